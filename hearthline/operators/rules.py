"""Validation of raw records against declarative rules.

A rule names a field, a message and a predicate over the field's facts. A record
is valid if no rule finds it bad. ``items`` frames have an ``item`` VARIANT column
next to whatever columns identify the record.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.dates import iso_timestamp
from hearthline.functions.variants import facts, kind, needed, terms, text, values
from hearthline.operators.ordered import running

ERRORS = "array<struct<field:string,value:string,message:string>>"
MAX_ERRORS = 1000


@dataclass(frozen=True)
class Rule:
    """``bad`` is SQL in which {present}, {given}, {numeric}, {number}, {integral},
    {text}, {is_text} and {truthy} stand for facts of the field (see
    :mod:`hearthline.functions.variants`). NULL is not bad."""

    field: str
    message: str
    bad: str


# Messages and ranges below are fixed values: users match reports on them.
def required(field: str) -> Rule:
    return Rule(field, f"Required field '{field}' is missing or null", "NOT {given}")


def _number(field: str, message: str, holds: str) -> Rule:
    return Rule(field, message, "{given} AND NOT ({numeric} AND {number} " + holds + ")")


def _iso_date(field: str) -> Rule:
    date = iso_timestamp("<text>").replace("{", "{{").replace("}", "}}").replace("<text>", "{text}")
    return Rule(field, "Invalid date format", "{truthy} AND NOT ({is_text} AND " + date + " IS NOT NULL)")


def _common(year: int) -> list[Rule]:
    # A null price or zip code breaks its own rule besides the required one.
    return [
        Rule("price", "Price must be a positive number", "{present} AND NOT ({numeric} AND {number} > 0)"),
        _number("rooms", "Rooms must be a non-negative number", ">= 0"),
        _number("size", "Size must be a positive number", "> 0"),
        Rule(
            "zipCode",
            "zipCode must be a 4-digit number between 1000-9999",
            "{present} AND NOT ({integral} AND {number} BETWEEN 1000 AND 9999)",
        ),
        Rule(
            "buildYear",
            f"buildYear must be between 1800 and {year}",
            "{given} AND NOT ({integral} AND {number} BETWEEN 1800 AND " + str(year) + ")",
        ),
        _number("latitude", "latitude must be between -90 and 90", "BETWEEN -90 AND 90"),
        _number("longitude", "longitude must be between -180 and 180", "BETWEEN -180 AND 180"),
    ]


# The fields a record cannot do without, in report order.
REQUIRED_ACTIVE = ("id", "price", "rooms", "size", "city", "zipCode", "street")
REQUIRED_SOLD = ("estateId", "address", "zipCode", "price", "soldDate", "city")


def active_rules(year: int) -> list[Rule]:
    """Rules for homes for sale; ``year`` is the latest build year allowed."""
    return [
        *map(required, REQUIRED_ACTIVE),
        *_common(year),
        _number("daysForSale", "daysForSale must be a non-negative number", ">= 0"),
        _iso_date("createdDate"),
    ]


def sold_rules(year: int) -> list[Rule]:
    """Rules for homes sold; ``year`` is the latest build year allowed."""
    return [
        *map(required, REQUIRED_SOLD),
        *_common(year),
        _number("sqmPrice", "sqmPrice must be a non-negative number", ">= 0"),
        _iso_date("soldDate"),
    ]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _settle(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.selectExpr("*", f"explode(array({column})) AS {name}").drop(column)


def validate(items: DataFrame, rules: Sequence[Rule], enabled: bool = True) -> DataFrame:
    """``items`` with ``errors`` (all that apply, in rule order) and ``is_valid``.

    With ``enabled=False`` every record passes unexamined. Narrow: no shuffle.
    """
    if not enabled:
        return items.withColumns({"errors": F.array().cast(ERRORS), "is_valid": F.lit(True)})
    judged = _judged(items, rules)
    reports = []
    for i, rule in enumerate(rules):
        report = (
            f"named_struct('field', {_quoted(rule.field)}, 'value', {text(f'_raw.`{rule.field}`')}, "
            f"'message', {_quoted(rule.message)})"
        )
        reports.append(f"CASE WHEN _bad[{i}] THEN {report} END")
    # is_valid does not read errors, so that a job that wants no report makes none.
    is_valid = "NOT array_contains(_bad, true)"
    errors = f"filter(array({', '.join(reports)}), e -> e IS NOT NULL)"
    none = f"CAST(array() AS {ERRORS})"
    checked = judged.selectExpr("*", f"if({is_valid}, {none}, {errors}) AS errors", f"{is_valid} AS is_valid")
    return checked.drop("_raw", "_bad")


def _judged(items: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``items`` with the values of the rules' fields in ``_raw`` and ``_bad``, a verdict per rule."""
    wanted: dict[str, set[str]] = {}
    for rule in rules:
        wanted.setdefault(rule.field, set()).update(needed(rule.bad))
    looked = {f: facts_ for f, facts_ in wanted.items() if facts_}
    # Facts and verdicts are generated columns, so that a filter on what follows
    # stays above them instead of repeating the work that made them.
    def settled(df: DataFrame, name: str, of_field: Callable[[str], str]) -> DataFrame:
        every = ", ".join(f"{_quoted(f)}, {of_field(f)}" for f in looked)
        return _settle(df.selectExpr("*", f"named_struct({every}) AS _made"), "_made", name)

    # Values, then kinds, then the facts that rules ask for, so that each is worked out once.
    found = _settle(items.selectExpr("*", f"{values(wanted)} AS _made"), "_made", "_raw") if wanted else items
    if looked:
        found = settled(found, "_kinds", lambda f: kind(f"_raw.`{f}`"))
        found = settled(found, "_facts", lambda f: facts(f"_raw.`{f}`", f"_kinds.`{f}`", looked[f])).drop("_kinds")
    broken = [f"coalesce({rule.bad.format(**terms(f'_raw.`{rule.field}`', f'_facts.`{rule.field}`'))}, false)" for rule in rules]
    verdicts = f"CAST(array({', '.join(broken)}) AS array<boolean>)"
    return _settle(found.selectExpr("*", f"{verdicts} AS _verdicts"), "_verdicts", "_bad").drop("_facts")


def count_errors(items: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """As :func:`errors_by_field` of the validated records, counted from the verdicts: no report is made.

    Rules of one field and message count together; rules nobody broke are left out.
    """
    names = [f"_n{i}" for i in range(len(rules))]
    counted = _judged(items, rules).agg(*[F.expr(f"count_if(_bad[{i}]) AS {n}") for i, n in enumerate(names)])
    each = [
        f"named_struct('field', {_quoted(rule.field)}, 'message', {_quoted(rule.message)}, 'n', {n})"
        for rule, n in zip(rules, names)
    ]
    told = counted.selectExpr(f"inline(array({', '.join(each)}))").filter("n > 0")
    return told.groupBy("field", "message").agg(F.sum("n").alias("error_count"))


def error_budget(
    validated: DataFrame,
    group: str | Sequence[str],
    order: Sequence[str],
    max_errors: int = MAX_ERRORS,
    items: DataFrame | None = None,
    **tuning,
) -> DataFrame:
    """``validated`` with ``examined``: false once the errors of earlier records
    in the group reach ``max_errors``.

    ``is_valid`` becomes false for records not examined, and their errors go. Give
    the ``items`` that were validated to have groups counted without validating twice,
    or say ``bounded=True`` where a group is a page, which came as a single value.
    """
    groups = [group] if isinstance(group, str) else list(group)
    counted = running(
        validated.withColumn("_errors", F.expr("CAST(size(errors) AS BIGINT)")),
        groups,
        order,
        sums={"_so_far": "_errors"},
        counted=items,
        **tuning,
    )
    examined = (F.col("_so_far") - F.col("_errors")) < max_errors
    return (
        counted.withColumn("examined", examined)
        .withColumn("is_valid", F.col("examined") & F.col("is_valid"))
        .withColumn("errors", F.when(F.col("examined"), F.col("errors")).otherwise(F.array().cast(ERRORS)))
        .drop("_errors", "_so_far")
    )


def validation_summary(validated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """valid, invalid and total counts and the success rate, per ``by`` columns.

    Records an error budget left out count in the total only.
    """
    examined = F.col("examined") if "examined" in validated.columns else F.lit(True)
    total = F.count(F.lit(1))
    valid = F.count_if(F.col("is_valid"))
    return validated.groupBy(*by).agg(
        valid.alias("valid_count"),
        F.count_if(examined & ~F.col("is_valid")).alias("invalid_count"),
        total.alias("total_count"),
        F.when(total > 0, valid / total).otherwise(0.0).alias("success_rate"),
    )


def error_listing(validated: DataFrame) -> DataFrame:
    """The invalid records with their errors."""
    columns = [F.col(c) for c in validated.columns if c != "errors"]
    # The errors of invalid records alone, in a generated column: they are put together once.
    told = validated.filter("NOT is_valid").select(*columns, F.explode(F.array("errors")).alias("errors"))
    return told.filter(F.size("errors") > 0).select(*validated.columns)


def errors_exploded(validated: DataFrame, *keep: str) -> DataFrame:
    """One row per error, with the ``keep`` columns of its record."""
    return error_listing(validated).select(*keep, F.explode("errors").alias("_e")).select(*keep, "_e.*")


def errors_by_field(validated: DataFrame) -> DataFrame:
    """How often each rule was broken."""
    return errors_exploded(validated).groupBy("field", "message").agg(F.count(F.lit(1)).alias("error_count"))
