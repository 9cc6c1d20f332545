"""Facts about one field of a raw VARIANT record, as SQL text.

Rules must tell an absent key from a null, and a number from a text that looks
like one, so each field is taken out once with its kind and numeric value.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from string import Formatter

# SQL over a value {v} and its facts {f}; the names a rule may use.
#   present    the key is there           given     present and not null
#   numeric    a JSON number              integral  one written as an integer
#   number     its value                  text      the value as text
#   truthy     given and not one of '', 0, false, [] and {}
TERMS = {
    "present": "{v} IS NOT NULL",
    "given": "({v} IS NOT NULL AND NOT is_variant_null({v}))",
    "numeric": "({f}.number IS NOT NULL)",
    "integral": "({f}.number IS NOT NULL AND {f}.kind = 'BIGINT')",
    "number": "{f}.number",
    "text": "{f}.text",
    "is_text": "coalesce({f}.kind = 'STRING', false)",
    "truthy": (
        "({v} IS NOT NULL AND {f}.kind NOT IN ('VOID', 'OBJECT<>') AND coalesce({f}.number <> 0, true)"
        " AND NOT ({f}.kind = 'STRING' AND {f}.text = '')"
        " AND NOT ({f}.kind = 'BOOLEAN' AND {f}.text = 'false')"
        " AND NOT ({f}.kind = 'ARRAY<VOID>' AND {f}.text = '[]'))"
    ),
}
_FACTS = ("kind", "number", "text")
_NAME = re.compile("[A-Za-z_][A-Za-z0-9_]*")


def values(fields: Iterable[str], item: str = "item") -> str:
    """struct of the fields as they stand in the record, NULL if the key is absent."""
    fields = list(fields)
    if all(map(_NAME.fullmatch, fields)):  # keys, not paths: the record is walked once
        kinds = ", ".join(f"`{f}`: variant" for f in fields)
        return f"try_variant_get({item}, '$', 'struct<{kinds}>')"
    return f"named_struct({', '.join(f"'{f}', variant_get({item}, '$.{f}', 'variant')" for f in fields)})"


def text(value: str) -> str:
    """A value as text."""
    return f"try_cast({value} AS STRING)"


def _cast(value: str, type_: str) -> str:
    return f"try_variant_get({value}, '$', '{type_}')"


def _written(value: str, type_: str) -> str:
    """A number by its digits: much faster than the cast of a VARIANT, which is prepared anew for every value."""
    return f"try_cast(to_json({value}) AS {type_})"


def _exact(kind: str) -> str:
    return f"({kind} = 'BIGINT' OR startswith({kind}, 'DECIMAL'))"


def typed(value: str, kind: str, type_: str) -> str:
    """A value of a known kind as ``type_``, as the cast of a VARIANT gives it; NULL if it cannot be."""
    if type_ in ("int", "bigint"):
        return f"CASE WHEN {kind} = 'BIGINT' THEN {_written(value, type_)} ELSE {_cast(value, type_)} END"
    if type_ == "double":
        return f"CASE WHEN {_exact(kind)} THEN {_written(value, type_)} ELSE {_cast(value, type_)} END"
    return _cast(value, type_)


def kind(value: str) -> str:
    """The kind of a value taken out before."""
    return f"schema_of_variant({value})"


def needed(bad: str) -> set[str]:
    """The facts that a rule's SQL reads: kind, number and text cost time for every record."""
    used = " ".join(TERMS[name] for _, name, _, _ in Formatter().parse(bad) if name)
    return {fact for fact in _FACTS if f"{{f}}.{fact}" in used}


def facts(value: str, kind: str, wanted: Iterable[str]) -> str:
    """struct of the ``wanted`` facts of a value and its kind, both columns. The number is read
    only where there is one: a cast that fails is slow.
    """
    number = f"CASE WHEN {_exact(kind)} THEN {_written(value, 'double')} WHEN {kind} IN ('DOUBLE', 'FLOAT') THEN {_cast(value, 'double')} END"
    every = {"kind": kind, "number": number, "text": text(value)}
    return f"named_struct({', '.join(f"'{name}', {every[name]}" for name in _FACTS if name in wanted)})"


def terms(value: str, facts: str) -> dict[str, str]:
    """The rule terms spelt out for the columns of a value and its facts."""
    return {name: text.format(v=value, f=facts) for name, text in TERMS.items()}
