"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the hash of its content (its blob). A ledger
says which pairs of blob and rule version have been scanned and what was found. Only
unseen pairs are scanned, each blob once whatever the number of its copies, and findings
are joined back to all paths. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import BROADCAST_ROWS, texts
from hearthline.sources.scratch import cut


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches leftmost and without overlap; matches with a short ``group`` are dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    #: A cheaper pattern that every text with a match has, if there is one.
    hint: str = ""
    #: The pattern for SQL without lookbehind, in texts where a mark stands before each run of token characters.
    marked: str = ""


# Runs of one class of characters may state their length: a shorter run holds no longer one.
# The patterns of the rules, by rule version. A new version holds new rules only.
RULES: dict[int, tuple[Rule, ...]] = {
    1: (
        Rule(
            "assign",
            "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
            2,
            12,
            "(?i:passw|secret|token|api_?key)",
        ),
        Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18, "AKIA"),
        Rule("hex", "[0-9a-f]{16,}", 0, 16, "[0-9a-f]{16}"),
    ),
    2: (
        Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "-----BEGIN"),
        Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40, "gh[pousr]_"),
        # A run is entered only where it begins, and never given back: linear in the text.
        Rule(
            "jwt",
            "(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\\.eyJ[A-Za-z0-9_-]++\\.[A-Za-z0-9_-]++",
            0,
            0,
            "eyJ",
            "\ue000eyJ[A-Za-z0-9_-]+\\.\ue000eyJ[A-Za-z0-9_-]+\\.\ue000[A-Za-z0-9_-]+",
        ),
    ),
}
BASE = ("assign", "access", "hex")
KINDS = [rule.kind for rules in RULES.values() for rule in rules]

#: Matches walked at once: a list that grows is copied with each, so longer ones are put together from these.
CHUNK = 256

SPANS = "array<struct<start:long,kind:int,end:long>>"
LEDGER = f"blob string, rule_version int, spans {SPANS}"


def spans_of(text: F.Column, rule: Rule) -> F.Column:
    """The spans of a rule's matches in code points, end exclusive.

    What lies between the matches, and the matches, are measured one after the other.
    """
    pattern, number = F.lit(rule.pattern), KINDS.index(rule.kind)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    matched = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matched
    # zipped, so that each list is made once and not anew for every step
    steps = F.arrays_zip(between, F.transform(matched, F.length), F.transform(kept, F.length))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("out"))

    def walk(state: F.Column, step: F.Column) -> F.Column:
        start = state["at"] + step["0"]
        end = start + F.coalesce(step["1"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        out = F.when(step["2"] >= rule.least, F.array_append(state["out"], span)).otherwise(state["out"])
        return F.struct(end.alias("at"), out.cast(SPANS).alias("out"))

    def placed(steps: F.Column) -> F.Column:
        """The spans of all steps: those of each chunk by themselves, then moved to where it begins."""
        last = F.floor((F.size(steps) - 1) / CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(steps, k * CHUNK + 1, CHUNK))
        return F.get(F.transform(F.array(F.transform(chunks, lambda c: F.aggregate(c, zero, walk))), moved), F.lit(0))

    def moved(walked: F.Column) -> F.Column:
        nowhere = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("all"))
        begins = F.aggregate(
            walked,
            nowhere,
            lambda s, w: F.struct((s["at"] + w["at"]).alias("at"), F.array_append(s["all"], s["at"]).alias("all")),
            lambda s: s["all"],
        )

        def shifted(chunk: F.Column, by: F.Column) -> F.Column:
            return F.transform(
                chunk["out"],
                lambda s: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end")),
            )

        return F.flatten(F.zip_with(walked, begins, shifted))

    # arrays of one, so that what they hold is worked out once and has a name
    walked = F.get(F.transform(F.array(steps), placed), F.lit(0))
    return F.when(text.rlike(rule.hint or rule.pattern), walked).otherwise(F.array().cast(SPANS))


def empty_ledger(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame([], LEDGER)


def scan(
    versions: DataFrame, ledger: DataFrame | None = None, rule_versions: Sequence[int] = tuple(RULES)
) -> DataFrame:
    """New rows of the ledger: one per unseen pair of blob and rule version.

    ``versions(doc_id, text)``: any number of versions and paths, null texts as empty
    ones. The text of a blob is taken from the rows of its smallest doc_id; only hashes
    and ids are grouped, so copies cost no more than one row per task.
    """
    rows = texts(versions).select("doc_id", "text", F.sha2("text", 256).alias("blob"))
    first = rows.groupBy("blob").agg(F.min("doc_id").alias("first"))
    pairs = first.select("blob", "first", F.explode(F.array(*map(F.lit, rule_versions))).alias("rule_version"))
    if ledger is not None:
        pairs = pairs.join(ledger.select("blob", "rule_version"), ["blob", "rule_version"], "left_anti")
    wanted = (
        pairs.groupBy("blob", "first")
        .agg(F.collect_set("rule_version").alias("wanted"))
        .select(F.col("blob").alias("wanted_blob"), "first", "wanted")
    )
    # keyed by id, not by content: a much copied text is dealt out like any other
    todo = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first"]) & (rows["blob"] == wanted["wanted_blob"]))
    found = [
        F.when(
            F.array_contains("wanted", version),
            F.struct(
                F.lit(version).alias("rule_version"),
                F.concat(*(spans_of(F.col("text"), rule) for rule in rules)).alias("spans"),
            ),
        )
        for version, rules in RULES.items()
    ]
    scanned = todo.select("blob", F.explode(F.array_compact(F.array(*found))).alias("f"))
    return scanned.select("blob", "f.rule_version", "f.spans").dropDuplicates(["blob", "rule_version"])


def findings(versions: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``versions``, from a ledger that knows its blobs."""
    of_blob = (
        ledger.filter(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    )
    blobs, spans = ledger.agg(F.count_if(F.size("spans") > 0), F.sum(F.size("spans"))).first()
    if blobs <= BROADCAST_ROWS and (spans or 0) <= BROADCAST_ROWS:  # few texts hold anything
        of_blob = F.broadcast(of_blob)
    paths = texts(versions).select("doc_id", F.sha2("text", 256).alias("blob"))
    none = F.array().cast(SPANS)
    return paths.join(of_blob, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


@dataclass(frozen=True)
class Scanned:
    """What a scan says of every row, and the ledger to give to the next one."""

    report: DataFrame
    ledger: DataFrame


def incremental(versions: DataFrame, ledger: DataFrame | None = None) -> Scanned:
    """Scan what the ledger does not know, and report on every row of ``versions``.

    The new rows of the ledger are computed here, once, and kept in the shared folder.
    """
    new = cut(scan(versions, ledger))
    every = new if ledger is None else new.unionByName(ledger.select(new.columns))
    return Scanned(_reported(findings(versions, every)), every)


def secrets(docs: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row of ``docs``.

    A null text counts as empty, a text without findings has the hash of the empty
    string and no spans. Repeated rows each get their row; null ids are scanned too.
    Other columns are not read. ``ledger``: what earlier scans found; :func:`incremental`
    gives the ledger after this one as well.
    """
    return incremental(docs, ledger).report


def in_two_scans(docs: DataFrame) -> DataFrame:
    """As :func:`secrets`, the way a ledger grows: documents with even ids were scanned before, by
    the first rules; now all documents come with all rules, and only what is new is scanned."""
    earlier = docs.filter(F.col("doc_id") % 2 == 0)
    known = cut(scan(earlier, rule_versions=(min(RULES),)))
    return secrets(docs, known)


def _reported(found: DataFrame) -> DataFrame:
    """The columns of a report from ``(doc_id, spans)``."""

    def joined(spans: F.Column) -> F.Column:
        kinds = F.array(*map(F.lit, KINDS))
        said = F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(said, ",")

    def count(k: int) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *(count(k) for k in range(len(BASE))),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _sql_spans(version_kind: int, rule: Rule) -> str:
    pattern, text = (rule.marked or rule.pattern).replace("'", "''"), "text"
    if rule.marked:  # marks are put in, and do not count
        text = "regexp_replace(text, '(^|[^A-Za-z0-9_-])([A-Za-z0-9_-])', '\\1\ue000\\2', 'g')"
    size = "length(replace({}, '\ue000', ''))" if rule.marked else "length({})"
    return f"""SELECT doc_id, {version_kind} AS kind, '{rule.kind}' AS name,
      list_sum([{size.format("x")} for x in gaps[1:k]])
        + coalesce(list_sum([{size.format("x")} for x in found[1:k - 1]]), 0) AS start,
      {size.format("found[k]")} AS size, length(kept[k]) AS kept
    FROM (SELECT doc_id, gaps, found, kept, unnest(range(1, len(found) + 1)) AS k FROM (
      SELECT doc_id, string_split_regex(marked, '{pattern}') AS gaps, regexp_extract_all(marked, '{pattern}', 0) AS found,
        regexp_extract_all(marked, '{pattern}', {rule.group}) AS kept FROM (SELECT doc_id, {text} AS marked FROM t)))
    WHERE length(kept[k]) >= {rule.least}"""


def oracle() -> str:
    """The query's rows in DuckDB."""
    parts = [_sql_spans(KINDS.index(r.kind), r) for rules in RULES.values() for r in rules]
    said = "name || ':' || CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + size AS BIGINT) AS VARCHAR)"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    s AS ({' UNION ALL '.join(parts)}),
    g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
      count(*) FILTER (kind = 2) AS n_hex,
      coalesce(string_agg({said}, ',' ORDER BY start, kind) FILTER (kind < {len(BASE)}), '') AS base,
      string_agg({said}, ',' ORDER BY start, kind) AS spans FROM s GROUP BY doc_id)
    SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
      coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM t LEFT JOIN g ON t.doc_id = g.doc_id"""
