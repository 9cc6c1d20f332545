"""Row order inside a group, for groups of any size.

A plain window sends each group to one task. Here the groups are counted first (a job that
runs when the function is called). If none holds more than four blocks of rows, a plain
window it is. Larger groups are cut into blocks of about ``hot_rows`` rows along their own
order: splitters are drawn from the group by hash, every row finds its block, the window
runs per (group, block), and what a block needs from its neighbours (rows and sums before
it, last row before it, first row after it) comes from a table with one row per block.

Blocks keep their size however large the data is. A group that needs more than ``parts``
blocks is cut level by level, at most ``parts`` splitters in one array, each level inside
the blocks of the one before; and the table of blocks is walked by this same function, so
its groups are cut as well when they are large. Helper tables are broadcast up to
``SMALL`` rows and joined by shuffle beyond.

``order`` must be unique inside a group, or results depend on chance, as in any
window. Sums are of whole numbers or decimals, which are the same however rows are cut.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.sources.scratch import kept

#: Rows of a block.
HOT_ROWS = 250_000
#: Most splitters of one array; in `beside_group`, four times the most groups that are broadcast.
PARTS = 4096
#: Rows (or splitters) up to which a helper table is broadcast.
SMALL = 200_000


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _beside(df: DataFrame, small: DataFrame, columns: Sequence[str], how: str, is_small: bool = True) -> DataFrame:
    """``df`` joined with another frame, map-side if that is small; NULL group equal to NULL."""
    renamed = small.select(*[F.col(c).alias(f"_k_{c}") if c in columns else F.col(c) for c in small.columns])
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns])
    return df.join(F.broadcast(renamed) if is_small else renamed, on, how).drop(*[f"_k_{c}" for c in columns])


def hot_groups(df: DataFrame, groups: Sequence[str], hot_rows: int, parts: int) -> DataFrame:
    """The at most ``parts / 4`` groups with more than four blocks of rows, and
    the block size ``_step``."""
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    return _hot(sizes, total, hot_rows, parts).select(*groups, "_step")


def _hot(sizes: DataFrame, total: Column, hot_rows: int, parts: int) -> DataFrame:
    step = F.greatest(F.lit(hot_rows).cast("long"), F.ceil(total / parts).cast("long"))
    return sizes.withColumn("_step", step).filter(F.col("_n") > 4 * F.col("_step"))


def _splitters(drawn: DataFrame, groups: Sequence[str], order: Sequence[str], step: int) -> DataFrame:
    """Per group the marks of about one in ``step`` of its rows, ascending."""
    marks = [f"_o{i}" for i in range(len(order))]
    keyed = drawn.select(*groups, *[F.col(c).alias(m) for c, m in zip(order, marks)])
    return (
        keyed.filter(F.pmod(F.xxhash64(*marks), F.lit(step)) == 0)
        .groupBy(*groups)
        .agg(F.array_sort(F.collect_set(F.struct(*marks))).alias("_cuts"))
    )


def _blocked(df: DataFrame, cuts: DataFrame, keys: Sequence[str], order: Sequence[str], one: bool, small: bool) -> DataFrame:
    """``df`` with ``_block``: the number of its group's splitters at or before a row, found by halving.

    The splitters of a single group are a value beside the rows, those of several are joined to them; no row
    copies them or looks at more of them than their logarithm.
    """
    here = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0] or 0
    steps = [1 << bit for bit in reversed(range(most.bit_length()))]
    if one and steps:
        block = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda block, step: block + F.when(F.get("_cuts", block + step - 1) <= here, step).otherwise(0),
        )
        return df.withColumn("_cuts", cuts.select("_cuts").scalar()).withColumn("_block", block).drop("_cuts")
    df = _beside(df, cuts, keys, "left", small).withColumn("_block", F.lit(0))
    for step in steps:
        further = F.get("_cuts", F.col("_block") + (step - 1)) <= here
        df = df.withColumn("_block", F.col("_block") + F.when(further, step).otherwise(0))
    return df.drop("_cuts")


def _walked(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], asked: Mapping[str, Mapping[str, str]], tag: str
) -> dict[str, Column]:
    """The local window of every block; the names are those of ``ordered``, with a prefix each."""
    w = W.partitionBy(*groups).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = {f"{tag}_row": F.row_number().over(w).cast("long")}
    local |= {f"{tag}_r_{n}": F.sum(c).over(upto) for n, c in asked["sums"].items()}
    local |= {f"{tag}_m_{n}": F.min(c).over(upto) for n, c in asked["mins"].items()}
    local |= {f"{tag}_b_{n}": F.lag(c).over(w) for n, c in asked["lags"].items()}
    local |= {f"{tag}_a_{n}": F.lead(c).over(w) for n, c in asked["leads"].items()}
    return local


def _placed(
    df: DataFrame, hot: DataFrame, groups: Sequence[str], order: Sequence[str], hot_rows: int, parts: int, tag: str
) -> tuple[DataFrame, list[str], bool]:
    """``df`` with its block in a column per level (NULL outside the hot groups), and whether blocks are few."""
    most, total = hot.agg(F.max("_n"), F.sum("_n")).first()
    levels = max(1, math.ceil(math.log(most / hot_rows) / math.log(parts)))
    marks: list[str] = []
    groups_cut = hot.count()
    placed = _beside(df, hot.select(*groups, F.lit(True).alias(f"{tag}_hot")), groups, "left", groups_cut <= SMALL)
    for level in range(levels):
        step = hot_rows * parts ** (levels - 1 - level)
        cuts = kept(_splitters(placed.filter(f"{tag}_hot"), [*groups, *marks], order, step))
        mark = f"{tag}_block{level}"
        one = groups_cut == 1 and not marks
        placed = (
            _blocked(placed, cuts, [*groups, *marks], order, one, total / step <= SMALL)
            .withColumn(mark, F.when(F.col(f"{tag}_hot"), F.col("_block")))
            .drop("_block")
        )
        marks.append(mark)
    return placed, marks, total / hot_rows <= SMALL


def ordered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    sums: Mapping[str, str] | None = None,
    mins: Mapping[str, str] | None = None,
    lags: Mapping[str, str] | None = None,
    leads: Mapping[str, str] | None = None,
    counted: DataFrame | None = None,
    bounded: bool = False,
    hot_rows: int = HOT_ROWS,
    parts: int = PARTS,
    tag: str = "",
) -> DataFrame:
    """``df`` plus, per group in ``order``: the row ``number`` from 1, running
    ``sums`` and ``mins`` (name -> column, the row included), and the column's
    value one row before (``lags``) or after (``leads``).

    ``counted`` is a frame with the same rows per group that is cheaper to make; the
    groups are then counted there. ``bounded`` says that no group is large by its
    nature: nothing is counted then, and nothing runs yet. ``tag`` keeps the names of
    helper columns apart where tables of blocks are walked in turn."""
    asked = {"sums": dict(sums or {}), "mins": dict(mins or {}), "lags": dict(lags or {}), "leads": dict(leads or {})}
    for c in asked["sums"].values():
        if isinstance(df.schema[c].dataType, T.FractionalType) and not isinstance(df.schema[c].dataType, T.DecimalType):
            raise TypeError(f"sums of {c} would depend on how rows are cut; cast it to a decimal")
    columns = list(df.columns)
    groups = list(groups)
    if not groups:
        df = df.withColumn("_all", F.lit(0))
        groups = ["_all"]

    hot = None
    if not bounded:
        sized = df if counted is None or groups == ["_all"] else counted
        found = sized.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 4 * hot_rows)
        hot = kept(found)
    if hot is None or hot.isEmpty():
        out = df.withColumns(_walked(df, groups, order, asked, tag))
        plain = {number: F.col(f"{tag}_row")} if number else {}
        plain |= {n: F.col(f"{tag}_r_{n}") for n in asked["sums"]} | {n: F.col(f"{tag}_m_{n}") for n in asked["mins"]}
        plain |= {n: F.col(f"{tag}_b_{n}") for n in asked["lags"]} | {n: F.col(f"{tag}_a_{n}") for n in asked["leads"]}
        return out.select(*columns, *[c.alias(n) for n, c in plain.items()])

    placed, marks, few = _placed(df, hot, groups, order, hot_rows, parts, tag)
    local = _walked(placed, [*groups, *marks], order, asked, tag)
    if asked["leads"]:
        local[f"{tag}_more"] = F.lead(F.lit(True), 1, False).over(W.partitionBy(*groups, *marks).orderBy(*order))
    inside = placed.withColumns(local)

    # One row per block of a cut group.
    edge_order = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    blocks = kept(
        placed.filter(f"{tag}_hot")
        .groupBy(*groups, *marks)
        .agg(
            F.count(F.lit(1)).alias(f"{tag}_rows"),
            *[F.sum(c).alias(f"{tag}_t_{n}") for n, c in asked["sums"].items()],
            *[F.min(c).alias(f"{tag}_t_{n}") for n, c in asked["mins"].items()],
            *[F.max_by(F.struct(F.col(c).alias("v")), edge_order).alias(f"{tag}_l_{n}") for n, c in asked["lags"].items()],
            *[F.min_by(F.struct(F.col(c).alias("v")), edge_order).alias(f"{tag}_f_{n}") for n, c in asked["leads"].items()],
        )
    )
    again = {"hot_rows": hot_rows, "parts": parts, "bounded": few}
    walk, look = f"{tag}i", f"{tag}j"
    running_ = ordered(
        blocks, groups, marks,
        sums={f"{tag}_upto": f"{tag}_rows"} | {f"{tag}_u_{n}": f"{tag}_t_{n}" for n in asked["sums"]},
        mins={f"{tag}_u_{n}": f"{tag}_t_{n}" for n in asked["mins"]}, tag=walk, **again,
    )
    # the lines of totals before a block, and the values beside it
    beside = ordered(
        running_, groups, marks,
        lags={f"{tag}_rows_before": f"{tag}_upto"}
        | {f"{tag}_x_{n}": f"{tag}_u_{n}" for n in (*asked["sums"], *asked["mins"])}
        | {f"{tag}_x_{n}": f"{tag}_l_{n}" for n in asked["lags"]},
        leads={f"{tag}_x_{n}": f"{tag}_f_{n}" for n in asked["leads"]}, tag=look, **again,
    )
    told = {f"{tag}_t_{n}": f"{tag}_x_{n}" for n in (*asked["sums"], *asked["mins"])}
    told |= {f"{tag}_l_{n}": f"{tag}_x_{n}" for n in asked["lags"]} | {f"{tag}_f_{n}": f"{tag}_x_{n}" for n in asked["leads"]}
    edges = beside.select(*groups, *marks, f"{tag}_rows_before", *[F.col(c).alias(n) for n, c in told.items()])
    joined = _beside(inside, edges, [*groups, *marks], "left", few)

    out = {}
    if number:
        out[number] = F.col(f"{tag}_row") + F.coalesce(f"{tag}_rows_before", F.lit(0))
    for n in asked["sums"]:
        out[n] = F.when(
            F.col(f"{tag}_r_{n}").isNotNull() | F.col(f"{tag}_t_{n}").isNotNull(),
            F.coalesce(f"{tag}_r_{n}", F.lit(0)) + F.coalesce(f"{tag}_t_{n}", F.lit(0)),
        )
    for n in asked["mins"]:
        out[n] = F.least(f"{tag}_m_{n}", f"{tag}_t_{n}")
    for n in asked["lags"]:
        out[n] = F.when(F.col(f"{tag}_row") == 1, F.col(f"{tag}_l_{n}")["v"]).otherwise(F.col(f"{tag}_b_{n}"))
    for n in asked["leads"]:
        out[n] = F.when(F.col(f"{tag}_more"), F.col(f"{tag}_a_{n}")).otherwise(F.col(f"{tag}_f_{n}")["v"])
    return joined.select(*columns, *[c.alias(n) for n, c in out.items()])


def running(df: DataFrame, groups: Sequence[str], order: Sequence[str], sums: Mapping[str, str], **tuning) -> DataFrame:
    """``df`` with running sums per group."""
    return ordered(df, groups, order, sums=sums, **tuning)


def beside_group(
    df: DataFrame,
    groups: Sequence[str],
    aggregates: Mapping[str, Column],
    *,
    hot_rows: int = HOT_ROWS,
    parts: int = PARTS,
) -> DataFrame:
    """``df`` with aggregates of its group on every row; NULL for a NULL group.

    The aggregates are combined before the shuffle. Rows of the at most
    ``parts / 4`` groups above their share get them from a broadcast table and
    are not shuffled at all; the others meet them in one join on the group.
    """
    groups = list(groups)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in groups])
    facts = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in aggregates.items()]
    ).filter(known)
    hot = _hot(facts, df.agg(F.count(F.lit(1))).scalar(), hot_rows, parts).drop("_n", "_step")
    on_hot = df.join(F.broadcast(hot), groups, "inner")
    others = df.join(F.broadcast(hot.select(*groups)), groups, "left_anti").join(
        facts.drop("_n"), groups, "left"
    )
    columns = [*df.columns, *aggregates]
    return on_hot.select(*columns).unionByName(others.select(*columns))
