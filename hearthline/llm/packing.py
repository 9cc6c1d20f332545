"""Packing by cutting-stock column generation.

Documents are cut into pieces of at most one sequence. The histogram of rounded piece
lengths is the demand of a cutting-stock problem: a linear program chooses how often each
pattern of lengths is used, a knapsack by dynamic programming prices new patterns with
the program's duals, and the solution is rounded down; what is left is a bounded number
of pieces, packed first-fit by decreasing length. Pieces are ranked within their length,
and a rank says which copy of which pattern, and so which sequence, the piece goes to.
Only the histogram (one row per length) and the patterns reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import bounded_batches, texts
from hearthline.llm.vocabulary import WORD_BPE, path_of, whole_tokens, words_of_worker
from hearthline.sources.scratch import cut

SEQUENCE = 2048
END = 1
#: Tokens of one unit of length in the histogram.
UNIT = 8
#: Pieces of one block of ranks.
BLOCK = 100_000
#: The linear program stops pricing after so many columns; any basis is a valid plan.
COLUMNS = 20_000


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best pattern for these dual values: how many of each size fill the capacity."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = int(np.searchsorted(sizes, room, side="right"))
        if fits:
            worth = best[room - sizes[:fits]] + values[:fits]
            k = int(worth.argmax())
            if worth[k] > best[room] + 1e-12:
                best[room], choice[room] = worth[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), counts


def relax(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) of an optimal basis of the linear program, and how often each is used."""
    m = len(sizes)
    patterns = np.diag(capacity // sizes)
    inverse = np.diag(1.0 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(COLUMNS):
        duals = inverse.sum(axis=0)
        worth, pattern = price(np.maximum(duals, 0), sizes, capacity)
        if worth <= 1 + 1e-7:
            break
        step = inverse @ pattern
        able = step > 1e-9
        if not able.any():
            break
        ratio = np.full(m, np.inf)
        ratio[able] = used[able] / step[able]
        leave = int(ratio.argmin())
        used = np.maximum(used - ratio[leave] * step, 0)
        used[leave] = ratio[leave]
        patterns[leave] = pattern
        inverse[leave] /= step[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(step[others], inverse[leave])
    return patterns, used


@dataclass(frozen=True)
class Plan:
    """Per length, the ranks at which each pattern's share begins, and where it leads."""

    begins: dict[int, np.ndarray]
    per_copy: dict[int, np.ndarray]
    first_sequence: dict[int, np.ndarray]
    sequences: int

    def sequence(self, units: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        out = np.empty(len(units), np.int64)
        for unit in np.unique(units):
            at = units == unit
            r = ranks[at]
            k = np.searchsorted(self.begins[unit], r, side="right") - 1
            out[at] = self.first_sequence[unit][k] + (r - self.begins[unit][k]) // self.per_copy[unit][k]
        return out


def solve(histogram: dict[int, int], capacity: int = SEQUENCE // UNIT) -> Plan:
    """A plan for so many pieces of each length in units (1 to the capacity)."""
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    runs: list[tuple[np.ndarray, int]] = []  # counts by size, copies
    left = demand.copy()
    if len(sizes):
        patterns, used = relax(sizes, demand.astype(float), capacity)
        for k in np.argsort(-used, kind="stable"):
            fits = left[patterns[k] > 0] // patterns[k][patterns[k] > 0]
            copies = int(min(np.floor(used[k] + 1e-6), fits.min(initial=np.iinfo(np.int64).max)))
            if copies > 0:
                runs.append((patterns[k], copies))
                left -= copies * patterns[k]
    open_: list[tuple[int, np.ndarray]] = []
    for k in range(len(sizes) - 1, -1, -1):
        for _ in range(int(left[k])):
            at = next((i for i, (room, _) in enumerate(open_) if room >= sizes[k]), None)
            if at is None:
                open_.append((capacity, np.zeros(len(sizes), np.int64)))
                at = len(open_) - 1
            room, counts = open_[at]
            counts[k] += 1
            open_[at] = (room - int(sizes[k]), counts)
    runs += [(counts, 1) for _, counts in open_]
    shares: dict[int, list[tuple[int, int, int]]] = {int(s): [] for s in sizes}
    ranks, sequence = dict.fromkeys(shares, 0), 0
    for counts, copies in runs:
        for k in np.flatnonzero(counts):
            size, each = int(sizes[k]), int(counts[k])
            shares[size].append((ranks[size], each, sequence))
            ranks[size] += each * copies
        sequence += copies
    parts = {s: np.array(rows, np.int64).reshape(-1, 3) for s, rows in shares.items()}
    return Plan(*({s: rows[:, c] for s, rows in parts.items()} for c in range(3)), sequence)


def pieces(docs: DataFrame, name: str = WORD_BPE) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: every document's ids and end id, cut.

    Cuts lie at multiples of the sequence length. A null text counts as empty: its one
    id is the end id.
    """
    bounded_batches(docs.sparkSession)
    whole = whole_tokens(path_of(name))
    end = np.uint32(END).tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = words_of_worker(path_of(name), whole)
        for frame in frames:
            rows = []
            for doc, ids in zip(frame["doc_id"].tolist(), words.ids(frame["text"].tolist())):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, SEQUENCE):
                    part = ids[4 * start : 4 * (start + SEQUENCE)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), n))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            # ids go as text: pandas would turn a column with nulls into floats
            yield out.assign(doc_id=pd.Series([None if d is None else str(d) for d in out["doc_id"]], dtype=object))

    kind = docs.schema["doc_id"].dataType
    return (
        texts(docs)
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        .mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long")
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )


def pack(docs: DataFrame, name: str = WORD_BPE) -> DataFrame:
    """Where every piece of ``docs(doc_id, text)`` goes: its sequence and the offset there.

    Returns (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset). Repeated
    rows are packed each; which of two equal pieces comes first does not matter. Null ids
    stay null; an empty table gives no rows; other columns are not read.
    """
    units = F.ceil(F.col("length") / UNIT).cast("int")
    made = cut(pieces(docs, name).withColumn("units", units))
    histogram = {r["units"]: r["n"] for r in made.groupBy("units").agg(F.count("*").alias("n")).collect()}
    plan = solve(histogram)
    blocks = max(1, sum(histogram.values()) // BLOCK)

    @F.pandas_udf("long")
    def sequence(unit: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(plan.sequence(unit.to_numpy(np.int64), rank.to_numpy(np.int64)))

    blocked = made.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    before = Window.partitionBy("units").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        blocked.groupBy("units", "block")
        .agg(F.count("*").alias("n"))
        .select("units", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("units", "block").orderBy("doc_id", "start", "ids_crc32")
    ranked = blocked.withColumn("rank", F.row_number().over(within) - 1).join(bases, ["units", "block"])
    placed = ranked.withColumn("sequence_id", sequence("units", F.col("base") + F.col("rank")))
    inside = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )
