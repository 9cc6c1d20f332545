"""SimHash near-duplicates: BK-trees over fingerprints, searched within a Hamming radius.

A fingerprint bit is the majority of that bit over the hashes of all shingles. The
fingerprints are dealt into shards that share two of five bit blocks: two fingerprints
with at most three differing bits agree on at least two blocks, so every link lies
inside some shard. Each shard is a BK-tree (children keyed by the integer Hamming
distance to their parent); a search follows only edges whose distance lies within the
radius of the distance just measured. A shard beyond ``SHARD`` fingerprints is cut into
trees of about that size, and the fingerprints of the others pass through each tree, so
no task holds more than one bounded tree. The trees go to the tasks by shuffle, not by
broadcast: all trees together grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import bounded_batches, components, fresh, stored, texts

WORDS = 3
SEED = 42
RADIUS = 3
#: Bits of the five blocks, from the lowest.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of one tree.
SHARD = 20_000

_LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the unsigned 64-bit hashes; 0 without any."""
    n = len(hashes)
    if not n:
        return 0
    starts = np.arange(0, n, 255)  # a byte lane holds 255 ones
    ones = np.empty((8, 8), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        ones[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones.ravel() > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str, words: int = WORDS) -> int:
    """The unsigned fingerprint of a whole text; 0 for one without words."""
    tokens = text.encode().lower().split()  # of ASCII alone, in both
    if not tokens:
        return 0
    shingles = map(b" ".join, zip(*(tokens[k:] for k in range(words)))) if len(tokens) >= words else [b" ".join(tokens)]
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter((digest(s, SEED) for s in shingles), np.uint64))


class Tree:
    """A BK-tree of distinct fingerprints that also joins those within the radius."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children, self.parent = radius, [], [], []
        self.sets = 0

    def root(self, k: int) -> int:
        """The first node of the set of k."""
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def near(self, value: int, accepts=None) -> list[int]:
        """The first nodes of the joined sets that hold a value within the radius.

        ``accepts``: a further test of a node. The search ends once every set is found.
        """
        found: set[int] = set()
        todo = [0] if self.values else []
        while todo and len(found) < self.sets:
            k = todo.pop()
            distance = (self.values[k] ^ value).bit_count()
            if distance <= self.radius and self.root(k) not in found and (accepts is None or accepts(k)):
                found.add(self.root(k))
            low, high = distance - self.radius, distance + self.radius
            todo += [child for edge, child in self.children[k].items() if low <= edge <= high]
        return sorted(found)

    def add(self, value: int, found: list[int]) -> None:
        """Put in a new value that ``near`` found these sets for, and join them."""
        k = len(self.values)
        if k:
            at = 0
            while (step := self.children[at].get(edge := (self.values[at] ^ value).bit_count())) is not None:
                at = step
            self.children[at][edge] = k
        self.values.append(value)
        self.children.append({})
        self.parent.append(found[0] if found else k)
        for root in found[1:]:
            self.parent[root] = found[0]
        self.sets += 1 - len(found)


def block_keys(fp: str = "fp") -> F.Column:
    """The ten keys of a fingerprint: which two blocks, and their bits."""
    value, shift, blocks = F.col(fp), 0, []
    for width in BLOCKS:
        blocks.append(F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1)))
        shift += width
    keys = []
    for i in range(len(blocks)):
        for j in range(i + 1, len(blocks)):
            keys.append(F.shiftleft(F.shiftleft(blocks[i], 13).bitwiseOR(blocks[j]), 4).bitwiseOR(F.lit(len(keys))))
    return F.array(*(k.cast("int") for k in keys))


def _link_shards(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, tree = None, Tree(radius)
        for frame in frames:
            left, right = [], []
            columns = (frame[c].tolist() for c in ("key", "shard", "visits", "fp"))
            for key, part, visits, fp in zip(*columns):
                if (key, part) != shard:
                    shard, tree = (key, part), Tree(radius)
                value = fp & 0xFFFFFFFFFFFFFFFF
                found = tree.near(value)
                for k in found:
                    left.append(fp)
                    right.append(tree.values[k])
                if not visits:
                    tree.add(value, found)
            b = np.array(right, np.uint64).view(np.int64)
            yield pd.DataFrame({"a": np.array(left, np.int64), "b": b})

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` that connect just the fingerprints that pairs within ``radius`` connect.

    ``fps(fp)``: distinct signed longs, cheap to read twice. In each tree a fingerprint is
    linked to the first one of each set it joins: links are fewer than ten times the
    fingerprints, and make almost stars.
    """
    if radius > RADIUS:
        raise ValueError(f"the block keys are complete up to radius {RADIUS}")
    keyed = fps.select("fp", F.explode(block_keys()).alias("key"))
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")  # alone: no partner
    trees = F.ceil(F.col("n") / shard).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("trees")).cast("int")
    dealt = (
        keyed.join(counts, "key")
        .withColumn("trees", trees)
        .withColumn("own", own)
        .select("key", "own", F.explode(F.sequence(F.lit(0), "own")).alias("shard"), "fp")
        .select("key", "shard", (F.col("shard") != F.col("own")).alias("visits"), "fp")
    )
    return (
        dealt.repartition("key", "shard")
        .sortWithinPartitions("key", "shard", "visits", "fp")
        .mapInPandas(_link_shards(radius), "a long, b long")
        .distinct()
    )


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``(doc_id, fp)`` of every row, computed once and kept in the shared folder."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in batch], np.uint64).view(np.int64))

    return stored(texts(docs).select("doc_id", of("text").alias("fp")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have fingerprint zero and are linked like any other. Equal and
    repeated rows each get their row. component_id is the smallest doc_id reachable; null
    ids don't count for it. Other columns of docs are not read.
    """
    prints = fingerprints(docs)
    fps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(fps.select("fp")))
    grouped = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest doc_id.

    Rows that share that doc_id differ by text: the smallest hash stays; of rows equal in id
    and text the one whose other columns, as JSON, come first. A group whose ids are all
    null keeps one row as well. All columns are kept.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.LongType())
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in batch], np.uint64).view(np.int64))

    prints = stored(texts(docs).select("doc_id", F.xxhash64("text").alias("h"), of("text").alias("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("first")
    fps = stored(prints.groupBy("fp").agg(first))
    roots = components(fingerprint_links(fps.select("fp")))
    grouped = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    kept = grouped.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    id_, hash_, row = fresh(docs, "kept_id", "kept_hash", "kept_row")
    kept = kept.select(F.col("first.doc_id").alias(id_), F.col("first.h").alias(hash_))
    same = docs["doc_id"].eqNullSafe(kept[id_]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == kept[hash_])
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct(F.to_json(F.struct(*others)) if others else F.lit(""), F.col("text"))
    # one row of those equal in id and text, met before the shuffle: the least by its other columns
    one = docs.join(kept, same).groupBy(id_, hash_).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
    return one.select(f"{row}.*")
