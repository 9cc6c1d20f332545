"""Document fingerprints: a digest of the quartiles of hashed byte triplets.

Every three bytes within four neighbours are hashed to one of 128 buckets. The digest
says for each bucket which quartile of all buckets its count lies in (two bits), and
carries a checksum of the text, its length on a logarithmic scale, and how far the
quartiles lie apart. Two digests are compared by a difference score with an upper bound.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import bounded_batches, texts

BUCKETS = 128
#: The difference at and beyond which two digests have nothing in common.
BOUND = 320
#: Texts of one run of neighbours, in bytes: a task sorts about so much.
RUN_BYTES = 32_000_000

_TABLES = [np.random.default_rng(seed).permutation(256).astype(np.uint8) for seed in (11, 12, 13)]
_STEPS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
_SLICE = 1 << 20


def digest(text: str) -> str:
    """72 hex digits; equal texts have equal ones, and texts under three bytes have no buckets set."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for salt, steps in enumerate(_STEPS):
        for low in range(0, len(data) - steps[2], _SLICE):
            high = min(low + _SLICE, len(data) - steps[2])
            mixed = np.uint8(salt) ^ _TABLES[0][data[low + steps[0] : high + steps[0]]]
            for table, step in zip(_TABLES[1:], steps[1:]):
                mixed ^= table[data[low + step : high + step]]
            counts += np.bincount(mixed & np.uint8(BUCKETS - 1), minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = min(255, round(8 * math.log2(len(data) + 1)))
    spread = (min(15, 16 * q1 // q3) << 4 | min(15, 16 * q2 // q3)) if q3 else 0
    return bytes([zlib.crc32(data) & 255, length, spread, 0]).hex() + packed.astype(np.uint8).tobytes().hex()


def difference(one: str, other: str) -> int:
    """0 for equal digests. A bucket counts the steps between its codes, six from end to end."""
    a, b = (np.frombuffer(bytes.fromhex(x), np.uint8) for x in (one, other))
    apart = sum(
        np.bincount(np.abs((a[4:] >> s & 3).astype(int) - (b[4:] >> s & 3).astype(int)), minlength=4)
        for s in (0, 2, 4, 6)
    )
    total = int(apart @ np.array([0, 1, 2, 6])) + int(a[0] != b[0])
    total += abs(int(a[1]) - int(b[1]))
    return total + abs(int(a[2] >> 4) - int(b[2] >> 4)) + abs(int(a[2] & 15) - int(b[2] & 15))


def likeness(one: str, other: str) -> float:
    return 1 - min(difference(one, other), BOUND) / BOUND


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of the next one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    waiting = None
    for frame in frames:
        rows = []
        for run, real, doc, text in zip(*(frame[c].tolist() for c in ("run", "real", "doc_id", "text"))):
            own = None
            if waiting and waiting[0] == run:
                own = digest(text)
                _, before, old, fingerprint = waiting
                changed = edited(old, text)
                other = digest(changed)
                sha = hashlib.sha256(changed.encode()).hexdigest()
                near = likeness(fingerprint, other), likeness(fingerprint, own)
                rows.append((before, len(old), sha, fingerprint, other, *near))
            waiting = (run, doc, text, own or digest(text)) if real else None
        yield pd.DataFrame(rows, columns=names)


def fingerprints(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The digest of every row of ``docs(doc_id, text)``, of its edited text, and their likeness.

    The next document is the one with the next smaller doc_id; rows with equal ids follow
    by the hash of their texts, null ids come last, and the last is followed by the first.
    A single document follows itself. A null text counts as empty. Other columns are not
    read.

    Documents are dealt into runs of neighbouring ids along the quantiles of doc_id; each
    run's first document goes to the run before it as well. One number per run reaches
    the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = texts(docs).select("doc_id", "text")
    size, largest = rows.agg(F.sum(F.octet_length("text")), F.max("doc_id")).first()
    n = max(1, -(-(size or 0) // run_bytes))
    ends = []
    if largest is not None:
        middle = rows.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if n > 1 else []
        ends = sorted({int(x) for x in middle} | {int(largest)})
    limits = np.array(ends, np.int64)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)  # null ids follow the smallest
        out[known] = np.searchsorted(limits, ids[known].to_numpy(np.int64))
        return pd.Series(out)

    dealt = rows.select(run_of("doc_id").alias("run"), F.lit(True).alias("real"), "doc_id", "text")
    # the first of a run (its end, as ids fall) follows the last of the run above it
    goes = [(int(e), (k + 1) % len(ends)) for k, e in enumerate(ends)] or [(0, 0)]
    heads = spark.createDataFrame(goes, "end long, run int")
    if not ends:
        first = rows.select(F.lit(0).alias("run"), F.lit(False).alias("real"), "doc_id", "text")
        both = dealt.unionByName(first)
    else:
        joined = rows.join(F.broadcast(heads), rows["doc_id"] == heads["end"])
        both = dealt.unionByName(joined.select("run", F.lit(False).alias("real"), "doc_id", "text"))
    kind = docs.schema["doc_id"].dataType
    return (
        both.repartitionById(max(1, len(ends)), "run")  # a task per run, none with two
        .sortWithinPartitions(
            "run", F.desc("real"), F.desc_nulls_last("doc_id"), F.xxhash64("text")
        )
        .select("run", "real", F.col("doc_id").cast("string").alias("doc_id"), "text")
        .mapInPandas(
            _compare,
            "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double",
        )
        .withColumn("doc_id", F.col("doc_id").cast(kind))
    )
