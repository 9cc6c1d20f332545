"""A bounded sample of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import texts


def remainder(divisor: int, doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id's text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % divisor


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: F.Column, rows: int, longest: int) -> DataFrame:
    """``(text, label)`` of at most ``rows`` labelled documents where ``learn`` holds.

    Rows are drawn by a hash of the id, from documents of at most ``longest`` bytes, so
    what reaches the driver is bounded. Unlabelled, null and doubly labelled ids are left
    out of learning (of two labels of one id, the larger counts).
    """
    drawn = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    short = texts(docs).filter(F.octet_length("text") <= longest)
    return short.join(F.broadcast(drawn), "doc_id").select("text", "label").orderBy(F.xxhash64("text")).limit(rows)
