"""Token counts by whole tokens: proven vocabulary strings count one, only the rest is merged."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import bounded_batches, texts
from hearthline.llm.vocabulary import WORD_BPE, path_of, whole_tokens, words_of_worker

LIMIT = 2048


def token_counts(docs: DataFrame, name: str = WORD_BPE, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs(doc_id, text)``.

    n_tokens is what the library gives for the whole text without begin or end tokens;
    special strings inside a text count as the library has them. A null text counts as
    empty: no bytes, no tokens. Repeated rows each get their row, null ids stay null, and
    other columns are not read. The proof runs once on the driver; its result is bounded
    by the vocabulary.
    """
    bounded_batches(docs.sparkSession)
    whole = whole_tokens(path_of(name))

    @F.pandas_udf(T.LongType())
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = words_of_worker(path_of(name), whole)
        for batch in batches:
            yield pd.Series(words.counts(batch.tolist()), dtype="int64")

    counted = texts(docs).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), tokens("text").alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
