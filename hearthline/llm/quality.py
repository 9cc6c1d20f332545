"""Quality: a byte-level convolutional network in numpy.

A text is read as bytes in overlapping chunks that cover all of it. Filters learned over
``WIDTH`` neighbouring bytes, and over a plane that says how many of the last words
repeat the word before them, are max-pooled in each chunk; a dense layer makes one logit
of each chunk, and the logits are averaged into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import bounded_batches
from hearthline.llm.labelled import remainder, sample

TRAIN_ROWS = 6000
TRAIN_BYTES = 30_000
#: Chunks of a document that one epoch learns from.
TRAIN_CHUNKS = 3
EPOCHS = 14
CHUNK = 512
STEP = 384
WIDTH = 4
FILTERS = 8
GOOD = 0.3
#: Bytes worked on at once.
BLOCK = 1 << 18


def repeats(data: np.ndarray) -> np.ndarray:
    """For every byte, the share of the last eight words that equal the word before them."""
    space = (data == 32) | (data >= 9) & (data <= 13)
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return np.zeros(len(data), np.float32)
    words = data.tobytes().split()
    same = np.fromiter(map(eq, words[1:], words), bool, len(words) - 1)
    same = np.concatenate([[False], same])
    sums = np.concatenate([[0], np.cumsum(same)])
    number = np.arange(1, len(starts) + 1)
    share = (sums[number] - sums[np.maximum(number - 8, 0)]) / np.minimum(8, number)
    share = np.concatenate([[0], share]).astype(np.float32)
    return np.repeat(share, np.diff(np.concatenate([[0], starts, [len(data)]])))


def chunks(n: int) -> list[tuple[int, int]]:
    """Overlapping spans that cover n bytes; one (empty) span for no bytes."""
    return [(low, min(n, low + CHUNK)) for low in range(0, max(1, n - (CHUNK - STEP)), STEP)]


@dataclass
class Network:
    """One table of filter values per byte of the window; row 256 stands for beyond the text."""

    tables: np.ndarray  # WIDTH, 257, FILTERS
    repeat: np.ndarray  # FILTERS
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # FILTERS
    out: float

    def responses(self, data: np.ndarray, plane: np.ndarray) -> np.ndarray:
        """Filter values at every position of padded data (WIDTH - 1 entries longer)."""
        n = len(plane)
        z = np.take(self.tables[0], data[:n], axis=0)
        for k in range(1, WIDTH):
            z += np.take(self.tables[k], data[k : n + k], axis=0, mode="clip")
        z += plane[:, None] * self.repeat
        return z

    def logit(self, text: str) -> float:
        raw = np.frombuffer(text.encode(), np.uint8)
        data = np.concatenate([raw, np.full(WIDTH, 256)]).astype(np.intp)
        plane = np.concatenate([repeats(raw), [0]]).astype(np.float32)
        spans = chunks(len(raw))
        total, block = 0.0, max(1, BLOCK // STEP)
        for first in range(0, len(spans), block):
            part = spans[first : first + block]
            low, high = part[0][0], max(part[-1][1], part[0][0] + 1)
            z = self.responses(data[low : high + WIDTH - 1], plane[low:high])
            # the maxima over thirds of a chunk are shared by the chunks that overlap there
            third = CHUNK - STEP
            edges = np.arange(0, high - low, third)
            tops = np.maximum.reduceat(z, edges, axis=0)
            for a, b in part:
                k = (a - low) // third
                top = tops[k : max(k + 1, -(-(b - low) // third))].max(axis=0)
                total += float(np.maximum(top + self.bias, 0) @ self.dense) + self.out
        return total / len(spans)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -30, 30))))


def learn(rows: list[tuple[str, int]], seed: int = 7) -> Network:
    """Gradient descent (Adam) on the logistic loss of chunks drawn anew in each epoch."""
    random = np.random.default_rng(seed)
    y = np.array([label for _, label in rows], np.float32)
    n = len(rows)
    params = {
        "tables": random.normal(0, 0.05, (WIDTH, 257, FILTERS)).astype(np.float32),
        "repeat": random.normal(0, 0.5, FILTERS).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": random.normal(0, 0.5, FILTERS).astype(np.float32),
        "out": np.zeros(1, np.float32),
    }
    if not n or y.min() == y.max():
        params["dense"][:] = 0
        params["out"][:] = 1 if not n else 4 * (y[0] - 0.5)
        return Network(params["tables"], params["repeat"], params["bias"], params["dense"], float(params["out"][0]))
    raws = [np.frombuffer(t.encode(), np.uint8) for t, _ in rows]
    planes = [np.concatenate([repeats(r), [0]]).astype(np.float32) for r in raws]
    padded = [np.concatenate([r, np.full(CHUNK + WIDTH, 256)]).astype(np.int16) for r in raws]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) ** 0.5
    t = 0
    for epoch in range(EPOCHS):
        order = random.permutation(np.repeat(np.arange(n), TRAIN_CHUNKS if epoch else 1))
        for batch in np.array_split(order, max(1, len(order) // 128)):
            net = Network(params["tables"], params["repeat"], params["bias"], params["dense"], 0.0)
            windows, tops, at = [], np.empty((len(batch), FILTERS), np.float32), []
            for i, k in enumerate(batch):
                spans = chunks(len(raws[k]))
                a, b = spans[random.integers(len(spans))]
                b = max(b, a + 1)
                data, plane = padded[k][a : b + WIDTH], planes[k][a:b]
                z = net.responses(data, plane)
                best = z.argmax(axis=0)
                tops[i] = z[best, np.arange(FILTERS)]
                windows.append((data, plane))
                at.append(best)
            pooled = np.maximum(tops + params["bias"], 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ params["dense"] + params["out"], -30, 30)))
            error = ((p - y[batch]) * balance[batch] / len(batch)).astype(np.float32)
            back = error[:, None] * params["dense"] * (pooled > 0)
            slopes = {k: 1e-5 * v for k, v in params.items()}
            slopes["dense"] = slopes["dense"] + pooled.T @ error
            slopes["out"] = slopes["out"] + error.sum()
            slopes["bias"] = slopes["bias"] + back.sum(axis=0)
            for (data, plane), best, g in zip(windows, at, back):
                slopes["repeat"] += g * plane[best]
                for k in range(WIDTH):
                    slopes["tables"][k, data[best + k], np.arange(FILTERS)] += g
            t += 1
            for k, v in params.items():
                m, s = moments[k]
                m += 0.1 * (slopes[k] - m)
                s += 0.001 * (slopes[k] ** 2 - s)
                v -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-7)
    return Network(params["tables"], params["repeat"], params["bias"], params["dense"], float(params["out"][0]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """Learn from at most ``rows`` labelled documents whose crc32(doc_id) mod 5 is not 0."""
    drawn = sample(docs, labels, "quality", remainder(5) != 0, rows, TRAIN_BYTES)
    return learn([(r["text"], r["label"]) for r in drawn.collect()])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    Empty and null texts are scored as one empty chunk. Null ids are never learned from
    and are not held out. Repeated rows each get their row. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    network = train(docs, labels)

    @F.pandas_udf(T.DoubleType())
    def score(batch: pd.Series) -> pd.Series:
        return pd.Series([network.score(t or "") for t in batch], dtype="float64")

    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
