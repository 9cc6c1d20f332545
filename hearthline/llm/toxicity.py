"""Toxicity: a lexicon trie searched by Levenshtein automata, weighed by context windows.

The lexicon is learned from labelled documents: words and stems that toxic documents
hold far more often. It is kept as a trie. Every distinct word of a text becomes a
Levenshtein automaton (a set of bit masks, one per number of edits) that runs along the
trie, so a misspelled term is found without listing its misspellings. Around each hit a
window of words is looked at: hits close to each other support one another, while hits
inside quotation marks, in quoted lines or behind a word of reporting count a quarter.
A logistic regression turns the sums into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import bounded_batches, fresh
from hearthline.llm.labelled import remainder, sample

#: Labelled rows learned from at most, and their bytes at most.
TRAIN_ROWS = 8000
TRAIN_BYTES = 30_000
#: Standard errors by which a term must be commoner in toxic documents.
Z = 6.0
LEXICON = 2000
STEMS = range(4, 13)
WINDOW = 10
FEATURES = 7
QUOTED = 0.25
REJECT = 0.7
#: Words whose hits a worker remembers.
REMEMBERED = 400_000

# Words that announce somebody else's words.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes term word words phrase reported stated "
    "dijo dice escribió palabra dit écrit mot sagte schrieb wort zitat".split()
)

_WORD = re.compile(r"[^\W_]+")
#: Quotation marks, quoted lines, and blank lines, which end a paragraph.
_MARKS = re.compile(r"[\"“”«»„]|^[ \t]*>[^\n]*|\n[ \t\r]*(?=\n)", re.M)
_CLOSES = {'"': '"', "“": "”", "«": "»", "„": "“”"}


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    lift: float

    @property
    def edits(self) -> int:
        """How many edits away the term is still recognised; stems must begin the word."""
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 9 else 2


def shortened(word: str, k: int) -> set[str]:
    """The word and what is left of it without up to k of its characters."""
    out = last = {word}
    for _ in range(k):
        last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
        out = out | last
    return out


class Lexicon:
    """A trie of the terms, searched exactly for stems and by an automaton for words.

    Two words within k edits are equal after up to k characters of each are left out, and of
    a term with k allowed edits one of k + 1 segments stays whole, at most k places away. The
    automaton runs only for words for which both hold for some term.
    """

    def __init__(self, terms: list[Term]):
        self.exact = {t.text: t for t in terms}
        self.stems = sorted({len(t.text) for t in terms if t.stem}, reverse=True)
        self.root: tuple[dict, list] = ({}, [])  # children by character, terms that end here
        self.short: dict[int, set[str]] = {}  # by allowed edits: what misspellings can be cut to
        self.lengths: dict[int, set[int]] = {}
        self.segments: dict[int, dict[tuple[int, int], set[str]]] = {}  # by place and length, too
        for term in terms:
            if term.edits:
                node, n, k = self.root, len(term.text), term.edits
                for c in term.text:
                    node = node[0].setdefault(c, ({}, []))
                node[1].append(term)
                self.short.setdefault(k, set()).update(shortened(term.text, k))
                self.lengths.setdefault(k, set()).update(range(n - k, n + k + 1))
                for i in range(k + 1):
                    a, b = n * i // (k + 1), n * (i + 1) // (k + 1)
                    for at in range(max(0, a - k), a + k + 1):
                        self.segments.setdefault(k, {}).setdefault((at, at + b - a), set()).add(term.text[a:b])
        self.edits = max((t.edits for t in terms), default=0)

    def near(self, word: str) -> bool:
        """Whether the word can be a misspelling of a term; true for all that are."""
        for k, lengths in self.lengths.items():
            if len(word) not in lengths:
                continue
            for (a, b), parts in self.segments[k].items():
                if word[a:b] in parts:
                    if not self.short[k].isdisjoint(shortened(word, k)):
                        return True
                    break
        return False

    def search(self, word: str) -> tuple[int, int, float] | None:
        """(0 for a stem or 1 for a word, edits, lift) of the nearest term; None without one."""
        found = self.exact.get(word)
        if found:
            return int(not found.stem), 0, found.lift
        stem = None
        for n in self.stems:
            term = self.exact.get(word[:n])
            if term and term.stem and (stem is None or term.lift > stem[2]):
                stem = (0, 0, term.lift)
        if stem or not self.near(word):
            return stem
        return self.misspelled(word)

    def misspelled(self, word: str) -> tuple[int, int, float] | None:
        """Run the word's Levenshtein automaton along the trie.

        Bit i of ``reached[j]`` is set if the path so far equals the first i characters of
        the word after at most j edits.
        """
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        last = 1 << len(word)
        full = 2 * last - 1
        best = None
        todo = [(self.root, tuple((2 << j) - 1 & full for j in range(self.edits + 1)))]
        while todo:
            (children, terms), reached = todo.pop()
            for term in terms:
                edits = next((j for j in range(term.edits + 1) if reached[j] & last), None)
                if edits is not None and (best is None or (edits, -term.lift) < (best[1], -best[2])):
                    best = (1, edits, term.lift)
            for c, child in children.items():
                mask = masks.get(c, 0)
                new = (reached[0] & mask) << 1
                states = [new]
                for j in range(1, len(reached)):
                    new = ((reached[j] & mask) << 1 | reached[j - 1] | reached[j - 1] << 1 | new << 1) & full
                    states.append(new)
                if states[-1]:
                    todo.append((child, tuple(states)))
        return best


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Quotations of any length within a paragraph, and quoted lines, in order.

    A straight mark after a space and before none only opens; after none and before one it
    only closes. An opening mark without its closing one quotes nothing.
    """
    spans, opened, kind = [], -1, ""
    for m in _MARKS.finditer(text):
        mark, at = m[0], m.start()
        if len(mark) > 1 or mark in ">\n":
            opened = -1
            if mark[0] != "\n":
                spans.append(m.span())
            continue
        opens, closes = mark in _CLOSES, opened >= 0 and mark in _CLOSES[kind]
        if mark == '"':
            before, after = text[at - 1 : at], text[at + 1 : at + 2]
            left, right = not before or before.isspace(), not after or after.isspace()
            opens, closes = opens and not (right and not left), closes and not (left and not right)
        if closes:
            spans.append((opened, m.end()))
            opened = -1
        elif opens and (opened < 0 or mark == kind):
            opened, kind = at, mark
    return spans


def features(text: str, hits: dict[str, tuple[int, int, float] | None], lexicon: Lexicon) -> list[float]:
    """Sums over the hits of a whole text; all zero without any. ``hits`` remembers words."""
    low = text.lower()
    words = _WORD.findall(low)
    if len(hits) > REMEMBERED:
        hits.clear()
    for w in set(words):
        if w not in hits:
            hits[w] = lexicon.search(w)
    at = [k for k, w in enumerate(words) if hits[w]]
    if not at:
        return [0.0] * FEATURES
    places = [m.start() for m in _WORD.finditer(low)]
    quoted = quoted_spans(low)
    exact = fuzzy = stems = lifts = closest = 0.0
    kinds: dict[str, float] = {}
    q, left = 0, 0
    weights = []
    for k in at:
        while q < len(quoted) and quoted[q][1] <= places[k]:
            q += 1
        inside = q < len(quoted) and quoted[q][0] <= places[k]
        told = any(w in REPORTING for w in words[max(0, k - 4) : k])
        weight = QUOTED if inside or told else 1.0
        weights.append(weight)
        kind, edits, lift = hits[words[k]]
        kinds[words[k]] = max(weight, kinds.get(words[k], 0.0))
        lifts += weight * lift
        if kind == 0:
            stems += weight
        elif edits:
            fuzzy += weight
        else:
            exact += weight
    for i, k in enumerate(at):
        while at[left] < k - WINDOW:
            left += 1
        closest = max(closest, sum(weights[left : i + 1][-WINDOW:]))
    share = 100 * (exact + fuzzy + stems) / len(words)
    return [math.log1p(v) for v in (exact, fuzzy, stems, share, closest, lifts, sum(kinds.values()))]


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...]
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, float).reshape(len(rows), -1) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -30, 30)))


def learn_terms(rows: list[tuple[str, int]]) -> list[Term]:
    """Words and stems that toxic texts hold more often by ``Z`` standard errors."""
    n = Counter(label for _, label in rows)
    if not n[0] or not n[1]:
        return []

    words_of = lambda text: set(_WORD.findall(text.lower()))
    prefixes = lambda w: [w[:k] for k in STEMS if k < len(w)]
    toxic: Counter = Counter()
    for text, label in rows:
        if label:
            words = words_of(text)
            toxic.update(words | {p for w in words for p in prefixes(w)})
    common = {t for t, k in toxic.items() if k >= max(3, n[1] / 200) and len(t) >= 3}
    clean, whole, known = Counter(), Counter(), {}
    for text, label in rows:
        words = words_of(text)
        if label:
            whole.update(words & common)
        else:
            held: set[str] = set()
            for w in words:
                if w not in known:
                    known[w] = [t for t in (w, *prefixes(w)) if t in common]
                held.update(known[w])
            clean.update(held)
    found = []
    for t in common:
        p1, p0 = toxic[t] / n[1], clean[t] / n[0]
        p = (toxic[t] + clean[t] + 1) / (n[0] + n[1] + 2)
        z = (p1 - p0) / math.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
        if z >= Z and p1 > 2 * p0:
            found.append((z, len(t), t))
    kept: list[str] = []
    kin: dict[str, list[str]] = {}
    for _, _, t in sorted(found, key=lambda x: (-round(x[0], 1), -x[1], x[2])):
        alike = kin.get(t[: STEMS[0]], [])  # with hardly more or fewer texts: the same term
        same = (k for k in alike if t.startswith(k) or k.startswith(t))
        if len(kept) < LEXICON and not any(0.9 * toxic[k] <= toxic[t] <= toxic[k] / 0.9 for k in same):
            kept.append(t)
            kin.setdefault(t[: STEMS[0]], []).append(t)
    lift = {t: math.log((toxic[t] + 0.5) / n[1] / ((clean[t] + 0.5) / n[0])) for t in kept}
    stems = {t for t in kept if whole[t] < 0.8 * toxic[t]}
    return [Term(t, t in stems, lift[t]) for t in sorted(kept)]


def learn(rows: list[tuple[str, int]]) -> Model:
    """The lexicon and the regression; without rows of both labels every score is the same low one."""
    terms = learn_terms(rows)
    lexicon, hits = Lexicon(terms), {}
    x = np.array([features(t, hits, lexicon) for t, _ in rows], float).reshape(-1, FEATURES)
    y = np.array([label for _, label in rows], float)
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(FEATURES)
    if not terms:
        return Model((), scale, np.array([-3.0] + [0.0] * FEATURES))
    x1 = np.hstack([np.ones((len(x), 1)), x / scale])
    w, ridge = np.zeros(FEATURES + 1), np.diag([1e-6] + [1.0] * FEATURES)
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        slope = x1.T @ (p - y) + ridge @ w
        curve = (x1 * (p * (1 - p) + 1e-9)[:, None]).T @ x1 + ridge
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(tuple(terms), scale, w)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents whose crc32(doc_id) mod 3 is not 1."""
    drawn = sample(docs, labels, "toxic", remainder(3) != 1, rows, TRAIN_BYTES)
    return learn([(r["text"], r["label"]) for r in drawn.collect()])


def scorer(model: Model):
    """A column function: the probability that a text is toxic; a null text counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, hits = Lexicon(list(model.terms)), {}
        for batch in batches:
            rows = [features(t or "", hits, lexicon) for t in batch]
            yield pd.Series(model.scores(rows))

    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``.

    Empty and null texts get the score of a text without hits. Null ids are never learned
    from and are not held out. Repeated rows each get their row. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    score = scorer(train(docs, labels))
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, trained_on: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that score under ``REJECT``, with all their columns."""
    bounded_batches(docs.sparkSession)
    score = scorer(train(docs if trained_on is None else trained_on, labels))
    (name,) = fresh(docs, "toxicity")
    return docs.withColumn(name, score("text")).filter(F.col(name) < REJECT).select(*docs.columns)
