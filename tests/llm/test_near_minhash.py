"""Near-duplicates by word sets against brute force over all pairs."""

from __future__ import annotations

import random
import re
from pathlib import Path

import numpy as np
import pytest

from hearthline.llm import near_minhash, queries
from tests.llm.test_operators import frame, groups, odd, prose

SMALL = Path("/root/testdata/sf0.001")


def slow_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
    if len(words) < 5:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[k : k + 5]) for k in range(len(words) - 4))


def slow(rows):
    """Per row (id, set size, component)."""
    sets = [slow_set(t) for _, t in rows]
    holding = {}
    for k, s in enumerate(sets):
        for x in s:
            holding.setdefault(x, []).append(k)
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for other in {j for x in s for j in holding[x] if j < k}:
            if 100 * len(s & sets[other]) >= 85 * len(s | sets[other]) and top(other) != top(k):
                root[top(k)] = top(other)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted(
        (str(i), len(sets[k]), str(least.get(top(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows)
    )


def got_of(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def changed(seed, base, words):
    """The text with up to so many words changed."""
    chosen, out = random.Random(seed), base.split()
    for k in chosen.sample(range(len(out)), chosen.randint(0, words)):
        out[k] = f"new{seed}x{k}"
    return " ".join(out)


def copies():
    """Groups of near copies of every likeness around the threshold, chains and texts apart."""
    rows = []
    for g in range(12):
        base = prose(1000 + g, 80 + 20 * g)
        rows += [(1000 * g + k, changed(1000 * g + k, base, 1 + g % 4)) for k in range(10)]
    chain = prose(77, 400).split()
    for k in range(30):  # each 85 to 95% like the next, the ends have nothing in common
        rows.append((50_000 + k, " ".join(chain[5 * k : 5 * k + 120])))
    passage = prose(78, 60)
    rows += [(60_000 + k, f"{prose(3000 + k, 200)} {passage} {prose(4000 + k, 30)}") for k in range(20)]
    return rows + [(70_000 + k, prose(5000 + k, k)) for k in range(8)] * 2


def test_equals_brute_force(spark):
    rows = copies() + odd()
    assert got_of(near_minhash.near_duplicates(frame(spark, rows))) == slow(rows)


def test_large_nodes(spark):
    """Nodes beyond the leaf: some branch on, some are compared in blocks; nothing gets lost."""
    base = prose(9, 150)
    rows = [(k, changed(k, base, 6)) for k in range(150)]
    rows += [(1000 + k, changed(k, prose(10, 60), 1)) for k in range(80)]
    rows += copies()
    for leaf, limit in ((6, 10**9), (20, 10**9), (1000, 2000)):
        assert got_of(near_minhash.near_duplicates(frame(spark, rows), leaf=leaf, shingle_limit=limit)) == slow(rows)


def test_odd_cases(spark):
    got = near_minhash.near_duplicates(frame(spark, odd())).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"] and by_id[5]["kept"]
    assert by_id[2]["component_id"] == 2 and by_id[3]["component_id"] == 3 and by_id[4]["n_shingles"] == 0
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True, True]
    assert near_minhash.near_duplicates(frame(spark, [])).collect() == []


def test_recall_of_the_trees():
    """Pairs at the threshold that share a leaf, going down as far as six levels."""
    chosen, found, tried = np.random.default_rng(1), 0, 3000
    trees = near_minhash.trees_for(near_minhash.RECALL)
    for _ in range(tried):
        both = chosen.integers(0, 2**64, 850, dtype=np.uint64)
        one, other = (np.concatenate([both, chosen.integers(0, 2**64, 75, dtype=np.uint64)]) for _ in range(2))
        sigs = near_minhash.tokens([one, other])
        for t in range(trees):
            paths = {t}
            for level in range(6):
                below = set()
                for node in paths:
                    at = near_minhash.branch(np.full(2, node, np.uint64), np.full(2, t), level, sigs)
                    below |= {int(a) for a, b in zip(*at) if a == b}
                paths = below
            if paths:
                found += 1
                break
    assert trees == 2 and found >= tried - 3


def test_links_and_classes():
    """A part's links against all pairs, joined and passive documents as told."""
    texts = [t for _, t in copies()[:60]]
    sets = [near_minhash.shingles(t) for t in texts]
    alike = lambda a, b: 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    ids = list(range(60))
    want = groups(ids, alike)
    links = near_minhash.links_within(ids, [near_minhash.ACTIVE] * 60, sets)
    assert groups(ids, lambda a, b: (a, b) in links or (b, a) in links) == want
    kinds = [near_minhash.JOINED] * 5 + [near_minhash.ACTIVE] * 30 + [near_minhash.PASSIVE] * 25
    links = near_minhash.links_within(ids, kinds, sets)
    told = groups(
        ids, lambda a, b: max(a, b) < 5 or 5 <= a < 35 and alike(a, b) or 5 <= b < 35 and alike(a, b)
    )
    assert groups(ids, lambda a, b: max(a, b) < 5 or (a, b) in links or (b, a) in links) == told


@pytest.mark.skipif(not SMALL.exists(), reason="no given tables")
def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got_of(queries.op11_minhash(spark, str(SMALL))) == slow(rows)
