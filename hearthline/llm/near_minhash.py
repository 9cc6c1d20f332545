"""MinHash near-duplicates: a chosen-path similarity join over sets of word shingles.

Every document starts at the root of each of several independent trees. At a node it
follows a few selected minwise tokens (the smallest hash of its shingles under one of 64
orders): documents with the same token meet in the same child. Two documents 85% alike
share a child of any node with three branches with probability 0.997, unrelated ones nearly
never, so nodes shrink quickly. Small nodes are compared exhaustively. Two trees leave out
about one in 70,000 pairs at the threshold, fewer above it.

Some nodes do not shrink: their documents are alike on average, as a text copied with
changes by thousands. Such a node is not branched any further but compared in blocks,
cheaply: first every document with the one that is nearest to the node's most common
tokens (whatever is linked to it is one class), then only the documents left over with all.

Equal sets are one document throughout. Which documents of a small node can be alike is
read off their 64 tokens; only those documents' full sets are made and moved, once for
each distinct group of them, however many nodes hold it. Links are confirmed on the full sets, as
intersections of bit vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.llm.common import bounded_batches, components, sized, stored, texts

WORDS = 5
#: A pair is linked if 100 * intersection >= 85 * union.
PERCENT = 85
#: Minwise tokens of a document, and those a node branches on.
TOKENS = 64
BRANCHES = 3
#: Share of the pairs at the threshold that the trees find at least; trees are added to reach it.
RECALL = 0.9999
#: Equal tokens from which the full sets of two documents are compared. A pair at the
#: threshold has 54.4 on average, and fewer than this once in 30,000.
AGREE = 42
#: A node is small up to so many documents and shingles, which bounds one comparison's memory.
LEAF = 2048
LEAF_SHINGLES = 1_000_000
#: Documents of a block in which a node that does not shrink is compared.
PART = 512
#: Documents drawn from a large node to find its most common tokens.
DRAWN = 64
#: A large node whose documents share this part of those tokens on average does not shrink.
DENSE = 0.6

_ORDERS = np.random.default_rng(11).integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = np.random.default_rng(12).integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.default_rng(13).integers(1, 2**63, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles hashed at once.
_CHUNK = 1_000_000


def trees_for(recall: float, percent: int = PERCENT, branches: int = BRANCHES) -> int:
    """Trees that find a pair at the threshold with at least this probability."""
    alike, found = percent / 100, 1.0
    for _ in range(100):  # at any depth: some shared branch must lead to a shared leaf
        found = 1 - (1 - alike * found) ** branches
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str, hashes: dict | None = None) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; fewer words make one shingle."""
    words = text.encode().lower().split()  # of ASCII alone, in both
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _WordHashes() if hashes is None else hashes
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = out + each[k : k + len(out)] * _PLACES[k]
    return np.unique(_mixed(out))


def tokens(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens of each set (not empty), a row each."""
    out = np.empty((len(sets), TOKENS), np.uint32)
    first = 0
    while first < len(sets):
        last, held = first + 1, len(sets[first])
        while last < len(sets) and held + len(sets[last]) <= _CHUNK:
            held += len(sets[last])
            last += 1
        together = np.concatenate(sets[first:last])
        starts = np.cumsum([0, *(len(s) for s in sets[first : last - 1])])
        for k, order in enumerate(_ORDERS):
            ranked = ((together * order) >> np.uint64(32)).astype(np.uint32)
            out[first:last, k] = np.minimum.reduceat(ranked, starts)
        first = last
    return out


def branch(nodes: np.ndarray, tree: np.ndarray, level: int, sigs: np.ndarray) -> np.ndarray:
    """The children, a column per branch, of documents with tokens ``sigs`` at their nodes.

    Each tree has its own order of the tokens; a path never selects a token twice.
    """
    out = np.empty((len(nodes), BRANCHES), np.uint64)
    for b in range(BRANCHES):
        # a step that shares no factor with the number of tokens runs through all of them
        places = (tree * 23 + (2 * tree + 1) * (level * BRANCHES + b)) % TOKENS
        chosen = sigs[np.arange(len(sigs)), places].astype(np.uint64)
        out[:, b] = _mixed(nodes * _STEPS[0] + places.astype(np.uint64) * _STEPS[1] + chosen * _STEPS[2] + _STEPS[3])
    return out


DEEPEST = TOKENS // BRANCHES - 1


def _sign(trees: int):
    hashes = _WordHashes()

    @F.pandas_udf("doc long, n long, sig binary, nodes array<long>")
    def run(batch: pd.Series) -> pd.DataFrame:
        sets = [shingles(t, hashes) for t in batch]
        full = [k for k, s in enumerate(sets) if len(s)]
        out = pd.DataFrame({"doc": None, "n": [len(s) for s in sets], "sig": None, "nodes": None}, dtype=object)
        if full:
            sigs = tokens([sets[k] for k in full])
            nodes = []
            for t in range(trees):
                tree = np.full(len(full), t)
                nodes.append(branch(tree.astype(np.uint64), tree, 0, sigs))
            nodes = np.concatenate(nodes, axis=1).view(np.int64)
            for at, k in enumerate(full):
                name = xxhash.xxh3_64_intdigest(sets[k].tobytes()) - (1 << 63)
                out.iat[k, 0], out.iat[k, 2], out.iat[k, 3] = name, sigs[at].tobytes(), nodes[at]
        out["doc"] = out["doc"].astype("Int64")
        return out

    return run


def signed(docs: DataFrame, trees: int) -> DataFrame:
    """``(doc_id, h, doc, n, sig, nodes)`` of every row, kept in the shared folder.

    h: xxhash64 of the text; doc: a hash of its set, null if that is empty; nodes: the
    children of the root in each tree.
    """
    bounded_batches(docs.sparkSession)
    of = texts(docs).select("doc_id", F.xxhash64("text").alias("h"), _sign(trees)("text").alias("s"))
    return stored(of.select("doc_id", "h", "s.*"))


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(len(sigs), TOKENS)


@F.pandas_udf(T.BinaryType())
def _most_common(drawn: pd.Series) -> pd.Series:
    """The most common value of every token."""

    def one(sigs) -> bytes:
        out = np.empty(TOKENS, np.uint32)
        for k, column in enumerate(_matrix(sigs).T):
            values, counts = np.unique(column, return_counts=True)
            out[k] = values[np.argmax(counts)]
        return out.tobytes()

    return pd.Series([one(s) for s in drawn])


@F.pandas_udf(T.IntegerType())
def _agreeing(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series((_matrix(list(left)) == _matrix(list(right))).sum(axis=1).astype(np.int32))


def _children(level: int):
    @F.pandas_udf("array<long>")
    def run(node: pd.Series, tree: pd.Series, sig: pd.Series) -> pd.Series:
        at = node.to_numpy(np.int64).view(np.uint64)
        return pd.Series(list(branch(at, tree.to_numpy(np.int64), level, _matrix(list(sig))).view(np.int64)))

    return run


def _groups(frames: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The rows of each value of a sorted column, also where a batch ends within them."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        values = frame[column].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        ends = [0, *cuts.tolist(), len(frame)]
        for low, high in zip(ends, ends[1:]):
            part = frame.iloc[low:high]
            if held and held[-1][column].iat[0] != part[column].iat[0]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _close(sizes: list[int], i: int, j: int) -> bool:
    """Whether two sets of these sizes can be alike."""
    return 100 * min(sizes[i], sizes[j]) >= PERCENT * max(sizes[i], sizes[j])


def _candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The documents of each small node that may be alike, in groups named by what they hold."""
    out: list[tuple[int, int]] = []
    for frame in _groups(frames, "node"):
        docs, sizes = frame["doc"].to_numpy(np.int64), frame["n"].tolist()
        sigs = _matrix(frame["sig"].tolist())
        root = np.arange(len(docs))
        for i in range(1, len(docs)):
            for j in np.flatnonzero((sigs[:i] == sigs[i]).sum(axis=1) >= AGREE):
                if root[i] != root[j] and _close(sizes, i, j):
                    root[root == root[i]] = root[j]
        for r in np.unique(root):
            group = np.sort(docs[root == r])
            if len(group) > 1:
                name = xxhash.xxh3_64_intdigest(group.tobytes()) - (1 << 63)
                out += [(name, int(d)) for d in group]
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=["part", "doc"])
            out = []
    yield pd.DataFrame(out, columns=["part", "doc"]).astype("int64")


#: What a document is in a part: compared with all; compared with those only; the same, and of one class.
ACTIVE, PASSIVE, JOINED = range(3)


def links_within(docs: list[int], kinds: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links ``(class representative, document)`` of the documents of a part, confirmed on full sets.

    A joined document, if there is one, represents its class.
    """
    sizes = [len(s) for s in sets]
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # others are in no intersection
    seat = np.cumsum(shared) - 1
    width = int(shared.sum())
    ends = np.cumsum([0, *sizes])
    bits = []
    for low, high in zip(ends, ends[1:]):
        here = places[low:high]
        row = np.zeros(width, np.uint8)
        row[seat[here[shared[here]]]] = 1
        bits.append(int.from_bytes(np.packbits(row).tobytes(), "big"))
    root = list(range(len(docs)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    joined = [k for k, kind in enumerate(kinds) if kind == JOINED]
    for k in joined[1:]:
        root[k] = joined[0]
    first = joined[0] if joined else -1
    active = [k for k, kind in enumerate(kinds) if kind == ACTIVE]
    for i in active:
        own, size = bits[i], sizes[i]
        for j in range(len(docs)):
            if j == i or kinds[j] == ACTIVE and j > i or not _close(sizes, i, j):
                continue
            a, b = top(i), top(j)
            if a == b:
                continue
            both = (own & bits[j]).bit_count()
            if 100 * both >= PERCENT * (size + sizes[j] - both):
                a, b = (a, b) if a == first or b != first and a < b else (b, a)
                root[b] = a
    return [(docs[r], docs[k]) for k in range(len(docs)) if kinds[k] != JOINED and (r := top(k)) != k]


def _confirm(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple[int, int, int]] = []
    for frame in _groups(frames, "part"):
        frame = frame.sort_values(["doc", "kind"]).drop_duplicates("doc")  # active counts before passive
        sets = [np.frombuffer(s, np.uint64) for s in frame["set"]]
        node = int(frame["node"].iat[0])
        out += [(node, *link) for link in links_within(frame["doc"].tolist(), frame["kind"].tolist(), sets)]
        if len(out) > 50_000:
            yield pd.DataFrame(out, columns=["node", "a", "b"])
            out = []
    yield pd.DataFrame(out, columns=["node", "a", "b"]).astype("int64")


def _confirmed(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """``(node, a, b)``: the links within the parts of ``parts(part, node, doc, kind)``."""
    return (
        parts.join(sets, "doc")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInPandas(_confirm, "node long, a long, b long")
    )


def _make_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, seen = _WordHashes(), set()
    for frame in frames:
        docs, out = [], []
        for doc, text in zip(frame["doc"].tolist(), frame["text"].tolist()):
            if doc not in seen:  # rows equal in id and text
                seen.add(doc)
                docs.append(doc)
                out.append(shingles(text, hashes).tobytes())
        yield pd.DataFrame({"doc": np.array(docs, np.int64), "set": out})


def _sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc, set)`` of the wanted documents, each made from one of its rows."""
    source = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("s")
    of = stored(
        rows.join(sized(wanted), "doc", "left_semi").groupBy("doc").agg(source).select(
            "doc", F.col("s.doc_id").alias("source_id"), F.col("s.h").alias("source_h")
        )
    )
    plain = texts(docs).withColumn("h", F.xxhash64("text"))
    same = plain["doc_id"].eqNullSafe(F.col("source_id")) & (plain["h"] == F.col("source_h"))
    made = plain.join(sized(of), same).select("doc", "text").mapInPandas(_make_sets, "doc long, set binary")
    return stored(made.dropDuplicates(["doc"]))


def _branched(rows: DataFrame, trees: int, leaf: int, shingle_limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Members of small nodes ``(node, doc, n, sig)`` and of dense ones ``(node, doc, n, medoid, parts)``."""
    tree = (F.col("at") / BRANCHES).cast("int").alias("tree")
    met = rows.filter("doc IS NOT NULL").select("doc", "n", F.posexplode("nodes").alias("at", "node"))
    met = met.select("node", tree, "doc", "n").distinct()
    shared = stored(met.groupBy("node").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("node"))
    members = stored(met.join(sized(shared), "node", "left_semi"))
    wanted = stored(members.select("doc").distinct())
    sigs = stored(
        rows.select("doc", "sig").join(sized(wanted), "doc", "left_semi").groupBy("doc").agg(F.any_value("sig").alias("sig"))
    )
    small, dense, level = [], [], 0
    while True:
        sizes = members.groupBy("node").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
        large = stored(sizes.filter((F.col("docs") > leaf) | (F.col("shingles") > shingle_limit) & (F.col("docs") > 2)))
        small.append(members.join(sized(large.select("node")), "node", "left_anti"))
        if large.isEmpty():
            break
        level += 1
        big = stored(members.join(sized(large), "node").join(sigs, "doc"))
        drawn = F.pmod(F.xxhash64("doc", "node"), F.ceil(F.col("docs") / DRAWN)) == 0
        common = big.filter(drawn).groupBy("node").agg(F.collect_list("sig").alias("sigs"))
        common = stored(common.select("node", _most_common("sigs").alias("common")))
        scored = big.join(sized(common), "node").withColumn("score", _agreeing("sig", "common"))
        facts = scored.groupBy("node").agg(F.avg("score").alias("alike"), F.max_by("doc", "score").alias("medoid"))
        facts = facts.withColumn("dense", (F.col("alike") >= DENSE * TOKENS) | F.lit(level >= DEEPEST))
        facts = sized(stored(facts.select("node", "medoid", "dense")))
        parts = F.ceil(F.greatest(F.col("docs") / min(PART, leaf), F.col("shingles") / shingle_limit)).cast("int").alias("parts")
        dense.append(big.join(facts.filter("dense"), "node").select("node", "doc", "n", "medoid", parts))
        others = big.join(facts.filter("dense").select("node"), "node", "left_anti")
        grown = others.select(F.explode(_children(level)("node", "tree", "sig")).alias("node"), "tree", "doc", "n")
        met = stored(grown)
        shared = stored(
            met.groupBy("node").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).filter("a < b").select("node")
        )
        members = stored(met.join(sized(shared), "node", "left_semi"))
    every = small[0]
    for more in small[1:]:
        every = every.unionByName(more)
    alike = None
    for more in dense:
        alike = more if alike is None else alike.unionByName(more)
    return every.join(sigs, "doc").select("node", "doc", "n", "sig"), None if alike is None else stored(alike)


def set_links(docs: DataFrame, rows: DataFrame, trees: int, leaf: int, shingle_limit: int) -> DataFrame:
    """``(a, b)``: links that connect just the documents that pairs above the threshold connect."""
    small, dense = _branched(rows, trees, leaf, shingle_limit)
    groups = stored(
        small.repartition("node")
        .sortWithinPartitions("node")
        .mapInPandas(_candidates, "part long, doc long")
        .distinct()
    )
    wanted = groups.select("doc")
    if dense is not None:
        wanted = wanted.unionByName(dense.select("doc"))
    sets = _sets_of(docs, rows, stored(wanted.distinct()))
    plain = groups.select("part", F.lit(0).cast("long").alias("node"), "doc", F.lit(ACTIVE).alias("kind"))
    found = _confirmed(plain, sets).select("a", "b")
    if dense is None:
        return found
    own = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    laid = dense.withColumn("own", own)
    medoids = laid.select("node", "medoid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own")).distinct()
    part = F.xxhash64("node", "own").alias("part")
    near = laid.filter("doc <> medoid").select(part, "node", "doc", F.lit(ACTIVE).alias("kind")).unionByName(
        medoids.select(part, "node", F.col("medoid").alias("doc"), F.lit(JOINED).alias("kind"))
    )
    near_links = stored(_confirmed(near, sets))
    joined = near_links.select("node", F.col("a").alias("medoid"), F.col("b").alias("doc"), F.lit(True).alias("is_joined"))
    told = stored(
        laid.join(joined, ["node", "medoid", "doc"], "left").withColumn(
            "is_joined", F.coalesce("is_joined", F.col("doc") == F.col("medoid"))
        )
    )
    # what is left over meets everything of its node, part by part
    left = told.filter("NOT is_joined")
    counts = left.groupBy("node").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    rounds = F.ceil(F.greatest(F.col("docs") / min(PART, leaf), F.col("shingles") / shingle_limit)).cast("int").alias("rounds")
    counts = sized(stored(counts.select("node", rounds)))
    block = F.xxhash64("node", "own", "round").alias("part")
    active = (
        left.join(counts, "node")
        .withColumn("round", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("rounds")).cast("int"))
        .select("node", "round", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("own"), "doc")
        .select(block, "node", "doc", F.lit(ACTIVE).alias("kind"))
    )
    passive = (
        told.join(counts, "node")
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)))
        .select(block, "node", "doc", F.when(F.col("is_joined"), JOINED).otherwise(PASSIVE).alias("kind"))
    )
    rest = _confirmed(active.unionByName(passive), sets)
    return found.unionByName(near_links.select("a", "b")).unionByName(rest.select("a", "b"))


def near_duplicates(
    docs: DataFrame, recall: float = RECALL, leaf: int = LEAF, shingle_limit: int = LEAF_SHINGLES
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Rows of null, empty or blank texts are linked with nothing: their component is their own
    id. Rows with equal sets are of one component. Null ids count for no component; a
    component of null ids alone is null, and its rows are kept. Repeated rows each get
    theirs. Other columns are not read. Sets are known by 64-bit hashes.
    """
    trees = trees_for(recall)
    rows = signed(docs, trees)
    links = stored(set_links(docs, rows, trees, leaf, shingle_limit).distinct())
    roots = components(links).withColumnRenamed("node", "doc")
    per_doc = rows.filter("doc IS NOT NULL").groupBy("doc").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("copies")
    )
    # only rows that share a set or a link have another component than their own id
    classes = per_doc.join(roots, "doc", "left").filter("copies > 1 OR root IS NOT NULL")
    classes = stored(classes.select("doc", "least", F.coalesce("root", "doc").alias("root")))
    least = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    of_doc = stored(classes.join(least, "root").select("doc", "class_id", F.lit(True).alias("known")))
    component = F.when(F.col("known"), F.col("class_id")).otherwise(F.col("doc_id"))
    return (
        rows.select("doc_id", "doc", F.col("n").alias("n_shingles"))
        .join(sized(of_doc), "doc", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
