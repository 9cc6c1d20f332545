"""Benchmark decontamination: SimHash of item-sized windows, DataFrame functions only.

A window of a document leaks an item if their weighted five-word shingles are at least
0.8 alike (weighted Jaccard over counted shingles, a shingle weighing its length). Such a
window shares more than four fifths of the item's weight, so any part of the item's
shingles that weighs more than a fifth holds a shared one. Of every item the shingles
with the rarest words are such a part; where their rarest word and then the shingle
itself occurs, item-sized windows are laid over the text. A window's SimHash is looked up
by multi-index Hamming blocks: 16 blocks of four bits find every fingerprint within
radius 15. The exact similarity decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.llm.common import fresh, sized, texts
from hearthline.sources.scratch import cut

WORDS = 5
LIKE = 0.8
RADIUS = 15
BLOCKS = 16
#: Words of one window at most: longer items are cut into several.
LONGEST = 200

#: Counters of 16 bits in a long, four to each; the test bit keeps sums clear of the sign.
_LANES = 16
_ONES = 0x0001000100010001
_TEST = 14


def words(text: str = "text") -> F.Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def shingles(of: str = "words") -> F.Column:
    """Every five words in a row; all words if there are fewer."""
    places = F.sequence(F.lit(1), F.greatest(F.size(of) - (WORDS - 1), F.lit(1)))
    return F.transform(places, lambda k: F.array_join(F.slice(of, k, WORDS), " "))


def simhash(of: str = "shingles") -> F.Column:
    """The majority bits of the shingles' xxhash64, for fewer than 2**14 shingles."""
    hashes = F.transform(of, lambda s: F.xxhash64(s))
    zero = F.struct(*(F.lit(0).cast("long").alias(f"b{k}") for k in range(_LANES)))

    def add(state: F.Column, h: F.Column) -> F.Column:
        ones = [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_ONES)) for k in range(_LANES)]
        return F.struct(*((state[f"b{k}"] + ones[k]).alias(f"b{k}") for k in range(_LANES)))

    def over_half(state: F.Column) -> F.Column:
        # raised so far that the test bit is set once a count passes half of all
        raise_by = (F.lit((1 << _TEST) - 1) - F.floor(F.size(of) / 2)) * F.lit(_ONES)
        value = F.lit(0).cast("long")
        for k in range(_LANES):
            passed = F.shiftrightunsigned(state[f"b{k}"] + raise_by, _TEST).bitwiseAND(F.lit(_ONES))
            value = value.bitwiseOR(F.shiftleft(passed, k))
        return value

    return F.aggregate(hashes, zero, add, over_half)


def block_keys(fp: str, size: str) -> F.Column:
    """One key per block of the fingerprint: its place, its bits and the window's size."""
    width = 64 // BLOCKS
    bits = [F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1)) for k in range(BLOCKS)]
    return F.array(*((F.col(size) * BLOCKS + k) * (1 << width) + b for k, b in enumerate(bits)))


def similarity(one: str, other: str) -> F.Column:
    """Weighted Jaccard of two counted lists of shingles; a shingle weighs its length."""

    def count(of: str, s: F.Column) -> F.Column:
        return F.size(F.filter(of, lambda x: x == s))

    def total(pick) -> F.Column:
        return F.aggregate(
            F.array_union(one, other),
            F.lit(0).cast("long"),
            lambda sum_, s: sum_ + F.length(s) * pick(count(one, s), count(other, s)),
        )

    return total(F.least) / total(F.greatest)


def patterns(benchmark: DataFrame) -> DataFrame:
    """``(key, words, size, shingles, fp, item_ids)``: the distinct windows the items are cut into."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(LONGEST))
    inside = F.transform(starts, lambda s: F.least(s, F.greatest(F.size("all") - LONGEST, F.lit(0))))
    cut_up = (
        benchmark.select("item_id", words().alias("all"))
        .filter(F.size("all") > 0)
        .select("item_id", F.explode(F.array_distinct(inside)).alias("from"), "all")
        .select("item_id", F.slice("all", F.col("from") + 1, LONGEST).alias("words"))
    )
    return (
        cut_up.groupBy("words")
        .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .select(F.xxhash64("words").alias("key"), "words", F.size("words").alias("size"), shingles().alias("shingles"), "item_ids")
        .withColumn("fp", simhash())
    )


def seeds(docs: DataFrame, pats: DataFrame) -> DataFrame:
    """``(word, at, key, size, shingle_at, shingle)``: per item the shingles with the rarest words.

    They weigh more than a fifth of the item together. ``at``: the place of the rarest word.
    """
    vocabulary = cut(pats.select(F.explode("words").alias("word")).distinct())
    seen = docs.select(F.explode(words()).alias("word")).join(sized(vocabulary), "word")
    rarity = seen.groupBy("word").agg(F.count("*").alias("n"))
    placed = pats.select("key", "size", F.posexplode("words").alias("at", "word"))
    rated = placed.join(rarity, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    last = F.greatest(F.col("size") - WORDS, F.lit(0))
    within = F.sequence(F.greatest(F.col("at") - (WORDS - 1), F.lit(0)), F.least("at", last))
    rarest = (
        rated.withColumn("shingle_at", F.explode(within))
        .groupBy("key", "size", "shingle_at")
        .agg(F.min(F.struct("n", "at", "word")).alias("rare"))
    )
    listed = pats.select("key", F.posexplode("shingles").alias("shingle_at", "shingle"))
    by_rarity = Window.partitionBy("key").orderBy("rare.n", "shingle_at")
    weight = F.length("shingle")
    before = F.coalesce(F.sum(weight).over(by_rarity.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    all_ = F.sum(weight).over(Window.partitionBy("key"))
    chosen = rarest.join(listed, ["key", "shingle_at"]).withColumn("before", before).withColumn("all", all_)
    return chosen.filter(F.col("before") <= (1 - LIKE) * F.col("all")).select(
        F.col("rare.word").alias("word"), F.col("rare.at").alias("at"), "key", "size", "shingle_at", "shingle"
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, h, item_id, similarity, start)``: windows that leak an item, the best of each.

    h: xxhash64 of the text, which tells rows with one doc_id apart. start: the window's
    first word. Windows lie up to a fifth of the item from where a shared shingle puts it.
    """
    rows = texts(docs).withColumn("h", F.xxhash64("text"))
    pats = cut(patterns(benchmark))
    chosen = cut(seeds(rows, pats))
    anchors = chosen.groupBy("word").agg(
        F.collect_list(F.struct("key", "size", "shingle_at", "shingle", "at")).alias("seeds")
    )
    hits = (
        rows.select("doc_id", "h", F.posexplode(words()).alias("place", "word"))
        .join(sized(cut(anchors)), "word")
        .select("doc_id", "h", "place", F.explode("seeds").alias("s"))
        .select("doc_id", "h", F.struct((F.col("place") - F.col("s.at")).alias("start"), "s.size", "s.shingle_at", "s.shingle").alias("hit"))
        .groupBy("doc_id", "h")
        .agg(F.collect_set("hit").alias("hits"))
        .select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"), "hits")
    )
    met = rows.join(hits, rows["doc_id"].eqNullSafe(hits["hit_id"]) & (rows["h"] == hits["hit_h"]))
    met = met.select("doc_id", "h", words().alias("words"), "hits")
    place = lambda x: x["start"] + x["shingle_at"]
    real = F.filter(
        "hits",
        lambda x: (place(x) >= 0)
        & (
            F.array_join(F.slice("words", F.greatest(place(x), F.lit(0)) + 1, F.least(x["size"], F.lit(WORDS))), " ")
            == x["shingle"]
        ),
    )

    def around(x: F.Column) -> F.Column:
        by = F.floor(x["size"] / 5).cast("int")
        room = F.greatest(F.size("words") - x["size"], F.lit(0))
        shifted = F.sequence(x["start"] - by, x["start"] + by)
        return F.transform(
            shifted, lambda s: F.struct(F.least(F.greatest(s, F.lit(0)), room).alias("start"), x["size"].alias("size"))
        )

    spans = F.array_distinct(F.flatten(F.transform(real, around)))
    windows = (
        met.select("doc_id", "h", "words", spans.alias("spans"))
        .select(
            "doc_id",
            "h",
            F.explode(
                F.transform(
                    "spans",
                    lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"), F.slice("words", x["start"] + 1, x["size"]).alias("words")),
                )
            ).alias("w"),
        )
        .select("doc_id", "h", "w.start", "w.size", F.col("w.words").alias("words"))
        .withColumn("shingles", shingles())
        .withColumn("fp", simhash())
        .drop("words")
    )
    by_block = windows.withColumn("block", F.explode(block_keys("fp", "size")))
    items = pats.select(
        "key", F.col("fp").alias("item_fp"), F.col("shingles").alias("item_shingles"), F.explode(block_keys("fp", "size")).alias("block")
    )
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # a pair is taken at the first block it agrees on, so each comes once
    agrees = F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("item_fp")), 0)
    width = 64 // BLOCKS
    first = F.coalesce(
        *(F.when(F.shiftrightunsigned(agrees, width * k).bitwiseAND(F.lit((1 << width) - 1)) == 0, F.lit(k)) for k in range(BLOCKS))
    )
    of_block = F.pmod(F.floor(F.col("block") / (1 << width)), F.lit(BLOCKS))
    pairs = by_block.join(sized(cut(items)), "block").filter((near <= RADIUS) & (of_block == first))
    verified = pairs.withColumn("similarity", similarity("shingles", "item_shingles")).filter(F.col("similarity") >= LIKE)
    best = verified.groupBy("doc_id", "h", "key").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "start")).alias("best")
    )
    named = best.join(pats.select("key", F.explode("item_ids").alias("item_id")), "key")
    return named.groupBy("doc_id", "h", "item_id").agg(F.min("best").alias("best")).select(
        "doc_id", "h", "item_id", F.round(-F.col("best.less"), 6).alias("similarity"), F.col("best.start").cast("long").alias("start")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, similarity, start)``: every item each document leaks, best window each.

    Null and empty texts and items without words leak nothing. Equal items leak alike; an
    item with a null id is not reported. Rows with one doc_id are taken together. Other
    columns are not read.
    """
    found = leaks(docs, benchmark).groupBy("doc_id", "item_id")
    best = found.agg(F.min(F.struct((-F.col("similarity")).alias("less"), "start")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.less")).alias("similarity"), F.col("best.start").alias("start"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns."""
    id_, hash_ = fresh(docs, "leak_id", "leak_hash")
    found = cut(leaks(docs, benchmark).select(F.col("doc_id").alias(id_), F.col("h").alias(hash_)).distinct())
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(hash_))
    return docs.join(sized(found), same, "left_anti")
