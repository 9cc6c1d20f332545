"""What several operators share: reading documents, sized broadcasts, linked groups."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.sources.scratch import shared_folder

#: Rows of one Arrow batch: texts come in batches, so this bounds a Python worker's memory.
BATCH_ROWS = 1000

#: A table of at most so many narrow rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000

#: Where the tables are that ``stored`` wrote.
_FOLDERS: WeakKeyDictionary[DataFrame, object] = WeakKeyDictionary()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` if it is above."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, made of ``names``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count shows at most ``rows`` rows; else as it is.

    ``df`` should be cheap to count: a checkpoint or a small table.
    """
    return F.broadcast(df) if df.count() <= rows else df


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder as Parquet, and read from there.

    For tables that many steps read: smaller than a checkpoint, and only the columns a
    step needs are read. The files go when the session ends.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(folder)
    _FOLDERS[out] = path
    return out


def discarded(*tables: DataFrame) -> None:
    """Delete what :func:`stored` wrote of tables that no step reads any more; they can't be read after that."""
    for df in tables:
        path = _FOLDERS.pop(df)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are not used any more.

    Spark deletes them when the driver collects the plans, which a driver with memory to spare does late.
    """
    spark._jvm.System.gc()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of the groups that ``links(a, b)`` (long) connect; root: the smallest node.

    Alternates between pointing every larger neighbour of a node to the smallest
    one around it, and every node's smaller neighbours to the smallest of them,
    until every group is a star: the rounds grow with the logarithm of the longest path.
    Nodes without a link to another node are left out. Nulls link nothing.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        """(u, v) with the smallest of u and its neighbours."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    def are_stars(pairs: DataFrame) -> bool:
        """Whether every node points to one node at most, and none that is pointed to points on."""
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
            pairs.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in"))
        )
        seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
        return seen.filter("`out` > 1 OR (`out` = 1 AND `in` = 1)").isEmpty()

    pairs = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not are_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = smallest(large)
        pairs = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
