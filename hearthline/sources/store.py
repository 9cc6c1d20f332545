"""Tables as Parquet: a base, small deltas beside it, and the history.

``<root>/current/<name>/batch=<n>`` makes the table after batch n. It holds either the
whole table or, in ``delta``, only the rows that batch n changed: what a batch writes is in
proportion to the batch, whatever the size of the table. ``base=<n>`` holds a compaction:
the places of the table that deltas up to n touched, written anew; the other places stay
where they are. A reader takes every place from the newest base that has it, without
the rows of later deltas (their keys are few, and are broadcast), and adds those.
Places are years of sale, or parts of the keys' hash; inside them rows follow a curve over
the map, with bloom filters on the key.

``<root>/history/<name>/batch=<n>`` holds the rows batch n brought. A batch counts once it
is marked complete, so the newest complete one is the table: a write never touches what
readers see, and a batch written twice is the same batch.

The store numbers its batches itself. A history batch is signed with the run and
the number that the run gave the batch, so a run that repeats a batch after a crash
is recognised, whatever other runs or writers have brought meanwhile. One writer at
a time may write a table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.places import curve, curve_ranges
from hearthline.functions.scalars import megabytes

if TYPE_CHECKING:
    from hearthline.plans.feeds import Feed

_DONE = "_SUCCESS"
_PLACES = "_places"
#: Parts of the keys' hash, for tables without a date of sale. Fixed: changing it needs a whole new snapshot.
HASH_PLACES = 32
#: Rows of deltas up to which their keys are broadcast to the base; streams compact well before.
BROADCAST_KEYS = 1_000_000
#: Rows of deltas from which a stream compacts.
COMPACT_AT = 500_000
_DELTA_FIELDS = "place int, was int, gone boolean, known boolean"


def _place(feed: Feed, of: str = "") -> Column:
    """The place of a row; ``of``: the struct that holds its columns."""
    if "sold_date" in feed.columns:
        return F.coalesce(F.year(F.col(f"{of}sold_date")), F.lit(0)).cast("int")
    return F.pmod(F.xxhash64(feed.key), F.lit(HASH_PLACES)).cast("int")


def _signature(run: str, number: int) -> str:
    """Name of an empty file that readers pass over."""
    return f"_run-{hashlib.sha256(run.encode()).hexdigest()[:32]}-{number}"


def dataset_size(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Bytes, MB and number of the files under ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    total = F.coalesce(F.sum("length"), F.lit(0).cast("long"))
    return files.agg(total.alias("size_bytes"), F.count(F.lit(1)).alias("file_count")).select(
        "size_bytes", megabytes(F.col("size_bytes")).alias("size_mb"), "file_count"
    )


def _on_curve(box: Mapping[str, float]) -> Column:
    """Whether a row's place on the curve is near the box; plain bounds that reach the scan."""
    names = ("latitudeMin", "latitudeMax", "longitudeMin", "longitudeMax")
    ranges = curve_ranges(*[box.get(n) for n in names])
    near = F.lit(False)
    for low, high in ranges:
        near = near | F.col("curve").between(low, high)
    return near


@dataclass(frozen=True)
class Store:
    """Current tables and histories under one folder of any Hadoop file system."""

    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, kind: str, name: str, child: str) -> dict[int, set[str]]:
        """The folders ``child=<n>`` by number, with the names of what they hold."""
        files, folder = self._files(), self._path(kind, name)
        if not files.exists(folder):
            return {}
        found = {}
        for status in files.listStatus(folder):
            path = status.getPath()
            if path.getName().startswith(f"{child}="):
                inside = {s.getPath().getName() for s in files.listStatus(path)}
                found[int(path.getName().removeprefix(f"{child}="))] = inside
        return dict(sorted(found.items()))

    def batches(self, kind: str, name: str) -> list[int]:
        """Numbers of the complete batches, ascending."""
        return [n for n, inside in self._numbers(kind, name, "batch").items() if _DONE in inside]

    def next_batch(self, feed: Feed) -> int:
        """The number after the newest complete snapshot."""
        return (self.batches("current", feed.name) or [-1])[-1] + 1

    def batch_of(self, feed: Feed, run: str, number: int) -> int | None:
        """The batch that a run's own batch ``number`` became, complete or not."""
        signed = self._path("history", feed.name, "batch=*", _signature(run, number))
        found = self._files().globStatus(signed) or []
        return max((int(f.getPath().getParent().getName().removeprefix("batch=")) for f in found), default=None)

    def sign(self, feed: Feed, batch: int, run: str, number: int) -> None:
        """Say which batch of which run a history batch holds."""
        self._files().create(self._path("history", feed.name, f"batch={batch:012d}", _signature(run, number)), True).close()

    def _folder(self, kind: str, name: str, batch: int) -> str:
        return f"{self.root}/{kind}/{name}/batch={batch:012d}"

    def _write_places(self, rows: DataFrame, feed: Feed, folder: str) -> None:
        """Rows with their ``place``: a folder per place, big places as several files."""
        along = curve(F.col("latitude"), F.col("longitude"))
        laid = rows.select(*feed.columns, along.alias("curve"), "place").hint("rebalance", "place")
        (
            laid.sortWithinPartitions("place", "curve")
            .write.partitionBy("place")
            .option(f"parquet.bloom.filter.enabled#{feed.key}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .mode("overwrite")
            .parquet(folder)
        )

    def _writable(self, feed: Feed, batch: int) -> None:
        if batch < self.next_batch(feed) - 1:
            raise ValueError(f"{feed.name} is at batch {self.next_batch(feed) - 1} already; {batch} would be lost")
        self._files().delete(self._path("current", feed.name, f"base={batch:012d}"), True)

    def write_current(self, table: DataFrame, feed: Feed, batch: int) -> None:
        """The whole table after ``batch``, by places.

        A batch below the newest complete one is refused, as no reader would ever see it.
        """
        self._writable(feed, batch)
        rows = table.select(*feed.columns).withColumn("place", _place(feed))
        self._write_places(rows, feed, self._folder("current", feed.name, batch))

    def write_delta(self, rows: DataFrame, feed: Feed, batch: int) -> DataFrame:
        """Only the rows that ``batch`` changes, one per key; given back as read from the files.

        ``rows`` has the columns of the table as they are from now on, and ``old``, a struct of
        what the table had under the key (NULL if nothing), for a key that goes also ``gone``.
        The batch counts from :meth:`finish` on.
        """
        self._writable(feed, batch)
        folder = self._folder("current", feed.name, batch)
        self._files().delete(self._path("current", feed.name, f"batch={batch:012d}"), True)
        gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in rows.columns else F.lit(False)
        known = F.col("old").isNotNull()
        made = rows.select(
            *feed.columns,
            _place(feed).alias("place"),
            F.when(known, _place(feed, "old.")).alias("was"),
            gone.alias("gone"),
            known.alias("known"),
        )
        made.write.parquet(f"{folder}/delta")
        return self.spark.read.schema(made.schema).parquet(f"{folder}/delta")

    def finish(self, feed: Feed, batch: int) -> None:
        """Mark a batch of a delta as complete."""
        self._files().create(self._path("current", feed.name, f"batch={batch:012d}", _DONE), True).close()

    def _bases(self, feed: Feed, upto: int) -> tuple[int, dict[int, list[int]]]:
        """The newest whole table up to a batch (-1: none), and the later compactions with their places."""
        batches = self._numbers("current", feed.name, "batch")
        whole = max((n for n, inside in batches.items() if n <= upto and _DONE in inside and "delta" not in inside), default=-1)
        compactions = {}
        for n, inside in self._numbers("current", feed.name, "base").items():
            if whole < n <= upto and _PLACES in inside:
                file = self._files().open(self._path("current", feed.name, f"base={n:012d}", _PLACES))
                compactions[n] = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
                file.close()
        return whole, compactions

    def _state(self, feed: Feed, before: int | None) -> tuple[int, list[int], int, dict[int, list[int]]] | None:
        """Newest batch, batches of open deltas, newest whole table and later compactions."""
        done = [b for b in self.batches("current", feed.name) if before is None or b < before]
        if not done:
            return None
        whole, compactions = self._bases(feed, done[-1])
        settled = max([whole, *compactions])
        return done[-1], [b for b in done if b > settled], whole, compactions

    def _read_base(self, feed: Feed, whole: int, compactions: Mapping[int, list[int]]) -> DataFrame:
        """Every place from the newest base that has it, with ``curve`` and ``place``."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema)
        schema = f"{columns}, curve long, place int"
        parts, newer = [], set()
        for n in sorted(compactions, reverse=True):
            mine = sorted(set(compactions[n]) - newer)
            newer |= set(compactions[n])
            if mine:
                read = self.spark.read.schema(schema).parquet(f"{self.root}/current/{feed.name}/base={n:012d}")
                parts.append(read.filter(F.col("place").isin(mine)))
        if whole >= 0:
            read = self.spark.read.schema(schema).parquet(self._folder("current", feed.name, whole))
            parts.append(read.filter(~F.col("place").isin(sorted(newer))) if newer else read)
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts)

    def _read_deltas(self, feed: Feed, batches: list[int]) -> DataFrame:
        """The newest row of every key that the deltas hold."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema)
        schema = f"{columns}, {_DELTA_FIELDS}"
        paths = [f"{self._folder('current', feed.name, b)}/delta" for b in batches]
        if not paths:
            return self.spark.createDataFrame([], schema)
        each = [self.spark.read.schema(schema).parquet(p).withColumn("nth", F.lit(k)) for k, p in enumerate(paths)]
        if len(each) == 1:
            return each[0].drop("nth")
        rows = reduce(DataFrame.unionByName, each)
        names = [f.name for f in rows.schema if f.name not in (feed.key, "nth")]
        newest = rows.groupBy(feed.key).agg(F.max_by(F.struct(*names), "nth").alias("newest"))
        return newest.select(feed.key, "newest.*")

    def _merged(self, feed: Feed, state: tuple, box: Mapping[str, float] | None = None) -> DataFrame:
        _, open_, whole, compactions = state
        base = self._read_base(feed, whole, compactions)
        if box is not None:
            base = base.filter(_on_curve(box))
        if not open_:
            return base.select(*feed.columns, "place")
        deltas = self._read_deltas(feed, open_)
        keys = deltas.select(feed.key)
        if self._delta_rows(feed, open_) <= BROADCAST_KEYS:
            keys = F.broadcast(keys)
        kept = base.join(keys, feed.key, "left_anti").select(*feed.columns, "place")
        return kept.unionByName(deltas.filter("NOT gone").select(*feed.columns, "place"))

    def _delta_rows(self, feed: Feed, batches: list[int]) -> int:
        """Rows of these deltas, as the footers of the files tell."""
        paths = [f"{self._folder('current', feed.name, b)}/delta" for b in batches]
        return self.spark.read.parquet(*paths).count() if paths else 0

    def open_rows(self, feed: Feed) -> int:
        """Rows of the deltas that no compaction holds yet."""
        state = self._state(feed, None)
        return self._delta_rows(feed, state[1]) if state else 0

    def read_current(
        self, feed: Feed, before: int | None = None, box: Mapping[str, float] | None = None
    ) -> DataFrame:
        """The newest complete table, or the newest before a batch; empty at first.

        The base is not shuffled for it. ``box``: bounds ``latitudeMin``, ``latitudeMax``,
        ``longitudeMin`` and ``longitudeMax``; only row groups near the box are then read, and
        some rows outside it with them: search the result with the same bounds.
        """
        state = self._state(feed, before)
        if state is None:
            return self.spark.createDataFrame([], feed.schema)
        return self._merged(feed, state, box).select(*[F.col(f.name).cast(f.dataType) for f in feed.schema])

    def compact(self, feed: Feed) -> bool:
        """Write the places anew that open deltas touch; False if there are none.

        A job of its own: the table stays as it is, and other places stay where they are.
        """
        state = self._state(feed, None)
        if state is None or not state[1]:
            return False
        newest, open_ = state[:2]
        deltas = self._read_deltas(feed, open_)
        # places are years or parts of a hash: a bounded list
        touched = deltas.select(F.explode(F.array("place", "was")).alias("place")).filter("place IS NOT NULL").distinct()
        places = sorted(r.place for r in touched.collect())
        # a delta tells where its key was before it, so what an earlier one of the same key tells counts too
        if len(open_) > 1:
            paths = [f"{self._folder('current', feed.name, b)}/delta" for b in open_]
            was = self.spark.read.parquet(*paths).select("was").filter("was IS NOT NULL").distinct()
            places = sorted({*places, *(r.was for r in was.collect())})
        folder = f"{self.root}/current/{feed.name}/base={newest:012d}"
        self._write_places(self._merged(feed, state).filter(F.col("place").isin(places)), feed, folder)
        path = self._path("current", feed.name, f"base={newest:012d}", _PLACES)
        out = self._files().create(path, True)
        out.write(json.dumps(places).encode())
        out.close()
        return True

    def append_history(self, rows: DataFrame, name: str, batch: int) -> DataFrame:
        """Write the rows of a batch and give them back as read from the files."""
        folder = self._folder("history", name, batch)
        rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def read_history(self, name: str, table: str | None = None) -> DataFrame:
        """Every row of the complete batches, with the ``batch`` that brought it.

        ``table``: whose batches count, ``name`` itself by default.
        """
        newest = (self.batches("current", table or name) or [-1])[-1]
        return self.spark.read.parquet(f"{self.root}/history/{name}").filter(F.col("batch") <= newest)

    def read_taken(self, feed: Feed) -> DataFrame:
        """The rows of the history that the table took."""
        return self.read_history(feed.name).filter("taken").drop("taken", "is_valid")

    def read_refused(self, feed: Feed) -> DataFrame:
        """The rows of the history that broke a rule or a constraint."""
        return self.read_history(feed.name).filter("NOT taken").drop("taken")

    def drop_old(self, feed: Feed, keep: int = 2) -> None:
        """Delete what none of the newest ``keep`` complete batches needs to be read."""
        done = self.batches("current", feed.name)
        batches, bases = set(), set()
        for n in done[-keep:]:
            _, open_, whole, compactions = self._state(feed, n + 1)
            batches |= {n, whole, *open_}
            bases |= set(compactions)
        for n in set(done) - batches:
            self._files().delete(self._path("current", feed.name, f"batch={n:012d}"), True)
        for n in set(self._numbers("current", feed.name, "base")) - bases:
            if n < done[-1]:
                self._files().delete(self._path("current", feed.name, f"base={n:012d}"), True)
