"""Page envelopes: ``{"meta": {...}, "results": [...]}``.

A pages frame has one row per page with its text in ``body``; further columns
(run id, file path) pass through every operator. Both spellings of the envelope
are read: ``results`` or ``searchResults``, ``totalCount`` or ``totalResults``.
Pages of homes for sale count from 0, pages of sales from 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.ordered import ordered

PAGE_SIZE = 50
SAMPLE_LIMIT = 10
_SPREAD = 10_000


def read_pages(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Page files under ``path``: a page per file, or a page per line."""
    text = spark.read.option("wholetext", not one_per_line).option("recursiveFileLookup", True).text(path)
    return _named(text)


def page_stream(
    spark: SparkSession, path: str, one_per_line: bool = False, max_files: int | None = None
) -> DataFrame:
    """The same as an unbounded stream: files are read once, as they arrive."""
    reader = (
        spark.readStream.format("text")
        .option("wholetext", not one_per_line)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _named(reader.load(path))


def _named(text: DataFrame) -> DataFrame:
    return text.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("page_path"),
        F.col("_metadata.file_modification_time").alias("page_time"),
    )


def _meta(field: str, kind: str) -> Column:
    return F.try_variant_get("_page", f"$.meta.{field}", kind)


def _parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_page``, a generated column: a text is parsed once, however often it is looked at."""
    return pages.select("*", F.explode(F.array(F.try_parse_json("body"))).alias("_page"))


def _page_number(base: int) -> Column:
    """``meta.pageIndex``; without one the page counts as the first."""
    return F.coalesce(_meta("pageIndex", "long"), F.lit(base).cast("long"))


def items(pages: DataFrame, base: int) -> DataFrame:
    """One row per record: ``page``, its position ``pos`` from 0 and ``item``.

    Pages that are not JSON, have no list or an empty one give no rows.
    """
    others = [c for c in pages.columns if c != "body"]
    # An envelope tells its list under one key; the other counts only if the first is absent.
    listed = F.coalesce(
        F.variant_get("_page", "$.results", "variant"), F.variant_get("_page", "$.searchResults", "variant")
    )
    numbered = _parsed(pages).select(*others, _page_number(base).alias("page"), listed.alias("_list"))
    # Elements are slices of the list; as an array<variant> each would be written anew.
    exploded = numbered.lateralJoin(pages.sparkSession.tvf.variant_explode(F.col("_list").outer()))
    listing = exploded.filter(F.col("key").isNull())  # only elements of a list have no key
    return listing.select(*others, "page", F.col("pos"), F.col("value").alias("item"))


def active_items(pages: DataFrame) -> DataFrame:
    """Records on pages of homes for sale (first page 0)."""
    return items(pages, 0)


def sold_items(pages: DataFrame) -> DataFrame:
    """Records on pages of sales (first page 1)."""
    return items(pages, 1)


def page_header(pages: DataFrame, base: int = 0, page_size: int = PAGE_SIZE) -> DataFrame:
    """``page``, ``total_count``, ``page_size`` and ``total_pages`` of each page.

    ``page_size`` stands in where the page does not tell its own.
    """
    others = [c for c in pages.columns if c != "body"]
    total = F.coalesce(_meta("totalCount", "long"), _meta("totalResults", "long"), F.lit(0).cast("long"))
    size = F.coalesce(_meta("pageSize", "long"), F.lit(page_size).cast("long"))
    return (
        _parsed(pages)
        .select(*others, _page_number(base).alias("page"), total.alias("total_count"), size.alias("page_size"))
        .withColumn("total_pages", F.ceil(F.try_divide("total_count", "page_size")).cast("long"))
    )


def available_count(pages: DataFrame) -> DataFrame:
    """The number of records the source says it has; 0 if no page says so."""
    return page_header(pages).agg(F.coalesce(F.max("total_count"), F.lit(0).cast("long")).alias("available"))


def sample_pages(pages: DataFrame, max_pages: int, base: int = 0) -> DataFrame:
    """The first ``max_pages`` pages, ten at most.

    Filters on the ``page`` column if the pages have one (a partition column
    then prunes files), else on the page's own number.
    """
    upto = base + min(max_pages, SAMPLE_LIMIT)
    if "page" in pages.columns:
        return pages.filter(F.col("page") < upto)
    return _parsed(pages).filter(_page_number(base) < upto).drop("_page")


def expected_pages(headers: DataFrame, run: Sequence[str], base: int) -> DataFrame:
    """Every page a run must read: one row per run and ``page``.

    Page numbers are made in chunks that are spread over the cluster first, so a
    run of a billion pages is neither one array nor one task.
    """
    chunks = headers.filter(F.col("total_pages") > 0).select(
        *run,
        "total_pages",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total_pages") - 1) / _SPREAD))).alias("_chunk"),
    )
    first = F.col("_chunk") * _SPREAD
    last = F.least(first + (_SPREAD - 1), F.col("total_pages") - 1)
    spread = chunks.repartition(*run, "_chunk")
    return spread.select(*run, F.explode(F.sequence(first, last)).alias("_at")).select(
        *run, (F.col("_at") + base).alias("page")
    )


def missing_pages(headers: DataFrame, landed: DataFrame, run: Sequence[str] = (), base: int = 0) -> DataFrame:
    """Pages still to read: expected from the headers, but not among ``landed``.

    ``headers`` has one or more rows per run with ``total_pages`` (the largest
    counts), ``landed`` the run columns and ``page``.
    """
    run = list(run)
    size = headers.groupBy(*run).agg(F.max("total_pages").cast("long").alias("total_pages"))
    return expected_pages(size, run, base).join(
        landed.select(*run, F.col("page").cast("long")), [*run, "page"], "left_anti"
    )


def missing_ranges(headers: DataFrame, landed: DataFrame, run: Sequence[str] = (), base: int = 0, **tuning) -> DataFrame:
    """The pages still to read as ranges: ``first_page``, ``last_page`` and ``pages`` per gap.

    As :func:`missing_pages`, but a gap is one row however long it is, and no page number is
    made that is not a border of one: a run costs its landed pages, not its pages.
    ``tuning``: for runs with very many landed pages, see :func:`ordered`.
    """
    told = list(run)
    run = told or ["_run"]
    if not told:  # one run without a name
        headers, landed = headers.withColumn("_run", F.lit(0)), landed.withColumn("_run", F.lit(0))
    size = headers.groupBy(*run).agg(F.max("total_pages").cast("long").alias("_total")).filter("_total > 0")
    last = F.lit(base - 1) + F.col("_total")
    borders = size.select(*run, F.lit(base - 1).cast("long").alias("page")).unionByName(
        size.select(*run, (last + 1).alias("page"))
    )
    pages = landed.select(*run, F.col("page").cast("long").alias("page")).distinct()
    inside = pages.join(size, run).filter((F.col("page") >= base) & (F.col("page") <= last)).select(*run, "page")
    walked = ordered(borders.unionByName(inside), run, ["page"], leads={"_next": "page"}, **tuning)
    return walked.filter(F.col("_next") > F.col("page") + 1).select(
        *told,
        (F.col("page") + 1).alias("first_page"),
        (F.col("_next") - 1).alias("last_page"),
        (F.col("_next") - F.col("page") - 1).alias("pages"),
    )


def range_failures(ranges: DataFrame, page_size: int = PAGE_SIZE, run: Sequence[str] = ()) -> DataFrame:
    """:func:`page_failures` from the ranges of :func:`missing_ranges`."""
    pages = F.sum("pages")
    return ranges.groupBy(*run).agg(
        pages.alias("pages_failed"), (pages * page_size).alias("records_failed"), pages.alias("api_calls_made")
    )


def page_failures(missing: DataFrame, page_size: int = PAGE_SIZE, run: Sequence[str] = ()) -> DataFrame:
    """A page given up on counts as one call and ``page_size`` failed records."""
    pages = F.count(F.lit(1))
    return missing.groupBy(*run).agg(
        pages.alias("pages_failed"),
        (pages * page_size).alias("records_failed"),
        pages.alias("api_calls_made"),
    )
