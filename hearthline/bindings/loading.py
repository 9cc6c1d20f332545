"""Sources, sinks and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.bindings import shapes
from hearthline.bindings.views import AS_OF, ORDER, YEAR, Views, bound, sql
from hearthline.functions.dates import iso_timestamp
from hearthline.functions.scalars import type_name
from hearthline.operators import append, mapping, merge, rules, stats
from hearthline.operators.history import version_history
from hearthline.operators.search import lookup, search_sold
from hearthline.plans import jobs
from hearthline.plans.feeds import ACTIVE, SOLD
from hearthline.plans.jobs import quick_load
from hearthline.sources import pages, store
from hearthline.sources.scratch import shared_folder
from hearthline.streaming import refresh


def _value(key: str, kind: str):
    return F.try_variant_get("item", f"$.{key}", kind)


def s1(view: Views) -> DataFrame:
    items = pages.active_items(shapes.listing_pages(view))
    fields = [f for f in mapping.ACTIVE_FIELDS if f[0] in ("id", "price", "size", "street")]
    return mapping.cleaned(items, fields, "home", *ORDER, "page", "pos")


S1_SQL = sql(
    """SELECT id AS home, scraped_at, o1, o2, o3, page, CAST(0 AS INT) AS pos, id, price, size, street FROM v_listing
       UNION ALL
       SELECT id, scraped_at, o1, o2, o3, page, CAST(1 AS INT), id, price + 1000, size, street FROM v_listing""",
    "v_listing",
)


def s2(view: Views) -> DataFrame:
    items = pages.sold_items(shapes.sale_pages(view))
    return items.select(
        "day", "page", "pos", _value("estateId", "bigint").alias("estate_id"), _value("address", "string").alias("address")
    )


def s3(view: Views) -> DataFrame:
    return pages.page_header(shapes.listing_pages(view))


def s4(view: Views) -> DataFrame:
    return pages.available_count(shapes.sale_pages(view))


def s5(view: Views) -> DataFrame:
    sample = pages.sample_pages(shapes.listing_pages(view), 20)
    return pages.active_items(sample).select("home", *ORDER, "page", "pos")


def _gaps(view: Views) -> DataFrame:
    steps = view("v_progress")
    headers = steps.groupBy("session_id").agg((F.max("current_page") + 1).alias("total_pages"))
    landed = steps.select("session_id", F.col("current_page").alias("page"))
    return pages.missing_pages(headers, landed, ["session_id"])


def s6_ranges(view: Views) -> DataFrame:
    """The same pages as ranges."""
    steps = view("v_progress")
    headers = steps.groupBy("session_id").agg((F.max("current_page") + 1).alias("total_pages"))
    landed = steps.select("session_id", F.col("current_page").alias("page"))
    return pages.missing_ranges(headers, landed, ["session_id"])


MISSING = {
    "expected": """SELECT session_id, unnest(range(CAST(0 AS BIGINT), CAST(max(current_page) + 1 AS BIGINT))) AS page
                   FROM v_progress GROUP BY session_id""",
    "missing": """SELECT e.session_id, e.page FROM expected e
                  WHERE NOT EXISTS (SELECT 1 FROM v_progress p
                                    WHERE p.session_id = e.session_id AND p.current_page = e.page)""",
}


def s7(view: Views) -> DataFrame:
    return pages.page_failures(_gaps(view), run=["session_id"])


def s10(view: Views) -> DataFrame:
    return lookup(shapes.active_table(view), "id", 42)


def s11(view: Views) -> DataFrame:
    return stats.row_count(view("v_held"))


def s13(view: Views) -> DataFrame:
    items = shapes.sparse_listing_items(view).withColumnRenamed("scraped_at", "_hit_time")
    return quick_load(items, shapes.active_table(view), ACTIVE, AS_OF, ("_hit_time", *ORDER[1:])).table


QUICK = {
    "early": shapes.tables_sql(ACTIVE)["early"],
    "first_fold": shapes.tables_sql(ACTIVE)["first_fold"],
    "old": shapes.tables_sql(ACTIVE)["old"],
    "quick": f"""SELECT id, price, rooms, size, CAST(NULL AS INT) AS lot_size, build_year,
                   CAST(NULL AS VARCHAR) AS energy_class, coalesce(city, 'Unknown') AS city, zip_code, street,
                   latitude, longitude, CAST(NULL AS INT) AS days_for_sale, CAST(NULL AS TIMESTAMP) AS created_date,
                   property_type, TIMESTAMP '{AS_OF}' AS scraped_at, TIMESTAMP '{AS_OF}' AS updated_at,
                   1 AS version, scraped_at AS hit_time, o1, o2, o3
                 FROM v_listing""",
    "quick_held": """SELECT * FROM quick WHERE price > 0 AND rooms >= 0 AND size > 0
                     AND zip_code BETWEEN 1000 AND 9999 AND build_year BETWEEN 1800 AND 2030
                     AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180""",
    "fresh": shapes.folded_sql("quick_held", ACTIVE, ("hit_time", "o1", "o2", "o3")),
}


def s14(view: Views) -> DataFrame:
    table = shapes.sold_table(view)
    place = store.Store(table.sparkSession, shared_folder(table.sparkSession))
    place.write_current(table, SOLD, 0)
    return place.read_current(SOLD)


def _small_batches(view: Views) -> store.Store:
    """All sales as the base, then two small batches of changed prices and one of removed sales beside it."""
    table = view("v_held_sold").select(*SOLD.columns)
    place = store.Store(table.sparkSession, shared_folder(table.sparkSession))
    place.write_current(table, SOLD, 0)
    for batch, (every, more) in enumerate(((97, 1), (89, 10)), 1):
        rows = view("v_held_sold").filter(F.col("estate_id") % every == 0).withColumn("price", F.col("price") + more)
        changed = merge.changes(place.read_current(SOLD), rows, SOLD, shapes.SOLD_ORDER, AS_OF)
        place.write_delta(changed, SOLD, batch)
        place.finish(SOLD, batch)
    gone = view("v_held_sold").filter(F.col("estate_id") % 101 == 0).select("estate_id")
    place.write_delta(merge.removals(place.read_current(SOLD), gone, SOLD), SOLD, 3)
    place.finish(SOLD, 3)
    return place


def s14_deltas(view: Views) -> DataFrame:
    return _small_batches(view).read_current(SOLD)


def s14_compacted(view: Views) -> DataFrame:
    place = _small_batches(view)
    place.compact(SOLD)
    return place.read_current(SOLD)


_CHANGED = [c for c in SOLD.columns if c not in ("price", "version", "updated_at")]
S14_DELTAS = sql(
    f"""SELECT {", ".join(_CHANGED)},
               CAST(price + CASE WHEN estate_id % 89 = 0 THEN 10 WHEN estate_id % 97 = 0 THEN 1 ELSE 0 END AS INT) AS price,
               CAST(1 + CASE WHEN estate_id % 97 = 0 THEN 1 ELSE 0 END + CASE WHEN estate_id % 89 = 0 THEN 1 ELSE 0 END AS INT) AS version,
               CASE WHEN estate_id % 97 = 0 OR estate_id % 89 = 0 THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at
        FROM v_held_sold WHERE estate_id % 101 <> 0""",
    "v_held_sold",
)


def q11_stored(view: Views) -> DataFrame:
    """A box read from the stored table by the curve over the map, changes beside the base included."""
    box = {"latitudeMin": 55.0, "latitudeMax": 55.5, "longitudeMin": 9.0, "longitudeMax": 11.0}
    return search_sold(_small_batches(view).read_current(SOLD, box=box), **box)


def s10_stored(view: Views) -> DataFrame:
    """Keys looked up in the stored table, through the bloom filters of its files."""
    place = _small_batches(view)
    table = place.read_current(SOLD)
    found = [lookup(table, "estate_id", key) for key in (1, 97, 101, 178, 4, 999_999_999)]
    return reduce(DataFrame.unionByName, found)


def _land(frame: DataFrame, folder: str) -> None:
    frame.select(F.col("body").alias("value")).write.mode("append").text(folder)


def _moment(batch: DataFrame, batch_id: int):
    from datetime import datetime

    return datetime.fromisoformat(AS_OF)


def s15(view: Views) -> DataFrame:
    """Page files read as a stream, each page's records landing in a table."""
    made = shapes.sale_pages(view)
    spark, folder = made.sparkSession, shared_folder(made.sparkSession)
    _land(made, f"{folder}/pages")
    items = pages.sold_items(pages.page_stream(spark, f"{folder}/pages", one_per_line=True))
    rows = mapping.map_sold(items, AS_OF)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


def r1(view: Views) -> DataFrame:
    made = shapes.sale_pages(view)
    spark, folder = made.sparkSession, shared_folder(made.sparkSession)
    _land(made, f"{folder}/pages")
    return _refreshed(spark, folder)


def _refreshed(spark, folder: str) -> DataFrame:
    place = store.Store(spark, f"{folder}/store")
    stream = pages.page_stream(spark, f"{folder}/pages", one_per_line=True)
    refresh.stream_upsert(stream, place, SOLD, f"{folder}/checkpoint", clock=_moment).awaitTermination()
    return place.read_current(SOLD)


def r2(view: Views) -> DataFrame:
    """Two drops with a restart between them; what is in both rises to version 2."""
    made = shapes.sale_pages(view)
    spark, folder = made.sparkSession, shared_folder(made.sparkSession)
    _land(made.filter(F.col("day") < F.lit("1998-01-01").cast("timestamp_ntz")), f"{folder}/pages")
    _refreshed(spark, folder)
    _land(made, f"{folder}/pages")
    return _refreshed(spark, folder)


def r2_sources(view: Views) -> DataFrame:
    """Two sources, each with its own checkpoint, into one store: no batch of either is lost."""
    made = shapes.sale_pages(view)
    spark, folder = made.sparkSession, shared_folder(made.sparkSession)
    place, early = store.Store(spark, f"{folder}/store"), F.col("day") < F.lit("1998-01-01").cast("timestamp_ntz")
    for name, part in (("early", made.filter(early)), ("late", made.filter(~early))):
        _land(part, f"{folder}/{name}")
        stream = pages.page_stream(spark, f"{folder}/{name}", one_per_line=True)
        refresh.stream_upsert(stream, place, SOLD, f"{folder}/c_{name}", clock=_moment).awaitTermination()
    return place.read_current(SOLD)


def n5_stored(view: Views) -> DataFrame:
    """Versions walked over the stored history of two drops."""
    made = shapes.sale_pages(view)
    spark, folder = made.sparkSession, shared_folder(made.sparkSession)
    _land(made.filter(F.col("day") < F.lit("1998-01-01").cast("timestamp_ntz")), f"{folder}/pages")
    _refreshed(spark, folder)
    _land(made, f"{folder}/pages")
    _refreshed(spark, folder)
    taken = store.Store(spark, f"{folder}/store").read_taken(SOLD)
    walked = version_history(taken, "estate_id", ["batch"])
    return walked.select("estate_id", "version_no", "price", "old_price", "change_percent")


def s10_sold(view: Views) -> DataFrame:
    return lookup(shapes.sold_table(view), "estate_id", 42)


def r4(view: Views) -> DataFrame:
    """Counts observed while the validated records are written."""
    from pyspark.sql import Observation

    seen = Observation("progress")
    checked = rules.validate(shapes.sale_items(view), rules.sold_rules(YEAR))
    watched = refresh.observed(checked, seen)
    folder = shared_folder(watched.sparkSession)
    watched.select("sale", "is_valid").write.parquet(f"{folder}/seen")
    row = seen.get
    return watched.sparkSession.createDataFrame(
        [(row["records_processed"], row["records_valid"], row["records_failed"])],
        "records_processed long, records_valid long, records_failed long",
    )


SALE_ROW = f"""estate_id, address, zip_code, price,
    CASE WHEN sale_type = '1-URGENT' OR sale_type = '5-LOW' THEN NULL
         ELSE CAST(CAST(day AS DATE) + INTERVAL 1 DAY AS DATE) END AS sold_date,
    property_type, sale_type, CAST(sqm_price AS DOUBLE) AS sqm_price, CAST(rooms AS DOUBLE) AS rooms, size, build_year,
    CAST(change_percent AS DOUBLE) AS change_percent, CAST(latitude AS DOUBLE) AS latitude,
    CAST(longitude AS DOUBLE) AS longitude, city,
    TIMESTAMP '{AS_OF}' AS scraped_at, TIMESTAMP '{AS_OF}' AS updated_at"""
SALE_VALID = f"""address IS NOT NULL AND price > 0 AND zip_code BETWEEN 1000 AND 9999 AND rooms >= 0 AND size > 0
    AND build_year BETWEEN 1800 AND {YEAR} AND (latitude IS NULL OR latitude BETWEEN -90 AND 90)
    AND longitude BETWEEN -180 AND 180 AND (sqm_price IS NULL OR sqm_price >= 0) AND sale_type <> '1-URGENT'"""
SALE_STORED = f"{SALE_VALID} AND sale_type <> '5-LOW'"


def p1(view: Views) -> DataFrame:
    return mapping.map_active(shapes.listing_items(view), AS_OF, F.col("scraped_at").alias("hit_time"), *ORDER[1:])


CREATED = """CASE o1 WHEN 1 THEN TIMESTAMP '2024-05-01 10:00:00' WHEN 4 THEN TIMESTAMP '2024-05-01 00:00:00'
             WHEN 6 THEN TIMESTAMP '2024-05-01 08:00:00' ELSE NULL END"""
P1_SQL = sql(
    f"""SELECT scraped_at AS hit_time, o1, o2, o3, id, price, rooms, size, lot_size, build_year, energy_class, city,
               zip_code, street, latitude, longitude, days_for_sale, {CREATED} AS created_date, property_type,
               TIMESTAMP '{AS_OF}' AS scraped_at, TIMESTAMP '{AS_OF}' AS updated_at, 1 AS version
        FROM v_listing""",
    "v_listing",
)


def p2(view: Views) -> DataFrame:
    return mapping.map_sold(shapes.sale_items(view), AS_OF)


def p3(view: Views) -> DataFrame:
    rows = view("v_sold").drop("updated_at", "version", "latitude").withColumnRenamed("change_percent", "change")
    return mapping.from_snake(rows, SOLD.schema, SOLD.required, AS_OF)


P3_SQL = sql(
    f"""SELECT estate_id, address, zip_code, price, sold_date, property_type, sale_type, sqm_price, rooms, size,
               build_year, change_percent, CAST(NULL AS DOUBLE) AS latitude, longitude, city, scraped_at,
               TIMESTAMP '{AS_OF}' AS updated_at, 1 AS version FROM v_sold""",
    "v_sold",
)


#: Written out: the keys a home for sale cannot do without, here each left out of some records.
LEFT_OUT = ("id", "price", "size", "city", "zip_code", "street")
#: A sighting as a record under table column names. Some lack one required key, and some hold a null under price.
_SNAKE = "concat('{\"rooms\":', rooms, " + ", ".join(
    f"CASE WHEN o2 % 40 = {k} THEN '' ELSE concat(',\"{c}\":', {value}) END"
    for k, (c, value) in enumerate(
        {
            "id": "id", "price": "coalesce(CAST(price AS STRING), 'null')", "size": "size", "city": "concat('\"', city, '\"')",
            "zip_code": "zip_code", "street": "concat('\"', street, '\"')",
        }.items()
    )
) + ", CASE WHEN o2 % 3 = 0 THEN ',\"version\":5,\"scraped_at\":\"2020-02-03T04:05:06\"' ELSE '' END, '}')"


def _snake_items(view: Views) -> DataFrame:
    """Records are dealt out before they are made: a table of one row group comes from a single task."""
    dealt = view("v_active").repartition("scraped_at", "o1", "o2", "o3", "id")
    return dealt.selectExpr("scraped_at AS hit_time", "o1", "o2", "o3", f"parse_json({_SNAKE}) AS item")


_HIT = ("hit_time", "o1", "o2", "o3")


def p3_failed(view: Views) -> DataFrame:
    """Records by the required keys they lack."""
    lost = mapping.lacking_records(_snake_items(view), ACTIVE.required).select(F.array_join("missing", ",").alias("missing"))
    return lost.groupBy("missing").agg(F.count(F.lit(1)).alias("failed_records"))


def p3_records(view: Views) -> DataFrame:
    """The complete records as rows."""
    given = mapping.snake_records(_snake_items(view), ACTIVE.schema, ACTIVE.required, AS_OF, *_HIT)
    return given.filter("size(missing) = 0").drop("missing")


def p3_stats(view: Views) -> DataFrame:
    """Records brought one by one over the table of the early sightings, failures counted."""
    return jobs.load_records(_snake_items(view), shapes.active_table(view), ACTIVE, AS_OF, _HIT).stats


_MISSING = "CASE o2 % 40 " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(LEFT_OUT)) + " ELSE '' END"
P3_ROWS = {
    "told": f"SELECT *, {_MISSING} AS missing FROM v_active",
    "snake": f"""SELECT id, price, rooms, size, CAST(NULL AS INT) AS lot_size, CAST(NULL AS INT) AS build_year,
                   CAST(NULL AS VARCHAR) AS energy_class, city, zip_code, street, CAST(NULL AS DOUBLE) AS latitude,
                   CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS INT) AS days_for_sale, CAST(NULL AS TIMESTAMP) AS created_date,
                   CAST(NULL AS INT) AS property_type,
                   CASE WHEN o2 % 3 = 0 THEN TIMESTAMP '2020-02-03 04:05:06' ELSE TIMESTAMP '{AS_OF}' END AS scraped_at,
                   TIMESTAMP '{AS_OF}' AS updated_at, CASE WHEN o2 % 3 = 0 THEN 5 ELSE 1 END AS version,
                   scraped_at AS hit_time, o1, o2, o3
                 FROM told WHERE missing = ''""",
    "held_snake": "SELECT * FROM snake WHERE price > 0 AND rooms >= 0 AND size > 0 AND zip_code BETWEEN 1000 AND 9999",
}


def p4(view: Views) -> DataFrame:
    return mapping.cleaned(shapes.listing_items(view), ACTIVE.fields, *ORDER)


P4_SQL = sql(
    f"""SELECT scraped_at, o1, o2, o3, id, price, rooms, size, lot_size AS "lotSize", build_year AS "buildYear",
               energy_class AS "energyClass", city, zip_code AS "zipCode", street, latitude, longitude,
               days_for_sale AS "daysForSale", {CREATED} AS "createdDate", property_type AS "propertyType"
        FROM v_listing""",
    "v_listing",
)


def p5(view: Views) -> DataFrame:
    return view("v_active").select("id", *ORDER, type_name(F.col("property_type")).alias("type_name"))


def f1(view: Views) -> DataFrame:
    """Every order date written in four ISO spellings and one that is none."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    spelt = F.array(
        F.struct(F.lit("date").alias("form"), day.alias("text")),
        F.struct(F.lit("basic").alias("form"), F.date_format("o_orderdate", "yyyyMMdd").alias("text")),
        F.struct(F.lit("zulu").alias("form"), F.concat(day, F.lit("T12:34:56.789Z")).alias("text")),
        F.struct(F.lit("offset").alias("form"), F.concat(day, F.lit("T01:00:00+02:00")).alias("text")),
        F.struct(F.lit("month").alias("form"), F.date_format("o_orderdate", "yyyy-MM").alias("text")),
    )
    rows = view("orders").select("o_orderkey", F.explode(spelt).alias("s"))
    return rows.select("o_orderkey", "s.form", F.expr(f"{iso_timestamp('s.text')} AS moment"))


F1_SQL = """
SELECT o_orderkey, form, CASE form
    WHEN 'date' THEN date_trunc('day', o_orderdate) WHEN 'basic' THEN date_trunc('day', o_orderdate)
    WHEN 'zulu' THEN date_trunc('day', o_orderdate) + INTERVAL '12 hours 34 minutes 56 seconds 789 milliseconds'
    WHEN 'offset' THEN date_trunc('day', o_orderdate) - INTERVAL '1 hour' ELSE NULL END AS moment
FROM orders CROSS JOIN (VALUES ('date'), ('basic'), ('zulu'), ('offset'), ('month')) AS forms(form)"""

LISTED = ("v_listing",)
BINDINGS = {
    "s1_active_items": (bound(s1), S1_SQL),
    "s2_sold_items": (
        bound(s2),
        sql("SELECT day, page, CAST(0 AS INT) AS pos, estate_id, address FROM v_sale", "v_sale"),
    ),
    "s3_page_header": (
        bound(s3),
        sql(
            """SELECT id AS home, scraped_at, o1, o2, o3, page, o2 AS total_count,
                      CAST(CASE WHEN o1 % 2 = 0 THEN 25 ELSE 50 END AS BIGINT) AS page_size,
                      CAST(ceil(o2 / CASE WHEN o1 % 2 = 0 THEN 25e0 ELSE 50e0 END) AS BIGINT) AS total_pages
               FROM v_listing""",
            *LISTED,
        ),
    ),
    "s4_available_count": (bound(s4), sql("SELECT coalesce(max(estate_id), 0) AS available FROM v_sale", "v_sale")),
    "s5_sample_pages": (
        bound(s5),
        sql(
            """SELECT id AS home, scraped_at, o1, o2, o3, page, CAST(pos AS INT) AS pos
               FROM v_listing CROSS JOIN (VALUES (0), (1)) AS positions(pos) WHERE page < least(20, 10)""",
            *LISTED,
        ),
    ),
    "s6_missing_pages": (bound(_gaps), sql("SELECT session_id, page FROM missing", "v_progress", **MISSING)),
    "s6_missing_ranges": (
        bound(s6_ranges),
        sql(
            """SELECT session_id, min(page) AS first_page, max(page) AS last_page, count(*) AS pages
               FROM (SELECT session_id, page, page - row_number() OVER (PARTITION BY session_id ORDER BY page) AS island
                     FROM (SELECT DISTINCT session_id, page FROM missing)) GROUP BY session_id, island""",
            "v_progress",
            **MISSING,
        ),
    ),
    "s7_page_failures": (
        bound(s7),
        sql(
            """SELECT session_id, count(*) AS pages_failed, count(*) * 50 AS records_failed,
                      count(*) AS api_calls_made FROM missing GROUP BY session_id""",
            "v_progress",
            **MISSING,
        ),
    ),
    "s10_lookup": (
        bound(s10),
        sql("SELECT * FROM old WHERE id = 42", "v_held", **shapes.tables_sql(ACTIVE)),
    ),
    "s11_row_count": (bound(s11), sql("SELECT count(*) AS row_count FROM v_held", "v_held")),
    "s12_dataset_size": (lambda spark, folder: store.dataset_size(spark, folder), None),
    "s13_quick_load": (
        bound(s13),
        sql(shapes.merged_sql("old", "fresh", ACTIVE, AS_OF), "v_held", "v_listing", **QUICK),
    ),
    "s14_deltas": (bound(s14_deltas), S14_DELTAS),
    "s14_compacted": (bound(s14_compacted), S14_DELTAS),
    "q11_stored_box": (
        bound(q11_stored),
        sql(
            "SELECT * FROM now WHERE latitude BETWEEN 55 AND 55.5 AND longitude BETWEEN 9 AND 11", now=S14_DELTAS,
        ),
    ),
    "s10_stored_lookup": (
        bound(s10_stored),
        sql("SELECT * FROM now WHERE estate_id IN (1, 97, 101, 178, 4, 999999999)", now=S14_DELTAS),
    ),
    "s14_write_current": (bound(s14), sql("SELECT * FROM old", "v_held_sold", **shapes.tables_sql(SOLD))),
    "s15_page_stream": (bound(s15), sql(f"SELECT {SALE_ROW}, 1 AS version FROM v_sale", "v_sale")),
    "r1_stream_upsert": (
        bound(r1),
        sql(f"SELECT {SALE_ROW}, 1 AS version FROM v_sale WHERE {SALE_STORED}", "v_sale"),
    ),
    "r2_resume": (
        bound(r2),
        sql(
            f"""SELECT {SALE_ROW}, CASE WHEN day < TIMESTAMP '1998-01-01' THEN 2 ELSE 1 END AS version
                FROM v_sale WHERE {SALE_STORED}""",
            "v_sale",
        ),
    ),
    "r2_two_sources": (
        bound(r2_sources),
        sql(f"SELECT {SALE_ROW}, 1 AS version FROM v_sale WHERE {SALE_STORED}", "v_sale"),
    ),
    "n5_over_history": (
        bound(n5_stored),
        sql(
            """SELECT estate_id, CAST(1 AS BIGINT) AS version_no, price, CAST(NULL AS INT) AS old_price,
                      CAST(NULL AS DOUBLE) AS change_percent FROM taken
               UNION ALL SELECT estate_id, 2, price, price, 0e0 FROM taken WHERE day < TIMESTAMP '1998-01-01'""",
            "v_sale",
            taken=f"SELECT estate_id, price, day FROM v_sale WHERE {SALE_STORED}",
        ),
    ),
    "s10_sold_lookup": (
        bound(s10_sold),
        sql("SELECT * FROM old WHERE estate_id = 42", "v_held_sold", **shapes.tables_sql(SOLD)),
    ),
    "r4_observe": (
        bound(r4),
        sql(
            f"""SELECT count(*) AS records_processed, count(*) FILTER ({SALE_VALID}) AS records_valid,
                       count(*) - count(*) FILTER ({SALE_VALID}) AS records_failed FROM v_sale""",
            "v_sale",
        ),
    ),
    "p1_map_active": (bound(p1), P1_SQL),
    "p2_map_sold": (bound(p2), sql(f"SELECT {SALE_ROW}, 1 AS version FROM v_sale", "v_sale")),
    "p3_from_snake": (bound(p3), P3_SQL),
    "p3_failed_records": (
        bound(p3_failed),
        sql("SELECT missing, count(*) AS failed_records FROM told WHERE missing <> '' GROUP BY missing", "v_active", **P3_ROWS),
    ),
    "p3_snake_records": (bound(p3_records), sql("SELECT * FROM snake", "v_active", **P3_ROWS)),
    "p3_load_stats": (
        bound(p3_stats),
        sql(
            """SELECT (SELECT count(*) FROM v_active) AS total, inserted, held - inserted AS updated,
                      (SELECT count(*) FROM v_active) - held AS failed
               FROM (SELECT count(*) AS held, count(DISTINCT s.id) FILTER (WHERE t.id IS NULL) AS inserted
                     FROM held_snake s LEFT JOIN old t ON t.id = s.id)""",
            "v_active",
            "v_held",
            **shapes.tables_sql(ACTIVE),
            **P3_ROWS,
        ),
    ),
    "p4_cleaned": (bound(p4), P4_SQL),
    "p5_type_name": (
        bound(p5),
        sql(
            """SELECT id, scraped_at, o1, o2, o3, CASE property_type WHEN 1 THEN 'house' WHEN 2 THEN 'apartment'
                      WHEN 3 THEN 'townhouse' WHEN 4 THEN 'villa' WHEN 99 THEN 'other' END AS type_name FROM v_active""",
            "v_active",
        ),
    ),
    "f1_iso_timestamp": (bound(f1), F1_SQL),
}
