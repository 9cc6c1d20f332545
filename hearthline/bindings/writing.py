"""Upserts, updates, deletes and strict inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.bindings import loading, records, shapes
from hearthline.bindings.views import AS_OF, CUT, ORDER, YEAR, Views, bound, sql
from hearthline.operators import append, mapping, merge, rules
from hearthline.plans import jobs
from hearthline.plans.feeds import ACTIVE, SOLD

ACTIVE_SQL = shapes.tables_sql(ACTIVE)
SOLD_SQL = shapes.tables_sql(SOLD)
MERGED = shapes.merged_sql("old", "fresh", ACTIVE, AS_OF)


def _upserted(view: Views) -> merge.Written:
    return merge.upsert(shapes.active_table(view), shapes.after(view("v_active")), ACTIVE, ORDER, AS_OF)


def w1(view: Views) -> DataFrame:
    return _upserted(view).table


def w1_stats(view: Views) -> DataFrame:
    return _upserted(view).stats


def w1_sold(view: Views) -> DataFrame:
    """Every sale written again over the table of the early ones."""
    return merge.upsert(shapes.sold_table(view), view("v_sold"), SOLD, shapes.SOLD_ORDER, AS_OF).table


def _updates(view: Views) -> DataFrame:
    """The later sightings as replacements that bring their own version."""
    return shapes.after(view("v_active")).withColumn("version", (F.col("o1") + 10).cast("int"))


def w2(view: Views) -> DataFrame:
    return merge.update_existing(shapes.active_table(view), _updates(view), ACTIVE, ORDER).table


def w2_not_found(view: Views) -> DataFrame:
    return merge.update_existing(shapes.active_table(view), _updates(view), ACTIVE, ORDER).not_found


UPDATES = {
    **ACTIVE_SQL,
    "newest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY scraped_at DESC, o1 DESC, o2 DESC, o3 DESC)
                 AS rn FROM late) WHERE rn = 1""",
}
_SET = ", ".join(f"CASE WHEN b.id IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in (*ACTIVE.payload, "updated_at"))


def _gone(view: Views) -> DataFrame:
    """Homes seen as houses, known to the table or not."""
    return view("v_active").filter(F.col("property_type") == 1).select("id")


def w3(view: Views) -> DataFrame:
    return merge.delete_keys(shapes.active_table(view), _gone(view), "id").table


def w3_not_found(view: Views) -> DataFrame:
    return merge.delete_keys(shapes.active_table(view), _gone(view), "id").not_found


def w3_sold(view: Views) -> DataFrame:
    gone = view("v_sold").filter(F.col("property_type") == 1).select("estate_id")
    return merge.delete_keys(shapes.sold_table(view), gone, "estate_id").table


def _appended(view: Views) -> merge.Written:
    """Later sightings in batches of two: most batches contest a home."""
    rows = append.number_batches(shapes.after(view("v_active")), (*ORDER, "id"), 2)
    return append.bulk_append(shapes.active_table(view), rows, ACTIVE)


def s8(view: Views) -> DataFrame:
    return _appended(view).table


def s8_stats(view: Views) -> DataFrame:
    return _appended(view).stats


def _appended_sales(view: Views) -> merge.Written:
    """All sales in batches of ten by day onto the table of the early ones."""
    rows = append.number_batches(view("v_sold"), ("scraped_at", "estate_id"), 10)
    return append.bulk_append(shapes.sold_table(view), rows, SOLD)


def s8_sold(view: Views) -> DataFrame:
    return _appended_sales(view).table


def s8_sold_stats(view: Views) -> DataFrame:
    return _appended_sales(view).stats


def _batched(rows: str, table: str, key: str, held: str, order: str, size: int) -> dict[str, str]:
    """Batches settled round by round: those first on all their keys enter, who
    shares a key with them is out."""
    return {
        "numbered": f"""SELECT *, CAST(floor((row_number() OVER (ORDER BY {order}) - 1) / {size}) AS BIGINT) AS batch,
                               ({held}) AS held FROM {rows}""",
        "faulty": f"""SELECT DISTINCT batch FROM (
                        SELECT batch FROM numbered WHERE held IS NOT TRUE
                        UNION ALL SELECT batch FROM numbered n JOIN {table} t ON n.{key} = t.{key}
                        UNION ALL SELECT batch FROM numbered GROUP BY batch, {key} HAVING count(*) > 1)""",
        "pairs": f"SELECT DISTINCT batch, {key} AS k FROM numbered WHERE batch NOT IN (SELECT batch FROM faulty)",
    }


def _settled(head: dict[str, str], views: tuple[str, ...], last: str) -> str:
    text = sql("SELECT 1", *views, **head).removesuffix(" SELECT 1")
    rounds = """rounds(round, batch, state) AS (
        SELECT 0, batch, 'open' FROM (SELECT DISTINCT batch FROM pairs)
        UNION ALL
        SELECT r.round + 1, r.batch,
               CASE WHEN r.state <> 'open' THEN r.state WHEN w.batch IS NOT NULL THEN 'in'
                    WHEN o.batch IS NOT NULL THEN 'out' ELSE 'open' END
        FROM rounds r
        LEFT JOIN (SELECT p.batch FROM pairs p JOIN rounds a ON a.batch = p.batch AND a.state = 'open'
                   JOIN (SELECT p.k, min(p.batch) AS first FROM pairs p JOIN rounds b ON b.batch = p.batch AND b.state = 'open'
                         GROUP BY p.k) f ON f.k = p.k
                   GROUP BY p.batch HAVING bool_and(p.batch = f.first)) w ON w.batch = r.batch
        LEFT JOIN (SELECT DISTINCT p.batch FROM pairs p
                   JOIN (SELECT p.k, min(p.batch) AS first FROM pairs p JOIN rounds b ON b.batch = p.batch AND b.state = 'open'
                         GROUP BY p.k) f ON f.k = p.k
                   JOIN (SELECT p.batch FROM pairs p JOIN rounds a ON a.batch = p.batch AND a.state = 'open'
                         JOIN (SELECT p.k, min(p.batch) AS first FROM pairs p JOIN rounds b ON b.batch = p.batch AND b.state = 'open'
                               GROUP BY p.k) f ON f.k = p.k
                         GROUP BY p.batch HAVING bool_and(p.batch = f.first)) x ON x.batch = f.first
                   WHERE p.batch <> f.first) o ON o.batch = r.batch
        WHERE EXISTS (SELECT 1 FROM rounds z WHERE z.state = 'open'))"""
    return (
        text.replace("WITH ", "WITH RECURSIVE ", 1)
        + f", {rounds}, entered AS (SELECT batch FROM rounds WHERE state = 'in' AND round = (SELECT max(round) FROM rounds)) "
        + last
    )


_ACTIVE_COLUMNS = ", ".join(ACTIVE.columns)
_SOLD_COLUMNS = ", ".join(SOLD.columns)
_HELD = """price > 0 AND coalesce(rooms >= 0, true) AND coalesce(size > 0, true) AND zip_code BETWEEN 1000 AND 9999
    AND coalesce(build_year BETWEEN 1800 AND 2030, true)"""
LATER = {**ACTIVE_SQL, "later": f"SELECT * FROM v_active WHERE scraped_at >= TIMESTAMP '{CUT}'"}
CONTESTED = {**LATER, **_batched("later", "old", "id", _HELD, "scraped_at, o1, o2, o3, id", 2)}
SALES = {
    **SOLD_SQL,
    **_batched("v_sold", "old", "estate_id", f"{_HELD} AND coalesce(sqm_price >= 0, true)", "scraped_at, estate_id", 10),
}
_STATS = """SELECT count(*) FILTER (WHERE batch IN (SELECT batch FROM entered)) AS inserted,
    count(*) FILTER (WHERE batch NOT IN (SELECT batch FROM entered)) AS failed, count(*) AS total FROM numbered"""


def s9(view: Views) -> DataFrame:
    """The newest sighting put in under the next free id."""
    table = shapes.active_table(view)
    rows = view("v_held")
    newest = rows.agg(
        F.max_by(F.struct(*[c for c in ACTIVE.columns if c != "id"]), F.struct(*ORDER, "id")).alias("r"),
        (F.max("id") + 1).alias("id"),
    ).select("id", "r.*")
    return append.insert_one(table, newest, ACTIVE).table


def a7(view: Views) -> DataFrame:
    checked = rules.validate(shapes.listing_items(view), rules.active_rules(YEAR))
    rows = mapping.map_active(checked.filter("is_valid"), AS_OF, F.col("scraped_at").alias("hit_time"), *ORDER[1:])
    stats = merge.upsert(shapes.active_table(view), rows, ACTIVE, ("hit_time", *ORDER[1:]), AS_OF).stats
    return jobs.batch_stats(checked, stats)


PAGE_ORDER = ("day", "page", "pos")
LAST_DAY = "2001-12-31 12:00:00"


def e1(view: Views) -> DataFrame:
    """The pages of the sales, validated, mapped and upserted over the early ones."""
    pages = shapes.sale_pages(view)
    return jobs.ingest(pages, shapes.sold_table(view), SOLD, AS_OF, order=PAGE_ORDER).table


def e2(view: Views) -> DataFrame:
    """The same for the last thousand days only, into an empty table."""
    pages = shapes.sale_pages(view)
    return jobs.incremental(pages, shapes.empty(view, SOLD), SOLD, LAST_DAY, days=1000, order=PAGE_ORDER).table


BINDINGS = {
    "w1_upsert": (bound(w1), sql(MERGED, "v_held", **ACTIVE_SQL)),
    "w1_upsert_stats": (
        bound(w1_stats),
        sql(
            f"""SELECT total, inserted, valid - inserted AS updated, total - valid AS failed FROM (
                 SELECT (SELECT count(*) FROM v_active WHERE scraped_at >= TIMESTAMP '{CUT}') AS total,
                        (SELECT count(*) FROM late) AS valid,
                        (SELECT count(*) FROM fresh g LEFT JOIN old t ON t.id = g.id WHERE t.id IS NULL) AS inserted)""",
            "v_active",
            "v_held",
            **ACTIVE_SQL,
        ),
    ),
    "w1_upsert_sold": (
        bound(w1_sold),
        sql(
            shapes.merged_sql("old", "every_sale", SOLD, AS_OF),
            "v_held_sold",
            **SOLD_SQL,
            every_sale=shapes.folded_sql("v_held_sold", SOLD, shapes.SOLD_ORDER),
        ),
    ),
    "w2_update_existing": (
        bound(w2),
        sql(
            f"""SELECT a.id, {_SET}, a.scraped_at,
                       CAST(CASE WHEN b.id IS NULL THEN a.version ELSE b.o1 + 10 END AS INT) AS version
                FROM old a LEFT JOIN newest b ON a.id = b.id""",
            "v_held",
            **UPDATES,
        ),
    ),
    "w2_not_found": (
        bound(w2_not_found),
        sql(
            f"""SELECT DISTINCT id FROM v_active WHERE scraped_at >= TIMESTAMP '{CUT}'
                AND id NOT IN (SELECT id FROM old)""",
            "v_active",
            "v_held",
            **ACTIVE_SQL,
        ),
    ),
    "w3_delete_keys": (
        bound(w3),
        sql(
            "SELECT * FROM old WHERE id NOT IN (SELECT id FROM v_active WHERE property_type = 1)",
            "v_active",
            "v_held",
            **ACTIVE_SQL,
        ),
    ),
    "w3_delete_sold": (
        bound(w3_sold),
        sql(
            "SELECT * FROM old WHERE estate_id NOT IN (SELECT estate_id FROM v_sold WHERE property_type = 1)",
            "v_sold",
            "v_held_sold",
            **shapes.tables_sql(SOLD),
        ),
    ),
    "w3_not_found": (
        bound(w3_not_found),
        sql(
            "SELECT DISTINCT id FROM v_active WHERE property_type = 1 AND id NOT IN (SELECT id FROM old)",
            "v_active",
            "v_held",
            **ACTIVE_SQL,
        ),
    ),
    "s8_bulk_append": (
        bound(s8),
        _settled(
            CONTESTED,
            ("v_active", "v_held"),
            f"SELECT {_ACTIVE_COLUMNS} FROM old UNION ALL "
            f"SELECT {_ACTIVE_COLUMNS} FROM numbered WHERE batch IN (SELECT batch FROM entered)",
        ),
    ),
    "s8_bulk_append_stats": (bound(s8_stats), _settled(CONTESTED, ("v_active", "v_held"), _STATS)),
    "s8_bulk_append_sold": (
        bound(s8_sold),
        _settled(
            SALES,
            ("v_held_sold",),
            f"SELECT {_SOLD_COLUMNS} FROM old UNION ALL "
            f"SELECT {_SOLD_COLUMNS} FROM numbered WHERE batch IN (SELECT batch FROM entered)",
        ),
    ),
    "s8_bulk_append_sold_stats": (bound(s8_sold_stats), _settled(SALES, ("v_held_sold",), _STATS)),
    "s9_insert_one": (
        bound(s9),
        sql(
            f"""SELECT * FROM old UNION ALL
                SELECT (SELECT max(id) + 1 FROM v_held) AS id, {", ".join(c for c in ACTIVE.columns if c != "id")}
                FROM (SELECT *, row_number() OVER (ORDER BY scraped_at DESC, o1 DESC, o2 DESC, o3 DESC, id DESC) AS rn FROM v_held)
                WHERE rn = 1""",
            "v_held",
            **ACTIVE_SQL,
        ),
    ),
    "a7_batch_stats": (
        bound(a7),
        sql(
            f"""SELECT (SELECT count(*) FROM counted) AS processed, inserted, valid - inserted AS updated,
                       (SELECT count(*) FROM counted) - valid AS failed
                FROM (SELECT count(*) AS valid,
                             count(DISTINCT c.id) FILTER (WHERE t.id IS NULL) AS inserted
                      FROM counted c LEFT JOIN old t ON t.id = c.id WHERE n_errors = 0)""",
            "v_held",
            "v_listing",
            **ACTIVE_SQL,
            **records.COUNTED,
        ),
    ),
    "e1_ingest": (
        bound(e1),
        sql(
            shapes.merged_sql("old", "landed", SOLD, AS_OF),
            "v_held_sold",
            "v_sale",
            **SOLD_SQL,
            stored=f"SELECT {loading.SALE_ROW}, 1 AS version FROM v_sale WHERE {loading.SALE_STORED}",
            landed=shapes.folded_sql("stored", SOLD, ("estate_id",)),
        ),
    ),
    "e2_incremental": (
        bound(e2),
        sql(
            f"""SELECT * FROM (SELECT {loading.SALE_ROW.replace(AS_OF, LAST_DAY)}, 1 AS version FROM v_sale
                               WHERE {loading.SALE_STORED} AND build_year <= 2001)
                WHERE sold_date BETWEEN DATE '2001-12-31' - INTERVAL 1000 DAY AND DATE '2001-12-31'""",
            "v_sale",
        ),
    ),
}
