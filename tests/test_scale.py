"""Work that must not be repeated: a record is walked once, rows to append are made once to decide."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearthline import schemas
from hearthline.functions.dates import iso_timestamp
from hearthline.operators import append, mapping, rules
from hearthline.plans.feeds import ACTIVE
from hearthline.sources import pages

AS_OF = "2024-06-30 12:00:00"


def items(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "body string").select(F.try_parse_json("body").alias("item"))


def walks(df) -> int:
    """How often the optimised plan reads ``item``."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("variant_get(item#")


@pytest.mark.parametrize(
    "made",
    [
        lambda i: rules.validate(i, rules.active_rules(2024)),
        lambda i: rules.validate(i, rules.sold_rules(2024)).filter("is_valid"),
        lambda i: mapping.map_active(i, AS_OF),
        lambda i: mapping.map_sold(i, AS_OF),
        lambda i: mapping.quick_map(i, AS_OF),
        lambda i: mapping.snake_records(i, schemas.ACTIVE, ACTIVE.required, AS_OF).filter("size(missing) = 0"),
    ],
)
def test_a_record_is_walked_once(spark, made):
    # not a local relation, which the optimiser would run
    stored = spark.range(3).select(F.try_parse_json(F.concat(F.lit('{"id":'), "id", F.lit("}"))).alias("item"))
    stored = stored.select(F.explode(F.array("item")).alias("item"))
    assert walks(made(stored)) == 1


def test_values_are_read_as_a_cast_reads_them(spark):
    values = ["1", "-0.5", "1.0", "5.9", "-5.9", "1e3", "1e400", "12345678901", "123456789012345678901", "true", '"7"', '" 8 "', '"x"',
              '""', "null", "[]", "[1]", "{}", '{"a":1}', "false", "0", "2147483648"]
    keys = ("id", "price", "rooms", "street", "createdDate")
    records = items(spark, *["{" + ",".join(f'"{k}":{v}' for k in keys) + "}" for v in values], "{}", "[]", "3", "null")
    got = mapping.map_active(records, AS_OF, "item").selectExpr(
        *[f"{c} <=> try_variant_get(item, '$.{c}', '{kind}') AS {c}" for c, kind in
          (("id", "bigint"), ("price", "int"), ("rooms", "double"), ("street", "string"))]
    )
    assert all(all(row) for row in got.collect())


def test_numbers_of_rules_are_read_as_a_cast_reads_them(spark):
    asked = [rules.Rule("a", m, bad) for m, bad in (("n", "{numeric}"), ("i", "{integral}"), ("t", "{truthy}"), ("h", "{number} > 0.5"))]
    told = {'1': "nith", '0': "ni", '0.5': "nt", '0.0': "n", '1e3': "nth", '"1"': "t", '""': "", "null": "", "[]": "", "{}": "",
            "true": "t", "false": "", "123456789012345678901": "nth"}
    checked = rules.validate(items(spark, *[f'{{"a":{v}}}' for v in told]), asked).select(
        F.expr("array_join(transform(errors, e -> e.message), '')").alias("m")
    )
    assert [r["m"] for r in checked.collect()] == list(told.values())


def test_offsets_and_odd_dates(spark):
    told = {
        "2024-05-01T10:00:00+02:00": datetime(2024, 5, 1, 8), "2024-05-01 23:30:00-02:30": datetime(2024, 5, 2, 2),
        "2024-05-01T10:00:00+24:00": None, "2024-05-01T10:00:00+02:60": None, "2024-02-30T10:00:00+02:00": None,
        "2024-05-01T24:00:00+02:00": None, "0000-05-01T10:00:00+02:00": None, "2024-05-01T10:00:00+02:00\n": datetime(2024, 5, 1, 8),
        "20240501": datetime(2024, 5, 1), "2024050": None, "2024,05,01,1,1,1,,+,0,0,0": None, "20240501Z": datetime(2024, 5, 1), "": None,
    }
    rows = spark.createDataFrame([(t,) for t in told], "t string").selectExpr("t", f"{iso_timestamp('t')} AS m")
    assert {r["t"]: r["m"] for r in rows.collect()} == told


def test_lists_under_either_key(spark):
    bodies = {
        1: '{"results":[{"id":1},null,3]}', 2: '{"searchResults":[{"id":2}]}', 3: '{"results":null,"searchResults":[{"id":3}]}',
        4: '{"results":{"id":4},"searchResults":[1]}', 5: '{"results":[]}', 6: "no", 7: "[1]",
    }
    made = spark.createDataFrame(list(bodies.items()), "n int, body string")
    got = sorted((r["n"], r["pos"], r["j"]) for r in pages.items(made, 0).select("n", "pos", F.to_json("item").alias("j")).collect())
    assert got == [(1, 0, '{"id":1}'), (1, 1, "null"), (1, 2, "3"), (2, 0, '{"id":2}')]


def test_rows_to_append_are_made_once_to_decide(spark):
    made = spark.sparkContext.accumulator(0)

    def through(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    filled = {"price": "100", "rooms": "1D", "size": "50", "city": "'c'", "zip_code": "2000", "street": "'s'", "version": "1"}
    now = "TIMESTAMP_NTZ '2024-06-30 12:00:00'"
    filled |= {"scraped_at": now, "updated_at": now}
    columns = [f"CAST({filled.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in ACTIVE.schema if f.name != "id"]
    rows = spark.range(40).selectExpr("id % 30 AS id", *columns, "id DIV 4 AS batch").select(*ACTIVE.columns, "batch")
    table = rows.select(*ACTIVE.columns).limit(0)
    told = append.bulk_append(table, rows.mapInPandas(through, rows.schema), ACTIVE).stats.first()
    assert (told["total"], told["inserted"], told["failed"]) == (40, 28, 12)
    assert made.value == 40


def test_snake_records_are_made_by_several_tasks(spark):
    """Rows of a table of one row group come from one task; the records are not made there."""
    from hearthline.bindings import loading

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    rows = spark.range(0, 400, 1, 1).selectExpr(
        "id", "CAST(id AS INT) AS price", "2.0D AS rooms", "CAST(60 AS INT) AS size", "'C' AS city", "8000 AS zip_code",
        "'S' AS street", "timestamp_ntz'1997-01-01 00:00:00' AS scraped_at", "1 AS o1", "id + 6 AS o2", "id AS o3",
    )
    spark.conf.set(key, "false")  # so few rows would be put together again
    try:
        made = loading.p3_records(lambda name: rows).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(key)
    assert len({r.task for r in made}) > 1
    assert sorted(r.id for r in made) == [k for k in range(400) if (k + 6) % 40 >= 6]
