import json
from datetime import datetime, timedelta

import pytest

from hearthline.functions.scalars import read_checkpoint
from hearthline.operators import history, ledger
from hearthline.schemas import LEDGER, LEDGER_EVENT

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 2, "parts": 8}])
def test_dedup_keeps_all_of_the_highest_version(spark, tuning):
    rows = [(1, 1), (1, 2), (1, 2), (2, 1), (3, 5), (3, 4), (None, 1), (None, 2)] + [(9, v % 4) for v in range(40)]
    table = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rows)], "id int, version int, n int")
    done = history.dedup_latest(table, "id", **tuning)
    kept = sorted((r.id or -1, r.version) for r in done.table.collect())
    assert kept == sorted([(1, 2), (1, 2), (2, 1), (3, 5), (-1, 1), (-1, 2)] + [(9, 3)] * 10)
    stats = done.stats.first()
    assert stats.duplicates_removed == len(rows) - len(kept) and stats.duplicates_found == 4
    again = history.dedup_latest(done.table, "id", **tuning)
    assert again.table.count() == len(kept) and again.stats.first().duplicates_removed == 0


def test_versions_of_a_home(spark):
    hits = spark.createDataFrame(
        [(1, 100, T0), (1, 80, T0 + timedelta(1)), (1, 80, T0 + timedelta(2)), (2, 7, T0)],
        "id int, price int, scraped_at timestamp_ntz",
    )
    found = history.version_history(hits, "id", ["scraped_at"]).orderBy("id", "version_no").collect()
    assert [(r.id, r.version_no, r.old_price, r.change_percent) for r in found] == [
        (1, 1, None, None), (1, 2, 100, -20.0), (1, 3, 80, 0.0), (2, 1, None, None),
    ]
    assert [r.valid_to for r in found] == [T0 + timedelta(1), T0 + timedelta(2), None, None]
    moved = history.price_development(hits, "id", ["scraped_at"]).collect()
    assert [(r.id, r.last_price, r.previous_price, r.development) for r in moved] == [(1, 80, 80, "same")]


def test_snapshot_differences_and_twins(spark):
    schema = "id int, street string, zip_code int, size int"
    old = spark.createDataFrame([(1, "A", 1, None), (2, "B", 1, 1), (3, "C", 1, 1)], schema)
    new = spark.createDataFrame([(1, "A", 1, None), (2, "B", None, 1), (4, " a  Street", 1, 1), (5, "A street ", 1, 1)], schema)
    columns = ["street", "zip_code", "size"]
    diff = {r.id: r.change for r in history.refresh_diff(old, new, "id", columns).collect()}
    assert diff == {1: "same", 2: "changed", 3: "gone", 4: "new", 5: "new"}
    twins = history.cross_id_duplicates(new.union(new)).collect()
    assert [(r.street_norm, r.id_count, r.kept_id) for r in twins] == [("a street", 2, 4)]


def event(session, kind, minute, seq=0, **values):
    row = {f.name: None for f in LEDGER_EVENT} | {
        "session_id": session, "scrape_type": "active", "kind": kind, "at": T0 + timedelta(minutes=minute), "seq": seq,
    }
    return tuple((row | values)[f.name] for f in LEDGER_EVENT)


def delta(session, minute, page, counts, checkpoint=None, **values):
    names = ("records_processed", "records_inserted", "records_updated", "records_failed", "api_calls_made")
    return event(session, "delta", minute, current_page=page, checkpoint_data=checkpoint, **dict(zip(names, counts)), **values)


def test_ledger_of_two_runs(spark):
    events = [
        event(1, "start", 0, total_pages=5),
        delta(1, 1, 3, (100, 95, 5, 0, 0), json.dumps({"test": "checkpoint"})),
        event(1, "end", 2, status="completed"),
        event(2, "start", 10),
        *[delta(2, 10 + p, p, (50, 45, 3, 2, 1), json.dumps({"last_property_id": p * 1000})) for p in (1, 2, 3)],
        event(3, "start", 20),
        delta(3, 21, 1, (1, 1, 0, 0, 1), "{}"),
        delta(3, 22, 2, (1, 0, 0, 1, 1), None, total_pages=40),
        event(3, "end", 23, status="failed", error_message="Timeout"),
        event(4, "start", 30),
    ]
    folded = ledger.fold_ledger(spark.createDataFrame(events, LEDGER_EVENT))
    assert [f.name for f in folded.schema] == LEDGER.names
    assert [f.dataType for f in folded.schema] == [f.dataType for f in LEDGER]
    rows = {r.id: r for r in folded.collect()}
    assert (rows[1].status, rows[1].current_page, rows[1].total_pages, rows[1].records_inserted) == ("completed", 3, 5, 95)
    two = rows[2]
    assert (two.records_processed, two.records_inserted, two.records_updated, two.records_failed) == (150, 135, 9, 6)
    assert (two.api_calls_made, two.current_page, two.status, two.end_time) == (3, 3, "running", None)
    assert (rows[3].status, rows[3].error_message, rows[3].checkpoint_data, rows[3].total_pages) == ("failed", "Timeout", None, 40)
    assert (rows[4].current_page, rows[4].records_processed, rows[4].status) == (0, 0, "running")

    last = ledger.last_checkpoint(folded, "active")
    assert last.first().session_id == 4
    page = ledger.last_checkpoint(folded.filter("id < 4"), "active").select(
        read_checkpoint(last.checkpoint_data, "last_property_id", "int").alias("p")
    )
    assert page.first().p == 3000
    assert ledger.last_checkpoint(folded, "sold").count() == 0

    stats = ledger.run_stats(folded).collect()
    assert [(r.status, r.session_count, r.avg_duration_seconds) for r in stats] == [
        ("completed", 1, 120.0), ("failed", 1, 180.0), ("running", 2, 0.0),
    ]
    summary = {r.id: r for r in ledger.run_summary(folded).collect()}
    assert (summary[1].elapsed_minutes, summary[1].success_rate, summary[1].pages_per_minute) == (2.0, 1.0, 1.5)
    assert summary[1].remaining_minutes == pytest.approx(2 * 2 / 3) and summary[2].remaining_minutes is None

    left = ledger.expire_runs(folded, T0 + timedelta(days=30, minutes=15))
    assert {r.id for r in left.ledger.collect()} == {2, 3, 4} and left.removed.first().removed == 1


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 2, "parts": 16}])
def test_progress_step_by_step(spark, tuning):
    steps = spark.createDataFrame(
        [delta(s, 2 * p, p, (10, p, 0, 0, 1), total_pages=20) for s in (1, 2) for p in range(0, 15)], LEDGER_EVENT
    )
    rows = {(r.session_id, r.current_page): r for r in ledger.run_progress(steps, **tuning).collect()}
    assert rows[1, 14].total_records_processed == 150 and rows[2, 3].total_records_inserted == 6
    assert rows[1, 10].elapsed_seconds == 1200 and rows[1, 10].remaining_seconds == 1200
    assert rows[1, 0].remaining_seconds is None
    points = ledger.checkpoint_points(steps.filter("session_id = 1"))
    assert [r.current_page for r in points.collect()] == [10]
