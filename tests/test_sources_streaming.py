import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearthline.operators import history, ledger, rules
from hearthline.plans import jobs
from hearthline.plans.feeds import ACTIVE, SOLD
from hearthline.schemas import LEDGER_EVENT
from hearthline.sources import pages, store
from hearthline.streaming import refresh

AS_OF = datetime(2024, 6, 30, 12)


def sale(key, **changes):
    return {"estateId": key, "address": f"A {key}", "zipCode": 8000, "price": 100, "soldDate": "2024-05-01", "city": "C"} | changes


def page_text(items, number=1, name="results", **meta):
    return json.dumps({"meta": {"pageIndex": number, **meta}, name: items})


def land(folder, name, text):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text(text)


def test_envelopes(spark):
    bodies = [
        page_text([{"id": 1}, {"id": 2}, 5], 0, totalCount=101), page_text([{"id": 3}], 2, "searchResults", totalResults=7, pageSize=3),
        page_text([], 3), "junk", json.dumps({"results": {"id": 9}}), json.dumps({"results": None}), json.dumps({}),
    ]
    made = spark.createDataFrame([(b, i) for i, b in enumerate(bodies)], "body string, n int")
    found = pages.active_items(made).selectExpr("n", "page", "pos", "to_json(item) AS j").collect()
    assert sorted((r.n, r.page, r.pos, r.j) for r in found) == [
        (0, 0, 0, '{"id":1}'), (0, 0, 1, '{"id":2}'), (0, 0, 2, "5"), (1, 2, 0, '{"id":3}'),
    ]
    heads = {r.n: (r.total_count, r.page_size, r.total_pages) for r in pages.page_header(made).collect()}
    assert heads[0] == (101, 50, 3) and heads[1] == (7, 3, 3) and heads[3] == (0, 50, 0)
    assert pages.available_count(made).first().available == 101
    assert pages.available_count(made.limit(0)).first().available == 0
    assert {r.n for r in pages.sample_pages(made, 2).collect()} == {0, 3, 4, 5, 6}


@pytest.mark.parametrize("spread", [3, 10_000])
def test_missing_pages(spark, spread, monkeypatch):
    monkeypatch.setattr(pages, "_SPREAD", spread)
    heads = spark.createDataFrame([(1, 7), (1, 5), (2, 3), (3, 0)], "run int, total_pages long")
    landed = spark.createDataFrame([(1, 1), (1, 4), (2, 1), (2, 2), (2, 3)], "run int, page long")
    missing = pages.missing_pages(heads, landed, ["run"], base=1)
    assert sorted(map(tuple, missing.collect())) == [(1, 2), (1, 3), (1, 5), (1, 6), (1, 7)]
    lost = pages.page_failures(missing, 50, ["run"]).collect()
    assert [(r.run, r.pages_failed, r.records_failed, r.api_calls_made) for r in lost] == [(1, 5, 250, 5)]


@pytest.mark.parametrize("tuning", [{}, {"hot_rows": 2, "parts": 4}])
def test_missing_ranges(spark, tuning):
    heads = spark.createDataFrame([(1, 7), (1, 5), (2, 3), (3, 0), (4, 10**9)], "run int, total_pages long")
    landed = spark.createDataFrame([(1, 1), (1, 4), (1, 4), (1, 99), (2, 1), (2, 2), (2, 3), (4, 500), (9, 1)], "run int, page long")
    gaps = pages.missing_ranges(heads, landed, ["run"], base=1, **tuning)
    assert sorted(map(tuple, gaps.collect())) == [
        (1, 2, 3, 2), (1, 5, 7, 3), (4, 1, 499, 499), (4, 501, 10**9, 10**9 - 500),
    ]
    small = heads.filter("run < 4")
    numbers = gaps.filter("run < 4").selectExpr("run", "explode(sequence(first_page, last_page)) AS page")
    assert sorted(map(tuple, numbers.collect())) == sorted(map(tuple, pages.missing_pages(small, landed, ["run"], base=1).collect()))
    lost = {r.run: (r.pages_failed, r.records_failed) for r in pages.range_failures(gaps, 50, ["run"]).collect()}
    assert lost == {1: (5, 250), 4: (10**9 - 1, 50 * (10**9 - 1))}
    one = pages.missing_ranges(heads.filter("run = 1").drop("run"), landed.filter("run = 1").drop("run"), base=1)
    assert sorted(map(tuple, one.collect())) == [(2, 3, 2), (5, 7, 3)]


def test_snapshots_swap_whole(spark, tmp_path):
    place = store.Store(spark, str(tmp_path / "store"))
    assert place.read_current(SOLD).count() == 0
    rows = [(k, "A", 8000, 5, AS_OF.date(), None, None, None, None, None, None, None, None, None, "C", AS_OF, AS_OF, 1) for k in range(4)]
    table = spark.createDataFrame(rows, SOLD.schema)
    place.write_current(table, SOLD, 0)
    # The table is written anew from itself.
    place.write_current(place.read_current(SOLD).filter("estate_id > 0"), SOLD, 1)
    assert place.read_current(SOLD).count() == 3 and place.read_current(SOLD, before=1).count() == 4
    # A write that has not finished does not count.
    land(tmp_path / "store/current/sold/batch=000000000002", "part-0.parquet", "torn")
    assert place.read_current(SOLD).count() == 3 and place.batches("current", "sold") == [0, 1]
    place.drop_old(SOLD, keep=1)
    assert place.batches("current", "sold") == [1]
    size = store.dataset_size(spark, str(tmp_path / "store/current/sold/batch=000000000001")).first()
    assert size.file_count >= 1 and size.size_bytes > 0


def test_stream_of_two_drops_with_a_restart(spark, tmp_path):
    folder, place = str(tmp_path / "pages"), store.Store(spark, str(tmp_path / "store"))

    def run():
        stream = pages.page_stream(spark, folder)
        refresh.stream_upsert(stream, place, SOLD, str(tmp_path / "checkpoint")).awaitTermination()
        return {r.estate_id: r for r in place.read_current(SOLD).collect()}

    land(folder, "p1.json", page_text([sale(1), sale(2), sale(3, price=0)]))
    land(folder, "p2.json", page_text([sale(4, soldDate=""), sale(5)], 2))
    first = run()
    assert {k: r.version for k, r in first.items()} == {1: 1, 2: 1, 5: 1}
    land(folder, "p3.json", page_text([sale(2, price=70), sale(6), sale(6, price=60)], 3))
    second = run()
    assert {k: r.version for k, r in second.items()} == {1: 1, 2: 2, 5: 1, 6: 2}
    assert second[2].price == 70 and second[6].price == 60 and second[2].scraped_at == first[2].scraped_at
    assert run() == second

    runs = place.read_history("sold_runs", "sold").orderBy("batch").collect()
    assert [(r.processed, r.inserted, r.updated, r.failed) for r in runs] == [(5, 3, 0, 2), (3, 1, 2, 0)]
    # The table keeps the last state, the history every one.
    assert place.read_taken(SOLD).count() == 6 and place.read_refused(SOLD).count() == 2

    # The batch comes again after a crash: nothing rises twice.
    batch = pages.read_pages(spark, folder)
    run_id = refresh.run_of(spark, str(tmp_path / "checkpoint"))
    assert refresh.apply_batch(batch, 1, place, SOLD, AS_OF, run=run_id) is False
    assert {r.estate_id: r for r in place.read_current(SOLD).collect()} == second


def test_batch_cut_short_is_done_again(spark, tmp_path):
    place = store.Store(spark, str(tmp_path / "store"))
    land(tmp_path / "a", "p.json", page_text([sale(1)]))
    land(tmp_path / "b", "p.json", page_text([sale(1), sale(2)]))
    one, two = (pages.read_pages(spark, str(tmp_path / d)) for d in "ab")
    refresh.apply_batch(one, 0, place, SOLD, AS_OF)
    refresh.apply_batch(two, 1, place, SOLD, AS_OF)
    want = sorted(map(tuple, place.read_current(SOLD).collect()))
    # As if the crash had come after the history and before the table was complete.
    (Path(tmp_path) / "store/current/sold/batch=000000000001/_SUCCESS").unlink()
    assert refresh.apply_batch(two, 1, place, SOLD, AS_OF) is True
    assert sorted(map(tuple, place.read_current(SOLD).collect())) == want
    assert place.read_history("sold").count() == 3


def test_no_batch_is_lost(spark, tmp_path):
    """Neither behind a batch of another writer, nor from a second source or a renewed checkpoint."""
    place = store.Store(spark, str(tmp_path / "store"))
    rows = [(9, "A", 8000, 5, AS_OF.date(), None, None, None, None, None, None, None, None, None, "C", AS_OF, AS_OF, 1)]
    place.write_current(spark.createDataFrame(rows, SOLD.schema), SOLD, 17)

    def run(source, checkpoint):
        stream = pages.page_stream(spark, str(tmp_path / source))
        refresh.stream_upsert(stream, place, SOLD, str(tmp_path / checkpoint)).awaitTermination()
        return {r.estate_id: r.version for r in place.read_current(SOLD).collect()}

    land(tmp_path / "one", "p.json", page_text([sale(1)]))
    assert run("one", "c1") == {9: 1, 1: 1}
    land(tmp_path / "two", "p.json", page_text([sale(2)]))
    assert run("two", "c2") == {9: 1, 1: 1, 2: 1}
    assert run("one", "c3") == {9: 1, 1: 2, 2: 1}
    assert run("one", "c1") == run("two", "c2") == {9: 1, 1: 2, 2: 1}
    with pytest.raises(ValueError, match="would be lost"):
        place.write_current(place.read_current(SOLD), SOLD, 17)


def test_history_holds_what_the_table_took(spark, tmp_path):
    """A price below one is valid but cannot be stored; versions can be walked over it."""
    place = store.Store(spark, str(tmp_path / "store"))
    for n, price in enumerate((0.5, 100, 0.5, 120)):
        land(tmp_path / f"d{n}", "p.json", page_text([{"id": 1, "price": price, "rooms": 1, "size": 2, "city": "c", "zipCode": 2000,
                                                       "street": "s"}], 0))
        made = pages.read_pages(spark, str(tmp_path / f"d{n}"))
        refresh.apply_batch(made, n, place, ACTIVE, AS_OF)
    assert place.read_current(ACTIVE).first().version == 2
    taken = history.version_history(place.read_taken(ACTIVE), "id", ["batch"]).orderBy("version_no").collect()
    assert [(r.version_no, r.price, r.change_percent) for r in taken] == [(1, 100, None), (2, 120, 20.0)]
    assert place.read_refused(ACTIVE).count() == 2
    every = history.version_history(place.read_history("active"), "id", ["batch"]).orderBy("version_no").collect()
    assert [r.change_percent for r in every] == [None, None, -100.0, None]


def test_stream_equals_batch(spark, tmp_path):
    land(tmp_path / "pages", "p.json", page_text([{"id": k % 3, "price": 5 + k, "rooms": 1, "size": 2, "city": "c", "zipCode": 1000 + k,
                                                  "street": "s"} for k in range(9)], 0))
    place = store.Store(spark, str(tmp_path / "store"))
    stream = pages.page_stream(spark, str(tmp_path / "pages"))
    refresh.stream_upsert(stream, place, ACTIVE, str(tmp_path / "c"), clock=lambda b, n: AS_OF).awaitTermination()
    batch = pages.read_pages(spark, str(tmp_path / "pages"))
    loaded = jobs.ingest(batch, spark.createDataFrame([], ACTIVE.schema), ACTIVE, AS_OF)
    assert sorted(map(tuple, place.read_current(ACTIVE).collect())) == sorted(map(tuple, loaded.table.collect()))
    assert loaded.stats.first().asDict() == {"processed": 9, "inserted": 3, "updated": 6, "failed": 0}


def test_page_error_budget_in_a_job(spark, tmp_path):
    bad, good = sale(1, price=0), sale(2)
    land(tmp_path / "pages", "p.json", page_text([good, bad, bad, sale(3)]))
    made = pages.read_pages(spark, str(tmp_path / "pages"))
    nothing = spark.createDataFrame([], SOLD.schema)
    cut = jobs.ingest(made, nothing, SOLD, AS_OF, max_errors=2)
    assert [r.estate_id for r in cut.table.collect()] == [2]
    assert cut.stats.first().asDict() == {"processed": 4, "inserted": 1, "updated": 0, "failed": 2}
    free = jobs.ingest(made, nothing, SOLD, AS_OF, validate=False)
    assert sorted(r.estate_id for r in free.table.collect()) == [2, 3]
    recent = jobs.incremental(made, nothing, SOLD, AS_OF, days=7)
    assert recent.table.count() == 0 and jobs.incremental(made, nothing, SOLD, AS_OF, days=90).table.count() == 2


def test_live_counters_and_callback(spark, tmp_path):
    names = [f.name for f in LEDGER_EVENT]
    rows = [tuple({"session_id": 1, "scrape_type": "sold", "kind": "delta", "at": AS_OF, "seq": i, "current_page": i,
                   "records_processed": 2}.get(n) for n in names) for i in range(3)]
    spark.createDataFrame(rows, LEDGER_EVENT).write.parquet(str(tmp_path / "events"))
    events = spark.readStream.schema(LEDGER_EVENT).parquet(str(tmp_path / "events"))
    for name, live in (("counters", refresh.stream_counters(events)), ("live", refresh.stream_ledger(events))):
        query = live.writeStream.outputMode("update").format("memory").queryName(name).start()
        query.processAllAvailable()
        query.stop()
    assert spark.table("counters").first().records_processed == 6
    assert (spark.table("live").first().current_page, spark.table("live").first().status) == (2, "running")

    land(tmp_path / "pages", "p.json", page_text([sale(1), sale(2, price=0)]))
    calls = []
    listener = refresh.ProgressListener(lambda batch, counts: calls.append((batch, counts)))
    spark.streams.addListener(listener)
    try:
        watched = refresh.observed_items(pages.page_stream(spark, str(tmp_path / "pages")), SOLD, AS_OF)
        query = watched.select("is_valid").writeStream.format("memory").queryName("watched").start()
        query.processAllAvailable()
        query.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert (0, {"records_processed": 2, "records_valid": 1, "records_failed": 1}) in calls


def test_closed_sessions_leave_the_state(spark, tmp_path):
    """Update mode over files in the order of time, late events included, equals the fold of all events."""
    chance, events = random.Random(3), []
    for session in range(30):
        begun = AS_OF + timedelta(hours=session)
        steps = [("start", 0, {"total_pages": 9})] + [("delta", 1 + k, {"current_page": k, "records_processed": 2}) for k in range(chance.randint(0, 4))]
        if session % 3:
            steps.append(("end", 40, {"status": "completed"}))
            if session % 5 == 1:
                steps.append(("delta", 50, {"current_page": 7, "records_failed": 1}))  # after the end, but not by much
        for seq, (kind, minute, more) in enumerate(steps):
            row = {"session_id": session, "scrape_type": "sold", "kind": kind, "at": begun + timedelta(minutes=minute), "seq": seq, **more}
            events.append(tuple(row.get(f.name) for f in LEDGER_EVENT))
    events.sort(key=lambda e: e[3])
    for k in range(0, len(events), 20):
        made = spark.createDataFrame(events[k : k + 20], LEDGER_EVENT)
        made.coalesce(1).write.mode("append").parquet(str(tmp_path / f"landed/{k:04d}"))
    stream = spark.readStream.schema(LEDGER_EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "landed"))
    held = []

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(str(tmp_path / f"ledger/batch={number}"))

    query = refresh.live_ledger(stream, "2 hours").writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    got = refresh.newest_rows(spark.read.parquet(str(tmp_path / "ledger")))
    want = ledger.fold_ledger(spark.createDataFrame(events, LEDGER_EVENT))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # the last sessions may still wait for late events; of the others only the open ones are held
    assert held[-1] <= 10 + 3 and held[-1] < 30


def test_errors_counted_from_verdicts(spark):
    bodies = [json.dumps(sale(k, **c)) for k, c in enumerate(({}, {"price": 0}, {"price": None, "rooms": -1}, {"zipCode": "x", "soldDate": "2024-99-01"}, {"city": None}))]
    items = spark.createDataFrame([(b,) for b in bodies], "b string").select(F.parse_json("b").alias("item"))
    known = SOLD.rules_at(AS_OF)
    want = rules.errors_by_field(rules.validate(items, known)).collect()
    assert sorted(map(tuple, rules.count_errors(items, known).collect())) == sorted(map(tuple, want)) and len(want) == 6
    assert rules.count_errors(items.limit(0), known).collect() == []


def test_events_fold_without_frames(monkeypatch):
    """Events of a session are folded as lists: ties go to the later row, nulls count nothing."""
    def none(*args, **kwargs):
        raise AssertionError("a frame was made")

    at = pd.Timestamp("2024-05-01 10:00:00.000001")
    events = [
        ("sold", "delta", at, 2, None, 4, 2, None, "a", None, None), ("sold", "start", at, -1, 9, None, None, None, None, None, None),
        (None, "delta", at, 2, None, None, 3, 1, "b", None, None), ("sold", "end", at, 2**62, None, None, 0, 0, None, "failed", "x"),
        ("sold", "delta", at - pd.Timedelta(hours=1), 7, 8, 5, 1, 1, "c", None, None),
    ]
    names = ["scrape_type", "kind", "at", "seq", "total_pages", "current_page", "records_processed", "records_failed", "checkpoint_data", "status", "error_message"]
    frame = pd.DataFrame(events, columns=names).assign(records_inserted=0, records_updated=1, api_calls_made=None)
    state = dict.fromkeys(refresh._STATE_NAMES)
    for name in ("assign", "sort_values", "__getitem__"):
        kept = getattr(pd.DataFrame, name)
        monkeypatch.setattr(pd.DataFrame, name, (lambda f, k, kept=kept: kept(f, k) if isinstance(k, str) else none()) if name == "__getitem__" else none)
    refresh._folded(state, frame)
    refresh._folded(state, frame.iloc[4:])
    micros = at.value // 1000
    assert state == {
        "scrape_type": "sold", "begun": micros, "first": micros - 3600 * 10**6, "records_processed": 7, "records_inserted": 0,
        "records_updated": 6, "records_failed": 3, "api_calls_made": 0, "delta_at": micros, "delta_seq": 2, "page": None,
        "checkpoint": "b", "pages_at": micros, "pages_seq": -1, "pages": 9, "end_at": micros, "end_seq": 2**62,
        "status": "failed", "error": "x", "updated": micros,
    }


def test_update_mode_takes_files_in_the_order_of_time(spark, tmp_path, monkeypatch):
    """Every event counts, though the files of the last third are written first by chance."""
    from hearthline.bindings import ledger as bindings
    from hearthline.bindings.views import opened

    chance = random.Random(4)
    begun = datetime(2024, 1, 1)
    rows = [
        (k, begun + timedelta(minutes=chance.randrange(80_000)), chance.randrange(9), chance.choice(["view", "purchase", "error", None]),
         chance.random() * 200, f'{{"k": {k}}}')
        for k in range(600)
    ]
    made = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    made.write.parquet(str(tmp_path / "events.parquet"))
    view = opened(spark, str(tmp_path))
    read, landed = [], refresh.live_ledger
    monkeypatch.setattr(refresh, "live_ledger", lambda stream, late: landed(read.append(1) or stream, late))
    got = bindings.r3_update(view)
    want = bindings.a8(view)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert len(read) == 3  # a third lands once the one before is taken
