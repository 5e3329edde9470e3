"""Streams of several batches: stopped, resumed, run again; late rows dropped and counted."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from campuslake.operators import replay, visa
from campuslake.streaming import state, streams

TOGGLES = "user_id long, item_id string, ts timestamp"


def deal(spark, folder, rows, schema, parts):
    """Append the rows in so many files."""
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], schema).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def test_checklists_survive_a_restart(spark, tmp_path):
    rng = random.Random(5)
    folder, at = str(tmp_path / "live"), dt.datetime(2024, 1, 1)
    rows = [(rng.randrange(9), rng.choice([*visa.ITEMS, "unknown"]), at) for _ in range(900)]
    deal(spark, folder, rows[:500], TOGGLES, 3)
    assert streams.run_checklists(streams.read_stream(spark, folder, "events", 1), folder, every=2) == 3
    assert streams.run_checklists(streams.read_stream(spark, folder, "events", 1), folder, every=2) == 0  # nothing new
    half = {r.user_id: r.mask for r in streams.checklists(spark, folder).collect()}
    df = lambda part: spark.createDataFrame(part, TOGGLES)
    assert half == {r.user_id: r.mask for r in replay.checklist_masks(df(rows[:500])).collect()}
    deal(spark, folder, rows[500:] + [(77, visa.ITEMS[3], at)], TOGGLES, 2)
    assert streams.run_checklists(streams.read_stream(spark, folder, "events", 1), folder, every=2) == 2
    got = {r.user_id: r for r in streams.checklists(spark, folder).collect()}
    assert {u: r.mask for u, r in got.items()} == {r.user_id: r.mask for r in replay.checklist_masks(df([*rows, (77, visa.ITEMS[3], at)])).collect()}
    on = {(r.user_id, r.item_id) for r in replay.replay_checklist(df(rows)).collect() if r.item_id != "unknown"} | {(77, visa.ITEMS[3])}
    read = visa.read_checked(streams.checklists(spark, folder), "json").collect()
    assert {(r.user_id, i) for r in read for i, v in r.checked.items() if v} == on
    assert all(r.n_checked == bin(r.mask).count("1") for r in got.values())


def test_upsert_is_idempotent_and_compacts(spark, tmp_path):
    folder, schema = str(tmp_path / "state"), "k long, v string"
    write, rows = state.upsert(folder), lambda *r: spark.createDataFrame(list(r), schema)
    now = lambda: {r.k: r.v for r in state.read_state(spark, folder, rows().schema, ["k"]).collect()}
    assert now() == {}
    for _ in range(2):  # a batch that runs again writes the same
        write(rows((1, "a"), (2, "b"), (None, "n")), 0)
    write(rows(), 1)
    for _ in range(2):
        write(rows((2, "c"), (3, None)), 2)
    want = {1: "a", 2: "c", 3: None, None: "n"}
    assert now() == want
    state.compact(spark, folder, rows().schema, ["k"])
    assert now() == want and state._children(spark, f"{folder}/changes") == [] and state._children(spark, f"{folder}/base") == [2]
    state.compact(spark, folder, rows().schema, ["k"])
    write(rows((3, "d")), 3)
    assert now() == want | {3: "d"}
    # a base that was not written whole is none
    rows((1, "broken")).write.parquet(f"{folder}/base/upto=9")
    import os

    os.remove(f"{folder}/base/upto=9/_SUCCESS")
    assert now() == want | {3: "d"}


EVENTS = "ts timestamp, event_category string, event_label string"


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    folder, day = str(tmp_path / "windows"), lambda d, h=12, m=0: dt.datetime(2024, 1, d, h, m)
    run = lambda rows: (deal(spark, folder, [(t, "c", "l") for t in rows], EVENTS, 1), streams.run_windows(streams.read_stream(spark, folder, "events"), folder))
    closed = lambda: {r.window_start.day: r.n for r in streams.closed_windows(spark, folder).collect()}
    run([day(1), day(1), day(2), day(2, 0, 30)])
    assert closed() == {1: 2}
    run([day(1), day(1, 23), day(2), day(3, 0, 59)])  # day 1 is closed: two are late; day 2 is not, as an hour has not passed
    assert closed() == {1: 2}
    run([day(2, 5), day(3, 1, 1)])
    assert closed() == {1: 2, 2: 4}
    run([day(2), day(1), day(9)])
    assert closed() == {1: 2, 2: 4, 3: 2}
    streams.run_windows(streams.read_stream(spark, folder, "events"), folder)  # nothing new
    found = [(r.run, r.n_rows, r.n_late) for r in streams.window_runs(spark, folder).orderBy("run").collect()]
    assert found == [(0, 4, 0), (1, 4, 2), (2, 2, 0), (3, 3, 2), (4, 0, 0)]
    total = streams.window_runs(spark, folder).agg(F.sum("n_rows") - F.sum("n_late")).first()[0]
    assert total == sum(closed().values()) + 1  # the last event's window is open
