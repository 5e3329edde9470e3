from __future__ import annotations

from pyspark.sql import functions as F

from campuslake.operators import events, replay
from campuslake.plans import inputs
from campuslake.plans import queries as plans
from campuslake.streaming import streams

SF = "/root/testdata/sf0.001"


def test_selection_and_checklist(spark):
    log = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, "c")], "user_id long, item_id string")
    assert {r.user_id: r.selected for r in replay.replay_selection(log).collect()} == {1: ["b"], 2: []}
    assert {tuple(r) for r in replay.replay_checklist(log).collect()} == {(1, "b")}


def courses(spark, *ops):
    log = spark.createDataFrame([(1, n, *o) for n, o in enumerate(ops)], "session_id long, seq long, op string, id string, field string, value string")
    return sorted(tuple(r)[1:] for r in replay.replay_courses(log).collect())


def test_courses(spark):
    add = lambda i: ("add", i, None, None)
    assert courses(spark, add("x"), ("update", "x", "credits", "3"), ("update", "y", "score", "9"), ("update", "x", "name", "math")) == [("blank-0", "", 0.0, 0.0), ("x", "math", 3.0, 0.0)]
    assert courses(spark, add("x"), ("remove", "x", None, None), ("remove", "blank-0", None, None)) == []
    assert courses(spark, add("x"), ("clear", None, None, None)) == [("blank-1", "", 0.0, 0.0)]
    filled = courses(spark, ("fill", None, None, None), ("update", "example-1", "score", "oops"))
    assert [(c, s) for _, _, c, s in filled] == [(4.0, 85.0), (3.0, 0.0), (3.0, 92.0)]


def test_courses_gather_no_session_in_one_task(spark):
    log = spark.createDataFrame([(None, 0, "fill", None, None, None), (1, 0, "add", "x", None, None)], "session_id long, seq long, op string, id string, field string, value string")
    out = replay.replay_courses(log)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.session_id or 0, r.course_id) for r in out.collect()) == [(0, "example-0"), (0, "example-1"), (0, "example-2"), (1, "blank-0"), (1, "x")]


def test_timeline_form(spark):
    rows = [("set", "country", "美国"), ("set", "grade", "3"), ("set", "round", "ED"), ("set", "level", "本科"), ("set", "major", "cs")]
    log = lambda r: spark.createDataFrame([(1, n, *x) for n, x in enumerate(r)], "session_id long, seq long, op string, field string, value string")
    got = replay.replay_timeline_form(log(rows)).first().asDict()
    assert (got["country"], got["level"], got["grade"], got["round"], got["major"], got["tier"]) == ("美国", "本科", "", "", "cs", "")
    assert set(replay.replay_timeline_form(log([*rows, ("reset", None, None)])).first()[1:]) == {""}


def test_envelope(spark):
    df = spark.createDataFrame([(1, None, 1, "copy_wechat_id", "x", 2.0), (2, None, 1, "click_cta_button", "x", 2.0)], "event_id long, ts timestamp, user_id long, name string, event_label string, value double")
    got = [r.envelope for r in events.event_envelope(df).collect()]
    assert [(e.event_category, e.value) for e in got] == [("Conversion", None), ("Engagement", 2.0)]


def test_streams_agree_with_batch(spark):
    live = {(r.user_id, r.item_id) for r in plans.stream_progress(spark, SF).where("checked").collect()}
    assert live == {tuple(r) for r in replay.replay_checklist(inputs.toggles(spark, SF)).collect()}
    counts = plans.stream_event_counts(spark, SF)
    last = inputs.interactions(spark, SF).agg(F.max("ts")).first()[0]
    batch = events.event_envelope(inputs.interactions(spark, SF)).select("ts", "envelope.*").groupBy(F.window("ts", "1 day"), "event_category", "event_label").count()
    closed = batch.where(F.col("window.end") <= F.lit(last) - F.expr("interval 1 hour"))
    key = lambda rows: sorted((str(r[0]), *r[1:]) for r in rows)
    assert key(counts.collect()) == key(closed.select("window.start", "event_category", "event_label", "count").collect())
    assert streams.latest(spark.createDataFrame([(1, True, 0), (1, False, 1)], "k long, v boolean, batch long"), ["k"]).first().v is False


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
