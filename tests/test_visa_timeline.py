from __future__ import annotations

from campuslake.operators import timeline, visa
from campuslake.sources import catalogs as cat

REQUEST = "request_id long, user_id long, country_id string, visa_id string, identity string"


def test_items(spark):
    items = visa.visa_items(spark).collect()
    count = {v: sum(r.visa_id == v for r in items) for v in ("us-f1", "us-j1", "uk-student", "au-500")}
    assert count == {"us-f1": 17, "us-j1": 7, "uk-student": 11, "au-500": 11}
    got = sorted((r.visa_id, r.section_no, r.item_no, r.item_id, r.required, r.needs_translation) for r in items)
    assert got == sorted((r[1], r[2], r[3], r[4], r[6], r[9]) for r in cat.flat_visa_rows())
    assert visa.visa_tips(spark).count() == 12 and visa.visa_summary(spark).count() == 4


def test_gate_and_progress(spark):
    every = [r[4] for r in cat.flat_visa_rows() if r[1] == "us-f1"]
    requests = spark.createDataFrame(
        [(1, 1, "us", "us-f1", "s"), (2, 2, "us", "us-f1", "s"), (3, 3, "us", "us-f1", "s"), (4, 1, "us", "us-j1", "s"), (5, 1, "us", "us-f1", ""), (6, 1, "us", None, "s"), (7, 1, "us", "us-x", "s")], REQUEST
    )
    checked = spark.createDataFrame([(2, every[0]), (2, "au-500-core-1")] + [(3, i) for i in every], "user_id long, item_id string")
    got = {r.request_id: (r.total, r.done, r.percent) for r in visa.visa_progress(requests, checked).collect()}
    assert got == {1: (17, 0, 0), 2: (17, 1, 6), 3: (17, 17, 100), 4: (7, 0, 0)}


def test_state_round_trip(spark):
    df = spark.createDataFrame([(1, "b", True), (1, "a", False), (2, "c", True)], "user_id long, item_id string, checked boolean")
    text = visa.write_checked(df)
    assert {r.user_id: r.json for r in text.collect()} == {1: '{"a":false,"b":true}', 2: '{"c":true}'}
    assert {r.user_id: r.checked for r in visa.read_checked(text, "json").collect()} == {1: {"a": False, "b": True}, 2: {"c": True}}
    assert visa.read_checked(spark.createDataFrame([("{oops",), (None,), ("",)], "json string"), "json").first().checked == {}


def test_timelines(spark):
    rows = [(1, "美国", "本科", "g", "m"), (2, "美国", "博士", "g", "m"), (3, "中国香港", "本科", "g", "m"), (4, "英国", "硕士", "g", "m"), (5, "美国", "本科", "", "m"), (6, "美国", "本科", "g", None), (7, "美国", "本科", " ", "m")]
    df = spark.createDataFrame(rows, "request_id long, country string, level string, grade string, major string")
    stages = timeline.timeline_stages(df)
    n = {r.request_id: r["count"] for r in stages.groupBy("request_id").count().collect()}
    assert n == {1: 7, 2: 4, 3: 3, 4: 7, 7: 7}
    assert {r.request_id: r.first_locked for r in timeline.first_locked(stages).collect()} == {1: 4, 2: 2, 3: 1, 4: 4, 7: 4}
    masked = timeline.mask_locked(stages).where("is_locked").collect()
    assert all(r[c] is None for r in masked for c in timeline.HIDDEN) and all(r.time_range for r in masked)
