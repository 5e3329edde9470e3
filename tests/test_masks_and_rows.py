"""Checklists as masks, matches inside the row, constants of templates."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from campuslake.operators import matching, replay, timeline, visa
from campuslake.plans import inputs
from campuslake.plans import queries as plans
from campuslake.sources import catalogs as cat

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_masks_fold_toggles_in_any_order(spark):
    rng = random.Random(3)
    items = [*visa.ITEMS, "unknown", None]
    log = [(rng.randrange(4), rng.choice(items)) for _ in range(2000)] + [(None, visa.ITEMS[0])]
    df = spark.createDataFrame(log, "user_id long, item_id string")
    want: dict = {}
    for u, i in log:
        want.setdefault(u, set())
        if i in visa.ITEMS:
            want[u] ^= {i}
    got = {r.user_id: r.mask for r in replay.checklist_masks(df.repartition(5)).collect()}
    assert {u: {i for k, i in enumerate(visa.ITEMS) if m >> k & 1} for u, m in got.items()} == want
    rows = replay.replay_checklist(df).where(F.col("item_id").isin(visa.ITEMS))
    assert {r.user_id: r.mask for r in visa.checked_masks(rows).collect()} == {u: m for u, m in got.items() if m}
    text = spark.createDataFrame([(u, m) for u, m in got.items()], "user_id long, mask long").withColumn("json", visa.mask_json(F.col("mask")))
    read = visa.read_checked(text, "json").collect()
    assert all({k for k, v in r.checked.items() if v} == want[r.user_id] for r in read)


def test_progress_shuffles_toggles_and_requests_once(spark):
    df = visa.mask_progress(inputs.visa_requests(spark, SF), replay.checklist_masks(inputs.toggles(spark, SF)))
    df.collect()
    assert plan(df).split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(user_id") == plan(df).split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") <= 2
    rows = visa.visa_progress(inputs.visa_requests(spark, SF), replay.replay_checklist(inputs.toggles(spark, SF)))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, df.collect()))


def test_progress_without_state(spark):
    requests = spark.createDataFrame([(1, None, "us", "us-f1", "s"), (2, 7, "us", "us-f1", "s")], "request_id long, user_id long, country_id string, visa_id string, identity string")
    nobody = replay.checklist_masks(spark.createDataFrame([], "user_id long, item_id string"))
    assert {(r.request_id, r.total, r.done, r.percent) for r in visa.mask_progress(requests, nobody).collect()} == {(1, 17, 0, 0), (2, 17, 0, 0)}


def test_matches_stay_in_their_row(spark):
    rng = random.Random(6)
    rows = [(n, str(rng.randrange(-10, 420) / 100), rng.choice([b for b, _ in cat.BACKGROUNDS] + ["?", None]), rng.choice([None, [], ["US"], ["UK", "HK"], ["SG"], [None]]), rng.choice([None, [], ["h"] * 5])) for n in range(300)]
    df = spark.createDataFrame(rows, "applicant_id long, gpa_text string, school_bg string, countries array<string>, highlights array<string>")
    df.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/applicants")
    df = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/applicants")
    by_window = matching.rank_matches(matching.match_schools(df))
    ranks, short, counts = matching.school_ranks(df), matching.school_shortlist(df), matching.school_counts(df)
    rows_of = lambda d, *c: sorted(map(tuple, d.select(*c).collect()))
    key = ("applicant_id", "school_id", "match_level", "rn")
    assert rows_of(ranks, *key) == rows_of(by_window, *key) and ranks.count() > 500
    assert rows_of(short, *key, "is_locked") == rows_of(matching.shortlist(by_window), *key, "is_locked")
    assert rows_of(counts, "applicant_id", *matching.LEVELS) == rows_of(matching.match_summary(df, matching.match_schools(df)), "applicant_id", *matching.LEVELS)
    for out in (ranks, short, counts, matching.match_schools(df)):
        assert "Exchange" not in plan(out) and plan(out).count("FileScan") == 1


def test_first_locked_is_a_constant_of_the_template(spark):
    requests = inputs.timeline_requests(spark, SF)
    got = timeline.first_locked_of(requests)
    assert "Exchange" not in plan(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, timeline.first_locked(timeline.timeline_stages(requests)).collect()))


def test_stored_state_of_any_text(spark):
    texts = list(inputs.STORED) + [None]
    df = spark.createDataFrame([(t,) for t in texts], "json string").coalesce(1)
    got = [(len(r.checked), sum(r.checked.values())) for r in visa.read_checked(df, "json").collect()]
    assert got == [*inputs.STORED.values(), (0, 0)]
    assert plans.stored_state_read(spark, SF).count() > 0
