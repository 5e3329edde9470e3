"""Facts against their schemas, scales chosen by row, users counted by bitmaps."""

from __future__ import annotations

import datetime as dt
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from campuslake.operators import events, gpa
from campuslake.sources import catalogs as cat
from campuslake.sources import facts
from campuslake.sources.scratch import shared_dir


def test_every_row_is_a_fact_or_a_reject(spark, tmp_path):
    rows = [("1", "a", 4, "85.5", ["x"]), ("x", "b", 3, "70", ["x"]), (None, "c", 2, "", None), ("3", None, None, "oops", ["x"]), ("9" * 30, "d", 1, None, None)]
    df = spark.createDataFrame(rows, "student_id string, course_id string, credits int, score string, name array<string>")
    df.write.parquet(f"{tmp_path}/raw.parquet")
    good, bad = facts.read_facts(spark, str(tmp_path), "transcripts", "raw")
    assert good.schema.simpleString() == "struct<student_id:bigint,course_id:string,name:string,credits:double,score:double>"
    assert [tuple(r) for r in good.collect()] == []  # a list is no name
    told = {json.loads(r.given).get("course_id"): r.reason for r in bad.collect()}
    assert told == {"a": "type: name", "b": "type: student_id; type: name", "c": "null: student_id; type: score", None: "null: course_id; type: name; type: score", "d": "type: student_id"}
    less = df.drop("name")
    assert [tuple(r) for r in facts.facts(less, "transcripts").collect()] == [(1, "a", None, 4.0, 85.5)]
    assert less.count() == facts.facts(less, "transcripts").count() + facts.rejects(less, "transcripts").count()


def test_absent_columns_and_lossy_numbers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.5, 6.0), (float("nan"), 7.0)], "student_id double, score double")
    assert {r.reason for r in facts.rejects(df, "transcripts").collect()} == {"absent: course_id", "type: student_id; absent: course_id"}
    assert facts.facts(df.withColumn("course_id", F.lit("c")), "transcripts").select("student_id").collect() == [(1,)]
    empty = spark.createDataFrame([], "event_id long")
    assert all(facts.facts(empty, f).count() == 0 and facts.facts(empty, f).schema.names == facts.schema_of(f).names for f in facts.FACTS)


class Session:
    """What shared_dir() asks of a session."""

    def __init__(self, master, **conf):
        self.sparkContext, self.conf = SimpleNamespace(master=master), SimpleNamespace(get=lambda k, other: conf.get(k, other), set=conf.__setitem__)


def test_no_shared_folder_is_an_error_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("spark://host:7077"))
    assert shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    alone = Session("local[4]")
    assert shared_dir(alone) == shared_dir(alone)


def test_bands_by_halving_agree_with_case_on_every_edge(spark):
    further = gpa.register_scale("honours50", 50, [(90, 50), (75, 40), (60, 25)])
    scales = cat.grade_scales(spark, further)
    edges = sorted({float(b) + d for _, bands in further.values() for b, _ in bands for d in (-0.01, 0.0, 0.01)} | {-5.0, 0.0, 150.0})
    rows = spark.createDataFrame([(k, e) for k in [*further, "none-such", None] for e in edges] + [("pku40", None)], "scale_id string, score double")
    case = None
    for k in further:
        case = (F.when if case is None else case.when)(F.col("scale_id") == k, gpa.points_x10(k, scales=further))
    got = gpa.to_points_by_scale(rows, scales).withColumn("want", case)
    assert got.count() == len(edges) * (len(further) + 2) + 1
    assert got.where("score is not null and not (points_x10 <=> want)").count() == 0
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_each_student_on_the_chosen_scale(spark):
    rows = [(1, "pku40", 4.0, 85.0), (1, "pku40", 3.0, 78.0), (1, "pku40", 3.0, 92.0), (2, "own", 1.0, 50.0), (3, "none-such", 1.0, 90.0), (4, "pku40", 0.0, 90.0)]
    df = spark.createDataFrame(rows, "student_id long, scale_id string, credits double, score double")
    own = spark.createDataFrame([("own", "own", 50, 40.0, 35)], cat.grade_scales(spark).schema)
    got = {r.student_id: (r.gpa, r.total_credits) for r in gpa.weighted_gpa_by_scale(df, cat.grade_scales(spark).unionByName(own)).collect()}
    assert got == {1: (3.58, 10.0), 2: (3.5, 1.0), 3: (None, 1.0), 4: (0.0, 0.0)}


def test_days_merge_to_weeks(spark):
    rng = random.Random(4)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 40)), rng.choice([None, -7, 0, 1, 32_768, 32_769, rng.randrange(200_000)]), rng.choice(["Engagement", "Conversion"]), rng.choice(["a", "b", None]), rng.choice([None, 0.25, 3.1])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "ts timestamp, user_id long, event_category string, event_label string, value double")
    daily = events.daily_rollup(df)
    assert daily.agg(F.sum("n_events")).first()[0] == 3000
    for span in ("week", "month", "year"):
        merged = events.span_rollup(daily, F.date_trunc(span, "day")).collect()
        whole = df.groupBy(F.date_trunc(span, F.to_date("ts")).alias("span"), "event_category", "event_label").agg(F.count("*").alias("n_events"), F.sum(F.coalesce("value", F.lit(0.0)).cast("decimal(18,2)")).cast("double").alias("value_sum"), F.countDistinct("user_id").alias("n_users"))
        key = lambda rows: sorted((str(r.span), r.event_category, str(r.event_label), r.n_events, r.value_sum, r.n_users) for r in rows)
        assert key(merged) == key(whole.collect())
        assert all(r.conversions == (r.n_events if r.event_category == "Conversion" else 0) for r in merged)
