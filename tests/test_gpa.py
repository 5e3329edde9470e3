from __future__ import annotations

import random
from fractions import Fraction

import pytest

from campuslake.operators import gpa
from campuslake.sources import catalogs as cat

ROWS = [(1, 4.0, 85.0), (1, 3.0, 78.0), (1, 3.0, 92.0), (2, 0.0, 0.0), (3, 3.0, 0.0), (3, 2.0, 60.0), (4, 2.0, 101.0), (5, 2.0, -5.0), (5, -1.0, 90.0), (6, 1.0, 59.99), (6, 1.0, 60.0)]
GOLDEN = {"standard40": 3.00, "pku40": 3.58, "improved40v1": 3.70, "improved40v2": 3.70, "canada43": 3.88, "ustc43": 3.58, "wes40": 3.70}


@pytest.fixture(scope="module")
def transcripts(spark):
    return spark.createDataFrame(ROWS, "student_id long, credits double, score double")


def test_golden_means(transcripts):
    got = {(r.student_id, r.scale_id): (r.gpa, r.total_credits) for r in gpa.weighted_gpa_all(transcripts).collect()}
    for scale, mean in GOLDEN.items():
        assert got[1, scale] == (mean, 10.0)
    assert got[2, "standard40"] == (0.0, 0.0) and got[5, "standard40"] == (0.0, 0.0)
    assert got[3, "standard40"] == (1.0, 2.0) and got[4, "standard40"] == (4.0, 2.0) and got[6, "standard40"] == (0.5, 2.0)
    one = {r.student_id: r.gpa for r in gpa.weighted_gpa(transcripts, "pku40").collect()}
    assert one == {k: v for (k, s), (v, _) in got.items() if s == "pku40"}


def test_band_edges(spark):
    rows, want = [], {}
    for scale, (_, bands) in cat.SCALES.items():
        for n, (bound, points) in enumerate(bands):
            below = bands[n + 1][1] if n + 1 < len(bands) else 0
            want |= {(scale, float(bound)): points, (scale, bound - 0.01): below}
            rows += [(float(bound),), (bound - 0.01,)]
    assert sum(len(b) for _, b in cat.SCALES.values()) == 43
    df = spark.createDataFrame(sorted(set(rows)), "score double")
    got = {(r.scale_id, r.score): r.points_x10 for r in gpa.to_points_all(df).collect()}
    assert {k: got[k] for k in want} == want


def test_flags_and_numbers(spark, transcripts):
    assert {r.score for r in gpa.flag_score_range(transcripts).where("score_out_of_range").collect()} == {101.0, -5.0}
    df = spark.createDataFrame([("3.5abc", "x"), ("", None), (" 2", "-1e1")], "credits string, score string")
    assert [tuple(r) for r in gpa.coerce_course_numbers(df).collect()] == [(3.5, 0.0), (0.0, 0.0), (2.0, -10.0)]


def test_best_scale_and_tiers(spark, transcripts):
    best = {r.student_id: r.scale_id for r in gpa.best_scale(transcripts).collect()}
    assert best[1] == "improved40v1" and best[2] == "standard40"
    tiers = gpa.cta_tier(spark.createDataFrame([(3.8,), (3.79,), (3.3,), (0.01,), (0.0,)], "gpa double"))
    assert [r.cta_tier for r in tiers.collect()] == ["top", "good", "good", "low", "none"]


def test_best_scale_inside_the_row(spark):
    rnd = random.Random(5)
    rows = [(n // 4, rnd.randrange(9) / 2, float(rnd.randrange(106))) for n in range(2000)] + [(1000 + k, c, s) for k, c, s in ROWS] + [(None, 2.0, 78.0), (None, None, 95.0), (2000, 3.0, None)]
    df = spark.createDataFrame(rows, "student_id long, credits double, score double")
    found = gpa.best_scale(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # a row for each scale would be sorted by student in the task's memory
    assert "Generate" not in plan and "Sort" not in plan and plan.count("Exchange hashpartitioning") == 1
    every = {}
    for r in gpa.weighted_gpa_all(df).collect():
        every.setdefault(r.student_id, []).append((Fraction(r.gpa_cents, r.max_gpa_x10), -r.scale_no, r.scale_id, r.gpa))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((k, *max(v)[2:])) for k, v in every.items())


def test_registered_scale(spark, transcripts):
    scales = gpa.register_scale("pass_fail", 10, [(60, 10)])
    assert {r.gpa for r in gpa.weighted_gpa(transcripts.where("student_id = 1"), "pass_fail", scales).collect()} == {1.0}
    assert "pass_fail" not in gpa.SCALES and len(gpa.weighted_gpa_all(transcripts.where("student_id = 1"), scales).collect()) == len(scales) == 8
    with pytest.raises(ValueError):
        gpa.register_scale("wrong", 10, [(1, 1), (60, 10)])


def test_credits_are_exact(spark):
    rows = [(1, "a", 0.333, 95.0), (1, "b", 0.004, 65.0), (2, "a", 0.004, 95.0)]
    got = {r.student_id: (r.gpa, r.total_credits) for r in gpa.weighted_gpa(spark.createDataFrame(rows, "student_id long, course_id string, credits double, score double"), "standard40").collect()}
    assert got == {1: (round((0.333 * 4 + 0.004) / 0.337, 2), 0.337), 2: (4.0, 0.004)}


def test_bands_by_table_and_by_case(spark):
    edges = [(b + d,) for _, bands in gpa.SCALES.values() for b, _ in bands for d in (0.0, -0.01)] + [(0.0,), (-1.0,), (120.0,), (None,)]
    df = spark.createDataFrame(edges, "score double")
    for scale in gpa.SCALES:
        both = gpa.to_points_by_table(gpa.to_points(df, scale).withColumnRenamed("points_x10", "by_case"), scale).collect()
        assert len(both) == len(edges) and all(r.by_case == r.points_x10 for r in both)
