from __future__ import annotations

import itertools
import random

from campuslake.operators import matching
from campuslake.sources import catalogs as cat

SCHEMA = "applicant_id long, gpa_text string, school_bg string, countries array<string>, highlights array<string>"


def frame(spark, *rows):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], SCHEMA)


def test_validation(spark):
    df = frame(spark, *[(t, "normal", [], []) for t in ("", "abc", "-0.1", "4.0", "4.01", "3.5abc", None)])
    assert [r.gpa_error for r in matching.validate_gpa(df).collect()] == ["required", "range", "range", None, "range", None, "required"]
    assert {r.applicant_id for r in matching.match_schools(df).collect()} == {3, 5}


def test_level_edges(spark):
    df = frame(spark, ("3.8", "normal", ["HK"], []), ("3.7", "985", ["HK"], []), ("3.5", "normal", ["SG"], []))
    got = {(r.applicant_id, r.school_id): r.match_level for r in matching.match_schools(df).collect()}
    assert got[0, "hk-1"] == "match" and got[1, "hk-1"] == "safety"
    assert not any(a == 2 for a, _ in got)
    summary = {r.applicant_id: (r.reach, r.match, r.safety) for r in matching.match_summary(df, matching.match_schools(df)).collect()}
    assert summary[2] == (0, 0, 0)


def test_highlights_widen_reach_only(spark):
    df = frame(spark, ("3.4", "normal", ["US"], []), ("3.4", "normal", ["US"], ["a", "b"]), ("3.4", "normal", [], list("abcde")))
    by = lambda n: {r.school_id: (r.match_level, r.match_score) for r in matching.match_schools(df).where(f"applicant_id = {n}").collect()}
    none, two = by(0), by(1)
    assert "us-1" not in none and two["us-1"][0] == "reach" and none.items() <= two.items()
    assert {s[:2] for s in by(2)} == {"us", "uk", "hk"}


def brute(gpa, bg, countries, n):
    """The rule for one applicant, row by row."""
    value, bound = gpa + dict(cat.BACKGROUNDS).get(bg, 0.0), -0.4 - min(0.05 * n, 0.15)
    levels = {k: [] for k in matching.LEVELS}
    for pos, code, _, _, country, _, need, *_ in cat.school_rows():
        diff = value - need
        level = "safety" if diff >= 0.2 else "match" if diff >= -0.15 else "reach" if diff >= bound else None
        if level and (not countries or country in countries):
            levels[level].append((abs(diff) if level == "match" else -need, pos, code))
    return {k: [c for *_, c in sorted(v)] for k, v in levels.items()}


def test_rank_and_shortlist_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(str(rng.randrange(250, 401) / 100), rng.choice([b for b, _ in cat.BACKGROUNDS] + ["?"]), rng.sample(["US", "UK", "HK"], rng.randrange(4)), ["h"] * rng.randrange(6)) for _ in range(60)]
    df = frame(spark, *rows)
    ranked = matching.rank_matches(matching.match_schools(df))
    got: dict = {}
    for r in sorted(ranked.collect(), key=lambda r: r.rn):
        got.setdefault(r.applicant_id, {}).setdefault(r.match_level, []).append(r.school_id)
    short: dict = {}
    for r in sorted(matching.shortlist(ranked).collect(), key=lambda r: r.rn):
        short.setdefault((r.applicant_id, r.match_level), []).append((r.school_id, r.is_locked))
    for n, (g, bg, countries, highlights) in enumerate(rows):
        want = {k: v for k, v in brute(float(g), bg, countries, len(highlights)).items() if v}
        assert got.get(n, {}) == want
        for level, found in want.items():
            most, free = matching.SHORTLIST[level]
            assert short[n, level] == [(c, k >= free) for k, c in enumerate(itertools.islice(found, most))]


def test_rank_is_limited_before_the_shuffle(spark):
    df = matching.shortlist(matching.rank_matches(matching.match_schools(frame(spark, ("3.5", "c9", [], [])))))
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_null_lists(spark):
    rows = [(1, "3.7", "other", None, None), (2, "3.7", "other", [], [])]
    got = matching.match_schools(spark.createDataFrame(rows, "applicant_id long, gpa_text string, school_bg string, countries array<string>, highlights array<string>")).collect()
    of = lambda k: sorted((r.school_id, r.match_level) for r in got if r.applicant_id == k)
    assert of(1) == of(2) and len(of(1)) > 10
