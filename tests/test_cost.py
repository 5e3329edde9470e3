from __future__ import annotations

from campuslake.operators import cost, replay

FORM = ("us", "us-nyc", "master_taught", "unsure", 1.5, "dorm")
SCHEMA = "request_id long, country string, city string, degree string, school_type string, duration double, accommodation string"


def estimate(spark, *forms):
    rows = cost.estimate_costs(spark.createDataFrame([(n, *f) for n, f in enumerate(forms)], SCHEMA)).collect()
    return [r.asDict() for r in sorted(rows, key=lambda r: r.request_id)]


def test_golden_and_fallbacks(spark):
    a, b, none, d, e = estimate(spark, FORM, ("us", "?", *FORM[2:]), ("??", *FORM[1:]), (*FORM[:2], "?", *FORM[3:]), (*FORM[:5], "tent"))
    assert [a[f"tuition_{k}"] for k in ("budget", "medium", "comfort")] == [459000, 540000, 648000]
    assert [a[f"living_{k}"] for k in ("budget", "medium", "comfort")] == [234058, 334368, 501552]
    assert [a[f"total_{k}"] for k in ("budget", "medium", "comfort")] == [710058, 891368, 1166552]
    strip = lambda r: {k: v for k, v in r.items() if k not in ("request_id", "city", "accommodation")}
    assert strip(a) == strip(b) == strip(e)
    assert all(v == 0 for k, v in none.items() if k.split("_")[0] in ("tuition", "living", "total", "application", "hidden"))
    assert d["tuition_medium"] == round(45000 * 1.5 * 7.2)


def test_no_shuffle(spark):
    df = cost.cost_cta(cost.estimate_costs(spark.createDataFrame([(1, *FORM)], SCHEMA)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_default_duration_and_cta(spark):
    df = spark.createDataFrame([("uk", "phd"), ("uk", "?"), ("?", "phd")], "country string, degree string")
    assert sorted(r.default_duration for r in cost.default_durations(df).collect()) == [1.0, 1.0, 3.5]
    tiers = cost.cost_cta(spark.createDataFrame([(500000,), (500001,)], "total_budget long"))
    assert [r.cta_tier for r in tiers.collect()] == ["guide", "plan"]


def replayed(spark, *edits):
    log = spark.createDataFrame([(1, n, *e) for n, e in enumerate(edits)], "session_id long, seq long, field string, value string")
    return replay.replay_cost_form(log).first().asDict()


def test_form_replay(spark):
    edits = [("country", "uk")]
    assert (lambda r: (r["city"], r["duration"]))(replayed(spark, *edits)) == ("uk-london", 1.0)
    edits += [("degree", "phd")]
    assert replayed(spark, *edits)["duration"] == 3.5
    edits += [("duration", "2"), ("country", "xx")]
    assert (lambda r: (r["country"], r["city"], r["duration"]))(replayed(spark, *edits)) == ("xx", "uk-london", 2.0)
    edits += [("degree", "bachelor")]
    assert replayed(spark, *edits)["duration"] == 2.0
    assert replayed(spark, ("school_type", "public"))["city"] == "us-nyc"
