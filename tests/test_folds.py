"""Edit logs folded by pieces, against a fold event by event."""

from __future__ import annotations

import random

import pytest

from campuslake.operators import replay
from campuslake.plans import inputs
from campuslake.sources import catalogs as cat

SF = "/root/testdata/sf0.001"
NUMBERS = {"2": 2.0, "0": 1.0, "3.5 years": 3.5, "none": 1.0, None: 1.0}


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def fold_cost(events):
    form = dict(replay.COST_FORM, duration=float(replay.COST_FORM["duration"]))
    first = {c[0]: c[2] for c in cat.CITIES if c[1] == 0}
    years = {(c, d): n for c, d, _, _, n in cat.DEGREES}
    for _, field, value in sorted(events, key=lambda e: e[0]):
        if field == "duration":
            form["duration"] = NUMBERS[value]
        elif value is not None:
            form[field] = value
            if field == "country" and value in first:
                form["city"] = first[value]
            if field in ("country", "degree") and form["country"] in first:
                form["duration"] = years.get((form["country"], form["degree"]), 1.0)
    return tuple(form[c] for c in replay.COST_FORM)


def random_event(rng):
    field = rng.choice(["country", "country", "degree", "degree", "duration", "city", "school_type", "accommodation"])
    value = {"country": [*inputs.COST_COUNTRIES, "yy", None], "degree": [*inputs.COST_DEGREES, None], "duration": list(NUMBERS), "city": inputs.COST_CITIES, "school_type": inputs.SCHOOL_TYPES, "accommodation": inputs.STAYS}[field]
    return field, rng.choice(value)


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_cost_form_against_a_plain_fold(spark, bits):
    rng = random.Random(bits)
    log = {}
    for session in range(120):  # a few events each, so that every order of the first ones is met
        log[session] = [(seq, *random_event(rng)) for seq in rng.sample(range(-20, 100), rng.randrange(1, 8))]
    log[500] = [(seq, *random_event(rng)) for seq in range(400)]  # a third of all rows
    log[None] = [(1, "city", "uk-other")]
    rows = [(s, *e) for s, es in log.items() for e in es] + [(7, None, "city", "nowhere")]
    df = spark.createDataFrame(rows, "session_id long, seq long, field string, value string").repartition(4)
    out = replay.replay_cost_form(df, bits)
    assert {r.session_id: tuple(r)[1:] for r in out.collect()} == {s: fold_cost(es) for s, es in log.items()}
    assert "Window" not in plan(out)


def test_cost_form_of_nothing_and_of_far_numbers(spark):
    schema = "session_id long, seq long, field string, value string"
    assert replay.replay_cost_form(spark.createDataFrame([], schema)).count() == 0
    far = [(1, -(2**62), "country", "uk"), (1, 2**62, "degree", "phd"), (1, 0, "country", "hk")]
    assert tuple(replay.replay_cost_form(spark.createDataFrame(far, schema)).first()) == (1, "hk", "hk-all", "phd", "unsure", 3.0, "dorm")


def test_a_large_session_is_many_pieces(spark):
    rng = random.Random(8)
    rows = [(1, seq, *random_event(rng)) for seq in range(3000)] + [(s, 0, *random_event(rng)) for s in range(2, 1000)]
    out = replay.replay_cost_form(spark.createDataFrame(rows, "session_id long, seq long, field string, value string"), 6)
    assert plan(out).count("Exchange hashpartitioning(session_id") == 2
    got = {r.session_id: tuple(r)[1:] for r in out.collect()}
    assert got[1] == fold_cost([r[1:] for r in rows if r[0] == 1])


def fold_courses(events):
    courses = [["blank-0", -1, "", 0.0, 0.0, False]]
    number = lambda v: {"3": 3.0, "2.5": 2.5}.get(v, 0.0)
    for seq, op, i, field, value in sorted(events, key=lambda e: e[0]):
        if op == "clear":
            courses = [[f"blank-{seq}", seq, "", 0.0, 0.0, False]]
        elif op == "fill":
            courses = [[f"example-{n}", seq, *r, False] for n, r in enumerate(cat.EXAMPLE_COURSES)]
        elif op == "add":
            if not any(c[0] == i and c[6:] == ["added"] for c in courses):
                courses.append([i, seq, "", 0.0, 0.0, False, "added"])
        else:
            for c in courses:
                if c[0] == i and op == "remove":
                    c[5] = True
                elif c[0] == i and value is not None:
                    c[{"name": 2, "credits": 3, "score": 4}[field]] = value if field == "name" else number(value)
    return sorted((c[0], *c[2:5]) for c in courses if not c[5])


def test_courses_against_a_plain_fold(spark):
    rng = random.Random(2)
    log = {}
    for session in [*range(80), None]:
        events, ids = [], []
        for seq in sorted(rng.sample(range(300), rng.randrange(1, 25))):
            op = rng.choice(["add", "add", "update", "update", "update", "update", "remove", "clear", "fill"]) if rng.random() < 0.95 else "clear"
            i = f"c-{seq}" if op == "add" else rng.choice([*ids, "example-0", "example-2", "blank-0", "none"])
            ids += [f"c-{seq}"] * (op == "add") + [f"blank-{seq}"] * (op == "clear")
            events.append((seq, op, i, rng.choice(["name", "credits", "score"]), rng.choice(["3", "2.5", "x", "math", None])))
        log[session] = events
    rows = [(s, *e) for s, es in log.items() for e in es]
    df = spark.createDataFrame(rows, "session_id long, seq long, op string, id string, field string, value string").repartition(3)
    got: dict = {}
    for r in replay.replay_courses(df).collect():
        got.setdefault(r.session_id, []).append(tuple(r)[1:])
    for s, events in log.items():
        assert sorted(got.get(s, [])) == fold_courses(events), (s, events)


def test_courses_read_the_log_twice(spark):
    out = replay.replay_courses(inputs.course_log(spark, SF))
    assert plan(out).count("FileScan") == 2 and plan(out).count("Exchange hashpartitioning") <= 3 and "Window" not in plan(out)
