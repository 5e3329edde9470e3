"""Edit logs folded into current state. Logs: session_id, seq (unique in a session), op, id, field, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import number_or, parse_float
from ..sources import catalogs as cat
from .visa import item_bit

#: The cost form before any edit.
COST_FORM = {"country": "us", "city": "us-nyc", "degree": "master_taught", "school_type": "unsure", "duration": "1.5", "accommodation": "dorm"}
TIMELINE_FORM = ["country", "level", "grade", "major", "tier", "round"]


#: What a stretch of a log makes of a duration: nothing, a value, or the default of a country and a degree (null: those that come in).
_KEEP, _SET, _DEFAULT = 0, 1, 2
#: Events of a session that are folded in one row are those whose seq is equal but for so many low bits; and so on upward.
PIECE_BITS = 16


def _becomes(kind: int, value: Column | None = None, country: Column | None = None, degree: Column | None = None) -> Column:
    none = F.lit(None)
    parts = {"kind": (F.lit(kind), "int"), "value": (value, "double"), "country": (country, "string"), "degree": (degree, "string")}
    return F.struct(*[(none if c is None else c).cast(t).alias(k) for k, (c, t) in parts.items()])


def _stretch(country: Column, degree: Column, known: Column, if_known: Column, if_unknown: Column) -> Column:
    """What a stretch of a cost form's log does: its last country (and whether that is known) and degree, and what the duration becomes, by whether the country that comes in is known."""
    return F.struct(country.cast("string").alias("country"), degree.cast("string").alias("degree"), known.cast("boolean").alias("known"), if_known.alias("if_known"), if_unknown.alias("if_unknown"))


def _then(a: Column, b: Column) -> Column:
    """The stretch of a followed by b."""

    def after(first: str, comes_in: bool) -> Column:
        known = F.coalesce(a["known"], F.lit(comes_in))
        e = F.when(known, b["if_known"]).otherwise(b["if_unknown"])
        filled = _becomes(_DEFAULT, None, F.coalesce(e["country"], a["country"]), F.coalesce(e["degree"], a["degree"]))
        return F.when(e["kind"] == _KEEP, a[first]).when(e["kind"] == _DEFAULT, filled).otherwise(e)

    return _stretch(F.coalesce(b["country"], a["country"]), F.coalesce(b["degree"], a["degree"]), F.coalesce(b["known"], a["known"]), after("if_known", True), after("if_unknown", False))


def replay_cost_form(log: DataFrame, piece_bits: int = PIECE_BITS) -> DataFrame:
    """The cost form of each session. log: session_id, seq, field, value.

    A known country resets city and duration; a degree resets duration if the
    country is known. What a stretch of the log does is a value of its own, and
    stretches that follow each other make one: events are folded by pieces of
    2^piece_bits numbers, then pieces in the same way, so that no task holds more
    than a piece of a session. Events without a seq, and countries and degrees
    without a value, are passed over; a duration that is no number is 1.
    """
    none, field, value = F.lit(None), F.col("field"), F.col("value")
    first = F.create_map(*[F.lit(x) for c in cat.CITIES if c[1] == 0 for x in (c[0], c[2])])
    years = F.create_map(*[F.lit(x) for c, d, _, _, n in cat.DEGREES for x in (f"{c} {d}", n or 1.0)])
    city = F.try_element_at(first, value)
    known = city.isNotNull()
    keep, default = _becomes(_KEEP), lambda c, d: _becomes(_DEFAULT, None, c, d)
    step = (
        F.when((field == "duration"), _stretch(none, none, none, *[_becomes(_SET, number_or(value, 1.0))] * 2))
        .when((field == "country") & known, _stretch(value, none, F.lit(True), default(value, none), default(value, none)))
        .when((field == "country") & value.isNotNull(), _stretch(value, none, F.lit(False), keep, keep))
        .when((field == "degree") & value.isNotNull(), _stretch(none, value, none, default(none, value), keep))
    )
    of = {"city": F.when(field == "city", value).when(field == "country", city)} | {c: F.when(field == c, value) for c in ("school_type", "accommodation")}
    last = {c: F.when(v.isNotNull(), F.struct("seq", v.alias("value"))) for c, v in of.items()}
    rows = log.where(F.col("seq").isNotNull()).select("session_id", F.col("seq").cast("long").alias("seq"), "field", "value")
    least, most = rows.agg(F.min("seq"), F.max("seq")).first()
    rows = rows.select("session_id", F.col("seq").alias("at"), F.when(step.isNotNull(), F.struct("seq", step.alias("s"))).alias("s"), *[v.alias(c) for c, v in last.items()])
    start = _stretch(none, none, none, keep, keep)
    pieces = (most or 0) - (least or 0)
    while True:
        wide = pieces >> piece_bits > 0
        at = F.shiftright("at", piece_bits)
        by = ["session_id", at.alias("at")] if wide else ["session_id"]
        rows = rows.groupBy(*by).agg(F.array_sort(F.collect_list("s")).alias("s"), *[F.max(c).alias(c) for c in of])
        whole = F.aggregate("s", start, lambda a, x: _then(a, x["s"]))
        if not wide:
            break
        rows = rows.select("session_id", "at", F.struct(F.col("at").alias("seq"), whole.alias("s")).alias("s"), *of)
        pieces >>= piece_bits
    rows = rows.withColumn("whole", whole)
    became = F.col("whole")["if_known"]
    chosen = F.concat_ws(" ", *[F.coalesce(became[c], F.lit(COST_FORM[c])) for c in ("country", "degree")])
    default_of = F.coalesce(F.try_element_at(years, chosen), F.lit(1.0))
    out = {
        "country": F.col("whole")["country"], "city": F.col("city")["value"], "degree": F.col("whole")["degree"], "school_type": F.col("school_type")["value"],
        "duration": F.when(became["kind"] == _SET, became["value"]).when(became["kind"] == _DEFAULT, default_of), "accommodation": F.col("accommodation")["value"],
    }
    return rows.select("session_id", *[F.coalesce(out[c], F.lit(float(v) if c == "duration" else v)).alias(c) for c, v in COST_FORM.items()])


def _odd(log: DataFrame) -> DataFrame:
    """(user_id, item_id) toggled an odd number of times: toggles commute, so their order is of no account."""
    return log.groupBy("user_id", "item_id").agg(F.count("*").alias("n")).where("n % 2 = 1").select("user_id", "item_id")


def replay_selection(log: DataFrame) -> DataFrame:
    """The sorted selection of each user who has toggled anything."""
    n = log.groupBy("user_id", "item_id").agg((F.count("*") % 2 == 1).alias("on"))
    return n.groupBy("user_id").agg(F.array_sort(F.collect_list(F.when(F.col("on"), F.col("item_id")))).alias("selected"))


def replay_checklist(log: DataFrame) -> DataFrame:
    """user_id, item_id of what is checked now."""
    return _odd(log)


def checklist_masks(log: DataFrame) -> DataFrame:
    """user_id, mask: what is checked now, one long a user. A toggle is its own inverse, so toggles fold by exclusive-or in any order, before the one shuffle too."""
    return log.groupBy("user_id").agg(F.bit_xor(item_bit(F.col("item_id"))).alias("mask"))


#: A session's courses are dealt to so many tasks.
SLOTS = 16


def replay_courses(log: DataFrame) -> DataFrame:
    """The courses of each session that has a log (null is a session too): session_id, course_id, name, credits, score.

    Ids are given once. `clear` leaves one blank course (id blank-<seq>), `fill`
    the example courses (id example-<n>); a session begins with a blank course
    (id blank-0). Updates count from their course's appearance to its removal.

    The log is read twice: once for each session's last reset, once for its
    courses. Both meet by session and a slot of the course's id, so that a large
    session is many tasks, and what follows needs no further shuffle.
    """
    seq, op = F.col("seq"), F.col("op")
    of_null = F.lit(0).cast(log.schema["session_id"].dataType)  # a key that joins may compare; z tells it from a real one
    keyed = log.select(F.coalesce("session_id", of_null).alias("k"), F.col("session_id").isNull().alias("z"), "seq", "op", "id", "field", "value")
    heads = keyed.groupBy("k", "z").agg(F.max(F.when(op.isin("clear", "fill"), seq)).alias("reset"))
    slot = lambda i: F.pmod(F.xxhash64(F.coalesce(i, F.lit(""))), F.lit(SLOTS))
    heads = heads.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long"))))

    def row(kind: Column, course: Column, at: Column, field: Column, value: Column) -> Column:
        texts = [c.cast("string").alias(k) for k, c in (("field", field), ("value", value))]
        return F.struct(kind.alias("kind"), course.alias("course_id"), at.cast("long").alias("seq"), *texts)

    none, begins = F.lit(None), F.lit("start")
    blank = row(begins, F.concat(F.lit("blank-"), seq.cast("string")), seq, none, none)
    examples = [row(begins, F.lit(f"example-{n}"), seq, none, none) for n in range(len(cat.EXAMPLE_COURSES))]
    told = F.when(op == "clear", F.array(blank)).when(op == "fill", F.array(*examples)).otherwise(F.array(row(op, F.col("id"), seq, F.col("field"), F.col("value"))))
    rows = keyed.select("k", "z", F.explode(told).alias("x")).withColumn("slot", slot(F.col("x.course_id")))
    # every slot of a session has a row, even without a log: the first blank course appears in its own
    rows = rows.join(heads, ["k", "z", "slot"], "right")
    first = F.col("reset").isNull() & (F.col("slot") == slot(F.lit("blank-0")))
    both = F.array_compact(F.array(F.col("x"), F.when(first, row(begins, F.lit("blank-0"), F.lit(-1), none, none))))
    rows = rows.select("k", "z", "slot", F.coalesce("reset", F.lit(-1)).alias("reset"), F.explode(both).alias("x")).select("k", "z", "slot", "reset", "x.*")
    kind, after = F.col("kind"), F.col("reset")
    change = lambda f: F.max(F.when((kind == "update") & (F.col("field") == f), F.struct("seq", "value"))).alias(f"new_{f}")
    found = rows.groupBy("k", "z", "slot", "course_id").agg(
        F.max(F.when((kind == "start") & (seq == after), after)).alias("started"), F.min(F.when((kind == "add") & (seq > after), seq)).alias("added"),
        F.max(F.when(kind == "remove", seq)).alias("removed"), *[change(f) for f in ("name", "credits", "score")],
    )
    empty = F.struct(F.lit("").alias("name"), F.lit(0.0).alias("credits"), F.lit(0.0).alias("score"))
    given = empty
    for n, (a, b, c) in enumerate(cat.EXAMPLE_COURSES):
        given = F.when(F.col("course_id") == f"example-{n}", F.struct(F.lit(a).alias("name"), F.lit(b).alias("credits"), F.lit(c).alias("score"))).otherwise(given)
    appeared = F.array_compact(F.array(*[F.when(F.col(born).isNotNull(), F.struct(F.col(born).alias("born"), base.alias("base"))) for born, base in (("started", given), ("added", empty))]))
    out = found.withColumn("c", F.explode(appeared)).where(~F.coalesce(F.col("removed") > F.col("c.born"), F.lit(False)))
    now = {f: F.when(F.col(f"new_{f}.seq") > F.col("c.born"), F.col(f"new_{f}.value")) for f in ("name", "credits", "score")}
    number = lambda f: F.when(now[f].isNotNull(), F.coalesce(parse_float(now[f]), F.lit(0.0))).otherwise(F.col(f"c.base.{f}")).alias(f)
    return out.select(F.when(~F.col("z"), F.col("k")).alias("session_id"), "course_id", F.coalesce(now["name"], "c.base.name").alias("name"), number("credits"), number("score"))


def replay_timeline_form(log: DataFrame) -> DataFrame:
    """The timeline form of each session: the last write wins, a level clears grade and round, a reset clears all. log: session_id, seq, op, field, value."""
    reset, field = F.col("op") == "reset", F.col("field")
    emit = {c: F.when(reset, "").when(field == c, F.col("value")) for c in TIMELINE_FORM}
    for c in ("grade", "round"):
        emit[c] = F.when(reset | (field == "level"), "").when(field == c, F.col("value"))
    run = log.withColumns({f"e_{c}": e for c, e in emit.items()})
    out = run.groupBy("session_id").agg(*[F.max_by(f"e_{c}", F.when(F.col(f"e_{c}").isNotNull(), F.col("seq"))).alias(c) for c in TIMELINE_FORM])
    return out.select("session_id", *[F.coalesce(c, F.lit("")).alias(c) for c in TIMELINE_FORM])
