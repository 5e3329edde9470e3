"""Facts for every operator, derived from the driver's tables with whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import catalogs as cat
from ..sources.scratch import load

BG_CODES = [code for code, _ in cat.BACKGROUNDS] + ["unknown"]
TAGS = ["research", "internship", "competition", "paper", "volunteer"]
COST_COUNTRIES = [c[0] for c in cat.COUNTRIES] + ["xx"]
COST_CITIES = [c[2] for c in cat.CITIES] + ["nowhere"]
COST_DEGREES = ["bachelor", "master_taught", "master_research", "phd", "diploma"]
STAYS = [a for a, _, _ in cat.ACCOMMODATIONS] + ["tent"]
SCHOOL_TYPES = [k for k, _ in cat.SCHOOL_TYPES]
TIMELINE_COUNTRIES, TIMELINE_LEVELS = ["美国", "中国香港", "英国", "新加坡"], ["本科", "硕士", "博士"]
VISA_IDS = [v[2] for v in cat.VISAS] + ["us-h1"]
#: What the labels that are made of a choice are picked from, by the site's place in the catalog.
CHOICES = {
    1: list(cat.SCALE_NAMES.values()), 3: list(cat.GPA_BUTTONS.values()), 5: [c[1] for c in cat.COUNTRIES], 6: [a[1] for a in cat.ACCOMMODATIONS], 8: list(cat.COST_BUTTONS.values()),
    10: [f"{c}_{n}_{g}" for c in TIMELINE_COUNTRIES for n in TIMELINE_LEVELS for g in ("1", "2")], 11: [f"{c}_{n}" for c in TIMELINE_COUNTRIES for n in TIMELINE_LEVELS], 12: cat.LOCK_LABELS,
}


def pick(options: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("long")


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return load(spark, sf, "lineitem").select(
        c("l_orderkey").alias("student_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("course_id"),
        ((c("l_quantity").cast("int") % 9) / 2.0).alias("credits"), ((c("l_partkey") * 7 + c("l_linenumber") * 13) % 106).cast("double").alias("score"),
    )


#: The scale that each student has chosen: those of the catalog, one that rows register, one that nobody knows.
CHOSEN_SCALES = [*cat.SCALES, "honours50", "none-such"]


def scaled_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts(spark, sf).withColumn("scale_id", pick(CHOSEN_SCALES, F.col("student_id") % len(CHOSEN_SCALES)))


def raw_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts as they may come in: numbers as text, some of them none, some rows without a student; no names."""
    c, n = F.col, F.col("l_linenumber")
    return load(spark, sf, "lineitem").select(
        F.when(c("l_orderkey") % 50 != 0, c("l_orderkey").cast("string")).alias("student_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("course_id"),
        F.when(n == 2, "pass").when(n == 3, F.lit(None)).otherwise((c("l_quantity").cast("int") % 9).cast("string")).alias("credits"), (c("l_partkey") % 106).cast("int").alias("score"),
    )


def stored_states(spark: SparkSession, sf: str) -> DataFrame:
    """Stored checklists as text, whole and broken."""
    return load(spark, sf, "events").select("event_id", pick(list(STORED), F.col("event_id") % len(STORED)).alias("json"))


#: Stored texts, with how many entries reading finds, and how many of them are checked.
STORED = {
    '{"us-f1-core-1":true,"us-f1-core-2":false}': (2, 1), "{oops": (0, 0), "": (0, 0), "[1,2]": (0, 0), '{"a":true,"b":"x","c":true}': (3, 3), "null": (0, 0), "{}": (0, 0),
    '{"a":0,"b":"","c":null,"d":1.5,"e":[],"f":{"g":1}}': (6, 3), '{"a":true} and more': (0, 0),
}


def arrivals(events: DataFrame) -> DataFrame:
    """events with the run in which each arrives: by its day of the month, but some come later than their days."""
    week = F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8)).cast("int")
    return events.withColumn("run", F.when(F.col("event_id") % 20 == 7, F.least(F.lit(3), week + 1 + (F.col("event_id") % 3).cast("int"))).otherwise(week))


def applicants(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    gpa = ((k * 37) % 430 - 10) / 100.0
    text = F.when(k % 50 == 0, "").when(k % 50 == 1, "abc").when(k % 50 == 2, F.concat(gpa.cast("string"), F.lit("abc"))).otherwise(gpa.cast("string"))
    bit = lambda n, code: F.when(div(k, n) % 2 == 1, F.lit(code))
    return load(spark, sf, "orders").select(
        k.alias("applicant_id"), F.lit("master").alias("degree"), F.lit("any").alias("major"), text.alias("gpa_text"), pick(BG_CODES, F.col("o_custkey") % 21).alias("school_bg"),
        F.array_compact(F.array(bit(1, "US"), bit(2, "UK"), bit(4, "HK"))).alias("countries"), F.slice(F.array(*[F.lit(t) for t in TAGS]), 1, (k % 6).cast("int")).alias("highlights"),
    )


def cost_requests(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, sf, "orders").select(
        k.alias("request_id"), pick(COST_COUNTRIES, F.col("o_custkey") % 5).alias("country"), pick(COST_CITIES, k % 8).alias("city"), pick(COST_DEGREES, k % 5).alias("degree"),
        pick(SCHOOL_TYPES, k % 3).alias("school_type"), ((1 + k % 10) / 2.0).alias("duration"), pick(STAYS, k % 4).alias("accommodation"),
    )


def timeline_requests(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return load(spark, sf, "customer").select(
        k.alias("request_id"), pick(TIMELINE_COUNTRIES, k % 4).alias("country"), pick(TIMELINE_LEVELS, k % 3).alias("level"),
        F.when(k % 7 == 0, "").otherwise("g").alias("grade"), F.when(k % 11 == 0, "").otherwise("m").alias("major"), F.lit(None).cast("string").alias("tier"), F.lit("").alias("round"),
    )


def visa_requests(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    visa = pick(VISA_IDS, k % 5)
    return load(spark, sf, "customer").select(
        k.alias("request_id"), (k % 100).alias("user_id"), F.substring_index(visa, "-", 1).alias("country_id"), visa.alias("visa_id"), F.when(k % 7 == 0, "").otherwise("student").alias("identity"),
    )


def toggles(spark: SparkSession, sf: str) -> DataFrame:
    return toggle_rows(load(spark, sf, "events"))


def toggle_rows(events: DataFrame) -> DataFrame:
    items = [r[4] for r in cat.flat_visa_rows()]
    return events.select("user_id", pick(items, F.col("event_id") % 46).alias("item_id"), "ts")


def selections(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return load(spark, sf, "events").select("user_id", pick(["US", "UK", "HK", "SG", "AU", "CA"], (e * 7 + div(e, 11)) % 6).alias("item_id"))


def cost_log(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    n = div(e, 7)
    field = pick(["country", "degree", "city", "duration", "school_type", "accommodation"], e % 6)
    value = (
        F.when(e % 6 == 0, pick(COST_COUNTRIES, n % 5)).when(e % 6 == 1, pick(COST_DEGREES, n % 5)).when(e % 6 == 2, pick(COST_CITIES, n % 8))
        .when(e % 6 == 3, pick(["2", "0", "3.5 years", "none", "4"], n % 5)).when(e % 6 == 4, pick(SCHOOL_TYPES, n % 3)).otherwise(pick(STAYS, n % 4))
    )
    return load(spark, sf, "events").select(F.col("user_id").alias("session_id"), e.alias("seq"), field.alias("field"), value.alias("value"))


def course_log(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    op = F.when(e % 97 == 0, "clear").when(e % 89 == 0, "fill").when(e % 5 == 0, "add").when(e % 5 == 4, "remove").otherwise("update")
    # a course is named by the event that adds it; later events of any session speak of a multiple of five before them
    code = F.when(e % 89 < 9, F.concat(F.lit("example-"), (e % 3).cast("string"))).otherwise(F.concat(F.lit("c-"), F.when(op == "add", e).otherwise(F.greatest(F.lit(0), div(e, 5) * 5 - 5 * (e % 400))).cast("string")))
    field = pick(["name", "credits", "score"], e % 3)
    value = F.when(e % 3 == 0, F.concat(F.lit("course "), e.cast("string"))).when(e % 3 == 1, pick(["3", "2.5", "x"], e % 7 % 3)).otherwise((e % 101).cast("string"))
    return load(spark, sf, "events").select(F.col("user_id").alias("session_id"), e.alias("seq"), op.alias("op"), code.alias("id"), field.alias("field"), value.alias("value"))


def timeline_log(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    op = F.when(e % 61 == 0, "reset").otherwise("set")
    field = pick(["country", "level", "grade", "major", "tier", "round"], e % 6)
    value = F.when(e % 6 == 0, pick(TIMELINE_COUNTRIES, e % 4)).when(e % 6 == 1, pick(TIMELINE_LEVELS, div(e, 6) % 3)).otherwise(F.concat(F.lit("v"), (e % 10).cast("string")))
    return load(spark, sf, "events").select(F.col("user_id").alias("session_id"), e.alias("seq"), op.alias("op"), field.alias("field"), value.alias("value"))


def interactions(spark: SparkSession, sf: str) -> DataFrame:
    return interaction_rows(load(spark, sf, "events"))


def interaction_rows(events: DataFrame) -> DataFrame:
    e, n = F.col("event_id"), len(cat.EVENT_SITES)
    name, label = pick([s[0] for s in cat.EVENT_SITES], e % n), pick([s[2] for s in cat.EVENT_SITES], e % n)
    for site, options in CHOICES.items():
        label = F.when(e % n == site, pick(options, div(e, n) % len(options))).otherwise(label)
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", name.alias("name"), label.alias("event_label"), "value")
