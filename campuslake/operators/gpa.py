"""Grade conversion and credit-weighted GPA. Transcripts: student_id, course_id, credits, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import parse_float
from ..sources.catalogs import SCALES, grade_scales
from ..sources.scratch import BROADCAST_ROWS

#: Credits are whole numbers of so many parts: exact up to six decimals.
UNIT = 1_000_000


def register_scale(scale_id: str, max_x10: int, bands: list[tuple[float, int]], scales: dict = SCALES) -> dict:
    """The scales and one more, as data: (lower bound, points times ten), the highest bound first. The result is what the operators below take as scales."""
    if sorted(bands, reverse=True) != list(bands):
        raise ValueError("bands must go from the highest bound down")
    return scales | {scale_id: (max_x10, list(bands))}


def countable() -> Column:
    return F.coalesce((F.col("credits") > 0) & (F.col("score") > 0), F.lit(False))


def valid_courses(df: DataFrame) -> DataFrame:
    """Courses with credits and a score; a score beyond 100 counts, a score of 0 does not."""
    return df.where(countable())


def flag_score_range(df: DataFrame) -> DataFrame:
    """score_out_of_range, a warning only: such courses still count."""
    return df.withColumn("score_out_of_range", (F.col("score") > 100) | (F.col("score") < 0))


def coerce_course_numbers(df: DataFrame) -> DataFrame:
    """credits and score from text; what is no number is 0."""
    return df.withColumns({c: F.coalesce(parse_float(F.col(c)), F.lit(0.0)) for c in ("credits", "score")})


def points_x10(scale_id: str, score: Column | None = None, scales: dict = SCALES) -> Column:
    """Grade points times ten, as one CASE over the scale's bands: no join, no shuffle."""
    score = F.col("score") if score is None else score
    ladder = None
    for bound, points in scales[scale_id][1]:
        ladder = F.when(score >= float(bound), points) if ladder is None else ladder.when(score >= float(bound), points)
    return F.lit(0) if ladder is None else ladder.otherwise(0)


def to_points(df: DataFrame, scale_id: str, scales: dict = SCALES) -> DataFrame:
    return df.withColumn("points_x10", points_x10(scale_id, scales=scales))


def to_points_by_table(df: DataFrame, scale_id: str, scales: dict = SCALES) -> DataFrame:
    """to_points() by the catalog's rows: the bands at or below the score are found in a sorted constant array of the broadcast row; no shuffle, no row more."""
    bands = grade_scales(df.sparkSession, scales).where(F.col("scale_id") == scale_id)
    ladder = bands.agg(F.sort_array(F.collect_list(F.struct("lower_bound", "points_x10"))).alias("ladder"))
    out = df.join(F.broadcast(ladder), how="left")  # one row for all: an empty scale gives an empty ladder
    below = F.filter("ladder", lambda b: b["lower_bound"] <= F.col("score"))
    return out.withColumn("points_x10", F.coalesce(F.try_element_at(below, F.lit(-1))["points_x10"], F.lit(0))).drop("ladder")


def scale_ladders(scales: DataFrame) -> DataFrame:
    """scale_id and its bands, by rising bound. scales: scale_id, lower_bound, points_x10, a row for each band; further rows make a further scale."""
    return scales.groupBy("scale_id").agg(F.array_sort(F.collect_list(F.struct("lower_bound", "points_x10"))).alias("ladder"))


def to_points_by_scale(df: DataFrame, scales: DataFrame) -> DataFrame:
    """to_points() where each row names its scale_id: the bound at or below the score is found by halving the scale's bands. A scale that is not in scales gives null.

    The scales are broadcast as long as they have BROADCAST_ROWS bands at most.
    """
    ladders = scale_ladders(scales.where(F.col("scale_id").isNotNull()))
    if scales.count() <= BROADCAST_ROWS:
        ladders = F.broadcast(ladders)
    out = df.join(ladders, "scale_id", "left")
    halvings = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2(F.size("ladder") + 1)).cast("int")))

    def half(bounds: Column, _: Column) -> Column:
        middle = F.shiftright(bounds["low"] + bounds["high"], 1)
        below = (bounds["low"] < bounds["high"]) & (F.get("ladder", middle)["lower_bound"] <= F.col("score"))
        return F.struct(F.when(below, middle + 1).otherwise(bounds["low"]).alias("low"), F.when(below, bounds["high"]).otherwise(F.least(middle, bounds["high"])).alias("high"))

    # low: how many bounds the score reaches
    low = F.aggregate(halvings, F.struct(F.lit(0).alias("low"), F.size("ladder").alias("high")), half)["low"]
    points = F.when(F.col("ladder").isNotNull(), F.when(low > 0, F.get("ladder", low - 1)["points_x10"]).otherwise(0))
    return out.withColumn("points_x10", points).select(*df.columns, "points_x10")


def weighted_gpa_by_scale(df: DataFrame, scales: DataFrame) -> DataFrame:
    """student_id, scale_id, gpa and total_credits, each student on the scale that the rows name.

    Rows that name several scales give a row for each; an unknown scale has a null
    gpa. One shuffle of courses.
    """
    p, c = _weighted(F.col("credits"), F.coalesce("points_x10", F.lit(0)))
    sums = to_points_by_scale(df, scales).groupBy("student_id", "scale_id").agg(p.alias("p"), c.alias("c"), F.max("points_x10").isNotNull().alias("known"))
    return sums.select("student_id", "scale_id", F.when(F.col("known"), gpa_hundredths(F.col("p"), F.col("c")) / 100.0).alias("gpa"), (F.col("c") / float(UNIT)).alias("total_credits"))


def to_points_all(df: DataFrame, scales: dict = SCALES) -> DataFrame:
    """A row for each course and scale, from one array: rows are multiplied by the number of scales."""
    named = lambda k, n, top: (F.lit(k).alias("scale_id"), F.lit(n).alias("scale_no"), F.lit(top).alias("max_gpa_x10"))
    every = F.array(*[F.struct(*named(k, n, top), points_x10(k, scales=scales).alias("points_x10")) for n, (k, (top, _)) in enumerate(scales.items())])
    return df.withColumn("s", F.explode(every)).select(*df.columns, "s.*")


def _weighted(credits: Column, points: Column) -> tuple[Column, Column]:
    """Sums of points times credits and of credits, in parts of UNIT, over countable courses."""
    parts = F.round(credits * UNIT).cast("long")
    return F.sum(F.when(countable(), points * parts).otherwise(0)), F.sum(F.when(countable(), parts).otherwise(0))


def gpa_hundredths(p: Column, c: Column) -> Column:
    """The mean in hundredths of a point, halves up, in whole numbers; 0 without credits."""
    whole, by = 20 * p + c, 2 * c
    return F.when(c > 0, ((whole - F.pmod(whole, by)) / by).cast("long")).otherwise(F.lit(0).cast("long"))


def weighted_gpa(df: DataFrame, scale_id: str, scales: dict = SCALES) -> DataFrame:
    """student_id, gpa and total_credits; students without a countable course stay, with zeros. One shuffle, after partial sums."""
    p, c = _weighted(F.col("credits"), points_x10(scale_id, scales=scales))
    sums = df.groupBy("student_id").agg(p.alias("p"), c.alias("c"))
    return sums.select("student_id", (gpa_hundredths(F.col("p"), F.col("c")) / 100.0).alias("gpa"), (F.col("c") / float(UNIT)).alias("total_credits"))


def _sums_all(df: DataFrame, scales: dict) -> DataFrame:
    """A row for each student: every scale's sum of points as a column of its own (p0, p1, ...), and c, the credits. One shuffle, after partial sums."""
    sums = [_weighted(F.col("credits"), points_x10(k, scales=scales))[0].alias(f"p{n}") for n, k in enumerate(scales)]
    return df.groupBy("student_id").agg(*sums, _weighted(F.col("credits"), F.lit(0))[1].alias("c"))


def weighted_gpa_all(df: DataFrame, scales: dict = SCALES) -> DataFrame:
    """weighted_gpa() on every scale: the scales' sums are columns of one aggregate, so rows are multiplied after the shuffle only."""
    one = _sums_all(df, scales)
    every = F.array(*[F.struct(F.lit(k).alias("scale_id"), F.lit(n).alias("scale_no"), F.lit(top).alias("max_gpa_x10"), F.col(f"p{n}").alias("p")) for n, (k, (top, _)) in enumerate(scales.items())])
    flat = one.select("student_id", "c", F.explode(every).alias("s")).select("student_id", "c", "s.*")
    cents = gpa_hundredths(F.col("p"), F.col("c"))
    return flat.select("student_id", "scale_id", "scale_no", "max_gpa_x10", cents.alias("gpa_cents"), (cents / 100.0).alias("gpa"), (F.col("c") / float(UNIT)).alias("total_credits"))


def scale_summary(df: DataFrame) -> DataFrame:
    """Every scale by name: students with credits, their mean in hundredths (whole, rounded down) and how many reach the maximum."""
    s = df.sparkSession
    names = grade_scales(s).select("scale_id", "scale_name", "max_gpa_x10").distinct()
    found = weighted_gpa_all(df).where("total_credits > 0").groupBy("scale_id").agg(
        F.count("*").alias("n_students"), F.floor(F.sum("gpa_cents") / F.count("*")).alias("mean_cents"), F.sum((F.col("gpa_cents") == F.col("max_gpa_x10") * 10).cast("long")).alias("n_at_max")
    )
    zero = F.lit(0).cast("long")
    return names.join(found, "scale_id", "left").select("scale_id", "scale_name", "max_gpa_x10", *[F.coalesce(c, zero).alias(c) for c in ("n_students", "mean_cents", "n_at_max")])


def best_scale(df: DataFrame) -> DataFrame:
    """The scale with the largest share of its maximum for each student, compared in whole numbers; ties go to the earlier scale.

    The scales are compared inside the student's row: no row for each scale, no sort.
    """
    cents = [gpa_hundredths(F.col(f"p{n}"), F.col("c")).alias(f"cents{n}") for n in range(len(SCALES))]
    one = _sums_all(df, SCALES).select("student_id", *cents)
    # 1720 is a multiple of both maxima, 40 and 43
    every = [F.struct((F.col(f"cents{n}") * (1720 // top)).alias("share"), F.lit(-n).alias("before"), F.lit(k).alias("scale_id"), F.col(f"cents{n}").alias("cents")) for n, (k, (top, _)) in enumerate(SCALES.items())]
    return one.select("student_id", F.greatest(*every).alias("x")).select("student_id", "x.scale_id", (F.col("x.cents") / 100.0).alias("gpa"))


def gpa_tier(gpa: Column) -> Column:
    return F.when(gpa >= 3.8, "top").when(gpa >= 3.3, "good").when(gpa > 0, "low").otherwise("none")


def cta_tier(df: DataFrame) -> DataFrame:
    """cta_tier of gpa: top from 3.8, good from 3.3, low above 0, else none."""
    return df.withColumn("cta_tier", gpa_tier(F.col("gpa")))
