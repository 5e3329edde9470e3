"""Application timelines. Requests: request_id, country, level, grade, major, tier, round."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources import catalogs as cat

#: Fixed value: stages from this share of the timeline on are locked.
LOCK_FROM = 0.6
HIDDEN = ["stage_id", "stage_name", "core_tasks", "bg_enhancement", "deadline", "risk_warning"]


def valid_timeline_requests(df: DataFrame) -> DataFrame:
    """Country, level, grade and major are all given (a blank is not trimmed)."""
    keep = F.lit(True)
    for c in ("country", "level", "grade", "major"):
        keep = keep & F.coalesce(F.col(c) != "", F.lit(False))
    return df.where(keep)


def choose_template(df: DataFrame) -> DataFrame:
    """template_id by country and level alone."""
    country, level = F.col("country"), F.col("level")
    template = F.when((country == "美国") & (level == "本科"), "US-undergrad").when(country == "美国", "US-master").when(country == "中国香港", "HK-master")
    return df.withColumn("template_id", template.otherwise("US-undergrad"))


def lock_stages(templates: DataFrame) -> DataFrame:
    """is_locked of each stage, on the catalog: the window never sees the requests."""
    n = F.count("*").over(W.partitionBy("template_id"))
    return templates.withColumn("is_locked", F.col("idx") >= F.floor(n * F.lit(LOCK_FROM)))


def timeline_stages(requests: DataFrame) -> DataFrame:
    """The stages of every valid request."""
    stages = lock_stages(cat.timeline_templates(requests.sparkSession))
    return choose_template(valid_timeline_requests(requests)).join(F.broadcast(stages), "template_id")


def mask_locked(df: DataFrame) -> DataFrame:
    """Locked stages show their time range only."""
    return df.withColumns({c: F.when(~F.col("is_locked"), F.col(c)) for c in HIDDEN})


def first_locked_of(requests: DataFrame) -> DataFrame:
    """The first locked stage of every valid request, -1 where there is none: a constant of its template, so requests stay where they are."""
    size: dict[str, int] = {}
    for r in cat.stage_rows():
        size[r[0]] = size.get(r[0], 0) + 1
    first = {t: min((r[1] for r in cat.stage_rows() if r[0] == t and r[1] >= math.floor(n * LOCK_FROM)), default=-1) for t, n in size.items()}
    of = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    return choose_template(valid_timeline_requests(requests)).select("request_id", F.try_element_at(of, F.col("template_id")).alias("first_locked"))


def first_locked(df: DataFrame) -> DataFrame:
    """The first locked stage of each request, -1 where there is none."""
    return df.groupBy("request_id").agg(F.coalesce(F.min(F.when(F.col("is_locked"), F.col("idx"))), F.lit(-1)).alias("first_locked"))
