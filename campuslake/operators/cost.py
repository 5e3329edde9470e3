"""Cost estimates. Requests: request_id, country, city, degree, school_type, duration, accommodation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_up
from ..sources import catalogs as cat

#: Spending tiers on tuition and on living costs, and the monthly living base in local currency.
TUITION_TIERS = {"budget": 0.85, "medium": 1.0, "comfort": 1.2}
LIVING_TIERS = {"budget": 0.7, "medium": 1.0, "comfort": 1.5}
LIVING_BASE = 600.0
CTA_LIMIT = 500_000


def resolve_cost_dims(df: DataFrame) -> DataFrame:
    """Look-ups with their fallbacks: an unknown city is the country's first, an unknown degree is bachelor, an unknown accommodation dorm; an unknown country stays null.

    All sides are constant catalogs of a few rows, so every join is a broadcast.
    """
    s = df.sparkSession
    cities, degrees, stays = cat.cost_cities(s), cat.cost_degrees(s), cat.accommodations(s)
    dorm = next(m for a, _, m in cat.ACCOMMODATIONS if a == "dorm")
    city = cities.select(F.col("country_id").alias("country"), F.col("city_id").alias("city"), F.struct("living_mult", "accom_base").alias("city_dim"))
    first = cities.where("pos = 0").select(F.col("country_id").alias("country"), F.struct("living_mult", "accom_base").alias("first_dim"))
    tuition = degrees.select(F.col("country_id").alias("country"), "degree", F.struct("public_tuition", "private_tuition").alias("degree_dim"))
    bachelor = degrees.where("degree = 'bachelor'").select(F.col("country_id").alias("country"), F.struct("public_tuition", "private_tuition").alias("bachelor_dim"))
    out = df.join(F.broadcast(cat.cost_countries(s).withColumnRenamed("country_id", "country")), "country", "left")
    out = out.join(F.broadcast(city), ["country", "city"], "left").join(F.broadcast(first), "country", "left")
    out = out.join(F.broadcast(tuition), ["country", "degree"], "left").join(F.broadcast(bachelor), "country", "left")
    out = out.join(F.broadcast(stays), "accommodation", "left")
    out = out.withColumns({"c": F.coalesce("city_dim", "first_dim"), "g": F.coalesce("degree_dim", "bachelor_dim"), "accom_mult": F.coalesce("multiplier", F.lit(dorm))})
    return out.select(*df.columns, "currency", "rate", "application_fee", "hidden_fee", "c.living_mult", "c.accom_base", "g.public_tuition", "g.private_tuition", "accom_mult")


def tuition_base(df: DataFrame) -> DataFrame:
    """Public, private, or else the mean of both."""
    pub, pri = F.col("public_tuition"), F.col("private_tuition")
    return df.withColumn("tuition_base", F.when(F.col("school_type") == "public", pub).when(F.col("school_type") == "private", pri).otherwise((pub + pri) / 2.0))


def _known(x: Column) -> Column:
    return F.when(F.col("rate").isNotNull(), x).otherwise(F.lit(0).cast("long"))


def tuition_tiers(df: DataFrame) -> DataFrame:
    base = F.col("tuition_base") * F.col("duration") * F.col("rate")
    return df.withColumns({f"tuition_{k}": _known(half_up(base * F.lit(m))) for k, m in TUITION_TIERS.items()})


def living_tiers(df: DataFrame) -> DataFrame:
    month = F.col("accom_base") * F.col("accom_mult") + F.lit(LIVING_BASE) * F.col("living_mult")
    base = month * F.lit(12.0) * F.col("duration") * F.col("rate")
    return df.withColumns({f"living_{k}": _known(half_up(base * F.lit(m))) for k, m in LIVING_TIERS.items()})


def totals(df: DataFrame) -> DataFrame:
    """Sums of the rounded parts and the fees; an unknown country is all zero, fees included."""
    out = df.withColumns({"application": _known(F.col("application_fee").cast("long")), "hidden": _known(F.col("hidden_fee").cast("long"))})
    return out.withColumns({f"total_{k}": F.col(f"tuition_{k}") + F.col(f"living_{k}") + F.col("application") + F.col("hidden") for k in TUITION_TIERS})


def estimate_costs(df: DataFrame) -> DataFrame:
    """The whole estimate in one projection over broadcast look-ups: no shuffle."""
    out = totals(living_tiers(tuition_tiers(tuition_base(resolve_cost_dims(df)))))
    parts = [f"{p}_{k}" for p in ("tuition", "living", "total") for k in TUITION_TIERS]
    return out.select(*df.columns, *parts, "application", "hidden")


def cost_labels(df: DataFrame) -> DataFrame:
    """The names of what each request has chosen; what no catalog lists has no name. Broadcasts only: no shuffle."""
    s = df.sparkSession
    countries = cat.cost_countries(s).select(F.col("country_id").alias("country"), "country_name", "flag")
    cities = cat.cost_cities(s).select(F.col("country_id").alias("country"), F.col("city_id").alias("city"), "city_name")
    out = df.join(F.broadcast(countries), "country", "left").join(F.broadcast(cities), ["country", "city"], "left")
    for names, key in ((cat.degree_types(s), "degree"), (cat.school_types(s), "school_type"), (cat.accommodations(s).drop("multiplier"), "accommodation")):
        out = out.join(F.broadcast(names), key, "left")
    return out.select(*df.columns, "country_name", "flag", "city_name", "degree_name", "school_type_name", "accommodation_name")


def default_durations(df: DataFrame) -> DataFrame:
    """default_duration of (country, degree), else 1; so is a default of 0."""
    d = cat.cost_degrees(df.sparkSession).select(F.col("country_id").alias("country"), "degree", "default_duration")
    out = df.join(F.broadcast(d), ["country", "degree"], "left")
    return out.withColumn("default_duration", F.coalesce(F.nullif("default_duration", F.lit(0.0)), F.lit(1.0))).select(*df.columns, "default_duration")


def cost_cta(df: DataFrame) -> DataFrame:
    """cta_tier of total_budget: plan above the limit, else guide."""
    return df.withColumn("cta_tier", F.when(F.col("total_budget") > CTA_LIMIT, "plan").otherwise("guide"))
