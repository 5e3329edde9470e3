"""Interaction events: event_id, ts, user_id, name, event_category, event_label, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import catalogs as cat

CONVERSIONS = sorted({name for name, category, _ in cat.EVENT_SITES if category == "Conversion"})


def event_envelope(df: DataFrame) -> DataFrame:
    """event_id, ts, user_id and envelope {name, event_category, event_label, value}; only events that carry one keep a value."""
    category = F.when(F.col("name").isin(CONVERSIONS), "Conversion").otherwise("Engagement")
    value = F.when(F.col("name").isin(cat.VALUED_EVENTS), F.col("value"))
    return df.select("event_id", "ts", "user_id", F.struct("name", category.alias("event_category"), "event_label", value.alias("value")).alias("envelope"))


def event_rollup(df: DataFrame) -> DataFrame:
    """Events, values and distinct users by category and label, and which of them are conversions."""
    out = df.groupBy("event_category", "event_label").agg(
        F.count("*").alias("n_events"), F.round(F.sum(F.coalesce("value", F.lit(0.0)).cast("decimal(18,2)")), 2).cast("double").alias("value_sum"),
        F.countDistinct("user_id").alias("n_users"), F.sum((F.col("event_category") == "Conversion").cast("long")).alias("conversions"),
    )
    return out


def daily_rollup(df: DataFrame) -> DataFrame:
    """Counts, values and users by day, category and label, in parts that add up: users are exact bitmaps, a row for each 32,768 of their numbers.

    df: ts, user_id, event_category, event_label, value. Days can be merged to any
    longer span without the events (span_rollup()).
    """
    parts = df.groupBy(F.to_date("ts").alias("day"), "event_category", "event_label", F.bitmap_bucket_number("user_id").alias("bucket"))
    return parts.agg(
        F.count("*").alias("n_events"), F.sum(F.coalesce("value", F.lit(0.0)).cast("decimal(18,2)")).alias("value_sum"),
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"),
    )


def span_rollup(daily: DataFrame, span: Column) -> DataFrame:
    """event_rollup() by span (a column made of day), from days: bitmaps are united, so a user of many days counts once."""
    key = ["span", "event_category", "event_label"]
    merged = daily.groupBy(span.alias("span"), "event_category", "event_label", "bucket").agg(
        F.sum("n_events").alias("n_events"), F.sum("value_sum").alias("value_sum"), F.bitmap_count(F.bitmap_or_agg("users")).alias("n_users")
    )
    out = merged.groupBy(*key).agg(F.sum("n_events").alias("n_events"), F.sum("value_sum").cast("double").alias("value_sum"), F.sum("n_users").alias("n_users"))
    return out.withColumn("conversions", F.when(F.col("event_category") == "Conversion", F.col("n_events")).otherwise(F.lit(0).cast("long")))
