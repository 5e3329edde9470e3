"""The facts that operators take, each with its schema; rows that break it are told with the reason.

Nothing is inferred from the data: a file's own columns are held against the
schema of the fact, by name. A column of another type is converted where each of
its values can be, without loss; a column that may be null may also be absent.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import load

#: What each fact consists of; NOT NULL: a row without it is no fact.
FACTS = {
    "transcripts": "student_id BIGINT NOT NULL, course_id STRING NOT NULL, name STRING, credits DOUBLE, score DOUBLE",
    "cost_requests": "request_id BIGINT NOT NULL, country STRING, city STRING, degree STRING, school_type STRING, duration DOUBLE, accommodation STRING",
    "applicants": "applicant_id BIGINT NOT NULL, degree STRING, major STRING, gpa_text STRING, school_bg STRING, countries ARRAY<STRING>, highlights ARRAY<STRING>",
    "visa_requests": "request_id BIGINT NOT NULL, user_id BIGINT, country_id STRING, visa_id STRING, identity STRING",
    "toggles": "user_id BIGINT NOT NULL, item_id STRING NOT NULL, ts TIMESTAMP",
    "timeline_requests": "request_id BIGINT NOT NULL, country STRING, level STRING, grade STRING, major STRING, tier STRING, round STRING",
    "edits": "session_id BIGINT, seq BIGINT NOT NULL, op STRING, id STRING, field STRING, value STRING",
    "interactions": "event_id BIGINT NOT NULL, ts TIMESTAMP NOT NULL, user_id BIGINT, name STRING NOT NULL, event_category STRING, event_label STRING, value DOUBLE",
}


def schema_of(fact: str) -> T.StructType:
    return T.StructType.fromDDL(FACTS[fact])


def _converted(rows: DataFrame, name: str, kind: T.DataType) -> tuple[Column, Column]:
    """The column as that type, and whether a value of it cannot be."""
    column, own = F.col(f"`{name}`"), rows.schema[name].dataType
    if own == kind:
        return column, F.lit(False)
    try:
        if isinstance(own, (T.ArrayType, T.MapType, T.StructType)) and not isinstance(kind, type(own)):
            return F.lit(None).cast(kind), column.isNotNull()  # a list has a text, but is none
        rows.select(column.try_cast(kind))
    except AnalysisException:  # no value of this type can be converted
        return F.lit(None).cast(kind), column.isNotNull()
    out = column.try_cast(kind)
    lost = out.isNull()
    if isinstance(kind, T.LongType) and isinstance(own, (T.DoubleType, T.FloatType, T.DecimalType)):
        lost = lost | (out.cast(own) != column)
    return out, column.isNotNull() & lost


def checked(rows: DataFrame, fact: str) -> DataFrame:
    """The columns of the fact, `reason` (null: the row keeps the schema) and `given`, the row as it came in, as JSON text.

    Reasons are absent, type and null, each with its column, in the schema's order.
    """
    schema, columns, reasons = schema_of(fact), [], []
    for f in schema.fields:
        if f.name not in rows.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            if not f.nullable:
                reasons.append(F.lit(f"absent: {f.name}"))
            continue
        column, bad = _converted(rows, f.name, f.dataType)
        columns.append(column.alias(f.name))
        reason = F.when(bad, F.lit(f"type: {f.name}"))
        if not f.nullable:
            reason = reason.when(F.col(f"`{f.name}`").isNull(), F.lit(f"null: {f.name}"))
        reasons.append(reason)
    told = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return rows.select(*columns, F.when(told != "", told).alias("reason"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("given"))


def facts(rows: DataFrame, fact: str) -> DataFrame:
    """The rows that keep the fact's schema, in it."""
    return checked(rows, fact).where(F.col("reason").isNull()).select(schema_of(fact).names)


def rejects(rows: DataFrame, fact: str) -> DataFrame:
    """fact, reason and given of the rows that do not: a table to append to."""
    return checked(rows, fact).where(F.col("reason").isNotNull()).select(F.lit(fact).alias("fact"), "reason", "given")


def read_facts(spark: SparkSession, folder: str, fact: str, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """facts() and rejects() of a table of the folder; each is one scan."""
    rows = load(spark, folder, name or fact)
    return facts(rows, fact), rejects(rows, fact)
