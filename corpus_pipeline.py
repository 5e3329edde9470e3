"""A training corpus from raw documents: filter, identify, deduplicate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. run() writes what a stage returns as Parquet in
the shared folder and reads it back for the next one, so that a lost executor
never costs more than the stage that it worked on.

All stages take an empty table and give an empty result, take texts of any length
whole, and keep columns that documents may have besides, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campuslake.llm.common import gathered, positional, remove, shared_dir, temporary
from campuslake.llm.language_id import UNKNOWN, identify, learn
from campuslake.llm.line_dedup import line_dedup
from campuslake.llm.near_dedup import one_of_each
from campuslake.llm.packing import pack
from campuslake.llm.quality_rules import quality_rules


def named(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[str]]:
    """docs with positional names, the position of each name, and all positions: extra columns may have any name."""
    rows, inside = positional(docs)
    return rows, dict(zip(docs.columns, inside)), inside


def carried(inside: list[str]) -> list[str]:
    """What operators call the columns that they carry."""
    return [f"c{k}" for k in range(len(inside))]


#: Tables that the last stage has written besides, which its rows are made of.
_left: list[DataFrame] = []


def after_the_last(stage: Callable) -> Callable:
    """A stage is called once its predecessor's rows are written, so what these were made of is deleted first."""

    @wraps(stage)
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            remove(spark, _left.pop().written_at)
        with gathered(_left):
            return stage(spark, docs, sf_dir)

    return called


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and that the rules together find good.

    Null and empty texts have no words and go; repeated rows get one verdict.
    Rows stay as they are.
    """
    rows, at, inside = named(docs)
    return quality_rules(rows, at["doc_id"], at["text"], carry=inside).where("kept").select(carried(inside)).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; lang becomes what was recognised.

    Null texts and texts without a letter go; a null lang is never learned from,
    and is filled in. Repeated rows get one result. Equal sizes go to the language
    that comes first by name.
    """
    rows, at, inside = named(docs)
    model = learn(rows, at["doc_id"], at["text"], at["lang"])
    found = identify(rows, model, at["doc_id"], at["text"], carry=inside)
    kept = found.where(~F.col("rejected") & (F.col("lang_pred") != UNKNOWN))
    columns = dict(zip(inside, carried(inside))) | {at["lang"]: "lang_pred"}
    return kept.select(*columns.values()).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less later copies of line runs; a document of which nothing is left goes.

    A text without lines, null or empty, stays as it is. Of repeated rows the first
    read counts as the earlier; n_chars is counted anew, other columns stay.
    """
    rows, at, inside = named(docs)
    out = line_dedup(rows, id_col=at["doc_id"], text_col=at["text"]).where((F.col("n_removed") == 0) | (F.col("n_lines") > F.col("n_removed")))
    if "n_chars" in at:
        out = out.withColumn(at["n_chars"], F.length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return out.select(inside).toDF(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id (null first), as it is.

    Of repeated rows one stays; null texts and texts without a word are like no
    other and stay.
    """
    rows, at, inside = named(docs)
    return one_of_each(rows, at["doc_id"], at["text"]).select(inside).toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token windows. A null or empty text is its end token alone; repeated rows are packed each on its own."""
    docs = docs.select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    (name, after_the_last(stage))
    for name, stage in (("quality rules", quality), ("language ID", language), ("line dedup", lines), ("near dedup", near), ("packing", packed))
]

#: No SQL: expectation-maximisation, compression and tokenizers are beyond it; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir. What a stage has written besides is deleted with its end, and its rows once the next one is written."""
    folder = f"{shared_dir(spark)}/campuslake/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with temporary():
            out = stage(spark, docs, sf_dir)
            out.write.parquet(f"{folder}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
