"""Shared pieces: reading tables, cutting lineage, and words as numpy arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import shared_dir

#: Text bytes that one task turns into arrays at a time.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back.

    Later jobs start from the written files, so a lost executor costs only the
    tasks that it ran. drop() deletes them; else they stay until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/campuslake/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    for tables in _inside:
        tables.append(out)
    return out


_inside: list[list[DataFrame]] = []


@contextmanager
def gathered(tables: list[DataFrame]):
    """Tables that cut() writes inside are added to the list."""
    _inside.append(tables)
    try:
        yield
    finally:
        _inside.pop()


@contextmanager
def temporary():
    """Tables that cut() writes inside are deleted at the end: what is made of them lazily must have been written by then."""
    tables: list[DataFrame] = []
    try:
        with gathered(tables):
            yield
    finally:
        drop(*tables)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop(*tables: DataFrame) -> None:
    """Delete tables of cut() that nothing reads any more: what was made of them has been written."""
    for table in tables:
        remove(table.sparkSession, table.written_at)


#: Rows of a side that is broadcast (tens of bytes each); larger sides are joined by a shuffle.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """df, broadcast if it is within BROADCAST_ROWS; its rows must be of fixed width."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: A key counts as hot if it has more than one row in so many; there are as many hot keys at most.
HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, n: str = "n") -> DataFrame:
    """rows joined to groups (one row for each of the keys, with n rows of rows) without gathering a hot key's rows in one task.

    total bounds the number of rows. The groups of hot keys are HOT_SHARE at most,
    so they are broadcast and their rows stay where they are; all others are
    joined by a shuffle.
    """
    hot = groups.where(F.col(n) > max(total // HOT_SHARE, 1))
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(groups.where(F.col(n) <= max(total // HOT_SHARE, 1)), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest).drop(n)


#: Rows (tens of bytes each) that one task may take of one key; where there are no more in all, no key is split.
FEW_ROWS = 1_000_000
#: Parts that the rows of a hot key are dealt to.
PARTS = 32


def join_parts(rows: DataFrame, groups: DataFrame, keys: list[str], total: int, n: str = "n") -> DataFrame:
    """join_groups() that reads rows once: the rows of a hot key are dealt to PARTS tasks by their hash, and its group goes to each of these."""
    if total <= FEW_ROWS:
        return rows.join(groups.drop(n), keys)
    hot = F.col(n) > max(total // HOT_SHARE, FEW_ROWS // PARTS)
    marks = F.broadcast(groups.where(hot).select(*keys, F.lit(True).alias("_hot")))  # HOT_SHARE rows at most
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS))).otherwise(0)
    dealt = rows.join(marks, keys, "left").withColumn("_part", part.cast("int")).drop("_hot")
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(groups.withColumn("_part", F.explode(parts)).drop(n), [*keys, "_part"]).drop("_part")


def positional(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its columns named p0, p1, ..., so that no name of a caller's clashes with ours; and these names."""
    inside = [f"p{k}" for k in range(len(docs.columns))]
    return docs.toDF(*inside), inside


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves no remainder by 5 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.Table]:
    """Pieces of the batches of about `most` text bytes each (one row at least); null texts become empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        column = pc.fill_null(t[text].combine_chunks().cast(pa.large_string()), "")
        t = t.set_column(t.column_names.index(text), text, column)
        ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield t.slice(at, to - at).combine_chunks()
            at = to


def plain(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """The rows of the column as one array."""
    out = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(out, pa.ChunkedArray):
        out = pa.concat_arrays(out.chunks) if out.num_chunks else pa.array([], out.type)
    return out


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one entry more than texts)."""
    starts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def split_flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The strings of all lists, and where each list begins."""
    flat = lists.flatten()
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), out=starts[1:])
    return flat, starts


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts: codes, where each text begins, and the distinct words."""
    flat, starts = split_flat(pc.ascii_split_whitespace(texts))
    found = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not found.all():
        kept = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(found, out=kept[1:])
        flat, starts = flat.filter(pa.array(found)), kept[starts]
    coded = flat.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, coded.dictionary


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def distinct_per_row(rows: np.ndarray, codes: np.ndarray, known: int, n: int) -> np.ndarray:
    """How many different codes (below `known`) each of the n rows holds."""
    if not len(codes):
        return np.zeros(n, np.int64)
    key = np.sort(rows * known + codes)
    return np.bincount(key[np.r_[True, key[1:] != key[:-1]]] // known, minlength=n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = np.asarray(x).astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(values: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every run of `width` values inside one text: hashes, their first positions, their texts."""
    n, values = np.diff(starts), np.asarray(values).astype(np.uint64)
    count = np.maximum(n - width + 1, 0)
    owner = np.repeat(np.arange(len(n)), count)
    first = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + starts[owner]
    h = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + values[first + k])
    return h, first, owner


#: Characters of all texts together that a sample takes to the driver for each class.
SAMPLE_CHARS = 24_000_000


def sample_ids(docs: DataFrame, labels: DataFrame, label: str, per_class: int, classes: list, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(id, label) of at most per_class labelled documents of each class that are not held out, and (id, text) of all that are not held out.

    The ids with the smallest hash are taken, so the sample hangs neither on the
    order of rows nor on the texts. An id with two labels counts as the larger one.
    """
    usable = docs.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    marks = labels.where(F.col(label).isin(classes) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label"))
    known = marks.join(usable.select("id").distinct(), "id", "left_semi")
    chosen = None
    for value in classes:
        part = known.where(F.col("label") == F.lit(value)).orderBy(F.xxhash64("id"), "id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return chosen, usable


def learn_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int, classes: list, id_col: str = "doc_id", text_col: str = "text", most_chars: int = SAMPLE_CHARS) -> list[tuple]:
    """At most per_class (label, text) of each class, from documents that are not held out; the sample of sample_ids().

    Whole texts are taken, the empty ones too (null counts as empty); of an id with
    several texts the least. Together those of a class have most_chars characters at
    most: in the order of the sample, a text that no longer fits is passed over.
    """
    chosen, usable = sample_ids(docs, labels, label, per_class, classes, id_col, text_col)
    # per_class * len(classes) rows at most
    sizes = usable.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.max(F.length("text")).alias("n"), F.xxhash64("id").alias("h"))
    left, take = dict.fromkeys(classes, most_chars), []
    for r in sorted(sizes.collect(), key=lambda r: (r["h"], r["id"])):
        if r["n"] <= left[r["label"]]:
            left[r["label"]] -= r["n"]
            take.append((r["id"], r["label"]))
    fields = [chosen.schema["id"], chosen.schema["label"]]
    taken = docs.sparkSession.createDataFrame(take, T.StructType(fields))
    texts = usable.join(F.broadcast(taken), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    return sorted((r["label"], r["id"], r["text"]) for r in texts.collect())


def cut_at_spaces(data: bytes, width: int) -> list[bytes]:
    """Pieces of about width bytes that end at white space where there is any within another width; joined they give data."""
    out, at = [], 0
    while len(data) - at > width + width // 2:
        to = data.find(b" ", at + width, at + 2 * width)
        to = at + 2 * width if to < 0 else to + 1
        out.append(data[at:to])
        at = to
    out.append(data[at:])
    return out
