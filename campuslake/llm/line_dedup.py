"""Line deduplication on a suffix array of line ids, built by prefix doubling.

The lines of all documents make one long sequence of line ids. The suffix array
of depth h holds the positions in the order of the h lines from there on, inside
their documents. A position's rank is how many positions come before its equals,
so that equal ranks are an interval whose longest common prefixes reach h. The
array of depth 2h is the order of the pairs (rank at the position, rank h lines
on): one shuffle and one range-partitioned sort of the distinct pairs a round. A
position that has no equal any more drops out: its longest common prefix with any
other is known to be shorter, and only repeated runs are looked for.

A run of at least `min_words` words that also begins earlier is a later copy, and
its lines are deleted. Every maximal repeated run is covered by its shortest
sub-runs of min_words words (from each line onward, and up to each line), so only
these are looked up: positions whose longest common prefix reaches n lines are
those with equal ranks of depth 2^k at the run's first line and 2^k lines before
its end, where 2^k <= n <= 2^(k+1). A line has a word at least, so no run is
longer than min_words lines, and the array needs no greater depth.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import cut, drop, join_groups, per_text, plain, positional, slices, split_flat, text_bytes, words

MIN_WORDS = 50
#: Documents with later copies, and runs of them, that are broadcast to the texts (16 bytes each).
BROADCAST_RUNS = 500_000


def shortest_runs(size: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line, how many lines from it onward (and up to it) hold `least` words within its document; 0 if too few are left."""
    before = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=before[1:])
    n = np.diff(starts)
    end, begin = np.repeat(starts[1:], n), np.repeat(starts[:-1], n)
    at = np.arange(len(size))
    to = np.searchsorted(before, before[:-1] + least, "left")  # first position with so many words before it
    forth = np.where(to <= end, to - at, 0)
    frm = np.searchsorted(before, before[1:] - least, "right") - 1
    back = np.where((before[1:] >= least) & (frm >= begin), at + 1 - frm, 0)
    return forth, back


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """A row for each line with a word: row number u and id d of its document, place p among those lines, words w, shortest runs, and the line's text."""

    def run(batches):
        for piece in slices(batches, "t"):
            flat, at = split_flat(pc.split_pattern(plain(piece["t"]), "\n"))
            _, ends, _ = words(flat)
            size = np.diff(ends)
            full = size > 0
            n = per_text(full, at)
            starts = np.zeros(len(n) + 1, np.int64)
            np.cumsum(n, out=starts[1:])
            size = size[full]
            forth, back = shortest_runs(size, starts, min_words)
            owner = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [plain(piece["u"]).take(owner), plain(piece["d"]).take(owner), pa.array(np.arange(len(size)) - np.repeat(starts[:-1], n)), pa.array(size, pa.int32()), pa.array(forth, pa.int32()), pa.array(back, pa.int32()), flat.filter(pa.array(full)).cast(pa.string())],
                ["u", "d", "p", "w", "forth", "back", "line"],
            )

    rows = docs.mapInArrow(run, "u long, d long, p long, w int, forth int, back int, line string")
    # two hashes with different seeds stand for the text
    return rows.select("u", "d", "p", "w", "forth", "back", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def ranked(groups: DataFrame, keys: list[str]) -> DataFrame:
    """groups (a row for each of the keys, with n positions) and rank: how many positions of groups come before in the order of the keys; as a written table.

    The groups are dealt out by ranges of the keys; the driver gets one sum for
    each range.
    """
    dealt = cut(groups.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "ranges")
    before, total = [], 0
    for r in dealt.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        before.append((r["range"], total))
        total += r["n"]
    starts = groups.sparkSession.createDataFrame(before, "range int, start long")
    inside = F.sum("n").over(W.partitionBy("range").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1))
    rank = F.col("start") + F.coalesce(inside, F.lit(0).cast("long"))
    out = cut(dealt.join(F.broadcast(starts), "range").withColumn("rank", rank).drop("range", "start"), "ranks")
    drop(dealt)
    return out


def repeated(lines: DataFrame, min_words: int) -> DataFrame:
    """(u, p, d, rank, forth, back): lines that are repeated, with the rank of their id, in stretches of repeated lines of min_words words or more; as a written table.

    A shortest run that reaches beyond its stretch holds a line that is found
    nowhere else, and is left out (0).
    """
    groups = ranked(lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"), ["a", "b"])
    active = join_groups(lines, groups, ["a", "b"], lines.count()).select("u", "d", "p", "w", "rank", "forth", "back")
    active = active.withColumn("stretch", F.col("p") - F.row_number().over(W.partitionBy("u").orderBy("p")))
    whole = W.partitionBy("u", "stretch")
    active = active.withColumns({"held": F.sum("w").over(whole), "low": F.min("p").over(whole), "high": F.max("p").over(whole)}).where(F.col("held") >= min_words)
    inside = {"forth": F.col("p") + F.col("forth") - 1 <= F.col("high"), "back": F.col("p") - F.col("back") + 1 >= F.col("low")}
    out = cut(active.select("u", "d", "p", "rank", *[F.when(fits, F.col(c)).otherwise(0).alias(c) for c, fits in inside.items()]), "repeated")
    drop(groups)
    return out


def suffix_arrays(first: DataFrame, min_words: int) -> list[DataFrame]:
    """Written tables (u, d, p, rank): the k-th is the suffix array of depth 2^k, of the positions that are not alone there; the first of them is `first`."""
    active, out, h = first.select("u", "d", "p", "rank"), [first], 1
    while 2 * h <= min_words:
        ahead = F.first("rank").over(W.partitionBy("u").orderBy("p").rangeBetween(h, h))
        pairs = active.withColumn("next", ahead).where(F.col("next").isNotNull()).withColumnRenamed("rank", "here")
        groups = ranked(pairs.groupBy("here", "next").agg(F.count("*").alias("n")).where("n > 1"), ["here", "next"])
        active = cut(join_groups(pairs, groups, ["here", "next"], active.count()).select("u", "d", "p", "rank"), "array")
        drop(groups)
        if active.isEmpty():
            drop(active)
            break
        out.append(active)
        h *= 2
    return out


def later_copies(lines: DataFrame, min_words: int) -> DataFrame:
    """(u, runs), as a written table: of each document the runs (p, n) of n lines from line p that also begin earlier, as far as shortest runs go."""
    first = repeated(lines, min_words)
    levels = suffix_arrays(first, min_words)
    named = None
    for k, level in enumerate(levels):
        level = level.select("u", "p", "rank", F.lit(k).alias("k"))
        named = level if named is None else named.unionByName(level)
    forth = first.where("forth > 0").select("u", "d", "p", F.col("forth").alias("n"))
    back = first.where("back > 0").select("u", "d", (F.col("p") - F.col("back") + 1).alias("p"), F.col("back").alias("n"))
    runs = forth.unionByName(back).distinct()
    runs = runs.withColumn("k", F.length(F.bin(F.col("n").cast("long"))) - 1)
    runs = runs.withColumn("q", F.col("p") + F.col("n") - F.expr("shiftleft(1, k)"))
    runs = runs.join(named.select("u", "p", "k", F.col("rank").alias("x")), ["u", "p", "k"])
    runs = runs.join(named.select("u", F.col("p").alias("q"), "k", F.col("rank").alias("y")), ["u", "q", "k"])
    runs = cut(runs.select("u", "d", "p", "n", "x", "y"), "runs")
    # equal n, x and y are an interval of longest common prefixes of n lines and more
    heads = runs.groupBy("n", "x", "y").agg(F.min(F.struct("d", "u", "p")).alias("first"), F.count("*").alias("many")).where("many > 1")
    later = join_groups(runs, heads, ["n", "x", "y"], runs.count(), "many").where(F.struct("d", "u", "p") != F.col("first"))
    out = cut(later.groupBy("u").agg(F.collect_list(F.struct("p", "n")).alias("runs")), "later")
    drop(runs, *levels)
    return out


def without(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text less the runs (first line, lines; counted among lines with a word), and how many lines with a word went.

    Blank lines between two deleted lines of overlapping or touching runs go with them.
    """
    lines = text.split("\n")
    full = [i for i, s in enumerate(lines) if s.strip(" \t\n\v\f\r")]
    gone, drop, last = set(), set(), -1
    for p, n in sorted(runs):
        last = max(last, p - 1)
        for q in range(last + 1, p + n):
            gone.add(q)
        last = max(last, p + n - 1)
    for q in gone:
        drop.add(full[q])
        if q + 1 in gone:
            drop.update(range(full[q], full[q + 1]))
    return "\n".join(s for i, s in enumerate(lines) if i not in drop), len(gone)


SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\v\f\r")] = True


def full_lines(texts: pa.Array) -> np.ndarray:
    """How many lines with a word each text has."""
    data, ends = text_bytes(texts)
    starts = np.sort(np.concatenate([ends[:-1], np.flatnonzero(data == 10) + 1]))
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=before[1:])
    full = starts[before[np.r_[starts[1:], len(data)]] > before[starts]] if len(starts) else starts
    # an empty text begins where the next one does: a line with a word is the last one's
    return np.bincount(np.searchsorted(ends, full, "right") - 1, minlength=len(texts))[: len(texts)].astype(np.int64)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """docs with text_col less its later copies, and two counts of lines with a word: all, and those removed.

    The earlier of two copies is that in the document of the smaller id (null
    first; among rows repeated with an id, in the order read), then the one nearer
    the beginning. Copies inside one document count; lines are equal if their
    texts are. Null and empty texts have no lines and stay as they are; texts and
    lines of any length are taken whole. An empty table gives an empty result.
    Other columns are kept, whatever their names; those named as counts are replaced.
    """
    docs = docs.drop(*counts)
    names = docs.columns
    rows, inside = positional(docs)
    t, i = inside[names.index(text_col)], inside[names.index(id_col)]
    rows = rows.withColumn("u", F.monotonically_increasing_id())
    rows = cut(rows, "documents")
    lines = cut(line_rows(rows.select("u", F.col(i).cast("long").alias("d"), F.col(t).alias("t")), min_words), "lines")
    gone = later_copies(lines, min_words)
    drop(lines)
    many = gone.agg(F.count("*") + F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0]
    # beyond the bound the texts are shuffled to their runs
    joined = rows.join(F.broadcast(gone) if many <= BROADCAST_RUNS else gone, "u", "left").drop("u")
    joined = joined.withColumn("missing", F.col(t).isNull())

    def run(batches):
        for piece in slices(batches, t):
            columns = {c: plain(piece[c]) for c in inside}
            n, removed, texts = full_lines(columns[t]), np.zeros(len(piece), np.int64), columns[t].cast(pa.string())
            at = np.flatnonzero(plain(piece["runs"]).is_valid().to_numpy(zero_copy_only=False))
            if len(at):  # all other texts pass as they are
                runs = plain(piece["runs"])
                less = [without(texts[i].as_py(), [(r["p"], r["n"]) for r in runs[i].as_py()]) for i in at.tolist()]
                mask = np.zeros(len(piece), bool)
                mask[at] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([x for x, _ in less], pa.string()))
                removed[at] = [k for _, k in less]
            columns[t] = pc.if_else(plain(piece["missing"]), pa.scalar(None, pa.string()), texts)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(n), pa.array(removed)], [*columns, "n_lines", "n_removed"])

    schema = T.StructType([*joined.select(inside).schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(run, schema).toDF(*names, *counts)
