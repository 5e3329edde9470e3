"""Exact top-k search by inner product on a bit-sliced index.

A block of vectors is indexed as bitmaps, cut once and written: slice b of
attribute d has a bit for every row whose quantised value, less the attribute's
least one, has bit b. A row's score for a query is the weighted sum of its
attributes.

Each block is read by one task and meets all queries of a pass, some at a time.
First, rows that cannot be among a query's best are ruled out: the slices are
spelled as numbers of single precision, and their product with the queries, plus
more than rounding can lose, is a score that no row exceeds; the query's k-th best
score so far, or the k-th best of the block less what was added, is one that its
result is known to reach. So rounding costs time, never a result. The scores of
the rows left are formed by adding their slices with carry-save adders on whole
bitmaps, a bit for each pair of a query and a row, and come out as slices again;
the best rows are found from the most significant score slice downward, and those
that tie at the border are resolved by their id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import cut

SCALE = 256
#: Rows to a block: 64 of them share a word of each bitmap.
BLOCK_ROWS = 8192
QUERY_EVERY = 50
#: Queries that meet a block at a time, and bytes of the queries of a pass (QUERY_PART of them at least): the driver hands these to the tasks, more are answered in further passes.
QUERY_PART, QUERY_BYTES = 256, 16 << 20
#: Tasks of a pass for each core: each gives k rows a query at most, however many blocks it reads.
TASKS = 4
#: Bits of the rows of pairs (query, row) whose scores are added at a time (the pairs of one query at least): 14,563 pairs at 64 attributes of 9 slices.
PAIR_BITS = 1 << 23
#: Rows of a block of which the largest bound is taken first.
GROUP = 128
TOP = 5
#: The squares of a vector's quantised values sum to less, so that they fit 32 bits and every score 64; other vectors are refused.
BOUND = 1 << 62


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Bits (rows last) as 64-bit words; the rows are filled up with zeros."""
    short = -flags.shape[-1] % 64
    padded = np.concatenate([flags, np.zeros((*flags.shape[:-1], short), bool)], -1) if short else flags
    # flags whose rows do not lie side by side, such as those of a transposed block, are copied first: words are read in place
    return np.packbits(np.ascontiguousarray(padded), axis=-1, bitorder="little").view(np.uint64)


def cut_slices(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """The least value of each attribute, how many slices an attribute has, and the slices (attribute, bit, words) of quantised vectors (rows x attributes)."""
    low = values.min(0) if len(values) else np.zeros(values.shape[1], np.int64)
    moved = (values - low).T
    bits = max(int(moved.max(initial=0)).bit_length(), 1)
    return low, bits, np.stack([bitmap((moved >> b & 1).astype(bool)) for b in range(bits)], 1)


def picked(maps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bitmaps (rows last) of the given rows, which may repeat."""
    return bitmap(maps.view(np.uint8)[..., at >> 3] >> (at & 7).astype(np.uint8) & 1)


def unpacked(maps: np.ndarray, n: int) -> np.ndarray:
    """The first n bits of bitmaps, as bytes."""
    return np.unpackbits(maps.view(np.uint8), axis=-1, count=n, bitorder="little")


class Queries:
    """Queries that meet a block together: block, row and id of each, and their values (queries x attributes); and what is known of each one's k best."""

    def __init__(self, block: np.ndarray, row: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int):
        self.block, self.row, self.ids, self.values, self.k = block, row, ids, values, k
        # the least score that may be among the best, and the best so far: query, score, id, by query and rank
        self.least = np.full(len(ids), -BOUND)
        self.best = np.zeros((3, 0), np.int64)

    def sized(self, width: int) -> np.ndarray:
        """Values for blocks of so many attributes: what either side lacks counts as zeros."""
        return self.values[:, :width] if self.values.shape[1] >= width else np.pad(self.values, ((0, 0), (0, width - self.values.shape[1])))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        found = np.concatenate([self.best, np.stack([query, score, ids])], 1)
        found = found[:, np.lexsort((found[2], -found[1], found[0]))]
        rank = np.arange(found.shape[1]) - np.searchsorted(found[0], found[0])
        self.best = found[:, rank < self.k]
        last = found[:, rank == self.k - 1]
        self.least[last[0]] = last[1]


def row_bound(values: np.ndarray) -> np.ndarray:
    """The length of each vector (last axis), rounded up."""
    return np.sqrt(np.square(values.astype(float)).sum(-1)) * (1 + 1e-9)


class Slices:
    """One block of the index: its rows' ids, and what cut_slices() gave."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, bits: int, ones: np.ndarray, k: int):
        self.ids, self.low, self.bits, self.ones, self.k = ids, low, bits, ones, k
        n = len(ids)
        values = low[:, None] + sum(unpacked(ones[:, b], n).astype(np.int64) << b for b in range(bits))
        # of equal vectors only the k + 1 of the smallest ids can be among the k best of any query, itself left out
        mark = values.T @ (np.random.default_rng(0).integers(1 << 62, size=len(values)) | 1)
        order = np.lexsort((ids, mark))
        same = np.flatnonzero(mark[order[1:]] == mark[order[:-1]]) + 1
        equal, at = np.zeros(n, bool), np.arange(n)
        equal[same] = (values[:, order[same]] == values[:, order[same - 1]]).all(0)
        self.rows = np.sort(order[at - np.maximum.accumulate(np.where(equal, 0, at)) <= k])
        # the same of a query without weights, for which all vectors are equal
        self.first = np.lexsort((self.rows, ids[self.rows]))[: k + 1]
        self.length = row_bound(values[:, self.rows].T)
        short = -len(self.rows) % GROUP
        self.spelled = np.pad(np.concatenate([values[:, self.rows], self.length[None]]), ((0, 0), (0, short))).astype(np.float32)

    def left(self, queries: Queries, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) that may be among the k best of the query, by query; block: this one's number, by which a query's own row is left out."""
        weights = queries.sized(len(self.ones))
        # at least twice what single precision may lose of a product of so many terms
        slack = (4 * len(self.ones) + 32) * 2.0**-24 * row_bound(weights)
        bound = np.concatenate([weights, slack[:, None]], 1).astype(np.float32) @ self.spelled
        bound[:, len(self.rows) :] = -np.inf
        mine = queries.block == block
        if mine.any():
            at = np.minimum(np.searchsorted(self.rows, queries.row), len(self.rows) - 1)
            own = mine & (self.rows[at] == queries.row)
            bound[own, at[own]] = -np.inf
        none = np.flatnonzero(~weights.any(1))
        if len(none):
            other = np.ones(bound.shape[1], bool)
            other[self.first] = False
            bound[np.ix_(none, np.flatnonzero(other))] = -np.inf
        groups = bound.reshape(len(bound), -1, GROUP)
        top = groups.max(2)
        least = queries.least.astype(float)
        if top.shape[1] >= self.k:  # the largest of k groups are k rows, of which the least score is known to be reached
            q = np.arange(len(bound))[:, None]
            best = np.argpartition(top, -self.k, 1)[:, -self.k :]
            row = best * GROUP + groups[q, best].argmax(2)
            some = np.append(self.length, np.zeros(bound.shape[1] - len(self.length)))[row]
            least = np.maximum(least, (bound[q, row] - 2.001 * slack[:, None] * some).min(1))
        least = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
        q, group = np.nonzero(top >= least[:, None])
        pair, at = np.nonzero(groups[q, group] >= least[q, None])
        return q[pair], self.rows[group[pair] * GROUP + at]

    def scores(self, weights: np.ndarray, query: np.ndarray, rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Slices of the scores of pairs (query, row), least significant first, and what to add to the numbers that they spell, for each query.

        The row value of attribute d is low + x; a negative weight takes the
        complement of x instead, so that all additions are of positive numbers.
        What is added is modulo 2**64, as scores are known to fit.
        """
        size = np.abs(weights)
        if not size.any():
            return [], np.zeros(len(weights), np.int64)
        base = weights @ self.low - np.where(weights < 0, size, 0).sum(1) * ((1 << self.bits) - 1)
        x = picked(self.ones, rows) ^ picked(bitmap((weights < 0).T), query)[:, None]
        w = [picked(bitmap((size >> j & 1).T.astype(bool)), query) for j in range(int(size.max(initial=0)).bit_length())]
        out, carries, c = [], [], 0
        while c < self.bits + len(w) - 1 or carries:
            maps = np.concatenate([x[:, c - j] & w[j] for j in range(len(w)) if 0 <= c - j < self.bits] + carries)
            carries = []
            while len(maps) > 1:
                if len(maps) == 2:  # half adder
                    carry, maps = maps[:1] & maps[1:], maps[:1] ^ maps[1:]
                else:
                    n = len(maps) // 3
                    a, b, d, rest = maps[:n], maps[n : 2 * n], maps[2 * n : 3 * n], maps[3 * n :]
                    half = a ^ b
                    carry = a & b | half & d
                    maps = np.concatenate([half ^ d, rest])
                carries.append(carry)
            out.append(maps[0])
            c += 1
        return out, base

    def top(self, slices: list[np.ndarray], query: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are the k best of their query, ties to the smaller id, and the numbers that their slices spell; the pairs are in the order of their queries."""
        bits = unpacked(np.stack(slices), len(rows)).astype(bool) if slices else np.zeros((0, len(rows)), bool)
        start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(rows)]))
        sure, open_, have = np.zeros(len(rows), bool), np.ones(len(rows), bool), np.zeros(len(start), np.int64)
        for s in bits[::-1]:
            high = open_ & s
            n = np.add.reduceat(high, start, dtype=np.int64)
            fits = have + n <= self.k  # all of them are among the best
            have += np.where(fits, n, 0)
            fits = fits[of]
            sure |= high & fits
            open_ = np.where(fits, open_ & ~s, high)
        edge = np.flatnonzero(open_)  # the border: these rows of a query have one score
        edge = edge[np.lexsort((rows[edge], self.ids[rows[edge]], of[edge]))]
        rank = np.arange(len(edge)) - np.searchsorted(of[edge], of[edge])
        sure[edge[rank < (self.k - have)[of[edge]]]] = True
        found = np.flatnonzero(sure)
        spelled = np.zeros(len(found), np.int64)
        for b, s in enumerate(bits[:64, found]):
            spelled += s.astype(np.int64) << b
        return found, spelled

    def meet(self, queries: Queries, block: int) -> None:
        """Adds the block's rows to what is known of the queries' best."""
        query, rows = self.left(queries, block)
        weights = queries.sized(len(self.ones))
        a, most = 0, max(1, PAIR_BITS // (len(self.ones) * self.bits))
        while a < len(rows):
            # as many whole queries as have so many pairs, or one
            b = int(np.searchsorted(query, query[a + most])) if a + most < len(rows) else len(rows)
            b = b if b > a else int(np.searchsorted(query, query[a], "right"))
            asked, of = np.unique(query[a:b], return_inverse=True)
            slices, base = self.scores(weights[asked], of, rows[a:b])
            found, spelled = self.top(slices, of, rows[a:b])
            queries.add(asked[of[found]], spelled + base[of[found]], self.ids[rows[a:b][found]])
            a = b


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and q (floor(256 x) of each component) of the rows that take part: no null or empty vector, no null or non-finite component, no null id.

    A vector whose scores might leave 64 bits (BOUND) makes the query fail.
    """
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    rows = vectors.where(x.isNotNull() & (F.size(x) > 0) & F.col(id_col).isNotNull() & ~bad)
    whole = lambda v: F.floor(v.cast("double") * SCALE)
    squares = F.aggregate(x, F.lit(0.0), lambda total, v: total + whole(v).cast("double") * whole(v).cast("double"))
    refused = F.raise_error(F.concat(F.lit("op1: components too large for 64-bit scores, id "), F.col(id_col).cast("string"))).cast("array<int>")
    return rows.select(F.col(id_col).cast("long").alias("id"), F.when(squares < float(BOUND), F.transform(x, lambda v: whole(v).cast("int"))).otherwise(refused).alias("q"))


INDEX = "block long, width long, bits long, ids binary, low binary, slices binary, q_rows binary, q_ids binary, q_values binary"


def index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, query_every: int = QUERY_EVERY) -> DataFrame:
    """Blocks of about block_rows rows: their slices, and the values of the rows whose id is divisible by query_every. Shorter vectors are filled up with zeros."""
    rows = quantised(vectors, id_col, vector_col)
    # dealt round robin: each task gets about block_rows rows, whatever the ids are, and makes one block
    rows = rows.repartition(max(1, -(-rows.count() // block_rows)))

    def run(batches):
        ids, parts = [], []
        for batch in batches:
            q = batch.column("q")
            sizes = np.diff(np.asarray(q.offsets))
            part = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
            part[np.arange(part.shape[1]) < sizes[:, None]] = np.asarray(q.flatten())
            ids.append(np.asarray(batch.column("id")))
            parts.append(part)
        if ids:
            width = max(p.shape[1] for p in parts)
            values = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
            ids = np.concatenate(ids)
            low, bits, slices = cut_slices(values)
            asked = np.flatnonzero(ids % query_every == 0)
            found = [TaskContext.get().partitionId(), width, bits, ids.tobytes(), low.astype(np.int64).tobytes(), slices.tobytes(), asked.astype(np.int64).tobytes(), ids[asked].tobytes(), values[asked].astype(np.int32).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], [c.split()[0] for c in INDEX.split(", ")])

    return rows.mapInArrow(run, INDEX)


def search(blocks: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of an index() for each of its queries.

    A query meets every row but itself; rows repeated under its id are other rows.
    Every block meets every query: that is the stated query set against all rows,
    block by block. A pass takes QUERY_BYTES of queries, or QUERY_PART of them, to
    all blocks; each of its tasks gives k rows a query at most, and only these are
    shuffled.
    """
    spark = blocks.sparkSession
    sizes = blocks.select("block", "width", (F.length("q_ids") / 8).cast("long").alias("n")).orderBy("block").collect()  # a row a block
    passes, room = [], 0
    for r in sizes:
        for part in range(-(-r["n"] // QUERY_PART)):
            need = min(QUERY_PART, r["n"] - part * QUERY_PART) * (4 * r["width"] + 24)
            if need > room:
                passes.append([(r["block"], part)] * 2)
                room = QUERY_BYTES
            passes[-1][1] = (r["block"], part)
            room -= need
    dealt = blocks.select("block", "width", "bits", "ids", "low", "slices").repartition(max(1, min(len(sizes), TASKS * spark.sparkContext.defaultParallelism)))
    best = None
    for first, last in passes:
        found = dealt.mapInArrow(answers(asked(blocks, first, last), k), "query_id long, q_block long, q_row long, vec_id long, score long")
        best = found if best is None else best.unionByName(found)
    if best is None:
        best = spark.createDataFrame([], "query_id long, q_block long, q_row long, vec_id long, score long")
    order = W.partitionBy("q_block", "q_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def asked(blocks: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> list[tuple[np.ndarray, ...]]:
    """The queries of a pass, from one (block, part) to another: block, row, id and values of QUERY_PART together, all of one width."""
    rows = blocks.where(F.col("block").between(first[0], last[0]) & (F.length("q_ids") > 0))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.length("q_ids") - 1) / (8 * QUERY_PART)).cast("int"))))
    place = lambda at: F.struct(F.lit(at[0]).cast("long"), F.lit(at[1]))
    rows = rows.where(F.struct("block", "part").between(place(first), place(last)))
    part = lambda c, size: F.substring(c, F.col("part") * size * QUERY_PART + 1, size * QUERY_PART).alias(c)
    rows = rows.select("block", "part", "width", part("q_rows", F.lit(8)), part("q_ids", F.lit(8)), part("q_values", 4 * F.col("width").cast("int")))
    by_width: dict[int, list] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["block"], r["part"])):  # about QUERY_BYTES
        ids = np.frombuffer(r["q_ids"], np.int64)
        by_width.setdefault(r["width"], []).append((np.full(len(ids), r["block"]), np.frombuffer(r["q_rows"], np.int64), ids, np.frombuffer(r["q_values"], np.int32).reshape(len(ids), r["width"])))
    out = []
    for held in by_width.values():
        columns = [np.concatenate(c) for c in zip(*held)]
        out += [tuple(c[a : a + QUERY_PART] for c in columns) for a in range(0, len(columns[0]), QUERY_PART)]
    return out


def answers(pieces: list[tuple[np.ndarray, ...]], k: int):
    """For the blocks of a task, the k best rows of each query."""

    def run(batches):
        queries = [Queries(block, row, ids, values.astype(np.int64), k) for block, row, ids, values in pieces]
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n] for c in ("block", "width", "bits", "ids", "low", "slices")}
                block, width, bits = (row[c].as_py() for c in ("block", "width", "bits"))
                ids, low, ones = (np.frombuffer(row[c].as_buffer(), kind) for c, kind in (("ids", np.int64), ("low", np.int64), ("slices", np.uint64)))
                slices = Slices(ids, low, bits, ones.reshape(width, bits, -1), k)
                for some in queries:
                    slices.meet(some, block)
        for some in queries:
            q, score, ids = some.best
            columns = [some.ids[q], some.block[q], some.row[q], ids, score]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["query_id", "q_block", "q_row", "vec_id", "score"])

    return run


def top_k_search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = QUERY_EVERY, k: int = TOP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """search() on the index of vectors, which is written first; without a query or another row the result is empty.

    Null and empty vectors, vectors that hold null or non-finite components and
    rows without an id take no part; ties go to the smaller vec_id. Other columns
    are not read, so their names may be any.
    """
    return search(cut(index(vectors, id_col, vector_col, block_rows, query_every), "index"), k)
