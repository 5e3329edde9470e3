"""Ranked lexical search: exact inner products by a ball tree of sparse vectors.

A document's vector holds, for each term of the items, what one mention of it in an
item adds to the score; an item's vector holds how often it mentions a term, so the
score is their inner product. Terms that no item holds change no score and are left
out of the vectors (counts of documents and lengths are over all terms).

Documents are indexed in blocks, each with a balanced tree: a node is split at the
median of the line between two of its documents that lie far apart, and is known by
a centre (the largest entries of its mean), the radius around it that holds its
documents, and how far they reach along each single term. No document of a node
scores more than the item's product with the centre and its length times the
radius; nor, as no entry is negative, more than its product with the reaches, which
is the closer bound where a node holds few of the item's terms. An item takes the
node with the highest bound next, and stops when it is below the TOP-th best score
known; documents of a leaf are scored in whole numbers. Bounds are rounded up by
more than floating point can lose, so rounding costs time, never a result.

The index is read twice: first each item looks at the best leaf of every block
only, and what it finds bounds its TOP-th best score from below; then all leaves
that this bound does not rule out are scored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import cut, drop, plain, slices, split_flat, text_bytes

TOP = 20
#: Items are answered together as long as their texts have about so many bytes.
ITEM_BYTES = 4 << 20
#: A block of the index has at most so many documents, and entries of all documents (one document at least).
BLOCK_DOCS, BLOCK_ENTRIES = 4096, 1 << 19
#: Documents of a leaf, and entries of a centre, at most.
LEAF, CENTRE = 32, 256
#: What sums of floating-point numbers may lose is far below this share of them.
SLACK = 1e-9

_KEEP = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
BYTES = np.full(256, 0x20, np.uint8)
BYTES[_KEEP] = _KEEP
BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


# ---------------------------------------------------------------- terms


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of all texts: codes, where each text begins, and the distinct terms. All bytes that are in no term count as spaces."""
    data, ends = text_bytes(texts)
    spaced = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(BYTES[data]))
    flat, starts = split_flat(pc.ascii_split_whitespace(spaced))
    found = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not found.all():
        kept = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(found, out=kept[1:])
        flat, starts = flat.filter(pa.array(found)), kept[starts]
    coded = plain(flat.dictionary_encode())
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), starts, coded.dictionary


def entries(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each text its number of terms; and the entries (text, term of known, times), by text and term."""
    codes, starts, distinct = terms(texts)
    of = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    term = of[codes] if len(codes) else codes
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[term >= 0]
    key, times = np.unique(row * max(len(known), 1) + term[term >= 0], return_counts=True)
    return np.diff(starts), key // max(len(known), 1), key % max(len(known), 1), times


class Items:
    """Items that are answered together: the distinct terms of all, and each one's terms and how often it holds them."""

    def __init__(self, texts: list[str]):
        column = pa.array(texts, pa.large_string())
        _, _, self.known = terms(column)
        _, row, self.term, self.times = entries(column, self.known)
        self.at = np.searchsorted(row, np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.at) - 1

    def terms(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        return self.term[self.at[q] : self.at[q + 1]], self.times[self.at[q] : self.at[q + 1]]


# ---------------------------------------------------------------- counts and vectors


def counts(docs: DataFrame, known: pa.Array) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all of them, and how many documents hold each known term: one row a term and task. docs: (i, t)."""

    def run(batches):
        total, held = np.zeros(2, np.int64), np.zeros(len(known), np.int64)
        for piece in slices(batches, "t"):
            n, _, term, _ = entries(plain(piece["t"]), known)
            total += ((n > 0).sum(), n.sum())
            held += np.bincount(term, minlength=len(held))
        if total[0]:
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some]), pa.array(np.r_[total, held[some]])], ["term", "n"])

    found = dict(docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect())
    return found.get(-2, 0), found.get(-1, 0), np.array([found.get(k, 0) for k in range(len(known))], np.int64)


def weights(n: int, held: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * h + 1))) for h in held.tolist()], np.int64)


def impacts(times: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a mention adds, before its term's weight; length: of the entry's document."""
    if len(length) and 25 * int(length.max()) * n >= 1 << 63:
        share = np.array([25 * x * n // total for x in length.tolist()], np.int64)
    else:
        share = 25 * length * n // max(total, 1)
    return 1_000_000_000 * times // (1000 * times + 12 * (75 + share))


class Tree:
    """A block's documents in the order of its tree.

    ids; entries at[d] to at[d + 1] of (term, value). Nodes: ranges of documents,
    parents before children, the root first; radius. Reaches, by term: those of
    some[k] are reach_at[k] to reach_at[k + 1] of (node, centre, reach).
    """

    FIELDS = {
        "ids": np.int64, "at": np.int64, "term": np.int32, "value": np.int64, "first": np.int32, "last": np.int32, "left": np.int32, "right": np.int32, "radius": np.float64,
        "some": np.int32, "reach_at": np.int64, "node": np.int32, "centre": np.float32, "reach": np.float32,
    }

    @classmethod
    def build(cls, ids: np.ndarray, at: np.ndarray, term: np.ndarray, value: np.ndarray, width: int) -> Tree:
        """The tree of documents with whole-number entries, one at least; width: one more than the largest term."""
        self, x = cls(), value.astype(float)
        square = np.add.reduceat(x * x, at[:-1])
        order, nodes, centres = np.arange(len(ids)), [], []
        dense = np.zeros(width)

        def rows(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Positions of the documents' entries, and where each document's begin among them."""
            n = at[docs + 1] - at[docs]
            begin = np.cumsum(n) - n
            return np.arange(n.sum()) - np.repeat(begin - at[docs], n), begin

        def times(spots: np.ndarray, begin: np.ndarray, vector: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x[spots] * vector[term[spots]], begin)

        def spread(doc: int) -> np.ndarray:
            out = np.zeros(width)
            out[term[at[doc] : at[doc + 1]]] = x[at[doc] : at[doc + 1]]
            return out

        todo = [(0, len(ids), -1, False)]
        while todo:
            a, b, parent, is_right = todo.pop()
            docs, me = order[a:b], len(nodes)
            spots, begin = rows(docs)
            if parent >= 0:
                nodes[parent][3 if is_right else 2] = me
            # the mean, of which the centre keeps the largest entries; any centre will do, if the radius is measured from it
            dense[:] = 0
            np.add.at(dense, term[spots], x[spots])
            some = np.flatnonzero(dense)
            if len(some) > CENTRE:
                some = np.sort(some[np.argpartition(dense[some], -CENTRE)[-CENTRE:]])
            mean = (dense[some] / len(docs)).astype(np.float32)
            dense[:] = 0
            dense[some] = mean
            own = float(dense @ dense)
            far = square[docs] - 2 * times(spots, begin, dense) + own
            radius = float(np.sqrt(np.maximum(far, 0) + SLACK * (square[docs] + own)).max()) * (1 + SLACK)
            nodes.append([a, b, -1, -1, radius, parent])
            centres.append((np.full(len(some), me), some, mean))
            if b - a > LEAF:
                line = spread(docs[int(np.argmax(far))])
                two = docs[int(np.argmax(square[docs] - 2 * times(spots, begin, line)))]
                place = times(spots, begin, spread(two) - line)
                order[a:b] = docs[np.lexsort((ids[docs], place))]
                middle = a + (b - a + 1) // 2
                todo += [(middle, b, me, True), (a, middle, me, False)]
        spots, begin = rows(order)
        self.ids, self.at, self.term, self.value = ids[order], np.r_[begin, len(spots)], term[spots], value[spots]
        self.first, self.last, self.left, self.right, self.radius, parent = (np.array(c) for c in zip(*nodes))

        # reaches: largest entries of each leaf and term, then of each node from those of its children
        def largest(node: np.ndarray, terms: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key = terms.astype(np.int64) * len(nodes) + node
            by = np.argsort(key, kind="stable")
            new = np.flatnonzero(np.r_[True, np.diff(key[by]) > 0])
            return node[by][new], terms[by][new], np.maximum.reduceat(reach[by], new)

        leaf_of = np.zeros(len(ids), np.int64)
        for k in np.flatnonzero(self.left < 0):
            leaf_of[self.first[k] : self.last[k]] = k
        level = largest(np.repeat(leaf_of, np.diff(self.at)), self.term, self.value.astype(float))
        found = [level]
        while (up := parent[level[0]] >= 0).any():
            level = largest(parent[level[0]][up], level[1][up], level[2][up])
            found.append(level)
        node, terms, reach = largest(*(np.concatenate(c) for c in zip(*found)))
        c_node, c_term, c_value = (np.concatenate(c) for c in zip(*centres))
        centre = np.zeros(len(node), np.float32)
        centre[np.searchsorted(terms * len(nodes) + node, c_term * len(nodes) + c_node)] = c_value
        up = reach.astype(np.float32)
        self.node, self.centre, self.reach = node, centre, np.where(up < reach, np.nextafter(up, np.float32(np.inf)), up)
        self.some, edge = np.unique(terms, return_index=True)
        self.reach_at = np.r_[edge, len(terms)]
        return self

    def pack(self) -> list[bytes]:
        return [np.asarray(getattr(self, k), t).tobytes() for k, t in self.FIELDS.items()]

    @classmethod
    def unpack(cls, columns: list) -> Tree:
        self = cls()
        for (k, t), data in zip(cls.FIELDS.items(), columns):
            setattr(self, k, np.frombuffer(data, t))
        return self

    def bounds(self, term: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each node a score that none of its documents exceeds, for an item that holds each term so many times."""
        at = np.minimum(np.searchsorted(self.some, term), len(self.some) - 1)
        held = self.some[at] == term
        at, times = at[held], times[held].astype(float)
        n = self.reach_at[at + 1] - self.reach_at[at]
        spots = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.reach_at[at], n)
        weight = np.repeat(times, n)
        product, reach = (np.bincount(self.node[spots], weight * column[spots], len(self.radius)) for column in (self.centre, self.reach))
        return np.minimum(product + math.sqrt(float(times @ times)) * self.radius, reach) * (1 + SLACK) + 1

    def scores(self, node: int, query: np.ndarray) -> np.ndarray:
        """The exact scores of a leaf's documents. query: how often the item holds each term."""
        a, b = self.first[node], self.last[node]
        x, y = self.at[a], self.at[b]
        return np.add.reduceat(query[self.term[x:y]] * self.value[x:y], self.at[a:b] - x)


class Best:
    """The TOP best (score, id) of an item, ties to the smaller id; below: a score that the last of them is known to reach."""

    def __init__(self, k: int, below: int):
        self.k, self.least, self.score, self.ids = k, max(below, 1), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.least
        if good.any():
            score, ids = np.r_[self.score, score[good]], np.r_[self.ids, ids[good]]
            order = np.lexsort((ids, -score))[: self.k]
            self.score, self.ids = score[order], ids[order]
            if len(order) == self.k:
                self.least = max(self.least, int(self.score[-1]))


def visit(tree: Tree, term: np.ndarray, times: np.ndarray, query: np.ndarray, best: Best, leaves: int | None = None) -> int:
    """Best-first search of a tree for an item's terms (query: the same, by term); stops after so many leaves, if given. Returns how many leaves it scored."""
    bound = tree.bounds(term, times)
    todo, seen = [(-bound[0], 0)], 0
    while todo and seen != leaves:
        top, node = heapq.heappop(todo)
        if -top < best.least:
            break
        if tree.left[node] < 0:
            best.add(tree.scores(node, query), tree.ids[tree.first[node] : tree.last[node]])
            seen += 1
            continue
        for child in (int(tree.left[node]), int(tree.right[node])):
            heapq.heappush(todo, (-bound[child], child))
    return seen


# ---------------------------------------------------------------- the operator

_INDEX = ", ".join(f"{k} binary" for k in Tree.FIELDS)


def index(docs: DataFrame, items: Items, weight: np.ndarray, n: int, total: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A row for each block of the index of docs (i, t). Documents without an id or without a term of the items are in none."""
    known, width = items.known, max(len(items.known), 1)

    def run(batches):
        held, docs_held, entries_held = [], 0, 0

        def block():
            ids, size, term, value = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in Tree.build(ids, np.r_[0, np.cumsum(size)], term, value, width).pack()], list(Tree.FIELDS))

        for piece in slices(batches, "t"):
            ids = plain(piece["i"])
            length, row, term, times = entries(plain(piece["t"]), known)
            value = weight[term] * impacts(times, length[row], n, total)
            size = np.bincount(row, minlength=len(length))
            usable = (size > 0) & np.asarray(ids.is_valid())
            at, ids = np.r_[0, np.cumsum(size)], np.asarray(ids.fill_null(0))
            for d in np.flatnonzero(usable).tolist():
                if held and (docs_held == block_docs or entries_held + size[d] > BLOCK_ENTRIES):
                    yield block()
                    held, docs_held, entries_held = [], 0, 0
                held.append((ids[d : d + 1], size[d : d + 1], term[at[d] : at[d + 1]], value[at[d] : at[d + 1]]))
                docs_held, entries_held = docs_held + 1, entries_held + int(size[d])
        if held:
            yield block()

    return docs.mapInArrow(run, _INDEX)


def search(blocks: DataFrame, items: Items, k: int, below: np.ndarray, leaves: int | None = None) -> DataFrame:
    """(q, doc_id, score): of each item (by number) the k best documents of each task's blocks that score `below` at least; leaves: so many of each block only."""
    width = max(len(items.known), 1)

    def run(batches):
        best = [Best(k, x) for x in below.tolist()]
        query = np.zeros(width, np.int64)
        for batch in batches:
            for j in range(batch.num_rows):
                tree = Tree.unpack([batch.column(c)[j].as_buffer() for c in range(len(Tree.FIELDS))])
                for q, found in enumerate(best):
                    term, times = items.terms(q)
                    if len(term):
                        query[term] = times
                        visit(tree, term, times, query, found, leaves)
                        query[term] = 0
        for q, found in enumerate(best):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.ids), q)), pa.array(found.ids), pa.array(found.score)], ["q", "doc_id", "score"])

    return blocks.mapInArrow(run, "q long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = TOP, item_bytes: int = ITEM_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_col, rank, doc_id and score: the k best documents of each item that score above 0; equal scores by the smaller id.

    Null and empty texts have no terms: such an item finds nothing, such a document
    is found by none and counts in no statistic. Documents of a null id count, but
    are not listed. Repeated documents are listed each; repeated items are answered
    each. Texts of any length are read whole. Empty tables give an empty result.
    Other columns are not read, so their names may be any. More items than fit
    item_bytes are answered in several passes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("t")).where(F.length("t") > 0)
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    passes = -(-size // item_bytes)
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item", "t"), F.lit(max(passes, 1))))
    schema = T.StructType([T.StructField("q", T.LongType()), T.StructField("item", items.schema[item_col].dataType)])
    out = None
    for turn in range(passes):
        rows = asked.where(F.col("pass") == turn).select("item", "t").collect()  # about item_bytes
        batch = Items([r["t"] for r in rows])
        n, total, held = counts(texts, batch.known)
        blocks = cut(index(texts, batch, weights(n, held), n, total, block_docs), "trees")
        order = W.partitionBy("q").orderBy(F.desc("score"), "doc_id")
        first = search(blocks, batch, k, np.ones(len(batch), np.int64), 1)
        first = first.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).where(F.col("r") == k)
        below = np.ones(len(batch), np.int64)
        for r in first.collect():  # one row an item
            below[r["q"]] = r["score"]
        found = search(blocks, batch, k, below)
        found = cut(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
        drop(blocks)
        names = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(rows)], schema)
        found = found.join(F.broadcast(names), "q").select(F.col("item").alias(item_col), "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(item_col, items.schema[item_col].dataType), T.StructField("rank", T.IntegerType(), False), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return out
