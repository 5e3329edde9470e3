"""Packing documents into windows of equal length.

Full windows are cut off the front of each document. What is left of every
document is shorter than a window; the histogram of these lengths is covered by
shallow combinations of lengths that fill a window exactly: non-negative least
squares gives how often each combination is repeated, the counts are rounded
down, and a greedy pass over the combinations takes what still fits. The
remaining lengths are laid end to end, longest first, and cut at the windows'
borders; the last, partly filled window is cut into powers of two. So no window
has padding, and a document is cut only where no combination takes it.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from tokenizers import Tokenizer

from .common import cut, plain, slices, text_bytes, words

WINDOW = 2048
END_ID = 1
#: Combinations hold up to this many copies of each of two lengths, or three different lengths.
COPIES = 8
#: At most so many combinations of three lengths enter the least-squares problem: those of the most common lengths.
TRIPLES = 20_000
NNLS_ROUNDS = 400
#: Counts of rows by part and length that are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_CELLS = 1_000_000
MEMO_WORDS = 400_000
#: Text bytes that a task encodes at a time: the more, the fewer words it meets anew.
SLICE = 12 << 20
PLAIN_WORD = re.compile(r"[a-zß-öø-ÿ]+")


# ---------------------------------------------------------------- token ids


class Encoder:
    """Ids by the tokenizers library, word by word.

    The vocabulary drops white space and its words never reach across it, nor from
    a letter into punctuation, so a text's ids are those of its words in order,
    with the punctuation after a letter as a word of its own. New words that are
    letters only go through the library many at a time, parted by their
    end-of-word tokens.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        self.tool, self.most = tokenizer(path), memo_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        if max(self.tool.get_vocab().values()) >= 1 << 16:
            raise ValueError(f"{path}: ids beyond 16 bits")
        known = self.encode(["It's  a\tTEST, of 3 words;and (more)!"])[0], self.encode([" ".join(["it", "'s", "a", "test", ",", "of", "3", "words", ";", "and", "(", "more", ")!"])])[0]
        if known[0] != known[1]:
            raise ValueError(f"{path}: its words are not those between white space and punctuation, in lower case")
        self.ends = np.zeros(max(self.tool.get_vocab().values()) + 1, bool)
        if suffix:
            self.ends[[v for k, v in spec["model"]["vocab"].items() if k.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.row, self.flat, self.size = {}, [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def keep(self, found: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.row.update(zip(found, range(len(self.row), len(self.row) + len(found))))
        self.flat.append(ids)
        self.size.append(size)

    def learn(self, new: list[str]) -> None:
        easy, rest = [], []
        for w in new:
            (easy if w.isascii() and w.isalpha() and w.islower() or PLAIN_WORD.fullmatch(w) else rest).append(w)
        for k in range(0, len(easy), 2000):
            part = easy[k : k + 2000]
            ids = np.array(self.encode([" ".join(part)])[0], np.uint16)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self.keep(part, ids, np.diff(stops, prepend=0))
            else:
                rest += part
        if rest:
            ids = self.encode(rest)
            self.keep(rest, np.array([i for x in ids for i in x], np.uint16), np.array([len(x) for x in ids], np.int64))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins."""
        special = bool(pc.any(pc.match_substring(texts, "<|")).as_py())
        codes, starts, known = words(apart(texts if special else pc.ascii_lower(texts)))
        known = known.to_pylist()
        if len(self.row) + len(known) > self.most:
            self.forget()
        self.learn([w for w in known if w not in self.row])
        self.flat, self.size = [np.concatenate(self.flat)], [np.concatenate(self.size)]
        rows = np.fromiter(map(self.row.__getitem__, known), np.int64, len(known))
        at = (np.cumsum(self.size[0]) - self.size[0])[rows]
        many = self.size[0][rows][codes]
        total = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(many, out=total[1:])
        where = np.repeat(at[codes] - total[:-1], many)
        where += np.arange(total[-1])
        return self.flat[0][where], total[starts]


LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
MARK[list(b".,;:!?")] = True


def apart(texts: pa.Array) -> pa.Array:
    """The texts with a space between each ASCII letter and punctuation after it."""
    data, ends = text_bytes(texts)
    at = np.flatnonzero(LETTER[data[:-1]] & MARK[data[1:]]) + 1 if len(data) else np.zeros(0, np.int64)
    ends = ends + np.searchsorted(at, ends, "left")
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.insert(data, at, 32)))


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def token_rows(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """For every row: its id, ids (binary of unsigned 16-bit numbers, END_ID last) and their number n.

    part is the task that read the row, tail the tokens beyond full windows, k the
    row's rank among the part's rows of that tail, full the number of full windows
    of the part before it.
    """

    def run(batches):
        encode, part = Encoder(path), TaskContext.get().partitionId()
        seen, full = np.zeros(window, np.int64), 0
        for piece in slices(batches, "t", SLICE):
            ids, starts = encode(plain(piece["t"]))
            count = len(starts) - 1
            data = np.insert(ids, starts[1:], END_ID).astype("<u2")
            ends = (starts + np.arange(count + 1)) * 2
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            n = np.diff(ends) // 2
            tail, whole = n % window, n // window
            order = np.argsort(tail, kind="stable")
            first = np.r_[True, np.diff(tail[order]) != 0] if count else np.zeros(0, bool)
            k = np.empty(count, np.int64)
            k[order] = np.arange(count) - np.maximum.accumulate(np.where(first, np.arange(count), 0)) + seen[tail[order]]
            seen += np.bincount(tail, minlength=window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, part, np.int32)), pa.array(tail), pa.array(k), pa.array(full + np.cumsum(whole) - whole), plain(piece["i"]), column, pa.array(n)],
                ["part", "tail", "k", "full", "id", "ids", "n"],
            )
            full += int(whole.sum())

    fields = [("part", T.IntegerType()), ("tail", T.LongType()), ("k", T.LongType()), ("full", T.LongType()), ("id", docs.schema[id_col].dataType), ("ids", T.BinaryType()), ("n", T.LongType())]
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


# ---------------------------------------------------------------- the plan


def combinations(counts: np.ndarray, window: int) -> list[tuple[tuple[int, int], ...]]:
    """((length, copies), ...) that fill a window exactly, of lengths that occur."""
    have = np.flatnonzero(counts)
    out = []
    for a in have:
        if window % a == 0 and window // a <= COPIES:
            out.append(((int(a), int(window // a)),))
    present = counts > 0
    for p in range(1, COPIES + 1):
        for q in range(1, COPIES + 1):
            a = have[have * p < window]
            rest = window - p * a
            b = rest // q
            good = (rest % q == 0) & (b > a) & (b < window)
            good[good] &= present[b[good]]
            out += [((int(x), p), (int(y), q)) for x, y in zip(a[good], b[good])]
    # three different lengths, by the count of the rarest
    tri = []
    for a in have[have < window // 3]:
        b = have[(have > a) & (have < window - a)]
        c = window - a - b
        good = (c > b) & (c < window)
        good[good] &= present[c[good]]
        if good.any():
            b, c = b[good], c[good]
            tri.append(np.stack([np.full(len(b), a), b, c, np.minimum(counts[a], np.minimum(counts[b], counts[c]))], 1))
    if tri:
        rows = np.concatenate(tri)
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0], -rows[:, 3]))[:TRIPLES]]
        out += [((int(a), 1), (int(b), 1), (int(c), 1)) for a, b, c, _ in rows]
    return out


def nnls(columns: list[tuple[tuple[int, int], ...]], target: np.ndarray, rounds: int = NNLS_ROUNDS) -> np.ndarray:
    """x >= 0 that makes the weighted sum of the columns come near the target: accelerated projected gradient."""
    if not columns:
        return np.zeros(0)
    row = np.array([a for c in columns for a, _ in c])
    col = np.array([j for j, c in enumerate(columns) for _ in c])
    val = np.array([float(k) for c in columns for _, k in c])
    times = lambda x: np.bincount(row, val * x[col], len(target))
    back = lambda y: np.bincount(col, val * y[row], len(columns))
    v = np.ones(len(columns))
    for _ in range(20):
        v = back(times(v))
        v /= np.linalg.norm(v)
    step = 1 / (np.linalg.norm(back(times(v))) * 1.05)
    x = z = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(z - step * back(times(z) - target), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> tuple[list[tuple], np.ndarray]:
    """[(combination, repeats)] within the counts of each length, and the counts left over."""
    left = counts.astype(np.int64).copy()
    columns = combinations(counts, window)
    x = nnls(columns, counts.astype(float))
    out: dict[tuple, int] = {}
    order = np.argsort(-x, kind="stable")
    for take_all in (False, True):  # the rounded solution first, then whatever still fits
        for j in order:
            c = columns[j]
            most = min(int(left[a]) // k for a, k in c)
            n = most if take_all else min(most, int(x[j]))
            if n > 0:
                out[c] = out.get(c, 0) + n
                for a, k in c:
                    left[a] -= n * k
    return list(out.items()), left


def layout(counts: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Where the k-th row of each length goes.

    spans: rows (length, first rank, end rank, first sequence, offset of the
    first copy, copies): ranks of a length in one combination, `copies` of them
    to a sequence. stream: for each length its first rank that goes to the end-
    to-end stream, and the stream position where those ranks begin.
    """
    chosen, left = plan(counts, window)
    used, sequence, spans = np.zeros(len(counts), np.int64), 0, []
    for c, n in chosen:
        offset = 0
        for a, k in c:
            spans.append((a, used[a], used[a] + n * k, sequence, offset, k))
            used[a] += n * k
            offset += a * k
        sequence += n
    sizes = left * np.arange(len(counts))
    start = np.zeros(len(counts), np.int64)
    start[::-1] = np.cumsum(sizes[::-1]) - sizes[::-1]  # the longest first
    total = int(sizes.sum())
    return {"spans": np.array(sorted(spans), np.int64).reshape(-1, 6), "used": used, "start": start, "total": total, "sequence": sequence}


def stream_pieces(start: int, n: int, total: int, window: int) -> list[tuple[int, int, int, int]]:
    """(first token, length, window number, offset) of n tokens at a stream position; the last window is cut into powers of two."""
    out, at, end, whole = [], start, start + n, total // window * window
    while at < end:
        if at < whole:
            k, low, high = at // window, at // window * window, at // window * window + window
        else:
            low, rest, k = whole, total - whole, whole // window
            while True:
                size = 1 << (rest.bit_length() - 1)
                if at < low + size:
                    break
                low, rest, k = low + size, rest - size, k + 1
            high = low + size
        to = min(end, high)
        out.append((at - start, to - at, k, at - low))
        at = to
    return out


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of docs is packed with END_ID after its ids; a null or empty text is
    that id alone. Repeated rows are packed each on its own. keep_ids adds the
    piece's ids (little-endian unsigned 32-bit). The driver gets one count for
    each length below the window. Ranks within a length come from counts of each
    part, so that a length of many rows is not gathered anywhere. An empty table
    gives an empty result; columns other than the two are not read.
    """
    rows = cut(token_rows(docs, path, id_col, text_col, window), "tokens")
    cells = rows.where("tail > 0").groupBy("part", "tail").agg(F.count("*").alias("rows"))
    earlier = W.partitionBy("tail").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each part at most
    cells = cut(cells.select("part", "tail", "rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")), "cells")
    totals = cells.groupBy("tail").agg(F.sum("rows").alias("rows"), F.count("*").alias("cells")).collect()
    counts = np.zeros(window, np.int64)
    for r in totals:
        counts[r["tail"]] = r["rows"]
    side = cells.select("part", "tail", "before")
    if sum(r["cells"] for r in totals) <= BROADCAST_CELLS:
        side = F.broadcast(side)
    placed = rows.join(side, ["part", "tail"], "left")
    return pieces(placed, layout(counts, window), id_col, window, keep_ids)


def pieces(placed: DataFrame, to: dict, id_col: str, window: int = WINDOW, keep_ids: bool = False) -> DataFrame:
    """The pieces of rows of token_rows() with `before`, the rows of their tail in earlier parts."""
    spans, used, start, total, base = to["spans"], to["used"], to["start"], to["total"], to["sequence"]
    span_key = spans[:, 0] * (1 << 40) + spans[:, 1]

    def tail_pieces(tail: int, rank: int) -> list[tuple[int, int, int, int]]:
        if rank < used[tail]:
            _, first, _, sequence, offset, copies = spans[np.searchsorted(span_key, tail * (1 << 40) + rank, "right") - 1]
            turn, copy = divmod(rank - int(first), int(copies))
            return [(0, tail, int(sequence) + turn, int(offset) + copy * tail)]
        at = int(start[tail]) + (rank - int(used[tail])) * tail
        return [(a, n, base + k, o) for a, n, k, o in stream_pieces(at, tail, total, window)]

    def run(batches):
        for batch in batches:
            rows, out, kept = batch.to_pydict(), [], []
            for name, data, n, part, full, tail, k, before in zip(*(rows[c] for c in ("id", "ids", "n", "part", "full", "tail", "k", "before"))):
                ids = np.frombuffer(data, "<u2").astype("<u4")
                cuts = [(j * window, window, (1 << 62) + (part << 36) + full + j, 0) for j in range(n // window)]
                if tail:
                    cuts += [(n - tail + a, m, q, o) for a, m, q, o in tail_pieces(tail, k + before)]
                for a, m, q, o in cuts:
                    piece = ids[a : a + m].tobytes()
                    out.append((name, a, m, zlib.crc32(piece), n, q, o))
                    if keep_ids:
                        kept.append(piece)
            columns = [pa.array(c, pa.int64() if j else batch.schema.field("id").type) for j, c in enumerate(zip(*out) if out else [()] * 7)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_ids, names + ["ids"] * keep_ids)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField("id", placed.schema["id"].dataType), *[T.StructField(n, T.LongType()) for n in names[1:]]]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * keep_ids)
    return placed.mapInArrow(run, schema).withColumnRenamed("id", id_col)
