"""Toxicity by compression distance.

Two zstandard dictionaries of equal size are filled, one from toxic and one from
ordinary text, with short cuts (SPAN bytes and up to the next space: one to three
words) of the learning texts. The toxic one takes the cuts that set toxic texts
apart: those that hold words which a larger share of toxic than of ordinary texts
holds, by their log-likelihood ratio. So labels choose words here, and the
compressors tell how much of a word is found again. Dictionaries of longer
passages chosen by compression alone, and windows of several words, were tried and
found too few toxic texts; the figures are in the README.
The ordinary one takes the ordinary passages that come nearest to them: those
that share the most of their words and runs of bytes, so that the surroundings
of a toxic passage, and what merely resembles it, cost the same under both.

A window is a word with spaces around it (punctuation counts as space, and words
over WINDOW_BYTES are cut), after LEAD bytes that both dictionaries hold equally
far back. What it saves under the toxic dictionary is its gain; equal windows are
compressed once. A text is judged by its best stretch of STRETCH windows, so that
evidence neither shrinks nor adds up with the length of what stands around it; a
logistic calibration, fitted on learning rows under dictionaries that have not
seen them, makes it a probability.
"""

from __future__ import annotations

import heapq
import math
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SAMPLE_CHARS, cut_at_spaces, held_out, learn_rows, plain, slices, text_bytes, words
from .language_id import FILL, compressor

PER_CLASS = 2000
#: Bytes of toxic passages; twice as many of ordinary ones, of which both dictionaries end with the same half.
PASSAGE_BYTES = 4_000
#: Passages are cut at white space after so many bytes.
SPAN = 12
#: Ordinary passages that the ordinary dictionary is chosen from, spread evenly over all of the learning texts: a bound of the fit alone.
CANDIDATES = 60_000
#: Log-likelihood ratio from which a word tells toxic texts: about one word in 5,000 of no meaning reaches it by chance.
TELLING = 14.0
#: Runs of bytes by which passages are found alike.
GRAM = 5
WINDOW_BYTES = 64
#: Windows to a stretch; each stretch begins half a stretch after the last.
STRETCH = 128
#: Gains that are counted, and the largest that is told apart.
STEPS, MOST = (2, 3, 4, 5, 6), 8
MARKS = b".,;:!?\"'()"
WORD = re.compile(rb"[^\s.,;:!?\"'()]+")
#: Bytes of base before each window: with a match before it, one match and two of a window differ by whole bytes.
LEAD = 14
LEVEL = 9
#: The calibration sees each part of the learning texts under dictionaries of the other parts.
FOLDS = 4
#: Rounds of choosing best stretches.
CHOICES = 5
#: Windows whose gains a task keeps from one batch to the next; beyond it starts anew.
MEMO_WINDOWS = 400_000


# ---------------------------------------------------------------- dictionaries


def telling_words(toxic: list[bytes], ordinary: list[bytes]) -> tuple[dict[bytes, float], Counter]:
    """Log-likelihood ratios, from TELLING on, of words that a larger share of toxic than of ordinary texts hold; and how many ordinary texts hold each word."""
    a, b = Counter(), Counter()
    for texts, into in ((toxic, a), (ordinary, b)):
        for text in texts:
            into.update(set(WORD.findall(text)))
    n, m, out = len(toxic), len(ordinary), {}
    for w, c in a.items():
        if c * m <= b[w] * n:
            continue
        both = (c + b[w]) / (n + m)
        ratio = 2 * (c * math.log(c / n / both) + (b[w] * math.log(b[w] / m / both) if b[w] else 0))
        if ratio >= TELLING:
            out[w] = ratio
    return out, b


def chosen(worth: dict[bytes, tuple[Iterable, float]], weight: dict, most: int) -> list[bytes]:
    """Passages in order of worth, until `most` bytes are full: worth[passage] is what it holds and what it costs.

    What has been taken before counts less each time it is taken again. Equal
    worths go by the passages' bytes, so the order of texts does not matter.
    """
    taken: Counter = Counter()
    value = lambda p: sum(weight[u] / (1 + taken[u]) ** 2 for u in worth[p][0]) - worth[p][1]
    heap = [(-value(p), p) for p in worth]
    heapq.heapify(heap)
    out, size = [], 0
    while heap:
        _, p = heapq.heappop(heap)
        now = -value(p)
        if heap and now > heap[0][0]:  # what it holds has been taken since
            heapq.heappush(heap, (now, p))
            continue
        passage = p.strip() + b" "
        if now >= 0 or size + len(passage) > most:
            break
        out.append(passage)
        size += len(passage)
        taken.update(worth[p][0])
    return out


def units(passage: bytes) -> set[bytes]:
    """The runs of GRAM bytes and the words of a passage by which it is compared with others."""
    padded = b" " + passage
    return {padded[k : k + GRAM] for k in range(len(padded) - GRAM + 1)} | {b"=" + w for w in WORD.findall(passage)}


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> dict[str, bytes]:
    """What the toxic dictionary (extra) and the ordinary one (plain) begin with, and what both end with (base); base and plain are ordinary passages."""
    telling, seen = telling_words(toxic, ordinary)
    worth = {}
    for passage in {p for text in toxic for p in cut_at_spaces(text, SPAN)}:
        found = set(WORD.findall(passage))
        if marks := {w for w in found if w in telling}:
            # rare words around telling ones would gain where they stand in ordinary texts
            worth[passage] = (sorted(marks), sum(max(0.0, 4 - math.log2(1 + seen[w])) for w in found - marks))
    extra = chosen(worth, {w: math.sqrt(x) for w, x in telling.items()}, PASSAGE_BYTES)
    size = sum(map(len, extra))
    counts = Counter(u for p in extra for u in units(p))
    known = {u: k for k, u in enumerate(sorted(counts))}
    # words weigh more than runs of bytes
    weight = {known[u]: math.sqrt(c) * (4 if u[:1] == b"=" else 1) for u, c in counts.items()}
    passages = sorted({p for text in ordinary for p in cut_at_spaces(text, SPAN)})
    near = {}
    for passage in passages[:: max(1, len(passages) // CANDIDATES)]:
        if not any(w in telling for w in WORD.findall(passage)):
            near[passage] = (sorted(known[u] for u in units(passage) if u in known), 0.0)
    base = chosen(near, weight, size)
    used = set(base)
    plain_ = chosen({p: x for p, x in near.items() if p.strip() + b" " not in used}, weight, size)
    return {"extra": b"".join(extra), "plain": b"".join(plain_), "base": b"".join(base)}


def tools(model: dict) -> tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]:
    return compressor(model["plain"] + model["base"], LEVEL), compressor(model["extra"] + model["base"], LEVEL)


# ---------------------------------------------------------------- scores


class Gains:
    """What each window saves under the toxic dictionary; keeps gains from batch to batch."""

    def __init__(self, model: dict, memo_windows: int = MEMO_WINDOWS):
        (self.ordinary, self.toxic), self.memo, self.most = tools(model), {}, memo_windows
        self.lead = model["base"][:LEAD] + b" "

    def gain(self, word: bytes) -> int:
        pieces = [word[k : k + WINDOW_BYTES] for k in range(0, len(word), WINDOW_BYTES)]
        return max(len(self.ordinary.compress(p)) - len(self.toxic.compress(p)) for p in (self.lead + p + b" " + FILL for p in pieces))

    def __call__(self, known: list[bytes]) -> np.ndarray:
        if len(self.memo) + len(known) > self.most:
            self.memo = {}
        memo = self.memo
        for w in known:
            if w not in memo:
                memo[w] = min(max(self.gain(w), 0), MOST)
        return np.fromiter(map(memo.__getitem__, known), np.int64, len(known))


SPACED = np.arange(256, dtype=np.uint8)
SPACED[list(MARKS)] = 32


def spaced(texts: pa.Array) -> pa.Array:
    """The texts in lower case, with a space for each mark."""
    data, ends = text_bytes(pc.utf8_lower(texts))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(SPACED[data]))


def features(texts: pa.Array, gains: Gains) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch of each text the largest gain, the roots of how many windows gain STEPS bytes and more, and the logged number of windows; and where each text's stretches begin."""
    codes, starts, known = words(spaced(texts))
    gain = gains(known.cast(pa.large_binary()).to_pylist())[codes] if len(codes) else np.zeros(0, np.int64)
    n = np.diff(starts)
    half = STRETCH // 2
    count = np.maximum(-(-(n - half) // half), 1)
    at = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    owner = np.repeat(np.arange(len(n)), count)
    first = np.maximum(np.minimum((np.arange(at[-1]) - at[owner]) * half, n[owner] - STRETCH), 0)
    size = np.minimum(n[owner], STRETCH)
    begin = starts[owner] + first

    def many(step: int) -> np.ndarray:
        total = np.zeros(len(gain) + 1, np.int64)
        np.cumsum(gain >= step, out=total[1:])
        return total[begin + size] - total[begin]

    counts = {k: many(k) for k in range(1, MOST + 1)}
    largest = sum((c > 0).astype(float) for c in counts.values())
    return np.stack([largest, *(np.sqrt(counts[k]) for k in STEPS), np.log(np.maximum(size, 1))], 1), at


def best(odds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretch of the largest odds of each text (the first of equals)."""
    order = np.lexsort((-np.arange(len(odds)), odds, np.repeat(np.arange(len(at) - 1), np.diff(at))))
    return order[at[1:] - 1]


def fold(k: int, toxic: list[str], ordinary: list[str]) -> dict | list[tuple[np.ndarray, np.ndarray]]:
    """features() of each FOLDS-th ordinary and toxic text from the k-th, under dictionaries of the others; for k = FOLDS the dictionaries of all."""
    chosen_texts = ([t.lower().encode() for j, t in enumerate(texts) if j % FOLDS != k] for texts in (toxic, ordinary))
    found = dictionaries(*chosen_texts)
    if k == FOLDS:
        return found
    gains = Gains(found)
    return [features(pa.array(texts[k::FOLDS], pa.large_string()), gains) for texts in (ordinary, toxic)]


def fit(toxic: list[str], ordinary: list[str], counts: dict[int, int], mapped=map) -> dict:
    """The model of learning texts of both classes; counts: labels of each class; mapped: what maps a function over numbers."""
    if not toxic or not ordinary:
        return {"extra": b"", "plain": b"", "base": b"", "weights": [0.0] * (len(STEPS) + 3)}
    *folds, found = mapped(lambda k: fold(k, toxic, ordinary), range(FOLDS + 1))
    parts, at, y = [], [0], []
    for k, both in enumerate(folds):
        for label, (x, ends) in enumerate(both):
            parts.append(x)
            at += (ends[1:] + at[-1]).tolist()
            y += [label] * (len(ends) - 1)
    x, at, y = np.concatenate(parts), np.array(at), np.array(y, float)
    weight = np.where(y == 1, counts.get(1, 1) / len(toxic), counts.get(0, 1) / len(ordinary))
    pick = best(x[:, 2], at)
    for _ in range(CHOICES):  # which stretch is the best hangs on the weights, and these on the best stretches
        w = fit_logistic(x[pick], y, weight)
        pick = best(x @ w[:-1], at)
    return found | {"weights": w.tolist()}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    weight = weight * len(weight) / weight.sum()
    w = np.zeros(x.shape[1])
    hold = ridge * np.r_[np.ones(x.shape[1] - 1), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + hold * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(hold + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


# ---------------------------------------------------------------- the operator


def in_tasks(spark: SparkSession) -> Callable[[Callable[[int], object], range], list]:
    """A map over a few numbers, each in a task of its own; what the function holds (the bounded sample) goes to the tasks, and what it gives comes back."""

    def mapped(f: Callable[[int], object], numbers: range) -> list:
        def run(batches):
            for batch in batches:
                for k in batch.column("id").to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps(f(k))], pa.binary())], ["id", "found"])

        rows = spark.range(numbers.start, numbers.stop, 1, len(numbers)).mapInArrow(run, "id long, found binary").collect()
        return [pickle.loads(r["found"]) for r in sorted(rows, key=lambda r: r["id"])]

    return mapped


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS, most_chars: int = SAMPLE_CHARS) -> dict:
    """The dictionaries and the calibration, from at most per_class rows and most_chars characters of each class that are not held out (see learn_rows())."""
    rows = learn_rows(docs, labels, label, per_class, [0, 1], id_col, text_col, most_chars)
    counts = {r["y"]: r["n"] for r in labels.where(F.col(label).isin([0, 1]) & ~held_out(id_col)).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    return fit([t for y, _, t in rows if y], [t for y, _, t in rows if not y], counts, in_tasks(docs.sparkSession))


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score (0 to 1) of every whole text.

    A null text counts as empty: one stretch without windows. Repeated rows and
    equal texts get equal scores; a long text gets that of its best stretch. An
    empty table gives an empty result. Columns other than the two are not read.
    """

    def run(batches):
        gains, w = Gains(model), np.array(model["weights"])
        for piece in slices(batches, "t"):
            x, at = features(plain(piece["t"]), gains)
            odds = x @ w[:-1]
            odds = odds[best(odds, at)] + w[-1]
            yield pa.RecordBatch.from_arrays([plain(piece["i"]), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], ["i", "score"])

    schema = T.StructType([T.StructField("i", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, schema)
    return rows.withColumnRenamed("i", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score and predicted for every row of docs; with no labelled row of a class, every score is 0.5."""
    out = score_toxicity(docs, learn(docs, labels, label, id_col, text_col), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
