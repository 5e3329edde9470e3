"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees grow level by level on binned features, and are kept as flat arrays
(feature, threshold, value) in heap order, so that a batch of documents goes down
a tree with `depth` numpy steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, plain, sample_ids, slices
from .quality_rules import text_stats
from .text_stats import COUNTS, stats

PER_CLASS = 4000
TREES, DEPTH, BINS, RATE, RIDGE, MIN_ROWS = 60, 4, 64, 0.15, 2.0, 12
PREDICT_AT = 0.3


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Statistics of each document that do not grow with its length, and the length itself."""
    c = {k: v.astype(float) for k, v in counts.items()}
    words, lines, letters = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1), np.maximum(c["n_upper"] + c["n_lower"], 1)
    size = np.maximum(c["n_bytes"], 1)
    return np.stack(
        [
            np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
            c["n_words"] / lines, c["n_distinct"] / words, c["n_upper"] / letters, c["n_digits"] / size, c["n_marks"] / words, c["n_stops"] / words,
            c["n_bangs"] / words, c["n_spaces"] / size, c["n_wide"] / size, c["n_letter_words"] / words, c["n_long_words"] / words, c["n_pipes"] / words,
            c["n_lines"],
        ],
        1,
    )


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Boosted trees for the logistic loss. Equal rows give equal trees whatever their order; no rows give a score of 0.5."""
    n, m = x.shape
    nodes = 2**DEPTH - 1
    feature, cut = np.zeros((TREES, nodes), np.int64), np.full((TREES, nodes), np.inf)
    value = np.zeros((TREES, nodes + 1))
    if not n:
        return {"feature": feature, "cut": cut, "value": value, "base": np.array(0.0)}
    weight = weight * n / weight.sum()
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    share = np.clip((weight @ y) / weight.sum(), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        grad, hess = weight * (p - y), np.maximum(weight * p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            best, where = np.zeros(many), {}
            for j in range(m):
                if not len(edges[j]):
                    continue
                cell, width = (at - first) * BINS + binned[:, j], many * BINS
                g, h, c = (np.bincount(cell, w, width).reshape(many, BINS).cumsum(1) for w in (grad, hess, np.ones(n)))
                gain = g**2 / (h + RIDGE) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                gain[(c < MIN_ROWS) | (c[:, -1:] - c < MIN_ROWS)] = 0
                gain = np.round(gain[:, : len(edges[j])], 9)
                k = gain.argmax(1)
                for q in np.flatnonzero(gain[np.arange(many), k] > best + 1e-6):
                    best[q], where[q] = gain[q, k[q]], (j, k[q])
            go = np.zeros(n, np.int64)
            for q, (j, k) in where.items():
                feature[t, first + q], cut[t, first + q] = j, edges[j][k]
                mine = at == first + q
                go[mine] = binned[mine, j] > k
            at = 2 * at + 1 + go
        leaf = at - nodes
        g, h = np.bincount(leaf, grad, nodes + 1), np.bincount(leaf, hess, nodes + 1)
        value[t] = -RATE * g / (h + RIDGE)
        score += value[t][leaf]
    return {"feature": feature, "cut": cut, "value": value, "base": np.array(base)}


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probability of class 1 for each row; every tree is DEPTH array look-ups for the whole batch."""
    rows, total = np.arange(len(x)), np.full(len(x), float(model["base"]))
    nodes = model["feature"].shape[1]
    for feature, cut, value in zip(model["feature"], model["cut"], model["value"]):
        at = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        total += value[at - nodes]
    return 1 / (1 + np.exp(-total))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> dict[str, np.ndarray]:
    """Fit on at most per_class labelled rows of each class that are not held out, weighted back to the classes' true shares.

    The statistics of the sampled texts are counted where the texts are, whole
    (null counts as empty); only the counts come to the driver. Of an id with
    several texts the least enters.
    """
    chosen, usable = sample_ids(docs, labels, label, per_class, [0, 1], id_col, text_col)
    sample = usable.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    # the key of a row: its label and its place in the order of ids
    rows = text_stats(sample.select(F.struct("label", F.col("id").cast("string").alias("id")).alias("key"), "text"), "key", "text").collect()
    rows = sorted(rows, key=lambda r: (r["key"]["label"], str(r["key"]["id"])))
    y = np.array([r["key"]["label"] for r in rows], float)
    x = features({k: np.array([r[k] for r in rows], np.int64) for k in COUNTS})
    counts = {r["y"]: r["n"] for r in labels.where(F.col(label).isin([0, 1]) & ~held_out(id_col)).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    share = {v: counts.get(v, 1) / max((y == v).sum(), 1) for v in (0, 1)}
    return fit(x, y, np.where(y == 1, share[1], share[0]))


def score_quality(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score (0 to 1) of every whole text, however long; a null text counts as empty.

    Repeated rows get equal scores; an empty table gives an empty result. Columns
    other than the two are not read, so their names may be any.
    """

    def run(batches):
        for piece in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([plain(piece["i"]), pa.array(predict(model, features(stats(plain(piece["t"])))))], ["i", "score"])

    schema = T.StructType([T.StructField("i", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, schema)
    return rows.withColumnRenamed("i", id_col)


def quality_classifier(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score and predicted for every row of docs; repeated rows get equal results."""
    out = score_quality(docs, learn(docs, labels, label, id_col, text_col), id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
