"""Quality rules by weak supervision.

Every rule votes good (2), bad (0) or abstains (1). The vote patterns of the
whole corpus are counted, expectation-maximisation on the counts estimates how
often the votes of each rule are right, and a document is kept when its
posterior probability of being good reaches a threshold. No rule rejects a
document by itself; only the base test (too few words, or too many words in
repeated windows) does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, plain, slices
from .text_stats import COUNTS, stats

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5
EM_ROUNDS = 100
#: Every rule starts as this accurate, as if it had cast so many votes before; on any corpus of size its own votes tell.
FIRST_ACCURACY = 0.9
HOLD = 10.0


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: list[str] = COUNTS, carry: list[str] | None = None) -> DataFrame:
    """id_col, the named counts of text_col and the columns to carry (as c0, c1, ...), for every row; a null text counts as empty."""
    carry = carry or []
    inside = [f"c{k}" for k in range(len(carry))]

    def run(batches):
        for piece in slices(batches, "text"):
            found = stats(plain(piece["text"]))
            yield pa.RecordBatch.from_arrays([plain(piece["id"]), *[pa.array(found[k]) for k in names], *[plain(piece[k]) for k in inside]], ["id", *names, *inside])

    fields = [T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(k, T.LongType()) for k in names]]
    schema = T.StructType(fields + [T.StructField(k, docs.schema[c].dataType) for k, c in zip(inside, carry)])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(k) for k, c in zip(inside, carry)]).mapInArrow(run, schema)
    return rows.withColumnRenamed("id", id_col)


def votes() -> dict[str, Column]:
    """The rules over COUNTS. A share with nothing to divide by is null, and its rule abstains.

    All but one look for a defect and abstain where they see none: most defects
    leave most rules silent, and silence is no evidence. Each defect shows in two
    rules at least, so that their agreement tells how far to trust them.
    """
    c = F.col
    share = lambda a, b: F.when(b > 0, a / b)
    symbols, bangs = share(c("n_symbols"), c("n_words")), share(c("n_bangs"), c("n_words"))
    upper = share(c("n_upper"), c("n_upper") + c("n_lower"))
    repeat, dup = share(c("n_repeat_words"), c("n_words")), F.when(c("n_lines") > 1, c("n_dup_lines") / c("n_lines"))
    length, variety = share(c("word_chars"), c("n_words")), F.when(c("n_words") >= 20, c("n_distinct") / c("n_words"))
    letters, marks = share(c("n_letter_words"), c("n_words")), share(c("n_marks"), c("n_words"))
    bad = {
        "symbols": symbols > 0.1,
        "shouting": bangs > 0.3,
        "capitals": upper > 0.4,
        "repeats": repeat > 0.25,
        "same_lines": dup > 0.4,
        "word_length": (length < 2.5) | (length > 6.8),
        "variety": variety < 0.35,
        "letters": letters < 0.7,
        "marks": (marks < 0.02) | (marks > 0.8),
    }
    prose = (symbols < 0.02) & (upper < 0.15) & (variety > 0.45) & length.between(4, 6.5) & (letters > 0.9) & marks.between(0.04, 0.5)
    return {k: F.when(v, 0).otherwise(1) for k, v in bad.items()} | {"prose": F.when(prose, 2).otherwise(1)}


def fit_em(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Posterior of class good for each vote pattern.

    patterns: (p, rules) votes in {0, 1, 2}; counts: documents with each pattern.
    A vote is right with its rule's accuracy whichever the class; whether a rule
    votes at all tells nothing. Accuracies stay within 0.5 and 0.99.
    """
    counts = np.asarray(counts, float)
    if not len(patterns):
        return np.zeros(0)
    sign = np.asarray(patterns) - 1
    cast = (counts[:, None] * (sign != 0)).sum(0)
    right, prior, good = np.full(sign.shape[1], FIRST_ACCURACY), 0.5, np.full(len(sign), 0.5)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + sign @ np.log(right / (1 - right))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        agree = (counts[:, None] * np.where(sign > 0, new[:, None], np.where(sign < 0, 1 - new[:, None], 0))).sum(0)
        right = np.clip((agree + HOLD * FIRST_ACCURACY) / (cast + HOLD), 0.5, 0.99)
        prior = float(np.clip((counts @ new + 1) / (counts.sum() + 2), 0.01, 0.99))
        done, good = np.abs(new - good).max() < 1e-9, new
        if done:
            break
    return good


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT, carry: list[str] | None = None) -> DataFrame:
    """id_col, the counts of BASE, the votes, p_good, base_failed and kept for every row of docs.

    carry names further columns of docs to keep, as c0, c1, and so on.

    Null and empty texts have no words: they fail the base test. Repeated rows
    each get a row with equal results. Texts of any length are counted whole. An
    empty table gives an empty result.
    Columns of docs other than id_col and text_col are not read, so their names
    may be any. The driver gets one row for each vote pattern seen: 3 ** rules at
    most, whatever the size of the corpus.
    """
    rules = votes()
    pattern = F.concat(*[v.cast("string") for v in rules.values()]).alias("votes")
    inside = [f"c{k}" for k in range(len(carry or []))]
    rows = cut(text_stats(docs, id_col, text_col, carry=carry).select(F.col(id_col).alias("row_id"), *BASE, pattern, *inside), "votes")
    seen = sorted((r["votes"], r["n"]) for r in rows.groupBy("votes").agg(F.count("*").alias("n")).collect())
    good = fit_em(np.array([[int(v) for v in p] for p, _ in seen]).reshape(len(seen), len(rules)), np.array([n for _, n in seen]))
    model = docs.sparkSession.createDataFrame([(p, float(g)) for (p, _), g in zip(seen, good)], "votes string, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = rows.join(F.broadcast(model), "votes", "left").withColumn("base_failed", failed)
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= keep_at))
    return out.select(F.col("row_id").alias(id_col), *BASE, "base_failed", "kept", "p_good", "votes", *inside)
