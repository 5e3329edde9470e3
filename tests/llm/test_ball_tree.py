from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from campuslake.llm import ball_tree

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    held = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in TERM.findall((text or "").translate(LOWER)) if c[t])
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(n=300, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(200)] + ["Äpfel", "日本", "x y", "a1b2"]
    weight = [1 / (k + 1) for k in range(len(vocabulary))]
    line = lambda m: " ".join(rnd.choices(vocabulary, weight, k=m))
    items = [(k, line(12)) for k in range(10)]
    docs = [(k, line(rnd.randrange(1, 60))) for k in range(n)]
    docs += [(n + k, f"{line(20)} {items[k % 10][1].upper()}, {line(20)}") for k in range(15)]
    docs = [(k, f"everywhere {t}") for k, t in docs] + [(n + 60 + k, "everywhere") for k in range(40)]  # a term of weight 0 in every document
    items += [(20, "everywhere"), (21, "everywhere w3")]
    docs += [(n + 20 + k, docs[3][1]) for k in range(30)]  # ties
    return docs, items


@pytest.mark.parametrize("block", [7, 4096])
def test_ranked_search(spark, block):
    docs, items = corpus()
    docs += [(900, None), (901, ""), (902, " ,.;\n"), (903, "w1 w2 " * 20_000), (None, "w1 w2 w3"), (904, "w5"), (904, "w5"), (905, "a\x00w6`w7{w8")]
    items += [(50, None), (51, ""), (52, "!?"), (53, "unheard of"), (54, "w1 w1 w1 W2"), (54, "w1 w1 w1 W2"), (None, "w9 w3"), (55, "w6")]
    df = spark.createDataFrame([(i, t, n, n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, score int, rank int").repartition(3)
    asked = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(items)], "item_id int, text string, doc_id int")
    got = ball_tree.ranked_search(df, asked, block_docs=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = brute(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    several = ball_tree.ranked_search(df, asked, item_bytes=200)
    assert sorted((tuple(r) for r in several.collect()), key=str) == want


def test_ranked_search_of_nothing(spark):
    empty, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    none, asked = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "two")], "item_id long, text string")
    for d, i in ((empty, asked), (some, none), (empty, none)):
        assert ball_tree.ranked_search(d, i).collect() == []
    assert [tuple(r) for r in ball_tree.ranked_search(some, asked).collect()] == brute([(1, "one two")], [(1, "two")])


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(8)
    pick = lambda topic: np.unique(np.r_[rng.integers(topic * 40, topic * 40 + 40, 12), rng.integers(0, 400, 2)])
    rows = [pick(d % 10) for d in range(1500)]
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    term, value = np.concatenate(rows), rng.integers(1, 10**10, at[-1])
    tree = ball_tree.Tree.unpack(ball_tree.Tree.build(np.arange(1500), at, term, value, 400).pack())
    assert sorted(tree.ids.tolist()) == list(range(1500))
    scored = 0
    for topic in range(10):
        query = np.zeros(400, np.int64)
        asked = pick(topic)
        query[asked] = 1
        exact = np.array([(query[term[at[d] : at[d + 1]]] * value[at[d] : at[d + 1]]).sum() for d in range(1500)])
        bound = tree.bounds(asked, query[asked])
        for node in range(len(bound)):
            assert exact[tree.ids[tree.first[node] : tree.last[node]]].max() <= bound[node]
        best = ball_tree.Best(5, 1)
        scored += ball_tree.visit(tree, asked, query[asked], query, best)
        want = sorted((-s, d) for d, s in enumerate(exact.tolist()) if s)[:5]
        assert list(zip((-best.score).tolist(), best.ids.tolist())) == want
    assert scored < 5 * (tree.left < 0).sum()  # subtrees are left out


def test_lengths_beyond_64_bits():
    got = ball_tree.impacts(np.array([3]), np.array([10**10]), 10**9, 10**12)
    assert got.tolist() == [(10**9 * 3) // (1000 * 3 + 12 * (75 + 25 * 10**10 * 10**9 // 10**12))]


def test_terms_are_those_of_the_pattern():
    rnd = random.Random(9)
    texts = ["".join(chr(rnd.choice([rnd.randrange(128), rnd.randrange(128, 0x3000)])) for _ in range(50)) for _ in range(200)]
    codes, starts, known = ball_tree.terms(pa.array(texts, pa.large_string()))
    known = known.to_pylist()
    assert [[known[c] for c in codes[a:b]] for a, b in zip(starts[:-1], starts[1:])] == [TERM.findall(t.translate(LOWER)) for t in texts]
