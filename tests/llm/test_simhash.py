from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from campuslake.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    w = WORD.findall((text or "").translate(LOWER))
    parts = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, prints, radius=2):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for a in range(len(ids)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {}
    for i, k in zip(ids, label):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    return [least.get(k) for k in label]


def texts():
    rnd = random.Random(2)
    base = [[rnd.choice(["one", "two", "Three", "vier", "fünf", "SIX", " x"]) for _ in range(rnd.randrange(20, 90))] for _ in range(25)]
    out = [" ".join(b) for b in base] + [" ".join(b[:-1]) for b in base] + [" ".join([*b, "more"]) for b in base]
    return out + [None, "", " \n\t ", "a", "A", "a b", "a  b", "a b c", "ÄB c d", "x " * 5000, "x " * 5001]


def test_fingerprints():
    rows = texts()
    assert simhash.fingerprints(pa.array([t or "" for t in rows], pa.large_string())).tolist() == [brute_print(t) for t in rows]
    assert simhash.fingerprints(pa.array([], pa.large_string())).tolist() == []


def test_a_text_longer_than_what_is_spread_at_once(monkeypatch):
    monkeypatch.setattr(simhash, "SPREAD", 7)
    rows = texts()[:40]
    assert simhash.fingerprints(pa.array([t or "" for t in rows], pa.large_string())).tolist() == [brute_print(t) for t in rows]


def test_neighbours_are_all_tiles_within_the_radius():
    rng = np.random.default_rng(3)
    f = rng.integers(0, 2**63, 300).astype(np.uint64)
    for radius in (0, 1, 2, 3):
        moved = f.copy()
        for _ in range(radius):
            moved ^= np.uint64(1) << rng.integers(0, 64, len(f)).astype(np.uint64)
        a, b = simhash.tile_of(f), simhash.tile_of(moved)
        at, to = simhash.earlier(np.maximum(a, b), radius)
        reached = set(zip(at.tolist(), to.tolist()))
        assert all(x == y or (k, min(x, y)) in reached for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())))
        assert (to < np.maximum(a, b)[at]).all() and len(reached) == len(at)


@pytest.mark.parametrize("block", [4, 4096])
def test_groups(spark, block):
    # fingerprints on purpose: one dense tile, its neighbours, chains and copies
    rng = random.Random(4)
    prints = [0, 0, 3, 2**64 - 1, 2**63]
    for _ in range(60):
        prints.append(rng.getrandbits(64))
        prints.append(prints[-1] ^ 1 << rng.randrange(64))
        prints.append(prints[-1] ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    prints += [0xFF00 | 1 << a | 1 << b for a in range(40, 56) for b in range(a)]
    ids = rng.sample(range(1000), len(prints))
    nodes = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p, int(simhash.tile_of(np.array([p], np.uint64))[0])) for p in set(prints)], "f long, tile long")
    calls, _ = simhash.dealt(nodes, 2, block)
    assert calls.groupBy("tile", "x", "y").count().agg(F.max("count")).first()[0] <= (300 * block if block == 4 else 10_000)
    found = simhash.links(calls, 2).collect()
    assert len(found) == len({tuple(r) for r in found})
    rows = sorted(set(prints))
    at = {p: k for k, p in enumerate(rows)}
    label = np.arange(len(rows))
    a, b = (np.array([at[x % 2**64] for x in c]) for c in zip(*found))
    pairs = simhash.forest(a, b, len(rows))
    label[pairs[1]] = pairs[0]
    want = brute_groups(list(range(len(rows))), rows)
    assert label.tolist() == want
    assert len(ids) == len(prints)


def test_operator(spark):
    rows = texts()
    ids = [n * 3 for n in range(len(rows))] + [500, 500, None, None]
    rows += [rows[0], rows[0], rows[1], "no one else has this text at all"]
    df = spark.createDataFrame([(i, t, n, "c", n) for n, (i, t) in enumerate(zip(ids, rows))], "doc_id long, text string, f int, tile string, component_id int").repartition(3)
    got = simhash.simhash_near_dedup(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [brute_print(t) for t in rows]
    want = list(zip(ids, [f"{p:016x}" for p in prints], brute_groups(ids, prints)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert simhash.simhash_near_dedup(df.limit(0)).count() == 0


def test_forest_connects_what_the_links_connect():
    rng = np.random.default_rng(6)
    for _ in range(30):
        n = int(rng.integers(1, 60))
        i, j = rng.integers(0, n, (2, int(rng.integers(0, 80))))
        a, b = simhash.forest(i, j, n)
        label = np.arange(n)
        for _ in range(n):
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
        mine = np.arange(n)
        mine[b] = a
        assert mine.tolist() == label.tolist()
