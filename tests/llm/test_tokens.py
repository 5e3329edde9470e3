from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from campuslake.llm import bpe, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "<|endoftext|>", "a<|endoftext|> b<|ENDOFTEXT|>", "  \n\n x  ", "a" * 300, "日本語 テキスト 😀👍🏽", "it's we'll I'd 'S Don't, 12.5", "\x00\x1c\x85\xa0a", "١٢٣ ½ ² ﬁ K ẞ", "x<|startoftext|>y", "word, word. word"]


def texts():
    rng = random.Random(4)
    letters = ["ab th ein r'.\n\t0é", "".join(map(chr, range(32, 600)))]
    return ODD + ["".join(rng.choice(rng.choice(letters)) for _ in range(rng.randrange(400))) for _ in range(300)] + ["long words " * 30_000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, n) for n, t in enumerate(texts())]
    return spark.createDataFrame(rows + [rows[6], (None, "no id", 0)], "doc_id long, text string, n int").repartition(3)


def test_encoding(spark, docs):
    tool = Tokenizer.from_file(BYTE)
    got = bpe.bpe_encode(docs, BYTE, keep_text=True).collect()
    assert len(got) == len(texts()) + 2
    for r in got:
        text = "no id" if r.doc_id is None else texts()[r.doc_id] or ""
        ids = tool.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded == tool.decode(ids, skip_special_tokens=False) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.bpe_encode(docs.where("false"), BYTE).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoding_of_any_text(found):
    tool, encode = Tokenizer.from_file(BYTE) if not hasattr(test_encoding, "tool") else test_encoding.tool, bpe.Encoder(BYTE, bpe.differing(), memo_words=50)
    test_encoding.tool = tool
    for ids, text in zip(encode(found), found):
        assert np.frombuffer(ids, "<u4").tolist() == tool.encode(text, add_special_tokens=False).ids


def test_encoding_of_every_character():
    tool, encode = Tokenizer.from_file(BYTE), bpe.Encoder(BYTE, bpe.differing())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    odd = [c for c in every if encode.vocabulary.odd and encode.vocabulary.odd.match(c)]
    found = [c + "'s" for c in every] + [x for c in odd for x in ("a" + c + "b", " " + c, "1" + c + " " + c + c)]
    for k in range(0, len(found), 100_000):
        part = found[k : k + 100_000]
        for text, ids, want in zip(part, encode(part), tool.encode_batch_fast(part, add_special_tokens=False)):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, text


def check_pieces(pieces, want, window):
    """Every id in one piece, sequences gapless, padding by sequence."""
    docs, sequences, padding = {}, {}, 0
    for p in pieces:
        docs.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"] and p["length"] > 0
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    for i, ids in want.items():
        rows = sorted(docs[i], key=lambda p: p["start"])
        if isinstance(ids, Counter):
            continue
        assert b"".join(p["ids"] for p in rows) == ids
        assert [p["start"] for p in rows] == np.r_[0, np.cumsum([p["length"] for p in rows])[:-1]].tolist() and {p["doc_tokens"] for p in rows} == {len(ids) // 4}
    return padding


def test_packing(spark, docs):
    tool = Tokenizer.from_file(WORD)
    got = [r.asDict() for r in packing.pack(docs.where("doc_id is not null and doc_id <> 6"), WORD, keep_ids=True).collect()]
    want = {n: np.array(tool.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for n, t in enumerate(texts()) if n != 6}
    assert {p["doc_id"] for p in got} == set(want) and check_pieces(got, want, packing.WINDOW) == 0
    twice = [r.asDict() for r in packing.pack(docs.where("doc_id = 6 or doc_id is null"), WORD, keep_ids=True).collect()]
    assert sum(p["length"] for p in twice) == sum(p["doc_tokens"] for p in twice if p["start"] == 0) and check_pieces(twice, {}, packing.WINDOW) == 0
    assert packing.pack(docs.where("false"), WORD).count() == 0


def test_packing_without_a_broadcast(spark, docs, monkeypatch):
    rows = docs.where("doc_id is not null and doc_id <> 6").coalesce(1)
    want = sorted(tuple(r) for r in packing.pack(rows, WORD).collect())
    monkeypatch.setattr(packing, "BROADCAST_CELLS", 0)
    assert sorted(tuple(r) for r in packing.pack(rows, WORD).collect()) == want


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="its words are not"):
        packing.Encoder(BYTE)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=120))
def test_layout_of_any_lengths(lengths):
    window = 64
    counts = np.bincount(np.array(lengths, int), minlength=window)
    to = packing.layout(counts, window)
    chosen, left = packing.plan(counts, window)
    assert (left >= 0).all() and all(sum(a * k for a, k in c) == window for c, _ in chosen)
    assert (sum((n * k * np.eye(window, dtype=int)[a] for c, n in chosen for a, k in c), np.zeros(window, int)) + left == counts).all()
    taken = [p for a in range(1, window) for r in range(int(left[a])) for p in packing.stream_pieces(int(to["start"][a]) + r * a, a, to["total"], window)]
    sizes: dict = {}
    for _, n, k, _ in taken:
        sizes[k] = sizes.get(k, 0) + n
    assert all(v == window or v & (v - 1) == 0 for v in sizes.values()) and sum(sizes.values()) == to["total"]


def test_nnls_reaches_the_least_squares():
    columns = [((2, 1),), ((2, 1), (3, 1)), ((3, 2),)]
    target = np.array([0, 0, 5.0, 4.0])
    x = packing.nnls(columns, target, rounds=3000)
    best = min(((5 - a - b) ** 2 + (4 - b - 2 * c) ** 2 for a in range(6) for b in range(6) for c in range(6)))
    got = (5 - x[0] - x[1]) ** 2 + (4 - x[1] - 2 * x[2]) ** 2
    assert (x >= 0).all() and got <= best + 1e-6
