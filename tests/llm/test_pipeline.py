from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from test_dedup_and_warc import WORD, brute_lines, groups, shingle_set
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from campuslake.llm import language_id, quality_rules

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["1 AS u", "'x' AS kept", "doc_id + 0.5D AS score", "3 AS n_removed", "4 AS c0"]
    again = docs.where("doc_id < 20")  # repeated rows
    nulls = spark.createDataFrame([(None,) * len(docs.columns), (10**6, None, "en", None, None), (10**6 + 1, "", "en", None, 0)], docs.schema)
    return docs.unionByName(again).unionByName(nulls).selectExpr("*", *names).coalesce(1)


@pytest.fixture(scope="module")
def staged(spark, docs, tmp_path_factory):
    """What goes into each stage, and what comes out of the last one."""
    out, now, folder = [docs.collect()], docs, tmp_path_factory.mktemp("stages")
    for k, (_, stage) in enumerate(pipeline.STAGES):
        made = stage(spark, now, SF)
        assert k == len(pipeline.STAGES) - 1 or made.columns == now.columns
        made.coalesce(1).write.parquet(str(folder / str(k)))
        now = spark.read.parquet(str(folder / str(k)))
        out.append(now.collect())
    return out


def plain(rows, *without):
    return Counter(tuple((k, v) for k, v in r.asDict().items() if k not in without) for r in rows)


def test_only_the_last_stage_is_left(spark):
    import os

    from campuslake.llm.common import shared_dir

    held = f"{shared_dir(spark)}/campuslake"
    before = set(os.listdir(held)) if os.path.isdir(held) else set()
    out = pipeline.run(spark, SF)
    assert out.count() > 0
    left = set(os.listdir(held)) - before
    assert len(left) == 1 and os.listdir(f"{held}/{left.pop()}") == [str(len(pipeline.STAGES) - 1)]


def test_quality_keeps_rows_as_they_are(spark, docs, staged):
    before, after = staged[:2]
    verdict = {(r.doc_id, r.c0): r.kept for r in quality_rules.quality_rules(docs, carry=["text"]).collect()}
    assert plain(after) == plain(r for r in before if verdict[r.doc_id, r.text])
    assert all(len(WORD.findall(r.text)) >= 20 for r in after) and len(after) >= 0.5 * len(before)


def test_language_is_what_was_recognised(spark, docs, staged):
    before, after = staged[1:3]
    table = spark.createDataFrame(before, docs.schema).coalesce(1)
    found = {r.doc_id: r for r in language_id.identify(table, language_id.learn(table)).collect()}
    kept = [r for r in before if not found[r.doc_id].rejected]
    assert plain(after, "lang") == plain(kept, "lang") and all(r.lang == found[r.doc_id].lang_pred for r in after)


def test_lines_against_brute_force(staged):
    before, after = staged[2:4]
    want = brute_lines([(r.doc_id, r.text) for r in before], 50)
    left = Counter((r.doc_id, tuple(want[n])) for n, r in enumerate(before) if want[n])
    assert left == Counter((r.doc_id, tuple(s for s in r.text.split("\n") if WORD.search(s))) for r in after)
    assert all(r.n_chars == len(r.text) for r in after) and {r.u for r in after} == {1}


def test_one_document_of_each_group(staged):
    before, after = staged[3:5]
    sets = [shingle_set(r.text) for r in before]
    links = [(a, b) for a in range(len(before)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = groups(links, range(len(before)))
    place = {(r.doc_id, r.text): of[n] for n, r in enumerate(before)}
    assert sorted(place[r.doc_id, r.text] for r in after) == sorted(set(of.values()))
    assert not plain(after) - plain(before)


def test_every_id_is_packed_once(staged):
    before, after = staged[4:6]
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: len(tool.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
    at = dict.fromkeys(want, 0)
    for p in sorted(after, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.doc_tokens == want[p.doc_id]
        at[p.doc_id] += p.length
    sizes = Counter()
    for p in after:
        sizes[p.sequence_id] += p.length
    assert at == want and all(s == 2048 or s & (s - 1) == 0 for s in sizes.values())


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
