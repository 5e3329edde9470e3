from __future__ import annotations

import zlib

import numpy as np
import pytest

from campuslake.llm import common, language_id, quality_model, toxicity

SF = "/root/testdata/sf0.1"
ODD = [(-1, None), (-2, ""), (-3, "12 345 !!"), (-4, " \n\t"), (-5, "word " * 30_000), (-6, "x"), (None, "the and of that with from"), (-7, "the and of"), (-7, "the and of")]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 5000").select("doc_id", "text", "lang").repartition(4)
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    # columns with the names that the operators use themselves
    return spark.createDataFrame([(*r, "q", 1.5, "r") for r in ODD], "doc_id long, text string, i string, score double, t string")


def test_language(spark, tables, odd):
    docs = tables[0]
    model = language_id.learn(docs)
    assert set(model) == {"en", "de", "fr", "es"} and all(len(v) <= language_id.DICT_BYTES + language_id.DOCS_PER_LANG for v in model.values())
    got = language_id.language_id(docs).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    rows = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert {k for k, r in rows.items() if r.lang_pred == "und"} == {-1, -2, -3, -4} and all(rows[k].rejected and rows[k].score == 0 for k in (-1, -2, -3, -4))
    assert rows[-5].lang_pred in model and rows[None].lang_pred == "en"
    assert {r.lang_pred for r in language_id.identify(odd, {}).collect()} == {"und"}
    assert language_id.language_id(docs.where("false")).count() == 0


def test_language_against_single_calls(spark):
    """Sizes, choice, score and margin of each text, compressed here piece by piece with the same dictionaries."""
    model = {"aa": b"the and of that with from this have " * 40, "bb": b"der und die das mit von nicht eine " * 40, "cc": b"le et la les des que pour dans " * 40}
    texts = ["the and of that", "und die das mit " * 500, "le et la " * 3, "zzz", "THE AND", "x" * 5000, "1 2 3", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(df, model, min_margin=0.02).collect()}
    for k, text in enumerate(texts):
        if k >= 6:
            assert (got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True)
            continue
        size = {}
        for lang, content in model.items():
            tool = language_id.compressor(content, language_id.LEVEL)
            size[lang] = sum(len(tool.compress(piece + bytes(256))) for piece in language_id.cut_at_spaces(text.lower().encode(), language_id.PIECE_BYTES))
        first, second = sorted(size.values())[:2]
        assert got[k].lang_pred == min(size, key=lambda x: (size[x], x)) and got[k].margin == pytest.approx((second - first) / second)
        assert got[k].score == pytest.approx(1 / sum(2.0 ** (-2.0 * min(v - first, 500)) for v in size.values()))
        assert got[k].rejected == ((second - first) / second < 0.02)


def test_learning_reads_whole_texts_of_any_length(spark, monkeypatch):
    rows = [(k, "ab " * 30_000 + f"tail{k} " * 30, "en") for k in range(1, 60)] + [(100 + k, "", "en") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    content = language_id.learn(df, dict_bytes=2_000, docs_per_lang=10)["en"]
    assert 1_900 <= len(content) <= 2_010
    labels = spark.createDataFrame([(i, k % 2) for k, (i, _, _) in enumerate(rows)], "doc_id long, toxic int")
    got = common.learn_rows(df, labels, "toxic", 50, [0, 1])
    usable = {i: t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5}
    assert {(i, t) for _, i, t in got} == set(usable.items())
    few = common.learn_rows(df, labels, "toxic", 50, [0, 1], most_chars=200_000)
    assert all(sum(len(t) for y, _, t in few if y == c) <= 200_000 for c in (0, 1)) and sum(not t for _, _, t in few) == sum(not t for t in usable.values())


def test_toxicity(spark, tables, odd):
    docs, labels = tables
    model = toxicity.learn(docs, labels)
    got = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    clean, toxic = [r.score >= 0.5 for r in got if r.toxic == 0], [r.score >= 0.5 for r in got if r.toxic == 1]
    assert sum(clean) <= 0.03 * len(clean) and sum(toxic) >= 0.8 * len(toxic)
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(odd, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[-1] == scores[-2] < 0.5
    few = toxicity.toxicity(docs.where("doc_id < 400"), labels).collect()
    assert few[0].__fields__ == ["doc_id", "held_out", "score", "predicted"] and all(r.predicted == (r.score >= 0.5) for r in few)
    assert {r.score for r in toxicity.toxicity(odd, labels.where("false")).collect()} == {0.5}
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0


@pytest.fixture(scope="module")
def toxic_model(spark, tables):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang"), tables[1]
    held = docs.where("text IS NOT NULL").join(labels, "doc_id").where(toxicity.held_out()).orderBy("doc_id").collect()
    return toxicity.learn(docs, labels), [r for r in held if r.toxic == 1], [r for r in held if r.toxic == 0]


def flagged(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sum(r.score >= 0.5 for r in toxicity.score_toxicity(rows, model).collect())


def test_toxic_passage_in_a_long_clean_text(spark, toxic_model):
    model, toxic, clean = toxic_model
    alone = flagged(spark, model, [r.text for r in toxic])
    ordinary = "\n".join(r.text for r in clean)
    step = len(ordinary) // len(toxic)
    fillers = [ordinary[k * step : (k + 1) * step][:20_000] for k in range(len(toxic))]
    inside = flagged(spark, model, [f"{f}\n{r.text}\n{f}" for f, r in zip(fillers, toxic)])
    assert alone >= 0.85 * len(toxic) and inside >= 0.85 * alone
    assert flagged(spark, model, fillers) <= 0.2 * len(fillers)


def test_toxic_texts_of_every_language(spark, toxic_model):
    model, toxic, clean = toxic_model
    assert flagged(spark, model, [r.text for r in clean]) <= 0.02 * len(clean)
    for lang in ("de", "en", "fr", "es"):
        texts = [r.text for r in toxic if r.lang == lang]
        assert flagged(spark, model, texts) >= 0.8 * len(texts)


def test_toxicity_dictionaries_are_passages():
    ordinary = [f"the weather of day {k} was fair\nand mild".encode() for k in range(60)]
    toxic = [f"they said you fool number {k} and left".encode() for k in range(120)] + [f"da war der dummkopf mit hut {k}".encode() for k in range(5)]
    found = toxicity.dictionaries(toxic, ordinary * 20)
    pieces = {p.strip() for t in toxic for p in toxicity.cut_at_spaces(t, toxicity.SPAN)}
    taken = found["extra"].decode()
    for p in sorted(pieces, key=len, reverse=True):
        taken = taken.replace(p.decode() + " ", "")
    assert taken == "" and b"fool" in found["extra"] and b"dummkopf" in found["extra"]
    # the ordinary ones are ordinary passages, and no longer than the toxic ones
    assert b"fool" not in found["plain"] + found["base"] and all(w in b" ".join(ordinary) for w in found["base"].split())
    assert max(len(found["plain"]), len(found["base"])) <= len(found["extra"])


def test_folds_in_tasks_give_the_same_model(spark):
    ordinary = [f"the weather of day {k} was fair and mild as ever" for k in range(40)]
    toxic = [f"they said you fool number {k} and left the day" for k in range(60)]
    assert toxicity.fit(toxic, ordinary, {0: 40, 1: 60}, toxicity.in_tasks(spark)) == toxicity.fit(toxic, ordinary, {0: 40, 1: 60})


def test_windows_against_single_calls():
    ordinary = [f"the weather of day {k} was fair and mild as ever" for k in range(60)]
    toxic = [f"they said you fool number {k} and left the day" for k in range(120)]
    model = toxicity.fit(toxic, ordinary, {0: 60, 1: 120})
    texts = ["", "you FOOL", "fool\nfool, the weather", "x" * 200, "the day was mild " * 100 + "you fool", "fool " * 300]
    plain = toxicity.compressor(model["plain"] + model["base"], toxicity.LEVEL)
    extra = toxicity.compressor(model["extra"] + model["base"], toxicity.LEVEL)
    got, at = toxicity.features(toxicity.pa.array(texts, toxicity.pa.large_string()), toxicity.Gains(model, memo_windows=3))
    for k, text in enumerate(texts):
        gain = []
        for word in text.lower().replace(",", " ").encode().split():
            cuts = [model["base"][:14] + b" " + word[i : i + 64] + b" " + bytes(256) for i in range(0, len(word), 64)]
            gain.append(min(max(0, *(len(plain.compress(c)) - len(extra.compress(c)) for c in cuts)), 8))
        begins = sorted({max(min(b, len(gain) - 128), 0) for b in range(0, max(len(gain) - 64, 1), 64)})
        want = [[max(part, default=0), *(sum(g >= s for g in part) ** 0.5 for s in (2, 3, 4, 5, 6)), np.log(max(len(part), 1))] for part in (gain[b : b + 128] for b in begins)]
        assert np.allclose(got[at[k] : at[k + 1]], want)


def test_quality(spark, tables, odd):
    docs, labels = tables
    got = quality_model.quality_classifier(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in got) >= 0.98 * len(got) and all(r.predicted == (r.score >= 0.3) for r in got)
    model = quality_model.learn(docs, labels)
    scores = {r.doc_id: r.score for r in quality_model.score_quality(odd, model).collect()}
    assert len(scores) == len({i for i, _ in ODD}) and all(0 <= s <= 1 for s in scores.values())
    assert {r.score for r in quality_model.quality_classifier(odd, labels.where("false")).collect()} == {0.5}


def test_first_split_is_the_best_one():
    """One tree of one level on few rows, against all splits tried out."""
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)).round(1), (rng.random(60) < 0.4).astype(float)
    y[x[:, 1] > 0.3] = 1
    model = quality_model.fit(x, y, np.ones(60))
    p = y.mean()
    best = None
    for j in range(3):
        for edge in np.unique(np.quantile(x[:, j], np.linspace(0, 1, quality_model.BINS + 1)[1:-1])):
            left = x[:, j] <= edge
            if min(left.sum(), (~left).sum()) >= quality_model.MIN_ROWS:
                gain = sum((p * m.sum() - y[m].sum()) ** 2 / (p * (1 - p) * m.sum() + quality_model.RIDGE) for m in (left, ~left))
                best = max(best or (-1, 0, 0), (round(gain, 6), -j, -edge))
    feature, cut = model["feature"][0][0], model["cut"][0][0]
    left = x[:, feature] <= cut
    got = sum((p * m.sum() - y[m].sum()) ** 2 / (p * (1 - p) * m.sum() + quality_model.RIDGE) for m in (left, ~left))
    assert got == pytest.approx(best[0], abs=1e-4)


def test_trees_against_a_walk_of_each_row():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)).round(1)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_model.fit(x, y, np.ones(400))
    want = []
    for row in x:
        total = float(model["base"])
        for f, c, v in zip(model["feature"], model["cut"], model["value"]):
            at = 0
            for _ in range(quality_model.DEPTH):
                at = 2 * at + (2 if row[f[at]] > c[at] else 1)
            total += v[at - len(f)]
        want.append(1 / (1 + np.exp(-total)))
    got = quality_model.predict(model, x)
    assert np.allclose(got, want) and ((got > 0.5) == (y > 0)).mean() > 0.95
