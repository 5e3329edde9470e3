from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest

from campuslake.llm import common, components, line_dedup, near_dedup, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- near-duplicates


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(pairs, nodes):
    head = {n: n for n in nodes}

    def find(n):
        while head[n] != n:
            n = head[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = groups(links, range(len(rows)))
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[of[n]] = min(i, least.get(of[n], i))
    return sorted(((i, len(sets[n]), least.get(of[n])) for n, (i, _) in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    out = [None, "", " \n", "one", "One", "a b c d", "A b\tc  d", "a b c d e", "a b c d e f"]
    for _ in range(25):  # distinct texts, mostly of one passage
        own = [word() for _ in range(rng.randrange(5, 120))]
        out.append(" ".join(own[: len(own) // 2] + passage + own[len(own) // 2 :]))
    base = [word() for _ in range(120)]
    for _ in range(40):  # one large group of near copies, of differing nearness
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    chain = [word() for _ in range(100)]
    for k in range(12):  # each like the next, the ends unlike
        out.append(" ".join(chain[k * 4 :] + [word() for _ in range(k * 4)]))
    out += [" ".join(word() for _ in range(30)) for _ in range(20)] + [out[40]] * 7 + ["w " * 20_000]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("few", [10**6, 0])
def test_joined_in_parts(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_ROWS", few)
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, 3, None, 4 + k % 50]), k) for k in range(3000)]
    counts = {k: sum(r[0] == k for r in rows) for k in {1, 2, 3, *range(4, 40)}}
    df, of = spark.createDataFrame(rows, "k long, v long"), spark.createDataFrame([(k, n, f"g{k}") for k, n in counts.items()], "k long, n long, name string")
    got = common.join_parts(df, of, ["k"], len(rows))
    assert got.columns == ["k", "v", "name"]
    assert sorted(map(tuple, got.collect())) == sorted((k, v, f"g{k}") for k, v in rows if k in counts)


@pytest.mark.parametrize(("hot", "block"), [(256, 2048), (6, 2048), (6, 9)])
def test_components_against_brute_force(spark, monkeypatch, hot, block):
    if block == 9:
        monkeypatch.setattr(common, "FEW_ROWS", 0)  # hot keys are dealt to several tasks
    # HOT and BLOCK are read on the driver alone
    monkeypatch.setattr(near_dedup, "HOT", hot)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = list(enumerate(corpus(hot + block), 10))
    rows += [rows[3], (rows[5][0], "repeated id with another text " * 3), (None, rows[50][1]), (None, "no id")]
    df = spark.createDataFrame([(i, t, "u", 1, 2) for i, t in rows], "doc_id long, text string, h string, n int, u int").repartition(3)
    got = near_dedup.near_dedup(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    # two texts under one id may be two components of one number
    linked = [r for r in got if r.n_shingles and r.component_id not in (None, rows[5][0])]
    assert sum(r.first for r in linked) == len({r.component_id for r in linked})


def shared_passage(n, seed=3):
    """Documents of 120 words, half of them a passage that all share; none is linked but for the last three, each like the next."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    out = [(k, " ".join([word() for _ in range(30)] + [passage] + [word() for _ in range(30)])) for k in range(n)]
    return out + [(n + k, out[0][1].rsplit(" ", k + 1)[0] + " x" * (k + 1)) for k in range(2)]


def test_a_shared_passage_brings_nobody_together(spark):
    dealt = []
    for n in (2000, 4000):
        df = spark.createDataFrame(shared_passage(n), "doc_id long, text string").repartition(4)
        rows = df.select(near_dedup.F.col("doc_id").alias("d"), near_dedup.F.lit(0).cast("long").alias("h"), near_dedup.F.col("text").alias("t"))
        base = common.cut(near_dedup.sketches(rows), "sketches")
        active = near_dedup.postings(base, n + 2).withColumn("label", near_dedup.F.col("u"))
        dealt.append(near_dedup.in_blocks(active, near_dedup.halves(base), False).count())
        got = near_dedup.near_dedup(df).where("component_id <> doc_id").collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(n, 0), (n + 1, 0)]
    assert dealt[1] < 2.3 * max(dealt[0], 100)


def test_linkable_leaves_out_no_linked_node(spark):
    rng = random.Random(12)
    rows = []
    for size in (3, 20, 150, 190, 200, 260, 400, 3000):  # about what a sketch holds, and beyond
        for k in range(6):
            a = [rng.getrandbits(60) for _ in range(size)]
            swap = max(1, size // 7)  # Jaccard (size - swap) / (size + swap), 0.75 and a little more
            rows += [(a, True), (a[swap:] + [rng.getrandbits(60) for _ in range(swap)], True), ([rng.getrandbits(60) for _ in range(size)], False)]
    pools = [(u, len(set(v)), np.sort(np.array(list(set(v)), np.uint64))[: near_dedup.POOL].tobytes()) for u, (v, _) in enumerate(rows)]
    df = spark.createDataFrame([(u, n, bytearray(p)) for u, n, p in pools], "u long, n long, pool binary")
    got = {r.u for r in near_dedup.linkable(df, len(rows)).collect()}
    assert got == {u for u, (v, linked) in enumerate(rows) if linked and (len(v) > 3)}


def test_near_dedup_of_nothing(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_dedup(nothing).count() == 0 and near_dedup.one_of_each(nothing).count() == 0


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_one_of_each_component_stays(spark, monkeypatch, broadcast):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rows = [(k, t) for k, t in enumerate(corpus(5), 10)]
    rows += [rows[3], rows[40], rows[40], (None, rows[50][1]), (None, "no id at all"), (None, "no id at all"), (7, None), (7, None), (8, ""), (8, "")]
    df = spark.createDataFrame([(i, t, "u", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, h string, u int").repartition(3)
    got = near_dedup.one_of_each(df).collect()
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    of = groups(links, range(len(rows)))
    assert sorted(of[r.u] for r in got) == sorted({of[n] for n in range(len(rows))})
    assert all((r.doc_id, r.text) == rows[r.u] for r in got) and got[0].__fields__ == ["doc_id", "text", "h", "u"]
    assert len(list(os.scandir(f"{common.shared_dir(spark)}/campuslake"))) >= 1


def test_tables_are_deleted_once_used(spark):
    before = {x.name for x in os.scandir(f"{common.shared_dir(spark)}/campuslake")}
    rows = [(k, t) for k, t in enumerate(corpus(6), 10)]
    near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {x.name for x in os.scandir(f"{common.shared_dir(spark)}/campuslake")} - before
    assert {x.split("-")[0] for x in left} <= {"classes", "ends"} and sum(x.startswith("classes") for x in left) == 1


def test_no_link_is_missed_by_the_estimate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400").select("doc_id", "text")
    got = sorted((tuple(r)[:3] for r in near_dedup.near_dedup(docs).collect()), key=repr)
    assert got == brute_components([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("few", [10**6, 0])
def test_connected_components(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_ROWS", few)  # with 0, the links of hubs are dealt to several tasks
    rng = random.Random(9)
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(1, 1)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == groups([x for x in links if x[0] != x[1]], {n for a, b in links if a != b for n in (a, b)})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- lines


def brute_lines(rows, least):
    """Delete what any run of `least` words covers that also begins earlier."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    lines = {n: [s for s in (rows[n][1] or "").split("\n") if WORD.search(s)] for n in order}
    seen, gone = set(), {n: set() for n in order}
    for n in order:
        sizes = [len(WORD.findall(s)) for s in lines[n]]
        for a in range(len(sizes)):
            for b in range(a + 1, len(sizes) + 1):
                run = tuple(lines[n][a:b])
                if sum(sizes[a:b]) >= least:
                    if run in seen:
                        gone[n] |= set(range(a, b))
                    seen.add(run)
    return {n: [s for k, s in enumerate(lines[n]) if k not in gone[n]] for n in order}


@pytest.mark.parametrize(("least", "broadcast"), [(1, 0), (3, 10**6), (7, 10**6)])
def test_line_dedup_against_brute_force(spark, monkeypatch, least, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_RUNS", broadcast)
    rng = random.Random(least)
    pool = ["a b", "c", "d e f", "g", "h i j k", "l", "m n", "", "  "]
    rows = [(n, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for n in range(60)]
    rows += [(5, rows[5][1]), (70, None), (71, ""), (72, "\n\n"), (None, rows[9][1]), (73, "c\n" * 40), (74, "q r\n\nq r\n")]
    df = spark.createDataFrame([(i, t, n, "r", 9) for n, (i, t) in enumerate(rows)], "doc_id long, text string, at int, runs string, n_lines int").coalesce(1)
    got = line_dedup.line_dedup(df, least).collect()
    want = brute_lines(rows, least)
    assert len(got) == len(rows)
    for r in got:
        before = rows[r["at"]][1]
        assert (r.text is None) == (before is None) and r.runs == "r"
        assert [s for s in (r.text or "").split("\n") if WORD.search(s)] == want[r["at"]]
        assert r.n_lines - r.n_removed == len(want[r["at"]])
        assert r.n_removed or r.text == before
    assert line_dedup.line_dedup(df.where("false"), least).count() == 0


@pytest.mark.parametrize("hot_share", [1000, 3])
def test_suffix_arrays_are_sorted(spark, monkeypatch, hot_share):
    """Ranks order the positions by the lines from there on, and equal ranks are the positions with a common prefix that long."""
    monkeypatch.setattr(common, "HOT_SHARE", hot_share)  # with 3, some groups are hot and some are not
    rng = random.Random(hot_share)
    rows = [(k, "\n".join(rng.choice(["a a", "b b b", "c c c c c", "d"]) for _ in range(40))) for k in range(8)]
    docs = spark.createDataFrame(rows, "d long, t string").repartition(3)
    lines = common.cut(line_dedup.line_rows(docs.selectExpr("d AS u", "d", "t"), 20), "lines")
    texts = {d: t.split("\n") for d, t in rows}
    order = {texts[r.d][r.p]: (r.a, r.b) for r in lines.collect()}
    for k, level in enumerate(line_dedup.suffix_arrays(line_dedup.repeated(lines, 20), 20)):
        h = 1 << k
        every = {}
        for d, t in texts.items():
            for p in range(len(t) - h + 1):
                every.setdefault(tuple(order[x] for x in t[p : p + h]), []).append((d, p))
        start, want = 0, {}
        for run in sorted(r for r in every if len(every[r]) > 1):
            want |= dict.fromkeys(every[run], start)
            start += len(every[run])
        assert {(r.d, r.p): r["rank"] for r in level.collect()} == want and (k or want)


def test_lines_of_any_length(spark):
    line = "word " * 30_000 + "end"
    rows = [(1, f"a\n{line}\nb"), (2, f"c\n{line}\nd"), (3, "x" * 300_000), (4, "x" * 300_000), (5, ("y " * 60 + "\n") * 2)]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (rows[0][1], 0) and got[2] == ("c\nd", 1)
    assert got[3][1] == got[4][1] == 0  # one word is no run of fifty
    assert got[5][1] == 1


def test_archives_are_split(spark, tmp_path):
    rows = [(k, f"http://x/{k}", f"<p>{k}</p>" * 200) for k in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"), pages_per_file=3)
    assert sum(f.name.endswith(".gz") for f in os.scandir(tmp_path / "w")) == 4
    found = warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    assert sorted(r.page_id for r in found) == list(range(10)) and all(r.request and r.metadata for r in found)


def test_full_lines():
    texts = ["", "a", "", "\n", "a\n", "\na\n \n\tb c\nd", "x\n\x0b\x0c\r\n\xa0", " ", "é\n日本", ""]
    for some in (texts, texts[1:], texts[:0], [""]):
        want = [sum(bool(WORD.search(x)) for x in t.split("\n")) for t in some]
        assert line_dedup.full_lines(line_dedup.pa.array(some, line_dedup.pa.large_string())).tolist() == want


def test_blank_lines_inside_a_run_go():
    assert line_dedup.without("a\n\nb\n\nc", [(0, 2)]) == ("\nc", 2)
    assert line_dedup.without("a\n\nb\n\nc", [(1, 1)]) == ("a\n\n\nc", 1)
    assert line_dedup.without("", []) == ("", 0)


# ---------------------------------------------------------------- archives


def test_warc_round_trip(spark):
    long, tricky = "é" * 600, "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40
    rows = [(1, "http://a", long), (2, "http://b", long), (3, None, long), (4, "u\r\nX: y", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", tricky), (9, "u", tricky + "\n"), (10, "u", "x" * 999), (11, "u", "x" * 999), (3, "again", long), (None, "u", "alone")]
    df = spark.createDataFrame([(*r, "k", "v") for r in rows], "page_id long, url string, html string, key string, value string").repartition(3)
    got = warc.warc_round_trip(df).collect()
    assert len(got) == len(rows) and all(r.request_id for r in got)
    seen = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = 3 if html == long and i != 3 else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers))
    assert seen == sorted(want, key=repr)
    assert warc.warc_round_trip(df.where("false")).count() == 0


def test_captures_are_nested_and_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/é", "<p>\r\n\r\n é</p>")], "page_id long, url string, html string")
    warc.write_warc(df, str(tmp_path / "w"))
    row = warc.assemble(warc.read_warc(spark, str(tmp_path / "w"))).first()
    assert bytes(row.block).partition(b"\r\n\r\n")[2].decode() == "<p>\r\n\r\n é</p>" and row.uri == "http://a/é"
    assert bytes(row.request.block).startswith(b"GET ") and row.metadata.length == len("<p>\r\n\r\n é</p>".encode())
    assert dict(row.request.headers)["warc-concurrent-to"] == row.record_id


def test_equal_halves_are_no_earlier_list():
    m, v = 60, (9 << 32) + 5
    common = [(k + 10) << 32 for k in range(14)]
    hashes = np.array([[(3 << 32) + k, v, *common] for k in range(m)], np.uint64)  # the first hashes differ in their lower halves only
    pools = np.full((m, near_dedup.POOL), near_dedup.HALF)
    pools[:, :16] = hashes >> np.uint64(32)
    args = (v, np.arange(m), np.arange(m), np.full(m, 16), np.ones(m, bool), pools, np.full(m, 16), np.zeros(m, bool), False)
    i, j = near_dedup.pairs_of_list(*args, hashes)
    assert len(i) == m * (m - 1) // 2
    hashes[:, 0] = 3 << 32  # now the list of that hash comes first, and the pairs are looked at there
    assert len(near_dedup.pairs_of_list(*args, hashes)[0]) == 0
