"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set of word shingles is hashed once; its sketch is the POOL smallest
hashes. Inverted lists of retained hashes bring documents together, the overlap of
two sketches estimates their similarity on the sketch of their union, and pairs
that may reach the bound are confirmed on the full sets.

How no link is lost: of the smallest hashes of a union each is shared with
probability 0.75 or more, so two linked documents have one in common among the
first INDEXED but for less than 0.25 ** 16. A value in more than HOT documents (a
passage that many documents hold) is passed over in favour of the next ones,
unless such values make up more than 3/8 of the first COUNTED ones; otherwise at
least 0.6 of the remaining values are shared, and all miss with probability
0.4 ** 16. Documents that are mostly such passages also enter the lists of hot
values, unless too few of their retained values are in any other such document for
a link (see linkable()): then they are linked through other values or not at all,
and a passage that a million short texts share brings none of them together. In
the last round a list of more than 48 members keeps only pairs that share
0.38 of the first COUNTED hashes; a pair at the bound falls short with odds of about
1e-7. The estimate is held against the bound less SLACK standard deviations; for
sets of up to POOL shingles it is no estimate but the similarity itself.

How groups of copies stay cheap: equal sets become one node. In the first rounds
each member of a list is tried with one member of another component only, the
links are confirmed, and components grow; long lists are dealt into blocks then,
and the list's first member joins each of them. The last round looks at all pairs
that are still in different components: the members outside a list's largest
component meet each other and those inside it, block by block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, drop, join_parts, mix, plain, slices, small, windows, words
from .components import components

SHINGLE = 5
POOL = 256
COUNTED = 48
INDEXED = 16
HOT = 256
#: The bound: 100 * intersection >= PERCENT * union.
PERCENT = 75
SLACK = 5.5
#: Members of a list that meet in one call; longer lists are dealt into blocks.
BLOCK = 512
PAD = np.uint64(2**64 - 1)
#: Sketches travel as the upper halves of their hashes: equal halves of unequal hashes only let a pair pass that the full sets then judge.
HALF = np.uint32(2**32 - 1)
#: Rounds that try one pair for each member of a list.
ROUNDS = 3


# ---------------------------------------------------------------- sets and sketches


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, sorted within it, and where each text begins."""
    codes, starts, known = words(pc.ascii_lower(texts))
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known.cast(pa.binary() if known.type != pa.large_string() else pa.large_binary()).to_pylist()), np.uint64, len(known))
    values = names[codes]
    h, _, owner = windows(values, starts, SHINGLE)
    few = np.flatnonzero((np.diff(starts) < SHINGLE) & (np.diff(starts) > 0))
    if len(few):  # the whole sequence as one; its length keeps it apart from shingles
        short = np.array([xxhash.xxh3_64_intdigest(values[starts[i] : starts[i + 1]].tobytes(), int(starts[i + 1] - starts[i])) for i in few], np.uint64)
        h, owner = np.concatenate([h, short]), np.concatenate([owner, few])
    h = np.minimum(h, PAD - np.uint64(1))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])] if len(h) else np.zeros(0, bool)
    h, owner = h[new], owner[new]
    at = np.zeros(len(starts), np.int64)
    np.cumsum(np.bincount(owner, minlength=len(starts) - 1), out=at[1:])
    return h, at


def sketches(docs: DataFrame) -> DataFrame:
    """docs (d, h, t) to (u, d, h, n, s1, s2, pool): the row's number, the set's size, two sums that stand for the set, and its smallest hashes."""

    def run(batches):
        u = TaskContext.get().partitionId() << 33
        for piece in slices(batches, "t"):
            hashes, at = shingles(plain(piece["t"]))
            n = np.diff(at)
            with np.errstate(over="ignore"):
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(mix(hashes ^ np.uint64(salt)), out=total[1:])
                    sums.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
            pools = [hashes[a : min(b, a + POOL)].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(u, u + len(n))), plain(piece["d"]), plain(piece["h"]), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), pa.array(pools, pa.binary())],
                ["u", "d", "h", "n", "s1", "s2", "pool"],
            )
            u += len(n)

    return docs.mapInArrow(run, "u long, d long, h long, n long, s1 long, s2 long, pool binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """(u, t) to (u, set): the full set of each text, sorted."""

    def run(batches):
        for piece in slices(batches, "t"):
            hashes, at = shingles(plain(piece["t"]))
            yield pa.RecordBatch.from_arrays([plain(piece["u"]), pa.array([hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())], ["u", "set"])

    return docs.mapInArrow(run, "u long, set binary")


# ---------------------------------------------------------------- inverted lists


def values(sketched: DataFrame, most: int) -> DataFrame:
    """(u, v, r, size): the first `most` hashes of each sketch with their ranks, and how many there are."""

    def run(batches):
        for batch in batches:
            pools = [np.frombuffer(p, np.uint64)[:most] for p in batch.column("pool").to_pylist()]
            size = np.array([len(p) for p in pools], np.int64)
            rank = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            v = np.concatenate(pools).view(np.int64) if pools else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(batch.column("u")), size)), pa.array(v), pa.array(rank, pa.int32()), pa.array(np.repeat(size, size), pa.int32())], ["u", "v", "r", "size"])

    return sketched.select("u", "pool").mapInArrow(run, "u long, v long, r int, size int")


def linkable(sketched: DataFrame, total: int) -> DataFrame:
    """(u): those of the sketched nodes that may be linked with another of them, as a written table.

    Of a linked set PERCENT in a hundred are in the other one. A set so small that
    the other one's sketch holds all of it is judged by all of its values; of others
    the first half of the sketch is looked at, which the other's sketch holds, and
    may fall short by SLACK standard deviations.
    """
    every = values(sketched, POOL)
    lists = every.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    shared = join_parts(every, lists, ["v"], total * POOL, "c").where(F.col("size") * 100 <= PERCENT * POOL).groupBy("u").agg(F.count("*").alias("found"))
    whole = sketched.select("u", "n").where(F.col("n") * 100 <= PERCENT * POOL).join(shared, "u").where(F.col("found") * 100 >= F.col("n") * PERCENT).select("u")
    half = POOL // 2
    least = PERCENT / 100 * half - SLACK * (half * 0.1875) ** 0.5
    part = join_parts(every.where(F.col("r") < half), lists, ["v"], total * half, "c").where(F.col("size") * 100 > PERCENT * POOL)
    part = part.groupBy("u").agg(F.count("*").alias("found")).where(F.col("found") >= least).select("u")
    return cut(whole.unionByName(part), "linkable")


def postings(sketched: DataFrame, total: int) -> DataFrame:
    """(u, v, mostly): each node in the lists of the hashes that it is indexed by, for lists of two nodes or more, as a written table; mostly: hot values make up much of it. total: how many nodes there are."""
    every = values(sketched, COUNTED)
    lists = every.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").withColumn("hot", F.col("c") > HOT)
    found = join_parts(every, lists, ["v"], total * COUNTED, "c")
    mine = W.partitionBy("u")
    found = found.withColumn("hots", F.sum(F.col("hot").cast("int")).over(mine))
    found = found.withColumn("before", F.sum(F.col("hot").cast("int")).over(mine.orderBy("r").rowsBetween(W.unboundedPreceding, 0)))
    found = found.withColumn("mostly", F.col("hots") * 8 > F.col("size") * 3)
    chosen = found.where((~F.col("hot") & (F.col("r") - F.col("before") < INDEXED)) | (F.col("mostly") & (F.col("r") < INDEXED)))
    chosen = chosen.withColumn("extra", F.col("hot") | (F.col("r") - F.col("before") >= INDEXED))
    chosen = cut(chosen.select("u", "v", "mostly", "extra"), "postings")
    mostly = cut(chosen.where("mostly").select("u").distinct(), "mostly")
    many = mostly.count()
    if not many:
        drop(mostly)
        return chosen
    kept = linkable(sketched.join(small(mostly), "u", "left_semi"), many)
    # two documents that are mostly hot values meet in the lists of these; any other pair meets in another list
    marked = chosen.join(small(kept.withColumn("stays", F.lit(True))), "u", "left").withColumn("mostly", F.col("mostly") & F.col("stays").isNotNull())
    out = cut(marked.where(F.col("mostly") | ~F.col("extra")).select("u", "v", "mostly"), "postings")
    drop(chosen, mostly, kept)
    return out


def halves(sketched: DataFrame) -> DataFrame:
    """(u, n, pool, first) with the upper halves of the pool's hashes, and the first INDEXED hashes as they are."""

    def run(batches):
        for batch in batches:
            pools = [(np.frombuffer(p, np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for p in batch.column("pool").to_pylist()]
            first = [p[: 8 * INDEXED] for p in batch.column("pool").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("n"), pa.array(pools, pa.binary()), pa.array(first, pa.binary())], ["u", "n", "pool", "first"])

    return sketched.select("u", "n", "pool").mapInArrow(run, "u long, n long, pool binary, first binary")


def likely(pools: np.ndarray, size: np.ndarray, full: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the pairs (i, j) of sketches may reach the bound, by the sketch of their union."""
    out = np.zeros(len(i), bool)
    for k in range(0, len(i), 20_000):
        a, b = i[k : k + 20_000], j[k : k + 20_000]
        both = np.sort(np.concatenate([pools[a], pools[b]], 1), 1)
        top = [np.where(full[x], HALF - np.uint32(1), pools[x, np.maximum(size[x] - 1, 0)]) for x in (a, b)]
        border = np.minimum(*top)[:, None]
        shared = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != HALF)).sum(1)
        union = (both <= border).sum(1) - shared
        exact = full[a] & full[b]
        need = PERCENT / 100 * union - np.where(exact, 1e-9, SLACK * np.sqrt(union * 0.1875))
        out[k : k + 20_000] = shared >= need
    return out


def shared_counts(pools: np.ndarray) -> np.ndarray:
    """How many hashes each two of the sketches share."""
    m = len(pools)
    out = np.zeros((m, m), np.float32)
    flat = pools.ravel()
    rows = np.repeat(np.arange(m), pools.shape[1])
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    count = np.diff(np.r_[first, len(flat)])
    use = (count > 1) & (flat[first] != HALF)
    for c in np.unique(count[use & (count <= 12)]):  # short runs, all of one length at a time
        at = rows[first[use & (count == c)][:, None] + np.arange(c)]
        for x in range(c):
            for y in range(c):
                if x != y:
                    np.add.at(out, (at[:, x], at[:, y]), 1)
    wide = np.flatnonzero(use & (count > 12))
    for k in range(0, len(wide), 1024):
        part = wide[k : k + 1024]
        x = np.zeros((m, len(part)), np.float32)
        for col, g in enumerate(part):
            x[rows[first[g] : first[g] + count[g]], col] = 1
        out += x @ x.T
    np.fill_diagonal(out, 0)
    return out


def pairs_of_list(v: int, u: np.ndarray, label: np.ndarray, n: np.ndarray, mostly: np.ndarray, pools: np.ndarray, size: np.ndarray, side: np.ndarray, few: bool, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one list that may be linked: from different components and, for two blocks, from different sides.

    few: each member is tried with one member only, the list's first or else the
    one of another component that it shares the most hashes with.
    """
    m, full = len(u), n <= POOL
    fits = lambda i, j: (label[i] != label[j]) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
    none = np.zeros(0, np.int64)
    if m < 2 or (label == label[0]).all():
        return none, none
    if few:
        hub = int(np.argmin(u))
        i = np.flatnonzero(np.arange(m) != hub)
        j = np.full(len(i), hub)
        good = fits(i, j)
        good[good] = likely(pools, size, full, i[good], j[good])
        rest = i[~good]
        i, j = i[good], j[good]
        if len(rest) and m > 2:
            counts = shared_counts(pools[:, :COUNTED])
            counts[label[:, None] == label[None, :]] = -1
            counts[100 * np.minimum(n[:, None], n[None, :]) < PERCENT * np.maximum(n[:, None], n[None, :])] = -1
            best = counts[rest].argmax(1)
            ok = fits(rest, best)
            ok[ok] = likely(pools, size, full, rest[ok], best[ok])
            i, j = np.concatenate([i, rest[ok]]), np.concatenate([j, best[ok]])
        return i, j
    if m <= 48:
        i, j = np.triu_indices(m, 1)
    else:
        counts = shared_counts(pools[:, :COUNTED])
        i, j = np.nonzero(np.triu(counts, 1) >= 0.38 * np.minimum(size[:, None], size[None, :]).clip(max=COUNTED))
    keep = fits(i, j)
    if side.any() and not side.all():
        keep &= side[i] != side[j]
    i, j = i[keep], j[keep]
    if mostly.all() and m > 48:  # such members are in the lists of all their first values: a pair is looked at in its first list
        # by whole hashes: halves may be equal where the hashes are not, and the earlier list would not exist
        codes = np.unique(first, return_inverse=True)[1].reshape(first.shape).astype(np.uint32)
        early = np.where(first < np.uint64(v & (2**64 - 1)), codes, HALF)
        once = shared_counts(early)[i, j] == 0
        i, j = i[once], j[once]
    good = likely(pools, size, full, i, j)
    return i[good], j[good]


def candidates(lists: DataFrame, few: bool) -> DataFrame:
    """Distinct pairs (a, b), a < b, of lists (v, x, y, side, u, label, n, mostly, pool, first)."""

    def run(batches):
        held: list[pa.Table] = []

        def pairs(t: pa.Table):
            t = t.combine_chunks()
            v, x, y = (np.asarray(t[c].combine_chunks()) for c in ("v", "x", "y"))
            edge = np.r_[0, np.flatnonzero((v[1:] != v[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1, t.num_rows]
            u, label, n, side = (np.asarray(t[c].combine_chunks()) for c in ("u", "label", "n", "side"))
            mostly = t["mostly"].to_numpy()
            raw = t["pool"].to_pylist()
            size = np.array([len(p) // 4 for p in raw])
            pools = np.full((len(raw), POOL), HALF)
            for k, p in enumerate(raw):
                pools[k, : size[k]] = np.frombuffer(p, np.uint32)
            first = np.full((len(raw), INDEXED), PAD)
            for k, p in enumerate(t["first"].to_pylist()):
                first[k, : len(p) // 8] = np.frombuffer(p, np.uint64)
            found = []
            for a, b in zip(edge[:-1], edge[1:]):
                i, j = pairs_of_list(int(v[a]), u[a:b], label[a:b], n[a:b], mostly[a:b], pools[a:b], size[a:b], side[a:b] > 0, few, first[a:b])
                if len(i):
                    p, q = u[a:b][i], u[a:b][j]
                    found.append(np.stack([np.minimum(p, q), np.maximum(p, q)], 1))
            rows = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            key = [np.asarray(t[c].combine_chunks()) for c in ("v", "x", "y")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], 0)) + 1
            same = bool(held) and all(held[-1][c][-1] == t[c][0] for c in ("v", "x", "y"))
            # the last list of a batch may go on in the next one
            if len(change) or not same:
                if held and not same:
                    yield pairs(pa.concat_tables(held))
                    held = []
                if len(change):
                    to = int(change[-1])
                    yield pairs(pa.concat_tables([*held, t.slice(0, to)]))
                    held, t = [], t.slice(to)
            held.append(t)
        if held:
            yield pairs(pa.concat_tables(held))

    dealt = lists.repartition("v", "x", "y").sortWithinPartitions("v", "x", "y", "u")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def in_blocks(active: DataFrame, pools: DataFrame, few: bool) -> DataFrame:
    """Lists of members of several components, with what members are judged by; lists over BLOCK go out in blocks x, y.

    few: each member goes out once, and the list's first member to every block.
    Else the members outside the list's largest component go to a call with each
    block, those inside it to one with each block of those outside.
    """
    cast, total = ["v", "x", "y", "side", "u", "label", "mostly"], active.count()
    if few:
        of = active.groupBy("v").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct("u", "label", "mostly")).alias("hub"))
        of = of.where("m > 1 and low <> high").select("v", "m", "hub", F.ceil(F.col("m") / BLOCK).alias("blocks"))
        mine = F.pmod(F.xxhash64("u"), F.col("blocks"))
        lists = join_parts(active, of.select("v", "blocks", "m"), ["v"], total, "m").withColumns({"x": mine, "y": mine, "side": F.lit(0)}).select(cast)
        hubs = of.where("blocks > 1").select("v", "hub.*", "blocks").withColumn("mine", mine)
        hubs = hubs.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("x <> mine")
        lists = lists.unionByName(hubs.withColumns({"y": F.col("x"), "side": F.lit(0)}).select(cast))
    else:
        of = active.groupBy("v", "label").agg(F.count("*").alias("c")).groupBy("v").agg(F.sum("c").alias("m"), F.max(F.struct("c", "label")).alias("main"), F.count("*").alias("k"))
        one = F.col("m") <= BLOCK
        outer = F.when(one, 1).otherwise(F.ceil((F.col("m") - F.col("main.c")) / BLOCK)).cast("long")
        inner = F.when(one, 0).otherwise(F.ceil(F.col("main.c") / BLOCK)).cast("long")
        of = of.where("k > 1").select("v", "m", F.when(~one, F.col("main.label")).alias("main"), outer.alias("outer"), inner.alias("inner"))
        lists = join_parts(active, of, ["v"], total, "m")
        inside, h = F.coalesce(F.col("label") == F.col("main"), F.lit(False)), F.xxhash64("u")
        lists = lists.withColumn("mine", F.when(inside, F.col("outer") + F.pmod(h, F.greatest("inner", F.lit(1).cast("long")))).otherwise(F.pmod(h, F.col("outer"))))
        last = F.when(inside, F.col("outer") - 1).otherwise(F.col("outer") + F.col("inner") - 1)
        lists = lists.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        lists = lists.withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other"), "side": (F.col("mine") > F.col("other")).cast("int")}).select(cast)
    return lists.join(pools, "u")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the bound."""

    def run(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (p, q) in enumerate(zip(batch.column("p"), batch.column("q"))):
                x, y = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                good[k] = 100 * shared >= PERCENT * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], ["a", "b"])

    # b first: a may be the first member of a long list, whose pairs Spark can then split by their size
    both = pairs.join(sets.select(F.col("u").alias("b"), F.col("set").alias("q")), "b")
    both = both.join(sets.select(F.col("u").alias("a"), F.col("set").alias("p")), "a")
    return both.select("a", "b", "p", "q").mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- the operator


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, h, n, component_id, first) for every row of docs, as a written table: its id, the hash of its text, its set's size, the least id of its component, and whether it is the one row that stands for it.

    What near_dedup() says of ids, nulls and repeats holds here.
    """
    text = docs.select(F.col(id_col).cast("long").alias("d"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    base = cut(sketches(text), "sketches")
    nodes = base.where("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("u", "d", "h")).alias("x"), F.min("d").alias("least"), F.count("*").alias("copies"))
    nodes = cut(nodes.select("s1", "s2", "n", "least", "copies", "x.*"), "nodes")
    sketched = base.join(nodes.select("u"), "u", "left_semi")
    active = postings(sketched, nodes.count())
    members = cut(active.select("u").distinct(), "members")
    pools = cut(halves(base.join(small(members), "u", "left_semi")), "pools")
    long_sets: list[DataFrame] = []

    def links_of(pairs: DataFrame) -> DataFrame:
        """The pairs confirmed on full sets. A set of up to POOL is its sketch; longer ones are made anew from the texts, once for each document that needs it."""
        found = cut(pairs.select(F.col("a").alias("u")).unionByName(pairs.select(F.col("b").alias("u"))).distinct(), "ends")
        ends = cut(nodes.select("u", "d", "h", "n").join(small(found), "u"), "ends")
        sets = base.join(small(ends.where(F.col("n") <= POOL).select("u")), "u", "left_semi").select("u", F.col("pool").alias("set"))
        new = ends.where(F.col("n") > POOL).select("u", "d", "h")
        for known in long_sets:
            new = new.join(known.select("u"), "u", "left_anti")
        new = cut(new, "ends")
        if not new.isEmpty():
            same_row = F.col("t.h").eqNullSafe(F.col("w.h")) & F.col("t.d").eqNullSafe(F.col("w.d"))
            # a text of more than POOL shingles has more characters than that
            texts = text.where(F.length("t") > POOL).alias("t").join(small(new).alias("w"), same_row).select("w.u", "t.t")
            long_sets.append(cut(full_sets(texts.groupBy("u").agg(F.min("t").alias("t"))), "sets"))
        for known in long_sets:
            sets = sets.unionByName(known)
        out = cut(confirmed(pairs, sets), "confirmed")
        drop(found, ends, new)
        return out

    known, links = active.withColumn("label", F.col("u")), []
    few, turn, labels = True, 0, None
    while True:
        pairs = cut(candidates(in_blocks(known, pools, few), few), "pairs")
        links.append(links_of(pairs))
        every = links[0]
        for more in links[1:]:
            every = every.unionByName(more)
        if labels is None or not links[-1].isEmpty():  # else all components are as they were
            before, labels = labels, components(every)
            drop(*([before] if before is not None else []))
        drop(pairs)
        if not few:
            break
        known = active.join(labels.withColumnRenamed("node", "u"), "u", "left").withColumn("label", F.coalesce("label", "u"))
        turn += 1
        few = turn < ROUNDS and not links[-1].isEmpty()

    of = nodes.join(labels.withColumnRenamed("node", "u"), "u", "left").withColumn("label", F.coalesce("label", "u"))
    least = of.groupBy("label").agg(F.min("least").alias("component_id"), F.min(F.struct("d", "u")).alias("head"), F.count("*").alias("many"))
    of = join_parts(of, least, ["label"], nodes.count(), "many").select("s1", "s2", "n", "copies", "component_id", F.col("head.u").alias("head"))
    rows = base.select("u", "d", "h", "n", "s1", "s2")
    # a set's copies stay where they are if they are many; texts without words are like no other
    out = join_parts(rows.where("n > 0"), of, ["s1", "s2", "n"], base.count(), "copies").select("d", "h", "n", "component_id", (F.col("u") == F.col("head")).alias("first"))
    out = cut(out.unionByName(rows.where("n = 0").select("d", "h", "n", F.col("d").alias("component_id"), F.lit(True).alias("first"))), "classes")
    drop(base, nodes, active, members, pools, labels, *links, *long_sets)
    return out


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id, kept and first for every row of docs.

    component_id is the least id that links lead to, kept whether that is the row's
    own; first is true for one row of each component, even where rows are repeated
    with one id. Words are split at ASCII white space and A-Z lower-cased; a text
    of fewer than five words is one shingle; null texts and texts without words
    are linked with nothing. A null id counts as none: its row takes the least id
    of the others. Texts of any length are compared whole. An empty table gives an
    empty result. Other columns are not read, so their names may be any.
    """
    same = F.col("d") == F.col("component_id")
    return classes(docs, id_col, text_col).select(F.col("d").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(same, F.lit(False)).alias("kept"), "first")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs less all but one of each component, with their columns as they are; rows are told apart by id and text.

    Of rows repeated with one id and one text any one stays. Null and empty texts
    stay; an empty table gives an empty result.
    """
    found = classes(docs, id_col, text_col)
    keys = cut(found.groupBy("d", "h").agg(F.max("first").alias("stays"), F.count_if("first").alias("times"), F.count("*").alias("many")), "keys")
    drop(found)
    d, h = F.col(id_col).cast("long"), F.xxhash64(text_col)

    def of(which: str) -> tuple[DataFrame, Column]:
        chosen = small(keys.where(which).select(F.col("d").alias("key_d"), F.col("h").alias("key_h")))
        return chosen, d.eqNullSafe(F.col("key_d")) & h.eqNullSafe(F.col("key_h"))

    rows = docs.join(*of("not stays"), "left_anti")
    twice = "stays and times < many"
    if keys.where(twice).isEmpty():
        return rows
    again = rows.join(*of(twice), "left_semi").withColumns({"key_d": d, "key_h": h}).dropDuplicates(["key_d", "key_h"]).drop("key_d", "key_h")
    return rows.join(*of(twice), "left_anti").unionByName(again)
