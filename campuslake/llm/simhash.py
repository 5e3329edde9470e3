"""Near-duplicate documents by fingerprints of 64 bits that differ in few of them.

Every shingle of a text (repeats included) votes with the bits of its hash; the
majority of each bit is the text's fingerprint. Fingerprints are compared exactly,
tile by tile, with exclusive-or and bit counts. A tile holds the fingerprints whose
eight bytes have the same population counts. One flipped bit moves one of these
counts by one, so two tiles whose counts differ by more than RADIUS in sum hold no
link and are never brought together; only what lies in a neighbouring tile is sent
to a tile, and of two neighbours the later one is sent to the earlier one.

Equal fingerprints are one node, so copies cost nothing. A tile of more than BLOCK
fingerprints is dealt into blocks, and what it meets into chunks, so that no task
holds more than a block and a chunk of each neighbour. Of the links that a tile
finds only a spanning forest goes out: links that lead to nothing new are left.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, join_groups, plain, slices, small, split_flat, text_bytes
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints of a tile that meet in one call, and those of each neighbour that they meet.
BLOCK = 4096
#: Shingles whose bits are spread out at a time.
SPREAD = 1 << 17
#: Fingerprints on a side of what is compared at once.
SIDE = 1024


# ---------------------------------------------------------------- fingerprints


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of every text: bit b is set if it is set in over half of its shingles' hashes; zero for a text without words."""
    flat, starts = split_flat(pc.ascii_split_whitespace(pc.ascii_lower(texts)))
    found = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not found.all():
        kept = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(found, out=kept[1:])
        flat, starts = flat.filter(pa.array(found)), kept[starts]
    # every word and a space: a shingle is what lies between two words' ends, less the last space
    spaced = plain(pc.binary_join_element_wise(flat, pa.scalar("", flat.type), pa.scalar(" ", flat.type)))
    data, ends = text_bytes(spaced) if len(spaced) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    data, n = data.tobytes(), np.diff(starts)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, (n > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(n)), count)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + starts[owner]
    last = first + np.minimum(n[owner], SHINGLE)
    digest = xxhash.xxh64_intdigest
    votes = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(owner), SPREAD):
        a, b, of = ends[first[at : at + SPREAD]].tolist(), (ends[last[at : at + SPREAD]] - 1).tolist(), owner[at : at + SPREAD]
        h = np.fromiter((digest(data[x:y], SEED) for x, y in zip(a, b)), np.uint64, len(of))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        votes[of[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """docs (d, t) to (d, f)."""

    def run(batches):
        for piece in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([plain(piece["d"]), pa.array(fingerprints(plain(piece["t"])).view(np.int64))], ["d", "f"])

    return docs.mapInArrow(run, "d long, f long")


# ---------------------------------------------------------------- tiles


def tile_of(f: np.ndarray) -> np.ndarray:
    """The population counts of a fingerprint's eight bytes, four bits each."""
    counts = np.bitwise_count(np.ascontiguousarray(f).view(np.uint8).reshape(-1, 8)).astype(np.int64)
    return (counts << (4 * np.arange(8))).sum(1)


def steps(radius: int) -> np.ndarray:
    """Differences of counts that lead from a tile to the earlier ones within the radius."""
    near = [np.zeros(8, np.int64)]
    for _ in range(radius):
        near += [x + s * np.eye(8, dtype=np.int64)[b] for x, b, s in itertools.product(near, range(8), (-1, 1))]
    near = np.unique(np.array(near), axis=0)
    return near[(near << (4 * np.arange(8))).sum(1) < 0]


def earlier(tiles: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The earlier tiles within the radius of each tile, as positions in tiles and tiles."""
    way = steps(radius)
    counts = tiles[:, None] >> (4 * np.arange(8)) & 15
    at, to = [], []
    for step in way:
        moved = counts + step
        ok = np.flatnonzero(((moved >= 0) & (moved <= 8)).all(1))
        at.append(ok)
        to.append((moved[ok] << (4 * np.arange(8))).sum(1))
    return np.concatenate(at) if at else np.zeros(0, np.int64), np.concatenate(to) if to else np.zeros(0, np.int64)


def sent(nodes: DataFrame, radius: int, block: int) -> DataFrame:
    """(f, tile, chunks, own): each node of (f, tile, m) in its own tile and in the earlier ones within the radius; m: nodes of its tile, if these are many."""

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                part = batch.slice(k, 20_000)
                f, tile, m = (np.asarray(part.column(c)) for c in ("f", "tile", "m"))
                at, to = earlier(tile, radius)
                at, to = np.concatenate([np.arange(len(f)), at]), np.concatenate([tile, to])
                own = np.arange(len(at)) < len(f)
                yield pa.RecordBatch.from_arrays([pa.array(f[at]), pa.array(to), pa.array(-(-m[at] // block)), pa.array(own)], ["f", "tile", "chunks", "own"])

    return nodes.select("f", "tile", "m").mapInArrow(run, "f long, tile long, chunks long, own boolean")


def dealt(nodes: DataFrame, radius: int, block: int = BLOCK) -> tuple[DataFrame, list[DataFrame]]:
    """(tile, x, y, guest, f): which nodes meet in which call; and the tables that this reads.

    A call (tile, x, y) holds block x of the tile's own nodes, and chunk y of what
    they meet: the tile's later blocks, and what neighbours have sent.
    """
    sizes = nodes.groupBy("tile").agg(F.count("*").alias("m")).where(F.col("m") > block)
    large = cut(sizes, "tiles")
    rows = nodes.join(small(large), "tile", "left").withColumn("m", F.coalesce("m", F.lit(1).cast("long")))
    rows = sent(rows, radius, block)
    # how many blocks a tile has, and how many chunks come to it; only where it is more than one
    parts = sent(large.select(F.col("tile").alias("f"), "tile", "m"), radius, block)
    parts = parts.groupBy("tile").agg(F.max(F.when(F.col("own"), F.col("chunks")).otherwise(1)).alias("blocks"), F.max("chunks").alias("every"))
    parts = cut(parts, "tiles")
    one = F.lit(1).cast("long")
    rows = rows.join(small(parts), "tile", "left").withColumns({"blocks": F.coalesce("blocks", one), "every": F.coalesce("every", one)})
    home_block, chunk, zero = F.pmod(F.xxhash64("f"), F.col("blocks")), F.pmod(F.xxhash64("f", F.lit(1)), F.col("chunks")), F.lit(0).cast("long")
    # own nodes: in their block's calls, and as guests of the blocks before; others: guests of all blocks
    home = F.transform(F.sequence(zero, F.col("every") - 1), lambda y: F.struct(home_block.alias("x"), y.alias("y"), F.lit(False).alias("guest")))
    visits = F.when(F.col("own"), home_block).otherwise(F.col("blocks"))
    away = F.when(visits > 0, F.transform(F.sequence(zero, visits - 1), lambda x: F.struct(x.alias("x"), chunk.alias("y"), F.lit(True).alias("guest"))))
    calls = F.when(F.col("own"), F.concat(home, F.coalesce(away, F.array()))).otherwise(away)
    return rows.select("tile", "f", F.explode(calls).alias("c")).select("tile", "c.x", "c.y", "c.guest", "f"), [large, parts]


# ---------------------------------------------------------------- links


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between n nodes that connect what (i, j) connect, n at most: each node with the least that it is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        label = np.minimum(label, label[label])
        if (label == before).all() and (label[i] == label[j]).all():
            break
    at = np.flatnonzero(label != np.arange(n))
    return label[at], at


def links_of_call(own: np.ndarray, guests: np.ndarray, inside: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in own and guests together) of nodes that are linked: own ones with guests and, if inside, with each other."""
    every = np.concatenate([own, guests])
    links = np.zeros((2, 0), np.int64)
    for a in range(0, len(own), SIDE):
        for b in range(a if inside else len(own), len(every), SIDE):
            x, y = own[a : a + SIDE], every[b : b + SIDE]
            i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
            i, j = i + a, j + b
            keep = (i < j) if inside else (j >= len(own))
            links = np.concatenate([links, np.stack([i[keep], j[keep]])], 1)
            if links.shape[1] > 4 * len(every) + SIDE:
                links = np.stack(forest(*links, len(every)))
    if links.shape[1] > len(every):
        links = np.stack(forest(*links, len(every)))
    return links[0], links[1]


def links(calls: DataFrame, radius: int) -> DataFrame:
    """Distinct links (a, b), a < b, that connect what the calls find within the radius."""

    def run(batches):
        held: list[np.ndarray] = []

        def found(t: np.ndarray):
            edge = np.flatnonzero(np.r_[True, (t[:3, 1:] != t[:3, :-1]).any(0)])
            size = np.diff(np.r_[edge, t.shape[1]])
            own = np.add.reduceat(1 - t[3], edge)
            a, b = [], []
            # a call without nodes of its own, or of one node, has nothing to compare
            for at, n, m in zip(*(x[(own > 0) & (size > 1)].tolist() for x in (edge, size, own))):
                f = t[4, at : at + n].view(np.uint64)
                i, j = links_of_call(f[:m], f[m:], bool(t[2, at] == 0), radius)
                if len(i):
                    a.append(f[i].view(np.int64))
                    b.append(f[j].view(np.int64))
            a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = np.stack([np.asarray(batch.column(c)) for c in ("tile", "x", "y", "guest", "f")])
            change = np.flatnonzero((t[:3, 1:] != t[:3, :-1]).any(0))
            if held and (held[-1][:3, -1] != t[:3, 0]).any():
                yield found(np.concatenate(held, 1))
                held = []
            if len(change):  # the last call of a batch may go on in the next one
                yield found(np.concatenate([*held, t[:, : change[-1] + 1]], 1))
                held, t = [], t[:, change[-1] + 1 :]
            held.append(t)
        if held:
            yield found(np.concatenate(held, 1))

    rows = calls.withColumn("guest", F.col("guest").cast("long"))
    rows = rows.repartition("tile", "x", "y").sortWithinPartitions("tile", "x", "y", "guest")
    return rows.mapInArrow(run, "a long, b long").distinct()


# ---------------------------------------------------------------- the operator


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """id_col, fingerprint (16 hexadecimal digits) and component_id for every row of docs.

    component_id is the least id that links of at most radius bits lead to, the
    row's own included. Words are split at ASCII white space and A-Z lower-cased; a
    text of fewer than three words is one shingle; null texts and texts without
    words have fingerprint zero, and are linked like any other. A null id counts as
    none: its row takes the least id of the others, or null. Repeated rows have one
    result each. Texts of any length are read whole. An empty table gives an empty
    result. Other columns are not read, so their names may be any.
    """
    base = cut(fingerprint_rows(docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("t"))), "fingerprints")

    def with_tiles(batches):
        for batch in batches:
            tile = tile_of(np.asarray(batch.column("f"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], [*batch.schema.names, "tile"])

    nodes = base.groupBy("f").agg(F.min("d").alias("least"), F.count("*").alias("n"))
    nodes = cut(nodes.mapInArrow(with_tiles, "f long, least long, n long, tile long"), "nodes")
    calls, sides = dealt(nodes, radius, block)
    found = cut(links(calls, radius), "links")
    labels = components(found)
    of = nodes.join(labels.withColumnRenamed("node", "f"), "f", "left").select("f", "least", "n", F.coalesce("label", "f").alias("label"))
    of = cut(of, "labelled")
    drop(nodes, found, labels, *sides)
    least = of.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("many"))
    total = of.agg(F.count("*"), F.sum("n")).first()
    labelled, of = of, cut(join_groups(of.select("f", "n", "label"), least, ["label"], total[0], "many"), "members")
    drop(labelled)
    out = join_groups(base, of.select("f", "component_id", "n"), ["f"], total[1] or 0)
    return out.select(F.col("d").alias(id_col), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
