"""Byte-level BPE over a trie of the distinct words.

The encoding of a word is told by the last token of each of its prefixes: token t
is the last one of a prefix exactly if it is a suffix of the prefix and stands
after the last token of what is before it without any merge across the two. The
distinct words of a batch are walked depth first in sorted order, which is the
walk of their trie: the states of a shared prefix are computed once. Which tokens
are suffixes of a prefix is told by an automaton of all tokens, whose state goes
down the trie with the walk: no bytes are cut out and looked up.

Texts are cut into words by a pattern over classes of characters. The tables of
these classes differ between Unicode versions, so the two engines at hand are
compared over all characters once a process; a text that holds a character on
which they differ is cut by the tokenizers library itself. Texts of Latin letters
are cut by the same pattern with these classes spelled out, which is faster.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from functools import cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Regex, Tokenizer, pre_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import plain, slices

#: Fixed value: how the byte-level vocabulary cuts text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose encodings a task keeps from one batch to the next; beyond it starts anew.
MEMO_WORDS = 300_000
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@cache
def differing() -> str | None:
    """A pattern of the characters that the two engines put into different classes, or None if there are none."""
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    found: set[int] = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        here = set(map(ord, regex.findall(kind, every)))
        there = pre_tokenizers.Split(Regex(f"{kind}+"), "removed", invert=True).pre_tokenize_str(every)
        found |= here ^ {ord(c) for part, _ in there for c in part}
    points = np.array(sorted(found), np.int64)
    if not len(points):
        return None
    runs = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    return "[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "]"


#: Texts whose characters are all below are cut with classes that are spelled out.
LATIN = 0x250


@cache
def latin_words() -> re.Pattern:
    """WORDS for texts of characters below LATIN, with the classes as the tokenizers library has them."""
    every = "".join(map(chr, range(LATIN)))

    def members(kind: str) -> str:
        parts = pre_tokenizers.Split(Regex(f"{kind}+"), "removed", invert=True).pre_tokenize_str(every)
        return "".join(re.escape(c) for part, _ in parts for c in part)

    letters, digits, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{space}{letters}{digits}]+|[{space}]+(?![^{space}])|[{space}]+")


class Vocabulary:
    """The tokens of a byte-level BPE file of the tokenizers library, and the encoder of its words."""

    def __init__(self, path: str, odd: str | None):
        """odd: what differing() gives."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.id_of = {as_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {v: k for k, v in self.id_of.items()} | {v: k.encode() for k, v in self.special.items()}
        self.merged, self.born, self.left, self.right = {}, {}, {}, {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            x, y, z = self.id_of[a], self.id_of[b], self.id_of[a + b]
            self.merged[x, y] = (rank, z)
            if z not in self.born:
                self.born[z], self.left[z], self.right[z] = rank, x, y
        # the automaton: children of nodes, by node and byte; of each node the tokens that end there, the longest first
        child: dict[int, int] = {}
        own: list[tuple] = [()]
        for token, k in self.id_of.items():
            at = 0
            for b in token:
                down = child.get(at << 8 | b)
                if down is None:
                    child[at << 8 | b] = down = len(own)
                    own.append(())
                at = down
            own[at] = ((len(token), k),)
        self.child, self.fails, self.ends = child, [0] * len(own), own
        below: dict[int, list[tuple[int, int]]] = {}
        for key, down in child.items():
            below.setdefault(key >> 8, []).append((key & 255, down))
        level = [down for _, down in below.get(0, [])]
        while level:  # a node goes back to the longest suffix of what it spells that is a node too
            later = []
            for at in level:
                own[at] += own[self.fails[at]]
                for b, down in below.get(at, []):
                    self.fails[down] = self.go(self.fails[at], b)
                    later.append(down)
            level = later
        self.steps = dict(child)
        self.apart: dict[int, bool] = {}
        self.splitter = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.words, self.latin, self.beyond = regex.compile(WORDS), latin_words(), re.compile(f"[^\0-{chr(LATIN - 1)}]")
        self.tool, self.letters, self.odd = Tokenizer.from_file(path).pre_tokenizer, letters, regex.compile(odd) if odd else None

    def go(self, at: int, b: int) -> int:
        """The node after one more byte: the longest suffix of what has been read that is a node."""
        while at and at << 8 | b not in self.child:
            at = self.fails[at]
        return self.child.get(at << 8 | b, 0)

    def stays_apart(self, a: int, b: int) -> bool:
        """Whether a then b, encoded together, give just these two.

        Going back in time the later-made of the two parts at the border falls
        into its halves. A merge across the border happens if its rank comes
        before each part was taken up by its parent; of equal ranks the left one
        goes first.
        """
        known = self.apart.get(a << 32 | b)
        if known is not None:
            return known
        if len(self.apart) > 2_000_000:
            self.apart.clear()
        x, y, x_gone, y_gone, out = a, b, NEVER, NEVER, True
        while True:
            found = self.merged.get((x, y))
            if found and found[0] < x_gone and found[0] <= y_gone:
                out = False
                break
            x_made, y_made = self.born.get(x, -1), self.born.get(y, -1)
            if x_made < 0 and y_made < 0:
                break
            if x_made > y_made:
                x_gone, x = x_made, self.right[x]
            elif y_made > x_made:
                y_gone, y = y_made, self.left[y]
            else:  # both made by the same merge: the left one came first, so the right one falls first
                y_gone, y = y_made, self.left[y]
        self.apart[a << 32 | b] = out
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids (little-endian unsigned 32-bit) of each word; the words must be sorted and distinct."""
        out, path, before = [], [], b""
        tokens, starts, nodes = [], [], []  # of each prefix of the word: its last token, where that begins, its node
        if len(self.steps) > 4_000_000:
            self.steps = dict(self.child)
        apart, stays, steps, ends, go = self.apart, self.stays_apart, self.steps, self.ends, self.go
        for word in words:
            # back up the trie to the node that this word shares with the last one
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del tokens[same:], starts[same:], nodes[same:]
            at = nodes[-1] if same else 0
            for end in range(same, len(word)):
                key = at << 8 | word[end]
                step = steps.get(key)
                if step is None:
                    step = steps[key] = go(at, word[end])
                at = step
                for size, token in ends[at]:
                    start = end + 1 - size
                    if start:
                        known = apart.get(tokens[start - 1] << 32 | token)
                        if not (known if known is not None else stays(tokens[start - 1], token)):
                            continue
                    tokens.append(token)
                    starts.append(start)
                    nodes.append(at)
                    break
                else:
                    raise ValueError(f"no token ends {word[: end + 1]!r}")
            path.clear()
            end = len(word)
            while end:
                path.append(tokens[end - 1])
                end = starts[end - 1]
            path.reverse()
            out.append(pack(f"<{len(path)}I", *path))
            before = word
        return out

    def cut(self, text: str) -> list[str | bytes]:
        """The words of a text in order, as text or as bytes."""
        if text.isascii() or not self.beyond.search(text):
            return self.latin.findall(text)
        if not self.odd or not self.odd.search(text):
            return self.words.findall(text)
        return [bytes(self.letters[c] for c in part) for part, _ in self.tool.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str | bytes | int]:
        """The words of a text in order; a special token's own text is its id."""
        if not self.splitter or not self.splitter.search(text):
            return self.cut(text)
        out, at = [], 0
        for m in self.splitter.finditer(text):
            out += [*self.cut(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self.cut(text[at:])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def vocabulary(path: str, odd: str | None) -> Vocabulary:
    return Vocabulary(path, odd)


class Encoder:
    """Encodes batches of texts; keeps words from batch to batch."""

    def __init__(self, path: str, odd: str | None, memo_words: int = MEMO_WORDS):
        self.vocabulary, self.memo, self.most = vocabulary(path, odd), {}, memo_words

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self.vocabulary.pieces(t) for t in texts]
        wanted = {w for s in split for w in s}
        if len(self.memo) + len(wanted) > self.most:
            self.memo = {}
        new = [(w if isinstance(w, bytes) else w.encode(), w) for w in wanted if w not in self.memo and not isinstance(w, int)]
        known = sorted({b for b, _ in new})
        found = dict(zip(known, self.vocabulary.encode_words(known)))
        self.memo.update((w, found[b]) for b, w in new)
        self.memo.update((w, np.array([w], "<u4").tobytes()) for w in wanted if isinstance(w, int))
        get = self.memo.__getitem__
        return [b"".join(map(get, s)) for s in split]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """id_col, n_tokens, ids (binary: little-endian unsigned 32-bit), ids_sha256 and decoded_sha256 for every whole text.

    path: the vocabulary file, present on every executor. A null text counts as
    empty: no ids. keep_text adds the decoded text. Repeated rows get equal
    results; an empty table gives an empty result. Texts of any length are encoded
    whole, and every text gets the ids that the tokenizers library gives it.
    Columns other than the two are not read, so their names may be any.
    """
    odd = differing()  # found once, on the driver

    def run(batches):
        encode = Encoder(path, odd)
        for piece in slices(batches, "t"):
            ids = encode(plain(piece["t"]).to_pylist())
            decoded = [encode.vocabulary.decode(x) for x in ids]
            columns = {
                "i": plain(piece["i"]),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids": pa.array(ids, pa.binary()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string()),
            }
            if keep_text:
                columns["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = [("i", docs.schema[id_col].dataType), ("n_tokens", T.LongType()), ("ids", T.BinaryType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields + [("decoded", T.StringType())] * keep_text])
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, schema).withColumnRenamed("i", id_col)
