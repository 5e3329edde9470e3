"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from sampled texts.
A text is compressed with every dictionary and goes to the language whose
dictionary makes it smallest; where the smallest is hardly smaller than the
next, the text is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import cut_at_spaces, held_out, plain, slices

UNKNOWN = "und"
DOCS_PER_LANG = 120
DICT_BYTES = 48_000
#: Short texts leave a part of the dictionary to longer ones, whose excerpts are so many shares long.
EXCERPTS = 4
PIECE_BYTES = 2048
LEVEL = 12
#: Zero bytes after each piece: without them zstandard stores many short pieces as they are.
FILL = bytes(256)
#: Each byte saved makes a language 2 ** SHARPNESS times as likely.
SHARPNESS = 2.0
#: Rejected: the runner-up needs less than this share more bytes.
MIN_MARGIN = 0.01


def compressor(content: bytes, level: int) -> zstd.ZstdCompressor:
    """A compressor whose dictionary is the content as it stands."""
    words = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=level)
    return zstd.ZstdCompressor(level=level, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """Dictionary content for each language, from excerpts of at most docs_per_lang texts of each.

    Only rows that are not held out and whose language is not null are read; the
    texts are those with the smallest hash of id and text, whatever their length.
    An excerpt begins at a place that the hash picks anywhere in the text, and is
    EXCERPTS times as long as the text's even share of the dictionary at most.
    """
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    # ranking carries ids and hashes only; each partition passes on docs_per_lang rows of a language at most
    keys = rows.select("lang", "id", "h").withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("h", "id")))
    chosen = keys.where(F.col("rank") <= docs_per_lang).drop("rank").distinct()
    width = EXCERPTS * -(-dict_bytes // docs_per_lang)
    at = 1 + F.pmod("h", F.greatest(F.length("text") - width + 1, F.lit(1)))
    excerpt = F.lower(F.col("text").substr(at.cast("int"), F.lit(width)))
    texts = rows.join(F.broadcast(chosen), ["lang", "id", "h"]).groupBy("lang", "id", "h").agg(F.min(excerpt).alias("text"))
    by_lang: dict[str, list[bytes]] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["lang"], r["h"], str(r["id"]))):
        by_lang.setdefault(r["lang"], []).append(r["text"].encode())
    out = {}
    for lang, found in by_lang.items():
        left, parts = dict_bytes, []
        for k, text in enumerate(sorted(found, key=len)):
            parts.append(text[: max(1, left // (len(found) - k))])
            left -= len(parts[-1])
        out[lang] = b"\n".join(parts)
    return out


def sizes(texts: list[bytes], tools: list[zstd.ZstdCompressor]) -> np.ndarray:
    """Bytes of each text, compressed piece by piece, under each dictionary."""
    out = np.zeros((len(texts), len(tools)), np.int64)
    for k, text in enumerate(texts):
        for piece in cut_at_spaces(text, PIECE_BYTES):
            piece += FILL
            for j, tool in enumerate(tools):
                out[k, j] += len(tool.compress(piece))
    return out


def identify(docs: DataFrame, model: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", min_margin: float = MIN_MARGIN, carry: list[str] | None = None) -> DataFrame:
    """id_col, lang_pred, score, margin and rejected for every row; carry names further columns of docs to keep, as c0, c1, and so on.

    lang_pred is a language of the model, or `und` (score 0, rejected) where the
    text is null or has no letter, or where the model is empty. Equal sizes go to
    the language that comes first by name. Repeated rows get equal results; an
    empty table gives an empty result. Texts of any length are compressed whole,
    piece by piece. Columns that are not named are not read, so their names may be
    any.
    """
    carry = carry or []
    names = sorted(model)
    contents = [model[k] for k in names]
    inside = [f"c{k}" for k in range(len(carry))]

    def run(batches):
        tools = [compressor(c, LEVEL) for c in contents]
        for piece in slices(batches, "t"):
            texts = plain(piece["t"])
            letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            lowered = pc.utf8_lower(texts).to_pylist()
            n = len(lowered)
            lang, score, margin = [UNKNOWN] * n, np.zeros(n), np.zeros(n)
            if names:
                rows = np.flatnonzero(letters)
                found = sizes([lowered[i].encode() for i in rows], tools)
                best = found.argmin(1) if len(rows) else np.zeros(0, int)
                least = found[np.arange(len(rows)), best]
                score[rows] = 1 / np.exp2(-SHARPNESS * np.minimum(found - least[:, None], 500)).sum(1) if len(rows) else []
                if len(names) > 1 and len(rows):
                    second = np.partition(found, 1, axis=1)[:, 1]
                    margin[rows] = (second - least) / second
                elif len(rows):
                    margin[rows] = 1.0
                for i, b in zip(rows, best):
                    lang[i] = names[b]
            yield pa.RecordBatch.from_arrays(
                [plain(piece["i"]), pa.array(lang), pa.array(score), pa.array(margin), pa.array((margin < min_margin) | ~letters), *[plain(piece[k]) for k in inside]],
                ["i", "lang_pred", "score", "margin", "rejected", *inside],
            )

    fields = [T.StructField("i", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType(fields + [T.StructField(k, docs.schema[c].dataType) for k, c in zip(inside, carry)])
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), *[F.col(c).alias(k) for k, c in zip(inside, carry)]).mapInArrow(run, schema)
    return rows.select(F.col("i").alias(id_col), "lang_pred", "score", "margin", "rejected", *inside)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """identify() with what learn() finds in docs itself, and whether each row was held out from it."""
    return identify(docs, learn(docs, id_col, text_col, lang_col), id_col, text_col).withColumn("held_out", held_out(id_col))
