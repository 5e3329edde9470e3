"""Statistics of whole texts, computed with numpy on Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import distinct_per_row, mix, per_text, plain, split_flat, text_bytes, windows, words

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8

#: Counts for each text, all exact integers.
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_upper", "n_lower", "n_bytes", "n_digits", "n_marks", "n_stops", "n_bangs",
    "n_spaces", "n_wide", "n_letter_words", "n_long_words", "n_pipes",
]


def byte_table(of: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(of)] = 1
    return out


#: One byte class for each row; UTF-8 keeps ASCII bytes out of other characters.
CLASSES = {
    "n_symbols": byte_table(SYMBOLS),
    "n_digits": byte_table(b"0123456789"),
    "n_marks": byte_table(b",.;:?'\"()-"),
    "n_stops": byte_table(b"."),
    "n_bangs": byte_table(b"!"),
    "n_spaces": byte_table(b" \t\n\v\f\r"),
    "n_wide": byte_table(bytes(range(0xC0, 0x100))),
    "n_pipes": byte_table(b"|"),
    "ascii_upper": byte_table(bytes(range(65, 91))),
    "ascii_lower": byte_table(bytes(range(97, 123))),
}


def repeated_words(codes: np.ndarray, starts: np.ndarray, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of `width` words found twice or more in that text."""
    h, first, owner = windows(codes, starts, width)
    if not len(h):
        return np.zeros(len(starts) - 1, np.int64)
    key = h ^ mix(owner + 1)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, first[twice], 1)
    np.add.at(edge, first[twice] + width, -1)
    return per_text(np.cumsum(edge)[:-1] > 0, starts)


def stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of every text. Lines are split at \\n only; words are `[^\\x20\\x09-\\x0D]+`."""
    texts = plain(texts)
    codes, starts, known = words(texts)
    n = len(texts)
    rows = np.repeat(np.arange(n), np.diff(starts))
    out = {"n_words": np.diff(starts), "n_repeat_words": repeated_words(codes, starts)}

    sizes = pc.utf8_length(known).to_numpy(zero_copy_only=False).astype(np.int64)
    out["word_chars"] = per_text(sizes[codes], starts)
    out["n_long_words"] = per_text(sizes[codes] > 15, starts)
    letters = pc.match_substring_regex(known, r"\p{L}").to_numpy(zero_copy_only=False)
    out["n_letter_words"] = per_text(letters[codes], starts)
    # cased letters beyond ASCII are counted from the distinct words
    upper = pc.count_substring_regex(known, r"\p{Lu}").to_numpy(zero_copy_only=False).astype(np.int64)
    lower = pc.count_substring_regex(known, r"\p{Ll}").to_numpy(zero_copy_only=False).astype(np.int64)
    out["n_upper"], out["n_lower"] = per_text(upper[codes], starts), per_text(lower[codes], starts)
    out["n_distinct"] = distinct_per_row(rows, codes, len(known), n)

    data, ends = text_bytes(texts)
    out["n_bytes"] = np.diff(ends)
    for name, chosen in CLASSES.items():
        if name.startswith("n_"):
            out[name] = per_text(chosen[data], ends)

    flat, at = split_flat(pc.split_pattern(texts, "\n"))
    coded = flat.dictionary_encode()
    lines = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.not_equal(pc.ascii_trim_whitespace(coded.dictionary), "").to_numpy(zero_copy_only=False)[lines] if len(lines) else np.zeros(0, bool)
    owner = np.repeat(np.arange(n), np.diff(at))[full]
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = out["n_lines"] - distinct_per_row(owner, lines[full], len(coded.dictionary), n)
    return {k: np.asarray(out[k], np.int64) for k in COUNTS}
