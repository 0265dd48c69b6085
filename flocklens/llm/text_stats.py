"""Structure statistics of whole texts, computed per Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from flocklens.llm.common import Windows, covered, encode_words, hash_strings, mix64, one_array, segment_sum, split_words

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
REPEAT_WINDOW = 8


def _table(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)], dtype=np.uint8)


_IN_WORD = _table(lambda b: b not in SPACES and not 0x80 <= b < 0xC0)  # one per code point
_SYMBOL = _table(lambda b: b in SYMBOLS)
_UPPER = _table(lambda b: 65 <= b <= 90)
_LETTER = _table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0)
_DIGIT = _table(lambda b: 48 <= b <= 57)
_LOUD = _table(lambda b: b in b"!?")


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and each text's offsets into them."""
    n = len(text)
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    data = text.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _counted(table: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(table[raw], offsets[:-1][some], dtype=np.int64)
    return out


def text_stats(text: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Counts per text, and (word hashes, offsets); a null text counts as empty.

    n_words, word_chars (code points in words), n_symbols, n_upper, n_letters,
    n_digits, n_loud (! and ?), n_bare (words without a letter), n_marked (words
    with two symbols in a row), n_stutter (words equal to the word before), n_lines (lines with a word), n_dup_lines (those
    equal to an earlier one) and n_repeat_words (words in 8-word windows found
    twice or more in the text)."""
    text = one_array(text)
    raw, at = text_bytes(text)
    words, offsets = split_words(text)
    codes, distinct = encode_words(words)
    hashes = hash_strings(distinct)[codes]
    n = len(text)
    stats = {"n_words": np.diff(offsets)}
    for name, pattern in (("n_bare", r"^[^\pL]+$"), ("n_marked", r"[#*$%&|<>]{2}")):
        hit = np.asarray(pc.match_substring_regex(distinct, pattern).to_numpy(zero_copy_only=False), dtype=bool)
        stats[name] = segment_sum(hit[codes].astype(np.int64), offsets)
    for name, table in (
        ("word_chars", _IN_WORD),
        ("n_symbols", _SYMBOL),
        ("n_upper", _UPPER),
        ("n_letters", _LETTER),
        ("n_digits", _DIGIT),
        ("n_loud", _LOUD),
    ):
        stats[name] = _counted(table, raw, at)
    again = np.zeros(len(codes), dtype=np.int64)
    again[1:] = codes[1:] == codes[:-1]
    again[offsets[:-1][np.diff(offsets) > 0]] = 0
    stats["n_stutter"] = segment_sum(again, offsets)

    lists = pc.split_pattern(text, "\n")
    lines = lists.flatten()
    doc = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    worded = np.asarray(pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False)) > 0
    doc, lines = doc[worded], lines.filter(pa.array(worded))
    line_codes, _ = encode_words(lines)
    seen = np.unique(doc * (len(lines) + 1) + line_codes) // (len(lines) + 1)
    stats["n_lines"] = np.bincount(doc, minlength=n)
    stats["n_dup_lines"] = stats["n_lines"] - np.bincount(seen, minlength=n)

    win = Windows(hashes, offsets)
    starts = win.starts(REPEAT_WINDOW)
    of = np.searchsorted(offsets, starts, side="right") - 1
    own = mix64(win.at(starts, REPEAT_WINDOW) + mix64(of.astype(np.uint64)))  # equal within one text only
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    stats["n_repeat_words"] = segment_sum(covered(starts[twice], REPEAT_WINDOW, len(words)).astype(np.int64), offsets)
    return stats, hashes, offsets
