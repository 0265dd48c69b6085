"""Best-fit packing of tokenised documents into sequences.

Method: vector best-fit decreasing. A sequence (bin) has residual capacities
of tokens, documents and attention cost (the sum of squared piece lengths).
Pieces come longest first; each goes to the open bin that scores best among
those where every constraint still holds: ``norm`` takes the least weighted
norm of the residual left after placing (normalised by capacity), ``dot`` the
largest weighted dot product of the piece and the residual. A new bin opens
only if none fits.

Pieces are dealt by their written place to groups of about ``GROUP`` pieces, equal
rows too, each packed by one task, so any corpus packs in parallel and no task grows with it; a group
wastes at most about one sequence. Pieces that fill a sequence alone never
meet others. Words are tokenised once per distinct word and batch, which gives
the same ids as whole texts because the tokenizer never joins words across
white space.

Cases: null or empty texts are the closing id alone; repeated rows are packed
each on their own; texts of any length are cut into pieces of ``max_tokens``;
a null doc_id stays null; an empty table gives an empty result. Only doc_id and
text are read, so further columns may have any name.
"""

from __future__ import annotations

import contextlib
import ctypes
import json
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import Run, encode_words, segment_sum, slices, split_words
from flocklens.llm.rank_merge_counts import LONG, NONE, byte_characters, surviving

MAX_TOKENS = 2048
CLOSING_ID = 0
GROUP = 8192
KNOWN_WORDS = 100_000  # words, of KNOWN_LETTERS at most, whose ids a task remembers between batches
KNOWN_LETTERS = 40

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


# words that the tokenizer splits before merging into one part (letters) or two
# (letters, then ASCII punctuation), whatever follows; letters whose lower case is
# one letter and which compose with nothing
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
_SIMPLE = f"^{_LETTERS}[!-/:-@\\[-`{{-~]*$"
_PLAIN = (f"^{_LETTERS}$", f"^{_LETTERS}[!-/:-@\\[-`{{-~]+$")


class LetterMerges:
    """The merges of a byte-level BPE file with a word-end mark, for plain words:
    their parts are the letters and, if any, the punctuation after them."""

    def __init__(self, model: dict, end_mark: str):
        vocab = model["vocab"]
        table = [c for _, c in sorted(byte_characters().items())]
        self.inner, self.last = (np.array([vocab.get(c + mark, 0) for c in table], np.int32) for mark in ("", end_mark))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]
        code = np.arange(256)
        self.mark = (code < 128) & ~np.isin(code, np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8))

    @classmethod
    def of(cls, path: str, end_mark: str) -> LetterMerges | None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")]
        odd.append(not {*byte_characters().values()} <= {*model.get("vocab", ())})
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != end_mark or any(odd):
            return None
        return cls(model, end_mark)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of each word's) of plain words."""
        words = pc.utf8_lower(words)
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        letters = np.frombuffer("".join(words.to_pylist()).encode(), np.uint8)
        begins = np.zeros(len(letters), bool)
        begins[np.cumsum(size) - size] = True
        word = np.cumsum(begins) - 1
        mark = self.mark[letters]
        begins[1:] |= mark[1:] & ~mark[:-1]
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, len(letters)))
        symbols = self.inner[letters]
        ends = starts + sizes - 1
        symbols[ends] = self.last[letters[ends]]
        kept: list = []
        many = surviving(symbols, sizes, self, kept)
        of = np.concatenate([np.repeat(k, many[k]) for k, _ in kept])
        ids = np.concatenate([s for _, s in kept])[np.argsort(of, kind="stable")].astype(np.uint32)
        return ids, np.bincount(word[starts], weights=many, minlength=len(size)).astype(np.int64)


class WordIds:
    """Token ids of words by a ``tokenizers`` file, with a bounded memory.

    Plain words of one shape are encoded many at a time, joined by spaces, and
    told apart by the tokens that end a part; all others one by one."""

    def __init__(self, path: str, end_mark: str = "</w>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(end_mark)]] = True
        self.known: dict[str, bytes] = {}
        self.letters = LetterMerges.of(path, end_mark)

    def _encode(self, words: list[str], parts: int) -> list[bytes]:
        """Ids of ``words`` that the tokenizer splits into ``parts`` each."""
        out: list[bytes] = []
        for a in range(0, len(words), 10_000):
            some = words[a : a + 10_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cut = np.flatnonzero(self.ends[ids])[parts - 1 :: parts] + 1
            if len(cut) != len(some) or cut[-1] != len(ids):
                out += self._one_by_one(some)
                continue
            raw, cut = ids.tobytes(), (4 * cut).tolist()
            out += [raw[x:y] for x, y in zip([0, *cut], cut)]
        return out

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def __call__(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets) of the distinct words."""
        simple = np.zeros(len(distinct), bool)
        if self.letters is not None and len(distinct):
            simple = np.asarray(pc.match_substring_regex(distinct, _SIMPLE).to_numpy(zero_copy_only=False), bool)
            simple &= pc.binary_length(distinct).to_numpy(zero_copy_only=False) <= LONG
        many = np.zeros(len(distinct), np.int64)
        parts = []
        for mask, encode in ((simple, self.letters), (~simple, self._others)):
            if mask.any():
                ids, many[mask] = encode(distinct.filter(pa.array(mask)))
                parts.append((mask, ids))
        offsets = np.concatenate(([0], np.cumsum(many)))
        flat = np.empty(int(offsets[-1]), np.uint32)
        for mask, ids in parts:
            flat[np.repeat(mask, many)] = ids
        return flat, offsets

    def _others(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = distinct.to_pylist()
        missing = [w for w in words if w not in self.known]
        found: dict[str, bytes] = {}
        if missing:
            array = pa.array(missing, pa.string())
            shape = np.zeros(len(missing), dtype=np.int64)
            if self.ends.any():
                for parts, pattern in enumerate(_PLAIN, 1):
                    shape[np.asarray(pc.match_substring_regex(array, pattern).to_numpy(zero_copy_only=False), dtype=bool)] = parts
            for parts in range(len(_PLAIN) + 1):
                some = [missing[i] for i in np.flatnonzero(shape == parts)]
                if some:
                    found.update(zip(some, self._encode(some, parts) if parts else self._one_by_one(some)))
        ids = [found[w] if w in found else self.known[w] for w in words]
        if len(self.known) + len(found) > KNOWN_WORDS:
            self.known.clear()
        self.known.update((w, i) for w, i in islice(found.items(), KNOWN_WORDS) if len(w) <= KNOWN_LETTERS)
        size = np.array([len(i) for i in ids], dtype=np.int64) // 4
        return np.frombuffer(b"".join(ids), np.uint32), size


def token_ids(text: pa.Array, word_ids: WordIds, closing_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(uint32 ids of all texts, each followed by the closing id; offsets)."""
    words, offsets = split_words(text)
    codes, distinct = encode_words(words)
    flat, at = word_ids(distinct)
    size = np.diff(at)[codes]
    lengths = segment_sum(size, offsets) + 1
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
    closing = np.zeros(len(out), dtype=bool)
    closing[ends - 1] = True
    first = np.cumsum(size) - size
    source = np.repeat(at[:-1][codes] - first, size) + np.arange(int(size.sum()))
    out[~closing] = flat[source]
    out[closing] = closing_id
    return out, np.concatenate(([0], ends))


def _give_back() -> None:
    """Returns free memory, also what earlier tasks of this worker left, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def _pieces(path: str, max_tokens: int, closing_id: int, with_ids: bool):
    def run(batches):
        _give_back()
        word_ids = WordIds(path)
        for batch in batches:
            for part in slices(batch, "text", max_bytes=2 << 20):
                ids, offsets = token_ids(part.column("text"), word_ids, closing_id)
                ids = ids.astype("<u4")
                n = np.diff(offsets)
                pieces = -(-n // max_tokens)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * max_tokens
                length = np.minimum(max_tokens, n[doc] - start)
                begin = offsets[:-1][doc] + start
                view = memoryview(ids).cast("B")
                blobs = [view[4 * a : 4 * (a + k)] for a, k in zip(begin.tolist(), length.tolist())]
                yield pa.record_batch(
                    [
                        part.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array([zlib.crc32(b) for b in blobs], pa.int64()),
                        pa.array([bytes(b) for b in blobs] if with_ids else [None] * len(doc), pa.binary()),
                    ],
                    schema=_PIECE,
                )
            _give_back()

    return run


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str) -> np.ndarray:
    """The bin of each piece; ``capacity`` of tokens, documents, attention cost."""
    items = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1).astype(np.float64) / capacity
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    least = items[order[-1]] if len(order) else None
    bins = np.full(len(lengths), -1, dtype=np.int64)
    open_ids = np.empty(len(lengths), dtype=np.int64)
    residual = np.empty((len(lengths), 3))
    n_open = made = 0
    eps = 1e-12
    for k in order:
        item = items[k]
        left = residual[:n_open]
        fits = np.flatnonzero((left >= item - eps).all(axis=1)) if n_open else ()
        if len(fits):
            if rule == "norm":
                rest = left[fits] - item
                best = fits[((rest * rest) @ weights).argmin()]
            else:
                best = fits[(left[fits] @ (weights * item)).argmax()]
        else:
            best = n_open
            open_ids[best], residual[best] = made, 1.0
            n_open, made = n_open + 1, made + 1
        bins[k] = open_ids[best]
        residual[best] -= item
        if (residual[best] < least - eps).any():  # nothing fits any more: close it
            n_open -= 1
            open_ids[best], residual[best] = open_ids[n_open], residual[n_open]
    return bins


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    max_tokens: int = MAX_TOKENS,
    max_docs: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6),
    rule: str = "norm",
    closing_id: int = CLOSING_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset (and ids, little-endian uint32).

    Without ``max_docs`` and ``max_attention`` those two constraints are as
    wide as the token limit itself (a sequence of ``max_tokens`` documents, or of
    one document of ``max_tokens``)."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    if max_attention is not None and max_attention < max_tokens * max_tokens:
        # a piece alone must fit: cut pieces at the attention limit
        max_piece = min(max_tokens, int(max_attention**0.5))
    else:
        max_piece = max_tokens
    capacity = np.array([max_tokens, max_docs or max_tokens, max_attention or max_tokens * max_tokens], dtype=np.float64)
    run = Run(docs.sparkSession, "packing")
    pieces = docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer_path, max_piece, closing_id, with_ids),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary",
    )
    pieces = run.keep(pieces if with_ids else pieces.drop("ids"), "pieces")
    groups = max(1, -(-pieces.count() // GROUP))
    # by the written row, so that equal rows are dealt out too
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    weight = np.array(weights, dtype=np.float64)

    def place(key, frame):
        frame = frame.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable")
        lengths = frame["length"].to_numpy(np.int64)
        bins = best_fit(lengths, capacity, weight, rule)
        order = np.argsort(bins, kind="stable")
        total = np.cumsum(lengths[order]) - lengths[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = bins[order][1:] != bins[order][:-1]
        offset = np.empty(len(order), dtype=np.int64)
        offset[order] = total - np.maximum.accumulate(np.where(new, total, 0))
        frame = frame.drop(columns="bucket")
        return frame.assign(sequence_id=(np.int64(key[0]) << np.int64(32)) + bins, offset=offset)

    fields = pieces.withColumns({"doc_id": F.col("doc_id").cast("string"), "bucket": key})
    out = ", ".join(f"{n} {t}" for n, t in fields.drop("bucket").dtypes)
    packed = fields.groupBy("bucket").applyInPandas(place, f"{out}, sequence_id long, offset long")
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))
