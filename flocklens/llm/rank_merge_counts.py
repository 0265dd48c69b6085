"""Token counts of a byte-level BPE by rank-synchronous array merging.

Method: texts are cut at the strings of special tokens and then into pre-tokens.
The distinct pre-tokens of a batch lie one after the other in one symbol array
with offsets (ragged). In every step each sequence merges its lowest-rank pair,
at all of its places at once from the left; only the ranks beside a merge are
looked up again, and sequences without a mergeable pair leave with the number
of symbols that survive. Sequences of more than ``LONG`` bytes would need many
steps over a long array: they are linked instead, and their pairs wait in
buckets by rank, so that a step touches the places of its rank only. Both apply
the lowest rank of each sequence first, so both give the library's count.

A text of any length is cut into runs of ``RUN`` pre-tokens, so a task holds a
batch of pre-tokens, not a text's; a single pre-token takes about 24 bytes of
memory for each of its bytes. Counts of short pre-tokens are remembered between
batches in a memory of at most ``KNOWN`` entries of at most 32 characters.

Cases: a null text counts as empty (no bytes, no tokens); rows come back one for
one, repeated rows alike; an empty table gives an empty result; only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

import heapq
import json
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from flocklens.llm.common import encode_words, one_array, segment_sum, slices

NONE = np.int32(np.iinfo(np.int32).max)  # the rank of a pair that never merges
LONG = 192
RUN = 1 << 17
KNOWN = 1 << 18
_SUFFIXES = r"'s|'t|'re|'ve|'m|'ll|'d"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Merges:
    """The merge table of a tokenizer file, as sorted arrays (some MB)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre["add_prefix_space"]
        odd = [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")]
        if model["type"] != "BPE" or not plain or any(odd):
            raise ValueError(f"{path}: only byte-level BPE with its default pre-tokens")
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for _, c in sorted(byte_characters().items())], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        self.ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.ranks]
        special = [t for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError(f"{path}: special tokens that take in what stands beside them")
        self.special = sorted((t["content"] for t in special), key=len, reverse=True)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)


def alternate(hits: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of ascending hits those that merge from the left: a hit whose second
    symbol is the first of the next hit (``follows[k]``: hit k starts where hit
    k - 1 ends) leaves that one out."""
    if not follows.any():
        return hits
    number = np.arange(len(hits))
    first = np.maximum.accumulate(np.where(follows, 0, number))
    return hits[(number - first) % 2 == 0]


def surviving(symbols: np.ndarray, sizes: np.ndarray, merges: Merges, kept: list | None = None) -> np.ndarray:
    """How many symbols survive in each sequence; ``sizes`` of at least 1. ``kept``
    takes the survivors themselves, as (sequences, their symbols one after the other)."""
    out = np.zeros(len(sizes), np.int64)
    live = np.arange(len(sizes))
    rank = np.full(len(symbols), NONE)
    rank[:-1] = merges.rank(symbols[:-1], symbols[1:])
    rank[np.cumsum(sizes) - 1] = NONE  # the last symbol has no right neighbour
    while len(live):
        starts = np.cumsum(sizes) - sizes
        low = np.minimum.reduceat(rank, starts)
        done = low == NONE
        if done.any():
            out[live[done]] = sizes[done]
            stays = np.repeat(~done, sizes)
            if kept is not None:
                kept.append((live[done], symbols[~stays]))
            symbols, rank = symbols[stays], rank[stays]
            live, sizes, low = live[~done], sizes[~done], low[~done]
            if not len(live):
                break
        hits = np.flatnonzero(rank == np.repeat(low, sizes))
        hits = alternate(hits, np.diff(hits, prepend=-2) == 1)
        ends = np.cumsum(sizes)
        of = np.searchsorted(ends, hits, side="right")
        symbols[hits] = merges.made[rank[hits]]
        rank[hits] = rank[hits + 1]  # the end of a sequence stays one
        gone = np.ones(len(symbols), bool)
        gone[hits + 1] = False
        symbols, rank = symbols[gone], rank[gone]
        sizes = sizes - np.bincount(of, minlength=len(sizes))
        hits = hits - np.arange(len(hits))  # one symbol less for each merge before
        ends = np.cumsum(sizes)
        first = np.zeros(len(symbols), bool)
        first[ends[:-1]] = True
        last = np.zeros(len(symbols), bool)
        last[ends - 1] = True
        again = np.concatenate([hits[~last[hits]], hits[~first[hits] & (hits > 0)] - 1])
        rank[again] = merges.rank(symbols[again], symbols[again + 1])
    return out


def surviving_linked(symbols: np.ndarray, sizes: np.ndarray, merges: Merges) -> np.ndarray:
    """As ``surviving``, for long sequences: linked symbols, places by rank."""
    n = len(symbols)
    after = np.arange(1, n + 1, dtype=np.int32)
    before = np.arange(-1, n - 1, dtype=np.int32)
    ends = np.cumsum(sizes)
    after[ends - 1] = -1
    before[ends - sizes] = -1
    rank = np.full(n, NONE)
    waiting: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def wait(places: np.ndarray) -> None:
        places = places[after[places] >= 0]
        found = merges.rank(symbols[places], symbols[after[places]])
        rank[places] = found
        places, found = places[found < NONE], found[found < NONE]
        by = np.lexsort((places, found))
        places, found = places[by], found[by]
        cuts = np.flatnonzero(np.diff(found)) + 1
        for group in np.split(places, cuts) if len(places) else []:
            r = int(rank[group[0]])
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(order, r)
            waiting[r].append(group)

    wait(np.arange(n, dtype=np.int32))
    while order:
        r = heapq.heappop(order)
        hits = np.unique(np.concatenate(waiting.pop(r)))
        hits = hits[rank[hits] == r]  # others have changed since
        if not len(hits):
            continue
        follows = np.zeros(len(hits), bool)
        follows[1:] = after[hits[:-1]] == hits[1:]
        hits = alternate(hits, follows)
        taken = after[hits]
        symbols[hits] = merges.made[r]
        rank[taken] = -1
        rank[hits] = NONE
        after[hits] = after[taken]
        right = hits[after[hits] >= 0]
        before[after[right]] = right
        left = before[hits]
        left = left[left >= 0]
        rank[left] = NONE
        wait(np.unique(np.concatenate([hits, left])))
    return segment_sum((rank >= 0).astype(np.int64), np.concatenate(([0], ends)))


def _patterns():
    """Pre-tokens of any text, and the faster pattern for ASCII texts."""
    import regex

    w, other = r"\p{White_Space}", r"[^\p{White_Space}\p{L}\p{N}]"
    full = regex.compile(rf"{_SUFFIXES}| ?\p{{L}}+| ?\p{{N}}+| ?{other}+|{w}+(?!\P{{White_Space}})|{w}+")
    w = r"[\t-\r ]"
    ascii_only = re.compile(rf"{_SUFFIXES}| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|{w}+(?![^\t-\r ])|{w}+")
    return full, ascii_only


class Counter:
    """Counts tokens; one per task."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.full, self.ascii_only = _patterns()
        self.special = re.compile("|".join(map(re.escape, merges.special))) if merges.special else None
        self.known: dict[str, int] = {}

    def of_tokens(self, tokens: list[str]) -> np.ndarray:
        """Number of symbols of each pre-token."""
        codes, distinct = encode_words(pa.array(tokens, pa.large_string()))
        words = distinct.to_pylist()
        known = self.known
        counts = np.array([known.get(w, -1) for w in words], np.int64)
        new = np.flatnonzero(counts < 0)
        if len(new):
            raw = [words[k].encode() for k in new.tolist()]
            sizes = np.array([len(b) for b in raw])
            for chosen, merge in ((sizes <= LONG, surviving), (sizes > LONG, surviving_linked)):
                if chosen.any():
                    text = b"".join(raw[k] for k in np.flatnonzero(chosen).tolist())
                    symbols = self.merges.byte_ids[np.frombuffer(text, np.uint8)]
                    counts[new[chosen]] = merge(symbols, sizes[chosen], self.merges)
            if len(known) + len(new) > KNOWN:
                known.clear()
            known.update((words[k], n) for k, n in zip(new.tolist(), counts[new].tolist()) if len(words[k]) <= 32)
        return counts[codes]

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        held: list[str] = []
        owners: list[tuple[int, int]] = []  # (text, its pre-tokens in held)

        def settle() -> None:
            if held:
                sizes = np.array([n for _, n in owners])
                sums = segment_sum(self.of_tokens(held), np.concatenate(([0], np.cumsum(sizes))))
                np.add.at(out, [k for k, _ in owners], sums)
                held.clear()
                owners.clear()

        for k, text in enumerate(texts):
            parts = [text]
            if self.special is not None and any(s in text for s in self.merges.special):
                parts = self.special.split(text)
                out[k] += len(parts) - 1
            for part in parts:
                pattern = self.ascii_only if part.isascii() else self.full
                if len(part) < RUN:
                    found = pattern.findall(part)
                    held += found
                    owners.append((k, len(found)))
                else:
                    every = (m.group() for m in pattern.finditer(part))
                    while found := list(islice(every, RUN)):
                        held += found
                        owners.append((k, len(found)))
                        settle()
                if len(held) >= RUN:
                    settle()
        settle()
        return out


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes (UTF-8), n_tokens
    as the tokenizer file gives them without added special tokens (the strings of
    its special tokens inside a text are special tokens), over_limit (n_tokens > limit)."""

    shared = docs.sparkSession.sparkContext.broadcast(Merges(tokenizer_path))  # the size of the file's merges

    def run(batches):
        counter = Counter(shared.value)
        for batch in batches:
            for part in slices(batch, "text", max_bytes=2 << 20, max_rows=1 << 14):
                text = one_array(part.column("text"))
                n = counter.of_texts(text.to_pylist())
                yield pa.record_batch(
                    [part.column("doc_id").cast(pa.int64()), pc.binary_length(text).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
