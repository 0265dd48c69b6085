"""Substring dedup by level-wise doubling.

A window is ``window`` consecutive words of one document; a word goes when a
window that covers it has a word sequence that also starts anywhere else.

Method: levels of doubling length, the last one the window itself (35: 18, 35; 100: 13, 25, 50, 100). At each level every window that is still a candidate is represented by
one of its sub-windows of the level's length, the leftmost one with the least
hash. Equal windows have equal representatives at equal places, so a window
whose representative starts at one place alone in the whole corpus cannot be
repeated and drops out; the others go on to the next length. At the last
length the representative is the window itself, and the survivors are the
repeated windows. Because neighbouring windows mostly share a representative,
the first level ships a few hashes per hundred words, and later levels only
touch documents that still hold candidates.

Equal hashes are found by dealing each block's distinct hashes into ranges of
the hash space; a range sees a hash at most once per block, however often a
passage occurs, and answers each block with those of its hashes that start
elsewhere too. 64-bit hashes stand for word sequences.

Cases: null, empty or shorter texts have no window and lose nothing; repeated
rows are separate occurrences, so copies of ``window`` words or more lose all
words; null ids are ordinary ids; an empty table gives an empty result. Only
doc_id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import (
    Run,
    Windows,
    covered,
    encode_words,
    hash_strings,
    shuffle_partitions,
    slices,
    split_words,
)

WINDOW = 35
SHORTEST = 20  # the first level has at most so many words
SLICE_BYTES = 4 << 20
HASHES_PER_RANGE = 2_000_000

_RUN = np.dtype([("hash", "<u8"), ("first", "<u4"), ("count", "<u4")])
_SPAN = np.dtype([("first", "<u4"), ("count", "<u4")])
_LEVEL = (
    "block string, hashes binary, doc_id long, text_key long, sha string, n_words long, "
    "text string, runs binary, spans binary"
)
_CUT = "of long, of_sha string, n_removed long, kept_sha256 string, kept_text string, text_key long"


def levels(window: int) -> list[int]:
    """Doubling lengths that end at ``window``."""
    out = [window]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


def least(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the leftmost position of the least of values[i : i + width]."""
    at = np.arange(len(values))
    low, span = values, 1
    while span < width:
        step = min(span, width - span)
        right, right_at = low[step:], at[step:]
        better = right < low[: len(right)]
        low = np.where(better, right, low[: len(right)])
        at = np.where(better, right_at, at[: len(right_at)])
        span += step
    return at


def _runs(words: pa.Array, offsets: np.ndarray, alive: np.ndarray, length: int, window: int):
    """(hash, first, count, document) of each run of candidate starts with one
    representative; ``alive`` holds start positions in the concatenation."""
    codes, distinct = encode_words(words)
    win = Windows(hash_strings(distinct)[codes], offsets)
    short = win.at(np.arange(max(0, win.n - length + 1)), length)
    at = least(short, window - length + 1)[alive]
    new = np.ones(len(alive), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (alive[1:] != alive[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(alive)))
    doc = np.searchsorted(offsets, alive[first], side="right") - 1
    return short[at[first]], alive[first] - offsets[doc], count, doc, at[first]


def _block_hashes(h: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Distinct hashes, the lowest bit set for those that start at two places here."""
    even = h & ~np.uint64(1)
    order = np.lexsort((place, even))
    e, p = even[order], place[order]
    distinct = np.ones(len(e), dtype=bool)
    distinct[1:] = (e[1:] != e[:-1]) | (p[1:] != p[:-1])
    e = e[distinct]
    values, n = np.unique(e, return_counts=True)
    return values | (n > 1).astype(np.uint64)


def _joined(words: pa.Array, offsets: np.ndarray) -> list[bytes]:
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words)
    return [x.encode() for x in pc.binary_join(lists, " ").to_pylist()]


def _alive(offsets: np.ndarray, window: int, spans: list | None) -> np.ndarray:
    """Candidate starts, as positions in the concatenation of the texts."""
    if spans is None:
        left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(offsets[-1])
        return np.flatnonzero(left >= window)
    spans = [np.frombuffer(b, _SPAN) for b in spans]
    base = np.repeat(offsets[:-1], [len(s) for s in spans])
    s = np.concatenate(spans)
    count = s["count"].astype(np.int64)
    return np.repeat(s["first"] + base - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _level(length: int, window: int, first: bool):
    """Each block's distinct hashes, and its documents: at the first level with
    the runs of their representatives, later with text and candidate starts."""
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in _LEVEL.split(", ")])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, offsets = split_words(part.column("text"))
                n = len(offsets) - 1
                alive = _alive(offsets, window, None if first else part.column("spans").to_pylist())
                block = uuid.uuid4().hex
                h, start, count, doc, place = _runs(words, offsets, alive, length, window)
                runs, nothing = [None] * n, [None] * n
                if first:
                    sha = [hashlib.sha256(x).hexdigest() for x in _joined(words, offsets)]
                    rows = np.empty(len(h), _RUN)
                    rows["hash"], rows["first"], rows["count"] = h, start, count
                    cut = np.searchsorted(doc, np.arange(n + 1))
                    runs = [rows[a:b].tobytes() if b > a else None for a, b in zip(cut[:-1], cut[1:])]
                columns = [
                    [block] * n,
                    nothing,
                    part.column("doc_id").cast(pa.int64()),
                    part.column("text_key"),
                    sha if first else part.column("sha"),
                    np.diff(offsets),
                    nothing if first else part.column("text"),
                    runs,
                    nothing if first else part.column("spans"),
                ]
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)
                if len(h):
                    one = [[block], [_block_hashes(h, place).tobytes()], *([None] for _ in range(7))]
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(one, schema)], schema=schema)

    return run


def _repeated(blocks: DataFrame, ranges: int) -> DataFrame:
    """(block, hashes): those of each block's hashes that start at two places."""
    width = (1 << 64) // ranges + 1

    def deal(frames):
        for frame in frames:
            for block, blob in zip(frame["block"], frame["hashes"]):
                h = np.frombuffer(blob, dtype=np.uint64)
                cut = np.searchsorted(h, np.array([min(r * width, (1 << 64) - 1) for r in range(1, ranges)], dtype=np.uint64))
                pieces = np.split(h, cut)
                yield pd.DataFrame(
                    {"range": range(ranges), "block": block, "hashes": [p.tobytes() for p in pieces]}
                ).loc[[len(p) > 0 for p in pieces]]

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(b, dtype=np.uint64) for b in frame["hashes"]]
        every = np.concatenate(parts)
        even = np.sort(every & ~np.uint64(1))
        more = even[:-1][even[1:] == even[:-1]]
        more = np.unique(np.concatenate([more, every[(every & np.uint64(1)) == 1] & ~np.uint64(1)]))
        found = [p[np.isin(p & ~np.uint64(1), more, assume_unique=True)] & ~np.uint64(1) for p in parts]
        out = pd.DataFrame({"block": frame["block"], "hashes": [f.tobytes() for f in found]})
        return out.loc[[len(f) > 0 for f in found]]

    dealt = blocks.mapInPandas(deal, "range int, block string, hashes binary")
    return dealt.groupBy("range").applyInPandas(meet, "block string, hashes binary")


def _survivors(length: int, window: int, first: bool):
    """The documents of one block with the candidate starts that go on."""

    def run(key, docs, hits):
        rows = []
        if len(hits) and len(docs):
            more = np.sort(np.concatenate([np.frombuffer(b, dtype=np.uint64) for b in hits["hashes"]]))
            if first:
                parts = [np.frombuffer(b, _RUN) for b in docs["runs"]]
                found, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            else:
                words, offsets = split_words(pa.array(docs["text"], pa.string()))
                alive = _alive(offsets, window, docs["spans"].tolist())
                h, start, count, doc, _ = _runs(words, offsets, alive, length, window)
                found = np.empty(len(h), _RUN)
                found["hash"], found["first"], found["count"] = h, start, count
            even = found["hash"] & ~np.uint64(1)
            at = np.minimum(np.searchsorted(more, even), len(more) - 1)
            hit = more[at] == even
            found, doc = found[hit], doc[hit]
            # runs that follow each other become one span
            new = np.ones(len(found), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (found["first"][1:] != found["first"][:-1] + found["count"][:-1])
            head = np.flatnonzero(new)
            spans = np.empty(len(head), _SPAN)
            spans["first"] = found["first"][head]
            spans["count"] = np.add.reduceat(found["count"], head) if len(head) else 0
            doc = doc[head]
            cut = np.searchsorted(doc, np.arange(len(docs) + 1))
            for k, row in enumerate(zip(docs["doc_id"], docs["text_key"], docs["sha"], docs["text"])):
                if cut[k + 1] > cut[k]:
                    rows.append((*row, spans[cut[k] : cut[k + 1]].tobytes()))
        return pd.DataFrame(rows, columns=["doc_id", "text_key", "sha", "text", "spans"])

    return run


def _go_on(level: DataFrame, run: Run, length: int, window: int, first: bool) -> DataFrame:
    blocks = level.where("hashes is not null").select("block", "hashes")
    total = blocks.agg(F.sum(F.length("hashes") / 8)).first()[0] or 0
    ranges = max(shuffle_partitions(run.spark), -(-int(total) // HASHES_PER_RANGE))
    hits = run.keep(_repeated(blocks, ranges), "repeated")
    docs = level.where("runs is not null" if first else "spans is not null")
    docs = docs.select("block", F.col("doc_id").cast("string"), "text_key", "sha", "text", "runs", "spans")
    out = docs.groupBy("block").cogroup(hits.groupBy("block")).applyInPandas(
        _survivors(length, window, first), "doc_id string, text_key long, sha string, text string, spans binary"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def _strip(window: int):
    schema = pa.schema(
        [
            ("of", pa.int64()),
            ("of_sha", pa.string()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
            ("kept_text", pa.string()),
            ("text_key", pa.int64()),
        ]
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, offsets = split_words(part.column("text"))
                alive = _alive(offsets, window, part.column("spans").to_pylist())
                gone = covered(alive, window, len(words))
                before = np.concatenate(([0], np.cumsum(~gone)))
                kept = _joined(words.filter(pa.array(~gone)), before[offsets])
                yield pa.record_batch(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        part.column("sha"),
                        pa.array(np.diff(offsets) - np.diff(before[offsets])),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                        pa.array([k.decode() for k in kept]),
                        part.column("text_key"),
                    ],
                    schema=schema,
                )

    return run


def _find(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sha, n_words of every row; what is cut from the distinct texts
    that lose words)."""
    run = Run(docs.sparkSession, "repeats")
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    steps = levels(window)
    base = run.keep(docs.mapInArrow(_level(steps[0], window, True), _LEVEL), "level")
    state = _go_on(base, run, steps[0], window, True)
    state = state.select(F.col("doc_id").alias("of"), F.col("text_key").alias("of_key"), "sha", "spans")
    state = run.keep(state.dropDuplicates(["of", "of_key"]), "candidates")
    # on the text too: the texts of a repeated or null id meet their own candidates only
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_key"))
    whole = docs.join(state, same).select("doc_id", "text_key", "sha", "text", "spans")
    for length in steps[1:]:
        level = run.keep(whole.mapInArrow(_level(length, window, False), _LEVEL), "level")
        whole = _go_on(level, run, length, window, False)
    cut = whole.mapInArrow(_strip(window), _CUT)
    cut = run.keep(cut.dropDuplicates(["of", "of_sha", "text_key"]), "cut")
    return base.where("sha is not null").select("doc_id", "sha", "n_words"), cut


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_removed and
    kept_sha256 (of the kept words joined by one space)."""
    rows, cut = _find(docs, window)
    cut = cut.dropDuplicates(["of", "of_sha"])
    out = rows.join(cut, rows["doc_id"].eqNullSafe(cut["of"]) & (rows["sha"] == cut["of_sha"]), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def strip_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns and rows; texts that hold repeated windows
    become their kept words joined by one space, and n_chars (if there is such
    a column) their new length."""
    _, cut = _find(docs, window)
    cut = cut.select("of", "text_key", "kept_text")
    rows = docs.select(F.struct("*").alias("whole"))
    same = F.col("whole.doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("whole.text") == F.col("text_key"))
    new = {"text": F.coalesce("kept_text", "whole.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("kept_text").cast("long"), "whole.n_chars")
    return rows.join(cut, same, "left").select(*(new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns))
