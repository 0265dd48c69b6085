"""Language ID by hierarchical discrimination.

Method: hashed character 1- to 4-grams of the letters of a whole text; linear
support vector machines first choose the language family (one against one),
then one-versus-one machines between the languages of that family choose the
language. The score is the product over both levels of the winner's least
pairwise confidence (a logistic function of the margin).

The machines are fitted on at most about ``max_train`` rows, a hash sample with
the same bound for every language, at most ``max_langs`` of them; every text is predicted whole. lang,
source and doc_id are never inputs of a prediction.

Cases: a null text or one without any letter is ``und`` with score 0; rows
with a null lang teach nothing; if nothing can be learned every text is
``und``; with one language (or one family) that level is certain; repeated rows
are predicted alike; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flocklens.llm.common import SAMPLE_RANGE, crc_of, mix64, one_array, sample_share, slices

UNKNOWN = "und"
BUCKETS = 4096
ORDERS = (1, 2, 3, 4)
MAX_TRAIN = 4000
MAX_LANGS = 200

# fixed values: families of ISO 639-1 codes; a code not listed is its own family
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb",
    "romance": "es fr it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "semitic": "ar he mt",
    "indic": "hi ur bn mr pa gu ne",
    "cjk": "zh ja ko",
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), f"own:{lang}")


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def features(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([texts, BUCKETS] unit vectors, which texts have a letter)."""
    n = len(texts)
    # a line feed before each text and after the last one separates them
    raw = np.frombuffer(("\n" + "\n".join(t.lower() for t in texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t.lower()) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    doc = np.repeat(np.arange(n), lengths + 1)
    raw = raw[: ends[-1] if n else 0]  # position 0 is the first separator; each text follows its own
    is_letter = letters[raw]
    some = np.bincount(doc, weights=is_letter, minlength=n) > 0
    # runs of other characters count as one boundary
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    chars = np.where(is_letter, raw, 0)[keep].astype(np.uint64)
    doc = doc[keep]
    h = mix64(chars + np.uint64(1))
    counts = np.zeros(n * BUCKETS)
    total = np.zeros(len(h), dtype=np.uint64)
    for order in range(1, max(ORDERS) + 1):
        if order > len(h):
            break
        total = total[: len(h) - order + 1] * np.uint64(0x9E3779B97F4A7C15) + h[order - 1 :]
        if order in ORDERS:
            one = doc[: len(total)] == doc[order - 1 :]
            cell = (mix64(total + np.uint64(order)) >> np.uint64(64 - 12)).astype(np.int64)
            counts += np.bincount((doc[: len(total)] * BUCKETS + cell)[one], minlength=n * BUCKETS)
    x = np.sqrt(counts).reshape(n, BUCKETS).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-6), some


def linear_svm(x: np.ndarray, y: np.ndarray, epochs: int = 30, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine; y is +1 or -1. Both classes weigh the same."""
    w, b = np.zeros(x.shape[1], np.float64), 0.0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    vw, vb = np.zeros_like(w), 0.0
    for step in range(epochs * 10):  # accelerated full gradient
        look_w, look_b = w + 0.9 * vw, b + 0.9 * vb
        slack = np.maximum(0, 1 - y * (x @ look_w.astype(np.float32) + look_b))
        g = -2 * weight * y * slack
        gw = (x.T @ g.astype(np.float32)) + l2 * look_w
        vw, vb = 0.9 * vw - 0.5 * gw, 0.9 * vb - 0.5 * g.sum()
        w, b = w + vw, b + vb
        if slack.max() == 0:
            break
    return w.astype(np.float32), float(b)


class Hierarchy:
    """Family machines, then the language machines of each family."""

    def __init__(self, x: np.ndarray, lang: np.ndarray):
        langs = sorted(set(lang))
        family = {g: family_of(g) for g in langs}
        self.families = sorted(set(family.values()))
        self.langs = {f: [g for g in langs if family[g] == f] for f in self.families}
        self.top = _pairs(x, np.array([family[g] for g in lang]), self.families)
        self.low = {f: _pairs(x, lang, self.langs[f]) for f in self.families}

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of, score = _vote(x, self.top, len(self.families))
        out = np.empty(len(x), dtype=object)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(of == k)
            if len(rows):
                lang, sure = _vote(x[rows], self.low[f], len(self.langs[f]))
                out[rows] = np.array(self.langs[f], dtype=object)[lang]
                score[rows] *= sure
        return out, score


def _pairs(x: np.ndarray, label: np.ndarray, classes: list[str]) -> dict:
    out = {}
    for a, b in itertools.combinations(range(len(classes)), 2):
        rows = np.flatnonzero((label == classes[a]) | (label == classes[b]))
        out[a, b] = linear_svm(x[rows], np.where(label[rows] == classes[a], 1.0, -1.0))
    return out


def _vote(x: np.ndarray, machines: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(most pairwise wins, ties by summed margin; the winner's least confidence)."""
    wins, margins = np.zeros((len(x), n)), np.zeros((len(x), n))
    sure = np.ones((len(x), n))
    for (a, b), (w, c) in machines.items():
        m = (x @ w + c).astype(np.float64)
        wins[:, a] += m > 0
        wins[:, b] += m <= 0
        margins[:, a] += m
        margins[:, b] -= m
        p = 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
        sure[:, a] = np.minimum(sure[:, a], p)
        sure[:, b] = np.minimum(sure[:, b], 1 - p)
    best = (wins + 1e-6 * np.tanh(margins)).argmax(axis=1)
    return best, sure[np.arange(len(x)), best]


def held_out():
    """Documents that take no part in learning: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(crc_of("doc_id") % 4 == 2, F.lit(False))


def train(docs: DataFrame, max_train: int = MAX_TRAIN, max_langs: int = MAX_LANGS) -> Hierarchy | None:
    """Fit on a hash sample of ``docs(doc_id, text, lang)``, at most about
    ``max_train`` rows with the same bound for every language. The ``max_langs``
    most frequent languages are learned (ties by name); of rows with equal id,
    text and language one is."""
    known = docs.where("lang is not null and text is not null")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs)
    counts = {r.lang: r["count"] for r in counts.collect()}
    if not counts:
        return None
    each = max(1, max_train // len(counts))
    share = F.lit(0).cast("long")
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(sample_share(each, n))).otherwise(share)
    rows = known.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text", F.lit(13)).alias("h"))
    rows = rows.where(F.pmod("h", F.lit(SAMPLE_RANGE)) < share)

    def build(batches):
        letters = _letter_table()
        for batch in batches:
            for p in slices(batch, "text", max_rows=256):
                x, some = features(one_array(p.column("text")).to_pylist(), letters)
                blobs = [r.astype(np.float16).tobytes() if s else None for r, s in zip(x, some)]
                yield pa.record_batch(
                    [p.column("doc_id").cast(pa.int64()), p.column("lang"), p.column("h"), pa.array(blobs, pa.binary())],
                    names=["doc_id", "lang", "h", "x"],
                )

    found = rows.mapInArrow(build, "doc_id long, lang string, h long, x binary").where("x is not null")
    found = found.groupBy("doc_id", "lang", "h").agg(F.min("x").alias("x")).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.lang, -1 if r.doc_id is None else r.doc_id, bytes(r.x)))
    x = np.stack([np.frombuffer(r.x, np.float16) for r in found]).astype(np.float32)
    return Hierarchy(x, np.array([r.lang for r in found], dtype=object))


def predict(docs: DataFrame, model: Hierarchy | None, whole_rows: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, lang_pred,
    score (and the row itself as the struct ``whole``)."""

    def run(batches):
        letters = _letter_table()
        for batch in batches:
            for p in slices(batch, "text", max_rows=256):
                lang = np.full(p.num_rows, UNKNOWN, dtype=object)
                score = np.zeros(p.num_rows)
                if model is not None:
                    x, some = features(one_array(p.column("text")).to_pylist(), letters)
                    if some.any():
                        lang[some], score[some] = model.predict(x[some])
                yield pa.record_batch(
                    [
                        p.column("doc_id").cast(pa.int64()),
                        p.column("held_out"),
                        pa.array(lang, pa.string()),
                        pa.array(score),
                        *([p.column("whole")] if whole_rows else []),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score", "whole"][: 5 if whole_rows else 4],
                )

    rows = docs.select("doc_id", "text", held_out().alias("held_out"), F.struct("*").alias("whole"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    if not whole_rows:
        return rows.drop("whole").mapInArrow(run, schema)
    return rows.mapInArrow(run, T.StructType([*T.StructType.fromDDL(schema).fields, rows.schema["whole"]]))
