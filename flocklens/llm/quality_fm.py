"""Quality classifier: a factorisation machine.

Features of a text: hashed words (log counts, unit length), structure
statistics and the metadata n_chars. The score is the logistic function of
``w0 + w.x + 1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)``: all
pairwise interactions at rank ``RANK``, in time linear in the features.

The model is fitted on at most about ``max_train`` labelled rows (a hash
sample); every text is scored whole. Labels, lang, source and doc_id are never
inputs of a score.

Cases: null texts count as empty and get a score too; a null n_chars is zero;
without any usable label all scores are 0.5; repeated rows score alike; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flocklens.llm.common import SAMPLE_RANGE, crc_of, sample_share, slices
from flocklens.llm.text_stats import text_stats

BUCKETS = 2048
RANK = 8
MAX_TRAIN = 8000
THRESHOLD = 0.7
STATS = 11


def features(text: pa.Array, n_chars: np.ndarray) -> np.ndarray:
    """[texts, BUCKETS + STATS] float32."""
    s, hashes, offsets = text_stats(text)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    words = np.bincount(doc * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS)
    words = np.log1p(words.reshape(n, BUCKETS)).astype(np.float32)
    words /= np.maximum(np.sqrt((words * words).sum(axis=1, keepdims=True)), 1e-6)
    share = lambda a, b: s[a] / np.maximum(s[b], 1)
    stats = np.stack(
        [
            np.log1p(s["n_words"]) / 8,
            share("word_chars", "n_words") / 8,
            np.minimum(share("n_symbols", "n_words") * 4, 3),
            share("n_upper", "n_letters") * 2,
            share("n_letters", "word_chars"),
            share("n_digits", "word_chars") * 3,
            np.minimum(share("n_loud", "n_words") * 2, 3),
            share("n_dup_lines", "n_lines") * 2,
            share("n_repeat_words", "n_words") * 2,
            np.log1p(s["n_lines"]) / 4,
            np.log1p(np.maximum(n_chars, 0)) / 8,
        ],
        axis=1,
    ).astype(np.float32)
    return np.concatenate([words, stats], axis=1)


class FactorisationMachine:
    def __init__(self, size: int, rank: int = RANK, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w0 = np.zeros(1, np.float32)
        self.w = np.zeros(size, np.float32)
        self.v = rng.normal(0, 0.05, (size, rank)).astype(np.float32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        xv = x @ self.v
        return self.w0[0] + x @ self.w + 0.5 * (xv * xv - (x * x) @ (self.v * self.v)).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(np.float64), -60, 60)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.02, l2: float = 1e-4):
        """Adam on the logistic loss."""
        rng = np.random.default_rng(5)
        params = [self.w0, self.w, self.v]
        m = [np.zeros_like(p) for p in params]
        s = [np.zeros_like(p) for p in params]
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for a in range(0, len(y), batch):
                rows = order[a : a + batch]
                b, bb = x[rows], x[rows] ** 2
                xv = b @ self.v
                z = self.w0[0] + b @ self.w + 0.5 * (xv * xv - bb @ (self.v * self.v)).sum(axis=1)
                g = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[rows]) / len(rows)).astype(np.float32)
                grads = [
                    g.sum(keepdims=True),
                    b.T @ g + l2 * self.w,
                    b.T @ (g[:, None] * xv) - (bb.T @ g)[:, None] * self.v + l2 * self.v,
                ]
                t += 1
                for p, d, mi, si in zip(params, grads, m, s):
                    mi += 0.1 * (d - mi)
                    si += 0.001 * (d * d - si)
                    p -= rate * (mi / (1 - 0.9**t)) / (np.sqrt(si / (1 - 0.999**t)) + 1e-8)
        return self


def _n_chars(batch) -> np.ndarray:
    return pc.fill_null(batch.column("n_chars").cast(pa.int64()), 0).to_numpy(zero_copy_only=False).astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> FactorisationMachine | None:
    """Fit on a hash sample of at most about ``max_train`` labelled documents of
    ``docs(doc_id, text, n_chars)``; rows with a null label are not used. Equal
    labels of an id count once; of several texts with one id, that with the
    least hash is learned."""
    known = labels.select("doc_id", (F.col("quality") > 0).cast("int").alias("y"))
    known = known.where("doc_id is not null and y is not null").distinct()
    total = known.count()
    if total == 0:
        return None
    share = F.lit(sample_share(max_train, total))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(SAMPLE_RANGE)) < share)
    rows = docs.select("doc_id", "text", "n_chars", F.xxhash64("text", "n_chars").alias("h"))
    rows = rows.join(F.broadcast(known), "doc_id")  # about max_train rows, whatever the ids

    def build(batches):
        for batch in batches:
            for p in slices(batch, "text", max_rows=512):
                x = features(p.column("text"), _n_chars(p))
                at = [np.flatnonzero(r) for r in x]
                yield pa.record_batch(
                    [
                        p.column("doc_id").cast(pa.int64()),
                        p.column("y").cast(pa.int32()),
                        p.column("h"),
                        pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
                        pa.array([r[a].tobytes() for r, a in zip(x, at)], pa.binary()),
                    ],
                    names=["doc_id", "y", "h", "at", "x"],
                )

    found = rows.mapInArrow(build, "doc_id long, y int, h long, at binary, x binary")
    found = found.groupBy("doc_id", "y").agg(F.min(F.struct("h", "at", "x")).alias("r")).select("doc_id", "y", "r.at", "r.x").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.doc_id, r.y, bytes(r.at)))  # the same model whatever the order of tasks
    x = np.zeros((len(found), BUCKETS + STATS), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["x"], np.float32)
    y = np.array([float(r.y > 0) for r in found], np.float32)
    return FactorisationMachine(x.shape[1]).fit(x, y)


def score(docs: DataFrame, model: FactorisationMachine | None, threshold: float = THRESHOLD, whole_rows: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text, n_chars)``: doc_id, held_out,
    score and predicted (1 from ``threshold`` on; and the row itself as the
    struct ``whole``)."""

    def run(batches):
        for batch in batches:
            for p in slices(batch, "text", max_rows=512):
                if model is None:
                    s = np.full(p.num_rows, 0.5)
                else:
                    s = model.score(features(p.column("text"), _n_chars(p)))
                yield pa.record_batch(
                    [
                        p.column("doc_id").cast(pa.int64()),
                        p.column("held_out"),
                        pa.array(s),
                        pa.array((s >= threshold).astype(np.int32)),
                        *([p.column("whole")] if whole_rows else []),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "whole"][: 5 if whole_rows else 4],
                )

    rows = docs.select("doc_id", "text", "n_chars", held_out().alias("held_out"), F.struct("*").alias("whole"))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    if not whole_rows:
        return rows.drop("whole").mapInArrow(run, schema)
    return rows.mapInArrow(run, T.StructType([*T.StructType.fromDDL(schema).fields, rows.schema["whole"]]))


def held_out():
    """Documents that take no part in learning: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(crc_of("doc_id") % 4 == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out())
