"""Embedding near-dedup by Euclidean p-stable hashing.

Method: vectors are normalised; each table hashes a vector by quantised random
projections floor((a.x + b) / width); vectors that share a bucket in any table
are compared, and the links are confirmed by exact cosines in double
precision. Bitwise equal vectors collapse to one class first.

The number of projections grows with the logarithm of the number of classes so
that a bucket of unrelated vectors keeps a constant expected size, and the
number of tables follows from the wanted recall of a pair exactly at the
threshold (closer pairs are found more surely). Buckets are dealt in square
cells of at most about ``CELL`` x ``CELL`` members, so a hot bucket spreads over
many tasks. What leaves a bucket is pairs of different vectors whose cosine in
half precision is near the threshold or above; copies are never paired.

Cases: vectors that are null, empty, zero or hold a null or a non-finite
component link with nothing (their component is their own id); vectors of
different length never link; repeated rows are copies that link with each
other; a null vec_id links with nothing; an empty table gives an empty result;
only vec_id and embedding are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flocklens.llm.common import Run, mix64, shuffle_partitions
from flocklens.llm.components import components

MIN_COSINE = 0.9
RECALL = 0.985
WIDTH = 3.0
STRANGERS = 12  # expected unrelated (orthogonal) vectors in a bucket
CELL = 2048
HALF_ERROR = 0.01
PAIRS_AT_ONCE = 1 << 18
ROWS_PER_TASK = 200_000  # dealt rows of a task, the last cell apart
PAIRS_HELD = 1 << 20  # near pairs that a task holds before it hands them on


def collision(distance: float, width: float) -> float:
    """Chance that one quantised Gaussian projection agrees at a distance."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan_tables(n: int, min_cosine: float = MIN_COSINE, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """(projections per table, tables) for n vectors."""
    near = collision(math.sqrt(2 - 2 * min_cosine), width)
    far = collision(math.sqrt(2), width)
    k = max(4, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near**k))


def _valid(batches):
    """vec_id, the vector's doubles as bytes (null: links with nothing)."""
    schema = pa.schema([("vec_id", pa.int64()), ("raw", pa.binary())])
    for batch in batches:
        ids, raw = batch.column("vec_id").cast(pa.int64()), []
        for vec_id, v in zip(ids, batch.column("embedding")):
            blob = None
            if vec_id.is_valid and v.is_valid and len(v) and v.values.null_count == 0:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 becomes 0.0
                if np.isfinite(x).all() and x.any():
                    blob = x.tobytes()
            raw.append(blob)
        yield pa.record_batch([ids, pa.array(raw, pa.binary())], schema=schema)


def unit(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.float64)
    x = x / np.abs(x).max()
    return x / math.sqrt(float(x @ x))


def _buckets(k: int, tables: int, width: float):
    schema = pa.schema([("rep", pa.int64()), ("half", pa.binary()), ("keys", pa.list_(pa.int64()))])

    def run(batches):
        planes = {}
        for batch in batches:
            vectors = [unit(r) for r in batch.column("raw").to_pylist()]
            keys = np.empty((len(vectors), tables), dtype=np.int64)
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                if dim not in planes:
                    rng = np.random.default_rng([17, int(dim)])
                    planes[dim] = (rng.normal(size=(dim, k * tables)), rng.uniform(0, width, k * tables))
                a, b = planes[dim]
                rows = np.flatnonzero(sizes == dim)
                cells = np.floor((np.stack([vectors[i] for i in rows]) @ a + b) / width).astype(np.int64)
                h = np.full((len(rows), tables), np.uint64(dim), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                h = mix64(h + np.arange(tables, dtype=np.uint64))
                for j in range(k):
                    h = mix64(h ^ cells[:, j::k].astype(np.uint64))
                keys[rows] = h.view(np.int64)
            half = [v.astype(np.float16).tobytes() for v in vectors]
            yield pa.record_batch(
                [batch.column("rep"), pa.array(half, pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))],
                schema=schema,
            )

    return run


def _near_pairs(min_cosine: float):
    """Pairs of the sorted cells of one partition that look near in half precision."""

    def run(frames):
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        f = pd.concat(parts, ignore_index=True)
        cell = f.groupby(["key", "i", "j"], sort=False).ngroup().to_numpy()
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        size = np.diff(np.append(first, len(f)))
        side, square = f["side"].to_numpy(), (f["i"] != f["j"]).to_numpy()
        rep, half = f["rep"].to_numpy(np.int64), f["half"].to_numpy()
        width = np.array([len(h) for h in half])
        found = []

        def compare(x, y):
            ok = (width[x] == width[y]) & (rep[x] != rep[y])
            x, y = x[ok], y[ok]
            for dim in np.unique(width[x]):
                rows = width[x] == dim
                for a in range(0, int(rows.sum()), PAIRS_AT_ONCE):
                    p, q = x[rows][a : a + PAIRS_AT_ONCE], y[rows][a : a + PAIRS_AT_ONCE]
                    dots = np.einsum("ij,ij->i", units[p], units[q])
                    near = dots >= min_cosine - HALF_ERROR
                    found.append(np.stack([rep[p[near]], rep[q[near]]], axis=1))

        def give(most=PAIRS_HELD):
            if sum(len(p) for p in found) >= most:
                pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
                found.clear()
                yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        if len(np.unique(width)) == 1:
            units = np.frombuffer(b"".join(half), np.float16).reshape(len(f), -1).astype(np.float32)
        else:
            units = np.zeros((len(f), width.max() // 2), np.float32)
            for i, h in enumerate(half):
                units[i, : len(h) // 2] = np.frombuffer(h, np.float16)
        # small cells: all pairs at a distance d in the sorted order, for all cells at once
        small = np.repeat(size <= 64, size)
        left = np.repeat(first + size, size) - np.arange(len(f))
        for d in range(1, 64):
            x = np.flatnonzero(small & (left > d))
            if not len(x):
                break
            y = x + d
            take = ~square[x] | (side[x] != side[y])
            compare(x[take], y[take])
            yield from give()
        for a, n in zip(first[size > 64], size[size > 64]):
            rows = np.arange(a, a + n)
            if square[a]:
                one, two = rows[side[rows] == 0], rows[side[rows] == 1]
            else:
                one = two = rows
            step = max(1, PAIRS_AT_ONCE // max(1, len(two)))
            for s in range(0, len(one), step):
                for dim in np.unique(width[one[s : s + step]]):
                    p = one[s : s + step][width[one[s : s + step]] == dim]
                    q = two[width[two] == dim]
                    x, y = np.nonzero(units[p] @ units[q].T >= min_cosine - HALF_ERROR)
                    ok = rep[p[x]] != rep[q[y]]
                    found.append(np.stack([rep[p[x[ok]]], rep[q[y[ok]]]], axis=1))
                yield from give()
        yield from give(1)

    return run


def _exact(min_cosine: float):
    def run(batches):
        for batch in batches:
            x = [unit(r) for r in batch.column("ra").to_pylist()]
            y = [unit(r) for r in batch.column("rb").to_pylist()]
            ok = [float(p @ q) >= min_cosine for p, q in zip(x, y)]
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, recall: float = RECALL, width: float = WIDTH) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding)``: vec_id, n_links (other
    rows linked directly), component_id (smallest vec_id reachable) and kept."""
    run = Run(vectors.sparkSession, "embedding")
    rows = run.keep(vectors.select("vec_id", "embedding").mapInArrow(_valid, "vec_id long, raw binary"), "rows")
    classes = run.keep(
        rows.where("raw is not null").groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes"
    )
    # the same id on two different vectors: a class of its own per vector
    classes = run.keep(classes.withColumn("cls", F.xxhash64("raw")), "keyed")
    k, tables = plan_tables(classes.count(), min_cosine, recall, width)
    keyed = classes.select(F.col("cls").alias("rep"), "raw").mapInArrow(
        _buckets(k, tables, width), "rep long, half binary, keys array<long>"
    )
    keyed = run.keep(keyed.select("rep", "half", F.explode("keys").alias("key")), "buckets")
    sizes = run.keep(keyed.groupBy("key").count().where("count > 1"), "sizes")
    chunks = F.ceil(F.col("count") / CELL).cast("int")
    total = sizes.agg(F.sum(F.col("count") * chunks)).first()[0] or 0
    parts = max(shuffle_partitions(run.spark), -(-total // ROWS_PER_TASK))
    dealt = (
        keyed.join(sizes, "key")
        .withColumn("chunks", chunks)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "rep",
            "half",
        )
    )
    dealt = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")
    pairs = run.keep(dealt.mapInPandas(_near_pairs(min_cosine), "a long, b long").distinct(), "pairs")
    raw = classes.select(F.col("cls"), "raw")
    joined = pairs.join(raw.toDF("a", "ra"), "a").join(raw.toDF("b", "rb"), "b").select("a", "b", "ra", "rb")
    links = run.keep(joined.mapInArrow(_exact(min_cosine), "a long, b long"), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(classes.select(F.col("cls").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = run.keep(components(links, run), "components")
    of = (
        classes.join(found.withColumnRenamed("id", "cls"), "cls", "left")
        .join(linked.withColumnRenamed("a", "cls"), "cls", "left")
        .select(
            "raw",
            "rep",
            F.coalesce("component", "cls").alias("component"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    of = run.keep(of, "of")
    smallest = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = of.join(smallest, "component").select("raw", "component_id", "n_links")
    out = rows.join(of, "raw", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
