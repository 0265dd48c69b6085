"""Shared helpers: shared-storage intermediates, Arrow word splitting, hashing.

Words are maximal runs of characters other than ``\\x20 \\x09-\\x0D``. Word
hashes are 64-bit and the same in every task. Window hashes come from prefix
sums of ``word_hash * B**position`` (arithmetic modulo 2**64), so a window of
any length costs one subtraction and one multiplication.
"""

from __future__ import annotations

import tempfile
import threading
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd: invertible modulo 2**64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset on a local master (tests) is a private folder
    made; on a cluster an unset setting is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to storage that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_made = threading.local()  # .dirs: run folders made by this thread


class Run:
    """Written intermediates of one operator call, in one folder of their own.

    A written table cuts the lineage: a lost executor's tasks reread files
    instead of recomputing what lies upstream. The operators' results read
    these folders; ``Scope`` removes them once the results are written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.dir = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
        self._n = 0
        if not hasattr(_made, "dirs"):
            _made.dirs = []
        _made.dirs.append(self.dir)

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.dir}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scope:
    """Removes the run folders that operators make within it, at its end.

    Results of those operators have to be written before: ``with Scope(spark):
    near_duplicates(docs).write.parquet(path)``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self._from = len(getattr(_made, "dirs", []))
        return self

    def __exit__(self, *_):
        made = getattr(_made, "dirs", [])
        while len(made) > self._from:
            remove(self.spark, made.pop())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def one_array(col) -> pa.Array:
    """A column of a batch as one string array without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col, "")


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and each text's offsets into them (length n + 1)."""
    lists = pc.ascii_split_whitespace(one_array(text))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    keep = np.asarray(pc.binary_length(flat).to_numpy(zero_copy_only=False)) > 0
    if keep.all():
        return flat, offsets
    before = np.concatenate(([0], np.cumsum(keep)))
    return flat.filter(pa.array(keep)), before[offsets]


def encode_words(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(index of each word in the distinct words, the distinct words)."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def hash_strings(distinct: pa.Array) -> np.ndarray:
    """A stable 64-bit hash of each string."""
    if len(distinct) == 0:
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(distinct.to_numpy(zero_copy_only=False), categorize=False)


def word_hashes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets of the texts)."""
    words, offsets = split_words(text)
    codes, distinct = encode_words(words)
    return hash_strings(distinct)[codes], offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Windows:
    """Hashes of word windows of any length over one concatenation of texts."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray):
        n = len(hashes)
        self.offsets = offsets
        self.n = n
        powers = np.full(n + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * powers[:n], out=self._sums[1:])
        inverse = np.full(n + 1, _BASE_INV, dtype=np.uint64)
        inverse[0] = 1
        self._inverse = np.cumprod(inverse)

    def starts(self, length: int) -> np.ndarray:
        """Positions at which a window of ``length`` words fits into its text."""
        return np.flatnonzero(self.fits(length))

    def fits(self, length: int) -> np.ndarray:
        left = np.repeat(self.offsets[1:], np.diff(self.offsets)) - np.arange(self.n)
        return left >= length

    def at(self, starts: np.ndarray, length) -> np.ndarray:
        return mix64((self._sums[starts + length] - self._sums[starts]) * self._inverse[starts])


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that begins at one of ``starts``."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each text."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20, max_rows: int = 1 << 30):
    """The batch in runs of rows of about ``max_bytes`` of text (one row at least).

    Bounds the working arrays of a task whatever the batch holds; all rows come."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(np.asarray(sizes, dtype=np.int64)) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        for c in range(a, b, max_rows):
            yield batch.slice(c, min(max_rows, b - c))


SAMPLE_RANGE = 1 << 62  # of the hashes by which rows are sampled


def sample_share(wanted: int, rows: int) -> int:
    """How much of ``SAMPLE_RANGE`` gives about ``wanted`` of ``rows`` rows; never nothing."""
    return max(1, SAMPLE_RANGE * min(wanted, rows) // rows)


def crc_of(column: str):
    """crc32 of an id's decimal text, as a column."""
    from pyspark.sql import functions as F

    return F.crc32(F.col(column).cast("string"))
