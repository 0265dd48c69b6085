"""A corpus pipeline over the table documents.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flocklens.llm import language_id, minhash_forest, packing, quality_fm, repeats
from flocklens.llm.common import Run, Scope
from flocklens.llm.queries import tokenizer_path

MIN_LANGUAGE_SCORE = 0.3  # below: no learned language is likelier than chance
MIN_QUALITY = 0.7
WINDOW = 35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language stay."""
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.predict(docs, model, whole_rows=True)
    keep = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(keep).select("whole.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts stay."""
    labels = quality_fm.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = quality_fm.train(docs, labels)
    if model is None:  # nothing to judge by
        return docs
    return quality_fm.score(docs, model, MIN_QUALITY, whole_rows=True).where("predicted = 1").select("whole.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (shingles of five words,
    similarity 0.8 or more), and one of each set of repeated rows."""
    return minhash_forest.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 words that also start elsewhere go; all rows stay."""
    return repeats.strip_repeats(docs, WINDOW)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), max_tokens=2048)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packed", packed),
]

ORACLE_SQL = None  # models and packing are not SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what its predecessor wrote.

    The stages' own intermediates go when their result is written; the caller's
    ``Scope`` removes the stage tables."""
    folder = Run(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with Scope(spark):
            docs = folder.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
