"""The registered queries opN_<name> over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flocklens.llm import (
    embedding_lsh,
    language_id,
    minhash_forest,
    packing,
    prefix_trie,
    quality_fm,
    rank_merge_counts,
    recurrent_lm,
    repeats,
    role_repair,
    sentencepiece_viterbi,
    warc,
    weak_rules,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.tokenise(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op7_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"), words=4)


def op8_doubling_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), window=35)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), max_tokens=2048)


def op2_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model)


def op4_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_lsh.near_vectors(_table(spark, sf_dir, "embeddings"), min_cosine=0.9)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive(_table(spark, sf_dir, "pages"))
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = quality_fm.learnable(_table(spark, sf_dir, "labels"))
    return quality_fm.score(docs, quality_fm.train(docs, labels))


def op10_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.score(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "posterior",
        "kept",
    )


def op11_rank_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_merge_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repair(role_repair.damage(_table(spark, sf_dir, "conversations")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_recurrent_lm": op2_recurrent_lm,
    "op3_language_id": op3_language_id,
    "op4_embedding_lsh": op4_embedding_lsh,
    "op5_warc": op5_warc,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_minhash_forest": op7_minhash_forest,
    "op8_doubling_repeats": op8_doubling_repeats,
    "op9_quality_fm": op9_quality_fm,
    "op10_weak_rules": op10_weak_rules,
    "op11_rank_merge_counts": op11_rank_merge_counts,
    "op12_role_repair": op12_role_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
