"""The registered queries of this package, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import (
    importance,
    language_id,
    lexical,
    licenses,
    mixing,
    neighbours,
    ngram_join,
    packing,
    prefix_trie,
    quality_rules,
    secrets,
    token_counts,
    toxicity,
)
from barlab.llm.oracles import licenses_sql, quality_sql, ranking_sql, trie_sql
from barlab.llm.shared import read_table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_components(documents(spark, sf_dir), percent=90, n=3, count_links=True)
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.sample(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(documents(spark, sf_dir)))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return judged.drop("n_lines")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(
        docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), word_pattern()
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, sf_dir)))


QUERIES = {
    "op1_ngram_jaccard_join": op1,
    "op2_learned_partitions_ann": op2,
    "op3_source_mixing": op3,
    "op4_importance_resampling": op4,
    "op5_secret_scan": op5,
    "op6_toxicity_neighbours": op6,
    "op7_quality_rules": op7,
    "op8_language_codes": op8,
    "op9_best_fit_packing": op9,
    "op10_token_counts": op10,
    "op11_prefix_trie": op11,
    "op12_dual_tree_search": op12,
    "op13_license_scan": op13,
}

ORACLES = {
    "op3_source_mixing": mixing.MIX_SQL,
    "op7_quality_rules": quality_sql(),
    "op11_prefix_trie": trie_sql(),
    "op12_dual_tree_search": ranking_sql(),
    "op13_license_scan": licenses_sql(),
}
