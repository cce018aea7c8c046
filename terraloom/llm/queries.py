"""The registered queries of the corpus operators: thin calls over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from terraloom.llm import collocations, filter_audit, hmm, langid, license, merkle, mixing, packing, quality, simhash, suffix_dedup, topk, warc
from terraloom.llm.common import documents


def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def vocabulary() -> str:
    """Place of the word vocabulary on this machine; every executor has it at the same path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_suffix_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(documents(spark, sf_dir))


def op3_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.licences(documents(spark, sf_dir))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary())


def op6_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_script_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(documents(spark, sf_dir))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(documents(spark, sf_dir))


def op11_weighted_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_simhash_vptree": (op1_simhash_vptree, None),
    "op2_suffix_columns": (op2_suffix_columns, None),
    "op3_sentence_rules": (op3_sentence_rules, license.ORACLE),
    "op4_arc_to_warc": (op4_arc_to_warc, warc.ORACLE),
    "op5_pattern_packing": (op5_pattern_packing, None),
    "op6_ngram_ratio": (op6_ngram_ratio, None),
    "op7_script_viterbi": (op7_script_viterbi, None),
    "op8_pareto_mix": (op8_pareto_mix, mixing.ORACLE),
    "op9_bitsliced_topk": (op9_bitsliced_topk, topk.ORACLE),
    "op10_hidden_markov": (op10_hidden_markov, None),
    "op11_weighted_automata": (op11_weighted_automata, collocations.ORACLE),
    "op12_merkle_tree": (op12_merkle_tree, merkle.ORACLE),
    "op13_filter_audit": (op13_filter_audit, filter_audit.ORACLE),
}
