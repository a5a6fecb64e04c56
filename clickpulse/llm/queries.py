"""One query for each operator, over its whole table, and the DuckDB SQL of
those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm.common import read_table
from clickpulse.llm.fingerprints import fingerprint_report
from clickpulse.llm.licenses import scan_licenses
from clickpulse.llm.mixing import MIXING_SQL, mix_report
from clickpulse.llm.neardup import near_duplicate_report
from clickpulse.llm.ngramjoin import NGRAM_SQL, ngram_join_report
from clickpulse.llm.orchard import COMPRESSION_SQL, compression_report
from clickpulse.llm.packing import pack_texts
from clickpulse.llm.prefixtrie import TRIE_SQL, prefix_trie_report
from clickpulse.llm.quality import quality_report
from clickpulse.llm.rollups import rollup_report
from clickpulse.llm.secrets import SECRETS_SQL, secret_report
from clickpulse.llm.tokenbin import token_report
from clickpulse.llm.topk import TOPK_SQL, top_k_report


TOKENIZER = "byte_bpe_50k.json"
#: Tokenizer versions of the token counts.
COUNTED = ("byte_bpe_50k", "byte_bpe_multi_50k")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_texts(read_table(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # the other queries go without the tokenizers' folder

    return token_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(read_table(spark, sf_dir, "documents"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(read_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rollup_report(read_table(spark, sf_dir, "documents"),
                         {v: public_tokenizers.path(f"{v}.tiktoken") for v in COUNTED}, public_tokenizers.PATTERN)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_report(read_table(spark, sf_dir, "embeddings"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join_report(read_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie_report(read_table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_report(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_license_scans": op2_license_scans,
    "op3_token_binary": op3_token_binary,
    "op4_fingerprints": op4_fingerprints,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_token_counts": op7_token_counts,
    "op8_secret_scans": op8_secret_scans,
    "op9_mixing": op9_mixing,
    "op10_topk": op10_topk,
    "op11_ngram_join": op11_ngram_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_vector_codes": op13_vector_codes,
}

SQL: dict[str, str] = {
    "op8_secret_scans": SECRETS_SQL,
    "op9_mixing": MIXING_SQL,
    "op10_topk": TOPK_SQL,
    "op11_ngram_join": NGRAM_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_vector_codes": COMPRESSION_SQL,
}
