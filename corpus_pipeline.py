"""The corpus pipeline: documents to packed sequences of token ids.

Each stage calls one operator of ``clickpulse.llm`` on all rows that the stage
before it kept; stages are written as Parquet and read again in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm.common import read_table, save
from clickpulse.llm.mixing import mix_documents
from clickpulse.llm.neardup import drop_near_duplicates
from clickpulse.llm.packing import pack_tokens
from clickpulse.llm.quality import drop_low_quality
from clickpulse.llm.queries import TOKENIZER
from clickpulse.llm.secrets import redact


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity is beyond their language's threshold."""
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near copies."""
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret in the texts."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target weight asks."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts' token ids into sequences of the permitted lengths."""
    import public_tokenizers

    return pack_tokens(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mixing),
    ("best-fit packing", packing),
]

#: Several stages are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
