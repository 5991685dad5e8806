"""The corpus pipeline: raw documents to clean, deduplicated, tokenised ones.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontaminate, near_dedup, pieces, quality, secrets
from sparkloom.llm.common import table
from sparkloom.llm.queries import piece_model
from sparkloom.operators.scale import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secrets.without_secrets(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text."""
    return pieces.encoded(docs, piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("piece_encoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next."""
    docs = spark.read.parquet(str(sf_dir) + "/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}

# Tokens are not SQL-expressible; tests compare with a brute-force version.
ORACLE_SQL = None
ORACLES = {}
