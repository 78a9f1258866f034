"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, packing."""

from pyspark.sql import DataFrame, SparkSession

from driftmon.llm import decontaminate, exact_dedup, packing, quality, simhash
from driftmon.llm.common import prepare, table
from driftmon.llm.queries import quality_model
from driftmon.session import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality_model(spark, sf_dir, docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest id stays."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None  # near copies, edit distance and packing are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(prepare(spark), docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
