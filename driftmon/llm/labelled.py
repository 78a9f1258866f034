"""Labelled rows to learn from: joined to their texts, never more than a stated number."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole

FIT_ROWS = 12_000  # labelled rows a classifier is fitted on, the first ones by a hash of the id


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    rows: int = FIT_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(label, text) of at most `rows` labelled ids for which `learn` holds.

    Null labels and null ids teach nothing. An id labelled twice counts once, as the larger
    label. The sampled labels are at most `rows` pairs of numbers, so they are broadcast.
    """
    known = labels.where(learn & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("k_id")).agg(F.max(label).cast("double").alias("label"))
    known = known.orderBy(F.xxhash64("k_id"), "k_id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("k_id"), whole(text).alias("text"))
    return texts.join(F.broadcast(known), "k_id").select("label", "text")
