"""Exact AUC and RMSE as DataFrame aggregations."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 20  # neighbouring scores summed up together: about a million


def _wide(counts: Column) -> Column:
    """Products of row counts outgrow 64 bits long before a table outgrows a cluster."""
    return counts.cast("decimal(38,0)")


def score_counts(df: DataFrame, score: str = "score", label: str = "label", by=()) -> DataFrame:
    """Positives and negatives per distinct score; the histogram AUC is computed from.

    Rows without a usable score or label are counted as `dropped`.
    """
    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    usable = s.isNotNull() & ~F.isnan(s) & y.isNotNull() & ~F.isnan(y)
    return (
        df.select(
            *by,
            F.when(usable, s + F.lit(0.0)).alias("score"),  # -0.0 ties with 0.0
            F.when(usable, y > 0.5).alias("_positive"),
        )
        .groupBy(*by, "score")
        .agg(
            F.count_if(F.col("_positive")).alias("pos"),
            F.count_if(~F.col("_positive")).alias("neg"),
            F.count_if(F.col("_positive").isNull()).alias("dropped"),
        )
    )


def auc_from_counts(counts: DataFrame, by=()) -> DataFrame:
    """Exact area under ROC per group from `score_counts`; null for one-class groups.

    Twice the area is the sum over scores of pos * (2 * negatives below + neg), so
    ties count one half. Scores are range-sorted, which Spark balances by sampling,
    and cut into chunks of neighbours; the running count is taken inside a chunk and
    the totals per chunk are then added up. Neither a large group nor nearly unique
    scores end up in one task, and where the chunks begin does not change the result.
    """
    by = list(by)
    placed = (
        counts.repartitionByRange(*by, "score")
        .sortWithinPartitions(*by, "score")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_chunk", F.shiftright("_at", CHUNK_BITS))
    )
    earlier = Window.unboundedPreceding, -1
    in_chunk = Window.partitionBy(*by, "_chunk").orderBy("_at").rowsBetween(*earlier)
    lower = F.coalesce(F.sum("neg").over(in_chunk), F.lit(0))
    per_chunk = (
        placed.withColumn("_area", _wide(F.col("pos")) * _wide(2 * lower + F.col("neg")))
        .groupBy(*by, "_chunk")
        .agg(
            F.min("score").alias("_from"),
            *[F.sum(c).alias(c) for c in ("_area", "pos", "neg", "dropped")],
        )
    )
    chunks = Window.partitionBy(*by).orderBy("_from").rowsBetween(*earlier)
    lower = F.coalesce(F.sum("neg").over(chunks), F.lit(0))
    totals = (
        per_chunk.withColumn("_area", F.col("_area") + _wide(F.col("pos")) * _wide(2 * lower))
        .groupBy(*by)
        .agg(
            F.sum("_area").alias("_area"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pos", "neg", "dropped")],
        )
    )
    both = (F.col("pos") > 0) & (F.col("neg") > 0)
    pairs = _wide(2 * F.col("pos")) * _wide(F.col("neg"))
    return totals.select(
        *by,
        "pos",
        "neg",
        "dropped",
        F.when(both, F.col("_area").cast("double") / pairs.cast("double")).alias("auc"),
    )


def auc(df: DataFrame, score: str = "score", label: str = "label", by=()) -> DataFrame:
    """Exact area under ROC, per `by` group or for the whole frame."""
    return auc_from_counts(score_counts(df, score, label, by), by)


def rmse(
    df: DataFrame, prediction: str = "prediction", label: str = "label", by=()
) -> DataFrame:
    """Root mean squared error; null when no row has both values."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    return df.groupBy(*by).agg(
        F.count(error).alias("rows"), F.sqrt(F.avg(error * error)).alias("rmse")
    )
