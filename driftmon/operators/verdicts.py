"""Verdicts: stamped on scored rows, listed as alerts, read by panels."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftmon.functions.rules import auc_drift, rmse_drift
from driftmon.schemas import AUC_THRESHOLD, PANEL_ROWS, RMSE_FACTOR

ALERT_MESSAGE = "drift: the metric left its allowed range"


def stamp(scored: DataFrame, train_auc, test_auc, drift) -> DataFrame:
    """The one verdict of a run on every scored row."""
    return scored.withColumns(
        {
            "train_auc": F.lit(train_auc).cast("double"),
            "test_auc": F.lit(test_auc).cast("double"),
            "drift": F.lit(drift).cast("boolean"),
        }
    )


def stamp_by(scored: DataFrame, verdicts: DataFrame, on) -> DataFrame:
    """The verdict of its group on every scored row. There is one verdict per group and very many
    rows, so the verdicts go to the rows: dealt by group, a group would be one task's."""
    return scored.join(F.broadcast(verdicts), on)


def _baseline(metrics: DataFrame, block: str, first, metric: str):
    """The baseline block's metric beside every block: one row per block is all there is."""
    return F.max(F.when(F.col(block) == F.lit(first), F.col(metric))).over(Window.partitionBy())


def auc_verdicts(
    metrics: DataFrame, block: str, first, threshold: float = AUC_THRESHOLD
) -> DataFrame:
    """Per block: baseline and own AUC and the absolute rule, against block `first`."""
    return metrics.select(
        block,
        _baseline(metrics, block, first, "auc").alias("train_auc"),
        F.col("auc").alias("test_auc"),
    ).withColumn("drift", auc_drift(F.col("test_auc"), F.col("train_auc"), threshold))


def rmse_verdicts(
    metrics: DataFrame, block: str, first, factor: float = RMSE_FACTOR
) -> DataFrame:
    """Per block: baseline and own RMSE and the ratio rule, against block `first`."""
    return metrics.select(
        block,
        _baseline(metrics, block, first, "rmse").alias("train_rmse"),
        F.col("rmse").alias("test_rmse"),
    ).withColumn("drift", rmse_drift(F.col("test_rmse"), F.col("train_rmse"), factor))


def alerts(verdicts: DataFrame) -> DataFrame:
    """One row per flagged verdict."""
    return verdicts.where("drift").withColumn("message", F.lit(ALERT_MESSAGE))


def newest(df: DataFrame, *cols: str, rows: int = PANEL_ROWS) -> DataFrame:
    """Panel series: the newest rows by time; the id settles ties."""
    return df.orderBy(F.desc("timestamp"), "id").limit(rows).select("timestamp", *cols)


def drift_series(verdict_rows: DataFrame) -> DataFrame:
    """Verdict over time as 0 and 1."""
    return verdict_rows.select("timestamp", F.col("drift").cast("int").alias("drift"))
