"""Continuous monitor: a verdict per event-time window while the stream runs."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from driftmon import storage
from driftmon.functions.rules import auc_drift
from driftmon.operators.metrics import auc_from_counts, score_counts
from driftmon.schemas import AUC_THRESHOLD, SPELL, SPELL_KEY
from driftmon.sources.keyed import BATCH, claim, own, read_table, write_batch


class LateRows(StreamingQueryListener):
    """Counts, per query, what came after the watermark and was left out.

    Rows of one window and score that a task reads together count once, as they reach the
    state. Register it with `spark.streams.addListener` before the query starts.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        key, late = str(event.progress.id), sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.counts[key] = self.counts.get(key, 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def window_counts(scored: DataFrame, width: str, score: str = "score") -> DataFrame:
    """Score histogram per tumbling window; on a stream this is the whole state.

    Its size follows the distinct scores of open windows, which for a boosted-tree
    model are few, not the rows.
    """
    windowed = scored.withColumn("window", F.window("timestamp", width))
    return score_counts(windowed, score, by=["window"]).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "score",
        "pos",
        "neg",
        "dropped",
    )


def window_verdicts(
    counts: DataFrame, baseline: float, threshold: float = AUC_THRESHOLD
) -> DataFrame:
    """AUC and absolute rule per window of `window_counts`."""
    by = ["window_start", "window_end"]
    return (
        auc_from_counts(counts, by)
        .withColumnRenamed("auc", "test_auc")
        .withColumn("train_auc", F.lit(baseline).cast("double"))
        .withColumn("drift", auc_drift(F.col("test_auc"), F.col("train_auc"), threshold))
        .select(*by, "pos", "neg", "dropped", "train_auc", "test_auc", "drift")
    )


def spells(verdicts: DataFrame, open_spell: DataFrame) -> DataFrame:
    """Neighbouring windows with drift as one spell each, going on from the open spell, if any.

    A window without drift or without a verdict ends a spell; windows that had no rows are not
    there and end none. There is one row per window, which one task puts in order.
    """
    columns = ["begin", "end", "windows", "worst", "drift"]
    seen = verdicts.select(
        F.col("window_start").alias("begin"),
        F.col("window_end").alias("end"),
        F.lit(1).cast("long").alias("windows"),
        F.abs(F.col("test_auc") - F.col("train_auc")).alias("worst"),
        F.coalesce("drift", F.lit(False)).alias("drift"),
    )
    rows = seen.unionByName(open_spell.withColumn("drift", F.lit(True)).select(*columns))
    before = Window.orderBy("begin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = F.sum(F.when(F.col("drift"), 0).otherwise(1)).over(before)
    last = F.max("end").over(Window.partitionBy())
    found = rows.withColumns({"island": island, "last": last}).where("drift").groupBy("island", "last")
    return found.agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("windows").alias("windows"), F.max("worst").alias("worst")
    ).select("begin", "end", "windows", "worst", (F.col("end") == F.col("last")).alias("open"))


def read_spells(spark: SparkSession, alerts: str, up_to: int | None = None) -> DataFrame:
    """The spells of a monitor, each as its newest batch has it."""
    return read_table(spark, alerts, SPELL, up_to=up_to, key=SPELL_KEY)


def log_spells(verdicts: DataFrame, alerts: str, batch_id: int) -> None:
    """Store what a batch of verdicts, later than all before, makes of the spells. A replayed
    batch goes on from the spells as they were before it, and replaces its own."""
    before = read_spells(verdicts.sparkSession, alerts, batch_id - 1).where("open")
    write_batch(spells(verdicts, before), alerts, batch_id, SPELL, key=SPELL_KEY, settled=True)


def start_monitor(
    scored: DataFrame,
    baseline: float,
    out: str,
    checkpoint: str,
    width: str = "1 day",
    late: str = "10 minutes",
    threshold: float = AUC_THRESHOLD,
    trigger: dict | None = None,
    alerts: str | None = None,
):
    """Write the verdict of each window once, when the watermark has passed its end.

    All score counts of a window leave the state in the same micro-batch, so its
    AUC is computed from the complete window. `out` can be read with the schema
    `WINDOW_VERDICT` from the start. Rows later than the watermark are counted by `LateRows`.
    With `alerts` a spell of drift is one row there, with its begin and its end so far, also
    across a restart. `out` belongs to the checkpoint; another one is refused.
    """
    spark = scored.sparkSession
    for path in (out, alerts) if alerts else (out,):
        claim(spark, path, checkpoint)
        storage.make_folder(spark, path)

    def emit(counts: DataFrame, batch_id: int):
        counts = counts.persist()  # the state is read and stored once per batch
        try:
            if not counts.isEmpty():
                verdicts = window_verdicts(counts, baseline, threshold)
                verdicts.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")
                if alerts:
                    log_spells(verdicts, alerts, batch_id)
        finally:
            counts.unpersist()

    writer = (
        window_counts(scored.withWatermark("timestamp", late), width)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(emit)
    )
    query = (writer.trigger(**trigger) if trigger else writer).start()
    for path in (out, alerts) if alerts else (out,):
        own(spark, path, query.id)
    return query
