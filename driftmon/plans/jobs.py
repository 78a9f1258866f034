"""Train, test, promote, and the cycle that ties them together."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from driftmon import storage
from driftmon.functions.codec import split_rejects
from driftmon.functions.rules import auc_drift, rmse_drift
from driftmon.operators.metrics import auc, rmse
from driftmon.operators.split import chrono_split
from driftmon.operators.verdicts import alerts, stamp
from driftmon.plans import models, runs
from driftmon.schemas import (
    ALERT,
    AUC_THRESHOLD,
    FEATURES,
    HISTORY_TABLE,
    RECORD,
    RMSE_FACTOR,
    RMSE_ROW,
    STREAM_TABLE,
    VERDICT,
    VERDICT_TABLE,
)
from driftmon.session import discard, work_path, written_at
from driftmon.sources.files import read_csv
from driftmon.sources.keyed import BATCH, last_batch, promote, read_table, write_batch

LOAD_REJECTS = -1  # the stream's rejects count from 0


@dataclass(frozen=True)
class Store:
    """Where the tables, the run log, the models and the alerts live."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def history(self):
        return self.path(HISTORY_TABLE)

    @property
    def stream(self):
        return self.path(STREAM_TABLE)

    @property
    def verdicts(self):
        return self.path(VERDICT_TABLE)

    @property
    def rejects(self):
        return self.path("rejects")

    @property
    def runs(self):
        return self.path("runs")

    @property
    def drifted(self):
        """Rows stored by the RMSE variant."""
        return self.path("drifted")

    @property
    def alerts(self):
        return self.path("alerts")

    @property
    def spells(self):
        return self.path("spells")

    def model(self, run_id: str) -> str:
        return self.path(f"models/{run_id}")


METRIC = {"classifier": "auc", "regressor": "rmse"}


def notes(*pairs: tuple[bool, str]) -> str | None:
    """The texts whose condition holds, in one line."""
    return "; ".join(text for holds, text in pairs if holds) or None


def named(run_id: str | None, started: datetime | None = None) -> dict:
    """What the caller of a job has settled about its run."""
    given = {"run_id": run_id, "start_time": started}
    return {k: v for k, v in given.items() if v is not None}


def labelled(df: DataFrame) -> DataFrame:
    """Rows a model can learn from; a missing label would fail the fit."""
    return df.where(F.col("label").isNotNull() & ~F.isnan("label"))


def load_history(
    spark: SparkSession, source: str, store: Store, schema: StructType = RECORD
) -> None:
    """History from CSV as batch 0, later lines winning; lines without a key go to the
    rejects, under a batch number of their own."""
    with_line = StructType([*schema.fields, StructField("raw", StringType())])
    rows = read_csv(spark, source, with_line).withColumn("_row", F.monotonically_increasing_id())
    good, bad = split_rejects(rows)
    write_batch(good, store.history, 0, schema, order=["_row"])
    line = F.coalesce("raw", F.to_csv(F.struct(*schema.names)))
    bad.select(line.alias("raw")).write.mode("overwrite").parquet(
        f"{store.rejects}/{BATCH}={LOAD_REJECTS}"
    )


def train(
    spark: SparkSession,
    history: DataFrame,
    store: Store,
    kind: str = "classifier",
    by: str | int | None = None,
    run_id: str | None = None,
    **params,
) -> dict:
    """Fit on the earlier 70 %, measure, save the model, log the run.

    The classifier's AUC is taken on the later part; the regressor's RMSE on the
    part it was fitted on. History is read once; splitting, fitting and measuring
    read what was written of it. Rows without a label or with a missing feature are
    counted in the note and left out.
    """
    path = work_path(spark, "history")
    needed = ["id", "timestamp", *FEATURES, "label"]
    kept = written_at(history.select(*needed), path)
    unlabelled, incomplete = kept.agg(
        F.count_if(F.col("label").isNull() | F.isnan("label")), F.count_if(~models.complete())
    ).first()
    early, late = chrono_split(labelled(kept).where(models.complete()))
    early = early.select(*FEATURES, "label").persist()
    try:
        low, high = early.agg(F.min("label"), F.max("label")).first()
        model = models.fit(early, kind, by, **params)
        run = runs.new_run("train", **named(run_id))
        run["artifact_uri"] = store.model(run["run_id"])
        if kind == "classifier":
            run["auc"] = auc(models.score(model, late)).first()["auc"]
        else:
            run["rmse"] = rmse(models.score(model, early)).first()["rmse"]
    finally:
        early.unpersist()
    run["note"] = notes(
        (low == high, "training part has a single class"),
        (kind == "classifier" and run["auc"] is None, "hold-out has fewer than two classes"),
        (unlabelled > 0, f"{unlabelled} rows without a label were not used"),
        (incomplete > 0, f"{incomplete} rows with a missing feature were not used"),
    )
    models.save(model, run["artifact_uri"])
    runs.log_run(spark, store.runs, run)
    discard(spark, path)
    return run


Scored = tuple[DataFrame, str, int]


def _scored(spark: SparkSession, table: DataFrame, baseline: dict) -> Scored:
    """The scored rows, written, where they are, and how many could not be scored."""
    path = work_path(spark, "scored")
    incomplete = table.where(~models.complete()).count()
    scored = models.score(models.load(baseline["artifact_uri"]), table.where(models.complete()))
    return written_at(scored, path), path, incomplete


def test(
    spark: SparkSession,
    table: DataFrame,
    baseline: dict,
    store: Store,
    batch_id: int,
    threshold: float = AUC_THRESHOLD,
    run_id: str | None = None,
    started: datetime | None = None,
    scored: Scored | None = None,
) -> dict:
    """Score the table, or take it as `scored` before, compare with the baseline run, store verdict rows, log the run.

    The scored rows are written first and measured from what was written, so the
    verdict belongs to exactly the rows that carry it. `table` holds a key once. Tried again
    under its `run_id`, a test replaces its batch and adds no second alert or run.
    """
    mine = scored is None
    scored, path, incomplete = scored or _scored(spark, table, baseline)
    measured = auc(scored).withColumn(
        "drift", auc_drift(F.col("auc"), F.lit(baseline["auc"]).cast("double"), threshold)
    )
    result = measured.first()
    run = runs.new_run("test", auc=result["auc"], drift=result["drift"], **named(run_id, started))
    run["note"] = notes(
        (result["drift"] is None, "no verdict: a metric is missing"),
        (result["dropped"] > 0, f"{result['dropped']} rows without a label were not measured"),
        (incomplete > 0, f"{incomplete} rows with a missing feature were not scored"),
    )
    rows = stamp(scored, baseline["auc"], result["auc"], result["drift"])
    write_batch(rows, store.verdicts, batch_id, VERDICT, settled=True)
    log_alert(spark, store, run, baseline, "auc")
    runs.log_run(spark, store.runs, run)
    if mine:
        discard(spark, path)
    return run


def log_alert(spark: SparkSession, store: Store, run: dict, baseline: dict, metric: str) -> None:
    """One alert row when the run found drift."""
    verdict = spark.createDataFrame(
        [(run["run_id"], run["start_time"], metric, baseline[metric], run[metric], run["drift"])],
        "run_id string, raised_at timestamp, metric string, baseline double, measured double, "
        "drift boolean",
    )
    if run["drift"]:
        runs.commit(alerts(verdict).select(*ALERT.names), store.alerts, run["run_id"])


def test_rmse(
    spark: SparkSession,
    table: DataFrame,
    baseline: dict,
    store: Store,
    out: str | None = None,
    factor: float = RMSE_FACTOR,
    run_id: str | None = None,
    started: datetime | None = None,
    scored: Scored | None = None,
) -> dict:
    """RMSE variant: rows are stored, with the run's stamp, only when drift was found, and once
    under the run's id, however often the job is tried. `started` is the stamp, by default now."""
    mine = scored is None
    scored, path, incomplete = scored or _scored(spark, table, baseline)
    measured = rmse(scored).withColumn(
        "drift", rmse_drift(F.col("rmse"), F.lit(baseline["rmse"]).cast("double"), factor)
    )
    result = measured.first()
    unlabelled = scored.count() - result["rows"]
    run = runs.new_run("test", rmse=result["rmse"], drift=result["drift"], **named(run_id, started))
    run["note"] = notes(
        (result["drift"] is None, "no verdict: a metric is missing"),
        (unlabelled > 0, f"{unlabelled} rows without a label were not measured"),
        (incomplete > 0, f"{incomplete} rows with a missing feature were not scored"),
    )
    if run["drift"]:
        rows = scored.withColumn("test_timestamp", F.lit(run["start_time"])).select(*RMSE_ROW)
        runs.commit(rows, out or store.drifted, run["run_id"])
    log_alert(spark, store, run, baseline, "rmse")
    runs.log_run(spark, store.runs, run)
    if mine:
        discard(spark, path)
    return run


def promoted_up_to(log: DataFrame) -> int | None:
    """The stream batch up to which rows are in history already."""
    return log.agg(F.max("promoted_up_to")).first()[0]


def promote_and_clear(
    spark: SparkSession, store: Store, up_to: int, after: int | None, rows: DataFrame | None = None
) -> dict:
    """Move stream batches into history, as `rows` if they were read before, and advance the mark
    that hides them."""
    mark = promote(spark, store.stream, store.history, RECORD, up_to, after, rows=rows)
    run = runs.new_run("promote", promoted_up_to=mark)
    runs.log_run(spark, store.runs, run)
    return run


def run_test(
    spark: SparkSession,
    table: DataFrame,
    baseline: dict,
    store: Store,
    batch_id: int,
    kind: str,
    scored: Scored | None = None,
) -> dict:
    """The test that goes with the kind of model."""
    if kind == "regressor":
        return test_rmse(spark, table, baseline, store, scored=scored)
    return test(spark, table, baseline, store, batch_id, scored=scored)


def run_cycle(spark: SparkSession, store: Store, kind: str = "classifier", **params) -> dict:
    """Train, test until the gate opens, promote. The next cycle is the caller's call.

    Each test reads the finished stream batches up to the newest when it starts, and
    the promotion moves exactly what the last test has seen. A stream that keeps
    writing loses nothing; without a stream the cycle ends after training. While no batch has
    come since the test before, the rows that it scored are measured again. The batches are
    merged once and written; counting, scoring and the promotion read what was written.
    """
    mark = promoted_up_to(runs.read_runs(spark, store.runs)) if logged(spark, store) else None
    up_to = last_batch(spark, store.history)
    history = read_table(spark, store.history, RECORD, up_to=up_to)
    trained = train(spark, history, store, kind, **params)
    batch = runs.read_runs(spark, store.runs).where("kind = 'test'").count()
    tested, scored, streamed = None, None, None
    while True:
        up_to = last_batch(spark, store.stream)
        if up_to is None or (mark is not None and up_to <= mark):
            return trained
        if up_to != tested:
            if scored:
                discard(spark, scored[1])
                discard(spark, streamed)
            streamed = work_path(spark, "streamed")
            table = written_at(read_table(spark, store.stream, RECORD, mark, up_to), streamed)
            tested, scored = up_to, _scored(spark, table, trained)
        run_test(spark, table, trained, store, batch, kind, scored)
        batch += 1
        log = runs.read_runs(spark, store.runs)
        if runs.gate(runs.runs_since(log, "test", trained["start_time"])).first()["ready"]:
            discard(spark, scored[1])
            run = promote_and_clear(spark, store, up_to, mark, table)
            discard(spark, streamed)
            return run


def logged(spark: SparkSession, store: Store) -> bool:
    """Whether any run was logged here; the first cycle starts without a log."""
    return storage.exists(spark, store.runs)
