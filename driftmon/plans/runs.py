"""Run log: one row per run, newest-run lookups, the re-test gate."""

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftmon import storage
from driftmon.functions.rules import known
from driftmon.schemas import RUN, RUNS_BEFORE_PROMOTION


def new_run(kind: str, **fields) -> dict:
    run = dict.fromkeys(RUN.names) | {
        "run_id": uuid4().hex,
        "kind": kind,
        "start_time": datetime.now(timezone.utc),
        "status": "FINISHED",
    }
    return run | fields


def commit(rows: DataFrame, path: str, run_id: str) -> bool:
    """Add the rows of a run to a table, once: they are staged and then take the run's place.

    A job that is tried again under its run id finds the place taken and adds nothing; a job
    that died before has left nothing that a reader sees. Says whether the rows were added.
    """
    spark = rows.sparkSession
    place, staged = f"{path}/run={run_id}", f"{path}.staged/{uuid4().hex}"
    if storage.exists(spark, place):
        return False
    rows.write.parquet(staged)
    added = storage.rename(spark, staged, place)
    if not added:
        storage.delete(spark, staged)
    return added


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all runs of a table."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def log_run(spark: SparkSession, path: str, run: dict) -> bool:
    row = spark.createDataFrame([tuple(run[c] for c in RUN.names)], RUN).coalesce(1)
    return commit(row, path, run["run_id"])


def log_runs(runs: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add runs under the name of their batch; columns the log has and they lack stay empty."""
    have = set(runs.columns)
    cols = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in RUN]
    return commit(runs.select(*cols), path, batch or uuid4().hex)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return committed(spark, path, RUN)


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run whatever its status; the id settles equal start times."""
    return runs.orderBy(F.desc("start_time"), F.desc("run_id")).limit(1)


def latest_usable_run(runs: DataFrame, metric: str = "auc") -> DataFrame:
    """The newest run that logged a number."""
    return latest_run(runs.where(known(F.col(metric))))


def require(run: DataFrame, what: str) -> Row:
    row = run.first()
    if row is None:
        raise ValueError(f"no {what} in the run log")
    return row


def distinct_stamps(runs: DataFrame, stamp: str = "start_time", by=()) -> DataFrame:
    """How many different run stamps there are."""
    return runs.groupBy(*by).agg(F.countDistinct(stamp).alias("runs"))


def gate(
    runs: DataFrame, stamp: str = "start_time", by=(), needed: int = RUNS_BEFORE_PROMOTION
) -> DataFrame:
    """Whether enough test runs were made to go on to promotion."""
    return distinct_stamps(runs, stamp, by).withColumn("ready", F.col("runs") >= needed)


def runs_since(runs: DataFrame, kind: str, since: datetime) -> DataFrame:
    return runs.where((F.col("kind") == kind) & (F.col("start_time") > F.lit(since)))
