"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from driftmon import storage

_local_roots: dict[str, str] = {}


def pin(spark: SparkSession) -> SparkSession:
    """Records carry local times without a zone, so the session's zone is set, for good."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may do without: it gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.conf.get("spark.app.id")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="/tmp/run-")
        spark.sparkContext.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the work folder; never reused."""
    return f"{work_root(spark)}/driftmon/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table: the rows no longer depend on how they were made."""
    return written_at(df, work_path(df.sparkSession, name))


def written_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a work table that nothing reads any more; refuses paths outside the work folder."""
    if not path.startswith(f"{work_root(spark)}/driftmon/"):
        raise ValueError(f"{path} is not a work table")
    storage.delete(spark, path)
