"""How far the consumers of a message folder are, read from their checkpoints."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmon import storage

SEEN = "path string, batchId long"  # what the file source notes of a file


def _same(path: str) -> Column:
    """A path as text in one form; Spark writes a scheme with one slash here and three there."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/").alias("path")


def committed(spark: SparkSession, checkpoint: str) -> int | None:
    """The source's offset as of the last finished micro-batch; None before the first."""
    done = [int(n) for n in storage.names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not done:
        return None
    noted = storage.read_line(spark, f"{checkpoint}/offsets/{max(done)}")
    return json.loads(noted.splitlines()[-1])["logOffset"]


def seen_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The files that finished micro-batches of a one-source stream have read. Its notes are
    folded from time to time and then name a file twice."""
    offset = committed(spark, checkpoint)
    if offset is None:
        return spark.createDataFrame([], "path string")
    notes = spark.read.text(f"{checkpoint}/sources/0").select(F.from_json("value", SEEN).alias("n"))
    return notes.where(F.col("n.batchId") <= offset).select(_same("n.path")).distinct()


def lag(spark: SparkSession, path: str, consumers: dict[str, str]) -> DataFrame:
    """consumer, messages, behind: of the messages in a folder, how many each consumer, a name with
    a checkpoint, has still to read. A consumer without a finished micro-batch has all to read.

    Consumers do not share offsets, so one that stopped holds up no other. Messages are counted
    per file before anything is joined.
    """
    sent = spark.read.text(path).groupBy(_same("_metadata.file_path")).agg(F.count("*").alias("n"))
    names = F.explode(F.array(*[F.lit(name) for name in consumers]))
    sent = sent.select("path", "n", names.alias("consumer"))
    seen = None
    for name, checkpoint in consumers.items():
        files = seen_files(spark, checkpoint).select("path", F.lit(name).alias("consumer"), F.lit(True).alias("read"))
        seen = files if seen is None else seen.union(files)
    behind = F.sum(F.when(F.col("read").isNull(), F.col("n")).otherwise(0))
    return sent.join(seen, ["path", "consumer"], "left").groupBy("consumer").agg(
        F.sum("n").alias("messages"), behind.alias("behind")
    )
