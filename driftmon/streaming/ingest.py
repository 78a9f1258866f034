"""Ingest: messages to the stream table, keyless rows to a reject table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from driftmon.functions.codec import decode, split_rejects
from driftmon.schemas import RECORD
from driftmon.sources.keyed import BATCH, claim, own, write_batch

REJECT = StructType([StructField("raw", StringType())])


def ingest_batch(
    batch: DataFrame, batch_id: int, table: str, rejects: str, schema=RECORD, uuid_ids: bool = False
):
    """Store one micro-batch. Running it again with the same number changes nothing."""
    placed = batch.withColumn("_row", F.monotonically_increasing_id())
    decoded = decode(
        placed.withColumn("raw", F.col("value").cast("string")),
        "raw",
        schema,
        keep=("_order", "_row", "raw"),
    ).persist()
    try:
        good, bad = split_rejects(decoded, uuid_ids=uuid_ids)
        write_batch(good, table, batch_id, schema, order=["_order", "_row"])
        bad.select("raw").write.mode("overwrite").parquet(f"{rejects}/{BATCH}={batch_id}")
    finally:
        decoded.unpersist()


def start_ingest(
    messages: DataFrame,
    table: str,
    rejects: str,
    checkpoint: str,
    schema=RECORD,
    trigger: dict | None = None,
    uuid_ids: bool = False,
):
    """Start the stream into the table; offsets live in `checkpoint`, to which the table
    belongs from then on.

    `trigger` takes the arguments of `DataStreamWriter.trigger`, for example
    `{"availableNow": True}`; without it micro-batches follow one another.
    """
    spark = messages.sparkSession
    claim(spark, table, checkpoint)
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, n: ingest_batch(df, n, table, rejects, schema, uuid_ids)
    )
    query = (writer.trigger(**trigger) if trigger else writer).start()
    own(spark, table, query.id)
    return query


def start_rejects(bad: DataFrame, rejects: str, checkpoint: str, trigger: dict | None = None):
    """Keep what a stream cannot use, as JSON in `raw`, so that it can be counted. The folder
    belongs to the checkpoint; another one, whose batches would replace these, is refused."""
    spark = bad.sparkSession
    claim(spark, rejects, checkpoint)

    def keep(rows: DataFrame, batch_id: int):
        rows.write.mode("overwrite").parquet(f"{rejects}/{BATCH}={batch_id}")

    raw = bad.select(F.to_json(F.struct("*")).alias("raw"))
    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
    query = (writer.trigger(**trigger) if trigger else writer).start()
    own(spark, rejects, query.id)
    return query
