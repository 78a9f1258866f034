"""Tables in an outside store, through whatever connector the session has.

The format name and its options (table, keyspace, host) are the caller's. A store
that keys its tables settles repeated keys itself, so rows are simply appended.
"""

from pyspark.sql import DataFrame, SparkSession

from driftmon.functions.codec import to_store


def read_external(spark: SparkSession, fmt: str, **options) -> DataFrame:
    return spark.read.format(fmt).options(**options).load()


def append_external(df: DataFrame, fmt: str, schema, **options) -> None:
    to_store(df, schema).write.format(fmt).mode("append").options(**options).save()


def stream_external(df: DataFrame, fmt: str, checkpoint: str, schema, **options):
    """Stream rows into a keyed store; what is written twice after a restart is one row."""

    def store(batch: DataFrame, _batch_id: int):
        append_external(batch, fmt, schema, **options)

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store).start()
