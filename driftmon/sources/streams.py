"""Stream sources and record sinks. Connector and options are the caller's."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmon.functions.codec import encode

# Fixed value: the topic records travel in.
TOPIC = "data_stream"


def kafka_options(servers: str, topic: str = TOPIC, per_trigger: int | None = None) -> dict:
    """Read a topic from its start; later runs resume from the checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_stream(spark: SparkSession, fmt: str, path: str | None = None, **options) -> DataFrame:
    """Raw messages as `value` with `_order`, which sorts them by arrival.

    `kafka` orders by broker time, partition and offset; `text` by file time, file
    and split (the position inside a split is added per micro-batch).
    """
    reader = spark.readStream.format(fmt).options(**options)
    raw = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        order = F.struct("timestamp", "partition", "offset")
    else:
        order = F.struct(
            "_metadata.file_modification_time",
            "_metadata.file_path",
            "_metadata.file_block_start",
        )
    return raw.select("value", order.alias("_order"))


def write_records(df: DataFrame, fmt: str, path: str | None = None, **options) -> None:
    """Records out as JSON messages, to a topic or to text files."""
    writer = encode(df).write.format(fmt).mode("append").options(**options)
    writer.save(path) if path else writer.save()


def show_stream(df: DataFrame, checkpoint: str, **options):
    """Print records as they arrive."""
    return (
        df.writeStream.format("console")
        .options(truncate=False, **options)
        .option("checkpointLocation", checkpoint)
        .start()
    )
