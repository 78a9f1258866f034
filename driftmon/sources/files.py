"""History and stream files: CSV with a header, ARFF text, slices in file order."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftmon.functions.codec import features_from_text
from driftmon.schemas import BATCH_SIZE, RECORD
from driftmon.session import written

# The stream files by drift type.
DRIFT_FILES = {
    1: "sea_tst1.arff",
    2: "sea_tst2.arff",
    3: "sea_tst3.arff",
    4: "sea_tst4.arff",
}


def read_csv(spark: SparkSession, path: str, schema: StructType = RECORD, **options) -> DataFrame:
    """CSV with a header line; fields that do not parse become null.

    A text column of the schema named `raw` gets the line where something did not parse.
    """
    return spark.read.options(**options).csv(
        path, schema=schema, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="raw"
    )


def drift_path(folder: str, drift_type: int) -> str:
    """The stream file for a drift type."""
    if drift_type not in DRIFT_FILES:
        raise ValueError(f"unknown drift type {drift_type}; known: {sorted(DRIFT_FILES)}")
    return f"{folder.rstrip('/')}/{DRIFT_FILES[drift_type]}"


def read_arff(spark: SparkSession, path: str) -> DataFrame:
    """Data lines as features and label with `idx`, their 0-based place in the file(s).

    Header, comment and blank lines are dropped first, so a split's rows are numbered
    without gaps and a row's place is the rows of earlier splits plus its distance
    from the first row of its own. The parsed rows are written once before splits
    are counted, since a second scan may cut the files differently.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.trim("value").alias("_line"),
    )
    data = lines.where(~F.col("_line").rlike("^([%@]|$)"))
    fields = features_from_text(F.split("_line", ","))
    rows = written(
        data.select("_file", "_block", F.monotonically_increasing_id().alias("_at"), *fields),
        "arff",
    )
    splits = rows.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_file",
        "_block",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return rows.join(starts, ["_file", "_block"]).select(
        (F.col("_at") + F.col("_shift")).alias("idx"),
        *[c for c in rows.columns if not c.startswith("_")],
    )


def take_slice(rows: DataFrame, cursor: int, size: int = BATCH_SIZE) -> DataFrame:
    """The next `size` rows from the cursor; past the end there are none."""
    return rows.where((F.col("idx") >= cursor) & (F.col("idx") < cursor + size))


def index_arff(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The file's rows stored in order of `idx`, so that a slice reads the row groups it lies in."""
    read_arff(spark, path).orderBy("idx").write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def start_slices(rows: DataFrame, size: int, send, checkpoint: str, trigger: dict | None = None):
    """Send the rows of an indexed file on in file order, `size` a micro-batch, by
    `send(slice, batch_id)`.

    The stream's offset is the place in the file, so `checkpoint` keeps the cursor: a new start
    goes on behind the last finished slice, also with another `size`, and a slice that was not
    finished is sent again under its number. Nothing is sent past the end. `trigger` is the
    pace: `{"processingTime": "10 seconds"}` sends a slice each interval, `{"availableNow": True}`
    the next one, after one that was not finished.
    """
    spark = rows.sparkSession
    places = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", size).load()

    def one(batch: DataFrame, batch_id: int):
        first, last = batch.agg(F.min("value"), F.max("value")).first()
        part = take_slice(rows, first, last - first + 1)
        if not part.isEmpty():
            send(part, batch_id)

    writer = places.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one)
    return (writer.trigger(**trigger) if trigger else writer).start()
