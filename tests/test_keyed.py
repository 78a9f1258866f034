import datetime as dt

from pyspark.sql import functions as F

from driftmon.operators.latest import latest_per_key
from driftmon.schemas import RECORD, VERDICT
from driftmon.sources.keyed import (
    create_tables,
    create_views,
    last_batch,
    promote,
    read_table,
    refresh_table,
    write_batch,
)
from tests.plans import plan_of


def records(spark, rows):
    """Rows of (id, microseconds, label)."""
    df = spark.createDataFrame(rows, "id string, t long, label double")
    return df.select(
        "id",
        F.timestamp_micros("t").alias("timestamp"),
        *[F.lit(float(i)).alias(f"feature_{i}") for i in range(3)],
        "label",
        F.monotonically_increasing_id().alias("seq"),
    )


def labels(df):
    return {(r.id, r.timestamp.microsecond): r.label for r in df.collect()}


def test_last_write_wins_across_and_inside_batches(spark, folder):
    write_batch(records(spark, [("a", 1000, 0.0), ("b", 0, 0.0)]), folder, 0, RECORD)
    again = records(spark, [("a", 1000, 3.0), ("a", 1000, 5.0), ("c", 0, 1.0)])
    write_batch(again, folder, 1, RECORD, order=["seq"])
    assert labels(read_table(spark, folder, RECORD)) == {("a", 1000): 5.0, ("b", 0): 0.0, ("c", 0): 1.0}
    assert labels(read_table(spark, folder, RECORD, up_to=0)) == {("a", 1000): 0.0, ("b", 0): 0.0}
    assert labels(read_table(spark, folder, RECORD, after=0)) == {("a", 1000): 5.0, ("c", 0): 1.0}
    assert last_batch(spark, folder) == 1


def test_replayed_batch_changes_nothing(spark, folder):
    batch = records(spark, [("a", 0, 0.0), ("b", 0, 1.0)])
    write_batch(batch, folder, 0, RECORD)
    before = labels(read_table(spark, folder, RECORD))
    write_batch(batch, folder, 0, RECORD)
    assert labels(read_table(spark, folder, RECORD)) == before
    assert spark.read.parquet(folder).count() == 2


def test_times_within_one_millisecond_are_one_key(spark, folder):
    write_batch(records(spark, [("a", 1100, 0.0), ("a", 1900, 1.0)]), folder, 0, RECORD, order=["seq"])
    assert labels(read_table(spark, folder, RECORD)) == {("a", 1000): 1.0}


def test_reads_do_not_depend_on_their_bounds(spark, folder):
    """Keys that meet at store precision are one key, however the batch is reached."""
    write_batch(records(spark, [("a", 1100, 0.0), ("a", 1900, 1.0)]), folder, 0, RECORD)
    want = {("a", 1000): 1.0}
    for bounds in ({}, {"up_to": 0}, {"after": -1, "up_to": 0}):
        read = read_table(spark, folder, RECORD, **bounds)
        assert read.count() == 1
        assert labels(read) == want
    merged = plan_of(read_table(spark, folder, RECORD))
    assert "SortAggregate" not in merged.replace("ObjectHashAggregate", "")


def test_a_batch_counts_once_it_is_finished(spark, folder):
    assert last_batch(spark, f"{folder}/none") is None
    write_batch(records(spark, [("a", 0, 0.0)]), folder, 9, RECORD)
    write_batch(records(spark, [("b", 0, 0.0)]), folder, 10, RECORD)
    assert last_batch(spark, folder) == 10
    half = records(spark, [("c", 0, 0.0)]).repartition(4)
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/batch_id=11")
    assert last_batch(spark, folder) == 10


def test_null_values_survive_the_merge(spark, folder):
    write_batch(records(spark, [("a", 0, 1.0)]), folder, 0, RECORD)
    write_batch(records(spark, [("a", 0, None)]), folder, 1, RECORD)
    assert labels(read_table(spark, folder, RECORD)) == {("a", 0): None}


def test_latest_with_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("v"),
    )
    got = latest_per_key(df, ["k"], ["seq"])
    assert got.count() == 20_001
    assert got.where("k = 'hot'").first().v == "29997"


def test_largest_row_is_compared_as_it_is(spark):
    rows = [("a", 1.0, None), ("a", None, 9.0), ("a", 1.0, 0.5), ("a", float("nan"), None), ("b", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = latest_per_key(df, ["k"], ["x", "y"])
    assert "max_by" not in plan_of(got)
    assert {r.k: (str(r.x), r.y) for r in got.collect()} == {"a": ("nan", None), "b": ("None", None)}
    df = df.where("not isnan(x) or x is null")
    assert latest_per_key(df, ["k"], ["x", "y"]).where("k = 'a'").first()[1:] == (1.0, 0.5)


def test_promote_is_repeatable_and_keeps_later_rows(spark, folder):
    stream, history = f"{folder}/stream", f"{folder}/history"
    write_batch(records(spark, [("a", 0, 0.0), ("h", 0, 0.0)]), history, 0, RECORD)
    write_batch(records(spark, [("a", 0, 1.0)]), stream, 0, RECORD)
    write_batch(records(spark, [("b", 0, 1.0)]), stream, 1, RECORD)
    mark = promote(spark, stream, history, RECORD, up_to=1)
    promote(spark, stream, history, RECORD, up_to=1)
    write_batch(records(spark, [("late", 0, 1.0)]), stream, 2, RECORD)
    assert labels(read_table(spark, history, RECORD)) == {("a", 0): 1.0, ("b", 0): 1.0, ("h", 0): 0.0}
    assert labels(read_table(spark, stream, RECORD, after=mark)) == {("late", 0): 1.0}
    mark = promote(spark, stream, history, RECORD, up_to=2, after=mark)
    assert read_table(spark, history, RECORD).count() == 4
    assert read_table(spark, stream, RECORD, after=mark).isEmpty()


def test_files_are_clustered_newest_first(spark, folder):
    rows = [(f"k{i % 3}", i * 1000, 0.0) for i in range(30)]
    write_batch(records(spark, rows).coalesce(1), folder, 0, RECORD)
    got = [(r.id, r.timestamp) for r in spark.read.parquet(folder).collect()]
    assert got == sorted(sorted(got, key=lambda r: r[1], reverse=True), key=lambda r: r[0])


def test_catalog_tables(spark, folder):
    create_tables(spark, folder, "drift_test")
    create_tables(spark, folder, "drift_test")
    write_batch(records(spark, [("a", 0, 1.0)]), f"{folder}/dataframe_test", 0, RECORD)
    refresh_table(spark, "dataframe_test", "drift_test")
    assert spark.table("drift_test.dataframe_test").count() == 1
    write_batch(records(spark, [("a", 0, 5.0)]), f"{folder}/dataframe_test", 1, RECORD)
    create_views(spark, folder, "drift_test")
    assert spark.table("drift_test.dataframe_test").count() == 2
    assert labels(spark.table("drift_test.dataframe_test_latest")) == {("a", 0): 5.0}
    assert spark.table("drift_test.drift_analysis_latest").isEmpty()
    stored = [f for f in spark.table("drift_test.drift_analysis").schema if f.name != "batch_id"]
    assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in VERDICT]


def test_published_row_fits_the_verdict_table(spark, folder):
    row = (
        "c235383f-d241-4d5d-8849-565482c7973f",
        1.0,
        0.0,
        4.007,
        6.126,
        6.417,
        dt.datetime(2024, 4, 12, 10, 39, 18, 45000),
        0.885744,
        0.918878,
        False,
    )
    df = spark.createDataFrame([row], VERDICT)
    write_batch(df, folder, 0, VERDICT)
    assert read_table(spark, folder, VERDICT).first() == df.first()
