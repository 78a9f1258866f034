"""Stand-ins for the monitored data, derived from the shared Parquet tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmon.operators.split import block_cuts, block_number

# Zone-less timestamps are read as UTC instants, so comparisons reach the scan.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp, o_orderpriority string",
}

# Concept thresholds of the four stream blocks, in order.
THETA = [8.0, 9.0, 7.0, 9.5]
# Largest quantity of the positive class in the four blocks of `steps`.
STEPS = [25.0, 35.0, 25.0, 40.0]
RECORD_COLUMNS = ["id", "timestamp", "feature_0", "feature_1", "feature_2", "label"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _padded(col: str, width: int) -> Column:
    return F.lpad(F.col(col).cast("string"), width, "0")


def sea_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as unlabelled points; the id sorts like the columns it is made of."""
    day = F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100 + F.day("l_shipdate")
    key = F.concat_ws(
        "-",
        _padded("l_orderkey", 12),
        _padded("l_linenumber", 2),
        _padded("l_partkey", 11),
        _padded("l_suppkey", 10),
        day.cast("string"),
    )
    mix = (
        F.col("l_orderkey") * 7
        + F.col("l_partkey") * 13
        + F.col("l_suppkey") * 3
        + F.col("l_linenumber")
    )
    return table(spark, sf_dir, "lineitem").select(
        key.alias("id"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_quantity") / 5).alias("feature_0"),
        (F.col("l_extendedprice") / 10500).alias("feature_1"),
        (F.col("l_discount") * 100).alias("feature_2"),
        (mix % 10 == 0).alias("noisy"),
    )


def sea(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled points in four blocks of time whose concept changes from block to block."""
    points = sea_points(spark, sf_dir)
    cuts = block_cuts(points, len(THETA))
    theta = F.element_at(F.array(*[F.lit(t) for t in THETA]), F.col("blk").cast("int"))
    clean = F.col("feature_0") + F.col("feature_1") <= theta
    return points.withColumn("blk", block_number(cuts)).withColumns(
        {"clean": clean.cast("double"), "label": (clean != F.col("noisy")).cast("double")}
    )


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points whose label is one bound on a feature of few values, so that trees with enough
    bins fit a block without error. The bound differs from block to block."""
    points = sea_points(spark, sf_dir)
    cuts = block_cuts(points, len(STEPS))
    bound = F.element_at(F.array(*[F.lit(t) for t in STEPS]), F.col("blk").cast("int"))
    quantity = F.round(F.col("feature_0") * 5)
    return points.withColumn("blk", block_number(cuts)).select(
        "id",
        "timestamp",
        quantity.alias("feature_0"),
        F.round("feature_2").alias("feature_1"),
        F.lit(1.0).alias("feature_2"),
        (quantity <= bound).cast("double").alias("label"),
        "blk",
    )


def hard_score() -> Column:
    """Deterministic classifier that knows the first block's concept."""
    return (F.col("feature_0") + F.col("feature_1") <= THETA[0]).cast("double")


def rank_score() -> Column:
    """Deterministic margin: the ranking of the concept without its threshold."""
    return -(F.col("feature_0") + F.col("feature_1"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records, errors being the positive class."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("feature_0"),
        F.get_json_object("props", "$.k").cast("double").alias("feature_1"),
        F.col("user_id").cast("double").alias("feature_2"),
        (F.col("event_type") == "error").cast("double").alias("label"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a run log with failed runs, NaN metrics and equal start times."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    metric = (
        F.when(status == "P", F.lit(None))
        .when(priority == "1-URGENT", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice") / 1000000)
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_custkey").alias("model"),
        F.col("o_orderdate").alias("start_time"),
        F.when(status == "P", "FAILED").otherwise("FINISHED").alias("status"),
        metric.alias("auc"),
    )
