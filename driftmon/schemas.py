"""Schemas, keys and the fixed parameters of the monitor, declared once."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names, types, key and thresholds that results depend on.
FEATURES = ["feature_0", "feature_1", "feature_2"]
KEY = ["id", "timestamp"]
TRAIN_FRACTION = 0.7
AUC_THRESHOLD = 0.05
RMSE_FACTOR = 1.1
BOOSTING_ROUNDS = 10
BATCH_SIZE = 10
RUNS_BEFORE_PROMOTION = 3
PANEL_ROWS = 100
HISTORY_TABLE = "dataframe_train"
STREAM_TABLE = "dataframe_test"
VERDICT_TABLE = "drift_analysis"

# Columns of the stored rows and records, in order.
RMSE_ROW = [
    "id",
    "test_timestamp",
    "label",
    "prediction",
    "feature_0",
    "feature_1",
    "feature_2",
    "timestamp",
]

# Fixed values, as above.
RECORD = StructType(
    [
        StructField("id", StringType()),
        StructField("timestamp", TimestampType()),
        StructField("feature_0", FloatType()),
        StructField("feature_1", FloatType()),
        StructField("feature_2", FloatType()),
        StructField("label", FloatType()),
    ]
)

# Fixed values, as above.
VERDICT = StructType(
    [
        StructField("id", StringType()),
        StructField("label", FloatType()),
        StructField("prediction", FloatType()),
        StructField("feature_0", FloatType()),
        StructField("feature_1", FloatType()),
        StructField("feature_2", FloatType()),
        StructField("timestamp", TimestampType()),
        StructField("train_auc", FloatType()),
        StructField("test_auc", FloatType()),
        StructField("drift", BooleanType()),
    ]
)

# One row per train, test or promote run; `promoted_up_to` is the stream batch
# that the run moved into history, `note` a warning about the data it saw.
RUN = StructType(
    [
        StructField("run_id", StringType()),
        StructField("kind", StringType()),
        StructField("start_time", TimestampType()),
        StructField("status", StringType()),
        StructField("auc", DoubleType()),
        StructField("rmse", DoubleType()),
        StructField("drift", BooleanType()),
        StructField("artifact_uri", StringType()),
        StructField("promoted_up_to", LongType()),
        StructField("note", StringType()),
    ]
)

ALERT = StructType(
    [
        StructField("run_id", StringType()),
        StructField("raised_at", TimestampType()),
        StructField("metric", StringType()),
        StructField("baseline", DoubleType()),
        StructField("measured", DoubleType()),
        StructField("message", StringType()),
    ]
)

# A spell: neighbouring windows with drift. `worst` is the largest distance from the baseline;
# an open spell may go on with the next window.
SPELL = StructType(
    [
        StructField("begin", TimestampType()),
        StructField("end", TimestampType()),
        StructField("windows", LongType()),
        StructField("worst", DoubleType()),
        StructField("open", BooleanType()),
    ]
)
SPELL_KEY = ["begin"]

WINDOW_VERDICT = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("pos", LongType()),
        StructField("neg", LongType()),
        StructField("dropped", LongType()),
        StructField("train_auc", DoubleType()),
        StructField("test_auc", DoubleType()),
        StructField("drift", BooleanType()),
    ]
)
