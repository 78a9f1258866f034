"""Every operator as a query over the shared tables."""

import uuid
from datetime import datetime, timedelta, timezone
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from driftmon.functions.codec import (
    decode,
    encode,
    is_uuid,
    iso_text,
    round_number,
    split_rejects,
    to_store,
    uuid_from,
)
from driftmon.operators import metrics, split, verdicts
from driftmon.operators.latest import latest_per_key
from driftmon.operators.ranking import row_numbers
from driftmon.operators.selection import extent
from driftmon.operators.verdicts import stamp_by
from driftmon.plans import fixtures, jobs, models, runs
from driftmon.plans.fixtures import RECORD_COLUMNS
from driftmon.schemas import (
    ALERT,
    AUC_THRESHOLD,
    BATCH_SIZE,
    RECORD,
    RMSE_ROW,
    STREAM_TABLE,
    VERDICT,
    WINDOW_VERDICT,
)
from driftmon.session import pin, work_path, written
from driftmon.sources.consumers import lag
from driftmon.sources.files import (
    DRIFT_FILES,
    drift_path,
    index_arff,
    read_arff,
    start_slices,
    take_slice,
)
from driftmon.sources.keyed import (
    BATCH,
    compact,
    create_views,
    promote,
    read_table,
    reclaim,
    scan_batches,
    write_batch,
)
from driftmon.sources.streams import read_stream, write_records
from driftmon.streaming.ingest import REJECT, ingest_batch, start_ingest
from driftmon.streaming.monitor import read_spells, start_monitor, window_counts, window_verdicts

QUERIES = {}


def query(fn):
    """Register a query; times go out without a zone, as the tables hold them."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fn(pin(spark), sf_dir)
        zoned = [f.name for f in out.schema if isinstance(f.dataType, TimestampType)]
        return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[fn.__name__] = run
    return run


def widened(df: DataFrame) -> DataFrame:
    """Float columns as doubles of the same value, for comparison by value."""
    floats = [c for c, t in df.dtypes if t == "float"]
    return df.withColumns({c: F.col(c).cast("double") for c in floats})


# Records and codec


@query
def json_encode(spark, sf_dir):
    return encode(fixtures.events(spark, sf_dir))


@query
def json_decode(spark, sf_dir):
    messages = encode(fixtures.events(spark, sf_dir)).select(F.col("value").cast("binary"))
    return widened(decode(messages))


@query
def decode_rejects(spark, sf_dir):
    sea = fixtures.sea(spark, sf_dir)
    text = F.to_json(F.struct(*[F.col(c) for c in RECORD_COLUMNS]))
    broken = F.concat(F.when(F.col("noisy"), "{").otherwise(""), text)
    messages = sea.select(F.col("id").alias("sent_id"), broken.alias("value"))
    _, bad = split_rejects(decode(messages, keep=["sent_id"]))
    return bad.select("sent_id")


@query
def round_features(spark, sf_dir):
    items = fixtures.table(spark, sf_dir, "lineitem")
    price = (F.col("l_extendedprice") / 7).cast("string")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return items.select(*keys, round_number(price).alias("feature_1"))


@query
def iso_timestamp(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", iso_text("ts").alias("emitted_at")
    )


@query
def sink_coerce(spark, sf_dir):
    events = fixtures.events(spark, sf_dir).withColumn("id", uuid_from("id"))
    return widened(to_store(events, RECORD)).withColumn("valid_id", is_uuid("id"))


# Keyed tables


@query
def upsert_latest(spark, sf_dir):
    items = fixtures.table(spark, sf_dir, "lineitem")
    return latest_per_key(
        items, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]
    )


@query
def table_scan_latest(spark, sf_dir):
    items = fixtures.table(spark, sf_dir, "lineitem")
    path, key = work_path(spark, "items"), ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    older = F.col("l_shipdate") < F.to_timestamp(F.lit("1998-07-01"))
    for n, part in enumerate([items.where(older), items.where(~older)]):
        write_batch(part, path, n, items.schema, order, key)
    return read_table(spark, path, items.schema, key=key)


@query
def clustered_newest_first(spark, sf_dir):
    """Inside each stored file the rows of a user follow one another, newest first."""
    events = fixtures.table(spark, sf_dir, "events")
    path = work_path(spark, "clustered")
    write_batch(events, path, 0, events.schema, key=["user_id", "ts", "event_id"])
    place = Window.partitionBy("_file", "user_id").orderBy("_row")
    follows = (F.lag("_row").over(place) == F.col("_row") - 1) & (F.lag("ts").over(place) >= F.col("ts"))
    return (
        scan_batches(spark, path, events.schema)
        .select("event_id", "user_id", "ts", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        .select("event_id", "user_id", "ts", F.coalesce(follows, F.lit(True)).alias("in_order"))
    )


def _loaded(spark, sf_dir):
    """History loaded from CSV in which some lines have lost their id."""
    store = jobs.Store(work_path(spark, "store"))
    sea = fixtures.sea(spark, sf_dir)
    path = work_path(spark, "csv")
    lines = sea.withColumn("id", F.when(~F.col("noisy"), F.col("id"))).select(*RECORD_COLUMNS)
    lines.write.csv(path, header=True)
    jobs.load_history(spark, path, store)
    return store


@query
def csv_load(spark, sf_dir):
    return widened(read_table(spark, _loaded(spark, sf_dir).history, RECORD))


@query
def csv_rejects(spark, sf_dir):
    raw = spark.read.schema(REJECT).parquet(_loaded(spark, sf_dir).rejects)
    fields = F.from_csv("raw", RECORD.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    return widened(raw.select(fields.alias("r")).select("r.timestamp", "r.feature_1"))


@query
def catalog_latest(spark, sf_dir):
    """The view over a registered table shows the newest row of every key."""
    store = jobs.Store(work_path(spark, "store"))
    events = fixtures.events(spark, sf_dir)
    write_batch(events, store.stream, 0, RECORD)
    write_batch(events.where("label = 1").withColumn("label", F.lit(2.0)), store.stream, 1, RECORD)
    database = f"drift_{uuid.uuid4().hex}"
    create_views(spark, store.root, database)
    return widened(_read_and_drop(spark, database))


def _read_and_drop(spark, database):
    """What the stream's view shows, and no trace of it in the catalog."""
    shown = written(spark.table(f"{database}.{STREAM_TABLE}_latest"), "view")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return shown


@query
def catalog_after_promote(spark, sf_dir):
    """A view made before a promotion hides what was promoted since; a batch that is still being
    written does not show. Batches 0 and 1 are folded into a base, batch 2 has come since."""
    store = jobs.Store(work_path(spark, "store"))
    events = fixtures.events(spark, sf_dir)
    third = F.col("id").cast("long") % 3
    for n in range(3):
        again = events.where((third == n) | ((third == n - 1) & (F.col("label") == 1)))
        write_batch(again.withColumn("label", F.lit(float(n))), store.stream, n, RECORD)
    compact(spark, store.stream, RECORD)
    unfinished = spark.read.parquet(f"{store.stream}/{BATCH}=0").withColumn("label", F.lit(9.0).cast("float"))
    quiet = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    unfinished.write.options(**quiet).parquet(f"{store.stream}/{BATCH}=3")
    database = f"drift_{uuid.uuid4().hex}"
    create_views(spark, store.root, database)
    jobs.promote_and_clear(spark, store, up_to=0, after=None)
    return widened(_read_and_drop(spark, database))


def _compacted(spark, sf_dir):
    """Line items in four batches by year, the later ones repeating some keys of the earlier; the
    first two folded, the third replayed with what it held before and then folded too."""
    items = fixtures.table(spark, sf_dir, "lineitem")
    path, key = work_path(spark, "items"), ["l_orderkey", "l_linenumber"]
    order = ["l_shipdate", "l_partkey", "l_suppkey"]

    def batch(n):
        cuts = ["1994-01-01", "1996-01-01", "1998-01-01"]
        lo, hi = ([None, *cuts][n], [*cuts, None][n])
        part = items
        for day, cond in ((lo, F.col("l_shipdate") >= F.to_timestamp(F.lit(lo))), (hi, F.col("l_shipdate") < F.to_timestamp(F.lit(hi)))):
            part = part.where(cond) if day else part
        write_batch(part, path, n, items.schema, order, key)

    for n in (0, 1, 2):
        batch(n)
    compact(spark, path, items.schema, key=key, buckets=4)
    batch(2)
    batch(3)
    compact(spark, path, items.schema, key=key)
    return path, items.schema, key


@query
def compacted_scan(spark, sf_dir):
    """The newest version of every key from a base of three batches and one batch since."""
    path, schema, key = _compacted(spark, sf_dir)
    try:
        write_batch(read_table(spark, path, schema, key=key), path, 1, schema, key=key, settled=True)
    except ValueError:
        return read_table(spark, path, schema, key=key)
    raise AssertionError("a folded batch was written again")


@query
def reclaimed_scan(spark, sf_dir):
    """Promoted batches are removed, then more is promoted: history has the rows all the same."""
    path, schema, key = _compacted(spark, sf_dir)
    history = work_path(spark, "history")
    mark = promote(spark, path, history, schema, up_to=2, key=key)
    if reclaim(spark, path, up_to=1) != 2:
        raise AssertionError("two batches should have gone")
    promote(spark, path, history, schema, up_to=3, after=mark, key=key)
    return read_table(spark, history, schema, key=key)


@query
def reject_bad_ids(spark, sf_dir):
    """A store whose ids are UUIDs takes the records that have one; the others are rejected."""
    events = fixtures.events(spark, sf_dir)
    shaped = F.when(F.col("label") == 1, F.col("id")).otherwise(uuid_from("id"))
    sent = encode(events.withColumn("id", shaped)).withColumn("_order", F.lit(0))
    store = jobs.Store(work_path(spark, "store"))
    ingest_batch(sent, 0, store.stream, store.rejects, uuid_ids=True)
    good = read_table(spark, store.stream, RECORD).select("id", F.lit(True).alias("stored"))
    bad = spark.read.schema(REJECT).parquet(store.rejects)
    return good.union(bad.select(F.get_json_object("raw", "$.id"), F.lit(False)))


@query
def promote_test_to_train(spark, sf_dir):
    return _promotion(spark, sf_dir)[0]


@query
def remaining_after_promote(spark, sf_dir):
    return _promotion(spark, sf_dir)[1]


def _promotion(spark, sf_dir):
    """History with clean labels up to mid 1998; the stream, from 1997 on, re-labels
    part of it. Its batch 0 is promoted, batch 1 has arrived since."""
    sea = fixtures.sea(spark, sf_dir)
    cols = [F.col(c) for c in RECORD_COLUMNS]
    schema = StructType([StructField(c, sea.schema[c].dataType) for c in RECORD_COLUMNS])
    history, stream = work_path(spark, "history"), work_path(spark, "stream")
    time = F.col("timestamp")

    def day(text):
        return F.to_timestamp(F.lit(text))

    first = sea.where(time < day("1998-07-01")).withColumn("label", F.col("clean"))
    write_batch(first.select(*cols), history, 0, schema)
    batches = [
        sea.where((time >= day("1997-07-01")) & (time < day("2000-01-01"))),
        sea.where(time >= day("2000-01-01")),
    ]
    for n, part in enumerate(batches):
        write_batch(part.select(*cols), stream, n, schema)
    mark = promote(spark, stream, history, schema, up_to=0)
    return (
        read_table(spark, history, schema),
        read_table(spark, stream, schema, after=mark),
    )


# Files and slices


def _write_arff(spark, points, path):
    """Points in time order as ARFF text."""
    header = spark.createDataFrame(
        [
            ("% points in stream order",),
            ("@relation sea",),
            *[(f"@attribute {c} numeric",) for c in RECORD_COLUMNS[2:]],
            ("",),
            ("@data",),
        ],
        "value string",
    ).coalesce(1)
    line = F.concat_ws(",", *[F.col(c) for c in RECORD_COLUMNS[2:]])
    header.union(points.orderBy("timestamp", "id").select(line.alias("value"))).write.text(path)


def _arff(spark, sf_dir):
    """The stream in time order as ARFF text, read back."""
    path = work_path(spark, "arff")
    _write_arff(spark, fixtures.sea(spark, sf_dir), path)
    return read_arff(spark, path)


@query
def arff_scan(spark, sf_dir):
    return _arff(spark, sf_dir)


@query
def source_slice(spark, sf_dir):
    """Three slices taken from a cursor, which together are the whole file."""
    rows = _arff(spark, sf_dir)
    parts = [
        take_slice(rows, at, size).withColumn("slice", F.lit(at).cast("long"))
        for at, size in ((0, BATCH_SIZE), (BATCH_SIZE, 990), (BATCH_SIZE + 990, 1 << 40))
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query
def drift_sources(spark, sf_dir):
    """A file for each type of drift, each found by its type and read in its own order."""
    sea = written(fixtures.sea(spark, sf_dir), "sea")
    folder, parts = work_path(spark, "drift"), []
    for kind in sorted(DRIFT_FILES):
        _write_arff(spark, sea.where(F.col("blk") == kind), drift_path(folder, kind))
        rows = read_arff(spark, drift_path(folder, kind))
        parts.append(rows.withColumn("drift_type", F.lit(kind)))
    return reduce(DataFrame.union, parts)


@query
def slice_stream(spark, sf_dir):
    """A file sent in three slices by a stream that is stopped after each, and once more past the end."""
    path, indexed, out, cursor = (work_path(spark, n) for n in ("arff", "indexed", "slices", "offsets"))
    _write_arff(spark, fixtures.sea(spark, sf_dir), path)
    rows = index_arff(spark, path, indexed)
    size = -(-rows.count() // 3)

    def send(part, n):
        part.write.mode("overwrite").parquet(f"{out}/{BATCH}={n}")

    for _ in range(4):
        start_slices(rows, size, send, cursor, {"availableNow": True}).awaitTermination()
    return spark.read.parquet(out).withColumn("slice", F.col(BATCH).cast("long")).drop(BATCH)


# Ranks and splits


@query
def row_number_by_time(spark, sf_dir):
    events = fixtures.events(spark, sf_dir)
    return row_numbers(events.select("id", "timestamp", "label"), ["timestamp", "id"])


@query
def history_count(spark, sf_dir):
    size = extent(fixtures.events(spark, sf_dir))
    return spark.createDataFrame([(size.rows, size.lo, size.hi)], "rows long, lo long, hi long")


@query
def chrono_split(spark, sf_dir):
    points = fixtures.sea_points(spark, sf_dir)
    return points.select("id", "timestamp", split.train_part(points).alias("in_train"))


@query
def split_sizes(spark, sf_dir):
    early, late = split.chrono_split(fixtures.events(spark, sf_dir))
    both = early.withColumn("part", F.lit("train")).union(late.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


# Metrics and drift


@query
def auc_exact(spark, sf_dir):
    return metrics.auc(fixtures.events(spark, sf_dir), "feature_0")


@query
def auc_by_block(spark, sf_dir):
    sea = fixtures.sea(spark, sf_dir)
    scorer = F.explode(
        F.array(
            F.struct(F.lit("hard").alias("scorer"), fixtures.hard_score().alias("score")),
            F.struct(F.lit("rank").alias("scorer"), fixtures.rank_score().alias("score")),
        )
    )
    scored = sea.select("blk", "label", scorer.alias("s")).select("blk", "label", "s.*")
    return metrics.auc(scored, by=["scorer", "blk"])


def _hard(spark, sf_dir):
    score = fixtures.hard_score()
    return fixtures.sea(spark, sf_dir).withColumns({"score": score, "prediction": score})


def _auc_verdicts(scored, score="score"):
    return verdicts.auc_verdicts(metrics.auc(scored, score, by=["blk"]), "blk", 1)


def _rmse_verdicts(scored):
    return verdicts.rmse_verdicts(metrics.rmse(scored, by=["blk"]), "blk", 1)


@query
def auc_drift_by_block(spark, sf_dir):
    return _auc_verdicts(_hard(spark, sf_dir))


@query
def auc_drift_by_rank_score(spark, sf_dir):
    sea = fixtures.sea(spark, sf_dir).withColumn("score", fixtures.rank_score())
    return _auc_verdicts(sea)


@query
def auc_drift_by_window(spark, sf_dir):
    events = fixtures.events(spark, sf_dir).withColumn("score", F.col("feature_0"))
    return window_verdicts(window_counts(events, "1 day"), baseline=0.5)


@query
def rmse(spark, sf_dir):
    out = metrics.rmse(_hard(spark, sf_dir))
    return out.withColumn("rmse", F.round("rmse", 9))


@query
def rmse_drift_by_block(spark, sf_dir):
    out = _rmse_verdicts(_hard(spark, sf_dir))
    return out.withColumns({c: F.round(c, 9) for c in ("train_rmse", "test_rmse")})


@query
def rmse_conditional_rows(spark, sf_dir):
    """Every block is tested; the rows of those with drift are stored."""
    store = jobs.Store(work_path(spark, "store"))
    steps = written(fixtures.steps(spark, sf_dir), "steps")
    run = jobs.train(spark, steps.where("blk = 1"), store, "regressor", **EXACT)
    for blk in range(1, len(fixtures.STEPS) + 1):
        for _ in range(2 if blk == 4 else 1):  # a retry under the same id adds no row
            jobs.test_rmse(
                spark,
                steps.where(F.col("blk") == blk),
                run,
                store,
                run_id=f"test-{blk}",
                started=datetime(2024, 4, 12, tzinfo=timezone.utc) + timedelta(days=blk),
            )
    return spark.read.parquet(store.drifted).select(*RMSE_ROW)


def _verdict_rows(spark, sf_dir):
    scored = _hard(spark, sf_dir)
    return stamp_by(scored, _auc_verdicts(scored), "blk").select(*VERDICT.names)


@query
def verdict_table(spark, sf_dir):
    return _verdict_rows(spark, sf_dir)


@query
def verdict_retest(spark, sf_dir):
    """All blocks judged by a wide threshold, then the later two by the usual one."""
    scored = written(_hard(spark, sf_dir), "scored")
    measured = written(metrics.auc(scored, by=["blk"]), "measured")
    path = work_path(spark, "verdicts")
    for batch, threshold in ((0, 0.08), (1, AUC_THRESHOLD)):
        judged = verdicts.auc_verdicts(measured, "blk", 1, threshold)
        part = scored.where("blk > 2") if batch else scored
        write_batch(stamp_by(part, judged, "blk"), path, batch, VERDICT)
    return widened(read_table(spark, path, VERDICT))


@query
def panel_drift_series(spark, sf_dir):
    return verdicts.drift_series(_verdict_rows(spark, sf_dir))


@query
def panel_feature_series(spark, sf_dir):
    return verdicts.newest(fixtures.events(spark, sf_dir), "feature_0")


@query
def alerts(spark, sf_dir):
    return verdicts.alerts(_auc_verdicts(_hard(spark, sf_dir)))


# Run log


@query
def latest_run(spark, sf_dir):
    return runs.latest_run(fixtures.run_log(spark, sf_dir)).select("run_id", "start_time", "status")


@query
def latest_usable_run(spark, sf_dir):
    log = fixtures.run_log(spark, sf_dir)
    return runs.latest_usable_run(log).select("run_id", "start_time", "status", "auc")


@query
def distinct_test_runs(spark, sf_dir):
    return runs.distinct_stamps(fixtures.run_log(spark, sf_dir))


@query
def retrain_gate(spark, sf_dir):
    return runs.gate(fixtures.run_log(spark, sf_dir), by=["model"])


@query
def run_log_roundtrip(spark, sf_dir):
    path = work_path(spark, "runs")
    runs.log_runs(fixtures.run_log(spark, sf_dir), path)
    log = runs.read_runs(spark, path).select("run_id", "start_time", "status", "auc")
    return log.withColumn("auc", F.nanvl("auc", F.lit(-1.0)))


# Models

PARTS = 4


@query
def class_spread(spark, sf_dir):
    """Training rows dealt so that every partition has its share of each class; the rows of one
    partition may be off by five standard deviations of chance."""
    dealt = models.spread(fixtures.sea(spark, sf_dir).select("label"), ("label", PARTS))
    found = dealt.groupBy("label", F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    share = F.sum("n") / PARTS
    off = F.greatest(F.max("n") - share, share - F.min("n"))
    return found.groupBy("label").agg(
        F.sum("n").alias("rows"), F.count("*").alias("parts"), (off <= 5 * F.sqrt(share)).alias("even")
    )

# A bin for every quantity, and no split on what is left of rounding once a point is fitted.
EXACT = {"maxBins": 64, "minInfoGain": 1e-9}


def _steps(spark, sf_dir, kind="classifier"):
    """Points, and the run of a model that was trained and saved on their first block."""
    store = jobs.Store(work_path(spark, "store"))
    steps = written(fixtures.steps(spark, sf_dir), "steps")
    return steps, jobs.train(spark, steps.where("blk = 1"), store, kind, **EXACT)


def _scored(spark, sf_dir, kind="classifier"):
    steps, run = _steps(spark, sf_dir, kind)
    return written(models.score(models.load(run["artifact_uri"]), steps), "scored"), run


@query
def gbt_train_test(spark, sf_dir):
    """Train on the first block, score all blocks, stamp each with its verdict."""
    scored, _ = _scored(spark, sf_dir)
    return stamp_by(scored, _auc_verdicts(scored), "blk").select("blk", *VERDICT.names)


def sea_scores(spark, sf_dir):
    """Noisy points whose concept needs two features, scored by a model of their first block."""
    store = jobs.Store(work_path(spark, "store"))
    sea = written(fixtures.sea(spark, sf_dir), "sea")
    run = jobs.train(spark, sea.where("blk = 1"), store)
    return written(models.score(models.load(run["artifact_uri"]), sea), "scored"), run


@query
def gbt_sea(spark, sf_dir):
    """Verdicts by block on points that no tree fits without error."""
    return _auc_verdicts(sea_scores(spark, sf_dir)[0])


@query
def gbt_score(spark, sf_dir):
    """Predictions, the side of the margin and of the probability, and the AUC on the hold-out."""
    scored, run = _scored(spark, sf_dir)
    return scored.select(
        "id",
        "timestamp",
        "label",
        "prediction",
        (F.col("score") > 0).alias("positive"),
        (F.col("probability") > 0.5).alias("likely"),
        F.lit(run["auc"]).alias("train_auc"),
    )


@query
def gbt_regressor(spark, sf_dir):
    scored, run = _scored(spark, sf_dir, "regressor")
    out = _rmse_verdicts(scored).withColumn("stored_rmse", F.lit(run["rmse"]))
    return out.withColumns({c: F.round(c, 9) for c in ("train_rmse", "test_rmse", "stored_rmse")})


def _cycled(spark, sf_dir, kind):
    """A store after a whole cycle: the first block is history, the next two were streamed before
    the cycle, the last one after it."""
    store = jobs.Store(work_path(spark, "store"))
    steps = written(fixtures.steps(spark, sf_dir), "steps")
    records = steps.select(*RECORD.names, "blk")
    for path, batch, blk in ((store.history, 0, 1), (store.stream, 0, 2), (store.stream, 1, 3)):
        write_batch(records.where(F.col("blk") == blk), path, batch, RECORD)
    jobs.run_cycle(spark, store, kind, **EXACT)
    write_batch(records.where("blk = 4"), store.stream, 2, RECORD)
    return store


@query
def cycle_history(spark, sf_dir):
    return widened(read_table(spark, _cycled(spark, sf_dir, "classifier").history, RECORD))


@query
def cycle_remaining(spark, sf_dir):
    """What the stream's table shows after the cycle: the block that came later."""
    store = _cycled(spark, sf_dir, "classifier")
    mark = jobs.promoted_up_to(runs.read_runs(spark, store.runs))
    return widened(read_table(spark, store.stream, RECORD, mark))


@query
def cycle_verdicts(spark, sf_dir):
    return widened(read_table(spark, _cycled(spark, sf_dir, "classifier").verdicts, VERDICT))


@query
def rmse_cycle(spark, sf_dir):
    """History after a cycle of the RMSE variant, with the kinds of run that led there."""
    store = _cycled(spark, sf_dir, "regressor")
    log = runs.read_runs(spark, store.runs).groupBy("kind").count().collect()
    kinds = ",".join(sorted(f"{r['kind']}:{r['count']}" for r in log))
    return widened(read_table(spark, store.history, RECORD)).withColumn("kinds", F.lit(kinds))


@query
def rmse_alerts(spark, sf_dir):
    store = _cycled(spark, sf_dir, "regressor")
    found = spark.read.schema(ALERT).parquet(store.alerts)
    return found.select("metric", F.round("baseline", 9).alias("baseline"), F.round("measured", 6).alias("measured"), "message")


# Streams

SPELL_THRESHOLD = 0.01  # small, so that the events have spells


def _messages(spark, sf_dir):
    path = work_path(spark, "messages")
    write_records(fixtures.events(spark, sf_dir), "text", path)
    return read_stream(spark, "text", path)


@query
def stream_ingest(spark, sf_dir):
    """Two deliveries with a restart between them, and a replay of the first batch."""
    store = jobs.Store(work_path(spark, "store"))
    events = fixtures.events(spark, sf_dir)
    path, copy, offsets = (work_path(spark, n) for n in ("messages", "messages", "offsets"))
    first = F.col("label") == 1
    for part in (events.where(first), events.where(~first)):
        write_records(part, "text", path)
        start_ingest(
            read_stream(spark, "text", path),
            store.stream,
            store.rejects,
            offsets,
            trigger={"availableNow": True},
        ).awaitTermination()
    write_records(events.where(first), "text", copy)
    again = spark.read.text(copy).withColumn("_order", F.lit(0))
    ingest_batch(again, 0, store.stream, store.rejects)
    return widened(read_table(spark, store.stream, RECORD))


@query
def consumer_lag(spark, sf_dir):
    """Two consumers of one folder with offsets of their own; the audit stops half-way."""
    events = fixtures.events(spark, sf_dir)
    path = work_path(spark, "messages")
    offsets = {name: work_path(spark, "offsets") for name in ("audit", "store", "late")}
    stores = {name: jobs.Store(work_path(spark, "store")) for name in ("audit", "store")}
    first = F.col("label") == 1
    for part, running in ((events.where(first), ("audit", "store")), (events.where(~first), ("store",))):
        write_records(part, "text", path)
        for name in running:
            start_ingest(
                read_stream(spark, "text", path),
                stores[name].stream,
                stores[name].rejects,
                offsets[name],
                trigger={"availableNow": True},
            ).awaitTermination()
    return lag(spark, path, offsets)


@query
def stream_monitor(spark, sf_dir):
    messages = decode(_messages(spark, sf_dir)).withColumn("score", F.col("feature_0"))
    out = work_path(spark, "monitor")
    start_monitor(
        messages, 0.5, out, work_path(spark, "offsets"), trigger={"availableNow": True}
    ).awaitTermination()
    return spark.read.schema(WINDOW_VERDICT).parquet(out).select(*WINDOW_VERDICT.names)


@query
def monitor_spells(spark, sf_dir):
    """Days with drift as spells; the stream is stopped and started in the middle of the events."""
    events = fixtures.events(spark, sf_dir)
    inbox, out, alerts, offsets = (work_path(spark, n) for n in ("messages", "monitor", "spells", "offsets"))
    half = F.col("timestamp") < F.to_timestamp(F.lit("2024-01-16 12:00:00"))
    for part in (events.where(half), events.where(~half)):
        write_records(part, "text", inbox)
        scored = decode(read_stream(spark, "text", inbox)).withColumn("score", F.col("feature_0"))
        start_monitor(
            scored, 0.5, out, offsets, threshold=SPELL_THRESHOLD, trigger={"availableNow": True}, alerts=alerts
        ).awaitTermination()
    return read_spells(spark, alerts).withColumn("worst", F.round("worst", 9))
