"""Jobs for spark-submit: stream, produce, load, train, test, cycle, monitor."""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from driftmon import storage
from driftmon.functions.codec import decode, has_key, random_id, round_number
from driftmon.plans import jobs, models, runs
from driftmon.schemas import AUC_THRESHOLD, FEATURES, RECORD
from driftmon.session import pin
from driftmon.sources.files import drift_path, index_arff, start_slices, take_slice
from driftmon.sources.keyed import create_views, last_batch, read_table
from driftmon.sources.streams import TOPIC, kafka_options, read_stream, write_records
from driftmon.streaming.ingest import start_ingest, start_rejects
from driftmon.streaming.monitor import LateRows, start_monitor


def messages(spark, args):
    if args.servers:
        options = kafka_options(args.servers, args.topic, args.per_trigger)
        return read_stream(spark, "kafka", **options)
    options = {"maxFilesPerTrigger": str(args.per_trigger)} if args.per_trigger else {}
    return read_stream(spark, "text", args.source, **options)


def trigger(args):
    return {"availableNow": True} if args.once else None


def stream(spark, args, store):
    start_ingest(
        messages(spark, args),
        store.stream,
        store.rejects,
        store.path("offsets/ingest"),
        trigger=trigger(args),
        uuid_ids=args.uuid_ids,
    ).awaitTermination()
    create_views(spark, store.root, args.database)


def produce(spark, args, store):
    """The next slice of a drift file as records, to the topic or to a folder.

    The file is parsed and numbered once, on the first call. With `--every` a stream sends a
    slice each interval, or one in all with `--once`, and keeps the cursor itself; a slice that
    fails is sent again.
    """
    indexed = store.path(f"indexed/drift-{args.drift}")
    if storage.exists(spark, f"{indexed}/_SUCCESS"):
        rows = spark.read.parquet(indexed)
    else:
        rows = index_arff(spark, drift_path(args.source, args.drift), indexed)

    def send(part, batch_id=None):
        records = part.select(
            random_id().alias("id"),
            F.current_timestamp().alias("timestamp"),
            *[round_number(c).alias(c) for c in [*FEATURES, "label"]],
        )
        if args.servers:
            options = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
            write_records(records, "kafka", **options)
        else:
            write_records(records, "text", store.path("messages"))

    if not args.every:
        return send(take_slice(rows, args.cursor, args.size))
    pace = trigger(args) or {"processingTime": args.every}
    cursor = store.path(f"offsets/produce-{args.drift}")
    start_slices(rows, args.size, send, cursor, pace).awaitTermination()


def load(spark, args, store):
    jobs.load_history(spark, args.source, store)
    create_views(spark, store.root, args.database)


def train(spark, args, store):
    up_to = last_batch(spark, store.history)
    history = read_table(spark, store.history, RECORD, up_to=up_to)
    print(jobs.train(spark, history, store, args.kind))


def baseline(spark, args, store):
    """The newest train run that measured the metric of this kind of model."""
    trained = runs.read_runs(spark, store.runs).where("kind = 'train'")
    usable = runs.latest_usable_run(trained, jobs.METRIC[args.kind])
    return runs.require(usable, "usable train run").asDict()


def test(spark, args, store):
    base = baseline(spark, args, store)
    log = runs.read_runs(spark, store.runs)
    batch = log.where("kind = 'test'").count()
    mark, up_to = jobs.promoted_up_to(log), last_batch(spark, store.stream)
    if up_to is None or (mark is not None and up_to <= mark):
        print("nothing to test")
        return
    table = read_table(spark, store.stream, RECORD, mark, up_to)
    print(jobs.run_test(spark, table, base, store, batch, args.kind))
    create_views(spark, store.root, args.database)


def cycle(spark, args, store):
    print(jobs.run_cycle(spark, store, args.kind))
    create_views(spark, store.root, args.database)


def monitor(spark, args, store):
    """Verdicts by window; records that cannot be scored go to rejects of their own."""
    base = baseline(spark, args, store)
    records = decode(messages(spark, args))
    good = has_key() & models.complete()
    scored = models.score(models.load(base["artifact_uri"]), records.where(good))
    late = LateRows()
    spark.streams.addListener(late)
    rejects = start_rejects(
        records.where(~good),
        store.path("unscored"),
        store.path("offsets/unscored"),
        trigger(args),
    )
    query = start_monitor(
        scored,
        base["auc"],
        store.path("windows"),
        store.path("offsets/monitor"),
        args.width,
        args.late,
        args.threshold,
        trigger(args),
        store.spells,
    )
    query.awaitTermination()
    rejects.awaitTermination() if args.once else rejects.stop()
    print(f"{late.counts.get(query.id, 0)} late rows")
    spark.streams.removeListener(late)


JOBS = {f.__name__: f for f in (stream, produce, load, train, test, cycle, monitor)}


def parse(argv=None):
    parser = argparse.ArgumentParser(prog="driftmon")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="shared folder of tables, runs and models")
    parser.add_argument("--source", help="CSV file, folder of drift files, or message folder")
    parser.add_argument("--servers", help="Kafka bootstrap servers; without it text files are used")
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument(
        "--per-trigger", type=int, help="messages, or files of messages, per micro-batch at most"
    )
    parser.add_argument("--kind", choices=jobs.METRIC, default="classifier")
    parser.add_argument("--uuid-ids", action="store_true", help="reject ids that are no UUID")
    parser.add_argument("--drift", type=int, default=1, help="drift type 1 to 4")
    parser.add_argument("--cursor", type=int, default=0)
    parser.add_argument("--size", type=int, default=1)
    parser.add_argument("--every", help="produce a slice each interval, as in '10 seconds'")
    parser.add_argument("--width", default="1 day", help="monitor window")
    parser.add_argument("--late", default="10 minutes", help="monitor waits so long for records")
    parser.add_argument("--threshold", type=float, default=AUC_THRESHOLD)
    parser.add_argument("--database", default="default")
    parser.add_argument("--once", action="store_true", help="stream what is there, then stop")
    return parser.parse_args(argv)


def main(argv=None):
    args = parse(argv)
    spark = pin(SparkSession.builder.appName(f"driftmon-{args.job}").getOrCreate())
    JOBS[args.job](spark, args, jobs.Store(args.root))


if __name__ == "__main__":
    main()
