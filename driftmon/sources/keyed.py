"""Keyed tables as Parquet batch logs: replayable writes, last write wins on read.

A table is a folder with one `batch_id=N` folder per write. Writing a batch again
replaces its folder, so a replayed batch changes nothing. A later batch wins over an
earlier one. The same key in one batch is settled before the write, so that reading
only has to compare batch numbers; every read does, whatever its bounds.

`compact` folds older batches into a settled base (see `settled`), so that a read merges the
few batches since then with rows that are in place already; `reclaim` removes what is folded.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from driftmon import storage
from driftmon.functions.codec import at_store_precision, to_store
from driftmon.operators.latest import latest_per_key
from driftmon.schemas import HISTORY_TABLE, KEY, RECORD, RUN, STREAM_TABLE, VERDICT, VERDICT_TABLE
from driftmon.sources.settled import base, buckets_for, drop_older, manifest, publish, settled_name, write_base

BATCH = "batch_id"
TABLES = {HISTORY_TABLE: RECORD, STREAM_TABLE: RECORD, VERDICT_TABLE: VERDICT}


def with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BATCH, LongType())])


def newest_first(df: DataFrame, key=KEY) -> DataFrame:
    """Clustering order inside the files: by id, then newest first."""
    return df.sortWithinPartitions(key[0], *[F.desc(c) for c in key[1:]])


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    schema: StructType,
    order=None,
    key=KEY,
    settled: bool = False,
):
    """Store `df` as batch `batch_id`, replacing an earlier try of the same batch.

    `order` names the columns that say which row of a key came last in this batch;
    without it the largest row of a key stays. `settled` says that the rows come from
    a keyed table, so that no key can repeat even at the precision of the store.
    A batch that was folded into the table's base cannot be written again.
    """
    entry = manifest(df.sparkSession, path)
    if entry and batch_id <= entry["folded"]:
        raise ValueError(f"batch {batch_id} of {path} is folded into its base")
    if not settled:
        values = [f.name for f in schema if f.name not in key]
        order = order or values or list(key)
        cols = [f.name for f in schema] + [c for c in order if c not in schema.names]
        # Times that differ below store precision are one key in the store.
        cut = {c: at_store_precision(c) for c in key if c in schema.names and _is_time(schema, c)}
        df = latest_per_key(df.select(*cols).withColumns(cut), key, order)
    out = newest_first(to_store(df, schema), key)
    out.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def _is_time(schema: StructType, name: str) -> bool:
    return schema[name].dataType.typeName() == "timestamp"


def scan_batches(
    spark: SparkSession,
    path: str,
    schema: StructType,
    after: int | None = None,
    up_to: int | None = None,
) -> DataFrame:
    """Every stored version with its batch; the batch bounds prune folders."""
    df = spark.read.schema(with_batch(schema)).parquet(path)
    if after is not None:
        df = df.where(F.col(BATCH) > after)
    if up_to is not None:
        df = df.where(F.col(BATCH) <= up_to)
    return df


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    after: int | None = None,
    up_to: int | None = None,
    key=KEY,
) -> DataFrame:
    """The table as a store would show it: the newest version of every key.

    With a base only the batches since are compared and shuffled; base rows without a newer
    version are taken where they lie. A read that ends before the base does needs the batch
    folders, and is refused once they are reclaimed.
    """
    return _newest(spark, path, schema, after, up_to, key).drop(BATCH)


def _newest(spark: SparkSession, path: str, schema: StructType, after, up_to, key) -> DataFrame:
    """The newest version of every key, with its batch."""
    entry = manifest(spark, path)
    if entry and up_to is not None and up_to < entry["folded"]:
        if entry["reclaimed"] is not None and (after is None or after < entry["reclaimed"]):
            raise ValueError(f"batches of {path} up to {entry['reclaimed']} are reclaimed")
        entry = None
    if entry is None:
        return latest_per_key(scan_batches(spark, path, schema, after, up_to), key, BATCH)
    if entry["low"] is not None and (after is None or after < entry["low"]):
        raise ValueError(f"rows of {path} up to batch {entry['low']} have left its base")
    since = entry["folded"] if after is None else max(after, entry["folded"])
    # Dealt like the base, whatever the session's number of partitions, so that the base stays put;
    # only if far more has come since than that number of tasks should hold, both are dealt anew.
    parts = max(entry["buckets"], buckets_for(spark, _stored(spark, path, since, up_to)))
    dealt = scan_batches(spark, path, schema, since, up_to).repartition(parts, *key)
    tail = latest_per_key(dealt, key, BATCH)
    there = base(spark, path, entry, with_batch(schema), key)
    if after is not None:
        there = there.where(F.col(BATCH) > after)
    return there.join(tail.select(*key), list(key), "left_anti").select(*tail.columns).union(tail)


def _stored(spark: SparkSession, path: str, after: int | None = None, up_to: int | None = None) -> int:
    """Bytes of the finished batches in (after, up_to], by folder sizes only."""
    inside = [
        n
        for n in finished_batches(spark, path)
        if (after is None or n > after) and (up_to is None or n <= up_to)
    ]
    return sum(storage.size(spark, f"{path}/{BATCH}={n}") for n in inside)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    up_to: int | None = None,
    low: int | None = None,
    buckets: int | None = None,
    key=KEY,
) -> dict | None:
    """Fold the finished batches up to `up_to` into a new base; returns the manifest.

    By default all but the newest, which a stream may still replay. Rows whose newest version
    is at or below `low` (a promotion mark that every reader has passed) are left out for good.
    Readers see the old base until the new manifest is there. One compaction at a time: a
    second one fails when it wants to publish. The base gets as many buckets as it had, as
    `buckets` says, or as the table's size asks for, whichever is most: a task holds a bucket.
    """
    entry, newest = manifest(spark, path), last_batch(spark, path)
    if newest is None:
        return entry
    up_to = newest - 1 if up_to is None else min(up_to, newest)
    if up_to < (entry["folded"] + 1 if entry else 0):
        return entry
    floor = low if low is not None else entry["low"] if entry else None
    rows = _newest(spark, path, schema, floor, up_to, key)
    version = entry["version"] + 1 if entry else 0
    held = storage.size(spark, entry["base"]) if entry else 0
    since = _stored(spark, path, entry["folded"] if entry else None)
    floor_buckets = max(buckets or 1, entry["buckets"] if entry else 1)
    buckets = max(floor_buckets, buckets_for(spark, held + since))
    folder = write_base(to_store(rows, with_batch(schema)), path, version, key, buckets)
    reclaimed = entry["reclaimed"] if entry else None
    fields = {"version": version, "base_version": version, "base": folder, "folded": up_to, "low": floor, "reclaimed": reclaimed, "buckets": buckets}
    return publish(spark, path, fields)


def reclaim(spark: SparkSession, path: str, up_to: int) -> int:
    """Remove the folders of batches at or below `up_to`, below which no reader or cycle may be
    any more, and bases older than the newest; only folded batches go. Returns how many went.

    The manifest says so first: a reader that needs them is refused, not given less. Views over
    an older base have to be created again.
    """
    entry = manifest(spark, path)
    if entry is None:
        return 0
    up_to = min(up_to, entry["folded"])
    prefix = f"{BATCH}="
    gone = [n for n in storage.names(spark, path) if n.startswith(prefix) and int(n.removeprefix(prefix)) <= up_to]
    if gone:
        reclaimed = up_to if entry["reclaimed"] is None else max(up_to, entry["reclaimed"])
        publish(spark, path, entry | {"version": entry["version"] + 1, "reclaimed": reclaimed})
        for name in gone:
            storage.delete(spark, f"{path}/{name}")
    drop_older(spark, path, entry["base_version"])
    return len(gone)


def last_batch(spark: SparkSession, path: str) -> int | None:
    """Highest number of a finished batch; None for an empty or missing table.

    Looks at folder names only. A batch counts once its folder has the success marker,
    so a mark never covers rows that are still being written or replaced.
    """
    prefix = f"{BATCH}="
    found = [n for n in storage.names(spark, path) if n.startswith(prefix)]
    numbers = sorted((int(n.removeprefix(prefix)) for n in found), reverse=True)
    return next((n for n in numbers if storage.exists(spark, f"{path}/{prefix}{n}/_SUCCESS")), None)


def promote(
    spark: SparkSession,
    stream_path: str,
    history_path: str,
    schema: StructType,
    up_to: int,
    after: int | None = None,
    key=KEY,
    rows: DataFrame | None = None,
) -> int:
    """Move the stream batches in (after, up_to] into history; returns the new mark. `rows` is
    what `read_table` gave for these bounds, where the caller has it.

    The stream table stays as it is: rows up to the mark are skipped by later reads
    with `after=mark`, so rows that arrive meanwhile are not lost. History batch
    numbers follow the mark, which makes a repeated promotion overwrite itself.
    """
    moved = read_table(spark, stream_path, schema, after, up_to, key) if rows is None else rows
    write_batch(moved, history_path, up_to + 1, schema, key=key, settled=True)
    return up_to


def create_tables(spark: SparkSession, root: str, database: str = "default") -> None:
    """Register the three tables over their folders unless they exist already."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in TABLES.items():
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_batch(schema))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({cols}) USING parquet "
            f"PARTITIONED BY ({BATCH}) LOCATION '{root}/{name}' "
            f"TBLPROPERTIES ('key' = '{','.join(KEY)}', 'clustering' = 'timestamp desc')"
        )


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder has the success marker, by folder names only."""
    prefix = f"{BATCH}="
    found = [int(n.removeprefix(prefix)) for n in storage.names(spark, path) if n.startswith(prefix)]
    return sorted(n for n in found if storage.exists(spark, f"{path}/{prefix}{n}/_SUCCESS"))


def refresh_table(spark: SparkSession, name: str, database: str = "default") -> None:
    """Let the catalog see the finished batches of a table, and no others."""
    table = f"`{database}`.`{name}`"
    (place,) = (r[1] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r[0] == "Location")
    finished = set(finished_batches(spark, place))
    known = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for verb, batches in (("DROP IF EXISTS", known - finished), ("ADD IF NOT EXISTS", finished - known)):
        if batches:
            parts = (f"PARTITION ({BATCH}={n})" for n in sorted(batches))
            spark.sql(f"ALTER TABLE {table} {verb} {(', ' if verb.startswith('DROP') else ' ').join(parts)}")
    spark.sql(f"REFRESH TABLE {table}")


def create_views(spark: SparkSession, root: str, database: str = "default", key=KEY) -> None:
    """Tables in the catalog, up to date, and `<table>_latest`: the newest row of every key.

    The view of the stream table leaves out what was promoted: it looks up the mark in the run
    log whenever it is read, so a promotion shows at once, to every session. Batches written
    since, and a newer base, show after another call.
    """
    create_tables(spark, root, database)
    keep_log(spark, f"{root}/{RUN_LOG}")
    mark = f"(SELECT max(promoted_up_to) FROM parquet.`{root}/{RUN_LOG}`)"
    for name, schema in TABLES.items():
        path = f"{root}/{name}"
        storage.make_folder(spark, path)
        refresh_table(spark, name, database)
        entry = manifest(spark, path)
        shown = f"coalesce({BATCH} > {mark}, true)" if name == STREAM_TABLE else "true"
        since = f"{shown} AND {BATCH} > {entry['folded']}" if entry else shown
        keys = ", ".join(f"`{c}`" for c in key)
        values = ", ".join(f"`{f.name}`" for f in schema if f.name not in key)
        columns = ", ".join(f"`{f.name}`" if f.name in key else f"newest.`{f.name}`" for f in schema)
        newest = (
            f"SELECT {columns} FROM (SELECT {keys}, max_by(struct({values}), {BATCH}) AS newest "
            f"FROM `{database}`.`{name}` WHERE {since} GROUP BY {keys})"
        )
        if entry:
            base(spark, path, entry, with_batch(schema), key)
            plain = ", ".join(f"`{f.name}`" for f in schema)
            on = " AND ".join(f"b.`{c}` = t.`{c}`" for c in key)
            newest = (
                f"SELECT {plain} FROM {settled_name(spark, path, entry)} b LEFT ANTI JOIN "
                f"(SELECT {keys} FROM `{database}`.`{name}` WHERE {since}) t ON {on} WHERE {shown} "
                f"UNION ALL {newest}"
            )
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}_latest` AS {newest}")


RUN_LOG = "runs"


def keep_log(spark: SparkSession, path: str) -> None:
    """A run log without runs, where there is none, so that it can be read."""
    if not storage.exists(spark, path):
        spark.createDataFrame([], RUN).coalesce(1).write.mode("ignore").parquet(f"{path}/run=none")


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse a stream whose batch numbers do not go on from those in the table.

    Batches are numbered by the stream's checkpoint. A new checkpoint counts from 0 again
    and would replace what another has written, or hide behind a promotion mark.
    """
    mine = stream_id(spark, checkpoint)
    owner = storage.read_line(spark, f"{path}.stream")
    held = any(n.startswith(f"{BATCH}=") for n in storage.names(spark, path))
    if held and (mine is None or (owner is not None and owner != mine)):
        raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")


def own(spark: SparkSession, path: str, query_id: str) -> None:
    """From now on the table belongs to this stream."""
    storage.write_line(spark, f"{path}.stream", query_id)


def stream_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The lasting id of the stream that a checkpoint belongs to."""
    line = storage.read_line(spark, f"{checkpoint}/metadata")
    return json.loads(line)["id"] if line else None
