import re

import pytest
from pyspark.sql import functions as F

from driftmon import storage
from driftmon.schemas import RECORD, STREAM_TABLE
from driftmon.sources import keyed, settled
from driftmon.sources.keyed import BATCH, compact, create_views, read_table, reclaim, write_batch
from tests.plans import plan_of

SCHEMA = RECORD


def batch(spark, n, ids, path):
    rows = spark.range(1).select(F.explode(F.array(*map(F.lit, ids))).alias("n")).select(
        F.col("n").cast("string").alias("id"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("timestamp"),
        *[F.lit(float(n)).alias(c) for c in RECORD.names[2:]],
    )
    write_batch(rows, path, n, SCHEMA, settled=True)


def newest(df):
    return {r["id"]: int(r["label"]) for r in df.collect()}


@pytest.fixture
def stored(spark, folder):
    """Batches 0 to 3; batch n holds the ids n to n + 4."""
    path = f"{folder}/t"
    for n in range(4):
        batch(spark, n, range(n, n + 5), path)
    return path


def test_reads_agree_before_and_after_compaction(spark, stored):
    bounds = [(None, None), (None, 3), (1, None), (2, 3), (0, 2), (None, 1), (3, None)]
    before = [newest(read_table(spark, stored, SCHEMA, a, u)) for a, u in bounds]
    entry = compact(spark, stored, SCHEMA, buckets=3)
    assert (entry["folded"], entry["buckets"]) == (2, 3)
    assert [newest(read_table(spark, stored, SCHEMA, a, u)) for a, u in bounds] == before
    batch(spark, 4, [0, 7, 20], stored)
    assert newest(read_table(spark, stored, SCHEMA)) == before[0] | {"0": 4, "7": 4, "20": 4}
    assert compact(spark, stored, SCHEMA)["folded"] == 3
    assert newest(read_table(spark, stored, SCHEMA)) == before[0] | {"0": 4, "7": 4, "20": 4}
    assert compact(spark, stored, SCHEMA)["version"] == 1  # nothing left to fold


def test_newest_batch_may_be_replayed_and_a_folded_one_not(spark, stored):
    compact(spark, stored, SCHEMA)
    batch(spark, 3, [100], stored)
    assert newest(read_table(spark, stored, SCHEMA))["100"] == 3
    with pytest.raises(ValueError, match="folded"):
        batch(spark, 2, [1], stored)


def test_base_is_merged_where_it_lies(spark, stored):
    compact(spark, stored, SCHEMA, buckets=5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(read_table(spark, stored, SCHEMA))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The children of the join: the base comes to it without an exchange, the tail with one.
    tree = plan.split("\n\n")[0]
    lines = tree.splitlines()
    (join,) = [i for i, x in enumerate(lines) if "SortMergeJoin" in x]
    depth = lines[join].index("SortMergeJoin")
    sides = [i for i, x in enumerate(lines) if i > join and re.search(r"[:+]- ", x) and x.index("- ") < depth + 3]
    left = lines[join + 1 : sides[1] if len(sides) > 1 else None]
    assert any("Scan parquet" in x for x in left)
    assert not any("Exchange" in x for x in left)
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 5 out of 5" in plan


def test_buckets_grow_with_the_table(spark, stored, monkeypatch):
    want = newest(read_table(spark, stored, SCHEMA))
    one = storage.size(spark, f"{stored}/{BATCH}=0")
    monkeypatch.setattr(settled, "BUCKET_BYTES", one // 2)
    entry = compact(spark, stored, SCHEMA, buckets=1)
    assert entry["buckets"] >= 7
    assert newest(read_table(spark, stored, SCHEMA)) == want
    reclaim(spark, stored, 2)  # the rows are in the base alone now
    monkeypatch.setattr(settled, "BUCKET_BYTES", one // 20)
    held = storage.size(spark, entry["base"])
    assert compact(spark, stored, SCHEMA, up_to=3)["buckets"] >= held // (one // 20)
    assert newest(read_table(spark, stored, SCHEMA)) == want


def test_many_rows_since_the_base_are_dealt_over_more_tasks(spark, stored, monkeypatch):
    want = newest(read_table(spark, stored, SCHEMA))
    compact(spark, stored, SCHEMA, up_to=0, buckets=1)
    late = sum(storage.size(spark, f"{stored}/{BATCH}={n}") for n in (1, 2, 3))
    monkeypatch.setattr(settled, "BUCKET_BYTES", late // 5)
    table = read_table(spark, stored, SCHEMA)
    assert re.search(r"hashpartitioning\(id#\d+, timestamp#\d+, [56]\), REPARTITION_BY_NUM", plan_of(table))
    assert newest(table) == want


def test_another_session_finds_the_base(spark, stored):
    entry = compact(spark, stored, SCHEMA)
    want = newest(read_table(spark, stored, SCHEMA))
    spark.sql(f"DROP TABLE {settled.settled_name(spark, stored, entry)}")  # as a new catalog has it
    assert newest(read_table(spark, stored, SCHEMA)) == want


def test_half_written_manifest_is_passed_over(spark, stored):
    entry = compact(spark, stored, SCHEMA)
    storage.write_line(spark, f"{stored}.manifest/{1:012d}", '{"version": 1, "ba')
    assert settled.manifest(spark, stored) == entry
    with pytest.raises(Exception, match="exist"):
        settled.publish(spark, stored, entry | {"version": 1})


def test_reclaimed_batches_are_refused_not_missing(spark, stored):
    want, late = newest(read_table(spark, stored, SCHEMA)), newest(read_table(spark, stored, SCHEMA, 1))
    assert reclaim(spark, stored, 3) == 0  # nothing is folded yet
    compact(spark, stored, SCHEMA)
    assert reclaim(spark, stored, 1) == 2
    assert sorted(storage.names(spark, stored)) == [f"{BATCH}=2", f"{BATCH}=3"]
    assert newest(read_table(spark, stored, SCHEMA)) == want
    assert newest(read_table(spark, stored, SCHEMA, 1)) == late
    with pytest.raises(ValueError, match="reclaimed"):
        read_table(spark, stored, SCHEMA, up_to=1)
    assert newest(read_table(spark, stored, SCHEMA, after=1, up_to=2)) == {str(i): 2 for i in range(2, 7)}
    batch(spark, 4, [50], stored)
    assert compact(spark, stored, SCHEMA)["reclaimed"] == 1
    assert reclaim(spark, stored, 3) == 2
    assert len(storage.names(spark, f"{stored}.base")) == 1
    assert newest(read_table(spark, stored, SCHEMA)) == want | {"50": 4}


def test_rows_below_the_low_mark_leave_the_base(spark, stored):
    want = newest(read_table(spark, stored, SCHEMA, after=1))
    compact(spark, stored, SCHEMA, low=1)
    assert newest(read_table(spark, stored, SCHEMA, after=1)) == want
    with pytest.raises(ValueError, match="left"):
        read_table(spark, stored, SCHEMA)


def test_keyless_rows_are_not_folded(spark, folder):
    path = f"{folder}/t"
    rows = spark.createDataFrame([(None, None, 1.0, 1.0, 1.0, 1.0)], SCHEMA)
    write_batch(rows, path, 0, SCHEMA, settled=True)
    with pytest.raises(ValueError, match="key"):
        compact(spark, path, SCHEMA, up_to=0)
    assert settled.manifest(spark, path) is None


def test_nothing_to_compact(spark, folder):
    assert compact(spark, f"{folder}/none", SCHEMA) is None
    assert reclaim(spark, f"{folder}/none", 5) == 0


def test_view_follows_the_mark_and_the_base(spark, folder):
    from driftmon.plans import jobs

    store, path = jobs.Store(folder), f"{folder}/{STREAM_TABLE}"
    for n in range(3):
        batch(spark, n, range(n, n + 3), path)
    create_views(spark, folder, "drift_marks")
    view = f"drift_marks.{STREAM_TABLE}_latest"
    assert newest(spark.table(view)) == {"0": 0, "1": 1, "2": 2, "3": 2, "4": 2}
    jobs.promote_and_clear(spark, store, up_to=0, after=None)
    assert newest(spark.table(view)) == {"1": 1, "2": 2, "3": 2, "4": 2}
    compact(spark, path, SCHEMA)
    batch(spark, 3, [1, 9], path)
    create_views(spark, folder, "drift_marks")
    assert newest(spark.table(view)) == {"1": 3, "2": 2, "3": 2, "4": 2, "9": 3}
    jobs.promote_and_clear(spark, store, up_to=2, after=0)
    assert newest(spark.table(view)) == {"1": 3, "9": 3}
    spark.sql("DROP DATABASE drift_marks CASCADE")


def test_unfinished_batches_do_not_show(spark, folder):
    path = f"{folder}/{STREAM_TABLE}"
    batch(spark, 0, [1], path)
    batch(spark, 1, [2], path)
    create_views(spark, folder, "drift_open")
    storage.delete(spark, f"{path}/{BATCH}=1/_SUCCESS")
    create_views(spark, folder, "drift_open")
    assert keyed.finished_batches(spark, path) == [0]
    assert newest(spark.table(f"drift_open.{STREAM_TABLE}_latest")) == {"1": 0}
    spark.sql("DROP DATABASE drift_open CASCADE")
