import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftmon.operators import selection
from driftmon.operators.selection import cut_at_ranks, extent
from driftmon.operators.split import block_cuts, block_number, chrono_split, split_rank, train_part
from driftmon.plans import fixtures
from tests.plans import plan_of


@pytest.fixture
def small_edges(monkeypatch):
    """Make every narrowing pass run on small data."""
    monkeypatch.setattr(selection, "EDGE_ROWS", 2)
    monkeypatch.setattr(selection, "BINS", 4)


def points(spark, rows):
    df = spark.createDataFrame(rows, "t long, id string")
    return df.select(F.timestamp_micros("t").alias("timestamp"), "id")


def literal_split(df, fraction=0.7):
    """The row-number form, on one partition."""
    order = Window.orderBy("timestamp", "id")
    k = int(df.count() * fraction)
    return {r.id for r in df.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).collect()}


def ids(df):
    return {r.id for r in df.collect()}


def test_split_rank_is_a_double_product():
    assert split_rank(90) == 62
    assert split_rank(10_000) == 7000
    assert split_rank(1) == 0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    times=st.lists(st.sampled_from([-7, 0, 1, 2, 3, 10**6, 10**15]), min_size=1, max_size=60),
    width=st.integers(1, 3),
)
def test_split_equals_row_numbers(spark, small_edges, times, width):
    rows = [(t, f"k-{i % 7}{'é' * (i % width)}-{i}") for i, t in enumerate(times)]
    df = points(spark, rows)
    early, late = chrono_split(df)
    assert ids(early) == literal_split(df)
    assert ids(early) | ids(late) == {r[1] for r in rows}
    assert not ids(early) & ids(late)


def test_hot_instant(spark, small_edges):
    """A third of the rows share one time; the cut falls among them."""
    rows = [(i, f"a{i:05d}") for i in range(400)] + [(1000, f"b{i:05d}") for i in range(200)]
    df = points(spark, rows)
    early, late = chrono_split(df)
    assert ids(early) == literal_split(df)
    assert early.count() == 420
    assert late.count() == 180


def test_repeated_key_is_refused(spark, small_edges):
    df = points(spark, [(5, "x")] * 30)
    with pytest.raises(ValueError, match="not unique"):
        chrono_split(df)


def test_keyless_rows_are_in_neither_part(spark):
    df = points(spark, [(i, f"a{i}") for i in range(10)] + [(None, "n"), (3, None)])
    early, late = chrono_split(df)
    assert early.count() == 7
    assert late.count() == 3


def test_tiny_tables(spark):
    one = points(spark, [(1, "a")])
    early, late = chrono_split(one)
    assert early.count() == 0
    assert late.count() == 1
    empty = points(spark, [(1, "a")]).where("false")
    early, late = chrono_split(empty)
    assert early.count() == late.count() == 0


def test_rank_out_of_range(spark):
    with pytest.raises(ValueError, match="outside"):
        cut_at_ranks(points(spark, [(1, "a")]), [2])


@pytest.mark.parametrize("rows", [40, 41, 42, 43])
def test_blocks_equal_ntile(spark, small_edges, rows):
    df = points(spark, [(i // 9, f"a{i:03d}") for i in range(rows)])
    ntile = F.ntile(4).over(Window.orderBy("timestamp", "id"))
    got = df.withColumn("blk", block_number(block_cuts(df, 4))).withColumn("want", ntile)
    assert got.where("blk <> want").count() == 0


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    sea = fixtures.sea_points(spark, sf_dir)
    part = sea.where(train_part(sea)).select("feature_0")
    plan = plan_of(part)
    assert "SinglePartition" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in plan
    assert extent(sea).rows == 6000


def test_both_halves_reach_the_scan(spark, sf_dir):
    early, late = chrono_split(fixtures.sea_points(spark, sf_dir))
    assert "LessThanOrEqual(l_shipdate" in plan_of(early)
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(late)
    assert early.count() + late.count() == 6000
