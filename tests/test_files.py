import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from driftmon.sources.files import (
    drift_path,
    index_arff,
    read_arff,
    read_csv,
    start_slices,
    take_slice,
)
from tests.plans import plan_of


def test_arff_places_lines_across_splits(spark, folder):
    lines = ["% comment", "@relation sea", "@attribute a numeric", "", "@DATA"]
    for i in range(500):
        lines += [f"{i}.0004, 2.5 ,3,{i % 2}", "% between" if i % 7 == 0 else ""]
    Path(folder, "part-0.arff").write_text("\n".join(lines[:600]) + "\n")
    Path(folder, "part-1.arff").write_text("\n".join(lines[600:]) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "700b")
    try:
        rows = sorted(read_arff(spark, folder).collect())
    finally:
        spark.conf.set(key, old)
    assert [r.idx for r in rows] == list(range(500))
    assert [r.feature_0 for r in rows] == [float(f"{i}.0004") for i in range(500)]
    assert rows[3].label == 1.0


def test_arff_missing_value_is_null(spark, folder):
    Path(folder, "a.arff").write_text("@data\n1,?,3\n")
    row = read_arff(spark, f"{folder}/a.arff").first()
    assert (row.feature_0, row.feature_1, row.feature_2, row.label) == (1.0, None, 3.0, None)


def test_slices(spark, folder):
    Path(folder, "sea_tst2.arff").write_text("@data\n" + "".join(f"{i},0,0,1\n" for i in range(25)))
    rows = read_arff(spark, drift_path(folder, 2))
    assert [r.idx for r in take_slice(rows, 0, 1).collect()] == [0]
    assert sorted(r.idx for r in take_slice(rows, 10).collect()) == list(range(10, 20))
    assert sorted(r.idx for r in take_slice(rows, 20).collect()) == [20, 21, 22, 23, 24]
    assert take_slice(rows, 25).isEmpty()


def test_slices_are_streamed_from_where_they_stopped(spark, folder):
    """With another size after the restart, a slice that fails once, and starts past the end."""
    Path(folder, "sea_tst1.arff").write_text("@data\n" + "".join(f"{i},0,0,1\n" for i in range(25)))
    rows = index_arff(spark, drift_path(folder, 1), f"{folder}/indexed")
    sent, broken = [], [True]

    def send(part, n):
        if n == 1 and broken:
            broken.clear()
            raise ValueError("the broker is away")
        sent.append((n, sorted(r.idx for r in part.collect())))

    def start(size):
        query = start_slices(rows, size, send, f"{folder}/cursor", {"availableNow": True})
        query.awaitTermination()

    start(10)
    with pytest.raises(StreamingQueryException):
        start(10)
    for size in (4, 4, 4):  # the first sends the failed slice again, then its own
        start(size)
    assert [s for s in sent if s[1]] == [(0, [*range(10)]), (1, [*range(10, 20)]), (2, [*range(20, 24)]), (3, [24])]
    assert len(sent) == 4


def test_a_slice_reads_by_place(spark, folder):
    Path(folder, "a.arff").write_text("@data\n1,2,3,0\n")
    rows = index_arff(spark, f"{folder}/a.arff", f"{folder}/indexed")
    assert "PushedFilters: [IsNotNull(idx), GreaterThanOrEqual(idx,5), LessThan(idx,7)]" in plan_of(take_slice(rows, 5, 2))


def test_unknown_drift_type(folder):
    with pytest.raises(ValueError, match="unknown drift type 5"):
        drift_path(folder, 5)


def test_csv_history(spark, folder):
    Path(folder, "training.csv").write_text(
        "id,timestamp,feature_0,feature_1,feature_2,label\n"
        "a,2024-04-12 10:39:18.045,4.007,6.126,6.417,1\n"
        "b,never,x,6.1,6.4,0\n"
    )
    good, bad = sorted(read_csv(spark, f"{folder}/training.csv").collect())
    assert good.timestamp == dt.datetime(2024, 4, 12, 10, 39, 18, 45000)
    assert good.label == 1.0
    assert (bad.timestamp, bad.feature_0, bad.label) == (None, None, 0.0)
