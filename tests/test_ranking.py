import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftmon.operators import ranking
from driftmon.operators.ranking import row_numbers


@pytest.fixture(params=[20, 4])
def many_chunks(spark, monkeypatch, request):
    """Keep small partitions apart, and cut them, so that groups span several chunks."""
    monkeypatch.setattr(ranking, "CHUNK_BITS", request.param)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_hot_group(spark, many_chunks):
    """One user holds most rows and spans partitions; null is a group as well."""
    user = F.when(F.col("id") % 10 < 6, 7).when(F.col("id") % 10 == 6, None).otherwise(F.col("id") % 50)
    df = spark.range(5000).select("id", user.alias("user"), (F.col("id") * 37 % 1009).alias("t"))
    got = row_numbers(df, [F.desc("t"), "id"], by=["user"])
    want = F.row_number().over(Window.partitionBy("user").orderBy(F.desc("t"), "id"))
    assert got.columns == ["id", "user", "t", "row_num"]
    assert got.withColumn("want", want).where("row_num <> want").count() == 0
    assert got.count() == 5000


def test_whole_table(spark, many_chunks):
    df = spark.range(3000).select("id", (F.col("id") * 37 % 101).alias("t"))
    got = row_numbers(df, ["t", "id"])
    want = F.row_number().over(Window.orderBy("t", "id"))
    assert got.withColumn("want", want).where("row_num <> want").count() == 0


def test_empty(spark):
    assert row_numbers(spark.range(0), ["id"]).count() == 0
