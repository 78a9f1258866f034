import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from driftmon.functions.codec import (
    decode,
    encode,
    is_uuid,
    iso_text,
    random_id,
    round_number,
    split_rejects,
    to_store,
    uuid_from,
)
from driftmon.schemas import RECORD

GOOD = (
    '{"id":"a","timestamp":"2024-04-12T10:39:18.045678","feature_0":4.007,'
    '"feature_1":6.126,"feature_2":6.417,"label":1.0}'
)


def decoded(spark, value):
    return decode(spark.createDataFrame([(value,)], "value string")).first()


def test_well_formed(spark):
    row = decoded(spark, GOOD)
    assert row.timestamp == dt.datetime(2024, 4, 12, 10, 39, 18, 45678)
    assert row.feature_0 == pytest.approx(4.007)
    assert row.label == 1.0


@pytest.mark.parametrize("value", ["{bad", '[{"id":"e"}]', "", None, GOOD[:-5]])
def test_malformed_gives_nulls(spark, value):
    assert all(v is None for v in decoded(spark, value))


def test_missing_and_extra_fields(spark):
    row = decoded(spark, '{"id":"b","other":5}')
    assert row.id == "b"
    assert [v for v in row if v is not None] == ["b"]


def test_bad_field_alone_is_null(spark):
    bad_time = decoded(spark, GOOD.replace("2024-04-12T10", "yesterday"))
    assert bad_time.timestamp is None
    assert bad_time.id == "a"
    text_number = decoded(spark, GOOD.replace("4.007", '"1.5"'))
    assert text_number.feature_0 is None
    assert text_number.label == 1.0
    assert math.isnan(decoded(spark, GOOD.replace("4.007", '"NaN"')).feature_0)


def test_rejects_are_the_rows_without_a_key(spark):
    values = [(GOOD,), ("{bad",), ('{"id":"b"}',), (None,)]
    good, bad = split_rejects(decode(spark.createDataFrame(values, "value string")))
    assert good.count() == 1
    assert bad.count() == 3


def test_encode_decode_round_trip(spark):
    first = decode(spark.createDataFrame([(GOOD,)], "value string"))
    again = decode(encode(first).select(F.col("value").cast("binary")))
    assert again.first() == first.first()


def test_iso_keeps_six_digits(spark):
    row = spark.range(1).select(iso_text(F.timestamp_micros(F.lit(45000))).alias("t")).first()
    assert row.t == "1970-01-01T00:00:00.045000"


def test_round_number(spark):
    df = spark.createDataFrame([("1.0005",), ("2.6755",), ("x",), (None,)], "v string")
    got = [r.v for r in df.select(round_number("v").alias("v")).collect()]
    assert got == [1.001, 2.676, None, None]


def test_ids(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int")
    once = df.select(uuid_from("x", "y").alias("id"), is_uuid("id").alias("ok"))
    assert [r.id for r in once.collect()] == [r.id for r in once.collect()]
    assert all(r.ok for r in once.collect())
    drawn = df.select(random_id().alias("id")).select(is_uuid("id").alias("ok"), "id").collect()
    assert all(r.ok for r in drawn)
    assert len({r.id for r in drawn}) == 2


def test_store_types(spark):
    stored = to_store(decode(spark.createDataFrame([(GOOD,)], "value string")), RECORD)
    assert stored.schema.simpleString() == RECORD.simpleString()
    assert stored.first().timestamp == dt.datetime(2024, 4, 12, 10, 39, 18, 45000)
