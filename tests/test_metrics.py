import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from driftmon.functions.rules import auc_drift, rmse_drift
from driftmon.operators import metrics
from driftmon.operators.metrics import auc, auc_from_counts, rmse
from driftmon.operators.verdicts import stamp, stamp_by
from driftmon.plans import fixtures
from tests.plans import plan_of


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label double")


def brute(rows):
    pos = [s for s, y in rows if y == 1.0]
    neg = [s for s, y in rows if y == 0.0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from([-1e300, -1.0, -0.0, 0.0, 1e-9, 2.5]), st.sampled_from([0.0, 1.0])),
        min_size=1,
        max_size=40,
    )
)
def test_auc_equals_pair_count(spark, rows):
    got = auc(scored(spark, rows)).first().auc
    want = brute(rows)
    assert got == (pytest.approx(want, abs=1e-12) if want is not None else None)


def test_auc_equals_evaluator(spark, sf_dir):
    df = fixtures.events(spark, sf_dir)
    exact = auc(df, "feature_0").first().auc
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="feature_0", numBins=0)
    assert exact == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    mirrored = auc(df.withColumn("score", -F.col("feature_0"))).first().auc
    assert exact + mirrored == pytest.approx(1.0, abs=1e-12)


def test_auc_does_not_depend_on_partitioning(spark, sf_dir, monkeypatch):
    df = fixtures.events(spark, sf_dir).withColumn("part", F.pmod(F.hash("id"), F.lit(3)))
    want = {r.part: r.auc for r in auc(df, "feature_0", by=["part"]).collect()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, adaptive in (("1", "true"), ("50", "false"), ("50", "true")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            for bits in (20, 3):
                monkeypatch.setattr(metrics, "CHUNK_BITS", bits)
                got = {r.part: r.auc for r in auc(df, "feature_0", by=["part"]).collect()}
                assert got == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_auc_without_a_verdict(spark):
    one_class = auc(scored(spark, [(0.1, 1.0), (0.2, 1.0)])).first()
    assert (one_class.pos, one_class.neg, one_class.auc) == (2, 0, None)
    empty = auc(scored(spark, [(0.1, 1.0)]).where("false")).first()
    assert (empty.pos, empty.neg, empty.dropped, empty.auc) == (0, 0, 0, None)


def test_unusable_rows_are_counted(spark):
    rows = [(0.1, 0.0), (0.9, 1.0), (float("nan"), 1.0), (None, 1.0), (0.5, None)]
    got = auc(scored(spark, rows)).first()
    assert (got.pos, got.neg, got.dropped, got.auc) == (1, 1, 3, 1.0)


def test_auc_of_very_many_rows(spark):
    """Counts whose product is far beyond 64 bits."""
    n = 10**12
    counts = spark.createDataFrame(
        [(0.0, n, 3 * n, 0), (1.0, 3 * n, n, 0)], "score double, pos long, neg long, dropped long"
    )
    assert auc_from_counts(counts).first().auc == 0.75


def test_auc_plan_has_no_single_task_over_scores(spark, sf_dir):
    """Only totals per score range may meet in one task."""
    plan = plan_of(auc(fixtures.events(spark, sf_dir), "feature_0"))
    last_scores = plan.index("rangepartitioning(score")
    assert "SinglePartition" not in plan[:last_scores]
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_rmse_equals_evaluator(spark, sf_dir):
    df = fixtures.events(spark, sf_dir).withColumn("prediction", F.col("feature_0") / 100)
    want = RegressionEvaluator(metricName="rmse").evaluate(df)
    assert rmse(df).first().rmse == pytest.approx(want, abs=1e-9)
    assert rmse(df.where("false")).first().rmse is None


@pytest.mark.parametrize(
    "test,base,want",
    [
        (0.918878, 0.885744, False),  # the published pair
        (0.80, 0.90, True),
        (0.96, 0.90, True),  # an improvement counts too
        (0.9375, 0.9375, False),
        (math.nan, 0.9, None),
        (0.9, math.nan, None),
        (None, 0.9, None),
        (0.9, None, None),
    ],
)
def test_auc_rule(spark, test, base, want):
    df = spark.createDataFrame([(test, base)], "test double, base double")
    assert df.select(auc_drift(F.col("test"), F.col("base")).alias("d")).first().d is want


@pytest.mark.parametrize(
    "test,base,want", [(1.11, 1.0, True), (1.0, 1.0, False), (0.5, 1.0, False), (math.nan, 1.0, None)]
)
def test_rmse_rule(spark, test, base, want):
    df = spark.createDataFrame([(test, base)], "test double, base double")
    assert df.select(rmse_drift(F.col("test"), F.col("base")).alias("d")).first().d is want


def test_stamp(spark):
    row = stamp(spark.range(1), 0.9, None, None).first()
    assert (row.train_auc, row.test_auc, row.drift) == (0.9, None, None)


def test_stamp_by(spark):
    rows = spark.range(50).withColumn("blk", F.col("id") % 5)
    verdicts = spark.range(5).select(F.col("id").alias("blk"), (F.col("id") > 2).alias("drift"))
    got = {r.id: r.drift for r in stamp_by(rows, verdicts, "blk").collect()}
    assert got == {i: i % 5 > 2 for i in range(50)}


def test_rows_of_a_group_stay_where_they_are(spark):
    rows = spark.range(50).withColumn("blk", F.col("id") % 2)
    verdicts = rows.groupBy("blk").agg((F.count("*") > 2).alias("drift"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(stamp_by(rows, verdicts, "blk"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
