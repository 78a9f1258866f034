import datetime as dt
from glob import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from driftmon import storage
from driftmon.functions.codec import to_store
from driftmon.plans import fixtures, jobs, models, runs
from driftmon.schemas import RECORD, RUN, VERDICT
from driftmon.session import discard, work_path, work_root, written
from driftmon.sources import keyed
from driftmon.sources.keyed import read_table, write_batch
from tests.plans import plan_of


@pytest.fixture(scope="module")
def sea(spark, sf_dir):
    """Points with noise-free labels."""
    df = fixtures.sea(spark, sf_dir).withColumn("label", F.col("clean"))
    return written(df.select(*RECORD.names, "blk"), "sea")


@pytest.fixture(scope="module")
def trained(spark, sea):
    """A classifier run on the first block."""
    return jobs.train(spark, sea.where("blk = 1"), jobs.Store(work_path(spark, "trained")))


@pytest.fixture
def store(folder):
    return jobs.Store(folder)


def test_train_and_test_by_block(spark, sea, store, trained):
    run = trained
    assert run["auc"] > 0.98
    same = jobs.test(spark, sea.where("blk = 1"), run, store, 0)
    moved = jobs.test(spark, sea.where("blk = 4"), run, store, 1)
    assert not same["drift"]
    assert moved["drift"]
    rows = read_table(spark, store.verdicts, VERDICT)
    assert rows.count() == sea.where("blk in (1, 4)").count()
    assert rows.where("drift").count() == sea.where("blk = 4").count()
    alert = spark.read.parquet(store.alerts).collect()
    assert [a.run_id for a in alert] == [moved["run_id"]]
    assert (alert[0].metric, alert[0].measured) == ("auc", moved["auc"])


def test_training_is_repeatable(spark, sea, store, trained):
    again = jobs.train(spark, sea.where("blk = 1"), store)
    assert again["auc"] == pytest.approx(trained["auc"], abs=1e-6)


def test_retest_replaces_the_verdict(spark, sea, store, trained):
    part = sea.where("blk = 4")
    jobs.test(spark, part, trained, store, 0)
    jobs.test(spark, part, trained | {"auc": 0.9}, store, 1)
    rows = read_table(spark, store.verdicts, VERDICT)
    assert rows.count() == part.count()
    assert rows.where("drift").isEmpty()


def test_no_verdict(spark, sea, store, trained):
    empty = jobs.test(spark, sea.where("false"), trained, store, 0)
    assert (empty["auc"], empty["drift"]) == (None, None)
    nan = jobs.test(spark, sea.where("blk = 4"), trained | {"auc": float("nan")}, store, 1)
    assert nan["drift"] is None
    assert nan["note"]


def test_missing_labels_are_counted(spark, sea, store, trained):
    label = F.when(F.col("feature_2") > 2, F.col("label"))
    part = sea.where("blk = 1").withColumn("label", label)
    run = jobs.test(spark, part, trained, store, 0)
    missing = part.where("label is null").count()
    assert run["note"] == f"{missing} rows without a label were not measured"
    assert read_table(spark, store.verdicts, VERDICT).count() == part.count()


def test_work_tables_are_removed(spark, sea, store, trained):
    jobs.test(spark, sea.where("blk = 1"), trained, store, 0)
    left = glob(f"{work_root(spark)}/driftmon/scored-*")
    with pytest.raises(ValueError, match="not a work table"):
        discard(spark, store.verdicts)
    jobs.test(spark, sea.where("blk = 1"), trained, store, 1)
    assert glob(f"{work_root(spark)}/driftmon/scored-*") == left


def test_null_features(spark, sea, trained):
    part = sea.where("blk = 1").withColumn("feature_1", F.when(F.col("feature_2") > 2, F.col("feature_1")))
    model = models.load(trained["artifact_uri"])
    with pytest.raises(Exception, match="null"):
        models.score(model, part).write.format("noop").mode("overwrite").save()
    model.stages[0].setHandleInvalid("skip")
    assert models.score(model, part).count() == part.where("feature_2 > 2").count()


def test_labels_must_be_zero_or_one(spark, sea):
    with pytest.raises(Exception, match="[Ll]abel"):
        models.fit(sea.where("blk = 1").withColumn("label", F.col("label") * 3))


def test_single_class_history_is_noted(spark, sea, store):
    run = jobs.train(spark, sea.where("blk = 1 and label = 1"), store)
    assert run["auc"] is None
    assert run["note"]


def test_rmse_variant_stores_rows_only_on_drift(spark, sea, store, folder):
    run = jobs.train(spark, sea.where("blk = 1"), store, kind="regressor")
    out = f"{folder}/rows"
    assert not storage.exists(spark, store.alerts)
    assert jobs.test_rmse(spark, sea.where("blk = 4"), run, store, out, 2.0)["drift"]
    stored = spark.read.parquet(out)
    assert stored.count() == sea.where("blk = 4").count()
    assert not jobs.test_rmse(spark, sea.where("blk = 1"), run, store, out, 2.0)["drift"]
    assert spark.read.parquet(out).count() == stored.count()
    assert stored.select("test_timestamp").distinct().count() == 1
    (alert,) = spark.read.parquet(store.alerts).collect()
    assert (alert.metric, alert.baseline) == ("rmse", run["rmse"])


def test_rmse_notes(spark, sea, store):
    part = sea.where("blk = 1")
    run = jobs.train(spark, part, store, kind="regressor")
    label = F.when(F.col("feature_2") > 2, F.col("label"))
    feature = F.when(F.col("feature_2") < 8, F.col("feature_0"))
    dirty = part.withColumn("label", label).withColumn("feature_0", feature)
    tested = jobs.test_rmse(spark, dirty, run, store)
    unlabelled = dirty.where("label is null and feature_0 is not null").count()
    incomplete = dirty.where("feature_0 is null").count()
    assert tested["note"] == (
        f"{unlabelled} rows without a label were not measured; "
        f"{incomplete} rows with a missing feature were not scored"
    )
    none = jobs.test_rmse(spark, part.where("false"), run, store)
    assert none["note"] == "no verdict: a metric is missing"


def test_training_counts_what_it_leaves_out(spark, sea, store):
    label = F.when(F.col("feature_2") > 1, F.col("label"))
    part = sea.where("blk = 1").withColumn("label", label)
    before = set(glob(f"{work_root(spark)}/driftmon/history-*"))  # the folder may be shared with other runs
    run = jobs.train(spark, part, store)
    assert run["note"] == f"{part.where('label is null').count()} rows without a label were not used"
    assert set(glob(f"{work_root(spark)}/driftmon/history-*")) <= before


def test_rmse_cycle(spark, sea, store):
    records = sea.select(*RECORD.names)
    write_batch(records.where(sea.blk == 1), store.history, 0, RECORD)
    assert jobs.run_cycle(spark, store, "regressor")["kind"] == "train"  # no stream yet
    write_batch(records.where(sea.blk == 4), store.stream, 0, RECORD)
    assert jobs.run_cycle(spark, store, "regressor")["promoted_up_to"] == 0
    assert spark.read.parquet(store.drifted).count() == 3 * sea.where("blk = 4").count()
    assert read_table(spark, store.history, RECORD).count() == sea.where("blk in (1, 4)").count()


def test_load_keeps_lines_without_a_key(spark, store, folder):
    Path(folder, "h.csv").write_text(
        "id,timestamp,feature_0,feature_1,feature_2,label\n"
        "a,2024-04-12 10:39:18.045,4.0,6.1,6.4,1\n"
        "b,never,x,6.1,6.4,0\n"
        ",2024-04-12 10:39:18.045,1.0,2.0,3.0,0\n"
    )
    jobs.load_history(spark, f"{folder}/h.csv", store)
    assert [r.id for r in read_table(spark, store.history, RECORD).collect()] == ["a"]
    raw = sorted(r.raw for r in spark.read.parquet(store.rejects).collect())
    assert len(raw) == 2
    assert raw[1] == "b,never,x,6.1,6.4,0"


def test_cycle(spark, sea, store):
    records = sea.select(*RECORD.names)
    write_batch(records.where(sea.blk == 1), store.history, 0, RECORD)
    write_batch(records.where(sea.blk == 3), store.stream, 0, RECORD)
    write_batch(records.where(sea.blk == 4), store.stream, 1, RECORD)
    done = jobs.run_cycle(spark, store)
    assert (done["kind"], done["promoted_up_to"]) == ("promote", 1)
    log = runs.read_runs(spark, store.runs)
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds == {"train": 1, "test": 3, "promote": 1}
    history = read_table(spark, store.history, RECORD)
    assert history.count() == sea.where("blk in (1, 3, 4)").count()
    # Nothing arrived since: the next cycle trains on the longer history and stops.
    again = jobs.run_cycle(spark, store)
    assert again["kind"] == "train"
    write_batch(records.where(sea.blk == 2), store.stream, 2, RECORD)
    assert jobs.run_cycle(spark, store)["promoted_up_to"] == 2
    assert read_table(spark, store.history, RECORD).count() == sea.count()


def test_streamed_batches_are_merged_once(spark, sea, store, monkeypatch):
    """Counting, scoring and promoting read the written rows; the stream table is read once."""
    records = sea.select(*RECORD.names)
    write_batch(records.where(sea.blk == 1), store.history, 0, RECORD)
    write_batch(records.where(sea.blk == 4).withColumn("label", F.lit(0.0)), store.stream, 0, RECORD)
    write_batch(records.where(sea.blk == 4), store.stream, 1, RECORD)
    seen, score, read = [], jobs._scored, keyed.read_table

    def scored(spark, table, baseline):
        seen.append(plan_of(table))
        return score(spark, table, baseline)

    def from_history(spark, path, *args, **kwargs):
        assert path != store.stream
        return read(spark, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "_scored", scored)
    monkeypatch.setattr(keyed, "read_table", from_history)
    assert jobs.run_cycle(spark, store, "regressor")["promoted_up_to"] == 1
    assert len(seen) == 1
    assert "Aggregate" not in seen[0]
    got = read_table(spark, store.history, RECORD)
    want = to_store(records.where(sea.blk.isin(1, 4)), RECORD)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert not [n for n in storage.names(spark, f"{work_root(spark)}/driftmon") if n.startswith("streamed")]


@pytest.mark.parametrize("by", ["label", 3, None])
def test_spread(spark, sea, by):
    assert models.spread(sea, by).count() == sea.count()


def test_models_score_a_stream(spark, sea, folder, trained):
    to_store(sea, RECORD).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(RECORD).parquet(f"{folder}/in")
    query = (
        models.score(models.load(trained["artifact_uri"]), stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/offsets")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination(120)
    assert spark.read.parquet(f"{folder}/out").count() == sea.count()


def log_rows(spark):
    def run(run_id, hour, auc, status="FINISHED"):
        fields = dict.fromkeys(RUN.names) | {
            "run_id": run_id,
            "kind": "train",
            "start_time": dt.datetime(2024, 1, 1, hour),
            "status": status,
            "auc": auc,
        }
        return tuple(fields.values())

    rows = [
        run("a", 1, 0.8),
        run("b", 2, 0.81),
        run("c", 2, 0.82),
        run("d", 3, float("nan")),
        run("e", 4, None, "FAILED"),
    ]
    return spark.createDataFrame(rows, RUN)


def test_latest_runs(spark):
    log = log_rows(spark)
    assert runs.latest_run(log).first().run_id == "e"
    assert runs.latest_usable_run(log).first().run_id == "c"
    with pytest.raises(ValueError, match="no usable run"):
        runs.require(runs.latest_usable_run(log.where("auc is null")), "usable run")


def test_gate(spark):
    log = log_rows(spark)
    assert runs.distinct_stamps(log).first().runs == 4
    assert runs.gate(log).first().ready
    assert not runs.gate(log.where("run_id in ('b', 'c', 'd')")).first().ready


def test_a_job_tried_again_adds_nothing(spark, sea, store):
    run = jobs.train(spark, sea.where("blk = 1"), store, kind="regressor")
    for _ in range(2):
        jobs.test_rmse(spark, sea.where("blk = 4"), run, store, factor=0.0, run_id="once")
    assert spark.read.parquet(store.drifted).count() == sea.where("blk = 4").count()
    assert spark.read.parquet(store.alerts).count() == 1
    assert runs.read_runs(spark, store.runs).where("kind = 'test'").count() == 1


def test_a_commit_that_died_is_not_seen(spark, folder):
    rows = spark.range(3).toDF("n")
    rows.write.parquet(f"{folder}/t.staged/left-behind")
    assert runs.commit(rows, f"{folder}/t", "a") and not runs.commit(rows, f"{folder}/t", "a")
    assert runs.commit(rows, f"{folder}/t", "b")
    assert runs.committed(spark, f"{folder}/t", rows.schema).count() == 6


def test_classes_are_dealt_over_all_partitions(spark):
    """Equal rows as well; a column alone puts a class in one partition."""
    rows = spark.range(4000, numPartitions=3).selectExpr("cast(id % 4 = 0 as double) as label", "1.0 as x")
    dealt = models.spread(rows, ("label", 5))
    assert dealt.columns == rows.columns and dealt.rdd.getNumPartitions() == 5
    found = dealt.groupBy("label", F.spark_partition_id().alias("part")).count().collect()
    assert len(found) == 10 and sum(r["count"] for r in found) == 4000
    assert all(abs(r["count"] - (200 if r.label else 600)) < 5 * 600**0.5 for r in found)
    alone = models.spread(rows, "label").select("label", F.spark_partition_id()).distinct()
    assert alone.count() == 2
