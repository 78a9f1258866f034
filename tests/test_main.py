"""The jobs end to end: files in, records streamed, model trained, verdicts out."""

from pathlib import Path

from pyspark.sql import functions as F

from driftmon.__main__ import main
from driftmon.plans import fixtures, jobs, runs
from driftmon.schemas import RECORD, VERDICT
from driftmon.sources.keyed import read_table


def test_jobs(spark, folder, sf_dir):
    store = jobs.Store(f"{folder}/store")
    sea = fixtures.sea(spark, sf_dir).withColumn("label", F.col("clean"))
    history = sea.where("blk = 1").select(*RECORD.names)
    history.write.csv(f"{folder}/csv", header=True)
    Path(folder, "extra").mkdir()
    broken = '{"id":"n","timestamp":"2024-04-12T00:00:00.000000","feature_0":1.0,"label":1.0}'
    Path(folder, "extra", "a.txt").write_text(broken + "\n")
    lines = [
        f"{r.feature_0},{r.feature_1},{r.feature_2},{r.label}"
        for r in sea.where("blk = 4").limit(400).collect()
    ]
    Path(folder, "sea_tst1.arff").write_text("@relation sea\n@data\n" + "\n".join(lines) + "\n")

    def job(name, **options):
        args = [name, "--root", store.root, "--database", "drift_jobs"]
        for k, v in options.items():
            args += [f"--{k}"] if v is True else [f"--{k}", str(v)]
        main(args)

    job("load", source=f"{folder}/csv")
    assert read_table(spark, store.history, RECORD).count() == history.count()
    job("produce", source=folder, cursor=0, size=300)
    job("stream", source=store.path("messages"), once=True)
    Path(folder, "sea_tst2.arff").write_text("@data\n" + "\n".join(lines[300:]) + "\n")
    for _ in range(3):  # slices of a stream that keeps the cursor; the third is past the end
        job("produce", source=folder, drift=2, size=60, every="1 second", once=True)
    job("stream", source=store.path("messages"), once=True)
    assert read_table(spark, store.stream, RECORD).count() == 400
    job("train")
    job("test")
    verdicts = read_table(spark, store.verdicts, VERDICT)
    assert verdicts.count() == 400
    assert verdicts.select("drift").distinct().count() == 1
    assert spark.table("drift_jobs.dataframe_train_latest").count() == history.count()
    assert spark.table("drift_jobs.drift_analysis_latest").count() == 400
    # A record with a missing feature is put aside, and the monitor goes on.
    job("monitor", source=f"{folder}/extra", once=True)
    assert spark.read.parquet(store.path("unscored")).count() == 1
    job("cycle")
    assert read_table(spark, store.history, RECORD).count() == history.count() + 400
    log = runs.read_runs(spark, store.runs)
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert kinds == {"train": 2, "test": 4, "promote": 1}
    job("train", kind="regressor")
    job("test", kind="regressor")  # everything was promoted: nothing to test
    log = runs.read_runs(spark, store.runs)
    assert log.where("kind = 'train' and rmse is not null").count() == 1
    assert log.where("kind = 'test'").count() == 4
