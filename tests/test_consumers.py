from pathlib import Path

from driftmon.sources.consumers import committed, lag, seen_files


def drain(spark, inbox, checkpoint, out):
    spark.readStream.text(inbox).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def test_lag_over_folded_notes(spark, folder):
    """A dozen micro-batches, after which the source has folded its notes of ten of them."""
    inbox, checkpoint = Path(folder, "inbox"), f"{folder}/a"
    inbox.mkdir()
    for n in range(12):
        Path(inbox, f"{n} of a dozen.txt").write_text("x\n" * (n + 1))
        drain(spark, str(inbox), checkpoint, f"{folder}/out")
    assert any(p.name.endswith(".compact") for p in Path(checkpoint, "sources/0").iterdir())
    Path(inbox, "later.txt").write_text("y\ny\ny\n")
    got = {r.consumer: (r.messages, r.behind) for r in lag(spark, str(inbox), {"a": checkpoint, "b": f"{folder}/b"}).collect()}
    assert got == {"a": (81, 3), "b": (81, 81)}


def test_an_unfinished_batch_is_still_to_read(spark, folder):
    """The source has noted the files of a batch whose commit is missing."""
    inbox, checkpoint = Path(folder, "inbox"), f"{folder}/a"
    inbox.mkdir()
    for n in range(2):
        Path(inbox, f"{n}.txt").write_text("x\n" * (n + 1))
        drain(spark, str(inbox), checkpoint, f"{folder}/out")
    last = max(int(p.name) for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit())
    Path(checkpoint, "commits", str(last)).unlink()
    assert committed(spark, checkpoint) == 0
    assert [Path(r.path).name for r in seen_files(spark, checkpoint).collect()] == ["0.txt"]
    assert lag(spark, str(inbox), {"a": checkpoint}).first().behind == 2
