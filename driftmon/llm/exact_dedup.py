"""Exact dedup: static filters per snapshot screen a batch, exact buckets confirm.

A snapshot is fixed: one row per distinct text, dealt into buckets by its digest, and a
binary fuse filter per bucket. A batch is first grouped by digest (its own duplicates), each
distinct digest is looked up in the filter of its bucket, and those that pass join the
bucket's entries, where the normalised bytes of both texts are compared.

Texts are equal when identical after lower-casing A-Z. A null text counts as empty. Rows with
a null id take part; a known id beats a null one. Rows that repeat an id and text count each,
and one of them stays. Only id and text are read, so other columns may have any name.
"""

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm import fuse
from driftmon.llm.common import keep_rows, raw_hash, whole
from driftmon.session import written

BUCKET_KEYS = 1 << 16


def normalised(text: str) -> Column:
    return F.translate(whole(text), ascii_uppercase, ascii_lowercase)


@dataclass(frozen=True)
class Snapshot:
    docs: DataFrame  # the fixed documents; read again only for byte checks
    rows: DataFrame  # row, id, sha
    entries: DataFrame  # one per distinct text: sha, bucket, id, raw, same, row, n
    filters: DataFrame  # one per bucket
    buckets: int


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row per document: the texts are read and digested once, here."""
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("id"),
            raw_hash(text).alias("raw"),
            F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("sha"),
        ),
        "digests",
    )


def _groups(rows: DataFrame) -> DataFrame:
    """One row per text: how many rows hold it, and the row that stays."""
    same = rows.groupBy("sha", "id", "raw").agg(F.count("*").alias("same"), F.min("row").alias("row"))
    best = F.max(F.struct("id", "raw", "same", "row")).alias("best")
    return same.groupBy("sha").agg(best, F.sum("same").alias("n")).select("sha", "best.*", "n")


def _key() -> Column:
    return F.xxhash64("sha")


def build_snapshot(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Snapshot:
    """Digest `docs` and build a filter per bucket of about 65 000 distinct texts."""
    rows = _rows(docs, doc_id, text)
    groups = written(_groups(rows), "groups")
    buckets = groups.count() // BUCKET_KEYS + 1
    entries = groups.withColumn("bucket", F.pmod(_key(), F.lit(buckets)).cast("int"))

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, data = fuse.build(pdf["key"].to_numpy())
        return pd.DataFrame([(pdf["bucket"].iloc[0], seed, length, segments, data)], columns=names)

    names = ["bucket", "seed", "length", "segments", "data"]
    filters = entries.select("bucket", _key().alias("key")).groupBy("bucket").applyInPandas(
        built, "bucket int, seed int, length int, segments int, data binary"
    )
    return Snapshot(docs, rows, entries, written(filters, "filters"), buckets)


def _screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of the batch that the filter of their bucket lets pass."""
    parts = groups.count() // (BUCKET_KEYS * snapshot.buckets) + 1
    keyed = groups.select(
        "sha",
        _key().alias("key"),
        F.pmod(_key(), F.lit(snapshot.buckets)).cast("int").alias("bucket"),
        F.pmod(F.xxhash64("sha", F.lit("part")), F.lit(parts)).cast("int").alias("part"),
    )
    filters = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def probe(batch: pd.DataFrame, one: pd.DataFrame) -> pd.DataFrame:
        if batch.empty or one.empty:
            return batch[["sha"]].iloc[:0]
        f = one.iloc[0]
        hit = fuse.contains((f["seed"], f["length"], f["segments"], f["data"]), batch["key"].to_numpy())
        return batch.loc[hit, ["sha"]]

    return (
        keyed.groupBy("bucket", "part").cogroup(filters.groupBy("bucket", "part")).applyInPandas(probe, "sha binary")
    )


def _texts(pairs: DataFrame, side: str, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The normalised text of each pair's row on one side.

    The pairs grow with the copies in the corpus, so they are never broadcast.
    """
    of = docs.select(F.col(doc_id).alias("t_id"), raw_hash(text).alias("t_raw"), normalised(text).alias("t"))
    on = F.col("t_id").eqNullSafe(F.col(f"{side}_id")) & (F.col("t_raw") == F.col(f"{side}_raw"))
    return of.join(pairs.hint("merge"), on).select("sha", F.col("t").alias(f"{side}_text"))


def confirmed(
    groups: DataFrame, batch: DataFrame, snapshot: Snapshot, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`sha` of each text of the batch that the snapshot holds, byte for byte."""
    passed = _screen(groups, snapshot)
    pairs = written(
        passed.join(snapshot.entries.select("sha", F.col("id").alias("s_id"), F.col("raw").alias("s_raw")), "sha").join(
            groups.select("sha", F.col("id").alias("b_id"), F.col("raw").alias("b_raw")), "sha"
        ),
        "positives",
    )
    old = _texts(pairs.select("sha", "s_id", "s_raw"), "s", snapshot.docs, doc_id, text)
    new = _texts(pairs.select("sha", "b_id", "b_raw"), "b", batch, doc_id, text)
    return old.join(new.hint("merge"), "sha").where("s_text = b_text").select("sha").distinct()


def dedup(batch: DataFrame, snapshot: Snapshot, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of snapshot and batch with its group.

    Columns: id, keep_id (the largest id of the group), group_size, kept, sha, and the row
    that stays: raw, same.
    """
    rows = _rows(batch, doc_id, text)
    groups = written(_groups(rows), "groups")
    found = written(confirmed(groups, batch, snapshot, doc_id, text), "confirmed").withColumn("held", F.lit(True))
    # A digest that two different texts shared would stay two groups: `own` tells them apart.
    mine = groups.join(found, "sha", "left").withColumn("own", F.col("held").isNull()).drop("held")
    both = snapshot.entries.drop("bucket").select("*", F.lit(False).alias("own"), F.lit(False).alias("new")).unionByName(
        mine.withColumn("new", F.lit(True))
    )
    best = F.max(F.struct("id", "raw", "same", "new", "row")).alias("best")
    total = both.groupBy("sha", "own").agg(best, F.sum("n").alias("size"), F.collect_set("new").alias("sides"))
    total = total.select("sha", "best", "size", F.explode("sides").alias("new"))
    members = snapshot.rows.withColumn("new", F.lit(False)).unionByName(rows.withColumn("new", F.lit(True)))
    here = (F.col("m.new") == F.col("best.new")) & (F.col("m.row") == F.col("best.row"))
    return (
        members.alias("m")
        .join(total.alias("t"), ["sha", "new"])
        .select(
            F.col("m.id").alias("id"),
            F.col("best.id").alias("keep_id"),
            F.col("size").alias("group_size"),
            here.alias("kept"),
            F.col("sha"),
            F.col("best.raw").alias("raw"),
            F.col("best.same").alias("same"),
        )
    )


def halves(docs: DataFrame, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """An older and a newer delivery: split at the middle of the id range; null ids are new."""
    low, high = docs.agg(F.min(doc_id), F.max(doc_id)).first()
    if low is None:
        return docs.where(F.lit(False)), docs
    old = F.col(doc_id) <= low + (high - low) // 2
    return docs.where(old), docs.where(~old | F.col(doc_id).isNull())


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`dedup` of one table: its older half is the snapshot, the rest is the batch."""
    old, new = halves(docs, doc_id)
    return dedup(new, build_snapshot(old, doc_id, text), doc_id, text)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns as they were."""
    kept = exact_dedup(docs, doc_id, text).where("kept")
    keepers = kept.select(F.col("id").alias("k_id"), F.col("raw").alias("k_raw"), F.col("same").alias("k_same"))
    return keep_rows(docs, written(keepers, "keepers"), doc_id, text)
