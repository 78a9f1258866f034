import hashlib

import numpy as np
import pytest

from driftmon.llm import exact_dedup, fuse
from driftmon.llm.queries import op1_exact_dedup


def normal(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("n", [1, 2, 3, 10, 500, 30_000])
def test_filter_passes_members_and_few_others(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    built = fuse.build(np.concatenate([keys, keys[:2]]))
    assert fuse.contains(built, keys).all()
    others = np.random.default_rng(n + 1).integers(0, 2**63, 20_000)
    assert fuse.contains(built, others).mean() < 0.02


def test_query_equals_brute_force(spark, sf_dir, given):
    groups = {}
    for doc_id, text in given("documents", "doc_id, text"):
        groups.setdefault(normal(text), []).append(doc_id)
    want = {
        (d, max(ids), len(ids), d == max(ids), hashlib.sha256(t).hexdigest()) for t, ids in groups.items() for d in ids
    }
    assert {tuple(r) for r in op1_exact_dedup(spark, sf_dir).collect()} == want


def test_odd_rows(odd):
    rows = exact_dedup.exact_dedup(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(bytes(r.sha), []).append(r)
    for group in by.values():
        assert sum(r.kept for r in group) == 1
        assert {r.group_size for r in group} == {len(group)}
    assert {r.keep_id for r in rows if r.id in (3, 4)} == {4}
    assert {r.keep_id for r in rows if r.id in (1, 2)} == {2}
    kept = exact_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(by)


def test_empty_table(none):
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.keep_one(none).columns == none.columns


def test_only_equal_bytes_are_confirmed(spark, monkeypatch):
    """Two texts behind one digest stay apart: the bytes decide."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "ONE"), (4, "four")], "doc_id long, text string")
    real = exact_dedup._rows
    monkeypatch.setattr(
        exact_dedup, "_rows", lambda *a: real(*a).withColumn("sha", F.when(F.col("id").isin(2, 4), F.lit(b"x")).otherwise(F.col("sha")))
    )
    got = {r.id: r.keep_id for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: 3, 3: 3, 2: 2, 4: 4}
