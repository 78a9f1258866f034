"""Every query against an independent SQL engine on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from driftmon.operators.metrics import auc, rmse
from driftmon.plans.oracles import _auc
from driftmon.plans.queries import sea_scores

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    frame = frame[cols].copy()
    for c in cols:
        if str(frame[c].dtype).startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]")
    return frame.sort_values(cols).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = rows(entry.queries()[name](spark, sf_dir).toPandas())
    want = rows(duck.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    for c in got.columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        assert same.all(), (c, got[c][~same].head(3), want[c][~same].head(3))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_noisy_points_are_judged_from_their_scores(spark, sf_dir):
    """Metrics and verdicts of an imperfect model against SQL over the scores it gave."""
    scored, run = sea_scores(spark, sf_dir)
    frame = scored.select("blk", "score", "label", "prediction").toPandas()
    con = duckdb.connect()
    con.register("scored", frame)
    sql = f"""WITH {_auc("scored", "blk")}, errors AS (
      SELECT blk, sqrt(avg((label - prediction) * (label - prediction))) AS rmse FROM scored GROUP BY blk)
    SELECT blk, auc, rmse FROM areas JOIN errors USING (blk) ORDER BY blk"""
    want = con.execute(sql).fetchall()
    aucs = {r.blk: r.auc for r in auc(scored, by=["blk"]).collect()}
    errors = {r.blk: r.rmse for r in rmse(scored, by=["blk"]).collect()}
    assert len(want) == 4 and frame["score"].nunique() > 20
    for blk, area, error in want:
        assert aucs[blk] == area and errors[blk] == pytest.approx(error, rel=1e-9)
    assert 0.75 < run["auc"] < 1 and 0.75 < aucs[1] < 1  # one label in ten is noise
    drift = {r.blk: r.drift for r in entry.queries()["gbt_sea"](spark, sf_dir).collect()}
    assert drift == {blk: abs(area - want[0][1]) > 0.05 for blk, area, _ in want}


def test_entry_stamps_every_row(spark):
    out = entry.entry(spark)
    per_block = out.groupBy("blk").agg(
        {"drift": "max", "train_auc": "max", "test_auc": "max", "id": "count"}
    )
    rows = {r["blk"]: r for r in per_block.collect()}
    assert sum(r["count(id)"] for r in rows.values()) == 6000
    assert rows[1]["max(test_auc)"] == rows[1]["max(train_auc)"] > 0.98
    assert not rows[1]["max(drift)"]
    assert rows[4]["max(drift)"]
