import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftmon.llm import quality, toxicity
from driftmon.llm.common import crc_mod
from driftmon.llm.labelled import labelled
from driftmon.llm.queries import op4_quality, op5_toxicity
from tests.llm.conftest import prose


def held_out_accuracy(rows, truth, folds, held):
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    return sum(a == b for a, b in judged) / len(judged)


@pytest.fixture(scope="module")
def larger():
    return "/root/testdata/sf0.01"


def read(sf_dir, columns):
    import duckdb

    return dict(duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/labels.parquet'").fetchall())


def test_quality_on_held_out_documents(spark, larger):
    rows = op4_quality(spark, larger).collect()
    assert len(rows) == 1000
    assert held_out_accuracy(rows, read(larger, "doc_id, quality"), 3, 1) > 0.95


def test_toxicity_on_held_out_documents(spark, larger):
    rows = op5_toxicity(spark, larger).collect()
    assert len(rows) == 1000
    assert held_out_accuracy(rows, read(larger, "doc_id, toxic"), 5, 0) > 0.93


def test_ngrams_are_of_characters_in_one_case():
    assert len(toxicity.slots_of(" äöü ".encode())) == 3 + 2 + 1
    assert list(toxicity.slots_of("GRÖSSE ÉTÉ".encode())) == list(toxicity.slots_of("grösse été".encode()))


def test_toxicity_found_by_language(spark):
    """Held-out recall; the language only judges."""
    sf_dir = "/root/testdata/sf0.1"
    rows = op5_toxicity(spark, sf_dir).where("held_out")
    rows = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null").select("doc_id", "toxic"), "doc_id")
    rows = rows.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()

    def found(lang):
        of = [r.predicted for r in rows if r.toxic and r.lang == lang]
        return sum(of) / len(of)

    assert found("en") > 0.85 and found("fr") > 0.6 and found("de") > 0.2 and found("es") > 0.3
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(clean) < 0.01 * len(clean)


def test_ratios_of_slots():
    held = np.zeros((2, 1 << toxicity.BITS))
    held[0, :3], held[1, 1:4] = (6, 3, 0), (1, 2, 1)
    for slot in range(5):
        clean, toxic = (held[k, slot] / held[k].sum() + toxicity.SMOOTHING / held.sum() for k in (0, 1))
        assert toxicity.ratios(held)[slot] == pytest.approx(math.log(toxic / clean))
    assert toxicity.ratios(held)[4] == 0 and not toxicity.ratios(np.zeros((2, 8))).any()


def test_descent_finds_the_least_point():
    rng = np.random.default_rng(3)
    shape, least = np.diag(rng.uniform(0.1, 9, 20)), rng.normal(size=20)
    fit = toxicity._descent(20)
    at = next(fit)
    with pytest.raises(StopIteration) as end:
        while True:
            away = at - least
            at = fit.send((away @ shape @ away / 2 + 1, shape @ away))
    assert end.value.value == pytest.approx(least, abs=0.02)


def test_toxicity_equals_a_plain_form(spark):
    """Of every document of a small table, with the fitted weights looked up gram by gram."""
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(labelled(docs, labels, "toxic", crc_mod("doc_id", 5) != 0), (0.1, 0.01))
    weights = np.frombuffer(model.weights)
    texts = dict(docs.select("doc_id", "text").collect())
    rows = toxicity.score_toxicity(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = f" {' '.join((texts[r.doc_id] or '').lower().split())} "
        grams = {words[i : i + n] for n in toxicity.SIZES for i in range(len(words) - n + 1)}
        slots = set(toxicity.slots_of((texts[r.doc_id] or "").encode()).tolist())
        assert len(slots) <= len(grams)
        z = model.intercept + math.fsum(weights[s] for s in slots)
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def test_paths_are_all_rules_of_the_trees():
    described = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 3 <= 0.25)
      Predict: 0.0
     Else (feature 3 > 0.25)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
"""
    assert quality.paths(described) == sorted(
        [((3, "<=", 0.5),), ((3, "<=", 0.25),), ((3, "<=", 0.5), (3, ">", 0.25)), ((3, ">", 0.5),)]
    )


def test_score_column_equals_the_rules(spark):
    model = quality.Model(((((0, ">", 1.0), (16, "<=", 0.9)), 2.0), (((1, "<=", 5.0),), -1.0)), 0.25)
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, prose(400))], "doc_id long, text string")
    from math import exp

    for r in quality.score_quality(docs, model).collect():
        text = {1: "a b a", 2: "", 3: prose(400)}[r.doc_id]
        s = quality.statistics_of(text.encode())
        z = 0.25 + 2.0 * (s[0] > 1 and s[16] <= 0.9) - 1.0 * (s[1] <= 5)
        assert r.score == pytest.approx(1 / (1 + exp(-z)))


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_labels_of_one_kind_or_none(spark, odd, none, kind):
    score = quality.score_quality if kind is quality else toxicity.score_toxicity
    train = spark.createDataFrame([(1.0, "a b"), (1.0, "")], "label double, text string")
    assert {round(r.score, 9) for r in score(odd, kind.learn(train)).collect()} == {0.75}
    empty = kind.learn(train.where("false"))
    assert {(r.score, r.predicted) for r in score(odd, empty).collect()} == {(0.5, 1)}
    assert score(none, empty).count() == 0


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 0), (3, 0), (9, 0), (11, 1)], "doc_id long, quality int"
    )
    train = labelled(odd, labels, "quality", F.lit(True))
    got = sorted((r.label, r.text[:5]) for r in train.collect())
    assert got == [(0.0, ""), (0.0, "word"), (0.0, "word"), (1.0, "Alpha"), (1.0, prose(60, 5)[:5])]
    assert labelled(odd, labels, "quality", F.lit(True), rows=1).select("text").distinct().count() <= 1
    model = quality.learn(train)
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() <= odd.count() == quality.score_quality(odd, model).count()


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    learn = crc_mod("doc_id", 3) != 1
    texts = {r.text for r in labelled(docs, labels, "quality", learn).collect()}
    assert texts == {f"t{i}" for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1}
