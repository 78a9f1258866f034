"""The pipeline against a plain version of each stage on the same documents."""

from collections import defaultdict

import pytest

import corpus_pipeline
from driftmon.llm import decontaminate as dc
from driftmon.llm import quality
from driftmon.llm.queries import quality_model
from driftmon.session import written
from tests.llm.test_decontaminate import distance
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_tokens_and_packing import EXACT, check_packing


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = written(stage(spark, docs, sf_dir), "stage")
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(kept):
    for name in ("quality", "exact_dedup", "near_dedup", "decontaminate"):
        assert kept[name].columns == kept[""].columns


def test_quality_drops_what_it_rejects(spark, sf_dir, kept):
    model = quality_model(spark, sf_dir, kept[""])
    good = {r.doc_id for r in quality.score_quality(kept[""], model).where("predicted = 1").collect()}
    assert set(texts(kept["quality"])) == good


def test_one_of_equal_texts_stays(kept):
    groups = defaultdict(list)
    for d, t in texts(kept["quality"]).items():
        groups[(t or "").encode().lower()].append(d)
    assert set(texts(kept["exact_dedup"])) == {max(g) for g in groups.values()}


def test_one_of_near_copies_stays(kept):
    prints = {d: plain_fingerprint(t) for d, t in texts(kept["exact_dedup"]).items()}
    assert set(texts(kept["near_dedup"])) == set(plain_components(prints).values())


def test_documents_with_benchmark_items_go(kept, given):
    items = [dc.words_of(t) for _, t in given("benchmark", "item_id, text")]
    stay = set(texts(kept["decontaminate"]))
    for d, t in texts(kept["near_dedup"]).items():
        words = dc.words_of(t or "")
        joined = b" " + b" ".join(words) + b" "
        if any(b" " + b" ".join(i) + b" " in joined for i in items):
            assert d not in stay
        elif d not in stay:
            assert any(distance(i, words) <= int(dc.SHARE * len(i)) for i in items)


def test_all_that_stays_is_packed(kept):
    check_packing(kept["packing"].collect(), texts(kept["decontaminate"]), EXACT)


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, kept):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rows = lambda f: sorted(map(tuple, f.select(*columns).collect()))
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(kept["packing"])
