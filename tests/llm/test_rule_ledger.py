import re

import pytest
from pyspark.sql import functions as F

from driftmon.llm import rule_ledger as rules
from tests.llm.conftest import prose
from tests.plans import plan_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plainly(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else None
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": None if covered is None else len(covered),
    }


TEXTS = [
    "a b c a b c a b c",
    "a a a a a a",
    "one two three\none two three\n\n \n one two three",
    "x y z . x y z x y",
    "  no break   spaces \x0b\x0c count",
    "# * $ | <> && 100%",
    "\U0001f642 \U0001f642 \U0001f642 \U0001f642",
    "- item one\n* item two\n3. item three\nline ...\nmore…",
    " \n".join(["same line here"] * 40),
    prose(200, 3) + " " + prose(80, 4) + " " + prose(200, 3),
]


def test_measures_equal_plain_python(spark, odd):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for docs in (frame, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        got = {r["doc_id"]: r for r in rules.ledger(docs).collect()}
        assert got.keys() == texts.keys()
        for key, text in texts.items():
            for name, want in plainly(text).items():
                assert want is None or got[key][name] == want, (key, name)


def test_every_row_has_a_row_and_bits(odd, none):
    rows = rules.ledger(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    few = rules.mask(["few_words"])
    assert all(by[i]["failed"] & few for i in (3, 4, 5))
    assert rules.ledger(none).count() == 0


def test_native_without_exchange(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(rules.apply_policy(rules.judged(docs), rules.POLICIES[-1]))
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


def test_policies_combine_bits(spark):
    bits = [0, 1, 2, 4, 4 | 64, 128 | 256, 16, 1 | 16]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id long, failed long")
    kept = {p.version: [r["kept"] for r in rules.apply_policy(rows, p).orderBy("doc_id").collect()] for p in rules.POLICIES}
    assert kept["base"] == [b & 3 == 0 for b in bits]
    assert kept["v2"] == [True, False, False, True, False, False, False, False]
    with pytest.raises(ValueError):
        rules.mask(["no such rule"])


def test_ablations_equal_counting_again(spark):
    found = rules.ledger(spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string")).collect()
    rows = spark.createDataFrame([(r["doc_id"], r["failed"]) for r in found], "doc_id long, failed long")
    names = [r.name for r in rules.RULES]

    def gone(bits, policy, without=None):
        failed = {n for i, n in enumerate(names) if bits >> i & 1} - {without}
        return bool(failed & set(policy.hard)) or len(failed & set(policy.soft)) > policy.most

    got = {(r["version"], r["rule"]): r for r in rules.ablations(rows).collect()}
    for p in rules.POLICIES:
        for name in (*p.hard, *p.soft):
            r, bits = got[p.version, name], [x["failed"] for x in found]
            failing = [b for b in bits if b >> names.index(name) & 1]
            assert r["failing"] == len(failing)
            assert r["kept"] == sum(not gone(b, p) for b in bits)
            assert r["kept_without"] == sum(not gone(b, p, name) for b in bits)
            assert r["alone"] == sum(gone(b, p) and not gone(b, p, name) for b in bits)
            assert set(r["beside"]) == {n for i, n in enumerate(names) if n != name and any(b >> i & 1 for b in failing)}
    zeros = rules.ablations(rows.where("false")).collect()
    assert len(zeros) == len(got) and all(r["failing"] == r["kept"] == 0 for r in zeros)


def test_kept_documents_keep_their_columns(odd, none):
    rows = rules.ledger(odd)
    kept = rules.keep_by_rules(odd, rows, rules.BASE)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in rules.apply_policy(rows, rules.BASE).where("kept and doc_id is not null").collect()
    }
    assert rules.keep_by_rules(none, rules.ledger(none), rules.BASE).count() == 0


def test_clean_documents_stay(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    judged = rules.apply_policy(rules.ledger(docs), rules.POLICIES[-1])
    base = rules.rejects(rules.BASE)
    good = judged.join(labels, "doc_id").where((F.col("quality") == 1) & ~base)
    assert good.where("kept").count() >= 0.99 * good.count() > 0
