from collections import Counter

import pytest

from driftmon.llm import language
from driftmon.llm.queries import op9_language


def plain_grams(text, longest=4):
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for word in letters:
        padded = f" {word} "
        for n in range(1, longest + 1):
            out.update(g for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) != " ")
    return out


@pytest.mark.parametrize("text", ["The cat", "", "12", "a", "Über-fluß, ça va? x1y", "\U0001f642 日本 ab"])
def test_grams_are_those_within_words(text):
    got = Counter(Counter(language.grams_of(text).tolist()).values())
    want = Counter(plain_grams(text).values())
    # A blank between two words belongs to both, so only n-grams that touch no blank differ in nothing.
    assert got == want


def test_places_are_compared_out_of_place(spark):
    docs = spark.createDataFrame([("x", "aaa ab"), ("x", None), ("y", "cc cd"), (None, "zz")], "lang string, text string")
    profiles = language.learn(docs)
    assert set(profiles) == {"x", "y"}
    places = language.Places(profiles)
    text = "ab aab"
    counts = Counter(language.grams_of(text).view("int64").tolist())
    own = sorted(counts, key=lambda g: (-counts[g], g))
    far = {
        lang: sum(abs(p.index(g) - i) if g in p else language.TOP for i, g in enumerate(own)) / len(own) / language.TOP
        for lang, p in profiles.items()
    }
    name, score = places.predict(text)
    assert name == min(far, key=far.get)
    assert score == pytest.approx(1 - min(far.values()) / max(far.values()))


def test_query_on_held_out_documents(spark, sf_dir, given):
    lang = dict(given("documents", "doc_id, lang"))
    rows = op9_language(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, none):
    profiles = language.learn(odd)
    rows = language.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert language.learn(none) == {}
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.identify(none, profiles).count() == 0
