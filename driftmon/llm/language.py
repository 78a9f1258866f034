"""Language of a text by rank-order profiles of letter n-grams.

A language's profile is the list of its most frequent n-grams, over all training texts. A
text's own list is compared with each profile: every n-gram adds how far out of place it is,
or the most a place can be off when the profile lacks it. The nearest profile names the
language; the score tells how much nearer it is than the next one.

A text is its words, runs of letters in lower case, with one blank between and at both ends;
n-grams lie within a word and its blanks. They are handled as 64-bit numbers; ties in
frequency go to the smaller number. A text that is null or has no letter is `und` with score
0, and so is every text if nothing was learned. Repeated rows count each, when learning too.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmon.llm.common import whole

LONGEST = 4  # letters of an n-gram
TOP = 400  # n-grams of a profile, and of a text
UNKNOWN = "und"
HELD = 1 << 22  # n-grams a task gathers before it counts them
_OTHER = re.compile(r"[\W\d_]+")
_BLANK = ord(" ")


def grams_of(text: str, longest: int = LONGEST) -> np.ndarray:
    """The n-grams of a text as unsigned numbers, repeats included."""
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, letters)):
        return np.empty(0, np.uint64)
    code = np.frombuffer(f" {letters} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    blank = code == _BLANK
    out = [code[~blank] + np.uint64(1)]
    number, inner = code + np.uint64(1), np.ones(len(code), bool)
    for n in range(2, longest + 1):
        # A blank may only be first or last.
        number = number[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(1)
        inner = inner[:-1] if n == 2 else inner[:-1] & ~blank[n - 2 : -1]
        out.append(number[inner])
    return np.concatenate(out)


def learn(
    texts: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP, longest: int = LONGEST
) -> dict[str, list[int]]:
    """Profiles of the languages in `texts`: n-grams, most frequent first.

    Counted over all rows that name a language; what comes back is `top` numbers each.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def out():
            for name, parts in held.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                kind = pa.array([name] * len(grams), pa.string())
                yield pa.RecordBatch.from_arrays([kind, pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(name, []).append(grams_of(body, longest))
                size += len(held[name][-1])
                if size > HELD:
                    yield from out()
                    size = 0
        yield from out()

    rows = texts.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), whole(text).alias("text"))
    counts = rows.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    best = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    profiles: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "place").collect():
        profiles.setdefault(r.lang, []).append(r.gram)
    return profiles


class Places:
    """The profiles as a table: n-gram by language, its place or `top` where it has none."""

    def __init__(self, profiles: dict[str, list[int]], top: int = TOP, longest: int = LONGEST):
        self.langs, self.top, self.longest = sorted(profiles), top, longest
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.place = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        for k, name in enumerate(self.langs):
            self.place[k, np.searchsorted(self.grams, profiles[name])] = np.arange(len(profiles[name]))

    def predict(self, text: str) -> tuple[str, float]:
        every = grams_of(text, self.longest)
        if not len(every) or not self.langs:
            return UNKNOWN, 0.0
        grams, n = np.unique(every.view(np.int64), return_counts=True)
        if len(grams) > self.top:  # only those that can be among the first
            cut = np.partition(n, len(n) - self.top)[len(n) - self.top]
            grams, n = grams[n >= cut], n[n >= cut]
        ranked = grams[np.argsort(-n, kind="stable")][: self.top]
        at = np.searchsorted(self.grams, ranked).clip(max=len(self.grams) - 1)
        places = np.where(self.grams[at] == ranked, self.place[:, at], -1)
        off = np.where(places < 0, self.top, np.abs(places - np.arange(len(ranked))))
        far = off.mean(1) / self.top
        order = np.argsort(far, kind="stable")
        rest = far[order[1]] if len(order) > 1 else 1.0
        score = 1 - far[order[0]] / rest if rest else 0.0
        return self.langs[order[0]], float(min(1.0, max(0.0, score)))


@lru_cache(maxsize=2)
def _places(profiles: tuple, top: int, longest: int) -> Places:
    return Places({name: list(grams) for name, grams in profiles}, top, longest)


def language(text: str, profiles: dict[str, list[int]], top: int = TOP, longest: int = LONGEST) -> Column:
    """struct<lang, score> of a text column."""
    fixed = tuple((name, tuple(grams)) for name, grams in sorted(profiles.items()))

    @F.arrow_udf("struct<lang:string,score:double>")
    def named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = _places(fixed, top, longest).predict
        for batch in batches:
            langs, scores = zip(*map(predict, batch.to_pylist())) if len(batch) else ((), ())
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return named.asNondeterministic()(whole(text))


def identify(docs: DataFrame, profiles: dict[str, list[int]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: a row per row of `docs`, in place."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), language(text, profiles).alias("p"))
    return rows.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
