"""Text quality by a sparse ensemble of rules over statistics of the text.

Shallow trees are grown on the statistics of labelled texts; every path from a root is a
rule, a conjunction of bounds. A lasso logistic regression over the rules keeps the few that
matter, and these become one Spark column: the score.

A null text counts as empty, and an empty one has all statistics zero. If the training rows
have one label only, every score is that label's smoothed share; without any it is 0.5, which
predicts 1. Repeated rows count each. Statistics never look at anything but the text.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import as_bytes, free
from driftmon.session import written

TREES, DEPTH, LASSO = 30, 3, 0.001
_MARK = np.zeros(256, bool)
_MARK[list(punctuation.encode())] = True
STATISTICS = (
    "bytes words lines upper digits marks stops spaces breaks high entropy repeats "
    "word_length word_spread longest short distinct capitals ends lone distinct_lines line_words"
).split()


def statistics_of(text: bytes) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    code = np.frombuffer(text, np.uint8)
    held = np.bincount(code, minlength=256)
    words, lines = text.split(), text.split(b"\n")
    many = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    last = np.frombuffer(b"".join([w[-1:] for w in words]) or b" ", np.uint8)
    share = held[held > 0] / n
    letters = max(1, int(held[65:91].sum() + held[97:123].sum()))
    stops = held[list(b".,")].sum()
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(np.log1p(len(lines))),
        held[65:91].sum() / letters,
        held[48:58].sum() / n,
        (held[_MARK].sum() - stops) / n,
        stops / n,
        held[32] / n,
        held[10] / n,
        held[128:].sum() / n,
        float(-(share * np.log(share)).sum()),
        np.count_nonzero(code[1:] == code[:-1]) / n,
        float(sizes.mean()),
        float(sizes.std()),
        float(np.log1p(sizes.max())),
        np.count_nonzero(sizes <= 3) / many,
        len(set(words)) / many,
        sum(map(bytes.isupper, words)) / many,
        np.count_nonzero(_MARK[last] & (last != 46) & (last != 44)) / many,
        np.count_nonzero((sizes == 1) & _MARK[last]) / many if words else 0.0,
        len(set(lines)) / len(lines),
        len(words) / len(lines),
    ]


def statistics(text: str) -> Column:
    """struct of doubles of a text column."""
    kind = pa.struct([(s, pa.float64()) for s in STATISTICS])

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = np.array([statistics_of(t) for t in batch.to_pylist()], np.float64).reshape(-1, len(STATISTICS))
            yield pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], fields=list(kind))

    return measured.asNondeterministic()(as_bytes(text))


Rule = tuple[tuple[int, str, float], ...]  # (statistic, "<=" or ">", bound), all must hold


def paths(described: str) -> list[Rule]:
    """Every path of the trees in a model's description, with the tightest bounds on it."""
    rules: set[Rule] = set()
    stack: list[tuple[int, tuple]] = []
    for line in described.split("\n"):
        depth = len(line) - len(line.lstrip())
        m = re.match(r"(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line.strip())
        if line.strip().startswith("Tree"):
            stack = []
        if not m:
            continue
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(m[1]), m[2], float(m[3]))))
        bounds: dict[tuple[int, str], float] = {}
        for _, (at, side, bound) in stack:
            old = bounds.get((at, side), bound)
            bounds[at, side] = min(old, bound) if side == "<=" else max(old, bound)
        rules.add(tuple(sorted((at, side, b) for (at, side), b in bounds.items())))
    return sorted(rules)


def holds(rule: Rule, stats: str) -> Column:
    """The rule as a condition on a column of statistics."""
    out = F.lit(True)
    for at, side, bound in rule:
        value = F.col(f"`{stats}`.{STATISTICS[at]}")
        out = out & ((value <= bound) if side == "<=" else (value > bound))
    return out


@dataclass(frozen=True)
class Model:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, stats: str) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def learn(train: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """Fit on `train` (label, text), as `labelled` gives it."""
    rows = written(train.select("label", statistics("text").alias("s")), "quality-train")
    many, good = rows.agg(F.count("*"), F.sum("label")).first()
    if not many or good in (0, many):
        share = (good + 1) / (many + 2) if many else 0.5
        return Model((), float(np.log(share / (1 - share))))
    columns = F.array(*(F.col(f"s.{name}") for name in STATISTICS))
    points = rows.select("label", "s", array_to_vector(columns).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=5, featureSubsetStrategy="onethird")
    rules = paths(forest.fit(points).toDebugString)
    fires = F.array(*(holds(r, "s").cast("double") for r in rules))
    fired = written(rows.select("label", fires.alias("fires")), "quality-rules")
    fitted = LogisticRegression(maxIter=100, regParam=lasso, elasticNetParam=1.0, standardization=False).fit(
        fired.select("label", array_to_vector("fires").alias("features"))
    )
    weights = fitted.coefficients.toArray()
    kept = tuple((r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6)
    return Model(kept, float(fitted.intercept))


def score_quality(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted: a row per row of `docs`, in place."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), statistics(text).alias("s"))
    rows = rows.select("doc_id", model.score("s").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` without those predicted 0, all columns as they were."""
    stats = free(docs, "__statistics")
    return docs.withColumn(stats, statistics(text)).where(model.score(stats) >= 0.5).drop(stats)
