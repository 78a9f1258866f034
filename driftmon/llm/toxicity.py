"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes ratios.

Features are the n-grams (three to five characters of the lower-cased text) that a text holds,
hashed into a fixed number of slots. Each is scaled by the logarithm of how much more often
toxic than other training texts hold it; SMOOTHING counts are added to every slot, dealt to the
two labels as all counts are, so that a slot no text holds has a ratio of one. A logistic
regression is fitted on all scaled slots, with both labels weighing the same. Of several penalties given it
takes the one with the least loss on a fifth of the training texts, learning from the others.

A null text counts as empty: it has no n-grams, so its score is the intercept's. If the
training rows have one label only, every score is that label's smoothed share; without any
training rows it is 0.5, which predicts 1. Repeated rows count each, in training as in scoring;
equal texts have equal scores, and a score of exactly 0.5 predicts 1. A text of any length is
scored whole: it holds a slot or not. Null ids and columns beside id and text change nothing,
whatever their names; no rows give no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from driftmon.llm.common import as_bytes
from driftmon.session import written

SIZES = (3, 4, 5)
BITS = 18  # slots of the hash: 2 ** 18
SMOOTHING = 64.0  # the best ranking in two folds of the learning rows of sf0.1, of 4, 16, 64 and 256
PENALTIES = (0.001,)  # of 0.01 and 0.001 the one a split of the learning rows of sf0.1 chose
STEPS, MOVES, SETTLED = 40, 8, 1e-6  # of a fit: most steps, moves it recalls, share of the loss at which it ends
PARTS = 6  # tasks of a pass over the learning rows, which are bounded; each sends 2 ** 18 sums
TRIED = 5  # one in so many texts judges the penalties


def slots_of(text: bytes) -> np.ndarray:
    """The slot of every n-gram, repeats included."""
    words = text.decode("utf-8", "replace").lower().split()
    code = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    out = []
    for n in SIZES:
        if len(code) < n:
            break
        gram = np.full(len(code) - n + 1, n, np.uint64)
        for i in range(n):
            gram = gram * np.uint64(0xD6E8FEB86659FD93) + code[i : len(code) - n + 1 + i]
        gram *= np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
        gram *= np.uint64(0xBF58476D1CE4E5B9)
        out.append((gram >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def held_slots(slots: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each slot once, as its last repeat; `last` is room for a number per slot, in any state."""
    at = np.arange(len(slots), dtype=last.dtype)
    last[slots] = at
    return slots[last[slots] == at]


@F.arrow_udf(BinaryType())
def _places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Of each text the slots it holds, as 32-bit numbers."""
    last = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        slots = (np.sort(held_slots(slots_of(t), last)).astype(np.int32) for t in batch.to_pylist())
        yield pa.array([s.tobytes() for s in slots], pa.binary())


def _summed(rows: DataFrame, width: int, add) -> np.ndarray:
    """The sum over all rows of what `add(total, label, slots)` adds to a row of `width` numbers;
    a task sends its sum only, and the sums are added in the order of the tasks. The driver gets
    at most PARTS sums a pass, into however many pieces the rows were cut."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for label, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                add(total, label, np.frombuffer(at, np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], ["task", "total"]
        )

    parts = rows.select("label", "at").coalesce(PARTS).mapInArrow(task, "task long, total binary").collect()
    return sum((np.frombuffer(p["total"]) for p in sorted(parts, key=lambda p: p["task"])), np.zeros(width))


def _evidence(rows: DataFrame) -> np.ndarray:
    """For each label, how many texts hold each slot."""
    slots = 1 << BITS

    def add(total, label, at):
        total[at + slots * int(label > 0.5)] += 1

    return _summed(rows, 2 * slots, add).reshape(2, slots)


def ratios(held: np.ndarray) -> np.ndarray:
    """Log-count ratios of all slots, from the counts of clean and toxic texts that hold them."""
    totals = held.sum(axis=1, keepdims=True)
    if not totals.all():
        return np.zeros(held.shape[1])
    smoothed = held / totals + SMOOTHING / totals.sum()
    return np.log(smoothed[1] / smoothed[0])


@dataclass(frozen=True)
class Model:
    weights: bytes  # a float64 for each slot; empty: all zero
    intercept: float


def learn(train: DataFrame, penalties=PENALTIES) -> Model:
    """Fit on `train` (label, text), as `labelled` gives it. The slots of its texts are found once."""
    rows = train.select("label", F.xxhash64("text").alias("part"), _places(as_bytes("text")).alias("at"))
    rows = written(rows.repartition(PARTS), "toxic-slots")
    many, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    if not many or toxic in (0, many):
        share = (toxic + 1) / (many + 2) if many else 0.5
        return Model(b"", float(np.log(share / (1 - share))))
    if len(penalties) > 1:
        judge = F.pmod("part", F.lit(TRIED)) == 0
        penalties = [_penalty(rows.where(~judge), rows.where(judge), penalties)]
    (weights,) = _fitted(rows, penalties)
    return Model(weights[:-1].tobytes(), float(weights[-1]))


def _penalty(rows: DataFrame, judge: DataFrame, penalties) -> float:
    """The penalty whose fit on `rows` has the least loss on `judge`; the first if none can tell."""
    many, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if toxic in (0, many) or judge.isEmpty():
        return penalties[0]
    losses, _ = _losses(judge, _fitted(rows, penalties), (many / (2 * (many - toxic)), many / (2 * toxic)))
    return penalties[int(np.argmin(losses))]


def _losses(rows: DataFrame, points: list[np.ndarray], shares) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss and its slope at each point, a weight per slot and the intercept; a row
    counts as `shares` says for its label."""
    tried = np.stack(points)
    many, width = tried.shape

    def add(total, label, at):
        z = tried[:, at].sum(axis=1) + tried[:, -1]
        toxic = label > 0.5
        share, away = shares[toxic], (-z if toxic else z)
        total[:many] += share * np.logaddexp(0, away)
        slope = share * (1 if not toxic else -1) * np.exp(-np.logaddexp(0, -away))
        by_point = total[many:].reshape(many, width)
        by_point[:, at] += slope[:, None]
        by_point[:, -1] += slope

    total = _summed(rows, many * (width + 1), add)
    return total[:many], total[many:].reshape(many, width)


def _descent(width: int):
    """Limited-memory quasi-Newton steps: yields points, is sent the loss and the slope there, and
    returns the last point."""
    at = np.zeros(width)
    loss, slope = yield at
    moves = []
    for _ in range(STEPS):
        step, kept = -slope, []
        for move, bend in reversed(moves):
            share = (move @ step) / (bend @ move)
            step = step - share * bend
            kept.append(share)
        if moves:
            move, bend = moves[-1]
            step = step * ((move @ bend) / (bend @ bend))
        for (move, bend), share in zip(moves, reversed(kept)):
            step = step + move * (share - (bend @ step) / (bend @ move))
        length = 1.0 if moves else 1 / max(1.0, np.abs(slope).sum())
        while True:
            there = at + length * step
            lower, new = yield there
            if lower <= loss + 1e-4 * length * (slope @ step) or length < 1e-10:
                break
            length /= 2
        move, bend, gain = there - at, new - slope, loss - lower
        if move @ bend > 1e-12:
            moves = [*moves[1 - MOVES :], (move, bend)]
        at, loss, slope = there, lower, new
        if abs(gain) < SETTLED * abs(loss):
            break
    return at


def _fitted(rows: DataFrame, penalties) -> list[np.ndarray]:
    """Weights and intercept for each penalty, on rows of both labels. The fits go in step, so
    that a pass over the rows serves them all."""
    many, toxic = rows.agg(F.count("*"), F.sum("label")).first()
    shares = (many / (2 * (many - toxic)), many / (2 * toxic))
    scale = np.append(ratios(_evidence(rows)), 1.0)
    fits = {k: _descent(len(scale)) for k in range(len(penalties))}
    points, done = {k: next(fit) for k, fit in fits.items()}, {}
    while points:
        order = list(points)
        losses, slopes = _losses(rows, [points[k] * scale for k in order], shares)
        for k, loss, slope in zip(order, losses, slopes):
            held = np.append(points[k][:-1], 0.0)  # the intercept is free
            sent = loss / many + penalties[k] / 2 * (held @ held), slope * scale / many + penalties[k] * held
            try:
                points[k] = fits[k].send(sent)
            except StopIteration as end:
                done[k] = end.value * scale
                del points[k]
    return [done[k] for k in range(len(penalties))]


class Scorer:
    def __init__(self, model: Model):
        self.weights = np.frombuffer(model.weights) if model.weights else np.zeros(1 << BITS)
        self.intercept, self.last = model.intercept, np.zeros(1 << BITS, np.int64)

    def score(self, text: bytes) -> float:
        z = self.intercept + self.weights[held_slots(slots_of(text), self.last)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


@lru_cache(maxsize=2)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def toxicity(text: str, model: Model) -> Column:
    """Score of a text column, 0 to 1."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = _scorer(model).score
        for batch in batches:
            yield pa.array([score(t) for t in batch.to_pylist()], pa.float64())

    return scored.asNondeterministic()(as_bytes(text))


def score_toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted: a row per row of `docs`, in place."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), toxicity(text, model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
