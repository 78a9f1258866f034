"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, edit distance.

Distance is edits over words (lower case, ASCII punctuation off). A document holds an item
of n words if one of its stretches is within `share * n` edits of the whole item.

Windows of an item's size class (the largest width up to 12 of which an item holds two) are
laid over the document at steps of half a width, and over the items at every word, so that a
held passage always has windows that begin at the same word as one of the item's. Wider ones
would hold too many edits each: a longer item has more windows instead. A window is
embedded by a random walk: at each step the current word is put out, and a random bit of
step and word tells whether to go on to the next one. Few edits then change few outputs, so
a few sampled outputs agree with good probability. This is repeated with new bits and
samples, for each class as often as it takes to find a share of `recall` of the items that are
held with as many edits as are allowed; trials on the shortest items of the class tell. An
agreement is only a candidate: the whole item is then compared with the stretch around it,
exactly.

The benchmark is a query set: it is taken in blocks of bounded size, each of which every
document meets in place. Documents are not shuffled. Null and empty texts hold nothing, and
items without words are never found. A repeated item id is an item each time; a match names
the id. Rows of documents may repeat; other columns are left as they are.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import repeat
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole
from driftmon.session import written

SHARE = 0.2  # edits allowed, as a share of the item's words
RECALL = 0.99  # of the items held with `SHARE` edits, in each size class
SAMPLES = 6  # outputs that must agree in one repetition of the embedding
WIDTHS = (1, 2, 3, 6, 12)  # of windows, by size class
TRIALS, MOST_ROUNDS = 2000, 1000  # edited items a class is tried on; more rounds are refused
BLOCK_WORDS = 100_000  # of the benchmark, taken at once
CHUNK_WORDS = 100_000  # of documents, embedded at once
_BLANK = bytes.maketrans(punctuation.encode(), b" " * len(punctuation))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_BLANK).split()


def _width(n: int) -> int:
    """The size class of an item of n words: the widest windows of which it holds two."""
    return max((w for w in WIDTHS if 2 * w <= n), default=1)


def _step(width: int) -> int:
    return max(1, width // 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


@dataclass
class Walk:
    """One repetition for windows of one width: sampled steps, bits by step and word."""

    width: int
    steps: np.ndarray  # sampled steps, ascending
    bits: np.ndarray  # [step, word]: go on or stay

    @classmethod
    def drawn(cls, rng: np.random.Generator, width: int, samples: int, words: int) -> "Walk":
        """A walk over words numbered up to `words`; 0 is what no item has."""
        top = 2 * width
        steps = np.sort(rng.choice(top, min(samples, top), replace=False))
        bits = rng.integers(0, 2, (top, words + 1), np.int32)
        bits[:, 0] = rng.integers(0, 2, top)
        return cls(width, steps, bits)

    def keys(self, ids: np.ndarray, starts: np.ndarray, allowed: list[np.ndarray] | None):
        """(starts, key) of the windows whose outputs agree with some item's, sample by sample.

        `allowed` holds, for each sample, a bitmap of the keys that items have there. Windows
        without a word there are left out as soon as it shows: they cannot agree any more.
        """
        at, alive = starts.copy(), np.arange(len(starts))
        key = np.zeros(len(starts), np.uint64)
        step = 0
        for k, sample in enumerate(self.steps.tolist()):
            while step < sample:
                at += self.bits[step][ids[at]]
                step += 1
            ended = at >= starts[alive] + self.width
            word = np.where(ended, 0, ids[np.minimum(at, len(ids) - 1)])
            with np.errstate(over="ignore"):
                key = _mixed(key * np.uint64(31) + word.astype(np.uint64) + np.uint64(k + 1))
            good = (word > 0) | ended
            if allowed is not None:
                good &= allowed[k][(key & np.uint64(len(allowed[k]) - 1)).astype(np.int64)]
            alive, at, key = alive[good], at[good], key[good]
        return alive, key


def _trial(rng: np.random.Generator, width: int, n: int, edits: int, words: int):
    """Items of n words and documents that hold them edited: (ids, starts, item) of both's windows."""
    items = rng.integers(1, words, (TRIALS, n))
    kind = np.zeros((TRIALS, n), np.int64)  # substituted, deleted, or followed by another word
    kind[:, :edits] = rng.integers(1, 4, (TRIALS, edits))
    kind = rng.permuted(kind, axis=1)
    around = 2 * width
    times = np.pad(np.choose(kind, (1, 1, 0, 2)), ((0, 0), (around, around)), constant_values=1)
    # A document begins at any word before the item, so that the windows' steps meet it anywhere.
    times[:, :around] = np.arange(around) >= rng.integers(0, around + 1, TRIALS)[:, None]
    text = rng.integers(1, words, (TRIALS, n + 2 * around))
    text[:, around:-around] = np.where(kind == 1, text[:, around:-around], items)
    ids = np.repeat(text.ravel(), times.ravel())
    again = np.repeat((times == 2).ravel(), times.ravel())
    second = again & (np.cumsum(again) % 2 == 0)
    ids[second] = rng.integers(1, words, second.sum())
    sizes = times.sum(axis=1)
    many = -(-sizes // _step(width))
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(np.cumsum(sizes) - sizes, many) + nth * _step(width)
    own = (np.arange(TRIALS)[:, None] * (n + around) + np.arange(max(1, n - width + 1))).ravel()
    flat = np.pad(items, ((0, 0), (0, around))).ravel()
    docs = np.append(ids, np.zeros(around, np.int64)), at, np.repeat(np.arange(TRIALS), many)
    return (flat, own, np.repeat(np.arange(TRIALS), max(1, n - width + 1))), docs


@lru_cache(maxsize=64)
def rounds_for(width: int, share: float, samples: int, recall: float) -> int:
    """Repetitions that find `recall` of a class's items held with `share` edits.

    Tried on the shortest length and the next two that allow one edit more: within a class
    these have the fewest windows for their edits. Two standard errors are added.
    """
    if not 0 < recall < 1:
        raise ValueError("recall must lie between 0 and 1")
    least = min(recall + 2 * (recall * (1 - recall) / TRIALS) ** 0.5, 1 - 1 / TRIALS)
    shortest = 1 if width == 1 else 2 * width
    lengths = [n for n in range(shortest, 8 * width) if _width(n) == width]
    lengths = [n for n in lengths if n == shortest or int(share * n) > int(share * (n - 1))][:3]
    words, most = 5000, 1
    for n in lengths:
        if int(share * n) == 0:
            continue  # copies word for word agree always
        rng = np.random.default_rng(n)
        (flat, own, item), (ids, at, doc) = _trial(rng, width, n, int(share * n), words)
        found, rounds = np.zeros(TRIALS, bool), 0
        while found.mean() < least:
            if rounds == MOST_ROUNDS:
                raise ValueError(f"no {recall} of items of {n} words with {share} edits in {rounds} rounds")
            walk = Walk.drawn(rng, width, samples, words)
            alive, key = walk.keys(flat, own, None)
            there, seen = walk.keys(ids, at, None)
            with np.errstate(over="ignore"):
                mine = _mixed(key + item[alive].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                theirs = _mixed(seen + doc[there].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            found[doc[there][np.isin(theirs, mine)]] = True
            rounds += 1
        most = max(most, rounds)
    return most


class Block:
    """Part of the benchmark with its walks and the keys of all its windows."""

    def __init__(self, items: tuple, share: float, rounds: tuple[int, ...], samples: int):
        """`rounds` are given for each of WIDTHS."""
        self.made_of = (items, share, rounds, samples)
        split = [(key, words_of(text)) for key, text in items]
        self.items = [(key, words) for key, words in split if words]
        self.share = share
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, ws in self.items for w in ws}))}
        self.ids = [np.array([self.vocabulary[w] for w in ws], np.int32) for _, ws in self.items]
        self.wants = [np.unique(i, return_counts=True) for i in self.ids]
        self.limits = [int(share * len(ws)) for _, ws in self.items]
        rng = np.random.default_rng(7)
        self.tables = []
        for width in sorted({_width(len(i)) for i in self.ids}):
            own = [k for k, ids in enumerate(self.ids) if _width(len(ids)) == width]
            flat = np.concatenate([np.append(self.ids[k], np.zeros(2 * width, np.int32)) for k in own])
            item, offset, start, base = [], [], [], 0
            for k in own:
                n = len(self.ids[k])
                many = max(1, n - width + 1)
                item.append(np.full(many, k))
                offset.append(np.arange(many))
                start.append(base + np.arange(many))
                base += n + 2 * width
            item, offset, start = map(np.concatenate, (item, offset, start))
            for _ in range(rounds[WIDTHS.index(width)]):
                walk = Walk.drawn(rng, width, samples, len(self.vocabulary))
                self.tables.append((walk, *self._table(walk, flat, start, item, offset)))

    def __reduce__(self):
        return _block, self.made_of  # tasks get the items and embed them themselves, once

    @staticmethod
    def _table(walk: Walk, flat: np.ndarray, start: np.ndarray, item: np.ndarray, offset: np.ndarray):
        room = 1 << max(12, int(len(start) * 4).bit_length())
        allowed = []
        for k in range(1, len(walk.steps) + 1):
            _, key = Walk(walk.width, walk.steps[:k], walk.bits).keys(flat, start, None)
            bitmap = np.zeros(room, bool)
            bitmap[(key & np.uint64(room - 1)).astype(np.int64)] = True
            allowed.append(bitmap)
        alive, key = walk.keys(flat, start, None)
        order = np.argsort(key, kind="stable")
        return allowed, key[order], item[alive][order], offset[alive][order]

    def candidates(self, ids: np.ndarray, starts: dict[int, np.ndarray]) -> set[tuple[int, int]]:
        """(item, word where the item would begin) of every agreement."""
        out: set = set()
        for walk, allowed, keys, item, offset in self.tables:
            at = starts[walk.width]
            alive, key = walk.keys(ids, at, allowed)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            n = high - low
            row = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.update(zip(item[row].tolist(), (np.repeat(at[alive], n) - offset[row]).tolist()))
        return out

    def check(self, ids: np.ndarray, k: int, begin: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best stretch of words [low, high) near `begin`, if close enough."""
        item, most = self.ids[k], self.limits[k]
        n = len(item)
        a, b = max(low, begin - most), min(high, begin + n + most)
        part = ids[a:b]
        if low <= begin and begin + n <= high and (ids[begin : begin + n] == item).all():
            return 0, begin, begin + n
        # The stretch must share all but `most` of the item's words with it.
        have = np.bincount(part, minlength=len(self.vocabulary) + 1)
        words, counts = self.wants[k]
        shared = np.minimum(counts, have[words]).sum()
        if shared < n - most:
            return None
        edits, start, end = nearest(item, part)
        return (edits, a + start, a + end) if edits <= most else None


@lru_cache(maxsize=1)
def _block(*made_of) -> Block:
    return Block(*made_of)


def nearest(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of `part` closest to all of `item`; the first of equals."""
    m = len(part)
    cost, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    ramp = np.arange(m + 1)
    for i, word in enumerate(item.tolist(), 1):
        new = np.empty(m + 1, np.int64)
        new[0] = i
        new[1:] = np.minimum(cost[:-1] + (part != word), cost[1:] + 1)
        from_ = np.empty(m + 1, np.int64)
        from_[0] = 0
        from_[1:] = np.where(cost[:-1] + (part != word) <= cost[1:] + 1, start[:-1], start[1:])
        # Words of the part that the item lacks: a running minimum along the row.
        lead = new - ramp
        best = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == best, ramp, 0))
        cost, start = best + ramp, from_[source]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


MATCH = "array<struct<item_id:long,edits:int,item_words:int,start:long,end:long>>"
_MATCH = pa.list_(
    pa.struct(
        [("item_id", pa.int64()), ("edits", pa.int32()), ("item_words", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
    )
)


def _matches(block: Block, texts: list[str]) -> list[list[dict]]:
    """The items that each text holds, each once at its closest stretch; ends are in words."""
    found: list[list[dict]] = [[] for _ in texts]
    at, group, size = [], [], 0

    def flush():
        nonlocal group, at, size
        if group:
            _search(block, group, at, found)
        group, at, size = [], [], 0

    for i, text in enumerate(texts):
        words = words_of(text)
        if words:
            group.append(np.fromiter(map(block.vocabulary.get, words, repeat(0)), np.int32, len(words)))
            at.append(i)
            size += len(words)
        if size >= CHUNK_WORDS:
            flush()
    flush()
    return found


def _search(block: Block, group: list[np.ndarray], at: list[int], found: list[list[dict]]) -> None:
    widest = max((walk.width for walk, *_ in block.tables), default=1)
    ids = np.concatenate([*group, np.zeros(2 * widest, np.int32)])
    sizes = np.array([len(g) for g in group])
    begins = np.cumsum(sizes) - sizes
    starts = {}
    for walk, *_ in block.tables:
        step = _step(walk.width)
        many = -(-sizes // step)
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        starts[walk.width] = (np.repeat(begins, many) + nth * step).astype(np.int32)
    best: dict[tuple[int, int], tuple] = {}
    tried: set = set()
    for k, begin in sorted(block.candidates(ids, starts)):
        begin = max(begin, 0)
        doc = int(np.searchsorted(begins, min(begin + len(block.ids[k]) // 2, int(begins[-1] + sizes[-1]) - 1), "right")) - 1
        for d in {doc, int(np.searchsorted(begins, begin, "right")) - 1}:
            low, high = int(begins[d]), int(begins[d] + sizes[d])
            if (k, d) in best and best[k, d][0] == 0 or (k, begin, d) in tried:
                continue
            tried.add((k, begin, d))
            hit = block.check(ids, k, begin, low, high)
            if hit and ((k, d) not in best or hit < best[k, d]):
                best[k, d] = hit
    for (k, d), (edits, start, end) in sorted(best.items()):
        low = int(begins[d])
        found[at[d]].append(
            {
                "item_id": block.items[k][0],
                "edits": edits,
                "item_words": len(block.ids[k]),
                "start": start - low,
                "end": end - low,
            }
        )


def blocks(benchmark: DataFrame, share: float, recall: float, samples: int, item_id: str, text: str) -> Iterator[Block]:
    """The benchmark by blocks of about BLOCK_WORDS words, so what a task holds is bounded."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), whole(text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    many = size // (5 * BLOCK_WORDS) + 1
    rounds = tuple(rounds_for(width, share, samples, recall) for width in WIDTHS)
    for b in range(many):
        mine = items.where(F.pmod(F.xxhash64("id", "t"), F.lit(many)) == b)
        yield Block(tuple((r.id, r.t) for r in mine.orderBy("id", "t").collect()), share, rounds, samples)


def matches(text: str, block: Block) -> Column:
    @F.arrow_udf(MATCH)
    def held(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_matches(block, batch.to_pylist()), _MATCH)

    return held.asNondeterministic()(whole(text))  # else an explode would run it twice


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    recall: float = RECALL,
    samples: int = SAMPLES,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row per document and item it holds: doc_id, item_id, edits, item_words, start, end (in words)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = [
        rows.select("doc_id", F.explode(matches("text", block)).alias("p")).select("doc_id", "p.*")
        for block in blocks(benchmark, share, recall, samples, item_id, item_text)
    ]
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    share: float = SHARE,
    recall: float = RECALL,
    samples: int = SAMPLES,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """`docs` without the documents that hold a benchmark item, all columns as they were.

    A further block meets what the earlier ones left, from a written table, so that a task
    never holds two of them.
    """
    out = None
    for block in blocks(benchmark, share, recall, samples, item_id, item_text):
        out = (docs if out is None else written(out, "clean")).where(F.size(matches(text, block)) == 0)
    return out
