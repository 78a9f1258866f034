"""Near duplicates by SimHash, found with covering codes as anchors.

The 64 bits of a fingerprint are cut into blocks, so many that two fingerprints within the
bit limit differ by at most one bit in some block. On each block the anchors are the words of
a covering code: a perfect code over 15 bits (covering radius one) with the block's other
bits as they are. Every fingerprint is at home at the anchor that covers it, and is sent to
every anchor within covering radius plus threshold, two bits. So of any linked pair one meets
the other at its home anchor, where all 64 bits are compared.

Only distinct fingerprints are sent. Anchors with very many are split into cells of bounded
size. A task passes on a forest of the links it found, not the pairs.

Texts without words have fingerprint zero and are linked like any other; null counts as
empty. Null ids take part, but a component is named by its smallest id that is not null.
Rows that repeat an id keep their own fingerprints. Only id and text are read.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import as_bytes, keep_rows, raw_hash
from driftmon.llm.components import components, forest
from driftmon.session import written

SHINGLE, MAX_BITS, SEED = 4, 4, 42
CODED = 15  # bits under the perfect code of each block
CELL = 50_000  # rows of an anchor compared together
PAIRS = 1 << 22  # pairs compared at once


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    pairs = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in pairs), ">u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: str, shingle: int = SHINGLE) -> Column:
    """The 64 bits as a signed long."""

    @F.arrow_udf("long")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint_of(t, shingle) for t in batch.to_pylist()], pa.int64())

    return made(as_bytes(text))


class Anchors:
    """Home and nearby anchors of fingerprints, block by block."""

    def __init__(self, max_bits: int = MAX_BITS):
        self.blocks = max(3, max_bits // 2 + 1)  # so one block differs by at most one bit
        if not 0 <= max_bits or 64 // self.blocks < CODED:
            raise ValueError("the bit limit must be from 0 to 7")
        cuts = np.linspace(0, 64, self.blocks + 1).astype(int)
        self.spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        words = np.arange(1 << CODED)
        self.syndrome = np.zeros(1 << CODED, np.int64)
        for bit in range(CODED):
            self.syndrome ^= np.where(words >> bit & 1, bit + 1, 0)
        # For each syndrome, the flips of at most two coded bits that lead to a code word.
        flips = {s: {1: [], 2: []} for s in range(CODED + 1)}
        for one in range(1, CODED + 1):
            flips[one][1].append(1 << one - 1)
        for one, two in combinations(range(1, CODED + 1), 2):
            flips[one ^ two][2].append(1 << one - 1 | 1 << two - 1)
        flips[0] = {1: [], 2: []}
        self.flips = flips

    def _masks(self, s: int, free: int) -> list[int]:
        """All flips of at most two bits of a block that lead to an anchor; the home first."""
        single = [1 << CODED + f for f in range(free)]
        if s == 0:
            return [0, *single, *(a | b for a, b in combinations(single, 2))]
        (home,) = self.flips[s][1]
        return [home, *(home | f for f in single), *self.flips[s][2]]

    def of(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, index of the fingerprint, is home), block by block; prints are unsigned."""
        for number, (low, high) in enumerate(self.spans):
            word = (prints >> np.uint64(low) & np.uint64((1 << high - low) - 1)).astype(np.int64)
            syndrome = self.syndrome[word & (1 << CODED) - 1]
            out = []
            for s in range(CODED + 1):
                own = np.flatnonzero(syndrome == s)
                masks = np.array(self._masks(s, high - low - CODED))
                anchors = word[own][:, None] ^ masks[None, :] | number << 32
                home = np.broadcast_to(np.arange(len(masks)) == 0, anchors.shape)
                out.append((anchors.ravel(), np.repeat(own, len(masks)), home.ravel()))
            yield tuple(map(np.concatenate, zip(*out)))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches together, of `rows` rows or little more, but for the last."""
    some: list = []
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
        if sum(b.num_rows for b in some) >= rows:
            yield some
            some = []
    if some:
        yield some


def _in_batches(prints: DataFrame, step, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(batches, 1 << 14):
            values = np.concatenate([b.column(0).to_numpy() for b in some]).view(np.uint64)
            for columns in step(values):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    return prints.select("fp").mapInArrow(run, schema)


def _crowded(prints: DataFrame, anchors: Anchors, cell: int) -> dict[int, int]:
    """Into how many parts to split the rows of each anchor that has more than `cell`.

    There are at most 2 ** 18 anchors a block, so this is bounded whatever the input is.
    """

    def counted(values: np.ndarray):
        for anchor, _, _ in anchors.of(values):
            keys, n = np.unique(anchor, return_counts=True)
            yield {"anchor": keys, "n": n}

    counts = _in_batches(prints, counted, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return {r.anchor: -(-r.n // cell) for r in counts.where(F.col("n") > cell).collect()}


def _dealt(prints: DataFrame, anchors: Anchors, parts: dict[int, int]) -> DataFrame:
    """Every fingerprint at its anchors: (anchor, cell, guest, fp); homes come first.

    A split anchor is a grid: homes go to all cells of their row, guests to all of their column.
    """
    crowded = np.array(sorted(parts), np.int64)
    split = np.array([parts[k] for k in crowded.tolist()], np.int64)

    def sent(values: np.ndarray):
        mixed = (values * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        for anchor, index, home in anchors.of(values):
            many = np.ones(len(anchor), np.int64)
            if len(crowded):
                at = np.searchsorted(crowded, anchor).clip(max=len(crowded) - 1)
                many = np.where(crowded[at] == anchor, split[at], 1)
            for guest, rows in ((False, np.flatnonzero(home)), (True, np.arange(len(anchor)))):
                n = many[rows]
                other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                rows, n = np.repeat(rows, n), np.repeat(n, n)
                own = mixed[index[rows]] % n
                cell = other * n + own if guest else own * n + other
                for a in range(0, len(rows), 1 << 17):
                    part = slice(a, a + (1 << 17))
                    yield {
                        "anchor": anchor[rows[part]],
                        "cell": cell[part],
                        "guest": np.full(len(cell[part]), guest),
                        "fp": values[index[rows[part]]].view(np.int64),
                    }

    return _in_batches(prints, sent, "anchor long, cell long, guest boolean, fp long")


def _compare(group: np.ndarray, guest: np.ndarray, fp: np.ndarray, max_bits: int):
    """Links between each home and the guests of its group; groups are runs of equal numbers."""
    homes = np.flatnonzero(~guest)
    guests = np.flatnonzero(guest)
    low = np.searchsorted(group[guests], group[homes], "left")
    count = np.searchsorted(group[guests], group[homes], "right") - low
    first = 0
    total = np.cumsum(count)
    while first < len(homes):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        n = count[first:last]
        left = np.repeat(fp[homes[first:last]], n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        right = fp[guests[np.repeat(low[first:last], n) + offset]]
        near = (np.bitwise_count(left ^ right) <= max_bits) & (left != right)
        yield left[near].view(np.int64), right[near].view(np.int64)
        first = last


def links(prints: DataFrame, max_bits: int = MAX_BITS, cell: int = CELL) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) within the bit limit."""
    anchors = Anchors(max_bits)
    parts = _crowded(prints, anchors, cell)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = [np.empty(0, np.int64), np.empty(0, np.int64)]
        held = None

        def take(rows: np.ndarray):
            if not len(rows):
                return
            change = (np.diff(rows["anchor"]) != 0) | (np.diff(rows["cell"]) != 0)
            group = np.concatenate([[0], np.cumsum(change)])
            for a, b in _compare(group, rows["guest"], rows["fp"].view(np.uint64), max_bits):
                found[0], found[1] = np.concatenate([found[0], a]), np.concatenate([found[1], b])
                if len(found[0]) > 200_000:
                    found[:] = forest(*found)

        def out():
            a, b = forest(*found)
            found[:] = [np.empty(0, np.int64), np.empty(0, np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        kind = [("anchor", np.int64), ("cell", np.int64), ("guest", bool), ("fp", np.int64)]
        for some in _gathered(batches, 1 << 16):
            rows = np.empty(sum(b.num_rows for b in some), kind)
            for i, (name, _) in enumerate(kind):
                rows[name] = np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in some])
            if held is not None:
                rows = np.concatenate([held, rows])
            same = (rows["anchor"] == rows["anchor"][-1]) & (rows["cell"] == rows["cell"][-1])
            cut = int(np.argmax(same))  # the last group may go on in the next batches
            take(rows[:cut])
            held = rows[cut:]
            if len(found[0]) > 100_000:
                yield out()
        if held is not None:
            take(held)
        yield out()

    return (
        _dealt(prints, anchors, parts)
        .repartition("anchor", "cell")
        .sortWithinPartitions("anchor", "cell", "guest")
        .mapInArrow(met, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    doc_id: str = "doc_id",
    text: str = "text",
    cell: int = CELL,
) -> DataFrame:
    """A row per document: id, raw, fp, component_id (the smallest id of its component), root."""
    rows = written(
        docs.select(F.col(doc_id).alias("id"), raw_hash(text).alias("raw"), fingerprint(text, shingle).alias("fp")),
        "fingerprints",
    )
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = components(links(prints, max_bits, cell)).select(F.col("node").alias("fp"), "root")
    named = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp")


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with one row of each component, the one with its smallest id, all columns as they were."""
    rows = near_duplicates(docs, shingle, max_bits, doc_id, text)
    same = rows.groupBy("root", "id", "raw").agg(F.count("*").alias("same"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "raw", "same")
    best = same.groupBy("root").agg(F.min(order).alias("best"))
    keepers = best.select(F.col("best.id").alias("k_id"), F.col("best.raw").alias("k_raw"), F.col("best.same").alias("k_same"))
    return keep_rows(docs, written(keepers, "keepers"), doc_id, text)
