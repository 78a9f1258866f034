"""Alignment of two tokenizers over the same text, by divide and conquer at shared cuts.

Both tokenizers' tokens cover the bytes of a text. A byte offset where a token of each ends is
a cut. Within an interval the cut nearest its middle is found by bisecting one tokenizer's
ends for the other's, and both halves go the same way; an interval without a cut inside is a
leaf group. All intervals of a batch are halved together, level by level. In a group every
overlap of two tokens is a link, and a pair of ids is counted once per document that links it.

Counts meet their documents again without a row per link: a batch of documents keeps its
distinct pairs and, packed, which of them each document has. The pairs of all batches are
summed, joined with the sums, and sent back to their batch, where the documents are totalled.

Null and empty texts have no tokens, nor have texts that the tokenizers do not give back byte
for byte (with U+2581, which one of them reads as a space): zeros and an empty digest. Such
texts link nothing. Repeated rows and null ids are documents of their own. Texts are never
cut, so a batch is as large as its longest text. Only id and text are read.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from driftmon.llm.common import whole
from driftmon.llm.packing import encoder, packed
from driftmon.llm.token_counts import SPACE, vocabulary
from driftmon.session import written

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
CACHE = 400_000  # words remembered by a process; a bound on memory, not on the ids
BREAK = "\n"  # a piece of its own beside any character
B_BITS = 16  # a pair of ids is one number: the first tokenizer's id above the second's
NEAR = 4  # steps from the middle tried for all intervals together


class PieceEncoder(dict):
    """Words and the spaces before them to ids (little-endian unsigned 32-bit). No piece holds a
    space after another character, so they encode apart; each distinct one is merged once while
    it is in the cache. A word that its pieces do not give back is counted in `lost` each time."""

    def __init__(self, name: str):
        import sentencepiece

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [p for i, p in enumerate(pieces) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or BREAK in p for p in plain):
            raise ValueError("a piece of this vocabulary crosses a space or a line break")
        self.bytes = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self._skip = len(model.encode(BREAK))
        self.lost = 0
        self._word = re.compile(" +[^ ]*").findall

    def __missing__(self, word: str) -> bytes:
        pieces = self.model.encode(BREAK + word)[self._skip :]
        ids = packed(pieces)
        if b"".join(map(self.bytes.__getitem__, pieces)) != word.encode():
            self.lost += 1
        elif len(word) < 100:
            if len(self) > CACHE:
                self.clear()
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes | None:
        """None where the pieces do not give back a space and the text."""
        before = self.lost
        ids = b"".join(map(self.__getitem__, self._word(" " + text)))
        return ids if self.lost == before and SPACE not in text else None


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, ranks: str, pieces: str):
        self.first, self.second = encoder(ranks), PieceEncoder(pieces)
        first = self.first.token_bytes()
        if not {bytes([i]) for i in range(256)} <= set(first):
            raise ValueError("a byte is no token of this vocabulary")
        self.lengths = [np.array([*map(len, b)], np.int64) for b in (first, self.second.bytes)]
        a, b = (range(len(x)) for x in self.lengths)
        # How a token is written: its id and what follows it inside and at the end of its group.
        self.shown = [f"{i}{c}" for c in ",|" for i in a] + [f"{i}{c}" for c in ",;" for i in b]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, empty where they do not give back a space and the text."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none
        b = self.second.ids(text)
        if b is None:
            return none, none
        # Byte-level ranks hold every byte, so the first tokenizer gives back any text.
        return tuple(np.frombuffer(x, "<u4").astype(np.int64) for x in (self.first.spaced(text), b))


@lru_cache(maxsize=2)
def pair(ranks: str, pieces: str) -> Pair:
    return Pair(ranks, pieces)


def shared_cuts(ea: np.ndarray, eb: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray):
    """For each tokenizer, which of its ends are ends of the other. `ea`, `eb`: ends, rising over
    all texts; `*_stops`: tokens up to the end of each text, whose ends are cuts already."""
    cut_a, cut_b = np.zeros(len(ea), bool), np.zeros(len(eb), bool)
    cut_a[a_stops - 1], cut_b[b_stops - 1] = True, True
    a0, b0 = np.r_[0, a_stops[:-1]], np.r_[0, b_stops[:-1]]
    a1, b1 = a_stops, b_stops
    while True:
        wide = (a1 - a0 > 1) & (b1 - b0 > 1)  # a single token has no end inside its interval
        a0, a1, b0, b1 = a0[wide], a1[wide], b0[wide], b1[wide]
        if not len(a0):
            return cut_a, cut_b
        middle = (a0 + a1 - 2) >> 1
        at, met = np.full(len(a0), -1), np.full(len(a0), -1)
        left = np.arange(len(a0))
        for step in range(2 * NEAR):
            away = (step + 1) // 2 * (1 if step % 2 else -1)
            there = middle[left] + away
            inside = (there >= a0[left]) & (there < a1[left] - 1)
            who, there = left[inside], there[inside]
            place = np.searchsorted(eb, ea[there])
            hit = eb[place] == ea[there]
            at[who[hit]], met[who[hit]] = there[hit], place[hit]
            left = left[at[left] < 0]
            if not len(left):
                break
        for i in left[a1[left] - a0[left] > NEAR]:  # few: no cut near the middle
            inner = ea[a0[i] : a1[i] - 1]
            place = b0[i] + np.searchsorted(eb[b0[i] : b1[i]], inner)
            hits = np.flatnonzero(eb[place] == inner)
            if len(hits):
                best = hits[np.argmin(np.abs(hits + a0[i] - middle[i]))]
                at[i], met[i] = a0[i] + best, place[best]
        found = at >= 0
        at, met = at[found], met[found]
        cut_a[at], cut_b[met] = True, True
        # Both halves side by side: intervals stay in order, and bisecting finds them in cache.
        a0, a1 = _beside(a0[found], at + 1), _beside(at + 1, a1[found])
        b0, b1 = _beside(b0[found], met + 1), _beside(met + 1, b1[found])


def _beside(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.stack((left, right), 1).ravel()


def aligned(texts: list[str], both: Pair) -> dict:
    """For each text: its tokens, groups and links, the digest of its groups; and the distinct
    (text, pair) of all, with how often each occurs."""
    tokens = [both.tokens(t) for t in texts]
    n_a, n_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
    a, b = (np.concatenate([t[k] for t in tokens] or [np.empty(0, np.int64)]) for k in (0, 1))
    ea, eb = np.cumsum(both.lengths[0][a]), np.cumsum(both.lengths[1][b])
    full = n_a > 0
    a_stops, b_stops = np.cumsum(n_a), np.cumsum(n_b)
    cut_a, cut_b = shared_cuts(ea, eb, a_stops[full], b_stops[full])
    groups = np.r_[0, np.cumsum(cut_a)]
    n_groups = groups[a_stops] - groups[a_stops - n_a]
    # Between two neighbouring ends of either tokenizer lies one overlap of one token of each;
    # an end is marked with whose token it ends: 1 the first's, 2 the second's, 3 both.
    ends = np.sort(np.r_[ea << 2 | 1 + 2 * cut_a, eb[~cut_b] << 2 | 2], kind="stable")
    past_a, past_b = ends & 1, ends >> 1 & 1
    pairs = a[np.cumsum(past_a) - past_a] << B_BITS | b[np.cumsum(past_b) - past_b]
    n_links = n_a + n_b - n_groups
    keys, times = np.unique(np.repeat(np.arange(len(texts)), n_links) << (2 * B_BITS) | pairs, return_counts=True)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_links,
        "groups_sha256": _digests(a, b, cut_a, cut_b, n_a, n_b, both),
        "text": keys >> (2 * B_BITS),
        "pair": keys & ((1 << 2 * B_BITS) - 1),
        "times": times,
    }


def _digests(a, b, cut_a, cut_b, n_a, n_b, both: Pair) -> list[str]:
    """Digests of `a1,a2|b1;a3|b2,b3`: tokens of a group, the first tokenizer's before the
    second's, groups in order. A text without tokens has an empty one."""
    size_a, size_b = (len(x) for x in both.lengths)
    before_a = np.r_[0, np.cumsum(cut_a)][:-1]  # groups before a token's own
    before_b = np.r_[0, np.cumsum(cut_b)][:-1]
    ends_a, ends_b = np.flatnonzero(cut_a) + 1, np.r_[0, np.flatnonzero(cut_b) + 1]
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + ends_b[before_a]] = a + cut_a * size_a
    if len(b):
        order[np.arange(len(b)) + ends_a[before_b]] = 2 * size_a + b + cut_b * size_b
    out, at, shown = [], 0, both.shown
    for n in (n_a + n_b).tolist():
        if n:
            text = "".join(map(shown.__getitem__, order[at : at + n].tolist()))
            out.append(hashlib.sha256(text[:-1].encode()).hexdigest())
        else:
            out.append("")
        at += n
    return out


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, byte planes apart, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


DONE = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ROW = f"chunk long, {DONE}, held binary, times binary, pairs array<long>, docs array<long>"
TOTALS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _schema(docs: DataFrame, doc_id: str, fields: str) -> StructType:
    """The id's own type, and `fields`."""
    return StructType([StructField("doc_id", docs.schema[doc_id].dataType), *StructType.fromDDL(fields).fields])


def align(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS, pieces: str = PIECES
) -> DataFrame:
    """A written table with a row per document: doc_id, its batch (`chunk`), DONE, and packed
    which of the batch's pairs it links (`held`) and how often (`times`). The first row of a
    batch has its distinct `pairs` and in how many of its `docs` each is."""
    schema = _schema(docs, doc_id, ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(ranks, pieces)
        for number, batch in enumerate(batches):
            chunk = TaskContext.get().partitionId() << 32 | number
            got = aligned(batch.column(1).to_pylist(), both)
            known, index, docs_of = np.unique(got["pair"], return_inverse=True, return_counts=True)
            stops = np.searchsorted(got["text"], np.arange(batch.num_rows + 1))
            parts = [slice(lo, hi) for lo, hi in zip(stops, stops[1:])]
            once = [known, *[None] * (batch.num_rows - 1)], [docs_of, *[None] * (batch.num_rows - 1)]
            columns = [
                batch.column(0),
                pa.array([chunk] * batch.num_rows, pa.int64()),
                *[pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                pa.array(got["groups_sha256"], pa.string()),
                *[pa.array([pack(x[p]) for p in parts], pa.binary()) for x in (index, got["times"])],
                *[pa.array(x[: batch.num_rows], pa.list_(pa.int64())) for x in once],
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return written(docs.select(F.col(doc_id).alias("doc_id"), whole(text)).mapInArrow(run, schema), "aligned")


def link_counts(rows: DataFrame) -> DataFrame:
    """pair, n: the documents that link it, best: whether no pair of its first id is in more.
    There are at most as many rows as pairs of ids, whatever the corpus. A written table."""
    each = rows.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "docs")))
    sums = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")), "pairs")
    first = F.shiftright("pair", B_BITS)
    tops = sums.groupBy(first.alias("first")).agg(F.max("n").alias("top"))
    joined = sums.withColumn("first", first).join(tops, "first")
    return joined.select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def link_totals(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id and TOTALS: a document's links summed over the counts of their pairs.

    What a batch asks for, and what comes back, is a row per distinct pair of the batch.
    """
    asked = rows.where("pairs is not null").select("chunk", F.posexplode("pairs").alias("i", "pair"))
    answers = asked.join(counts, "pair").select(F.col("chunk").alias("of"), "i", "n", "best")
    schema = _schema(rows, "doc_id", TOTALS)

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        place = right.column("i").to_numpy()
        n, best = np.zeros(size, np.int64), np.zeros(size, bool)
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy()
        n_best, sums = [], []
        for held, times in zip(left.column("held").to_pylist(), left.column("times").to_pylist()):
            index, often = unpack(held), unpack(times)
            n_best.append(int(often[best[index]].sum()))
            sums.append(int((often * n[index]).sum()))
        return pa.table(
            {
                **{c: left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                "n_best": pa.array(n_best, pa.int64()),
                "count_sum": pa.array(sums, pa.int64()),
                "groups_sha256": left.column("groups_sha256"),
            }
        )

    kept = rows.drop("pairs", "docs")
    return kept.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(total, schema)


def token_alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and TOTALS for every document."""
    rows = align(docs, doc_id, text)
    return link_totals(rows, link_counts(rows))
