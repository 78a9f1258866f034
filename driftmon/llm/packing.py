"""Packing documents into sequences by first-fit decreasing over a tournament tree.

Each document becomes its token ids and an end id, cut into full pieces of the sequence
length and a remainder. A full piece is a sequence. Remainders are dealt at random into
groups of bounded size; each group is packed on its own: longest first, each into the first
sequence with room, which a tournament tree over the free room finds in log time.

Null and empty texts are one end id. Repeated rows and null ids are documents like any
other. Only id and text are read.
"""

import base64
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole
from driftmon.llm.token_counts import vocabulary
from driftmon.session import written

LENGTH, END = 1024, 0
GROUP = 20_000  # remainders packed together, on average
CACHE = 400_000  # words remembered by a process; a bound on memory, not on the ids
MARKS = "!#$%&()*,-./:;?@_|"
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit numbers, little-endian."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class Encoder(dict):
    """Text to ids (little-endian unsigned 32-bit), as the byte-level BPE file gives them.

    A space between two other characters that are not white space always begins a new
    pre-token, so the words between such spaces encode independently; each distinct word is
    merged once while it is in the cache. The rank file holds the same vocabulary as the
    tokenizer file; its special token, which that file knows in any text, is cut out first.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import regex
        import tiktoken

        lines = open(vocabulary(name), "rb").read().split(b"\n")
        ranks = {base64.b64decode(k): int(v) for k, v in (line.split() for line in lines if line)}
        merges = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._ranks = ranks
        self._tails: dict[str, bytes] = {}  # short runs of MARKS
        self._encode, self._one = merges.encode_ordinary, merges._core_bpe.encode_single_piece
        self._spaced = regex.compile(r"\s\s|^\s|\s$")
        self._split = regex.compile(r"(?<=\S) (?=\S)").split

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(MARKS)
        if stem.isalpha() and max(stem) < "\u0250":  # letters are one pre-token, the marks after them another
            if stem != word:
                return self[stem] + self._tail(word[len(stem) :])
            ids = packed(self._one(f" {word}".encode()))
        else:
            ids = packed(self._encode(" " + word))
        if len(self) > CACHE:
            self.clear()
        if len(word) < 100:
            self[word] = ids
        return ids

    def _tail(self, marks: str) -> bytes:
        ids = self._tails.get(marks)
        if ids is None:
            ids = packed(self._encode(marks))
            if len(marks) < 5:
                self._tails[marks] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        words = self._split(text) if self._spaced.search(text) else text.split(" ")
        first = packed(self._encode(words[0]))
        return first + b"".join(map(self.__getitem__, words[1:]))

    def spaced(self, text: str) -> bytes:
        """Ids of a space and the text, in which the special token's string is ordinary text."""
        if self._spaced.search(text):
            return self._plain(" " + text)
        return b"".join(map(self.__getitem__, text.split(" ")))

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        out = [SPECIAL.encode()] * (max(SPECIAL_ID, *self._ranks.values()) + 1)
        for token, i in self._ranks.items():
            out[i] = token
        return out

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if SPECIAL not in text:
            return self._plain(text)
        special = packed([SPECIAL_ID])
        return special.join(self._plain(part) if part else b"" for part in text.split(SPECIAL))


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    return Encoder(name)


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, lot long, ids binary"


def pieces(
    docs: DataFrame,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    ranks: str = "byte_bpe_50k.tiktoken",
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: its document's id, where it starts, its ids, and a random lot."""
    schema = PIECE if with_ids else PIECE.removesuffix(", ids binary")
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks).ids
        end = packed([END])
        # Written before it is used: a lost task draws the same lots again.
        lots = np.random.default_rng(TaskContext.get().partitionId())
        step = 4 * length
        for batch in batches:
            out = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body) + end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    row = (key, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4)
                    out.append(row + (part,) if with_ids else row)
            columns = [list(c) for c in zip(*out)] if out else [[] for _ in names[:-1]]
            columns.insert(5, lots.integers(0, 1 << 62, len(out)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, columns)], names
            )

    return docs.select(F.col(doc_id).cast("long"), whole(text)).mapInArrow(cut, schema)


def first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size; sizes come in decreasing order, none over the capacity.

    `tree` is a complete binary tree in an array: leaves hold the room of the bins, inner
    nodes the larger room of their two children. The leftmost leaf with room is found by
    going down from the root. The tree doubles when every bin in it has been opened.
    """
    width = 1
    tree = [0, capacity]
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for k, size in enumerate(sizes.tolist()):
        if tree[1] < size:
            tree = _grown(tree, width, capacity)
            width *= 2
        node = 1
        while node < width:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[k], offsets[k] = node - width, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins, offsets


def _grown(tree: list[int], width: int, capacity: int) -> list[int]:
    leaves = tree[width:] + [capacity] * width
    out = [0] * (2 * width) + leaves
    for node in range(2 * width - 1, 0, -1):
        out[node] = max(out[2 * node], out[2 * node + 1])
    return out


def pack(cut: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """`cut` (length, lot and any other columns) with sequence_id and offset instead of lot.

    `cut` must be a written table: its lots are random.
    """
    groups = cut.where(F.col("length") < length).count() // group + 1
    names = [c for c in cut.columns if c != "lot"]
    keep = [F.col(f"`{c}`") for c in names]
    # Ids: full pieces count down from -1 by row, groups count up inside ranges of their own.
    full = cut.where(F.col("length") >= length).select(
        *keep, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    span = 1 << 32

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "lot"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit(pdf["length"].to_numpy(), length)
        base = int(pdf["group"].iloc[0]) * span
        return pdf.drop(columns=["lot", "group"]).assign(sequence_id=base + bins, offset=offsets)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "lot")
    rest = (
        cut.where(F.col("length") < length)
        .withColumn("group", F.col("lot") % groups)
        .groupBy("group")
        .applyInPandas(packed, f"{schema}, sequence_id long, offset long")
    )
    return full.unionByName(rest)


def pack_documents(
    docs: DataFrame,
    length: int = LENGTH,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids on request)."""
    return pack(written(pieces(docs, length, doc_id, text, with_ids=with_ids), "pieces"), length)
