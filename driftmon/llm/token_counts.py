"""Token counts by a sentencepiece BPE model, with a whole-token shortcut.

Offline, once per process, the vocabulary tells

* that no piece holds a space after another character. So no merge crosses a space, and a
  text is counted one pre-token (a run of spaces and the word after it) at a time;
* which pieces encode alone as one token. A pre-token equal to one of them counts as one.

All other pre-tokens go through the model's merges, once for each distinct one while it is in
the cache. Null and empty texts have no tokens.
"""

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole

SPACE = "\u2581"  # the model writes a space so, and reads this character as a space
BREAK = "\n"  # no piece holds it beside another character
CACHE = 300_000  # pre-tokens remembered by a process; a bound on memory, not on the counts
MODEL = "piece_bpe_32k.model"


class Counter:
    """Counts as `len(model.encode(text))` does."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [i for i in range(self.model.vocab_size()) if not self._reserved(i)]
        pieces = [self.model.id_to_piece(i) for i in own]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece of this vocabulary crosses a space")
        probes = {"a  b ": ["\u2581a", "\u2581", "\u2581b", "\u2581"], "": [], "\ufb01": None}
        for text, want in probes.items():
            got = self.model.encode(text, out_type=str)
            if want is not None and got != want or "".join(got).replace(SPACE, "") != text.replace(" ", ""):
                raise ValueError("this model normalises texts; its words cannot be counted apart")
        if any(BREAK in p for p in pieces):
            raise ValueError("a piece of this vocabulary crosses a line break")
        # Spaces stay spaces in the keys: " word" is the piece "\u2581word".
        starts = [p.replace(SPACE, " ") for p in pieces if p.startswith(SPACE)]
        self.whole = {p for p, n in zip(starts, self._merged(starts)) if n == 1}
        self._seen: dict[str, int] = dict.fromkeys(self.whole, 1)
        self._word = re.compile(" +[^ ]*")

    def _reserved(self, i: int) -> bool:
        m = self.model
        return m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)

    def _merged(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token. The model puts a space in front itself; a line break,
        which merges with nothing, keeps it away from the word: two tokens more."""
        return [len(ids) - 2 for ids in self.model.encode([BREAK + w for w in words], num_threads=1)]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; what the shortcut leaves is merged for all texts at once."""
        seen, totals, rest = self._seen, [], {}
        if len(seen) > CACHE:
            seen.clear()
            seen.update(dict.fromkeys(self.whole, 1))
        for i, text in enumerate(texts):
            total = 0
            words = self._word.findall(" " + text.replace(SPACE, " ")) if text else []
            for word, n in zip(words, map(seen.get, words)):
                if n is None:
                    rest.setdefault(word, []).append(i)
                else:
                    total += n
            totals.append(total)
        for (word, where), n in zip(rest.items(), self._merged(list(rest))):
            if len(word) < 100:
                seen[word] = n
            for i in where:
                totals[i] += n
        return totals


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def n_tokens(text: str, model: str = MODEL) -> Column:
    """Tokens of a text column, without begin and end tokens."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = counter(vocabulary(model)).counts
        for batch in batches:
            yield pa.array(counts(batch.to_pylist()), pa.int64())

    return counted(whole(text))


def token_counts(
    docs: DataFrame, limit: int = 4096, doc_id: str = "doc_id", text: str = "text", model: str = MODEL
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: a row per row of `docs`, in place, no shuffle.

    Repeated rows and null ids count like any other. Only id and text are read.
    """
    counts = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(whole(text)).cast("long").alias("n_bytes"),
        n_tokens(text, model).alias("n_tokens"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
