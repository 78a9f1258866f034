import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given as holds_for
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from driftmon.llm import packing, token_counts
from driftmon.llm.queries import op2_token_counts, op8_packing
from driftmon.llm.token_counts import vocabulary

ODD = ["", " ", "a  b ", " a\n\nb", "▁x▁", "é 日本 12345\t", "</s> <0x0A>", "a" * 3000, "\U0001f642\U0001f642 x"]
ODD += ["x<|endoftext|>y <|endoftext|>", "<|endoftext|>", "a \n b", "a  b", "it's we'll  I'm", " x y", "x:,. y!! (z)"]
EXACT = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
TEXT = st.text(st.sampled_from("ab cA.\n\t'1é▁ !<|>"), max_size=60)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(token_counts.MODEL))


@pytest.fixture(scope="module")
def bytes_bpe():
    return EXACT


def ids_of(text):
    return np.frombuffer(packing.encoder("byte_bpe_50k.tiktoken").ids(text), "<u4").tolist()


def test_counts_equal_the_library(spark, sf_dir, given, pieces):
    want = {
        (d, len(t.encode()), n := len(pieces.encode(t)), n > 4096)
        for d, t in ((d, t or "") for d, t in given("documents", "doc_id, text"))
    }
    assert {tuple(r) for r in op2_token_counts(spark, sf_dir).collect()} == want


def test_shortcut_words_are_one_token(pieces):
    counter = token_counts.counter(vocabulary(token_counts.MODEL))
    assert len(counter.whole) > 10_000
    assert all(len(pieces.encode("\n" + w)) == 3 for w in list(counter.whole)[::97])


@settings(max_examples=300, deadline=None)
@holds_for(TEXT)
def test_any_text_counts_and_encodes_as_the_libraries_do(text):
    model = token_counts.counter(vocabulary(token_counts.MODEL))
    assert model.counts([text]) == [len(model.model.encode(text))]
    assert ids_of(text) == EXACT.encode(text, add_special_tokens=False).ids


def test_odd_texts(odd, pieces, bytes_bpe):
    model = token_counts.counter(vocabulary(token_counts.MODEL))
    assert model.counts(ODD) == [len(pieces.encode(t)) for t in ODD]
    for text in ODD:
        assert ids_of(text) == bytes_bpe.encode(text, add_special_tokens=False).ids
    got = token_counts.token_counts(odd).collect()
    assert len(got) == odd.count()
    assert {r.n_tokens for r in got if r.doc_id in (3, 4)} == {0}


def check_packing(rows, texts, bytes_bpe, length=1024):
    """Every id of every document lies in one piece, and sequences are gapless."""
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = [*bytes_bpe.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
    return len(sequences) * length


def test_packing(spark, sf_dir, given, bytes_bpe):
    rows = op8_packing(spark, sf_dir).collect()
    texts = dict(given("documents", "doc_id, text"))
    room = check_packing(rows, texts, bytes_bpe)
    assert sum(r.length for r in rows) / room > 0.98


def test_packing_odd_rows(odd, bytes_bpe):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(docs).collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, bytes_bpe)
    assert packing.pack_documents(odd).selectExpr("sum(length)").first()[0] > sum(r.length for r in rows)
    ids = packing.pack_documents(docs, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in ids)


def test_packing_nothing(none):
    assert packing.pack_documents(none).count() == 0


@settings(max_examples=60, deadline=None)
@holds_for(st.lists(st.integers(1, 20), max_size=60))
def test_first_fit_takes_the_first_bin_with_room(sizes):
    sizes = np.sort(np.array(sizes, np.int64))[::-1]
    bins, offsets = packing.first_fit(sizes, 20)
    room = []
    for size, b, offset in zip(sizes, bins, offsets):
        want = next((i for i, r in enumerate(room) if r >= size), len(room))
        if want == len(room):
            room.append(20)
        assert (b, offset) == (want, 20 - room[want])
        room[want] -= size
