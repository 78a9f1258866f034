import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftmon.llm import token_align as align
from driftmon.llm.common import prepare

ODD = [
    "", "x", " ", "  a  b", "a <|endoftext|> b", "</s> <s> <unk>", "▁x", "Ä ß € \U0001f642", "\n  b \n\n c\t\td  ",
    "a b", "é" * 300, "<0x41>", "a" * 5000, "\x00x", "x " * 3, "\r\n a",
]


@pytest.fixture(scope="module")
def libraries():
    """The tokenizers themselves, with the bytes of their tokens."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(align.PIECES))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def of_first(i):
        return bytes(letters[c] for c in first.id_to_token(i))

    def of_second(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        return [(i, of_first(i)) for i in a], [(i, of_second(i)) for i in b]

    return tokens


def plainly(text, tokens):
    """Tokens, groups, links with their counts, and the digest, from byte spans."""
    a, b = tokens(text) if text else ([], [])
    body = b" " + (text or "").encode()
    if not text or any(b"".join(x for _, x in side) != body for side in (a, b)):
        return 0, 0, 0, 0, "", Counter()

    def spans(side):
        stops = np.cumsum([len(x) for _, x in side]).tolist()
        return [(i, stop - len(x), stop) for (i, x), stop in zip(side, stops)]

    a, b = spans(a), spans(b)
    cuts = sorted({s for *_, s in a} & {s for *_, s in b})
    sides = []
    for side in (a, b):
        groups, rest = [], iter(side)
        for cut in cuts:
            own = []
            while not own or own[-1][2] < cut:
                own.append(next(rest))
            groups.append(",".join(str(i) for i, *_ in own))
        sides.append(groups)
    groups = map("|".join, zip(*sides))
    links, j = Counter(), 0
    for i, lo, hi in a:
        while b[j][2] <= lo:
            j += 1
        k = j
        while k < len(b) and b[k][1] < hi:
            links[i, b[k][0]] += 1
            k += 1
    return len(a), len(b), len(cuts), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def batch(texts):
    got = align.aligned(texts, align.pair(align.RANKS, align.PIECES))
    for i in range(len(texts)):
        mine = got["text"] == i
        links = {(p >> 16, p & 65535): n for p, n in zip(got["pair"][mine].tolist(), got["times"][mine].tolist())}
        yield (*(int(got[c][i]) for c in ("n_a", "n_b", "n_groups", "n_links")), got["groups_sha256"][i], links)


def test_batches_equal_byte_spans(libraries, given):
    rng = random.Random(1)
    noise = ["".join(rng.choice("ab é€\n \t.,1'<>|▁\U0001f600ñ中 ") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts = [t or "" for _, t in given("documents", "doc_id, text")][:120]
    for some in (ODD, noise, texts, [], [""]):
        assert list(batch(some)) == [plainly(t, libraries) for t in some]


def test_cuts_are_all_shared_ends():
    rng = np.random.default_rng(3)
    for n in (1, 2, 10, 200, 3000):
        for share in (0.02, 0.3, 0.9):
            total = 4 * n
            ea, eb = (np.unique(np.r_[rng.choice(np.arange(1, total), n, replace=False), total]) for _ in range(2))
            if share < 0.1:
                eb = np.r_[np.setdiff1d(eb, ea), total]  # no shared end but the last
            cut_a, cut_b = align.shared_cuts(ea, eb, np.array([len(ea)]), np.array([len(eb)]))
            assert set(ea[cut_a]) == set(eb[cut_b]) == set(ea) & set(eb)


def test_packed_numbers_come_back():
    for numbers in ([], [0], [5, 1 << 31, 255, 256]):
        assert align.unpack(align.pack(np.array(numbers, np.int64))).tolist() == numbers


def expected(texts, tokens):
    rows = [plainly(t, tokens) for t in texts]
    docs = Counter(p for r in rows for p in r[5])
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(n, top.get(a, 0))
    for n_a, n_b, groups, n_links, sha, links in rows:
        best = sum(m for p, m in links.items() if docs[p] == top[p[0]])
        yield n_a, n_b, groups, n_links, best, sum(m * docs[p] for p, m in links.items()), sha


def test_totals_over_several_batches(spark, libraries, given):
    rows = [(i, t) for i, t in given("documents", "doc_id, text")] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    rows += [(10**7, None)] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(tuple(r) for r in align.token_alignment(docs).collect())
    finally:
        prepare(spark)
    want = sorted((i, *w) for (i, _), w in zip(rows, expected([t for _, t in rows], libraries)))
    assert got == want


def test_odd_and_empty_tables(spark, odd, none, libraries):
    rows = odd.select("doc_id", "text").collect()
    got = align.token_alignment(odd)
    assert got.columns[0] == "doc_id" and got.count() == len(rows)
    want = expected([r["text"] for r in rows], libraries)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((r["doc_id"], *w) for r, w in zip(rows, want)), key=key)
    assert align.token_alignment(none).count() == 0
    named = odd.where("doc_id is not null").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert align.token_alignment(named).count() == named.count()
