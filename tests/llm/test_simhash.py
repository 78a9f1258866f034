import random

import numpy as np
import pytest
import xxhash

from driftmon.llm import simhash
from driftmon.llm.components import components, forest
from driftmon.llm.queries import op6_simhash


def plain_fingerprint(text: str, size: int = 4) -> int:
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict) -> dict:
    """Smallest id reachable over links of at most four bits, all pairs compared."""
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                a_, b_ = sorted((find(a), find(b)))
                root[b_] = a_
    return {d: find(d) for d in ids}


def test_query_equals_brute_force(spark, sf_dir, given):
    prints = {d: plain_fingerprint(t) for d, t in given("documents", "doc_id, text")}
    roots = plain_components(prints)
    want = {(d, f"{p:016x}", roots[d]) for d, p in prints.items()}
    assert {tuple(r) for r in op6_simhash(spark, sf_dir).collect()} == want


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 7])
def test_every_pair_within_the_limit_meets(spark, max_bits):
    """Anchors lose no link, with cells split or not."""
    rng = random.Random(max_bits)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(4):
            flips = rng.sample(range(64), rng.randrange(0, max_bits + 2))
            prints.add(base ^ sum(1 << f for f in flips))
    values = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
    a, b = np.nonzero(np.triu(near, 1))
    want = set(zip(*(x.tolist() for x in forest(values[a].view(np.int64), values[b].view(np.int64)))))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for cell in (simhash.CELL, 3):
        got = simhash.links(frame, max_bits, cell).toPandas()
        got = set(zip(*(x.tolist() for x in forest(got.a.to_numpy(), got.b.to_numpy()))))
        assert got == want


def test_anchors_cover_and_reach():
    anchors = simhash.Anchors(4)
    prints = np.random.default_rng(2).integers(0, 2**63, 50).astype(np.uint64)
    homes = 0
    for (low, high), (anchor, index, home) in zip(anchors.spans, anchors.of(prints)):
        word = (prints >> np.uint64(low) & np.uint64((1 << high - low) - 1)).astype(np.int64)
        away = np.bitwise_count((anchor & 0xFFFFFFFF) ^ word[index])
        assert away.max() == 2 and away[home].max() <= 1
        homes += home.sum()
    assert homes == 3 * len(prints)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1005, 1006), (1005, 1005)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 201)} | {(1000 + i, 1000) for i in range(1, 300)}


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.id: r for r in rows}
    assert by[3].fp == by[4].fp == by[5].fp == 0
    assert by[6].component_id == by[7].component_id == 6
    assert by[9].component_id == 9
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.root for r in rows})
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0
