import hashlib
import random
import re

from pyspark.sql import functions as F

from driftmon.llm import structure_repair as repair
from driftmon.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def plainly(rows):
    """Counts, and the least (cost, audit) with its messages, by trying every state in turn."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    heads = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in rows]
    best = {0: (0, "", ())}

    def put(to, state, cost, audit, out):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, out)

    def fill(to):
        for _ in range(4):
            for state, (cost, audit, out) in list(to.items()):
                then = 3 if state == 2 else 2
                put(to, then, cost + 2, audit + "I", out + (("assistant" if state == 2 else "user") + ":",))

    fill(best)
    for (_, role, text), fault, head in zip(rows, faults, heads):
        after = {}
        for state, (cost, audit, out) in best.items():
            put(after, state, cost + 3, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = cost + (fault == "truncated")
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, head))
                if kept is not None:
                    put(after, kept, more, audit + "K", out + (f"{role}:{text}",))
                who = "assistant" if state == 2 else "user"
                put(after, 3 if state == 2 else 2, more + 2, audit + "R", out + (f"{who}:{text}",))
        fill(after)
        best = after
    cost, audit, out = min(best[s] for s in (0, 3) if s in best)
    turns = [r[0] for r in rows if r[0] is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def by_conversation(frame):
    out = {}
    for r in frame.select("conv_id", "turn", "role", "text").collect():
        out.setdefault(r["conv_id"], []).append((r["turn"], " " if r["role"] is None else r["role"], " " if r["text"] is None else r["text"]))
    return out


def same(frame, got):
    want = {k: plainly(v) for k, v in by_conversation(frame).items()}
    rows = {r["conv_id"]: r.asDict() for r in got.collect()}
    assert rows.keys() == want.keys()
    for key, expected in want.items():
        assert {k: rows[key][k] for k in expected} == expected, key


def odd_messages(spark, n=400, conversations=40):
    rng = random.Random(7)
    texts = ["", " \t", "Yes.", "No!", "half", "Well?  \n", "a. b", None, "Ä ß \U0001f642.", "\x0b"]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Assistant", "super"]
    rows = [
        (
            rng.choice([None, *range(conversations)]),
            rng.choice([None, *range(12)]),
            rng.choice(roles[:3] * 4 + roles),
            rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randint(0, 99)}{rng.choice(['.', ''])}",
        )
        for _ in range(n)
    ]
    rows += rows[:60]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_equals_trying_every_state(spark):
    frame = odd_messages(spark)
    same(frame, repair.repair_conversations(frame))


def test_long_conversations_in_blocks(spark):
    frame = odd_messages(spark, 600, 3)
    same(frame, repair.repair_conversations(frame, levels=(2, 4, 5)))
    same(frame, repair.repair_conversations(frame, levels=(1, 33)))


def test_given_conversations_damaged(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    frame = damaged(conversations)
    same(frame, repair.repair_conversations(frame))


def test_prices_are_least_costs_for_every_node():
    rng = random.Random(1)
    for _ in range(200):
        symbols = "".join(rng.choice("suaxSUAX1234") for _ in range(rng.randint(1, 30)))
        arcs = [repair.message_arcs(s) for s in symbols]
        for leave in (None, 0, 1, 2, 3):
            lattice = repair.Lattice(arcs, leave)
            for place, prices in enumerate(lattice.prices[:-1]):
                for state, price in enumerate(prices):
                    offers = [c + lattice.prices[place + step][then] for _, step, then, c in lattice.arcs[place][state]]
                    assert price == min([*offers, repair.FAR])


def test_repaired_messages_fit_the_grammar(spark):
    frame = odd_messages(spark, 300, 20)
    placed, marks = repair.faults(frame)
    steps, _ = repair.repair(marks)
    rows = repair.repaired(placed, steps).orderBy("conv_id", "at", "part").collect()
    heads = {}
    for r in rows:
        heads.setdefault(r["conv_id"], []).append(r["role"][0])
        assert r["text"] == "" if r["edit"] == "I" else r["text"].strip()
    assert all(re.fullmatch("s?(ua)+", "".join(h)) for h in heads.values())


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(none).count() == 0
    frame = odd_messages(spark, 60, 5)
    for name in "at fault symbol letters made b p of said last first kind copy start enter".split():
        frame = frame.withColumn(name, F.lit("x"))
    same(frame, repair.repair_conversations(frame))


def test_conversations_without_messages_have_zeros(spark):
    all_ids = spark.createDataFrame([(1,), (None,)], "conv_id long")
    rows = repair.repair_conversations(spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA))
    got = {r["conv_id"]: r for r in repair.with_all(all_ids, rows).collect()}
    assert (got[1]["cost"], got[1]["audit"]) == (2, "KI")
    assert (got[None]["cost"], got[None]["audit"]) == (0, "")
    assert got[None]["repaired_sha256"] == hashlib.sha256().hexdigest()


def test_long_text_and_copies_of_one_message(spark):
    rows = [(1, 0, "user", "word " * 200_000 + ".")] + [(1, 0, "user", "again.")] * 3000
    frame = spark.createDataFrame(rows, SCHEMA)
    same(frame, repair.repair_conversations(frame, levels=(8, 33)))
