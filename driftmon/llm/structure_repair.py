"""Repair of conversation structure as a shortest path, found by the auction algorithm.

A conversation is a lattice: a node per place between two messages and state of the grammar
`(s?(ua)+)?` over role initials, an arc per edit. Keep costs 0, rerole 2, delete 3, an empty
message put in 2; a truncated message that is not deleted costs 1 more. Each node has a price.
From an origin a path is extended along the arc with the least cost plus price, and contracted
when its end's price has to rise; it is done when it meets a node whose price is settled. With
every node as origin, last place first, prices are the costs to the end, and an arc whose cost
is the difference of its prices is tight: every cheapest path runs on tight arcs only. The
audit takes the least letter of a tight arc (D, I, K, R) at each node.

A conversation may be longer than a task should hold. Messages are sorted once over all
conversations and cut into blocks. A block alone has, for each state at its begin and at its
end, a cost and the rank of its audit; blocks of a conversation form a lattice of the same
kind one level up, and so on (LEVELS). The path on top says with which states each block is
entered and left. No task holds more than a block or a block's children; the last level has
one child per partition of the sort.

Null roles and texts count as one space; a null conversation is a conversation, a null turn
comes first. Messages of one turn are ordered by role, then text; equal ones are copies of one
another. Repeated rows are messages like any other. A role that begins with no s, u or a can
only be deleted or given another role, and so can an empty one. Texts are never cut. Only the
four columns named are read. No messages: no rows.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from driftmon.llm.common import prepare
from driftmon.session import written

TRIMMED = " \t\n\x0b\f\r"
LEVELS = (12, 22, 33)  # a block's rows, and blocks under a block, as powers of two of the place
STATES = 4  # nothing yet, after s, after u, after a
ENDS = (0, 3)
ANSWER = {0: 2, 1: 2, 2: 3, 3: 2}  # the state after a user or assistant message that fits
ROLE = {2: "user", 3: "assistant"}
INITIAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
LAWFUL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
FAR = 1 << 60  # the price of a node from which the end cannot be reached

Arc = tuple[str, int, int, int]  # label, places to go on (0 or 1), state, cost


# Symbols: a message's initial (x: any other), in capitals if truncated, a digit if it must go.
GONE = {"s": "1", "u": "2", "a": "3", "x": "4"}
CLASS = {v: k for k, v in GONE.items()}


@lru_cache(maxsize=None)
def message_arcs(symbol: str) -> tuple[tuple[Arc, ...], ...]:
    """The arcs from each state at the place before a message, least label first."""
    cut = CUT if symbol.isupper() else 0
    out = []
    for state in range(STATES):
        arcs = [("D", 1, state, DELETE), ("I", 0, ANSWER[state], INSERT)]
        if symbol not in CLASS:
            kept = INITIAL.get((state, symbol.lower()))
            arcs += [("K", 1, kept, cut)] if kept is not None else []
            arcs.append(("R", 1, ANSWER[state], REROLE + cut))
        out.append(tuple(arcs))
    return tuple(out)


def block_arcs(cost: list[int], rank: list[int]) -> tuple[tuple[Arc, ...], ...]:
    """The arcs over a whole block, from its costs and ranks by state at begin and end."""
    out = []
    for state in range(STATES):
        row = range(state * STATES, (state + 1) * STATES)
        arcs = [(str(rank[i]), 1, i % STATES, cost[i]) for i in row if cost[i] < FAR]
        out.append(tuple(sorted(arcs)))
    return tuple(out)


AFTER_LAST = tuple((("I", 0, ANSWER[s], INSERT),) for s in range(STATES))


class Lattice:
    """Places 0 to n with four states each, and arcs from all places but the last."""

    def __init__(self, arcs: list, leave: int | None):
        """`leave` is the state to end in; None: any state that may end, after insertions."""
        self.arcs = arcs if leave is not None else [*arcs, AFTER_LAST]
        n = len(arcs)
        self.prices = [[0] * STATES for _ in range(n)]
        self.settled = [[False] * STATES for _ in range(n)]
        ends = ENDS if leave is None else (leave,)
        self.prices.append([0 if s in ends or leave is None else FAR for s in range(STATES)])
        self.settled.append([s in ends or leave is not None for s in range(STATES)])
        if leave in (0, 1):  # after u or a there is no way back: all else would raise prices for ever
            for place in range(n):
                self.prices[place][2:] = FAR, FAR
                self.settled[place][2:] = True, True
        for place in range(n, -1, -1):
            if place < n:  # no way on is cheaper than the cheapest of the next place
                low = min(self.prices[place + 1])
                self.prices[place] = [max(p, low) for p in self.prices[place]]
            for state in range(STATES):
                self._auction(place, state)

    def _auction(self, place: int, state: int) -> None:
        prices, settled, path = self.prices, self.settled, [(place, state)]
        while not settled[path[-1][0]][path[-1][1]]:
            at, now = path[-1]
            least, onward = FAR, None
            for _, step, then, cost in self.arcs[at][now]:
                offer = cost + prices[at + step][then]
                if offer < least:
                    least, onward = offer, (at + step, then)
            if prices[at][now] < least:  # the price rises and the path contracts
                prices[at][now] = least
                if len(path) > 1:
                    path.pop()
            elif onward is None:
                break
            else:
                path.append(onward)
        for at, now in path:
            settled[at][now] = True

    def trace(self, state: int) -> tuple[str, list[int]]:
        """The least labels along tight arcs from `state` at the first place, and the states."""
        labels, states, at, n = [], [state], 0, len(self.prices) - 1
        while at < n or at < len(self.arcs) and not (state in ENDS):
            price = self.prices[at][state]
            label, step, state, _ = next(a for a in self.arcs[at][state] if a[3] + self.prices[at + a[1]][a[2]] == price)
            labels.append(label)
            states.append(state)
            at += step
        return "".join(labels), states


@lru_cache(maxsize=100_000)
def passages(symbols: str) -> tuple[list[int], list[int]]:
    """Of a block of messages: cost, and rank of the audit, by state at begin and end."""
    return _passages([message_arcs(s) for s in symbols])


def _passages(arcs: list) -> tuple[list[int], list[int]]:
    cost, rank = [FAR] * STATES**2, [0] * STATES**2
    audits: list[list] = [[] for _ in range(STATES)]
    for leave in range(STATES):
        lattice = Lattice(arcs, leave)
        for enter in range(STATES):
            price = lattice.prices[0][enter]
            if price < FAR:
                cost[enter * STATES + leave] = price
                audits[enter].append((lattice.trace(enter)[0], leave))
    for enter, found in enumerate(audits):
        for place, (_, leave) in enumerate(sorted(found)):
            rank[enter * STATES + leave] = place
    return cost, rank


@lru_cache(maxsize=100_000)
def edits(symbols: str, enter: int, leave: int | None) -> tuple[int, list[str], list[str]]:
    """The cost of a block, and for each of its messages the letters of the edits up to and with
    its own and the initials of the roles these give (- for none). What is put in after the
    last message is with the last one."""
    lattice = Lattice([message_arcs(s) for s in symbols], leave)
    letters, made, start = [], [], 0
    labels, states = lattice.trace(enter)
    given = [ROLE[s][0] if a in "IR" else "-" for a, s in zip(labels, states[1:])]
    for i, label in enumerate(labels):
        if label != "I":
            letters.append(labels[start : i + 1])
            made.append("".join(given[start : i + 1]))
            start = i + 1
    letters[-1] += labels[start:]
    made[-1] += "".join(given[start:])
    return lattice.prices[0][enter], letters, made


def unlawful(initials: str) -> int:
    return sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:]))


def initials(symbols: str) -> str:
    return "".join(CLASS.get(s, s.lower()) for s in symbols)


def faults(
    messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two written tables: the messages in order (conv_id, role, text, `at`), and their marks
    (conv_id, turn, at, `fault`: blank, duplicate, truncated or null, the first that holds, and
    `symbol`).

    One range sort over all conversations; a conversation with very many messages, or copies
    of one message, is spread over tasks like any other.
    """
    prepare(messages.sparkSession)
    rows = messages.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("copy", F.monotonically_increasing_id())
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "copy"]
    placed = written(rows.orderBy(*order).drop("copy").withColumn("at", F.monotonically_increasing_id()), "placed")
    last = F.right(F.rtrim("text", F.lit(TRIMMED)), F.lit(1))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    said = F.concat_ws(":", F.length(conv), conv, F.length("role"), F.col("role"), F.col("text"))
    head = F.left("role", F.lit(1))
    kind = F.when(head.isin("s", "u", "a"), head).otherwise("x").alias("kind")
    marked = placed.select("conv_id", "turn", "at", kind, last.alias("last"), F.unhex(F.sha2(said, 256)).alias("said"))
    # One row per thing said more than once; the key's messages can be split among tasks.
    first = marked.where("last != ''").groupBy("said").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("times"))
    again = first.where("times > 1").select("said", "first")
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("at") > F.col("first"), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.translate("kind", "suax", "1234"))
        .when(F.col("fault") == "truncated", F.upper("kind"))
        .otherwise(F.col("kind"))
    )
    judged = marked.join(again, "said", "left").withColumn("fault", fault).withColumn("symbol", symbol)
    return placed, written(judged.select("conv_id", "turn", "at", "fault", "symbol"), "faults")


def _mapped(df: DataFrame, schema: StructType, one) -> DataFrame:
    """`one(*row)` gives the rows that take the place of a row."""
    names = schema.names

    kinds = to_arrow_schema(schema).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [new for row in zip(*(c.to_pylist() for c in batch.columns)) for new in one(*row)]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return df.mapInArrow(run, schema)


def _schema(df: DataFrame, fields: str) -> StructType:
    """The conversation's own type, and `fields`."""
    more = StructType.fromDDL(fields)
    return StructType([StructField("conv_id", df.schema["conv_id"].dataType), *more.fields])


BLOCK = "b long, cost array<long>, rank array<long>, head string, tail string, unlawful long"
CHOICE = "b long, enter int, leave int"


def _children(blocks: DataFrame, shift: int | None) -> DataFrame:
    """Blocks of one level under their parents, in order."""
    parent = F.lit(0).cast("long") if shift is None else F.shiftright("b", shift)
    fields = F.struct("b", "cost", "rank", "head", "tail", "unlawful")
    return blocks.groupBy("conv_id", parent.alias("p")).agg(F.sort_array(F.collect_list(fields)).alias("of"))


def _met(of: list[dict]) -> int:
    return sum(c["unlawful"] for c in of) + sum(a["tail"] + b["head"] not in LAWFUL for a, b in zip(of, of[1:]))


def _join(left: DataFrame, right: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """A join on columns of one name in which null equals null."""
    there = right.withColumnsRenamed({c: f"{c}__" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}__"))
    return left.join(there, cond, how).drop(*[f"{c}__" for c in on])


def _solve_long(blocks: DataFrame, levels) -> tuple[DataFrame, DataFrame]:
    """For conversations of several blocks: the states each is entered and left in (null: the
    end of the conversation), and (conv_id, cost, illegal)."""

    def up(conv, p, of):
        cost, rank = _passages([block_arcs(c["cost"], c["rank"]) for c in of])
        yield conv, p, cost, rank, of[0]["head"], of[-1]["tail"], _met(of)

    def lowest(conv, b, symbols):
        seen = initials(symbols)
        yield conv, b, *passages(symbols), seen[0], seen[-1], unlawful(seen)

    tables = [written(_mapped(blocks, _schema(blocks, BLOCK), lowest), "blocks")]
    for low, high in zip(levels, levels[1:]):
        tables.append(written(_mapped(_children(tables[-1], high - low), _schema(blocks, BLOCK), up), "blocks"))

    def top(conv, p, of):
        lattice = Lattice([block_arcs(c["cost"], c["rank"]) for c in of], None)
        yield conv, lattice.prices[0][0], _met(of), list(_chosen(lattice, 0, None, of))

    schema = _schema(blocks, f"cost long, illegal long, picks array<struct<{CHOICE.replace(' ', ':')}>>".replace(",:", ","))
    solved = written(_mapped(_children(tables[-1], None), schema, top), "solved")
    picks = solved.select("conv_id", F.inline("picks"))
    for level in range(len(levels) - 1, 0, -1):

        def down(conv, p, of, enter, leave):
            lattice = Lattice([block_arcs(c["cost"], c["rank"]) for c in of], leave)
            for pick in _chosen(lattice, enter, leave, of):
                yield conv, *pick

        under = _children(tables[level - 1], levels[level] - levels[level - 1])
        chosen = _join(under, picks.withColumnRenamed("b", "p"), "conv_id", "p")
        picks = written(_mapped(chosen, _schema(blocks, CHOICE), down), "picks")
    return picks, solved.select("conv_id", "cost", "illegal")


def _chosen(lattice: Lattice, enter: int, leave: int | None, of: list[dict]) -> Iterator[tuple]:
    """(block, state at begin, state at end) along the path; the last block of a conversation
    also gets what is put in after it, so its end is open."""
    _, states = lattice.trace(enter)
    for i, child in enumerate(of):
        last = leave is None and i == len(of) - 1
        yield child["b"], states[i], None if last else states[i + 1]


def repair(marks: DataFrame, levels=LEVELS) -> tuple[DataFrame, DataFrame]:
    """The cheapest edits, from the marks of `faults`: (conv_id, at, letters, made) per message, and
    (conv_id, cost, illegal) per conversation. Both are written tables."""
    block = F.shiftright("at", levels[0]).alias("b")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "symbol"))), lambda x: x["symbol"]), "")
    blocks = written(
        marks.groupBy("conv_id", block).agg(F.min("at").alias("start"), joined.alias("symbols")), "lattice"
    )
    per = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    many = _join(blocks, per.where("n > 1").select("conv_id"), "conv_id").select("conv_id", "b", "symbols")
    picks, solved = _solve_long(many, levels)
    known = _join(blocks, picks, "conv_id", "b", how="left")

    def one(conv, start, symbols, enter, leave):
        alone = enter is None
        cost, letters, made = edits(symbols, 0 if alone else enter, leave)
        yield conv, cost if alone else None, unlawful(initials(symbols)) if alone else None, start, letters, made

    schema = _schema(marks, "cost long, illegal long, start long, letters array<string>, made array<string>")
    done = written(_mapped(known.select("conv_id", "start", "symbols", "enter", "leave"), schema, one), "edits")
    zipped = done.select("conv_id", "start", F.posexplode(F.arrays_zip("letters", "made")).alias("i", "e"))
    per_message = zipped.select("conv_id", (F.col("start") + F.col("i")).alias("at"), "e.letters", "e.made")
    alone = done.where("cost is not null").select("conv_id", "cost", "illegal")
    return per_message, alone.unionByName(solved)


def repaired(placed: DataFrame, steps: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, at, part, edit, role, text; (at, part) is the order.
    Messages put in have no text."""
    one = F.posexplode(F.split("letters", "")).alias("part", "edit")
    rows = placed.join(steps.drop("conv_id"), "at").select("conv_id", "at", "role", "text", "made", one).where("edit not in ('D', '')")
    initial = F.substring("made", F.col("part") + 1, F.lit(1))
    role = F.when(initial == "u", "user").when(initial == "a", "assistant").otherwise(F.col("role"))
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
    return rows.select("conv_id", "at", "part", "edit", role.alias("role"), text.alias("text"))


def digests(placed: DataFrame, steps: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): letters and a digest over the repaired `role:text` lines.

    A digest runs over a conversation from its begin, so one task streams a conversation's
    messages in order, however many; it holds a batch of them and the letters.
    """
    columns = ["conv_id", "at", "role", "text", "letters", "made"]
    rows = placed.join(steps.drop("conv_id"), "at").select(*columns)
    schema = StructType(
        [placed.schema["conv_id"], StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, kind = None, None

        def out(rows):
            columns = list(zip(*rows)) or [[], [], []]
            types = (kind, pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            conv, _, role, text, letters, made = (c.to_pylist() for c in batch.columns)
            for row in zip(conv, role, text, letters, made):
                if state is None or state[0] != row[0]:
                    if state is not None:
                        done.append((state[0], "".join(state[1]), state[2].hexdigest()))
                    state = [row[0], [], hashlib.sha256(), b""]
                state[1].append(row[3])
                for edit, initial in zip(row[3], row[4]):
                    if edit != "D":
                        who = {"u": "user", "a": "assistant"}.get(initial, row[1])
                        state[2].update(state[3] + f"{who}:{'' if edit == 'I' else row[2]}".encode())
                        state[3] = b"\n"
            yield out(done)
        if state is not None:
            yield out([(state[0], "".join(state[1]), state[2].hexdigest())])

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(run, schema)


def counts(marks: DataFrame) -> DataFrame:
    """conv_id, gaps (turns missing between the least and the largest), and messages by fault."""

    def n(fault: str) -> Column:
        return F.count_if(F.col("fault") == fault).alias(fault)

    turns = marks.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    kinds = marks.groupBy("conv_id").agg(n("blank"), n("duplicate"), n("truncated"))
    return _join(turns, kinds, "conv_id")


def repair_conversations(messages: DataFrame, levels=LEVELS, **columns: str) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal (neighbours
    whose initials are none of su, ua, au), cost, audit, repaired_sha256."""
    placed, marks = faults(messages, **columns)
    steps, solved = repair(marks, levels)
    rows = _join(_join(counts(marks), solved, "conv_id"), digests(placed, steps), "conv_id")
    return rows.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def with_all(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each of `conversations` (distinct conv_id): zeros, an empty audit and the digest
    of nothing for those that `rows` lacks."""
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    filled = {c: F.coalesce(c, F.lit(empty.get(c, 0))) for c in rows.columns if c != "conv_id"}
    return _join(conversations, rows, "conv_id", how="left").withColumns(filled)
