"""Quality rules as a ledger: every rule is evaluated once, policies are applied later.

A ledger row holds a document's measurements and `failed`, a bit per rule that it fails. A
policy only combines bits, so a new version of it, or the question what a rule alone costs,
needs neither the texts nor the rules again. All of it is DataFrame functions.

A null text counts as empty. Empty and blank texts have no words and fail `few_words`. Each
row of the input has its row here, null ids and repeated rows too; only id and text are read.
A text is measured whole and by its own task alone, however long. Words are equal if their
bytes are; three-word windows are compared by a 64-bit hash chained over the words.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole
from driftmon.session import written

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
TRIMMED = " \t\n\x0b\f\r"
SYMBOL = "[#*$%&|<>]"
BULLET = r"^[\x20\x09]*([-*•‣◦]|[0-9]{1,3}[.)])[\x20\x09]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09\r]*$"
WINDOW = 3  # words

MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_bullets n_ellipses n_unlettered".split()


@dataclass(frozen=True)
class Rule:
    """A name and the SQL condition over measurements under which a document fails."""

    name: str
    fails: str


# A rule's bit is its place here: new rules go to the end, so that stored bits keep their sense.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("bullets", "10 * n_bullets > 9 * n_lines"),
    Rule("ellipses", "10 * n_ellipses > 3 * n_lines"),
    Rule("unlettered", "10 * n_unlettered > 2 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of what is kept: a failure of any rule in `hard` rejects, and so do more than
    `most` failures among `soft`."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...] = ()
    most: int = 0


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = (
    BASE,
    Policy("v1", (*BASE.hard, "short_words", "long_words", "symbols", "repeated_lines")),
    Policy(
        "v2",
        (*BASE.hard, "long_words", "symbols", "repeated_lines"),
        ("short_words", "bullets", "ellipses", "unlettered"),
        1,
    ),
)


def mask(names, rules=RULES) -> int:
    """The bits of the named rules."""
    places = {r.name: i for i, r in enumerate(rules)}
    unknown = set(names) - places.keys()
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    return sum(1 << places[n] for n in set(names))


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and MEASURES. Each step names what the next one uses more than once."""
    base = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("body"))
    body = F.btrim("body", F.lit(TRIMMED))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANKS))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))
    split = base.select("doc_id", F.regexp_count("body", F.lit(SYMBOL)).cast("long").alias("n_symbols"), words.alias("words"), lines.alias("lines"))
    windows = F.transform(
        "words", lambda w, i: F.xxhash64(w, *(F.get("words", i + k) for k in range(1, WINDOW)))
    )
    counted = split.select(
        "doc_id",
        _count(F.col("words")).alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        _count(F.col("lines")).alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count(F.filter("lines", lambda x: x.rlike(BULLET))).alias("n_bullets"),
        _count(F.filter("lines", lambda x: x.rlike(ELLIPSIS))).alias("n_ellipses"),
        _count(F.filter("words", lambda x: ~x.rlike(r"\p{L}"))).alias("n_unlettered"),
        F.slice(windows, F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))).alias("windows"),
    )
    # Windows that occur again are neighbours once sorted; a text without any is not sorted.
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    rest = [c for c in counted.columns if c != "windows"]
    sorted_ = counted.select(*rest, F.when(again, placed).alias("placed"))

    def met(x, i):
        return (x["h"] == F.get("placed", i + 1)["h"]) | (x["h"] == F.get("placed", i - 1)["h"])

    found = F.transform(F.filter("placed", lambda x, i: F.coalesce(met(x, i), F.lit(False))), lambda x: x["at"])
    starts = sorted_.select(*rest, F.sort_array(found).alias("starts"))
    # Each window covers the words up to the next one that was found, three at most.
    covered = F.transform(
        "starts", lambda x, i: F.least(F.coalesce(F.get("starts", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return starts.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).select("doc_id", *MEASURES)


def judged(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of a ledger, not yet stored. A filter on them would be evaluated below the steps
    of `measured`, and these again for every word: store them first."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured(docs, doc_id, text).withColumn("failed", failed)


def ledger(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, MEASURES and `failed`: bit i is set if the document fails rule i (63 at most). A
    written table."""
    return written(judged(docs, rules, doc_id, text), "ledger")


def rejects(policy: Policy, rules=RULES, failed: str = "failed") -> Column:
    """Whether a policy rejects a ledger row, from its bits alone."""
    soft = F.bit_count(F.col(failed).bitwiseAND(F.lit(mask(policy.soft, rules)).cast("long")))
    return fails_any(policy.hard, rules, failed) | (soft > policy.most)


def fails_any(names, rules=RULES, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask(names, rules)).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy, rules=RULES) -> DataFrame:
    """A ledger with `kept` and `policy`, the version that decided."""
    return rows.withColumns({"kept": ~rejects(policy, rules), "policy": F.lit(policy.version)})


def keep_by_rules(docs: DataFrame, rows: DataFrame, policy: Policy, doc_id: str = "doc_id", rules=RULES) -> DataFrame:
    """The documents, with all their columns, whose id a policy keeps in a ledger.

    Of rows with one id all must be kept; a null id names no document and goes.
    """
    verdicts = rows.groupBy(F.col("doc_id").alias("k_id")).agg(F.bool_or(rejects(policy, rules)).alias("k_gone"))
    kept = verdicts.where("not k_gone").select("k_id").alias("k")
    return docs.alias("d").join(kept, F.col("k.k_id") == F.col(f"d.`{doc_id}`"), "left_semi")


def ablations(rows: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """What each rule costs under each policy, from the bits alone.

    version, rule, `failing` documents, `kept` under the whole policy, `kept_without` the rule,
    `alone`: documents rejected that would be kept without it, and `beside`: names of the rules
    that fail together with it on some document, whose bits are or-ed. A ledger is first counted
    per distinct bit pattern, of which there are 2^rules at most whatever its size; all but that
    count works on patterns. An empty ledger has zeros.
    """
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    places = {r.name: i for i, r in enumerate(rules)}
    every = F.array(*[F.lit(r.name) for r in rules])

    def one(policy: Policy, name: str) -> Column:
        without = Policy(
            policy.version,
            tuple(n for n in policy.hard if n != name),
            tuple(n for n in policy.soft if n != name),
            policy.most,
        )
        bit = F.lit(1 << places[name]).cast("long")
        failing = F.col("failed").bitwiseAND(bit) != 0
        gone, left = rejects(policy, rules), ~rejects(without, rules)

        def total(cond: Column) -> Column:
            return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")

        others = F.coalesce(F.bit_or(F.when(failing, F.col("failed").bitwiseAND(F.bitwise_not(bit)))), F.lit(0).cast("long"))
        return F.struct(
            F.lit(policy.version).alias("version"),
            F.lit(name).alias("rule"),
            total(failing).alias("failing"),
            total(~gone).alias("kept"),
            total(left).alias("kept_without"),
            total(gone & left).alias("alone"),
            others.alias("others"),
        )

    cells = patterns.agg(F.array(*[one(p, n) for p in policies for n in (*p.hard, *p.soft)]).alias("cells"))
    flat = cells.select(F.inline("cells"))
    beside = F.filter(every, lambda x, i: F.expr("others").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
    return flat.select("version", "rule", "failing", "kept", "kept_without", "alone", beside.alias("beside"))
