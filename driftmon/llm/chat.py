"""Chat formatting: link tool calls with their results, order, check and write them.

Input is a table of messages (conv_id, turn, role, text). An assistant message whose text is
a JSON object with "tool_calls" holds calls, each with "id", "name", "arguments" and, if it
waits for others, "after" (their ids). A message of role "tool" whose text is a JSON object
with "tool_call_id" and "content" is a result. Every other message stays as it is.

* Calls and results of a conversation are hash-joined by identifier. Where one is used again,
  the k-th call by turn and place goes with the k-th result by turn; each has its line, and
  the numbers are reported. Results beyond the last call of their identifier are in `repeats`
  of that call's result line, as the lines they would be. Calls without an id are calls of
  their own without a result.
* What a calling message or a result says besides is a message before its calls: its content,
  or all of its other keys as JSON if there are more.
* Calls are ordered topologically: a call comes after all calls it waits for, and otherwise
  at its turn. Rounds of joins release the calls whose waits are over; there are as many as
  the longest chain of waiting calls. Calls in a circle keep their turn and are reported.
  Of calls with one identifier the last up to the waiting call's turn is waited for, or else
  the first.
* Arguments are checked against the schema of the tool.
* Each message, call and result becomes one line of canonical JSON: keys sorted, no spaces,
  numbers in their shortest form.

No conversation is gathered into one task: the order is a sort key (turn_at, stage, place,
part); only the uses of one identifier in one conversation meet, to be numbered. A null
conv_id is a conversation, a null text an empty one, a null role stays null.
Malformed JSON is an ordinary message. Other columns of the messages are not read.
"""

import json
import math
import re
from decimal import Decimal
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmon.llm.common import whole
from driftmon.session import written

CALLS = "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>"
RESULT = "tool_call_id string, content string"
_KINDS = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
    "integer": int,
    "number": (int, float),
}

_HALF = re.compile("[\ud800-\udfff]")
_CHECKS = set("type enum minimum maximum properties required additionalProperties items".split())
_NOTES = set("title description default examples $schema $id $comment".split())


def _plain(value: Any) -> Any:
    """Numbers in one form: a whole float is an integer; keys in UTF-16 order."""
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a JSON number")
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, dict):
        return {k: _plain(value[k]) for k in sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def escaped(text: str) -> str:
    """Halves of surrogate pairs, which no encoding can hold, as JSON escapes."""
    return _HALF.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def number(value: float) -> str:
    """The shortest digits that give the number back; an exponent only below 1e-6 and for whole
    numbers that are no exact integers (from 2^53), which must not be read back as such."""
    sign, digits, shift = Decimal(repr(value)).normalize().as_tuple()
    text, point = "".join(map(str, digits)), len(digits) + shift
    if 0 < point < len(text):
        text = f"{text[:point]}.{text[point:]}"
    elif -6 < point <= 0:
        text = f"0.{'0' * -point}{text}"
    else:
        text = f"{text[0]}{'.' if text[1:] else ''}{text[1:]}e{point - 1:+d}"
    return "-" * sign + text


def _written(value: Any) -> str:
    if isinstance(value, dict):
        return "{" + ",".join(f"{_written(k)}:{_written(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    if isinstance(value, float) and math.isfinite(value):
        return number(value)
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def canonical(value: Any) -> str:
    return escaped(_written(_plain(value)))


def refuse_unknown(schema: Any, at: str = "$") -> None:
    """A keyword that `faults` does not know would pass any value: such a schema is refused."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema must be an object")
    unknown = schema.keys() - _CHECKS - _NOTES
    if unknown:
        raise ValueError(f"{at}: keywords {sorted(unknown)} are not supported")
    kinds = schema.get("type", [])
    if not set([kinds] if isinstance(kinds, str) else kinds) <= _KINDS.keys():
        raise ValueError(f"{at}: unknown type {kinds}")
    if schema.get("additionalProperties", True) not in (True, False):
        raise ValueError(f"{at}: additionalProperties must be true or false")
    for name, part in schema.get("properties", {}).items():
        refuse_unknown(part, f"{at}.{name}")
    if "items" in schema:
        refuse_unknown(schema["items"], f"{at}[]")


def _is(value: Any, kind: str) -> bool:
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def faults(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What a schema (type or types, enum, minimum, maximum, properties, required,
    additionalProperties, items) has against a value. Values are equal if their JSON is."""
    kind = schema.get("type")
    kinds = [kind] if isinstance(kind, str) else kind
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not one of the values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{at}: too small")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{at}: too large")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
        for k in sorted(set(known) & set(value)):
            out += faults(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += faults(v, schema["items"], f"{at}[{i}]")
    return out


def checked_call(call_id: str | None, name: str | None, arguments: str | None, schemas: dict) -> tuple[str, list[str]]:
    """(canonical JSON of the call, what is wrong with it)."""
    try:
        value = json.loads(arguments) if arguments is not None else {}
        if isinstance(value, str):  # arguments may be JSON inside a string
            value = json.loads(value)
        line = canonical({"id": call_id, "name": name, "arguments": value})
    except (ValueError, RecursionError):
        return canonical({"id": call_id, "name": name, "arguments": arguments}), ["$: not JSON"]
    if name not in schemas:
        return line, ["unknown tool"]
    return line, [escaped(f) for f in faults(value, schemas[name])]


_CHECKED = pa.struct([("json", pa.string()), ("faults", pa.list_(pa.string()))])


def _check(schemas: dict) -> Column:
    @F.arrow_udf("struct<json:string,faults:array<string>>")
    def check(ids: pa.Array, names: pa.Array, arguments: pa.Array) -> pa.Array:
        rows = [checked_call(*r, schemas) for r in zip(ids.to_pylist(), names.to_pylist(), arguments.to_pylist())]
        return pa.array([{"json": j, "faults": f} for j, f in rows], _CHECKED)

    return check("call_id", "call.name", "call.arguments")


def _line(key: str, value: Column, content: Column) -> Column:
    @F.arrow_udf("string")
    def line(values: pa.Array, contents: pa.Array) -> pa.Array:
        return pa.array([canonical({key: v, "content": c}) for v, c in zip(values.to_pylist(), contents.to_pylist())], pa.string())

    return line(value, content)


def besides(text: str, keys: tuple[str, ...]) -> str:
    """What a message says beside `keys`: its content if that is all, or the rest as JSON."""
    try:
        rest = {k: v for k, v in json.loads(text).items() if k not in keys}
        return rest["content"] if list(rest) == ["content"] and isinstance(rest["content"], str) else canonical(rest)
    except (AttributeError, ValueError, RecursionError):
        return text


def says_more(text: str, use: str) -> bool:
    """Whether a calling or answering message says anything beside that; a call's empty or null
    content says nothing."""
    try:
        rest = {k: v for k, v in json.loads(text).items() if k not in _KEYS[use]}
    except (AttributeError, ValueError, RecursionError):
        return True
    return bool(rest.keys() - ({"content"} if use == "call" and rest.get("content") in ("", None) else set()))


def _more(use: Column) -> Column:
    @F.arrow_udf("boolean")
    def more(texts: pa.Array, uses: pa.Array) -> pa.Array:
        return pa.array([u is None or says_more(t, u) for t, u in zip(texts.to_pylist(), uses.to_pylist())], pa.bool_())

    return more(F.when(use.isNotNull(), F.col("text")), use)


_KEYS = {"call": ("tool_calls",), "result": ("tool_call_id", "content")}


def _spoken() -> Column:
    @F.arrow_udf("string")
    def spoken(roles: pa.Array, texts: pa.Array, uses: pa.Array) -> pa.Array:
        rows = zip(roles.to_pylist(), texts.to_pylist(), uses.to_pylist())
        return pa.array([canonical({"role": r, "content": besides(t, _KEYS[u]) if u else t}) for r, t, u in rows], pa.string())

    return spoken(F.col("role").cast("string"), F.col("text"), F.col("use"))


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, calls, results)."""
    rows = messages.select("conv_id", "turn", "role", whole("text").alias("text"))
    # Ids are matched as text; a call's place is where it stands in its message.
    rows = rows.withColumn("calls", F.when(F.col("role") == "assistant", F.from_json("text", CALLS).tool_calls))
    rows = rows.withColumn("result", F.when(F.col("role") == "tool", F.from_json("text", RESULT)))
    has_calls = F.size(F.coalesce("calls", F.array())) > 0
    has_result = F.coalesce(F.col("result.tool_call_id").isNotNull(), F.lit(False))
    calls = rows.where(has_calls).select("conv_id", "turn", F.posexplode("calls").alias("place", "c"))
    results = rows.where(has_result).select("conv_id", "turn", F.col("result.tool_call_id").alias("call_id"), "result.content")

    used = rows.withColumn("use", F.when(has_calls, "call").when(has_result, "result"))
    plain = used.withColumn("more", _more(F.col("use"))).where("more")
    return plain.select("conv_id", "turn", "role", "text", "use"), calls.select("conv_id", F.col("c.id").alias("call_id"), "turn", "place", "c"), results


def numbered(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, nth, call, copies): calls with one identifier told apart by `nth`."""
    unnamed = F.col("call_id").isNull()
    same = Window.partitionBy("conv_id", "call_id", F.when(unnamed, F.col("turn")), F.when(unnamed, F.col("place")))
    call = F.struct("turn", "place", F.col("c.name"), F.col("c.arguments"), F.col("c.after"))
    n = F.row_number().over(same.orderBy("turn", "place", "c")).cast("string")
    where = F.concat_ws("/", F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.col("place").cast("string"), n)
    nth = F.when(unnamed, where).otherwise(n).alias("nth")
    return calls.select("conv_id", "call_id", nth, call.alias("call"), F.count("*").over(same).alias("copies"))


def dealt(results: DataFrame, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, nth, result, results, repeats): for each call, or each result without one."""
    same = Window.partitionBy("conv_id", "call_id")
    results = written(
        results.select(
            "conv_id",
            "call_id",
            F.row_number().over(same.orderBy("turn", "content")).alias("k"),
            F.struct("turn", "content").alias("result"),
            F.count("*").over(same).alias("results"),
        ),
        "results",
    )
    key, none = F.col("k").cast("string").alias("nth"), F.array().cast("array<string>").alias("repeats")
    if results.where("k > 1").isEmpty():
        return results.select("conv_id", "call_id", key, "result", "results", none)
    many = calls.where("nth = '1'").select("conv_id", "call_id", F.col("copies").alias("many"))
    on = F.col("r.conv_id").eqNullSafe(F.col("m.conv_id")) & (F.col("r.call_id") == F.col("m.call_id"))
    rest = results.where("k > 1").alias("r").join(many.alias("m"), on, "left").select("r.*", "many")
    line = _line("tool_call_id", F.col("call_id"), F.coalesce("result.content", F.lit("")))
    over = rest.where("k > many").withColumn("line", line)
    over = over.groupBy("conv_id", "call_id", F.col("many").cast("int").alias("k")).agg(F.sort_array(F.collect_list(F.struct("k", "line"))).alias("over"))
    own = results.where("k = 1").unionByName(rest.where("many is null or k <= many").drop("many"))
    at = F.col("r.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("r.call_id") == F.col("o.call_id")) & (F.col("r.k") == F.col("o.k"))
    own = own.alias("r").join(over.alias("o"), at, "left").select("r.*", "over")
    return own.select("conv_id", "call_id", key, "result", "results", F.coalesce("over.line", none).alias("repeats"))


def _same(a: str, b: str) -> Column:
    return reduce(Column.__and__, (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in ("conv_id", "call_id", "nth")))


def _which(asked: DataFrame, known: DataFrame) -> DataFrame:
    """`asked` with wait_nth: which of the calls with the identifier is waited for."""
    again = known.where("copies > 1")
    if again.isEmpty():
        return asked.withColumn("wait_nth", F.lit("1"))
    uses = again.select("conv_id", F.col("call_id").alias("wait"), "turn", F.col("nth").alias("use"))
    uses = asked.unionByName(uses, allowMissingColumns=True)
    so_far = Window.partitionBy("conv_id", "wait").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.col("use").cast("int")).over(so_far).cast("string")
    return uses.withColumn("wait_nth", F.coalesce(last, F.lit("1"))).where("use is null").drop("use")


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, nth, turn_at, stage, circular) of the calls that `numbered` gives."""
    nodes = calls.select("conv_id", "call_id", "nth", "copies", F.col("call.turn").alias("turn"), F.col("call.after").alias("after"))
    asked = nodes.select("conv_id", "call_id", "nth", "turn", F.explode("after").alias("wait")).distinct()
    asked = _which(asked, nodes)
    known = nodes.select("conv_id", F.col("call_id").alias("wait"), F.col("nth").alias("wait_nth"))
    on = F.col("a.conv_id").eqNullSafe(F.col("k.conv_id")) & (F.col("a.wait") == F.col("k.wait")) & (F.col("a.wait_nth") == F.col("k.wait_nth"))
    # Waits for a call that the conversation lacks are no reason to wait.
    waits = asked.alias("a").join(known.alias("k"), on, "left_semi")
    waits = written(waits, "waits")
    waiting = waits.select("conv_id", "call_id", "nth").distinct()
    free = nodes.alias("n").join(waiting.alias("w"), _same("n", "w"), "left_anti")
    start = F.struct(F.col("turn").alias("turn_at"), F.lit(0).alias("stage"))
    done = written(free.select("conv_id", "call_id", "nth", start.alias("key")), "released")
    while not waits.isEmpty():
        met = waits.alias("a").join(
            done.select("conv_id", F.col("call_id").alias("wait"), F.col("nth").alias("wait_nth"), F.col("key").alias("of")).alias("k"), on, "left"
        )
        per = met.groupBy("a.conv_id", "a.call_id", "a.nth").agg(
            F.max("turn").alias("turn"), F.max("of").alias("of"), F.count("*").alias("n"), F.count("of").alias("met")
        )
        late = F.coalesce(F.col("of.turn_at") >= F.col("turn"), F.col("turn").isNull())
        at = F.when(late, F.col("of.turn_at")).otherwise(F.col("turn")).alias("turn_at")
        stage = F.when(late, F.col("of.stage") + 1).otherwise(0).alias("stage")
        new = written(per.where("met = n").select("conv_id", "call_id", "nth", F.struct(at, stage).alias("key")), "released")
        if new.isEmpty():
            break
        waits = written(waits.alias("w").join(new.alias("d"), _same("w", "d"), "left_anti"), "waits")
        done = done.unionByName(new)
    circle = waits.groupBy("conv_id", "call_id", "nth").agg(F.max("turn").alias("turn"))
    rest = circle.select("conv_id", "call_id", "nth", F.col("turn").alias("turn_at"), F.lit(0).alias("stage"), F.lit(True).alias("circular"))
    return done.select("conv_id", "call_id", "nth", "key.*", F.lit(False).alias("circular")).unionByName(rest)


def format_chats(messages: DataFrame, schemas: dict) -> DataFrame:
    """A line per message, call and result.

    Columns: conv_id, turn_at, stage, place, part (sorting by these gives the order), kind,
    call_id, copies (rows that said the same identifier), problems, json, repeats (lines of
    results that no call is left for). A schema with keywords that are not checked is refused.
    """
    for schema in schemas.values():
        refuse_unknown(schema)
    plain, calls, results = parse(messages)
    calls = written(numbered(calls), "calls")
    results = dealt(results, calls)
    order = ordered(calls)
    linked = calls.alias("c").join(results.alias("r"), _same("c", "r"), "full_outer").select(
        F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"),
        F.coalesce("c.call_id", "r.call_id").alias("call_id"),
        F.coalesce("c.nth", "r.nth").alias("nth"),
        "call",
        "copies",
        "result",
        "results",
        "repeats",
    )
    linked = linked.alias("l").join(order.alias("o"), _same("l", "o"), "left").select("l.*", "turn_at", "stage", "circular")
    linked = written(linked.withColumn("checked", F.when(F.col("call").isNotNull(), _check(schemas))), "linked")

    def noted(*notes: tuple[Column, str]) -> Column:
        return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in notes)))

    call_lines = linked.where(F.col("call").isNotNull()).select(
        "conv_id",
        "turn_at",
        "stage",
        F.col("call.place").alias("place"),
        F.lit(0).alias("part"),
        F.lit("call").alias("kind"),
        "call_id",
        "copies",
        F.concat(
            noted(
                (F.col("result").isNull(), "no result"),
                (F.col("copies") > 1, "repeated"),
                (F.col("circular"), "circular"),
            ),
            "checked.faults",
        ).alias("problems"),
        F.col("checked.json").alias("json"),
        F.array().cast("array<string>").alias("repeats"),
    )
    result_lines = linked.where(F.col("result").isNotNull()).select(
        "conv_id",
        F.coalesce("turn_at", "result.turn").alias("turn_at"),
        F.coalesce("stage", F.lit(0)).alias("stage"),
        F.coalesce("call.place", F.lit(0)).alias("place"),
        F.lit(1).alias("part"),
        F.lit("result").alias("kind"),
        "call_id",
        F.col("results").alias("copies"),
        noted((F.col("call").isNull(), "no call"), (F.col("results") > 1, "repeated")).alias("problems"),
        _line("tool_call_id", F.col("call_id"), F.coalesce("result.content", F.lit(""))).alias("json"),
        "repeats",
    )
    message_lines = plain.select(
        "conv_id",
        F.col("turn").alias("turn_at"),
        F.lit(-1).alias("stage"),
        F.lit(0).alias("place"),
        F.lit(0).alias("part"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit(1).cast("long").alias("copies"),
        F.array().cast("array<string>").alias("problems"),
        _spoken().alias("json"),
        F.array().cast("array<string>").alias("repeats"),
    )
    return message_lines.unionByName(call_lines).unionByName(result_lines)
