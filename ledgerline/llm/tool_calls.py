"""Tool-call linking for chat records.

Messages become events: a plain message, a call (one per entry of
``tool_calls``) or a result (a message with a ``tool_call_id``). Calls and
results are hash-joined by (conversation, identifier), ordered topologically
(a result after its call, a call after the results of the calls that it
names in ``after``), the arguments are validated against the tool's schema,
and every event is serialised as canonical JSON: sorted keys, no white space,
UTF-8, no NaN.

Status: ``linked``; ``unanswered`` (call without result); ``orphan`` (result
without call); ``duplicate`` (a later call or result of the same identifier;
the first by turn counts); ``no_id``; ``cyclic`` (a call that waits for
itself); ``message``.

Scale: linking is two partial aggregates (first call, first result of each
identifier) and equality joins; a conversation with a third of all rows is
never gathered, its events carry a dense ``order_no`` from a distributed sort.
Dependencies are peeled level by level, a written table each: as many rounds
as the longest chain of calls that wait for each other; a round joins only the
level placed last and the calls still waiting, each of which adds up what it has met.

Defined results: null conversations are one conversation of their own; null
turns come first; null text is JSON null; rows that repeat are events of their
own, later ones duplicates; arguments that aren't a JSON object, unknown tools
and a missing schema are invalid; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
import sys
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage_table
from ledgerline.operators.features import global_rank

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SURROGATE = re.compile("[\ud800-\udfff]")
CALLS = "array<struct<id:string,name:string,arguments:string,after:array<string>>>"
TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    """Sorted keys, no spaces, text as it is; a lone surrogate, which no UTF-8 text holds, as its escape."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return SURROGATE.sub(lambda m: f"\\u{ord(m.group()):04x}", text)


def _is(value: object, kind: str) -> bool:
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    if kind == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return isinstance(value, TYPES[kind])


def faults(value: object, schema: dict, at: str = "$") -> list[str]:
    """What ``value`` breaks of a JSON schema (types, enum, bounds, lengths, pattern, properties, items)."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: type"]
    out = []
    if "enum" in schema and not any(value == e and type(value) is type(e) for e in schema["enum"]):
        out.append(f"{at}: enum")
    if _is(value, "number"):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            out.append(f"{at}: range")
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
            out.append(f"{at}: length")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{at}: pattern")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += faults(x, schema["items"], f"{at}[{i}]")
    return out


def _event(kind: str, cid: str | None, name: str | None, arguments: str | None, role: str | None, text: str | None,
           schemas: dict[str, dict]) -> tuple[str, bool | None, str | None]:
    """Canonical JSON, are the arguments valid (calls only), and their faults."""
    if kind != "call":
        return canonical({"content": text, "id": cid, "type": kind} if kind == "result" else {"content": text, "role": role, "type": kind}), None, None
    try:
        value = json.loads(arguments or "", parse_constant=lambda x: float("nan"))
        body = canonical(value)
    except (ValueError, RecursionError):
        return canonical({"arguments": arguments, "id": cid, "name": name, "type": kind}), False, "$: not JSON"
    wrong = ["$: unknown tool"] if name not in schemas else ["$: type"] if not isinstance(value, dict) else faults(value, schemas[name])
    rest = canonical({"id": cid, "name": name, "type": kind})
    return f'{{"arguments":{body},{rest[1:]}', not wrong, SURROGATE.sub("?", "; ".join(wrong)) or None


def _serialised(schemas: dict[str, dict], *cols: Column) -> Column:
    @F.pandas_udf("json string, args_valid boolean, faults string")
    def run(kind: pd.Series, cid: pd.Series, name: pd.Series, arguments: pd.Series, role: pd.Series, text: pd.Series) -> pd.DataFrame:
        rows = [_event(*r, schemas) for r in zip(kind, cid, name, arguments, role, text, strict=True)]
        return pd.DataFrame(rows, columns=["json", "args_valid", "faults"]).astype(object)

    return run(*cols)


def _depths(calls: DataFrame) -> DataFrame:
    """(conv, id, level, ready): peel calls whose ``after`` calls are all placed.

    ``ready`` is the least turn at which the call can stand; calls in or
    behind a cycle stay out.
    """
    edges = stage_table(calls.select("conv", "id", F.explode(F.array_distinct("after")).alias("dep")).alias("e").join(
        calls.select(F.col("conv").alias("c2"), F.col("id").alias("dep")), ["dep"]).where(F.col("conv").eqNullSafe(F.col("c2"))).select("conv", "id", "dep"), "edges")
    left = calls.select("conv", "id", "turn", "answered")
    waits = edges.groupBy("conv", "id").agg(F.count(F.lit(1)).alias("deps"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    w = waits.select(F.col("conv").alias("c2"), F.col("id").alias("i2"), "deps")
    todo = stage_table(left.join(w, same("conv", "c2") & (F.col("id") == F.col("i2")), "left").select(
        "conv", "id", "turn", "answered", F.coalesce("deps", F.lit(0)).alias("deps"),
        F.lit(None).cast("int").alias("l"), F.lit(None).cast("long").alias("o")), "todo")
    done = stage_table(todo.where("deps = 0").select("conv", "id", F.lit(0).alias("level"), F.col("turn").alias("ready"), F.greatest("turn", "answered").alias("over")), "level")
    parts, todo = [done], todo.where("deps > 0")
    while True:  # each round joins the level placed last with the edges into it, and adds up what every waiting call has met
        d = done.select(F.col("conv").alias("c3"), F.col("id").alias("dep3"), F.col("level").alias("l3"), "over")
        met = edges.join(d, same("conv", "c3") & (F.col("dep") == F.col("dep3"))).groupBy("conv", "id").agg(
            F.count(F.lit(1)).alias("n4"), F.max("l3").alias("l4"), F.max("over").alias("o4"))
        m = met.select(F.col("conv").alias("c4"), F.col("id").alias("i4"), "n4", "l4", "o4")
        todo = stage_table(todo.join(m, same("conv", "c4") & (F.col("id") == F.col("i4")), "left").select(
            "conv", "id", "turn", "answered", (F.col("deps") - F.coalesce("n4", F.lit(0))).alias("deps"),
            F.greatest("l", "l4").alias("l"), F.greatest("o", "o4").alias("o")), "todo")
        done = stage_table(todo.where("deps = 0").select("conv", "id", (F.col("l") + 2).alias("level"), F.greatest("turn", "o").alias("ready"),
                                                         F.greatest("turn", "o", "answered").alias("over")), "level")
        if not done.limit(1).count():
            return reduce(DataFrame.unionByName, parts)
        parts.append(done)
        todo = todo.where("deps > 0")


def linked(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row an event, from ``messages`` (conv, turn, role, text, tool_calls, tool_call_id).

    Columns: conv, turn, kind, id, status, level, order_no (dense from 1 in
    the conversation), args_valid, faults, json.
    """
    m = messages.select("conv", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("tool_calls").cast(CALLS).alias("tool_calls"),
                        F.col("tool_call_id").alias("rid"))
    made = F.transform("tool_calls", lambda c: F.struct(F.lit("call").alias("kind"), c["id"].alias("id"), c["name"].alias("name"),
                                                       c["arguments"].alias("arguments"), F.coalesce(c["after"], F.array().cast("array<string>")).alias("after")))
    own = F.array(F.struct(F.when(F.col("rid").isNotNull(), "result").otherwise("message").alias("kind"), F.col("rid").alias("id"),
                           F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.array().cast("array<string>").alias("after")))
    e = m.select("conv", "turn", "role", "text", F.explode(F.when(F.size("tool_calls") > 0, made).otherwise(own)).alias("x"))
    e = stage_table(e.select("conv", "turn", "role", "text", "x.*").withColumn("row", F.monotonically_increasing_id()), "events")
    firsts = stage_table(e.where("kind <> 'message' AND id IS NOT NULL").groupBy("conv", "id").agg(
        F.min(F.when(F.col("kind") == "call", F.struct("turn", "row"))).alias("call"),
        F.min(F.when(F.col("kind") == "result", F.struct("turn", "row"))).alias("result")), "identifiers")
    f = firsts.select(F.col("conv").alias("c1"), F.col("id").alias("i1"), "call", "result")
    j = e.join(f, F.col("conv").eqNullSafe(F.col("c1")) & (F.col("id") == F.col("i1")), "left")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    j = j.withColumn("status", F.when(F.col("kind") == "message", "message").when(F.col("id").isNull(), "no_id")
                     .when(call & (F.col("call")["row"] != F.col("row")) | result & (F.col("result")["row"] != F.col("row")), "duplicate")
                     .when(call & F.col("result").isNull(), "unanswered").when(result & F.col("call").isNull(), "orphan").otherwise("linked"))
    j = stage_table(j.select(*e.columns, "status", F.col("result")["turn"].alias("answered")), "linked")
    levels = _depths(j.where("kind = 'call' AND status IN ('linked', 'unanswered')"))
    v = levels.select(F.col("conv").alias("c2"), F.col("id").alias("i2"), "level", "ready")
    j = j.join(v, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("id") == F.col("i2")), "left")
    first = F.col("status").isin("linked", "unanswered")
    j = j.withColumn("status", F.when(call & first & F.col("level").isNull(), "cyclic").otherwise(F.col("status")))
    j = j.withColumn("at", F.when(first, F.greatest("turn", "ready")).otherwise(F.col("turn")))
    j = j.withColumn("level", F.when(first, F.col("level") + F.when(result, 1).otherwise(0)).otherwise(F.lit(0)))
    j = stage_table(j.withColumn("level", F.coalesce("level", F.lit(0))), "placed")
    ranked = stage_table(global_rank(j.select("row", "conv", "at", "level", "turn"), [F.col(c) for c in ("conv", "at", "level", "turn", "row")], "g"), "order")
    start = ranked.groupBy("conv").agg((F.min("g") - 1).alias("g0")).select(F.col("conv").alias("c3"), "g0")
    order = ranked.join(start, F.col("conv").eqNullSafe(F.col("c3"))).select(F.col("row").alias("r3"), (F.col("g") - F.col("g0")).alias("order_no"))
    j = j.join(order, F.col("row") == F.col("r3")).withColumn("s", _serialised(schemas, *map(F.col, ("kind", "id", "name", "arguments", "role", "text"))))
    return j.select("conv", "turn", "kind", "id", "status", "level", "order_no", "s.args_valid", "s.faults", "s.json")


#: The tool that ``as_tool_messages`` makes calls to.
SCHEMAS = {"answer": {"type": "object", "required": ["query", "turn"], "additionalProperties": False,
                      "properties": {"query": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations as tool calls: every user turn calls ``answer``, the next turn of the assistant is the result.

    Each second question of a conversation waits for the answer to the one before it.
    """
    key = lambda back: F.concat_ws(":", F.lit("q"), (F.col("turn") - back).cast("string"))
    waits = F.when(F.col("turn") % 4 >= 2, F.array(key(2))).otherwise(F.array().cast("array<string>"))
    call = F.struct(key(0).alias("id"), F.lit("answer").alias("name"),
                    F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("query"))).alias("arguments"), waits.alias("after"))
    return conversations.select(
        F.col("conv_id").alias("conv"), "turn", "role", "text",
        F.when(F.col("role") == "user", F.array(call)).cast(CALLS).alias("tool_calls"),
        F.when(F.col("role") == "assistant", key(1)).alias("tool_call_id"))
