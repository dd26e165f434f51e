"""Chat formatting: tool calls linked to their results, checked and written as canonical JSON.

A message whose text is a JSON object with ``tool_calls`` (a list of ``{"id",
"name", "arguments"}``; arguments an object, or a string that holds one) makes
calls; a message with ``tool_call_id`` answers one.  Calls and results of a
conversation meet in a join on (conv_id, call id).  One row per message and
one more per call come out; ``(order_turn, order_part, turn, item)`` is a
topological order of a conversation: its messages by turn, a message before
its calls, and a result never before its call, also where its own turn is
earlier.  No step needs a conversation's rows together.

Defined cases: null or non-JSON text is a plain message; an id without a call
or a null conversation leaves a result unlinked; of calls with the same id in
a conversation the first (by turn, then place) is the one that results answer
and the others carry the error ``duplicate id``; arguments that are no JSON
object carry the error ``arguments``; repeated messages stay repeated; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adresponse.llm.store import own_columns

#: tool -> parameter -> (JSON type, required); tools not listed are not checked.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "get_weather": {"city": ("string", True), "unit": ("string", False)},
    "calculate": {"expression": ("string", True)},
}
#: How Spark names the JSON types of a variant.
TYPES = {
    "string": "^STRING", "integer": "^BIGINT", "number": "^(BIGINT|DECIMAL|DOUBLE)",
    "boolean": "^BOOLEAN", "object": "^OBJECT", "array": "^ARRAY",
}


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no spare white space; null if it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def _errors(name: Column, args: Column, schemas) -> Column:
    """What is wrong with a call's arguments, joined by ``;`` (empty: nothing)."""
    value = F.try_parse_json(args)
    out = F.lit("")
    for tool, params in schemas.items():
        found = []
        for p, (kind, required) in sorted(params.items()):
            part = F.try_variant_get(value, f"$.{p}", "variant")
            wrong = F.when(part.isNotNull() & ~F.schema_of_variant(part).rlike(TYPES[kind]), F.lit(f"{p}: not {kind}"))
            found.append(F.when(part.isNull(), F.lit(f"{p}: missing")).otherwise(wrong) if required else wrong)
        known = F.array(*[F.lit(p) for p in sorted(params)]) if params else F.array().cast("array<string>")
        more = F.array_sort(F.array_except(F.json_object_keys(args), known))
        found.append(F.when(F.size(more) > 0, F.concat(F.lit("unknown: "), F.array_join(more, ","))))
        out = F.when(name == tool, F.concat_ws(";", *found)).otherwise(out)
    is_object = args.startswith("{")
    return F.when(args.isNull() | ~is_object, F.lit("arguments")).otherwise(out)


def format_chats(conversations: DataFrame, schemas=None) -> DataFrame:
    """Rows of the module's description: conv_id, turn, role, part (message, call
    or result), item (place of a call in its message), call_id, order_turn,
    order_part, linked (a call has a result, a result a call; null for messages),
    error and json."""
    schemas = SCHEMAS if schemas is None else schemas
    m = own_columns(conversations, "conv_id", "turn", "role", "text")
    mine = F.col("text").rlike(r'^\s*\{') & (F.contains("text", F.lit('"tool_calls"')) | F.contains("text", F.lit('"tool_call_id"')))
    m = m.withColumn("tree", F.when(mine, F.try_parse_json("text")))
    m = m.withColumn("answers", F.try_variant_get("tree", "$.tool_call_id", "string")).withColumn(
        "calls", F.when(F.col("answers").isNull(), F.try_variant_get("tree", "$.tool_calls", "array<string>"))
    )
    plain = m.select(
        "conv_id", "turn", "role",
        F.when(F.col("answers").isNull(), "message").otherwise("result").alias("part"),
        F.lit(0).alias("item"), F.col("answers").alias("call_id"), F.lit("").alias("error"),
        F.when(F.col("tree").isNotNull() & (F.col("answers").isNotNull() | F.col("calls").isNotNull()), F.to_json("tree"))
        .otherwise(F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content"), "role"))).alias("json"),
    )
    one = m.where(F.size("calls") > 0).select("conv_id", "turn", "role", F.posexplode("calls").alias("item", "call"))
    one = one.withColumn("call_id", F.get_json_object("call", "$.id")).withColumn("name", F.get_json_object("call", "$.name"))
    one = one.withColumn("args", canonical(F.get_json_object("call", "$.arguments")))
    head = F.expr("substring(to_json(struct(call_id as id, name)), 2)")
    calls = one.select(
        "conv_id", "turn", "role", F.lit("call").alias("part"), (F.col("item") + 1).alias("item"), "call_id",
        _errors(F.col("name"), F.col("args"), schemas).alias("error"),
        F.concat(F.lit('{"arguments":'), F.coalesce("args", F.lit("null")), F.when(F.length(head) > 1, ",").otherwise(""), head).alias("json"),
    )
    link = ["conv_id", "call_id"]
    first = calls.where("call_id is not null").groupBy(*link).agg(F.min(F.struct("turn", "item")).alias("call"))
    done = plain.where("part = 'result'").groupBy(*link).agg(F.min("turn").alias("answered"))
    ends = first.join(done, link, "left")
    # only calls and results are joined: plain messages never move
    linked = calls.unionByName(plain.where("part = 'result'")).join(ends, link, "left")
    same = F.struct("turn", "item").eqNullSafe(F.col("call"))
    twice = F.when((F.col("part") == "call") & F.col("call").isNotNull() & ~same, "duplicate id")
    linked = linked.select(
        "conv_id", "turn", "role", "part", "item", "call_id",
        F.when(F.col("part") == "result", F.greatest("turn", "call.turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(F.col("part") == "call", 1).otherwise(2).alias("order_part"),
        F.when(F.col("part") == "call", F.col("answered").isNotNull() & same).otherwise(F.col("call").isNotNull()).alias("linked"),
        F.concat_ws(";", F.when(F.col("error") != "", F.col("error")), twice).alias("error"), "json",
    )
    rest = plain.where("part = 'message'").select(
        "conv_id", "turn", "role", "part", "item", "call_id", F.col("turn").alias("order_turn"), F.lit(0).alias("order_part"),
        F.lit(None).cast("boolean").alias("linked"), "error", "json",
    )
    return rest.unionByName(linked)
