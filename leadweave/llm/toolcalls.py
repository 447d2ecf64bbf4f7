"""Chat formatting with linked tool calls, in built-in functions only.

Calls and results are tables of messages; a full hash join by conversation and call identifier links them, as identifiers
are unique in their conversation only. Calls may refer to results of other calls of the conversation (`{"$ref": "id"}`
in their arguments); levels of a topological order follow from these references: calls
without references have level 0, others one more than the highest call they refer to, found by peeling settled calls
round by round. Rounds are as many as the longest chain of references, and each writes its table to the shared folder.
Arguments are validated against the schema of the tool, and every message is serialised as canonical JSON: keys in
order, no blanks, absent values left out.

Every message is one row, so a conversation of any length never meets in one task. In a conversation, rows in the order of
(level, turn, kind) follow every reference; a result stands in the row of its call.

Defined cases: a null or empty text, or arguments that are no JSON object, is `invalid_json`; a call or result without
identifier or conversation links with nothing and is a row of its own (`unlinked`); of several calls (or results) with one
identifier in a conversation the first by turn and text is linked, with the count of all, and each other one is a row of
its own (`duplicate`); an empty list of calls makes its message a plain one; a call without result is `unanswered`, a result without call `orphan`, a reference to no call `missing_ref`, and calls in a
circle or behind one `cyclic` with a null level; empty tables give an empty result; texts of any length are read whole; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadweave.session import cut

# JSON types of the variant type names that schemas may ask for.
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "array": "ARRAY<.*>",
         "object": "OBJECT<.*>", "null": "VOID"}


def schema_errors(name: Column, arguments: Column, schemas: dict) -> Column:
    """Sorted list of what is wrong with arguments (a variant) under the schema of the named tool.

    `schemas`: tool -> {"properties": {field: type}, "required": [field]}; further fields are errors.
    """
    is_object = F.coalesce(F.schema_of_variant(arguments).startswith("OBJECT"), F.lit(False))
    out = F.array(F.lit("unknown_tool"))
    for tool, schema in schemas.items():
        found = []
        for field, kind in schema["properties"].items():
            value = F.try_variant_get(arguments, f"$['{field}']", "variant")
            wrong = value.isNotNull() & ~F.coalesce(F.schema_of_variant(value).rlike(f"^{KINDS[kind]}$"), F.lit(False))
            if field in schema.get("required", ()):
                found.append(F.when(value.isNull(), F.lit(f"missing:{field}")))
            found.append(F.when(wrong, F.lit(f"type:{field}")))
        keys = F.json_object_keys(arguments.cast("string"))
        extra = F.transform(F.array_except(keys, F.array(*[F.lit(f) for f in schema["properties"]]).cast("array<string>")), lambda k: F.concat(F.lit("unknown:"), k))
        mistakes = F.array_sort(F.concat(F.array_compact(F.array(*found)), F.coalesce(extra, F.array().cast("array<string>"))))
        out = F.when(name == tool, mistakes).otherwise(out)
    return F.when(arguments.isNull() | ~is_object, F.array(F.lit("invalid_json"))).otherwise(out)


KEY = ["conv_id", "call_id"]


def _first(rows: DataFrame, values: list[str], count: str) -> DataFrame:
    """One row per identifier of a conversation: the least values, and how many rows had it."""
    kept = rows.filter("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*KEY).agg(F.min(F.struct(*values)).alias("_m"), F.count(F.lit(1)).alias(count))
    return kept.select(*KEY, "_m.*", count)


def _others(rows: DataFrame, first: DataFrame, values: list[str], count: str) -> DataFrame:
    """The rows that `first` does not stand for, with their status: further ones of an identifier, and those without key."""
    repeated = first.filter(F.col(count) > 1).select(*KEY, F.struct(*values).alias("_m"))
    equal = rows.join(repeated, KEY).groupBy(*KEY, *values, "_m").agg(F.count(F.lit(1)).alias("_n"))
    copies = F.col("_n") - F.struct(*values).eqNullSafe(F.col("_m")).cast("bigint")
    again = equal.select(*KEY, *values, copies.alias("_n")).filter("_n > 0").withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    loose = rows.filter("conv_id IS NULL OR call_id IS NULL")
    return again.select(*KEY, *values, F.lit("duplicate").alias("status")).unionByName(loose.select(*KEY, *values, F.lit("unlinked").alias("status")))


def _refs() -> Column:
    return F.array_distinct(F.regexp_extract_all("arguments", F.lit(r'"\$ref"\s*:\s*"([^"\\]+)"'), F.lit(1)))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, missing) of calls (conv_id, call_id, arguments) that refer to others; level null: in or behind a circle."""
    edges = calls.select(*KEY, F.explode(_refs()).alias("ref"))
    known = edges.join(calls.select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("there")), ["conv_id", "ref"], "left")
    missing = known.groupBy(*KEY).agg(F.bool_or(F.col("there").isNull()).alias("missing"))
    edges = cut(known.filter("there").select(*KEY, "ref"), "references")
    waiting = edges.select(*KEY).distinct()
    waiting_of = lambda table: edges.join(table.withColumnRenamed("call_id", "ref").withColumn("late", F.lit(True)), ["conv_id", "ref"], "left")
    settled = cut(missing.join(waiting, KEY, "left_anti").select(*KEY, F.lit(0).alias("level")), "levels")
    left = cut(waiting, "levels")
    n, level = left.count(), 1
    while n:
        late = waiting_of(left).groupBy(*KEY).agg(F.bool_or(F.col("late").isNotNull()).alias("late"))
        ready = left.join(late.filter("NOT late"), KEY, "left_semi")
        settled = cut(settled.unionByName(ready.select(*KEY, F.lit(level).alias("level"))), "levels")
        left = cut(left.join(late.filter("late"), KEY, "left_semi"), "levels")
        before, n, level = n, left.count(), level + 1
        if n == before:
            break
    return missing.join(settled, KEY, "left").select(*KEY, "level", "missing")


def _levels_behind(calls: DataFrame, nodes: DataFrame) -> DataFrame:
    """`calls`, to which no call can refer, with their level: one more than the highest of `nodes` (call, level) they refer to."""
    texts = calls.select("conv_id", "arguments").distinct()
    edges = texts.select("conv_id", "arguments", F.explode(_refs()).alias("ref"))
    met = edges.join(nodes.select("conv_id", F.col("call_id").alias("ref"), F.col("level").alias("_l"), F.lit(True).alias("_there")), ["conv_id", "ref"], "left")
    circle = F.bool_or(F.coalesce("_there", F.lit(False)) & F.col("_l").isNull())
    found = met.groupBy("conv_id", "arguments").agg(circle.alias("_circle"), F.max("_l").alias("_l")).select(
        F.col("conv_id").alias("_c"), F.col("arguments").alias("_a"), "_circle", "_l")
    joined = calls.join(found, calls["conv_id"].eqNullSafe(F.col("_c")) & calls["arguments"].eqNullSafe(F.col("_a")), "left")
    level = F.when(~F.coalesce("_circle", F.lit(False)), F.coalesce(F.col("_l") + 1, F.lit(0)))
    return joined.withColumn("level", level).drop("_c", "_a", "_circle", "_l")


CALL_VALUES, RESULT_VALUES = ["turn", "name", "arguments"], ["turn", "content"]


def link_rows(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """Calls with their results, every call and every result in one row: linked by conversation and identifier, or on its own.

    calls: call_id, conv_id, turn, name, arguments (JSON text); results: call_id, conv_id, turn, content.
    """
    one = _first(calls, CALL_VALUES, "n_calls")
    answer = _first(results, RESULT_VALUES, "n_results")
    depth = cut(levels(one.select(*KEY, "arguments")), "depth")
    joined = one.join(answer.withColumnRenamed("turn", "result_turn"), KEY, "full").join(depth, KEY, "left")
    cyclic = F.col("missing").isNotNull() & F.col("level").isNull()
    status = (F.when(F.col("n_calls").isNull(), "orphan").when(cyclic, "cyclic").when(F.col("missing"), "missing_ref"))
    level = F.when(~F.coalesce(cyclic, F.lit(False)), F.coalesce("level", F.lit(0)))
    joined = joined.withColumn("status", status).withColumn("level", level)
    nodes = one.select(*KEY).join(depth, KEY, "left").withColumn("level", level).select(*KEY, "level")
    other_calls = _levels_behind(_others(calls, one, CALL_VALUES, "n_calls"), nodes).withColumn("n_calls", F.lit(1).cast("bigint"))
    other_results = _others(results, answer, RESULT_VALUES, "n_results").join(nodes.withColumn("_there", F.lit(True)), KEY, "left")
    other_results = (other_results.withColumn("level", F.when(F.col("_there"), F.col("level")).otherwise(0)).drop("_there")
                     .withColumnRenamed("turn", "result_turn").withColumn("n_results", F.lit(1).cast("bigint")))
    joined = joined.drop("missing").unionByName(other_calls, allowMissingColumns=True).unionByName(other_results, allowMissingColumns=True)
    joined = joined.withColumn("args", F.try_parse_json("arguments")).withColumn(
        "errors", F.when(F.col("n_calls").isNotNull(), schema_errors(F.col("name"), F.col("args"), schemas)).otherwise(F.array().cast("array<string>")))
    status = F.coalesce("status", F.when(F.size("errors") > 0, "invalid").when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    return joined.select(
        "conv_id", F.coalesce("turn", "result_turn").alias("turn"), F.lit("call").alias("kind"), "call_id", "name",
        "result_turn", "level", status.alias("status"), F.array_join("errors", ",").alias("errors"),
        F.coalesce("n_calls", F.lit(0)).cast("bigint").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        canonical({"arguments": F.col("args"), "id": F.col("call_id"), "name": F.col("name"), "result": F.col("content")}).alias("json"))


def link(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """The rows of `link_rows` that stand for an identifier: one per conversation and identifier."""
    return link_rows(calls, results, schemas).filter("status NOT IN ('duplicate', 'unlinked')")


def canonical(fields: dict[str, Column]) -> Column:
    """JSON object of columns: keys in order, no blanks, nulls left out; variants keep the order of their keys too."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def messages(rows: DataFrame) -> DataFrame:
    """Plain messages (conv_id, turn, role, text) in the form of `link`'s rows."""
    return rows.select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("bigint").alias("result_turn"), F.lit(0).alias("level"), F.lit("plain").alias("status"), F.lit("").alias("errors"),
        F.lit(0).cast("bigint").alias("n_calls"), F.lit(0).cast("bigint").alias("n_results"), canonical({"content": F.col("text"), "role": F.col("role")}).alias("json"))


# Tools that every chat can be read as calling: the user's turn asks, the next turn of the assistant answers.
REPLY = {"reply": {"properties": {"prompt": "string", "words": "integer"}, "required": ["prompt", "words"]}}
CALL_JSON = "tool_calls array<struct<id: string, function: struct<name: string, arguments: string>>>"


def chat_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, other messages) of a table (conv_id, turn, role, text).

    A text of the assistant that is a JSON object with `tool_calls`, of one call at least, makes these calls; one of role `tool` with
    `tool_call_id` is a result. Any other turn of the user is a call of `reply`, whose result is the assistant's next turn.
    """
    rows = chats.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))
    is_json = F.coalesce(F.ltrim("text").startswith("{"), F.lit(False))
    own = F.when(is_json & (F.col("role") == "assistant"), F.from_json("text", CALL_JSON)["tool_calls"])
    own = F.when(F.size(own) > 0, own)
    answered = F.when(is_json & (F.col("role") == "tool"), F.get_json_object("text", "$.tool_call_id"))
    rows = rows.withColumn("own", own).withColumn("answered", answered)
    turn_id = lambda turn: F.concat_ws(":", "conv_id", turn)
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    named = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    plain_user = (F.col("role") == "user") & named
    plain_assistant = (F.col("role") == "assistant") & F.col("own").isNull() & named
    asked = rows.filter(plain_user).select(
        turn_id(F.col("turn")).alias("call_id"), "conv_id", "turn", F.lit("reply").alias("name"), canonical({"prompt": F.col("text"), "words": words}).alias("arguments"))
    made = rows.filter("own IS NOT NULL").select("conv_id", "turn", F.explode("own").alias("c")).select(
        F.col("c.id").alias("call_id"), "conv_id", "turn", F.col("c.function.name").alias("name"), F.col("c.function.arguments").alias("arguments"))
    replied = rows.filter(plain_assistant).select(turn_id(F.col("turn") - 1).alias("call_id"), "conv_id", "turn", F.col("text").alias("content"))
    returned = rows.filter("answered IS NOT NULL").select(F.col("answered").alias("call_id"), "conv_id", "turn", F.get_json_object("text", "$.content").alias("content"))
    handled = F.coalesce(plain_user | plain_assistant, F.lit(False)) | F.col("own").isNotNull() | F.col("answered").isNotNull()
    return asked.unionByName(made), replied.unionByName(returned), rows.filter(~handled).select("conv_id", "turn", "role", "text")


def format_chats(chats: DataFrame, schemas: dict | None = None) -> DataFrame:
    """Every call with its result, every call and result that links with none, and every other message, as rows of canonical JSON."""
    calls, results, rest = chat_calls(chats)
    return link_rows(calls, results, REPLY | (schemas or {})).unionByName(messages(rest))
