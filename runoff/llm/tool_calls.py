"""Chat formatting with linked tool calls, in DataFrame operations only.

Calls and results meet in a hash join by identifier.  Calls may use the
results of other calls: they get the level of a topological order (level 0
uses none, others one more than the highest level they use), found by peeling
off, round by round, the calls whose uses all have levels; the rounds follow
the longest chain of uses, not the number of calls.  Arguments are validated
against the tools' schemas, which are configuration and become expressions.
Each call becomes one line of canonical JSON: sorted keys, no white space
between tokens, no key left out.

Rows stay separate (a line for each call), so a conversation with a third of
all calls is not gathered in one task.

Defined cases: calls and results without identifier cannot be linked (``no_id``
and ``no_call``, each row of its own); of
several calls or results with one identifier the least row counts; a result
without a call (``no_call``), a call without a result (``no_result``), one in
or behind a circle of uses (``cycle``) and one with invalid arguments
(``invalid``) come out with that status, the others with ``ok``; uses of
unknown calls are errors; arguments that are no JSON object are kept as a
string; null texts are JSON nulls; empty tables give no rows; other columns
are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runoff.llm.common import written

#: JSON types by what schema_of_variant calls them.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)",
         "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}


def levels(calls: DataFrame, uses: DataFrame) -> DataFrame:
    """(call_id, level) of the calls (call_id, unique) that no circle holds
    up; ``uses`` (call_id, used): distinct, both known calls."""
    pending = written(uses, "uses")
    ready = calls.select("call_id").join(pending, "call_id", "left_anti")
    out, level = None, 0
    while True:
        ready = written(ready.withColumn("level", F.lit(level)), "level")
        out = ready if out is None else out.union(ready)
        rest = written(pending.join(ready.select(F.col("call_id").alias("used")), "used", "left_anti"), "uses")
        freed = pending.select("call_id").distinct().join(rest, "call_id", "left_anti")
        if freed.isEmpty():
            return out
        pending, ready, level = rest, freed, level + 1


def argument_errors(schemas: dict[str, dict[str, tuple[str, bool]]], name: Column, arguments: Column) -> Column:
    """What is wrong with a call's arguments (JSON text), sorted.  schemas:
    {tool: {parameter: (type, whether it is required)}}."""
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    errors = F.array(F.concat(F.lit("unknown tool: "), F.coalesce(name, F.lit("null"))))
    for tool, parameters in sorted(schemas.items()):
        checks = []
        for p, (kind, required) in sorted(parameters.items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$['{p}']", "variant"))
            missing = found.isNull() | (found == "VOID")
            checks.append(F.when(missing, F.lit(f"{p}: missing") if required else F.lit(None))
                          .when(~found.rlike(f"^{TYPES[kind]}$"), F.lit(f"{p}: not {kind}")))
        more = F.array_except(F.json_object_keys(arguments), F.lit(sorted(parameters)))
        of = F.concat(F.array_compact(F.array(*checks)), F.transform(more, lambda k: F.concat(k, F.lit(": unknown"))))
        of = F.when(is_object, F.sort_array(of)).otherwise(F.array(F.lit("arguments are no JSON object")))
        errors = F.when(name == tool, of).otherwise(errors)
    return errors


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """conv_id, turn, call_id, level, status, errors (array) and json of every
    call (conv_id, turn, call_id, name, arguments: JSON text, uses: array of
    call ids) and every result (call_id, content) without a call."""
    named = calls.select("call_id", F.struct("conv_id", "turn", "name", "arguments", "uses").alias("call"))
    known = written(named.where("call_id is not null").groupBy("call_id").agg(F.min("call").alias("call")), "calls")
    answer = (results.where("call_id is not null").groupBy("call_id")
              .agg(F.min(F.struct(F.col("content").isNull().alias("none"), "content")).alias("result")))
    wanted = known.select("call_id", F.explode(F.array_distinct("call.uses")).alias("used")).where("used is not null")
    ids = known.select(F.col("call_id").alias("used"), F.lit(True).alias("there"))
    uses = written(wanted.join(ids, "used", "left"), "wanted")
    level = levels(known, uses.where("there").select("call_id", "used"))
    lost = (uses.where("there is null").groupBy("call_id")
            .agg(F.sort_array(F.collect_set(F.concat(F.lit("uses unknown call: "), "used"))).alias("lost")))
    linked = (known.join(answer, "call_id", "full").join(level, "call_id", "left").join(lost, "call_id", "left"))
    linked = linked.unionByName(named.where("call_id is null"), allowMissingColumns=True)
    lone = results.where("call_id is null").select("call_id", F.struct(F.col("content").isNull().alias("none"), "content").alias("result"))
    linked = linked.unionByName(lone, allowMissingColumns=True)
    errors = F.concat(argument_errors(schemas, F.col("call.name"), F.col("call.arguments")),
                      F.coalesce("lost", F.array().cast("array<string>")))
    status = (F.when(F.col("call").isNull(), "no_call").when(F.col("call_id").isNull(), "no_id")
              .when(F.col("level").isNull(), "cycle").when(F.size("errors") > 0, "invalid")
              .when(F.col("result").isNull(), "no_result").otherwise("ok"))
    quoted = F.variant_get(F.parse_json(F.to_json(F.array("call.arguments"))), "$[0]", "variant")
    line = F.struct(F.coalesce(F.try_parse_json("call.arguments"), quoted).alias("arguments"),
                    F.col("errors"), F.col("call_id").alias("id"), F.col("level"), F.col("call.name").alias("name"),
                    F.col("result.content").alias("result"), F.col("status"),
                    F.sort_array(F.array_distinct(F.array_compact("call.uses"))).alias("uses"))
    return (linked.withColumn("errors", F.when(F.col("call").isNull(), F.array().cast("array<string>")).otherwise(errors))
            .withColumn("status", status)
            .select("call.conv_id", "call.turn", "call_id", "level", "status", "errors",
                    F.to_json(line, {"ignoreNullFields": "false"}).alias("json")))
