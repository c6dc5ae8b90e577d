"""Operator 9: tool-call linking for chat formatting.

Calls and results meet in a hash join by (conversation, identifier).  A call
may name the call of its conversation that it follows; its level is the length
of that chain, found by pointer doubling (a call points to its 2^n-th
predecessor after n rounds, so a conversation of any length takes
logarithmically many rounds and no task holds a whole one).  Sorting a
conversation by (level, turn, call_id) is a topological order.  Arguments are
parsed as JSON variants, validated against the tool's schema by the kind each
value has in the JSON text (``"5"`` is no integer, an object no string), and
written as canonical JSON at every depth: keys sorted, no blanks, one spelling
per value.

No row vanishes: ``n_rows`` is the number of input rows an output row stands
for (equal rows are one), and their sum is the number of all calls and results.
Of several different calls with one identifier the smallest by (turn, name,
arguments, after) is linked, the others have status ``conflicting``.  Of several
different results the smallest by (turn, content) is the call's, the others
have status ``further``.  ``n_calls`` / ``n_results`` count all rows with the
identifier.

Defined cases: a call without result has a null result and status
``unanswered``; results without call have status ``orphan``; a predecessor that
does not exist is ignored; calls on or behind a cycle have a null level and
come last; arguments that are not a JSON object, name a key twice or are null
are invalid and serialised as null; rows without conversation or identifier are
never linked (status ``unidentified``, one row each); turns of other roles have
status ``no call``.  Integers of more than 38 digits are numbers only.  Texts
of any length Spark can parse (128 MiB) are taken whole; empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage


class Field(NamedTuple):
    name: str
    kind: str                # string, integer, number or boolean
    required: bool = True


# Variant types that a JSON value of each kind has.
KINDS = {"string": "STRING", "boolean": "BOOLEAN", "integer": r"BIGINT|DECIMAL\([0-9]+,0\)",
         "number": r"BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\)"}
KEY = ["conv_id", "call_id"]


def json_string(text: Column) -> Column:
    """``text`` as a JSON string literal."""
    packed = F.to_json(F.array(text))
    return F.substring(packed, F.lit(2), F.length(packed) - 2)


def canonical_object(pairs: list[tuple[str, Column]]) -> Column:
    """JSON object of already serialised values; keys sorted, null values kept as null."""
    parts = [F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in sorted(pairs, key=lambda p: p[0])]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def levels(calls: DataFrame) -> DataFrame:
    """``call_id, level`` for ``calls(call_id, after)`` of any one type, call_id unique; null on or behind a cycle."""
    known = calls.select(F.col("call_id").alias("after"))
    at = stage(calls.join(known, "after", "left_semi").select("call_id", "after", F.lit(1).cast("long").alias("level"))
               .union(calls.join(known, "after", "left_anti").select(
                   "call_id", F.lit(None).cast(calls.schema["after"].dataType), F.lit(0).cast("long"))), "levels")
    n, reach = at.count(), 1
    while reach <= n:
        if not at.where("after is not null").limit(1).count():
            break
        to = at.select(F.col("call_id").alias("after"), F.col("after").alias("further"), F.col("level").alias("more"))
        moving = at.where("after is not null").join(to, "after").select(
            "call_id", F.col("further").alias("after"), (F.col("level") + F.col("more")).alias("level"))
        at = stage(moving.union(at.where("after is null").select("call_id", "after", "level")), "levels")
        reach *= 2
    return at.select("call_id", F.when(F.col("after").isNull(), F.col("level")).alias("level"))


def _first_and_others(rows: DataFrame, columns: list[str], total: str) -> tuple[DataFrame, DataFrame]:
    """Of the rows of each identifier the smallest, and the different others; ``copies`` equal rows are one."""
    each = stage(rows.groupBy(*KEY, *columns).agg(F.count(F.lit(1)).alias("copies")), "tool-rows")
    first = each.groupBy(*KEY).agg(F.min(F.struct(*columns, "copies")).alias("r"), F.sum("copies").alias(total))
    others = each.join(first, KEY).where(~F.struct(*columns, "copies").eqNullSafe(
        F.col("r"))).drop("r")
    return first.select(*KEY, "r.*", total), others


def validated(calls: DataFrame, schemas: dict[str, tuple[Field, ...]]) -> DataFrame:
    """Adds ``errors`` (sorted, comma-joined; empty if valid) and ``arguments_json`` (canonical)."""
    parsed = F.try_parse_json("arguments")
    errors = F.array(F.lit("unknown tool"))
    for tool, fields in schemas.items():
        checks = []
        for f in fields:
            value = F.try_variant_get(F.col("args"), f"$['{f.name}']", "variant")
            missing = ~F.array_contains("arg_names", f.name)
            if f.required:
                checks.append(F.when(missing, F.lit(f"missing {f.name}")))
            fits = F.coalesce(F.schema_of_variant(value).rlike(f"^({KINDS[f.kind]})$"), F.lit(False))
            checks.append(F.when(~missing & ~fits, F.lit(f"{f.name} is no {f.kind}")))
        more = F.transform(F.array_except("arg_names", F.array(*[F.lit(f.name) for f in fields]).cast("array<string>")),
                           lambda k: F.concat(F.lit("unknown "), k))
        errors = F.when(F.col("name") == tool, F.concat(F.array_compact(F.array(*checks).cast("array<string>")), more)
                        ).otherwise(errors)
    ready = calls.withColumn("args", F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)).withColumn(
        "arg_names", F.when(F.col("args").isNotNull(), F.json_object_keys("arguments")))
    return ready.withColumns({
        "errors": F.when(F.col("args").isNull(), F.lit("arguments are no object")).otherwise(
            F.array_join(F.array_sort(errors), ",")),
        "arguments_json": F.to_json("args")}).drop("args", "arg_names")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, tuple[Field, ...]]) -> DataFrame:
    """``calls(conv_id, turn, call_id, name, arguments, after)`` with
    ``results(conv_id, turn, call_id, content)``: one row per call, per further
    result and per unidentified row, with level, errors, status and canonical JSON."""
    calls = calls.select(*KEY, "turn", "name", "arguments", "after")
    results = results.select(*KEY, F.col("turn").alias("result_turn"), "content")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one, same_id = _first_and_others(calls.where(named), ["turn", "name", "arguments", "after"], "n_calls")
    one = stage(one.withColumnRenamed("copies", "call_copies"), "calls")
    answer, further = _first_and_others(results.where(named), ["result_turn", "content"], "n_results")
    level = levels(one.select(
        F.struct("conv_id", "call_id").alias("call_id"),
        F.when(F.col("after").isNotNull(), F.struct("conv_id", F.col("after").alias("call_id"))).alias("after")))
    placed = one.join(level.select("call_id.*", "level"), KEY)
    # Both sides hold one row an identifier by now, so no key is hot in the hash join.
    linked = placed.join(answer.hint("shuffle_hash"), KEY, "full").withColumns({
        "status": F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered")
        .otherwise("linked"),
        "n_rows": F.coalesce("call_copies", F.lit(0)) + F.coalesce("copies", F.lit(0))})
    answered = one.select(*KEY, F.lit(True).alias("answered"))
    more = further.join(answered, KEY, "left").select(
        *KEY, "result_turn", "content", "n_results", F.col("copies").alias("n_rows"),
        F.when(F.col("answered"), "further").otherwise("orphan").alias("status"))
    parts = [more, same_id.withColumn("n_rows", F.col("copies")).withColumn("status", F.lit("conflicting")),
             calls.where(~named).withColumns({"n_calls": F.lit(1).cast("long"), "n_rows": F.lit(1).cast("long"),
                                              "status": F.lit("unidentified")}),
             results.where(~named).withColumns({"n_results": F.lit(1).cast("long"), "n_rows": F.lit(1).cast("long"),
                                                "status": F.lit("unidentified")})]
    every = linked
    for p in parts:
        every = every.unionByName(p, allowMissingColumns=True)
    called = F.col("n_calls").isNotNull()
    return validated(every, schemas).select(
        *KEY, "name", "level", F.coalesce("turn", "result_turn").alias("turn"), "status",
        F.when(called, F.col("errors")).alias("errors"),
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), F.col("n_rows").cast("long").alias("n_rows"),
        canonical_object([("id", json_string(F.col("call_id"))), ("name", json_string(F.col("name"))),
                          ("arguments", F.when(called, F.col("arguments_json"))),
                          ("result", json_string(F.col("content")))]).alias("canonical"))


# Tools of the stand-in calls: every user turn of a conversation is a call ``ask`` whose
# result is the assistant's turn after it, and which follows the user turn before.
SCHEMAS = {"ask": (Field("text", "string"), Field("turn", "integer"), Field("words", "integer", False))}


def calls_of(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stand-in calls and results of ``conversations(conv_id, turn, role, text)``."""
    name = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    calls = messages.where("role = 'user'").select(
        "conv_id", "turn", F.when(known, name(F.col("turn"))).alias("call_id"), F.lit("ask").alias("name"),
        F.to_json(F.struct("turn", "text", F.size(F.split(F.trim("text"), " +")).alias("words"))).alias("arguments"),
        F.when(known & (F.col("turn") >= 2), name(F.col("turn") - 2)).alias("after"))
    results = messages.where("role = 'assistant'").select(
        "conv_id", "turn", F.when(known, name(F.col("turn") - 1)).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def conversation_rows(messages: DataFrame) -> DataFrame:
    """``link`` over all turns of ``conversations``; turns of other roles follow with status ``no call``."""
    calls, results = calls_of(messages)
    others = messages.where("role is null or role not in ('user', 'assistant')").select(
        "conv_id", "turn", F.lit("no call").alias("status"), F.lit(0).cast("long").alias("n_calls"),
        F.lit(0).cast("long").alias("n_results"), F.lit(1).cast("long").alias("n_rows"),
        canonical_object([("role", json_string(F.col("role"))), ("text", json_string(F.col("text")))]).alias("canonical"))
    return link(calls, results, SCHEMAS).unionByName(others, allowMissingColumns=True)
