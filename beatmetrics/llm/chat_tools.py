"""Tool calls of conversations: linked, ordered, validated, serialised.

Calls and results are hash-joined by conversation and call id.  Calls are put
in a topological order of what they build on, level by level.  Arguments are
parsed to variants and checked against the tool's schema, and each call becomes
one line of canonical JSON: sorted keys, no white space.  Built-in functions
only; every row is a call, so no conversation is gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatmetrics.llm.common import written

# A schema maps a tool to its parameters: name -> (JSON type, required).
Schema = dict[str, dict[str, tuple[str, bool]]]
# JSON types and the names Spark's variants give them.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT", "STRUCT"),
}
# Rows of one conversation and level are numbered in groups of so many turns.
TURNS = 64


def problems(arguments: Column, name: Column, schemas: Schema) -> Column:
    """Sorted list of what is wrong with parsed arguments; empty if they are valid."""
    kind = F.schema_of_variant(arguments)
    found = []
    for tool, parameters in sorted(schemas.items()):
        here = name == tool
        for parameter, (wanted, required) in sorted(parameters.items()):
            value = F.try_variant_get(arguments, f"$.{parameter}", "variant")
            given = F.schema_of_variant(value)
            good = F.lit(False)
            for spelled in TYPES[wanted]:
                good = good | F.startswith(given, F.lit(spelled))
            if required:
                found.append(F.when(here & value.isNull(), F.lit(f"missing {parameter}")))
            found.append(F.when(here & ~good, F.lit(f"type of {parameter}")))
        keys = F.map_keys(arguments.try_cast("map<string,variant>"))
        known = F.array(*[F.lit(p) for p in sorted(parameters)]).cast("array<string>")
        found.append(
            F.when(here & (F.size(F.array_except(keys, known)) > 0), F.lit("unknown parameter"))
        )
    tools = F.array(*[F.lit(t) for t in sorted(schemas)]).cast("array<string>")
    detail = F.array_sort(F.array_compact(F.array(*found, F.lit(None).cast("string"))))
    return (
        F.when(name.isNull() | ~F.array_contains(tools, name), F.array(F.lit("unknown tool")))
        .when(arguments.isNull(), F.array(F.lit("no JSON")))
        .when(
            ~(F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("STRUCT"))),
            F.array(F.lit("no object")),
        )
        .otherwise(detail)
    )


def levels(calls: DataFrame) -> DataFrame:
    """Adds ``level`` to calls (conv_id, call_id, after): 0, or one more than what they build on.

    An ``after`` that names no call counts as none.  A call on a cycle, or
    behind one, has no level.  One round per level, each written to the shared
    folder; the rounds end when no further call gets a level.
    """
    edges = calls.select("conv_id", "call_id", F.explode("after").alias("on")).distinct()
    known = calls.select("conv_id", F.col("call_id").alias("on"))
    edges = written(edges.join(known, ["conv_id", "on"]), "edges")
    waiting = edges.select("conv_id", "call_id").distinct()
    done = written(
        calls.select("conv_id", "call_id")
        .join(waiting, ["conv_id", "call_id"], "left_anti")
        .withColumn("level", F.lit(0)),
        "levels",
    )
    while True:
        # Calls whose every predecessor has a level, and that have none themselves.
        reached = (
            edges.join(done.withColumnRenamed("call_id", "on"), ["conv_id", "on"], "left")
            .groupBy("conv_id", "call_id")
            .agg(
                F.max("level").alias("most"),
                F.count(F.lit(1)).alias("all"),
                F.count("level").alias("ready"),
            )
            .where("all = ready")
            .select("conv_id", "call_id", (F.col("most") + 1).alias("level"))
            .join(done.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
        )
        new = written(reached, "levels")
        if new.isEmpty():
            break
        done = done.unionByName(new)
    return calls.join(done, ["conv_id", "call_id"], "left")


def with_position(df: DataFrame) -> DataFrame:
    """Adds ``position``, the place from 0 in its conversation by level, turn and id.

    Two passes: rows are numbered within groups of TURNS turns, and the sizes
    of the groups before are added, so no task orders a whole conversation.
    """
    group = ["conv_id", "level", "_block"]
    rows = df.withColumn("_block", F.floor(F.col("turn") / TURNS))
    sizes = rows.where("level IS NOT NULL").groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("level", "_block")
    sizes = sizes.withColumn(
        "_first",
        F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        - F.col("_n"),
    )
    inside = Window.partitionBy(*group).orderBy("turn", "call_id")
    placed = rows.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        placed.join(sizes.drop("_n"), group, "left")
        .withColumn("position", (F.col("_first") + F.col("_place")).cast("long"))
        .drop("_block", "_place", "_first")
    )


def link(
    calls: DataFrame, results: DataFrame, schemas: Schema, others: DataFrame | None = None
) -> DataFrame:
    """One row per call, per result without a call, and per other turn.

    calls: conv_id, call_id, turn, name, arguments (JSON text), after (ids);
    results: conv_id, call_id, turn, content; others: conv_id, turn.  Returns conv_id, call_id, turn,
    status, level, position, n_calls, n_results, problems, json.

    Of calls, and of results, with one id the first by turn counts, the number
    of all is kept.  Status: ``no_id`` (a conversation, call id or turn is
    null: kept as it is, one row each), ``orphan`` (a result without a call),
    ``cycle``, ``invalid``, ``no_result`` or ``ok``, the first that holds.  Turns
    that are neither call nor result, such as a system's, have the status
    ``other``, so that all calls, results and others are counted in some row.
    Empty tables give no rows; other columns are ignored.
    """
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & F.col("turn").isNotNull()
    key = ["conv_id", "call_id"]
    first_call = (
        calls.where(whole)
        .groupBy(*key)
        .agg(
            F.min(F.struct("turn", "name", "arguments", "after")).alias("c"),
            F.count(F.lit(1)).alias("n_calls"),
        )
        .select(*key, "c.*", "n_calls")
    )
    first_call = written(first_call, "calls")
    first_result = (
        results.where(whole)
        .groupBy(*key)
        .agg(
            F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")
        )
    )
    ordered = with_position(levels(first_call))
    joined = ordered.join(first_result, key, "full_outer")
    parsed = joined.withColumn("_parsed", F.try_parse_json("arguments"))
    checked = parsed.withColumn(
        "problems",
        F.when(F.col("turn").isNotNull(), problems(F.col("_parsed"), F.col("name"), schemas)),
    )
    status = (
        F.when(F.col("turn").isNull(), "orphan")
        .when(F.col("level").isNull(), "cycle")
        .when(F.size("problems") > 0, "invalid")
        .when(F.col("r").isNull(), "no_result")
        .otherwise("ok")
    )
    body = F.to_json(
        F.struct(
            F.col("_parsed").alias("arguments"),
            F.col("call_id").alias("id"),
            F.col("name").alias("name"),
            F.col("r.content").alias("result"),
        )
    )
    linked = checked.select(
        *key,
        F.coalesce("turn", "r.turn").alias("turn"),
        status.alias("status"),
        "level",
        "position",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        "problems",
        body.alias("json"),
    )

    def alone(df: DataFrame, status: str, n_calls: int, n_results: int) -> DataFrame:
        return df.select(
            *key,
            "turn",
            F.lit(status).alias("status"),
            F.lit(None).cast("int").alias("level"),
            F.lit(None).cast("long").alias("position"),
            F.lit(n_calls).cast("long").alias("n_calls"),
            F.lit(n_results).cast("long").alias("n_results"),
            F.lit(None).cast("array<string>").alias("problems"),
            F.lit(None).cast("string").alias("json"),
        )

    found = linked.unionByName(alone(calls.where(~whole), "no_id", 1, 0))
    found = found.unionByName(alone(results.where(~whole), "no_id", 0, 1))
    if others is None:
        return found
    named = others.withColumn("call_id", F.lit(None).cast("string"))
    return found.unionByName(alone(named, "other", 0, 0))
