"""Operator 3: tool-call linking, in DataFrame expressions only.

Calls and results are hash-joined by (conversation, identifier), calls are
ordered topologically by what they come after, arguments are validated against
the tools' schemas, and every event becomes one line of canonical JSON (keys
sorted, no spaces, numbers in normal form). Keys are single calls, never whole
conversations, so a conversation of any length spreads over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import kept_table

_ALL = {"ignoreNullFields": "false"}  # a line has all its keys, null or not
# JSON types by the first word of Spark's schema of a variant.
_TYPES = {"STRING": "string", "BIGINT": "integer", "DOUBLE": "number", "DECIMAL": "number", "FLOAT": "number",
          "BOOLEAN": "boolean", "OBJECT": "object", "ARRAY": "array", "VOID": "null"}


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): the number of calls before it along
    ``after``, by pointer doubling, so rounds grow with the logarithm of the
    longest chain. An ``after`` that names no call of the conversation ends
    the chain; members of a cycle, and calls behind one, have a null depth."""
    links = calls.select("conv_id", "call_id", F.col("after").alias("up"))
    known = calls.select("conv_id", F.col("call_id").alias("up"), F.lit(True).alias("known"))
    state = kept_table(links.join(known, ["conv_id", "up"], "left").select(
        "conv_id", "call_id", F.when(F.col("known"), F.col("up")).alias("up"),
        F.when(F.col("known"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("depth")), "calls-depth")
    rounds = 1 + int(calls.count()).bit_length()
    for _ in range(rounds):
        if state.where("up is not null").isEmpty():
            break
        over = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"),
                            F.col("depth").alias("more"))
        state = kept_table(state.join(over, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("up2").alias("up"),
            # beyond the number of calls lies a cycle; the sum stays in bounds
            F.least(F.col("depth") + F.coalesce("more", F.lit(0)), F.lit(1 << 40)).alias("depth")), "calls-depth")
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds arguments_json (canonical, null when it is no JSON) and errors, a
    sorted array: ``json`` (no JSON object), ``tool`` (unknown tool),
    ``missing:p``, ``type:p``, ``unknown:p``. A parameter that is null and not
    required passes."""
    tools = schemas.groupBy("name").agg(
        F.collect_list(F.struct("param", "type", "required")).alias("params"))   # a tool's signature: bounded
    parsed = F.try_parse_json("arguments")
    df = calls.withColumn("parsed", parsed).join(tools, "name", "left")
    is_object = F.coalesce(F.schema_of_variant("parsed").startswith("OBJECT"), F.lit(False))
    df = df.withColumns({
        "arguments_json": F.to_json("parsed"),
        "given": F.when(is_object, F.col("parsed").cast("map<string,variant>")),
    })
    kinds = F.create_map(*(F.lit(x) for pair in _TYPES.items() for x in pair))

    def problem(p):
        value = F.col("given")[p["param"]]
        kind = F.try_element_at(kinds, F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))
        absent = ~F.map_contains_key("given", p["param"]) | (F.coalesce(kind, F.lit("null")) == "null")
        fits = (kind == p["type"]) | ((p["type"] == "number") & (kind == "integer"))
        return (F.when(absent & p["required"], F.concat(F.lit("missing:"), p["param"]))
                .when(~absent & ~F.coalesce(fits, F.lit(False)), F.concat(F.lit("type:"), p["param"])))

    found = F.filter(F.transform("params", problem), lambda e: e.isNotNull())
    unknown = F.transform(
        F.array_except(F.map_keys("given"), F.transform("params", lambda p: p["param"])),
        lambda k: F.concat(F.lit("unknown:"), k))
    errors = (F.when(F.col("given").isNull(), F.array(F.lit("json")))
              .when(F.col("params").isNull(), F.array(F.lit("tool")))
              .otherwise(F.sort_array(F.concat(found, unknown))))
    return df.withColumn("errors", errors).drop("parsed", "given", "params")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per event: conv_id, depth, call_position, step (0 call, 1
    result), position, call_id, status, name, errors, line.

    ``calls``: conv_id, position, call_id, after, name, arguments. ``results``:
    conv_id, position, call_id, content. Sorting by (conv_id, depth,
    call_position, step, position) is a topological order: a call stands after
    what it comes after and before its result, whatever the log's order was.
    status: ``linked`` (call with a result; its first result), ``open`` (call
    without one), ``repeated`` (later call of an identifier, later result),
    ``orphan`` (result without call), ``unnamed`` (null conversation or
    identifier: never linked). Of repeated rows the first by position links;
    full ties link the row that compares smallest. Null arguments are not
    JSON. Empty tables give empty results; other columns are ignored.
    """
    calls = calls.select("conv_id", "position", "call_id", "after", "name", "arguments")
    results = results.select("conv_id", "position", "call_id", "content")
    key = ["conv_id", "call_id"]
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()

    calls = kept_table(validated(calls, schemas).withColumn("row", F.monotonically_increasing_id()), "calls")
    results = kept_table(results.withColumn("row", F.monotonically_increasing_id()), "results")
    # the row that counts for each identifier: reduced before the shuffle
    first_call = calls.where(named).groupBy(key).agg(
        F.min(F.struct("position", "after", "name", "arguments", "row")).alias("c")).select(
            *key, F.col("c.row").alias("call_row"), F.col("c.position").alias("call_position"),
            F.col("c.after").alias("after"))
    first_result = results.where(named).groupBy(key).agg(
        F.min(F.struct("position", "content", "row")).alias("r")).select(*key, F.col("r.row").alias("result_row"))
    # hash joins: the side that is hashed has one row per identifier, so no key
    # fills a task's table
    links = first_call.join(first_result.hint("shuffle_hash"), key, "left")
    links = kept_table(links.join(depths(links).hint("shuffle_hash"), key, "left"), "links")
    linked_to = links.drop("after").hint("shuffle_hash")

    def state(row, other):
        return (F.when(~named, "unnamed").when(F.col("call_row").isNull(), "orphan")
                .when(F.col("row") != F.col(row), "repeated").when(F.col(other).isNull(), "open").otherwise("linked"))

    call_lines = calls.join(linked_to, key, "left").select(
        "conv_id", "depth", F.coalesce("call_position", "position").alias("call_position"), F.lit(0).alias("step"),
        "position", "call_id", state("call_row", "result_row").alias("status"), "name", "errors",
        F.concat(F.lit('{"arguments":'), F.coalesce("arguments_json", F.lit("null")), F.lit(","),
                 F.substring(F.to_json(F.struct("call_id", "name"), _ALL), 2, 1 << 30)).alias("line"))
    result_lines = results.join(linked_to, key, "left").select(
        "conv_id", "depth", F.coalesce("call_position", "position").alias("call_position"), F.lit(1).alias("step"),
        "position", "call_id", state("result_row", "call_row").alias("status"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("array<string>").alias("errors"),
        F.to_json(F.struct("call_id", "content"), _ALL).alias("line"))
    return call_lines.union(result_lines)


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: a user turn is a call of the
    tool ``reply`` and a system turn one of ``configure``, the assistant turn
    that follows is the result, and a call comes after the call whose result
    stands right before it. Identifiers are ``c<turn>``."""
    role, turn = F.col("role"), F.col("turn")
    name = F.concat(F.lit("c"), turn.cast("string"))
    is_call = F.coalesce(role.isin("user", "system"), F.lit(False))
    before = turns.where("role = 'assistant'").select(
        "conv_id", (turn + 1).alias("turn"), F.concat(F.lit("c"), (turn - 1).cast("string")).alias("after")).distinct()
    calls = turns.where(is_call).select(
        "conv_id", "turn", name.alias("call_id"),
        F.when(role == "user", "reply").otherwise("configure").alias("name"),
        F.to_json(F.struct(turn, F.col("text"), F.char_length("text").alias("n_chars"))).alias("arguments")) \
        .join(before, ["conv_id", "turn"], "left").withColumnRenamed("turn", "position")
    results = turns.where(~is_call).select(
        "conv_id", turn.alias("position"), F.concat(F.lit("c"), (turn - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"))
    return calls, results


# Signatures of the two tools of ``from_conversations``.
SCHEMAS = [("reply", "turn", "integer", True), ("reply", "text", "string", True), ("reply", "n_chars", "number", False),
           ("configure", "turn", "integer", True), ("configure", "text", "string", True)]

# DuckDB SQL for the rows of the query (turns are distinct in a conversation).
ORACLE = """
WITH t AS (SELECT *, CASE WHEN role IN ('user', 'system') THEN 0 ELSE 1 END AS step FROM conversations),
c AS (SELECT conv_id, turn FROM t WHERE step = 0),
r AS (SELECT conv_id, turn FROM t WHERE step = 1),
linked AS (SELECT c.conv_id, c.turn FROM c JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1),
ups AS (SELECT c.conv_id, c.turn, l.turn AS up FROM c
        JOIN linked l ON l.conv_id = c.conv_id AND l.turn = c.turn - 2
        JOIN t a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1 AND a.role = 'assistant'),
runs AS (SELECT c.conv_id, c.turn, c.turn % 2 AS half,
                sum(CASE WHEN ups.turn IS NULL THEN 1 ELSE 0 END)
                  OVER (PARTITION BY c.conv_id, c.turn % 2 ORDER BY c.turn) AS run
         FROM c LEFT JOIN ups ON ups.conv_id = c.conv_id AND ups.turn = c.turn),
depth AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, half, run ORDER BY turn) - 1 AS depth FROM runs)
SELECT t.conv_id, d.depth, CASE WHEN step = 1 AND d.turn IS NOT NULL THEN d.turn ELSE t.turn END AS call_position,
  t.step, t.turn AS position, 'c' || (t.turn - t.step) AS call_id,
  CASE WHEN d.turn IS NULL THEN 'orphan' WHEN step = 1 OR l.turn IS NOT NULL THEN 'linked' ELSE 'open' END AS status,
  CASE WHEN step = 0 THEN CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END END AS name,
  CASE WHEN step = 0 THEN CASE role WHEN 'user' THEN '' ELSE 'unknown:n_chars' END END AS errors,
  CASE WHEN step = 0 THEN
    '{"arguments":{"n_chars":' || length(text) || ',"text":' || to_json(text) || ',"turn":' || t.turn
      || '},"call_id":"c' || t.turn || '","name":"' || CASE role WHEN 'user' THEN 'reply' ELSE 'configure' END || '"}'
  ELSE '{"call_id":"c' || (t.turn - 1) || '","content":' || to_json(text) || '}' END AS line
FROM t LEFT JOIN depth d ON d.conv_id = t.conv_id AND d.turn = t.turn - t.step
LEFT JOIN linked l ON l.conv_id = t.conv_id AND l.turn = t.turn"""
