"""Tool calls: link calls and results by identifier, order calls topologically,
validate their arguments against schemas and serialise canonical JSON.

Chat messages are (conversation, turn, role, text). A message whose text is
``{"tool_calls": [{"id", "name", "arguments", "after"}]}`` makes calls, ``after``
naming calls whose results they need; one of role ``tool`` with
``{"tool_call_id", "content"}`` is a result.

Statuses of calls: answered, unanswered, repeated_call (its id was used before in
the conversation), no_id. Of results: answer (the first one after its call),
repeated_result, early_result (before its call), orphan_result, no_id. The order
of a conversation's calls is (level, turn, place); a call's level is one more than the
greatest of those it needs, 0 for none, null on or behind a cycle. Calls that
are named in ``after`` but do not exist are left out and counted in ``missing``.

Calls and results meet in hash joins on (conversation, id); records without an id
or a conversation stay out of these joins. A conversation's calls are ordered in one
task where at most ``EDGES_IN_PLACE`` needs connect them; larger conversations are
ordered in rounds (one per level) that only touch the calls still waiting.

Defined results: null or unparsable texts, and tool messages without an id and a
content, make no records; long texts go through whole; repeated messages make repeated records (the first by turn
and place counts); an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import Scratch

CALLS = "conversation long, turn long, place int, call_id string, name string, arguments string, after array<string>"
RESULTS = "conversation long, turn long, place int, call_id string, content string"
KEY = ["conversation", "call_id"]
EDGES_IN_PLACE = 100_000  # needs among a conversation's calls that one task takes
NODE = ["conversation", "node"]  # a call in the order: its id, or its own number where it has none


def canonical(value) -> str:
    """Keys in code point order, no spaces, text as it is, whole numbers without a fraction."""
    def plain(v):
        if isinstance(v, float) and v.is_integer() and abs(v) < 1e15:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(v[k]) for k in sorted(v)}
        return [plain(x) for x in v] if isinstance(v, list) else v

    return json.dumps(plain(value), ensure_ascii=False, separators=(",", ":"))


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What of a JSON schema (type, enum, minimum, maximum, required, properties,
    additionalProperties, items) the value breaks, as path and keyword."""
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    kind = schema.get("type")
    if kind in ("integer", "number"):
        fits = isinstance(value, (int, float)) and not isinstance(value, bool) and (kind == "number" or float(value).is_integer())
    else:
        fits = kind is None or isinstance(value, kinds.get(kind, object))
    if not fits:
        return [f"{path}:type"]
    out = [f"{path}:enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{path}:minimum"] * (value < schema.get("minimum", value)) + [f"{path}:maximum"] * (value > schema.get("maximum", value))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}:required" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}:additionalProperties" for k in sorted(value) if k not in known]
        for k in sorted(value):
            out += violations(value[k], known[k], f"{path}.{k}") if k in known else []
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{path}[{i}]")
    return out


def parse(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(calls, results) of chat messages."""
    rows = messages.select(F.col(conversation).cast("long").alias("conversation"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    call = "struct<id:string,name:string,arguments:string,after:array<string>>"
    made = F.from_json("text", f"tool_calls array<{call}>")
    calls = rows.filter(F.coalesce("role", F.lit("")) != "tool").select("conversation", "turn", F.posexplode(made["tool_calls"]).alias("place", "c"))
    calls = calls.select("conversation", "turn", "place", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.after")
    result = F.from_json("text", "tool_call_id string, content string")
    results = rows.filter("role = 'tool'").select("conversation", "turn", F.lit(0).alias("place"), result.alias("r"))
    results = results.filter(F.col("r.tool_call_id").isNotNull() | F.col("r.content").isNotNull())
    return calls, results.select("conversation", "turn", "place", F.col("r.tool_call_id").alias("call_id"), F.col("r.content").alias("content"))


def levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """(conversation, node, level, missing) of the calls that need others."""
    nodes = calls.select(*NODE).distinct()
    wants = calls.select(*NODE, F.explode("after").alias("parent")).withColumn("parent", F.concat(F.lit("="), "parent")).distinct()
    there = nodes.select("conversation", F.col("node").alias("parent"), F.lit(True).alias("there"))
    edges = scratch.table(wants.join(there, ["conversation", "parent"], "left").select(*NODE, "parent", F.coalesce("there", F.lit(False)).alias("there")), "edges")
    waiting = scratch.table(edges.filter("there").select(*NODE, "parent"), "waiting-0")
    missing = edges.groupBy(*NODE).agg(F.count(F.when(~F.col("there"), 1)).alias("missing"), F.max("there").alias("waits"))
    done = missing.filter("not waits").select(*NODE, F.lit(0).alias("level"))
    sizes = scratch.table(waiting.groupBy("conversation").agg(F.count("*").alias("n")).filter(F.col("n") > EDGES_IN_PLACE), "large")
    few = waiting
    if not sizes.isEmpty():
        large = common.sized(sizes.select("conversation"))
        few = waiting.join(large, "conversation", "left_anti")
        done = done.unionByName(in_rounds(scratch.table(waiting.join(large, "conversation", "left_semi"), "waiting-large"), scratch))
    done = done.unionByName(few.groupBy("conversation").applyInArrow(ordered, "conversation bigint, node string, level int"))
    return missing.select(*NODE, "missing").join(done, NODE)


def ordered(edges: pa.Table) -> pa.Table:
    """(conversation, node, level) of one conversation's calls that wait for others: one more than the
    greatest level they need, null in cycles and behind them. At most ``EDGES_IN_PLACE`` edges."""
    needs, needed_by = defaultdict(set), defaultdict(list)
    for node, parent in zip(edges.column("node").to_pylist(), edges.column("parent").to_pylist(), strict=True):
        needs[node].add(parent)
    for node, parents in needs.items():
        for parent in parents:
            needed_by[parent].append(node)
    level = {parent: 0 for parent in needed_by if parent not in needs}
    queue = deque(level)
    open_ = {node: len(parents) for node, parents in needs.items()}
    while queue:
        parent = queue.popleft()
        for node in needed_by[parent]:
            open_[node] -= 1
            if not open_[node]:
                level[node] = 1 + max(level[x] for x in needs[node])
                queue.append(node)
    nodes = list(needs)
    return pa.table({"conversation": pa.array([edges.column("conversation")[0].as_py()] * len(nodes), pa.int64()), "node": pa.array(nodes, pa.string()),
                     "level": pa.array([level.get(n) for n in nodes], pa.int32())})


def in_rounds(waiting: DataFrame, scratch: Scratch) -> DataFrame:
    """The same for conversations of any size: a round per level over the calls that still wait."""
    done, level = None, 0
    while not waiting.isEmpty():
        # calls that still wait for something waiting are not ready
        blocked = waiting.select("conversation", F.col("node").alias("parent")).distinct()
        left = waiting.join(blocked, ["conversation", "parent"], "left_semi").select(*NODE, "parent")
        left = scratch.table(left, f"waiting-{level + 1}")
        ready = waiting.select(*NODE).distinct().join(left.select(*NODE).distinct(), NODE, "left_anti")
        ready = scratch.table(ready, f"ready-{level + 1}")
        if ready.isEmpty():
            break  # cycles, and what stands behind them
        level += 1
        now = ready.withColumn("level", F.lit(level))
        done = now if done is None else done.unionByName(now)
        waiting = left
    stuck = waiting.select(*NODE).distinct().withColumn("level", F.lit(None).cast("int"))
    return stuck if done is None else done.unionByName(stuck)


def checked(rows: DataFrame) -> DataFrame:
    """Replace payload and schema by canonical JSON (null if unparsable) and what the schema finds."""
    kept = [f for f in rows.schema.fields if f.name not in ("payload", "schema")]
    names = [f.name for f in rows.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemas: dict = {}
        for batch in batches:
            made, found = [], []
            for payload, schema in zip(batch.column(names.index("payload")).to_pylist(), batch.column(names.index("schema")).to_pylist(), strict=True):
                try:
                    value = json.loads(payload)
                    made.append(canonical(value))
                except (TypeError, ValueError):
                    made.append(None)
                    found.append(None if schema is None else ["$:json"])
                    continue
                if schema is not None and schema not in schemas:
                    schemas = schemas if len(schemas) < 1000 else {}
                    schemas[schema] = json.loads(schema)
                found.append(None if schema is None else violations(value, schemas[schema]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(made, pa.string()), pa.array(found, pa.list_(pa.string()))], [*(f.name for f in kept), "canonical", "errors"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("canonical", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType()))]))


def _joined(rows: DataFrame, facts: list[DataFrame]) -> DataFrame:
    """``rows`` left-joined to per-id facts. Rows without an id or a conversation meet none: they
    are not shuffled by that key, so very many of them are no single task's."""
    keyed = F.col("conversation").isNotNull() & F.col("call_id").isNotNull()
    out, rest = rows.filter(keyed), rows.filter(~keyed)
    for f in facts:
        out = out.join(f.hint("shuffle_hash"), KEY, "left")
        rest = rest.withColumns({c: F.lit(None).cast(f.schema[c].dataType) for c in f.columns if c not in KEY})
    return out.unionByName(rest)


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per call and per result: conversation, turn, place, kind, call_id, name, status,
    level, missing, canonical, errors. ``schemas`` has (name, schema as JSON); a call
    of an unknown name has null errors."""
    node = F.coalesce(F.concat(F.lit("="), "call_id"), F.concat(F.lit("#"), F.monotonically_increasing_id().cast("string")))
    calls, results = scratch.table(calls.withColumn("node", node), "calls"), scratch.table(results, "results")
    at = F.struct("turn", "place")
    first = scratch.table(calls.groupBy(*KEY).agg(F.min(at).alias("first")), "first")
    met = _joined(results, [first]).withColumn("at", at)
    answers = met.filter("at > first").groupBy(*KEY).agg(F.min("at").alias("answer"))
    answers = scratch.table(answers, "answers")
    order = scratch.table(levels(calls, scratch), "levels")
    made = _joined(calls, [first, answers]).join(order.hint("shuffle_hash"), NODE, "left")
    status = F.when(F.col("call_id").isNull(), "no_id").when(at != F.col("first"), "repeated_call").when(F.col("answer").isNull(), "unanswered").otherwise("answered")
    level = F.when(F.col("missing").isNull(), F.lit(0)).otherwise(F.col("level"))
    made = made.select("conversation", "turn", "place", F.lit("call").alias("kind"), "call_id", "name", status.alias("status"), level.alias("level"),
                       F.coalesce("missing", F.lit(0)).alias("missing"), F.col("arguments").alias("payload"))
    known = scratch.table(schemas.select("name", "schema"), "schemas")
    made = common.spread_lookup(made, known, "name", F.concat_ws(":", "conversation", "turn", "place"))
    status = (F.when(F.col("call_id").isNull(), "no_id").when(F.col("first").isNull(), "orphan_result").when(F.col("at") < F.col("first"), "early_result")
              .when(F.col("at") == F.col("answer"), "answer").otherwise("repeated_result"))
    got = _joined(met, [answers])
    got = got.select("conversation", "turn", "place", F.lit("result").alias("kind"), "call_id", F.lit(None).cast("string").alias("name"), status.alias("status"),
                     F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("missing"), F.col("content").alias("payload"), F.lit(None).cast("string").alias("schema"))
    return checked(made.unionByName(got))


#: Schemas of the calls that op2 derives from conversations.
TURN_SCHEMAS = {
    "configure": {"type": "object", "required": ["text", "words"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"}, "words": {"type": "integer", "minimum": 1}}},
    "reply": {"type": "object", "required": ["text", "words"], "additionalProperties": False,
              "properties": {"text": {"type": "string"}, "words": {"type": "integer", "minimum": 8}}},
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations without tool messages as calls and results: a system turn is a call
    ``configure``, a user turn a call ``reply`` that needs the call at its turn number less
    its lowest binary digit, and an assistant turn the result for the turn before it."""
    rows = conversations.select(F.col("conv_id").alias("conversation"), "turn", F.lit(0).alias("place"), "role", F.coalesce("text", F.lit("")).alias("text"))
    name = F.when(F.col("role") == "system", "configure").when(F.col("role") == "user", "reply")
    payload = F.to_json(F.struct(F.size(common.words(F.col("text"))).alias("words"), "text"))
    number = lambda c: F.concat(F.lit("turn-"), c.cast("string"))
    parent = F.col("turn").bitwiseAND(F.col("turn") - 1)
    after = F.when((name == "reply") & (F.col("turn") > 0), F.array(number(parent))).otherwise(F.array().cast("array<string>"))
    calls = rows.filter(name.isNotNull()).select("conversation", "turn", "place", number(F.col("turn")).alias("call_id"), name.alias("name"), payload.alias("arguments"), after.alias("after"))
    results = rows.filter(name.isNull()).select("conversation", "turn", "place", number(F.col("turn") - 1).alias("call_id"), F.to_json(F.struct("text")).alias("content"))
    return calls, results


def marked(rows: DataFrame, mark: str) -> DataFrame:
    """Ids with a mark in front, so that equal ids of different origins do not meet."""
    out = rows.withColumn("call_id", F.concat(F.lit(mark), "call_id"))
    return out.withColumn("after", F.transform("after", lambda x: F.concat(F.lit(mark), x))) if "after" in rows.columns else out


def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tool call and tool result of all conversations, and every other turn read
    as one (``turns_as_calls``), linked, ordered and validated."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    calls, results = (marked(part, "t") for part in parse(rows))
    made = F.from_json("text", "tool_calls array<struct<id:string>>")["tool_calls"]
    tool = (F.coalesce("role", F.lit("")) == "tool") | (F.coalesce(F.size(made), F.lit(0)) > 0)
    turn_calls, turn_results = (marked(part, "n") for part in turns_as_calls(rows.filter(~tool)))
    calls = calls.unionByName(turn_calls)
    results = results.unionByName(turn_results)
    schemas = spark.createDataFrame([(k, json.dumps(v)) for k, v in TURN_SCHEMAS.items()], "name string, schema string")
    out = link(calls, results, schemas, Scratch(spark, "calls"))
    return out.select(F.col("conversation").alias("conv_id"), "turn", "kind", F.substr("call_id", F.lit(2)).alias("call_id"), "name", "status", "level", "missing", F.array_join("errors", ",").alias("errors"), "canonical")


OP2_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(text, '') AS text, CASE role WHEN 'system' THEN 'configure' WHEN 'user' THEN 'reply' END AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations),
k AS (SELECT *, CASE WHEN name = 'reply' AND turn > 0 THEN turn & (turn - 1) END AS parent FROM c WHERE name IS NOT NULL),
r AS (SELECT a.conv_id, a.turn, a.text, k.turn AS answers FROM c a LEFT JOIN k ON k.conv_id = a.conv_id AND k.turn = a.turn - 1 WHERE a.name IS NULL),
v AS (
  SELECT k.conv_id, k.turn, 0 AS level FROM k LEFT JOIN k p ON p.conv_id = k.conv_id AND p.turn = k.parent WHERE p.turn IS NULL
  UNION ALL
  SELECT k.conv_id, k.turn, v.level + 1 FROM k JOIN v ON v.conv_id = k.conv_id AND v.turn = k.parent)
SELECT k.conv_id, k.turn, 'call' AS kind, 'turn-' || k.turn AS call_id, k.name,
  CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status, v.level,
  (k.parent IS NOT NULL AND p.turn IS NULL)::BIGINT AS missing,
  CASE WHEN k.words < CASE k.name WHEN 'reply' THEN 8 ELSE 1 END THEN '$.words:minimum' ELSE '' END AS errors,
  '{"text":' || to_json(k.text) || ',"words":' || k.words || '}' AS canonical
FROM k JOIN v USING (conv_id, turn) LEFT JOIN k p ON p.conv_id = k.conv_id AND p.turn = k.parent LEFT JOIN r ON r.conv_id = k.conv_id AND r.answers = k.turn
UNION ALL
SELECT conv_id, turn, 'result', 'turn-' || (turn - 1), NULL, CASE WHEN answers IS NULL THEN 'orphan_result' ELSE 'answer' END, NULL, NULL, NULL,
  '{"text":' || to_json(text) || '}'
FROM r
"""
