"""Chat formatting: tool calls linked to their results, checked, ordered and written as canonical JSON.

A message whose text is a JSON object may carry tool calls, {"content": ..., "tool_calls": [{"id", "name", "arguments"}]},
or, with the role "tool", a result, {"tool_call_id": ..., "content": ...}; any other text is plain content. Calls and
results are hash-joined by (conversation, identifier); both sides are first reduced to one row an identifier, so that
an identifier used very often is joined once. Arguments are checked against the tools' JSON schemas (type, required,
properties, additionalProperties, items, enum).

Order: a result depends on its call, and a message on those before it. The topological order is given by a key rather
than a position, so that no task sorts a conversation: (turn, 0, 0, 0), or for a linked result (turn of its call or its
own, whichever is later, 1, the call's place in its message, its own turn).

Canonical JSON: keys sorted, no white space, non-ASCII characters as they are, no NaN.

Defined cases: a null text is empty content, a null role is null; identifiers that aren't strings are their JSON text.
Of calls with one identifier the first (turn, then place) is linked, others are "duplicate"; of its results the first
is linked, others are "extra"; a call without result is "unanswered", a result without call is an "orphan" and keeps its
own place. A tool without schema is "unknown_tool". Repeated rows repeat in the result; rows without conversation or
turn are never linked. Other columns may stay (keep).
"""

from __future__ import annotations

import json
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._rows import annotate

CALL = "struct<id:string,name:string,arguments:string,errors:array<string>>"
PARSED = f"struct<kind:string,body:string,calls:array<{CALL}>,answers:string>"
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: Schemas of the tools that the registered query checks arguments against.
TOOLS: dict[str, dict] = {
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}}, "additionalProperties": False},
    "calculate": {"type": "object", "required": ["expression"], "properties": {"expression": {"type": "string"}}, "additionalProperties": False},
}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is(value: object, kind: str) -> bool:
    if kind == "integer":
        return (isinstance(value, int) and not isinstance(value, bool)) or (isinstance(value, float) and value.is_integer())
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return isinstance(value, KINDS.get(kind, object))


def violations(value: object, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a schema, sorted; empty if it holds."""
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: type"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: enum")
    if isinstance(value, dict):
        properties = schema.get("properties", {})
        out += [f"{at}.{k}: required" for k in schema.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in properties:
                out += violations(v, properties[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unexpected")
    elif isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{at}[{i}]")
    return sorted(out)


def _refuse(name: str) -> None:
    raise ValueError(name)


def _load(text: str) -> object:
    return json.loads(text, parse_constant=_refuse)


def _name(value: object) -> str | None:
    return value if isinstance(value, str) or value is None else canonical(value)


def _call(call: dict, schemas: dict[str, dict]) -> dict:
    arguments, errors = call.get("arguments", {}), []
    if isinstance(arguments, str):
        try:
            arguments = _load(arguments)
        except (ValueError, RecursionError):
            errors.append("$: json")
    name = _name(call.get("name"))
    if name not in schemas:
        errors.append("unknown_tool")
    elif not errors:
        errors += violations(arguments, schemas[name])
    return {"id": _name(call.get("id")), "name": name, "arguments": canonical(arguments), "errors": errors}


#: Lone surrogates, which JSON escapes can spell but UTF-8 can't hold.
_LONE = re.compile("[\ud800-\udfff]")


def parse_message(role: str | None, text: str | None, schemas: dict[str, dict]) -> dict:
    """PARSED: body is the canonical JSON of the message without its place."""
    value: object = None
    if text and text.lstrip()[:1] == "{":
        try:
            value = _load(text)
        except (ValueError, RecursionError):
            value = None
    calls, answers, content = [], None, text or ""
    if isinstance(value, dict):
        if role == "tool" and value.get("tool_call_id") is not None:
            answers, content = _name(value["tool_call_id"]), value.get("content", "")
        elif isinstance(value.get("tool_calls"), list) and all(isinstance(c, dict) for c in value["tool_calls"]):
            calls, content = [_call(c, schemas) for c in value["tool_calls"]], value.get("content", "")
    body: dict = {"content": content, "role": role}
    if calls:
        body["tool_calls"] = [{"arguments": _load(c["arguments"]), "id": c["id"], "name": c["name"]} for c in calls]
    if answers is not None:
        body["tool_call_id"] = answers
    out = {"kind": "call" if calls else "result" if answers is not None else "plain", "body": canonical(body), "calls": calls, "answers": answers}
    return json.loads(_LONE.sub("�", json.dumps(out, ensure_ascii=False))) if _LONE.search(out["body"]) else out


def _parsing(schemas: dict[str, dict], role_col: str, text_col: str):
    def parse(batch: pa.RecordBatch) -> list[dict]:
        return [parse_message(r, t, schemas) for r, t in zip(batch.column(role_col).to_pylist(), batch.column(text_col).to_pylist())]

    return parse


def link_tools(messages: DataFrame, schemas: dict[str, dict], conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """For every message: the columns in keep (conversation, turn and role by default), kind, json, link (of results),
    n_calls, n_linked, n_invalid, call_links and order key."""
    keep = keep or [conv, turn, role]
    parsed, p = annotate(messages, text, partial(_parsing, schemas, role, text), PARSED, "parsed", keep)
    calls = parsed.where(F.size(f"{p}.calls") > 0).select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.posexplode(f"{p}.calls").alias("place", "call"))
    calls = calls.where("c IS NOT NULL AND t IS NOT NULL AND call.id IS NOT NULL")
    first_call = calls.groupBy("c", F.col("call.id").alias("i")).agg(F.min(F.struct("t", "place")).alias("first_call"))
    results = parsed.where(F.col(f"{p}.answers").isNotNull() & F.col(conv).isNotNull() & F.col(turn).isNotNull())
    first_result = results.groupBy(F.col(conv).alias("c"), F.col(f"{p}.answers").alias("i")).agg(F.min(turn).alias("first_result"))
    linked = first_call.join(first_result, ["c", "i"], "full")
    by_call = calls.join(linked, (calls["c"] == linked["c"]) & (F.col("call.id") == linked["i"])).select(calls["c"], "t", "place", "first_call", "first_result")
    status = F.when((F.col("first_call.t") != F.col("t")) | (F.col("first_call.place") != F.col("place")), "duplicate").when(F.col("first_result").isNull(), "unanswered").otherwise("linked")
    per_message = by_call.select("c", "t", "place", status.alias("s")).distinct().groupBy("c", "t").agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("place", "s"))), lambda x: x["s"])).alias("call_links"), F.count_if(F.col("s") == "linked").alias("n_linked")
    )
    out = parsed.join(per_message, (F.col(conv) == F.col("c")) & (F.col(turn) == F.col("t")) & (F.size(f"{p}.calls") > 0), "left").drop("c", "t")
    out = out.join(linked, (F.col(conv) == F.col("c")) & (F.col(f"{p}.answers") == F.col("i")) & F.col(turn).isNotNull(), "left")
    is_result = F.col(f"{p}.answers").isNotNull()
    link = F.when(is_result, F.when(F.col("first_call").isNull(), "orphan").when(F.col("first_result") != F.col(turn), "extra").otherwise("linked"))
    bound = is_result & F.col("first_call").isNotNull()
    at = F.when(bound, F.greatest(F.col("first_call.t"), F.col(turn))).otherwise(F.col(turn)).cast("long")
    key = F.struct(at.alias("turn"), bound.cast("int").alias("after"), F.when(bound, F.col("first_call.place")).otherwise(0).alias("place"), F.col(turn).cast("long").alias("own"))
    invalid = F.size(F.filter(f"{p}.calls", lambda c: F.size(c["errors"]) > 0)).cast("long")
    return out.select(
        *keep, F.col(f"{p}.kind").alias("kind"), F.col(f"{p}.body").alias("json"), link.alias("link"), F.size(f"{p}.calls").cast("long").alias("n_calls"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), invalid.alias("n_invalid"), F.coalesce("call_links", F.lit("")).alias("call_links"), key.alias("order_key"),
    )


def with_tools(messages: DataFrame) -> DataFrame:
    """The registered query's input. The table's turns hold no tools, so each turn's text becomes part of a message that its
    turn and length choose. Assistants: a valid call, a call with an unexpected argument, two calls of which one lacks a
    required argument, a call of an unknown tool under an identifier used again, or plain text. Users: the result of the
    call of the turn before, of the turn after, or of that identifier (so some come early, twice or to no call), or text."""
    text, turn = F.coalesce("text", F.lit("")), F.col("turn").cast("string")
    quoted = F.to_json(F.array(text))
    quoted = F.substr(quoted, F.lit(2), F.char_length(quoted) - 2)
    kind = F.char_length(text) + F.col("turn")
    call = lambda name, id_, *arguments: F.concat(F.lit(f'{{"name": "{name}", "id": "'), id_, F.lit('", "arguments": {'), *arguments, F.lit("}}"))
    message = lambda *calls: F.concat(F.lit('{"tool_calls": ['), *calls, F.lit('], "content": '), quoted, F.lit("}"))
    own = F.concat(F.lit("c"), turn)
    asked = F.pmod(kind, F.lit(5))
    asks = (
        F.when(asked == 0, message(call("search", own, F.lit('"query": '), quoted, F.lit(', "limit": '), turn)))
        .when(asked == 1, message(call("calculate", own, F.lit('"extra": true, "expression": '), quoted)))
        .when(asked == 2, message(call("search", own, F.lit('"query": '), quoted), F.lit(", "), call("calculate", F.concat(own, F.lit("b")))))
        .when(asked == 3, message(call("browse", F.lit("c"), F.lit('"url": '), quoted)))
    )
    told = F.pmod(kind, F.lit(4))
    to = F.when(told == 0, F.concat(F.lit("c"), (F.col("turn") - 1).cast("string"))).when(told == 1, F.concat(F.lit("c"), (F.col("turn") + 1).cast("string"))).when(told == 2, F.lit("c"))
    tells = F.concat(F.lit('{"tool_call_id": "'), to, F.lit('", "content": '), quoted, F.lit("}"))
    is_result = (F.col("role") == "user") & to.isNotNull()
    said = F.when(F.col("role") == "assistant", F.coalesce(asks, text)).when(is_result, tells).otherwise(text)
    return messages.select("conv_id", "turn", F.when(is_result, "tool").otherwise(F.col("role")).alias("role"), said.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = with_tools(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))
    out = link_tools(messages, TOOLS)
    place = F.format_string("%d.%d.%d.%d", *[F.col(f"order_key.{f}") for f in ("turn", "after", "place", "own")])
    return out.select("conv_id", "turn", "role", "kind", "json", F.coalesce("link", F.lit("")).alias("link"), "n_calls", "n_linked", "n_invalid", "call_links", place.alias("place"))


SQL = """
WITH m AS (
  SELECT conv_id, turn, role, CAST(to_json(coalesce(text, '')) AS VARCHAR) AS q,
    CASE WHEN role = 'assistant' THEN (length(coalesce(text, '')) + turn) % 5 END AS asked,
    CASE WHEN role = 'user' THEN CASE (length(coalesce(text, '')) + turn) % 4 WHEN 0 THEN 'c' || (turn - 1) WHEN 1 THEN 'c' || (turn + 1) WHEN 2 THEN 'c' END END AS answers
  FROM conversations
), calls AS (
  SELECT conv_id, turn, 0 AS place, CASE asked WHEN 3 THEN 'c' ELSE 'c' || turn END AS id, CASE asked WHEN 1 THEN 'calculate' WHEN 3 THEN 'browse' ELSE 'search' END AS name,
    CASE asked WHEN 0 THEN '{"limit":' || turn || ',"query":' || q || '}' WHEN 1 THEN '{"expression":' || q || ',"extra":true}' WHEN 2 THEN '{"query":' || q || '}' ELSE '{"url":' || q || '}' END AS arguments,
    asked IN (1, 3) AS invalid
  FROM m WHERE asked < 4
  UNION ALL SELECT conv_id, turn, 1, 'c' || turn || 'b', 'calculate', '{}', true FROM m WHERE asked = 2
), first_call AS (
  SELECT conv_id, id, min(turn) AS turn, arg_min(place, (turn, place)) AS place FROM calls GROUP BY conv_id, id
), first_result AS (
  SELECT conv_id, answers AS id, min(turn) AS turn FROM m WHERE answers IS NOT NULL GROUP BY conv_id, answers
), judged AS (
  SELECT c.*, CASE WHEN c.turn <> f.turn OR c.place <> f.place THEN 'duplicate' WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS s
  FROM calls c JOIN first_call f USING (conv_id, id) LEFT JOIN first_result r USING (conv_id, id)
), by_message AS (
  SELECT conv_id, turn, count(*) AS n, count(*) FILTER (s = 'linked') AS n_linked, count(*) FILTER (invalid) AS n_invalid, string_agg(s, ',' ORDER BY place) AS call_links,
    string_agg('{"arguments":' || arguments || ',"id":"' || id || '","name":"' || name || '"}', ',' ORDER BY place) AS body
  FROM judged GROUP BY conv_id, turn
)
SELECT m.conv_id, m.turn, CASE WHEN answers IS NOT NULL THEN 'tool' ELSE role END AS role,
  CASE WHEN answers IS NOT NULL THEN 'result' WHEN b.n > 0 THEN 'call' ELSE 'plain' END AS kind,
  '{"content":' || q || ',"role":' || CASE WHEN answers IS NOT NULL THEN '"tool"' ELSE CAST(to_json(role) AS VARCHAR) END
    || CASE WHEN answers IS NOT NULL THEN ',"tool_call_id":"' || answers || '"' WHEN b.n > 0 THEN ',"tool_calls":[' || body || ']' ELSE '' END || '}' AS json,
  CASE WHEN answers IS NULL THEN '' WHEN f.turn IS NULL THEN 'orphan' WHEN r.turn <> m.turn THEN 'extra' ELSE 'linked' END AS link,
  CAST(coalesce(b.n, 0) AS BIGINT) AS n_calls, CAST(coalesce(b.n_linked, 0) AS BIGINT) AS n_linked, CAST(coalesce(b.n_invalid, 0) AS BIGINT) AS n_invalid, coalesce(call_links, '') AS call_links,
  CASE WHEN f.turn IS NOT NULL THEN greatest(f.turn, m.turn) || '.1.' || f.place || '.' || m.turn ELSE m.turn || '.0.0.' || m.turn END AS place
FROM m LEFT JOIN by_message b USING (conv_id, turn) LEFT JOIN first_call f ON f.conv_id = m.conv_id AND f.id = m.answers LEFT JOIN first_result r ON r.conv_id = m.conv_id AND r.id = m.answers
"""
