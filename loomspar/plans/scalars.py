"""Queries of the scalar functions; blanks, noise and bad values are put in by the rows' keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.functions import scalars as S
from loomspar.operators.cells import cells, system_field, unwrapped


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(k: Column, *values: Column | str | None) -> Column:
    """values[k % n]."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(values):
        out = F.when(k % len(values) == i, F.lit(v) if isinstance(v, str) or v is None else v).otherwise(out)
    return out


def _sql_pick(k: str, *values: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} % {len(values)} = {i} THEN {v}" for i, v in enumerate(values)) + " END"


def normalize_field_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = F.concat(_pick(F.col("p_partkey"), " ", "_", "-", "/"), F.upper("p_name"), F.lit(" -_/"), "p_type")
    return p.select("p_partkey", S.normal_name(raw).alias("norm"), S.preview_name(raw).alias("preview"))


def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _table(spark, sf_dir, "documents")
    noisy = F.concat(F.lit("\t\u200b\u00a0 "), F.regexp_replace("text", "the", "t\u200dhe"), F.lit("\ufeff\u00a0 \n"))
    return d.select("doc_id", S.strip(S.strip_invisible(noisy)).alias("clean"))


def number_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = _pick(F.col("p_partkey"), F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")), "abc", "0x1f", "1e3", "-0", "", "Infinity", "1d", ".5", "0b101", "12.", None)
    return p.select("p_partkey", S.to_number(raw).alias("number"))


def excel_serial_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return o.select("o_orderkey", S.day_text(S.serial_date((F.col("o_orderkey") - 5).cast("double") + 0.5)).alias("day"))


def epoch_to_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return e.select("event_id", S.epoch_datetime(F.when(F.col("event_id") % 2 == 0, millis).otherwise(F.floor(millis / 1000))).alias("stamp"))


def iso_date_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = _pick(F.col("o_orderkey"), day, F.concat(day, F.lit("T10:30:00Z")), "2023-02-30", F.concat(day, F.lit("T23:30:00-05:00")), "n/a", F.concat(F.lit(" "), day), F.concat(day, F.lit("T23:30:00+05:00")))
    return o.select("o_orderkey", S.iso_date(raw).alias("day"))


def iso_datetime_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = _pick(F.col("o_orderkey"), day, F.concat(day, F.lit("T10:30")), F.concat(day, F.lit("T10:30:15.250Z")), F.concat(day, F.lit("T23:30:00-05:00")), "2023-02-30", "soon")
    return o.select("o_orderkey", S.iso_datetime(raw).alias("stamp"))


def duration_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", S.duration_text((F.col("l_quantity") * 7919).cast("long") - 20000).alias("duration"))


def duration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    n = F.col("event_id").cast("string")
    raw = _pick(F.col("event_id"), F.concat(n, F.lit(" hours")), F.concat(n, F.lit("min")), F.lit("1w 2d 3h"), F.concat(n, F.lit(" Day")), F.lit("1W"), F.lit("soon"), F.lit(""), F.concat(F.lit(" "), n, F.lit("m ")))
    return e.select("event_id", S.duration_value(raw).alias("duration"))


def split_array_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = _pick(F.col("p_partkey"), F.concat("p_name", F.lit(" , ,"), "p_type"), F.lit(""), F.concat(F.lit(","), "p_brand"))
    items = S.split_list(raw)
    return p.select("p_partkey", F.array_join(items, "|").alias("items"), F.size(items).cast("long").alias("n_items"))


def cascade_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = _pick(F.col("p_partkey"), F.concat("p_type", F.lit(" -> "), "p_brand"), F.concat("p_type", F.lit("/"), "p_brand", F.lit(" -> x")), F.concat("p_type", F.lit(" , "), "p_brand"), F.col("p_brand"), F.concat("p_type", F.lit("|"), "p_brand"), F.concat(F.lit("-> "), "p_brand"))
    return p.select("p_partkey", S.split_cascade(raw).alias("s")).select("p_partkey", "s.parent", "s.child")


def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    raw = _pick(F.col("c_custkey"), F.concat(F.lit("ab-"), F.col("c_custkey").cast("string")), F.lit("PROJ1"), F.lit("Sub-Task"), F.lit("sub task"), F.lit(""), F.lit(" "), F.lit("Issue_Type"), F.lit("a.b@c.de"), F.lit("1AB"), None)
    return c.select(
        "c_custkey", S.is_blank(raw).alias("blank"), S.is_record_key(raw).alias("record_key"), S.looks_like_project_key(raw).alias("project_key"), S.is_subtask_type(raw).alias("subtask"),
        F.coalesce(S.is_meta_field(raw), F.lit(False)).alias("meta"), S.is_email(raw).alias("email"),
    )


def text_escapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = F.concat("p_name", F.lit('\\ "'), "p_type", _pick(F.col("p_partkey"), "\r\n", "\r", "\n", ""))
    return p.select("p_partkey", S.escape_search(raw).alias("search"), S.double_backslashes(raw, "yaml").alias("doubled"), S.line_ending(raw).alias("ending"))


def marker_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    mark = S.marker(F.when(F.col("p_partkey") % 3 == 0, F.repeat("p_name", 40)).otherwise(F.col("p_name")), F.lit(1700000000000) + F.col("p_partkey"))
    labels = F.when(F.col("p_partkey") % 2 == 0, F.split("p_type", "E")).when(F.col("p_partkey") % 5 == 0, F.array(mark))
    return p.select("p_partkey", F.array_join(S.with_marker(labels, mark), ",").alias("labels"), F.length(mark).cast("long").alias("mark_length"))


def error_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    raw = _pick(F.col("event_id"), "Summary is Required", "Value does not exist", "No permission to set", "Entity not found", "is ambiguous", "Internal server error", "forbidden", "is not valid", "hm")
    status = F.element_at(F.array(*map(F.lit, (400, 401, 403, 404, 500, 503, 429))), (F.col("event_id") % 7 + 1).cast("int"))
    return e.select("event_id", S.field_error_code(raw).alias("field_code"), S.global_error_code(raw).alias("global_code"), S.status_error_code(status).alias("status_code"))


def system_field_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    key = _pick(F.col("event_id"), "project", "PRO_JECT", "Pro ject", "other")
    value = _pick(F.col("event_id"), F.concat(F.lit('{"key":"'), "event_type", F.lit('"}')), F.concat(F.lit('" '), "event_type", F.lit(' "')), F.col("event_id").cast("string"), F.lit('""'), F.lit("null"))
    raw = F.concat(F.lit('{"a":1,"'), key, F.lit('":'), value, F.lit(',"Project":"last"}'))
    found = system_field(cells(e.select(F.col("event_id").alias("row_index"), raw.alias("raw"))), "project")
    return found.select(F.col("row_index").alias("event_id"), "key", "extracted")


def unwrap_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    raw = _pick(F.col("event_id"), F.concat(F.lit('{"value":'), F.get_json_object("props", "$.k"), F.lit("}")), F.col("props"), F.lit('{"value":"x","id":"1"}'), F.lit('{"value":[1]}'))
    return e.select("event_id", F.to_json(unwrapped(F.parse_json(raw))).alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_field_name, sanitize_text, number_convert, excel_serial_date, epoch_to_datetime, iso_date_check, iso_datetime_check, duration_format, duration_parse, split_array_field, cascade_split,
        predicates, text_escapes, marker_inject, error_classify, system_field_extract, unwrap_single_key,
    )
}

_LI = "(CAST(l_quantity * 7919 AS BIGINT) - 20000)"
_UNIT = lambda n, d, u: f"CASE WHEN ({n}) // {d} > 0 THEN (({n}) // {d}) || '{u}' END"
_CASCADE = _sql_pick("p_partkey", "p_type || ' -> ' || p_brand", "p_type || '/' || p_brand || ' -> x'", "p_type || ' , ' || p_brand", "p_brand", "p_type || '|' || p_brand", "'-> ' || p_brand")
SQL = {
    "normalize_field_name": f"""WITH t AS (SELECT p_partkey, {_sql_pick('p_partkey', "' '", "'_'", "'-'", "'/'")} || upper(p_name) || ' -_/' || p_type AS r FROM part)
        SELECT p_partkey, regexp_replace(lower(r), '[\\s_\\-/]', '', 'g') AS norm, regexp_replace(lower(r), '[\\s_\\-]', '', 'g') AS preview FROM t""",
    "sanitize_text": "SELECT doc_id, regexp_replace(regexp_replace(replace(text, chr(160), ' '), '^\\s+', ''), '\\s+$', '') AS clean FROM documents",
    "number_convert": f"SELECT p_partkey, {_sql_pick('p_partkey', 'CAST(p_size AS DOUBLE)', 'NULL', '31.0::DOUBLE', '1000.0', '0.0', 'NULL', 'NULL', 'NULL', '0.5', '5.0', '12.0', 'NULL')} AS number FROM part",
    "excel_serial_date": """SELECT o_orderkey, CASE WHEN o_orderkey - 4.5 > 0 THEN strftime(DATE '1900-01-01' + CAST(floor(o_orderkey - 4.5) AS INTEGER) - CASE WHEN o_orderkey - 4.5 <= 60 THEN 1 ELSE 2 END, '%Y-%m-%d') END AS day FROM orders""",
    "epoch_to_datetime": "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000') ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000+0000') END AS stamp FROM events",
    "iso_date_check": f"""SELECT o_orderkey, {_sql_pick('o_orderkey', "d", "d", "NULL", "NULL", "NULL", "d", "d")} AS day FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""",
    "iso_datetime_check": f"""SELECT o_orderkey, {_sql_pick('o_orderkey', "d || 'T00:00:00.000+0000'", "d || 'T10:30:00.000+0000'", "d || 'T10:30:15.250+0000'", "e || 'T04:30:00.000+0000'", "NULL", "NULL")} AS stamp
        FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS e FROM orders)""",
    "duration_format": f"""SELECT l_orderkey, l_linenumber, CASE WHEN s >= 0 THEN coalesce(nullif(concat_ws(' ', {_UNIT('s', 144000, 'w')}, {_UNIT('s % 144000', 28800, 'd')}, {_UNIT('s % 28800', 3600, 'h')}, {_UNIT('s % 3600', 60, 'm')}), ''), '0m') END AS duration
        FROM (SELECT l_orderkey, l_linenumber, {_LI} AS s FROM lineitem)""",
    "duration_parse": f"SELECT event_id, {_sql_pick('event_id', "event_id || 'h'", "event_id || 'm'", "'1w 2d 3h'", "event_id || 'd'", "'1w'", "NULL", "NULL", "event_id || 'm'")} AS duration FROM events",
    "split_array_field": f"SELECT p_partkey, {_sql_pick('p_partkey', "p_name || '|' || p_type", "''", "p_brand")} AS items, CAST({_sql_pick('p_partkey', '2', '0', '1')} AS BIGINT) AS n_items FROM part",
    "cascade_split": f"SELECT p_partkey, {_sql_pick('p_partkey', 'p_type', "p_type || '/' || p_brand", 'p_type', 'NULL', 'p_type', "'-'")} AS parent, {_sql_pick('p_partkey', 'p_brand', "'x'", 'p_brand', 'p_brand', 'p_brand', 'p_brand')} AS child FROM part",
    "predicates": "SELECT c_custkey, c_custkey % 10 IN (4, 9) AS blank, c_custkey % 10 = 0 AS record_key, c_custkey % 10 = 1 AS project_key, c_custkey % 10 IN (2, 3) AS subtask, c_custkey % 10 = 6 AS meta, c_custkey % 10 = 7 AS email FROM customer",
    "text_escapes": f"""WITH t AS (SELECT p_partkey, p_name || '\\ "' || p_type || {_sql_pick('p_partkey', "chr(13) || chr(10)", "chr(13)", "chr(10)", "''")} AS r FROM part)
        SELECT p_partkey, replace(replace(r, '\\', '\\\\'), '"', '\\"') AS search, replace(r, '\\', '\\\\') AS doubled, {_sql_pick('p_partkey', "'CRLF'", "'CR'", "'LF'", "'LF'")} AS ending FROM t""",
    "marker_inject": """WITH t AS (SELECT p_partkey, p_type, 'bulk-job-' AS h, regexp_replace(CASE WHEN p_partkey % 3 = 0 THEN repeat(p_name, 40) ELSE p_name END, '[^A-Za-z0-9\\-_]', '-', 'g') AS j, '-' || (1700000000000 + p_partkey) AS e FROM part),
        m AS (SELECT *, h || left(j, 255 - length(h) - length(e)) || e AS mark FROM t)
        SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN array_to_string(list_append(string_split(p_type, 'E'), mark), ',') ELSE mark END AS labels, length(mark) AS mark_length FROM m""",
    "error_classify": f"""SELECT event_id, {_sql_pick('event_id', "'REQUIRED_FIELD'", "'INVALID_VALUE'", "'PERMISSION_DENIED'", "'NOT_FOUND'", "'INVALID_VALUE'", "'INVALID_VALUE'", "'INVALID_VALUE'", "'INVALID_VALUE'", "'INVALID_VALUE'")} AS field_code,
        {_sql_pick('event_id', "'REQUIRED_FIELD'", "'INVALID_VALUE'", "'PERMISSION_DENIED'", "'NOT_FOUND'", "'AMBIGUOUS'", "'SERVER_ERROR'", "'PERMISSION_DENIED'", "'INVALID_VALUE'", "'INVALID_VALUE'")} AS global_code,
        {_sql_pick('event_id', "'VALIDATION_ERROR'", "'AUTHENTICATION_ERROR'", "'PERMISSION_DENIED'", "'NOT_FOUND'", "'SERVER_ERROR'", "'SERVER_ERROR'", "NULL")} AS status_code FROM events""",
    "system_field_extract": f"""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'Project' ELSE {_sql_pick('event_id', "'project'", "'PRO_JECT'", "'Pro ject'", "''")} END AS key,
        CASE WHEN event_id % 4 = 3 THEN 'last' ELSE {_sql_pick('event_id', 'event_type', 'event_type', 'CAST(event_id AS VARCHAR)', 'NULL', 'NULL')} END AS extracted FROM events""",
    "unwrap_single_key": f"""SELECT event_id, {_sql_pick('event_id', "json_extract_string(props, '$.k')", "'{\"k\":' || json_extract_string(props, '$.k') || '}'", "'{\"id\":\"1\",\"value\":\"x\"}'", "'{\"value\":[1]}'")} AS value FROM events""",
}
