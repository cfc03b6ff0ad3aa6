"""Queries of searches over entities, error rows, mappings and descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.operators import entities as E
from loomspar.operators import lookups as L
from loomspar.plans.scalars import _pick, _sql_pick, _table
from loomspar.sources import mapping


def user_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey"), F.col("c_custkey").cast("string")
    users = c.select(k.alias("pos"), F.concat(F.lit("user"), (k % 40).cast("string")).alias("username"), F.col("c_name").alias("display"), F.concat(F.lit("u"), n, F.lit("@example.com")).alias("email"), (k % 5 > 0).alias("active"))
    value = _pick(k, F.concat(F.lit("U"), n, F.lit("@example.com")), F.upper("c_name"), F.concat(F.lit("user"), (k % 40).cast("string")))
    return E.search_users(c.select(k.alias("cell_id"), value.alias("value")), users, fuzzy=False).select("cell_id", "pos", "score", F.col("rank").cast("bigint").alias("rank"))


def user_best_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    m = o.select(F.col("o_custkey").alias("cell_id"), F.col("o_orderkey").alias("pos"), ((F.col("o_orderkey") % 3) / 2.0).alias("confidence"), ((F.col("o_orderkey") % 5) / 4.0).alias("similarity"), F.col("o_orderpriority").alias("display"), F.lit(None).cast("string").alias("email"), F.col("o_orderstatus").alias("username"))
    return E.best_by_policy(m)


def parent_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    key = F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string"))
    weight = L.parent_weight(key, F.col("p_name"), F.lit("Brand#1"), F.lit("red ring"))
    return E.best_parent(p.select(F.concat_ws("/", "p_type", F.col("p_size").cast("string")).alias("cell_id"), key.alias("key"), weight.alias("weight"), F.col("p_partkey").alias("pos")))


def types_of_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "nation")
    levels = n.groupBy(F.col("n_regionkey").alias("id")).agg(F.collect_list("n_nationkey").alias("type_ids"))
    types = n.select(F.col("n_nationkey").alias("id"), "n_name")
    listed, all_ = E.types_of_level(types, levels, 2), E.types_of_level(types, levels, 99)
    return listed.withColumn("asked", F.lit("2")).unionByName(all_.withColumn("asked", F.lit("99")))


def candidate_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    some = p.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct(F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("id"), F.col("p_name").alias("name")))).alias("c"))
    return some.select("p_brand", E.candidate_list("c").alias("text"))


def punctuation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = _pick(F.col("p_partkey"), F.concat("p_type", F.lit(" :: "), "p_name"), F.concat("p_type", F.lit(";"), "p_name", F.lit(" ~ x")), F.col("p_name"))
    return p.select("p_partkey", E.punctuation_split(raw).alias("s")).select("p_partkey", "s.*")


def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    k = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, (400, 403, 404, 502))), (k % 4 + 1).cast("int"))
    errs = F.when(k % 8 == 0, F.create_map(F.lit("summary"), F.lit("is required"), F.lit("due"), F.lit("not valid"))).when(k % 8 == 1, F.create_map(F.lit("x"), F.lit("y")))
    failed = e.select(k.alias("row_index"), F.when(k % 3 > 0, status).otherwise(400).alias("status"), errs.alias("errors"), F.when(k % 16 < 8, F.array(F.lit("is ambiguous"))).alias("messages"))
    return E.error_rows(failed)


def describe_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    raw = _pick(F.col("event_id"), F.col("props"), F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(",2]")), F.concat(F.lit('"'), "event_type", F.lit('"')), F.col("event_id").cast("string"))
    return e.select("event_id", E.described(F.parse_json(raw)).alias("text"))


def map_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    raw = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("key"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).alias("projectTypeKey"), F.when(F.col("p_partkey") % 3 == 0, F.create_map(F.lit("32x32"), F.lit("u"))).alias("avatarUrls")))
    return mapping.projects(p.select(F.col("p_partkey").alias("pos"), raw.alias("raw")))


def map_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    value = F.struct(k.cast("string").alias("id"), F.col("p_name").alias("name"), F.when(k % 2 == 0, F.col("p_type")).when(k % 3 == 0, "").alias("value"))
    raw = F.to_json(F.struct(F.when(k % 5 > 0, F.concat(F.lit("f"), k.cast("string"))).alias("fieldId"), F.col("p_name").alias("name"), (k % 4 == 0).alias("required"), F.struct(F.lit("array").alias("type"), F.lit("option").alias("items")).alias("schema"), F.array(value).alias("allowedValues")))
    out = mapping.fields(p.select(F.lit("P").alias("project_key"), F.lit("Task").alias("issue_type"), k.alias("pos"), raw.alias("raw")))
    return out.select("field_id", "name", "kind", "items", "required", F.col("allowed")[0]["name"].alias("first_allowed"))


QUERIES = {f.__name__: f for f in (user_search, user_best_by_policy, parent_best, types_of_level, candidate_lists, punctuation_split, error_rows, describe_values, map_projects, map_fields)}
SQL = {
    "user_search": f"""WITH u AS (SELECT c_custkey AS pos, 'user' || (c_custkey % 40) AS un, lower(c_name) AS dn, 'u' || c_custkey || '@example.com' AS em FROM customer WHERE c_custkey % 5 > 0),
        v AS (SELECT c_custkey AS cell_id, lower({_sql_pick('c_custkey', "'U' || c_custkey || '@example.com'", 'c_name', "'user' || (c_custkey % 40)")}) AS w FROM customer),
        h AS (SELECT cell_id, pos, CASE WHEN em = w THEN 1.0 ELSE 0.95 END::DOUBLE AS score FROM v JOIN u ON em = w OR dn = w OR un = w)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY score DESC, pos) AS rank FROM h) WHERE rank <= 10""",
    "user_best_by_policy": """WITH m AS (SELECT o_custkey AS cell_id, o_orderkey AS pos, o_orderkey % 3 AS c, o_orderkey % 5 AS s, lower(o_orderpriority) AS d, lower(o_orderstatus) AS u FROM orders),
        r AS (SELECT *, row_number() OVER w AS n, coalesce(lead(c) OVER w = c AND lead(s) OVER w = s, false) AS tie FROM m WINDOW w AS (PARTITION BY cell_id ORDER BY c DESC, s, d, u, pos))
        SELECT cell_id, CASE WHEN tie THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN NOT tie THEN pos END AS pos FROM r WHERE n = 1""",
    "parent_best": """WITH c AS (SELECT p_type || '/' || p_size AS cell_id, p_brand || '-' || p_partkey AS key, CASE WHEN p_brand = 'Brand#1' THEN 100 ELSE 0 END + CASE WHEN lower(p_name) = 'red ring' THEN 50 WHEN starts_with(lower(p_name), 'red ring') THEN 25 ELSE 0 END AS w, p_partkey AS pos FROM part),
        r AS (SELECT *, row_number() OVER x AS n, coalesce(lead(w) OVER x = w, false) AS tie FROM c WINDOW x AS (PARTITION BY cell_id ORDER BY w DESC, pos))
        SELECT cell_id, CASE WHEN tie THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN NOT tie THEN key END AS key FROM r WHERE n = 1""",
    "types_of_level": "SELECT n_nationkey AS id, n_name, '2' AS asked FROM nation WHERE n_regionkey = 2 UNION ALL SELECT n_nationkey, n_name, '99' FROM nation",
    "candidate_lists": """WITH c AS (SELECT p_brand, '- ' || p_name || ' (' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') || ')' AS l, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
        SELECT p_brand, string_agg(l, chr(10) ORDER BY r) FILTER (r <= 5) || CASE WHEN max(n) > 5 THEN chr(10) || '... and ' || (max(n) - 5) || ' more' ELSE '' END AS text FROM c GROUP BY p_brand""",
    "punctuation_split": f"""SELECT p_partkey, {_sql_pick('p_partkey', 'p_type', 'NULL', 'NULL')} AS parent, {_sql_pick('p_partkey', 'p_name', 'NULL', 'NULL')} AS child, {_sql_pick('p_partkey', "'ok'", "'ambiguous'", "'none'")} AS status FROM part""",
    "error_rows": """WITH f AS (SELECT event_id AS k, CASE WHEN event_id % 3 > 0 THEN [400, 403, 404, 502][event_id % 4 + 1] ELSE 400 END AS s FROM events),
        r AS (SELECT k, CASE s WHEN 403 THEN 'PERMISSION_DENIED' WHEN 404 THEN 'NOT_FOUND' ELSE 'SERVER_ERROR' END AS code, NULL AS field, 'status ' || s AS message FROM f WHERE s <> 400
        UNION ALL SELECT k, 'REQUIRED_FIELD', 'summary', 'summary: is required' FROM f WHERE s = 400 AND k % 8 = 0 UNION ALL SELECT k, 'INVALID_VALUE', 'due', 'due: not valid' FROM f WHERE s = 400 AND k % 8 = 0
        UNION ALL SELECT k, 'INVALID_VALUE', 'x', 'x: y' FROM f WHERE s = 400 AND k % 8 = 1 UNION ALL SELECT k, 'AMBIGUOUS', NULL, 'is ambiguous' FROM f WHERE s = 400 AND k % 16 < 8
        UNION ALL SELECT k, 'SERVER_ERROR', NULL, 'unknown error' FROM f WHERE s = 400 AND k % 8 > 1 AND k % 16 >= 8)
        SELECT k AS row_index, code, field, message FROM r""",
    "describe_values": f"""SELECT event_id, {_sql_pick('event_id', "'{k: ...}'", "'[2 items]'", "'\"' || event_type || '\"'", 'CAST(event_id AS VARCHAR)')} AS text FROM events""",
    "map_projects": "SELECT p_partkey AS pos, CAST(p_partkey AS VARCHAR) AS id, p_brand AS key, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'software' END AS project_type_key, CASE WHEN p_partkey % 3 = 0 THEN 'u' END AS avatar FROM part",
    "map_fields": "SELECT 'f' || p_partkey AS field_id, p_name AS name, 'array' AS kind, 'option' AS items, p_partkey % 4 = 0 AS required, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_name END AS first_allowed FROM part WHERE p_partkey % 5 > 0",
}
