"""Lookup and resolution queries over the driver's tables; dimensions are built from their values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspar.functions.fuzzy import Options
from loomspar.functions.scalars import normal_name
from loomspar.operators import lookups as L
from loomspar.plans.scalars import _pick, _sql_pick, _table


def _noisy(k: F.Column, c: F.Column) -> F.Column:
    return _pick(k, c, F.upper(c), F.concat(F.lit("\u00a0"), F.lower(c), F.lit("\u200b ")), F.concat(F.lit("?"), c), F.lit(" "))


def _sql_noisy(k: str, c: str) -> str:
    """What is looked up: lower case, null if nothing is left."""
    return _sql_pick(k, f"lower({c})", f"lower({c})", f"lower({c})", f"'?' || lower({c})", "NULL")


def _named(df: DataFrame, value: str) -> DataFrame:
    """id and name of the distinct values, numbered in their order."""
    names = df.select(F.col(value).alias("name")).distinct()
    return names.withColumn("id", F.row_number().over(W.orderBy("name")).cast("string")).withColumn("all", F.lit(1))


def _cells(df: DataFrame, key: str, value: F.Column) -> DataFrame:
    return df.select(F.col(key).alias("cell_id"), value.alias("value"), F.lit(1).alias("all"))


def priority_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return L.resolve_unique(_cells(o, "o_orderkey", _noisy(F.col("o_orderkey"), F.col("o_orderpriority"))), _named(o, "o_orderpriority"), ["all"], fuzzy=None).drop("score")


def option_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    dim = _named(p, "p_brand").withColumn("field", F.lit("brand")).unionByName(_named(p, "p_type").withColumn("field", F.lit("type")))
    field = F.when(F.col("p_partkey") % 2 == 0, "brand").otherwise("type")
    cells = p.select(F.col("p_partkey").alias("cell_id"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise(F.col("p_brand")).alias("value"), field.alias("field"))
    return L.resolve_unique(cells, dim, ["field"], fuzzy=None).drop("score")


def ambiguous_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    dim = _named(c, "c_mktsegment")
    twice = dim.unionByName(dim.where("id IN ('1', '2')").withColumn("id", F.concat(F.lit("copy-"), "id")).withColumn("name", F.upper("name")))
    return L.resolve_unique(_cells(c, "c_custkey", _noisy(F.col("c_custkey"), F.col("c_mktsegment"))), twice, ["all"], fuzzy=None).drop("score")


def project_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, c = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "customer")
    dim = n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"), F.col("n_name").alias("name"), F.lit(1).alias("all"))
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    value = _pick(F.col("c_custkey"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.lower("n_name"), F.concat("n_name", F.lit("x")))
    return L.resolve_unique(_cells(named, "c_custkey", value), dim, ["all"], fuzzy=None).drop("score")


def fuzzy_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names with a letter dropped or doubled, looked up among the distinct names."""
    p = _table(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    at = (k % 3 + 2).cast("int")
    value = _pick(k, n, F.concat(F.left(n, at), F.substr(n, at + 2, F.lit(99))), F.concat(F.left(n, at), F.substr(n, at, F.lit(99))), F.concat(F.lit("zz"), F.reverse(n)))
    return L.resolve_unique(_cells(p, "p_partkey", value), _named(p, "p_name"), ["all"])


def fuzzy_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate search among brands, location-sensitive, with a confidence of 1 - score."""
    p = _table(spark, sf_dir, "part")
    dim = _named(p, "p_brand")
    values = p.select(F.lower(F.concat(F.left("p_brand", F.lit(3)), F.substr("p_brand", F.lit(5), F.lit(9)))).alias("wanted"), F.lit(1).alias("all")).distinct()
    hits = L.scored(values, dim, ["all"], [], Options(threshold=0.4, ignore_place=False, least_run=1))
    return hits.groupBy("wanted").agg(F.min(F.struct("score", "id")).alias("b")).select("wanted", F.col("b.id").alias("id"), F.greatest(F.lit(0.0), 1 - F.col("b.score")).alias("confidence"))


def closest_field_names_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    fields = p.select(F.upper("p_type").alias("candidate")).distinct().withColumn("pos", F.row_number().over(W.orderBy("candidate"))).withColumn("all", F.lit(1))
    names = p.select(F.col("p_partkey").alias("cell_id"), F.col("p_name").alias("name"), F.lit(1).alias("all"))
    return L.closest_names(names, fields, ["all"])


def field_name_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    fields = p.select(normal_name("p_type").alias("norm")).distinct().unionByName(p.select(normal_name("p_brand").alias("norm")).distinct())
    fields = fields.withColumn("pos", F.row_number().over(W.orderBy("norm"))).select(F.lit(1).alias("all"), "pos", F.concat(F.lit("f"), F.col("pos").cast("string")).alias("field_id"), "norm")
    raw = _pick(F.col("p_partkey"), F.col("p_type"), F.concat(F.col("p_type"), F.lit("_s")), F.concat(F.lit("the "), "p_type"), F.substring("p_brand", 1, 7), F.lit("brand"), F.concat("p_brand", F.lit("abcdef")))
    names = p.select(F.col("p_partkey").alias("cell_id"), normal_name(raw).alias("norm_name"), F.lit(1).alias("all"))
    return L.field_by_name(names, fields, ["all"])


def user_tiered_match(spark: SparkSession, sf_dir: str, policy: str = "first") -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey"), F.col("c_custkey").cast("string")
    users = c.select(
        k.alias("pos"), F.concat(F.lit("User"), n).alias("username"), F.col("c_name").alias("display"), F.concat(F.lit("u"), n, F.lit("@Example.com")).alias("email"), F.when(k % 7 != 3, True).when(k % 2 == 0, False).alias("active")
    )
    value = _pick(k, F.concat(F.lit("u"), n, F.lit("@example.COM")), F.concat(F.lit("USER"), n), F.lit("use"), F.concat(F.lit("#0000"), F.lpad(n, 5, "0")), F.lit("nobody@example.com"), F.lit("zq"), F.lit(None).cast("string"))
    return L.match_users(c.select(k.alias("cell_id"), value.alias("value")), users, policy, fuzzy=None)


def user_policy_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_tiered_match(spark, sf_dir, "error")


def fuzzy_user(spark: SparkSession, sf_dir: str, policy: str = "first") -> DataFrame:
    """User names, e-mails and display names with a letter dropped, doubled or changed, or without a likeness, among the
    distinct part names as users."""
    p = _table(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), F.col("p_name")
    name = F.replace(n, F.lit(" "), F.lit("."))
    mail = F.concat(name, F.lit("@example.com"))
    users = p.groupBy("p_name").agg(F.min("p_partkey").alias("pos")).select("pos", F.concat(F.lit("u-"), name).alias("username"), n.alias("display"), mail.alias("email"), (F.col("pos") % 5 > 0).alias("active"))
    at = (k % 3 + 2).cast("int")
    dropped, doubled, changed = (lambda c: F.concat(F.left(c, at), F.substr(c, at + 2, F.lit(99)))), (lambda c: F.concat(F.left(c, at), F.substr(c, at, F.lit(99)))), (lambda c: F.concat(F.left(c, at), F.lit("x"), F.substr(c, at + 2, F.lit(99))))
    value = _pick(k, mail, dropped(mail), doubled(n), changed(F.upper(n)), dropped(F.concat(F.lit("u-"), name)), F.concat(F.lit("zz"), F.reverse(n)))
    return L.match_users(p.select(k.alias("cell_id"), value.alias("value")), users, policy)


def sprint_exact_state_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    state = F.element_at(F.array(*map(F.lit, ("closed", "future", "active"))), (F.col("event_id") % 3 + 1).cast("int"))
    sprints = e.select(F.col("event_id").alias("sprint_id"), F.col("event_id").alias("pos"), F.concat(F.lit("Sprint "), (F.col("event_id") % 211).cast("string")).alias("name"), state.alias("state"))
    sprints = sprints.unionByName(spark.createDataFrame([(-9, -9, "Autumn release", "future")], sprints.schema))
    n = F.col("event_id")
    value = _pick(n, F.concat(F.lit("SPRINT "), (n % 250).cast("string")), n.cast("string"), F.lit("autumn"), F.lit("sprint"), F.lit(""))
    return L.sprint_by_name(e.select(n.alias("cell_id"), value.alias("value")), sprints)


def mru_board_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    boards = o.select((F.col("o_custkey") % 10).alias("project"), F.col("o_orderkey").alias("board_id"))
    hint = F.array((F.col("project") + 100).cast("bigint"), F.lit(7).cast("bigint"), (F.col("project") * 3).cast("bigint"))
    ranked = L.boards_by_hint(boards, hint, 5)
    return ranked.select("project", "board_id", F.col("rank").cast("bigint").alias("rank"), F.array_join(L.used_board(hint, F.col("board_id")), ",").alias("hint"))


def parent_weight_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    key = F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string"))
    weight = L.parent_weight(key, F.col("p_name"), F.lit("Brand#1"), F.lit("RED"))
    w = W.partitionBy("p_type").orderBy(F.col("weight").desc(), "p_partkey")
    return p.withColumn("weight", weight.cast("bigint")).withColumn("rank", F.row_number().over(w).cast("bigint")).where("rank <= 10").select("p_type", "p_partkey", "weight", "rank")


def parent_field_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = _pick(k, F.lit("Parent Link"), F.concat(F.lit("my parent link "), "p_name"), F.lit("epic link"), F.col("p_name"))
    plugin = F.when(k % 11 == 0, "hierarchy-link").when(k % 13 == 0, "epic-link")
    fields = p.select(F.col("p_brand").alias("project"), F.col("p_type").alias("issue_type"), k.cast("string").alias("field_id"), name.alias("name"), F.when(k % 5 == 0, "option").otherwise("any").alias("kind"), plugin.alias("plugin"))
    return L.parent_field(fields, ["epic-link", "hierarchy-link"], ["parent link", "epic link"])


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    own = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return own.groupBy(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title")).agg(F.collect_list(F.col("n_nationkey").cast("string")).alias("type_ids"))


def parent_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.parent_levels(_levels(spark, sf_dir)).select("type_id", F.col("level").cast("bigint").alias("level"), F.col("parent_level").cast("bigint").alias("parent_level"))


def valid_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    pairs = c.select("c_custkey", F.col("c_nationkey").cast("string").alias("child_type"), (F.col("c_custkey") % 30).cast("string").alias("parent_type"))
    return L.valid_parents(pairs, _levels(spark, sf_dir)).select("c_custkey", "valid")


def cascading_option(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r, c = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region"), _table(spark, sf_dir, "customer")
    own = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    options = own.select(F.col("r_regionkey").cast("string").alias("parent_id"), F.col("r_name").alias("parent"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child_id"), F.when(F.col("n_nationkey") % 10 == 0, "Shared").otherwise(F.col("n_name")).alias("child"))
    named = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.lit(None).cast("string")
    parent = _pick(F.col("c_custkey"), F.lower("r_name"), F.lower("r_name"), none, none, F.lit("nowhere"), none)
    child = _pick(F.col("c_custkey"), F.upper("n_name"), none, F.lower("n_name"), F.lit("shared"), F.col("n_name"), F.lower("r_name"))
    return L.resolve_cascade(named.select(F.col("c_custkey").alias("cell_id"), parent.alias("parent"), child.alias("child")), options)


def _status_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus").distinct()
    types = o.groupBy(F.col("o_orderpriority").alias("issue_type")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderstatus").alias("id"), F.concat(F.lit("S-"), "o_orderstatus").alias("name")))).alias("statuses"))
    return types.withColumn("pos", F.left("issue_type", F.lit(1)).cast("int"))


def status_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.statuses(_status_types(spark, sf_dir), "2-high")


def status_by_type_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.statuses(_status_types(spark, sf_dir), "no such type")


QUERIES = {
    f.__name__: f
    for f in (
        priority_lookup, option_lookup, ambiguous_lookup, project_lookup, fuzzy_resolve, fuzzy_scores, closest_field_names_top3, field_name_tiers, user_tiered_match, user_policy_error, fuzzy_user,
        sprint_exact_state_rank, mru_board_order, parent_weight_topk, parent_field_candidate, parent_level, valid_parent, cascading_option, status_by_type, status_by_type_fallback,
    )
}


def _sql_users(policy: str) -> str:
    return f"""
WITH u AS (SELECT c_custkey AS pos, 'user' || c_custkey AS un, lower(c_name) AS dn, 'u' || c_custkey || '@example.com' AS em FROM customer
  WHERE NOT (c_custkey % 7 = 3 AND c_custkey % 2 = 0)),
v AS (SELECT c_custkey AS cell_id, {_sql_pick('c_custkey', "'u' || c_custkey || '@example.com'", "'user' || c_custkey", "'use'", "'#0000' || lpad(CAST(c_custkey AS VARCHAR), 5, '0')", "'nobody@example.com'", "'zq'", 'NULL')} AS w FROM customer),
h AS (SELECT w, pos, CASE WHEN w LIKE '%_@_%._%' THEN CASE WHEN em = w THEN 1 WHEN un = w THEN 2 END
    ELSE CASE WHEN un = w THEN 2 WHEN starts_with(un, w) THEN 3 WHEN contains(dn, w) THEN 4 END END AS tier FROM (SELECT DISTINCT w FROM v WHERE w IS NOT NULL), u),
t AS (SELECT w, tier, min(pos) AS pos, count(*) AS n FROM h WHERE tier IS NOT NULL GROUP BY ALL),
b AS (SELECT w, arg_min(pos, tier) AS pos, arg_min(n, tier) AS n, min(tier) AS tier FROM t GROUP BY w)
SELECT cell_id, CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 AND '{policy}' = 'error' THEN 'ambiguous' ELSE 'ok' END AS status,
  CASE WHEN n = 1 OR '{policy}' = 'first' THEN pos END AS user_pos, CASE WHEN n = 1 OR '{policy}' = 'first' THEN CASE tier WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.95 WHEN 3 THEN 0.7 WHEN 4 THEN 0.5 END END AS confidence
FROM v LEFT JOIN b USING (w) WHERE w IS NOT NULL"""


_DIM = lambda table, c: f"SELECT {c} AS name, CAST(row_number() OVER (ORDER BY {c}) AS VARCHAR) AS id FROM (SELECT DISTINCT {c} FROM {table})"
_LEVELS = "SELECT r_regionkey AS lv, CAST(n_nationkey AS VARCHAR) AS ty FROM nation JOIN region ON n_regionkey = r_regionkey"
_STATUS = "SELECT DISTINCT o_orderpriority AS ty, o_orderstatus AS id FROM orders"
SQL = {
    "priority_lookup": f"""WITH d AS ({_DIM('orders', 'o_orderpriority')}), v AS (SELECT o_orderkey AS cell_id, {_sql_noisy('o_orderkey', 'o_orderpriority')} AS w FROM orders)
        SELECT cell_id, CASE WHEN id IS NULL THEN 'not_found' ELSE 'ok' END AS status, id FROM v LEFT JOIN d ON lower(d.name) = w""",
    "option_lookup": f"""WITH d AS (SELECT *, 0 AS f FROM ({_DIM('part', 'p_brand')}) UNION ALL SELECT *, 1 FROM ({_DIM('part', 'p_type')}))
        SELECT p_partkey AS cell_id, CASE WHEN id IS NULL THEN 'not_found' ELSE 'ok' END AS status, id FROM part LEFT JOIN d ON f = p_partkey % 2 AND name = CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_brand END""",
    "ambiguous_lookup": f"""WITH d AS ({_DIM('customer', 'c_mktsegment')}), v AS (SELECT c_custkey AS cell_id, {_sql_noisy('c_custkey', 'c_mktsegment')} AS w FROM customer)
        SELECT cell_id, CASE WHEN id IS NULL THEN 'not_found' WHEN id IN ('1', '2') THEN 'ambiguous' ELSE 'ok' END AS status, CASE WHEN id NOT IN ('1', '2') THEN id END AS id FROM v LEFT JOIN d ON lower(d.name) = w""",
    "project_lookup": """SELECT c_custkey AS cell_id, CASE WHEN c_custkey % 3 < 2 THEN 'ok' ELSE 'not_found' END AS status, CASE WHEN c_custkey % 3 < 2 THEN 'N' || c_nationkey END AS id FROM customer""",
    "closest_field_names_top3": """WITH f AS (SELECT candidate, row_number() OVER (ORDER BY candidate) AS pos FROM (SELECT DISTINCT upper(p_type) AS candidate FROM part)),
        r AS (SELECT p_partkey AS cell_id, candidate, CAST(levenshtein(lower(p_name), lower(candidate)) AS INTEGER) AS distance, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY levenshtein(lower(p_name), lower(candidate)), pos) AS INTEGER) AS rank FROM part, f)
        SELECT cell_id, rank, candidate, distance FROM r WHERE rank <= 3""",
    "field_name_tiers": f"""WITH f AS (SELECT norm, row_number() OVER (ORDER BY norm) AS pos FROM (SELECT DISTINCT lower(p_type) AS norm FROM part UNION ALL SELECT DISTINCT lower(p_brand) FROM part)),
        v AS (SELECT p_partkey AS cell_id, lower({_sql_pick('p_partkey', 'p_type', "p_type || 's'", "'the' || p_type", 'substr(p_brand, 1, 7)', "'brand'", "p_brand || 'abcdef'")}) AS w FROM part),
        m AS (SELECT w, pos, norm = w AS a, (starts_with(w, norm) OR starts_with(norm, w)) AND abs(length(w) - length(norm)) <= 2 AS b, (contains(w, norm) OR contains(norm, w)) AND length(w) >= 5 AND abs(length(w) - length(norm)) <= 4 AS c FROM (SELECT DISTINCT w FROM v), f),
        t AS (SELECT w, min(CASE WHEN a THEN pos END) AS p1, CASE WHEN count_if(b) = 1 THEN min(CASE WHEN b THEN pos END) END AS p2, CASE WHEN count_if(c) = 1 THEN min(CASE WHEN c THEN pos END) END AS p3 FROM m GROUP BY w)
        SELECT cell_id, 'f' || coalesce(p1, p2, p3) AS field_id, CASE WHEN p1 IS NOT NULL THEN 1 WHEN p2 IS NOT NULL THEN 2 WHEN p3 IS NOT NULL THEN 3 END AS tier FROM v JOIN t USING (w)""",
    "user_tiered_match": _sql_users("first"),
    "user_policy_error": _sql_users("error"),
    "sprint_exact_state_rank": f"""WITH s AS (SELECT event_id AS id, 'sprint ' || (event_id % 211) AS name, CASE event_id % 3 WHEN 2 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS st FROM events),
        x AS (SELECT name, arg_min(id, st * 10000000000 + id) AS id FROM s GROUP BY name)
        SELECT event_id AS cell_id, CASE event_id % 5 WHEN 0 THEN x.id WHEN 1 THEN event_id WHEN 2 THEN -9 END AS sprint_id FROM events LEFT JOIN x ON event_id % 5 = 0 AND x.name = 'sprint ' || (event_id % 250)""",
    "mru_board_order": """WITH b AS (SELECT o_custkey % 10 AS project, o_orderkey AS board_id, [CAST(o_custkey % 10 + 100 AS BIGINT), 7, CAST(o_custkey % 10 * 3 AS BIGINT)] AS h FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY coalesce(list_position(h, board_id), 1 << 30), board_id DESC) AS rank FROM b)
        SELECT project, board_id, rank, array_to_string(list_filter([board_id] || h, lambda x, i: list_position([board_id] || h, x) = i)[1:5], ',') AS hint FROM r WHERE rank <= 5""",
    "parent_weight_topk": """WITH w AS (SELECT p_type, p_partkey, CAST(CASE WHEN p_brand = 'Brand#1' THEN 100 ELSE 0 END + CASE WHEN lower(p_name) = 'red' THEN 50 WHEN starts_with(lower(p_name), 'red') THEN 25 ELSE 0 END AS BIGINT) AS weight FROM part),
        r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY weight DESC, p_partkey) AS rank FROM w) SELECT * FROM r WHERE rank <= 10""",
    "parent_field_candidate": f"""WITH f AS (SELECT p_brand AS project, p_type AS issue_type, CAST(p_partkey AS VARCHAR) AS field_id, {_sql_pick('p_partkey', "'Parent Link'", "'my parent link ' || p_name", "'epic link'", 'p_name')} AS name,
          CASE WHEN p_partkey % 11 = 0 THEN 1 WHEN p_partkey % 13 = 0 THEN 0 END AS pl FROM part WHERE p_partkey % 5 <> 0),
        r AS (SELECT *, CASE WHEN pl IS NOT NULL THEN pl WHEN lower(name) = 'parent link' THEN 2 WHEN lower(name) = 'epic link' THEN 3 WHEN contains(lower(name), 'parent link') THEN 4 WHEN contains(lower(name), 'epic link') THEN 5 END AS rk FROM f)
        SELECT project, issue_type, field_id, name FROM (SELECT *, row_number() OVER (PARTITION BY project, issue_type ORDER BY rk, name, field_id) AS n FROM r WHERE rk IS NOT NULL) WHERE n = 1""",
    "parent_level": f"""WITH l AS ({_LEVELS}) SELECT ty AS type_id, CAST(lv AS BIGINT) AS level, CAST(CASE WHEN lv + 1 IN (SELECT lv FROM l) THEN lv + 1 END AS BIGINT) AS parent_level FROM l""",
    "valid_parent": f"""WITH l AS ({_LEVELS}) SELECT c_custkey, coalesce(p.lv = c.lv + 1, false) AS valid FROM customer LEFT JOIN l c ON c.ty = CAST(c_nationkey AS VARCHAR) LEFT JOIN l p ON p.ty = CAST(c_custkey % 30 AS VARCHAR)""",
    "cascading_option": f"""WITH o AS (SELECT CAST(r_regionkey AS VARCHAR) AS pid, lower(r_name) AS p, 'n' || n_nationkey AS cid, CASE WHEN n_nationkey % 10 = 0 THEN 'shared' ELSE lower(n_name) END AS c FROM nation JOIN region ON n_regionkey = r_regionkey),
        v AS (SELECT c_custkey AS cell_id, {_sql_pick('c_custkey', 'lower(r_name)', 'lower(r_name)', 'NULL', 'NULL', "'nowhere'", 'NULL')} AS p, {_sql_pick('c_custkey', 'lower(n_name)', 'NULL', 'lower(n_name)', "'shared'", 'lower(n_name)', 'lower(r_name)')} AS c
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        j AS (SELECT cell_id, v.p, v.c, (SELECT min(pid) FROM o WHERE o.p = v.p) AS pp, (SELECT min(cid) FROM o WHERE o.p = v.p AND o.c = v.c) AS pc, (SELECT min(pid) FROM o WHERE o.p = v.c) AS cp,
          (SELECT count(DISTINCT pid) FROM o WHERE o.c = v.c) AS n, (SELECT min(pid) FROM o WHERE o.c = v.c) AS op, (SELECT min(cid) FROM o WHERE o.c = v.c) AS oc FROM v),
        s AS (SELECT *, CASE WHEN p IS NOT NULL THEN CASE WHEN pp IS NULL OR (c IS NOT NULL AND pc IS NULL) THEN 'not_found' ELSE 'ok' END WHEN cp IS NOT NULL OR n = 1 THEN 'ok' WHEN n > 1 THEN 'ambiguous' ELSE 'not_found' END AS status FROM j)
        SELECT cell_id, status, CASE WHEN status = 'ok' THEN CASE WHEN p IS NOT NULL THEN pp WHEN cp IS NOT NULL THEN cp ELSE op END END AS parent_id,
          CASE WHEN status = 'ok' THEN CASE WHEN p IS NOT NULL THEN pc WHEN cp IS NULL THEN oc END END AS child_id FROM s""",
    "status_by_type": f"WITH s AS ({_STATUS}) SELECT id, 'S-' || id AS name, ty AS issue_type FROM s WHERE lower(ty) = '2-high'",
    "status_by_type_fallback": f"WITH s AS ({_STATUS}) SELECT id, 'S-' || id AS name, min(ty) AS issue_type FROM s GROUP BY id",
}
