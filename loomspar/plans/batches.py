"""Hierarchy, bulk, manifest, search and progress queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.functions.scalars import preview_name
from loomspar.operators import bulk as B
from loomspar.operators import hierarchy as H
from loomspar.plans.scalars import _pick, _sql_pick, _table


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations: each has the turn before as its parent; every 50th conversation's first turn names its
    second as parent, which makes a cycle."""
    c = _table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    parent = F.when(F.col("turn") > 0, F.concat(F.lit(" "), name(F.col("turn") - 1))).when(F.col("conv_id") % 50 == 7, name(F.col("turn") + 1)).when(F.col("conv_id") % 2 == 0, "outside")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_index"), name(F.col("turn")).alias("uid"), parent.alias("parent"))


def hierarchy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.levels(_edges(spark, sf_dir))


def hierarchy_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.cycle_members(_edges(spark, sf_dir))


def uid_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return H.duplicate_uids(o.select(F.col("o_orderkey").alias("row_index"), F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit(" u"), (F.col("o_custkey") * 10 + F.col("o_orderkey") % 5).cast("string"))).otherwise(" ").alias("uid")))


def uid_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    keys = c.select(F.col("c_custkey").cast("string").alias("uid"), F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("KEY-"), F.col("c_custkey").cast("string"))).alias("key"))
    return H.replace_uids(o.select("o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("parent")), keys)


def bulk_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return B.counts(o.select("o_orderstatus", "o_orderpriority", F.when(F.col("o_orderkey") % 9 == 0, "bad").alias("error")), ["o_orderstatus", "o_orderpriority"])


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    k, ok = F.col("o_orderkey"), F.col("o_orderkey") % 4 > 0
    entries = lambda cond, v: F.map_from_entries(F.array_compact(F.collect_list(F.when(cond, F.struct(k.alias("key"), v.alias("value"))))))
    list_of = lambda cond: F.array_sort(F.array_compact(F.collect_list(F.when(cond, k))))
    again = ~ok & (k % 8 == 0)
    return o.groupBy((F.col("o_custkey") % 50).alias("id")).agg(
        list_of(ok).alias("succeeded"), list_of(~ok).alias("failed"), entries(ok, F.concat(F.lit("K-"), k.cast("string"))).alias("created"), entries(~ok, F.lit("first")).alias("errors"),
        list_of(again).alias("new_succeeded"), list_of(~ok & ~again).alias("new_failed"), entries(again, F.concat(F.lit("N-"), k.cast("string"))).alias("new_created"), entries(~ok & (k % 12 == 0) & ~again, F.lit("second")).alias("new_errors"),
    )


def _text(m: F.Column) -> F.Column:
    return F.array_join(F.transform(F.sort_array(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"])), ",")


def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifests(spark, sf_dir)
    new = B.updated(*[F.col(c) for c in ("created", "failed", "errors", "new_created", "new_failed", "new_errors", "succeeded", "new_succeeded")])
    out = m.select("id", *[v.alias(k) for k, v in new.items()])
    return out.select("id", F.array_join(F.col("succeeded").cast("array<string>"), ",").alias("succeeded"), F.array_join(F.col("failed").cast("array<string>"), ",").alias("failed"), _text(F.col("created")).alias("created"), _text(F.col("errors")).alias("errors"))


def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifests(spark, sf_dir)
    done, failed = B.retried(F.col("succeeded"), F.col("failed"), F.col("new_succeeded"), F.col("new_failed"))
    return m.select("id", F.size(done).cast("bigint").alias("n_succeeded"), F.array_join(failed.cast("array<string>"), ",").alias("failed"))


def retry_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    rows = o.select((F.col("o_custkey") % 50).alias("batch_id"), F.col("o_orderkey").alias("row_index"), "o_totalprice")
    return B.to_retry(rows, _manifests(spark, sf_dir))


def bulk_response_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_index"), (F.col("o_custkey") % 20).alias("grp"))
    sent = B.batches(o, 10, ["grp"]).withColumn("batch", F.col("grp") * 100000 + F.col("batch"))
    failed = sent.withColumn("error", F.when(F.col("row_index") % 7 == 3, "refused")).where("error IS NOT NULL").select("batch", "position", "error")
    n = sent.join(failed, ["batch", "position"], "left").where("error IS NULL").groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    created = n.select("batch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("k")).withColumn("key", F.concat_ws("-", F.lit("C"), F.col("batch").cast("string"), F.col("k").cast("string")))
    return B.normalise_response(sent, failed, created)


def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    first, last = B.first_by(o, "o_custkey", ["o_orderkey"]), B.first_by(o, "o_custkey", ["o_orderkey"], last=True)
    return first.withColumn("kept", F.lit("first")).unionByName(last.withColumn("kept", F.lit("last")))


def search_contains_in_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.search(_table(spark, sf_dir, "part"), {"p_name": "RED", "p_brand": None}, {"p_type": ["PROMO", "SMALL"]}, order_by=["p_partkey"]).select("p_partkey", "p_name", "p_type")


def search_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.search(_table(spark, sf_dir, "orders"), {"o_orderpriority": "high"}, since=("o_orderdate", "1999-06-01 00:00"), order_by=["o_orderkey"], limit=50).select("o_orderkey", "o_orderpriority")


def progress_stuck_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return B.progress(e.select(F.col("user_id").alias("job"), F.unix_millis(F.col("ts").cast("timestamp")).alias("at"), (F.col("event_id") % 1000).alias("count")), 3_600_000 * 24)


def preview_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    fields = p.groupBy(preview_name("p_type").alias("norm_field")).agg(F.min("p_partkey").alias("pos")).withColumn("field_id", F.concat(F.lit("f-"), "norm_field"))
    raw = _pick(F.col("p_partkey"), F.concat(F.lit(" "), F.col("p_type")), F.concat("p_type", F.lit(" x")), F.substring("p_type", 1, 4), F.lit("zz"))
    return B.preview_fields(p.select(F.col("p_partkey").alias("cell_id"), preview_name(raw).alias("norm")), fields)


QUERIES = {
    f.__name__: f
    for f in (
        hierarchy_levels, hierarchy_cycles, uid_duplicates, uid_replace, bulk_partition_counts, manifest_merge, retry_merge, retry_semi_join, bulk_response_normalise, dedup_by_id, search_contains_in_limit, search_since,
        progress_stuck_batch, preview_resolution,
    )
}

_MAN = "CAST(o_custkey % 50 AS BIGINT) AS id"
SQL = {
    "hierarchy_levels": """WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations), x AS (SELECT conv_id FROM c GROUP BY conv_id HAVING conv_id % 50 = 7 AND max(turn) > 0)
        SELECT conv_id * 1000 + turn AS row_index, CASE WHEN conv_id IN (SELECT conv_id FROM x) THEN 0 ELSE turn END AS level, conv_id IN (SELECT conv_id FROM x) AS in_cycle FROM c""",
    "hierarchy_cycles": "SELECT conv_id * 1000 + turn AS row_index FROM (SELECT DISTINCT conv_id, turn, max(turn) OVER (PARTITION BY conv_id) AS m FROM conversations) WHERE conv_id % 50 = 7 AND m > 0 AND turn < 2",
    "uid_duplicates": "SELECT 'u' || (o_custkey * 10 + o_orderkey % 5) AS uid, min(o_orderkey) AS first_index, count(*) AS n FROM orders WHERE o_orderkey % 5 > 0 GROUP BY 1 HAVING count(*) > 1",
    "uid_replace": "SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 AND o_custkey IN (SELECT c_custkey FROM customer) THEN 'KEY-' || o_custkey ELSE ' ' || o_custkey END AS parent FROM orders",
    "bulk_partition_counts": "SELECT o_orderstatus, o_orderpriority, count(*) AS total, CAST(sum(CASE WHEN o_orderkey % 9 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS succeeded, CAST(sum(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM orders GROUP BY 1, 2",
    "manifest_merge": f"""SELECT {_MAN}, string_agg(CASE WHEN o_orderkey % 4 > 0 OR o_orderkey % 8 = 0 THEN CAST(o_orderkey AS VARCHAR) END, ',' ORDER BY o_orderkey) AS succeeded,
        coalesce(string_agg(CASE WHEN o_orderkey % 8 = 4 THEN CAST(o_orderkey AS VARCHAR) END, ',' ORDER BY o_orderkey), '') AS failed,
        string_agg(CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey || '=K-' || o_orderkey WHEN o_orderkey % 8 = 0 THEN o_orderkey || '=N-' || o_orderkey END, ',' ORDER BY o_orderkey) AS created,
        coalesce(string_agg(CASE WHEN o_orderkey % 8 = 4 THEN o_orderkey || CASE WHEN o_orderkey % 12 = 0 THEN '=second' ELSE '=first' END END, ',' ORDER BY o_orderkey), '') AS errors FROM orders GROUP BY 1""",
    "retry_merge": f"""SELECT {_MAN}, CAST(count(CASE WHEN o_orderkey % 8 <> 4 THEN 1 END) AS BIGINT) AS n_succeeded, coalesce(string_agg(CASE WHEN o_orderkey % 8 = 4 THEN CAST(o_orderkey AS VARCHAR) END, ',' ORDER BY o_orderkey), '') AS failed FROM orders GROUP BY 1""",
    "retry_semi_join": "SELECT CAST(o_custkey % 50 AS BIGINT) AS batch_id, o_orderkey AS row_index, o_totalprice FROM orders WHERE o_orderkey % 4 = 0",
    "bulk_response_normalise": """WITH s AS (SELECT o_orderkey AS r, o_custkey % 20 AS g, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) - 1 AS n FROM orders), b AS (SELECT r, g * 100000 + n // 10 AS batch, n % 10 AS p FROM s)
        SELECT r AS row_index, CASE WHEN r % 7 <> 3 THEN 'C-' || batch || '-' || (sum(CASE WHEN r % 7 <> 3 THEN 1 ELSE 0 END) OVER (PARTITION BY batch ORDER BY p) - 1) END AS key, CASE WHEN r % 7 = 3 THEN 'refused' END AS error FROM b""",
    "dedup_by_id": """SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority, 'first' AS kept FROM orders GROUP BY 1
        UNION ALL SELECT o_custkey, max(o_orderkey), arg_max(o_orderpriority, o_orderkey), 'last' FROM orders GROUP BY 1""",
    "search_contains_in_limit": "SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(p_name), 'red') AND p_type IN ('PROMO', 'SMALL') ORDER BY p_partkey LIMIT 100",
    "search_since": "SELECT o_orderkey, o_orderpriority FROM orders WHERE contains(lower(o_orderpriority), 'high') AND o_orderdate >= TIMESTAMP '1999-06-01' ORDER BY o_orderkey LIMIT 50",
    "progress_stuck_batch": """WITH e AS (SELECT user_id AS job, epoch_ms(ts) AS t, event_id % 1000 AS c FROM events), m AS (SELECT *, c > coalesce(max(c) OVER (PARTITION BY job ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS moved FROM e),
        l AS (SELECT *, t - coalesce(max(CASE WHEN moved THEN t END) OVER (PARTITION BY job ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), min(t) OVER (PARTITION BY job)) AS idle FROM m)
        SELECT job, count(*) AS n_polls, arg_max(c, t) AS completed, max(idle) > 86400000 AS stuck FROM l GROUP BY job""",
    "preview_resolution": f"""WITH f AS (SELECT lower(p_type) AS nf, min(p_partkey) AS pos FROM part GROUP BY 1), v AS (SELECT p_partkey AS cell_id, lower({_sql_pick('p_partkey', 'p_type', "p_type || 'x'", 'substr(p_type, 1, 4)', "'zz'")}) AS w FROM part),
        j AS (SELECT cell_id, nf, CASE WHEN w = nf THEN 1.0 ELSE 0.7 END::DOUBLE AS c, row_number() OVER (PARTITION BY cell_id ORDER BY CASE WHEN w = nf THEN 0 ELSE 1 END, pos) AS r FROM v LEFT JOIN f ON contains(w, nf) OR contains(nf, w))
        SELECT cell_id, 'f-' || nf AS field_id, CASE WHEN nf IS NOT NULL THEN c END AS confidence, coalesce(CASE WHEN nf IS NOT NULL THEN c END < 0.8, true) AS warned FROM j WHERE r = 1""",
}
