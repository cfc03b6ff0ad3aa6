"""Validation queries over orders joined with customers, with defects put in by their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.operators import validation

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    k = F.col("o_orderkey")
    nth = lambda n: k % n == 0
    rec = F.struct(
        F.when(~nth(97), F.when(nth(101), "NOWHERE").otherwise(F.lower("c_mktsegment"))).alias("Project"),
        F.when(nth(89), "Chore").otherwise("Task").alias("Issue Type"),
        F.when(nth(13), "").otherwise(F.concat(F.lit("Order "), k)).alias("Summary"),
        F.when(nth(17), "Blocker").otherwise(F.lower("o_orderpriority")).alias("Priority"),
        F.when(nth(19), "abc").when(nth(2), F.col("o_totalprice").cast("decimal(18,2)").cast("string")).otherwise("0x1F").alias("Story Points"),
        F.when(~nth(29), F.array(F.lit("a"), F.lit("b"))).alias("labels"),
        F.when(nth(31), "x").alias("Mystery"),
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(k.alias("row_index"), F.to_json(rec).alias("raw"))


def fields(spark: SparkSession) -> DataFrame:
    allowed = F.array(*[F.struct(F.lit(str(i)).alias("id"), F.lit(p).alias("name")) for i, p in enumerate(PRIORITIES, 1)])
    none = F.lit(None).cast("array<struct<id:string,name:string>>")
    rows = [("Summary", "string", True, none), ("Priority", "priority", False, allowed), ("Story Points", "number", False, none), ("Labels", "array", True, none)]
    one = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(r).alias("required"), a.alias("allowed")) for n, t, r, a in rows])
    projects = spark.createDataFrame([(s,) for s in SEGMENTS], "project_key string")
    return projects.select("project_key", F.lit("Task").alias("issue_type"), F.explode(one).alias("f")).select("project_key", "issue_type", "f.*")


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate(records(spark, sf_dir), fields(spark))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.summary(findings(spark, sf_dir))


def _only(code: str):
    return lambda spark, sf_dir: findings(spark, sf_dir).where(F.col("code") == code).select("row_index", "field")


_FOUND = """
WITH r AS (
  SELECT o_orderkey AS k FROM orders JOIN customer ON o_custkey = c_custkey
), ok AS (SELECT k FROM r WHERE k % 97 <> 0 AND k % 101 <> 0 AND k % 89 <> 0),
f AS (
  SELECT k AS row_index, 'error' AS severity, 'REQUIRED_FIELD_MISSING' AS code, 'Project' AS field FROM r WHERE k % 97 = 0
  UNION ALL SELECT k, 'error', 'INVALID_PROJECT', 'Project' FROM r WHERE k % 97 <> 0 AND k % 101 = 0
  UNION ALL SELECT k, 'error', 'INVALID_ISSUE_TYPE', 'Issue Type' FROM r WHERE k % 97 <> 0 AND k % 101 <> 0 AND k % 89 = 0
  UNION ALL SELECT k, 'error', 'REQUIRED_FIELD_MISSING', 'Summary' FROM ok WHERE k % 13 = 0
  UNION ALL SELECT k, 'error', 'REQUIRED_FIELD_MISSING', 'Labels' FROM ok WHERE k % 29 = 0
  UNION ALL SELECT k, 'error', 'INVALID_ENUM_VALUE', 'Priority' FROM ok WHERE k % 17 = 0
  UNION ALL SELECT k, 'error', 'INVALID_TYPE', 'Story Points' FROM ok WHERE k % 19 = 0
  UNION ALL SELECT k, 'warning', 'UNKNOWN_FIELD', 'Mystery' FROM ok WHERE k % 31 = 0
)
"""
_CODES = {"required_missing": validation.REQUIRED, "unknown_field": validation.UNKNOWN, "type_check": validation.TYPE, "enum_check": validation.ENUM}
QUERIES = {"validate_findings": findings, "validate_summary": summary} | {n: _only(c) for n, c in _CODES.items()}
SQL = {
    "validate_findings": f"{_FOUND} SELECT row_index, severity, code, field FROM f",
    "validate_summary": f"{_FOUND} SELECT severity, code, field, count(*) AS n_findings, count(DISTINCT row_index) AS n_rows FROM f GROUP BY ALL",
} | {n: f"{_FOUND} SELECT row_index, field FROM f WHERE code = '{c}'" for n, c in _CODES.items()}
