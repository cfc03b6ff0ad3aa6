"""Batches whose rows name their parents by uid: duplicate uids, cycles, dependency levels and key substitution.

Levels come from pointer doubling: every row keeps its farthest known ancestor and the distance to it, and both double
each round, so a chain of n rows takes log2(n) joins. Rows that reach no root within that many rounds are on a cycle or
below one.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspar.functions.scalars import strip
from loomspar.operators.lineage import cut

MAX_ROUNDS = 40


def uid(c: str) -> F.Column:
    return F.nullif(strip(F.col(c).cast("string")), F.lit(""))


def duplicate_uids(rows: DataFrame) -> DataFrame:
    """uid, first_index, n: uids that several rows (row_index, uid) have."""
    return rows.withColumn("uid", uid("uid")).where("uid IS NOT NULL").groupBy("uid").agg(F.min("row_index").alias("first_index"), F.count(F.lit(1)).alias("n")).where("n > 1")


def _doubled(rows: DataFrame) -> DataFrame:
    """row_index, up (null at a root), distance: to the root, or to a row of a cycle after all rounds."""
    own = rows.select("row_index", uid("uid").alias("uid"), uid("parent").alias("parent"))
    ids = own.where("uid IS NOT NULL").groupBy("uid").agg(F.min("row_index").alias("up"))
    start = own.join(ids.withColumnRenamed("uid", "parent"), "parent", "left").select("row_index", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("distance"))
    current = cut(start)
    for _ in range(min(max(1, current.count().bit_length()), MAX_ROUNDS)):
        if not current.where("up IS NOT NULL").limit(1).count():
            break
        next_ = current.select(F.col("row_index").alias("up"), F.col("up").alias("far"), F.col("distance").alias("more"))
        current = cut(current.join(next_, "up", "left").select("row_index", F.col("far").alias("up"), (F.col("distance") + F.coalesce("more", F.lit(0))).alias("distance")))
    return current


def levels(rows: DataFrame) -> DataFrame:
    """row_index, level, in_cycle. rows: row_index, uid, parent. A row without a parent among the rows is on level 0, a
    child one level below its parent; rows on or below a cycle are on level 0."""
    reached = _doubled(rows)
    return reached.select("row_index", F.when(F.col("up").isNull(), F.col("distance")).otherwise(0).cast("bigint").alias("level"), F.col("up").isNotNull().alias("in_cycle"))


def cycle_members(rows: DataFrame) -> DataFrame:
    """row_index of rows that are on a cycle (not just below one): those that a row on or below a cycle ends at after as
    many steps as there are rows."""
    return _doubled(rows).where("up IS NOT NULL").select(F.col("up").alias("row_index")).distinct()


def replace_uids(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """rows with parent replaced by the key written for that uid (keys: uid, key), where there is one."""
    known = keys.select(uid("uid").alias("__uid"), F.col("key").alias("__key")).dropDuplicates(["__uid"])
    out = rows.join(known, uid("parent") == F.col("__uid"), "left")
    return out.withColumn("parent", F.coalesce("__key", "parent")).drop("__uid", "__key")


def with_parent(raw: str, parent: str) -> F.Column:
    """Records (JSON text) without their uid and with their parent replaced where one is given; keys keep their order."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, parents: pd.Series) -> pd.Series:
        def one(text: str, key: str | None) -> str:
            record = {k: v for k, v in json.loads(text).items() if k != "uid"}
            if key is not None:
                record["Parent"] = key
            return json.dumps(record, ensure_ascii=False)

        return pd.Series([one(t, None if pd.isna(k) else k) for t, k in zip(texts, parents)])

    return run(raw, parent)
