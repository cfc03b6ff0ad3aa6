"""Bulk writes: splitting, responses, manifests and retries. A manifest is a row of sets and maps; merging is algebra on
them, so that a run can be repeated from the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MANIFEST = "id string, timestamp bigint, total int, succeeded array<bigint>, failed array<bigint>, created map<bigint,string>, errors map<bigint,string>, uid_map map<string,string>"
DAY_MS = 86_400_000


def counts(results: DataFrame, by: list[str]) -> DataFrame:
    """total, succeeded and failed of results (error: null if written)."""
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull()).alias("succeeded"), F.count_if(F.col("error").isNotNull()).alias("failed"))


def batches(rows: DataFrame, size: int, by: list[str]) -> DataFrame:
    """rows with batch and position: `size` rows of a group to a batch, in the order of row_index."""
    n = F.row_number().over(W.partitionBy(*by).orderBy("row_index")) - 1
    return rows.withColumns({"batch": F.floor(n / size).cast("bigint"), "position": (n % size).cast("bigint")})


def normalise_response(sent: DataFrame, failed: DataFrame, created: DataFrame) -> DataFrame:
    """row_index, key, error of sent rows (batch, position, row_index): failed (batch, position, error) are taken out, and
    the k-th created row (batch, k, key) is the k-th of those left, so failures in the middle shift nothing."""
    marked = sent.join(failed, ["batch", "position"], "left")
    left = marked.where("error IS NULL").withColumn("k", F.row_number().over(W.partitionBy("batch").orderBy("position")).cast("bigint") - 1)
    ok = left.join(created, ["batch", "k"], "left").select("row_index", "key", F.when(F.col("key").isNull(), "no result").alias("error"))
    return ok.unionByName(marked.where("error IS NOT NULL").select("row_index", F.lit(None).cast("string").alias("key"), "error"))


def union_sorted(a: Column | str, b: Column | str) -> Column:
    return F.array_sort(F.array_union(a, b))


def updated(created: Column, failed: Column, errors: Column, new_created: Column, new_failed: Column, new_errors: Column, succeeded: Column, new_succeeded: Column) -> dict[str, Column]:
    """A manifest's columns after an update: succeeded grows, failed is replaced, created gains (new keys win), and old
    errors stay only for rows that still fail."""
    failed_now = F.array_sort(F.array_distinct(new_failed))
    return {
        "succeeded": union_sorted(succeeded, new_succeeded),
        "failed": failed_now,
        "created": over(created, new_created),
        "errors": over(_only(errors, failed_now), new_errors),
    }


def over(old: Column, new: Column) -> Column:
    """Union of two maps in which new values win, by key."""
    first = lambda all_: F.filter(all_, lambda x, i: (i == 0) | (F.get(all_, i - 1)["k"] != x["k"]))
    return _mapped(F.concat(_ranked(new, 0), _ranked(old, 1)), first)


def _only(entries: Column, keys: Column) -> Column:
    """A map's entries whose keys are in an array without repeats."""
    wanted = F.transform(F.coalesce(keys, F.array()), lambda k: F.struct(k.alias("k"), F.lit(0).alias("r"), F.lit(None).alias("v")))
    after = lambda all_: F.filter(all_, lambda x, i: (x["r"] == 1) & (i > 0) & (F.get(all_, i - 1)["k"] == x["k"]))
    return _mapped(F.concat(wanted, _ranked(entries, 1)), after)


def _ranked(entries: Column, rank: int) -> Column:
    return F.transform(F.map_entries(entries), lambda e: F.struct(e["key"].alias("k"), F.lit(rank).alias("r"), e["value"].alias("v")))


def _mapped(ranked: Column, chosen: Callable[[Column], Column]) -> Column:
    """The map of what is chosen from sorted entries: looking each key up in another map would read all of that. They are
    bound as the item of an array, else each place would sort them again."""
    kept = F.transform(F.array(F.sort_array(ranked)), chosen)[0]
    return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["k"], x["v"])))


def retried(succeeded: Column, failed: Column, new_succeeded: Column, new_failed: Column) -> tuple[Column, Column]:
    """Sets after a retry: what now succeeded leaves failed; what still fails stays."""
    return union_sorted(succeeded, new_succeeded), F.array_sort(F.array_except(F.array_union(failed, new_failed), new_succeeded))


def to_retry(rows: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rows (batch_id, row_index) that the manifest (id, failed) of their batch lists as failed."""
    failed = manifests.select(F.col("id").alias("batch_id"), F.explode("failed").alias("row_index")).distinct()
    return rows.join(failed, ["batch_id", "row_index"], "left_semi")


def stale(timestamp: Column, now: Column) -> Column:
    return now - timestamp > DAY_MS


def first_by(df: DataFrame, key: str, order: list[str], last: bool = False) -> DataFrame:
    """One row a key: the first (or last) in the order."""
    cols = [F.col(o).desc() if last else F.col(o) for o in order]
    return df.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(*cols))).where("__n = 1").drop("__n")


def progress(events: DataFrame, stuck_ms: int = 120_000) -> DataFrame:
    """job, n_polls, completed, stuck: of polls (job, at in ms, count). Progress counts only above the largest count so
    far; a job is stuck if a poll came more than stuck_ms after the last progress."""
    w = W.partitionBy("job").orderBy("at")
    best = F.coalesce(F.max("count").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = events.withColumn("moved", F.col("count") > best)
    last = F.last(F.when(F.col("moved"), F.col("at")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    first = F.min("at").over(W.partitionBy("job"))
    marked = marked.withColumn("idle", F.col("at") - F.coalesce(last, first))
    return marked.groupBy("job").agg(F.count(F.lit(1)).alias("n_polls"), F.max_by("count", "at").alias("completed"), F.max(F.col("idle") > stuck_ms).alias("stuck"))


def search(df: DataFrame, contains: dict[str, str] | None = None, within: dict[str, list[str]] | None = None, since: tuple[str, str] | None = None, order_by: list[str] | None = None, limit: int = 100) -> DataFrame:
    """Rows by criteria, as predicates that Spark pushes to the source; null criteria are left out."""
    for c, v in (contains or {}).items():
        if v is not None:
            df = df.where(F.lower(F.col(c)).contains(v.lower()))
    for c, vs in (within or {}).items():
        if vs is not None:
            df = df.where(F.col(c).isin(vs))
    if since is not None:
        df = df.where(F.col(since[0]) >= F.lit(since[1]).cast("timestamp"))
    return df.orderBy(*order_by).limit(limit) if order_by else df.limit(limit)


def search_text(contains: dict[str, str] | None = None, within: dict[str, list[str]] | None = None, raw: str | None = None, since: str | None = None, order_by: str | None = None) -> str:
    """The same criteria as text for a remote service."""
    quote = lambda s: s.replace("\\", "\\\\").replace('"', '\\"')
    parts = [f'{k} ~ "{quote(v)}"' for k, v in (contains or {}).items() if v is not None]
    parts += [f"{k} IN ({', '.join(f'{chr(34)}{quote(x)}{chr(34)}' for x in vs)})" for k, vs in (within or {}).items() if vs is not None]
    if raw is not None:
        parts = [f"({raw})" if since else raw]
    if since:
        parts.append(f'created >= "{since}"')
    return " AND ".join(parts) + (f" ORDER BY {order_by}" if order_by else "")


def preview_fields(inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """cell_id, field_id, confidence, warned: an equal normalised name gives 1.0, else one that contains the other (the
    first field) 0.7; below 0.8 there is a warning. inputs: cell_id, norm; fields: pos, field_id, norm_field."""
    values = inputs.select("norm").distinct()
    equal = values.join(fields, F.col("norm") == F.col("norm_field")).select("norm", "pos", "field_id", F.lit(1.0).alias("confidence"))
    inside = values.join(fields, F.col("norm").contains(F.col("norm_field")) | F.col("norm_field").contains(F.col("norm"))).select("norm", "pos", "field_id", F.lit(0.7).alias("confidence"))
    best = equal.unionByName(inside).groupBy("norm").agg(F.max_by(F.struct("field_id", "confidence"), F.struct("confidence", -F.col("pos"))).alias("b"))
    out = inputs.join(best, "norm", "left")
    return out.select("cell_id", F.col("b.field_id").alias("field_id"), F.col("b.confidence").alias("confidence"), F.coalesce(F.col("b.confidence") < 0.8, F.lit(True)).alias("warned"))
