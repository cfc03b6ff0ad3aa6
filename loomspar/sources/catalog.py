"""Dimension tables of a tracker: projects, issue types, fields, users, boards, sprints and the like.

A catalog is a folder of Parquet tables (or registered DataFrames); accessors are filters and projections that reach the
scan. A Python data source reads folders of recorded REST pages, one input partition a page.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from loomspar.errors import NOT_FOUND, EngineError
from loomspar.functions.fuzzy import Options
from loomspar.operators.lookups import scored

#: Paths of the service's endpoints by deployment.
ENDPOINTS = {
    "serverInfo": "/rest/api/{v}/serverInfo", "createMeta": "/rest/api/{v}/issue/createmeta", "issueCreate": "/rest/api/{v}/issue", "issueBulkCreate": "/rest/api/{v}/issue/bulk",
    "issueGet": "/rest/api/{v}/issue/{id}", "issueUpdate": "/rest/api/{v}/issue/{id}", "search": "/rest/api/{v}/search", "userSearch": "/rest/api/{v}/user/search", "projectList": "/rest/api/{v}/project",
    "projectGet": "/rest/api/{v}/project/{id}", "fieldList": "/rest/api/{v}/field",
}


def endpoint(name: str, deployment: str, **values: str) -> str:
    return ENDPOINTS[name].format(v=3 if deployment == "cloud" else 2, **values)


class Catalog:
    def __init__(self, spark: SparkSession, folder: str | None = None, tables: dict[str, DataFrame] | None = None) -> None:
        self.spark, self.folder, self.tables = spark, folder, dict(tables or {})

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            if self.folder is None:
                raise EngineError(NOT_FOUND, f"no table {name}")
            self.tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.tables[name]

    def invalidate(self, name: str | None = None) -> list[str]:
        """Forget tables; returns their names."""
        gone = [name] if name in self.tables else [] if name else sorted(self.tables)
        for n in gone:
            self.tables.pop(n).unpersist()
        return gone

    def projects(self, query: str | None = None, type_key: str | None = None, offset: int = 0, limit: int = 50) -> DataFrame:
        df = self.table("project")
        if type_key is not None:
            df = df.where(F.col("project_type_key") == type_key)
        if query is not None:
            df = self.fuzzy(df, query, "key", ["name"], 0.4)
            return df.orderBy("score", "pos").offset(offset).limit(limit)
        return df.orderBy("pos").offset(offset).limit(limit)

    def project(self, key: str) -> DataFrame:
        found = self.table("project").where(F.col("key") == key)
        if not found.limit(1).count():
            raise EngineError(NOT_FOUND, f"no project {key}")
        return found

    def issue_types(self, project: str, subtasks: bool = True, query: str | None = None) -> DataFrame:
        df = self.table("issue_type").where(F.col("project_key") == project)
        df = df if subtasks else df.where(~F.coalesce("subtask", F.lit(False)))
        return df if query is None else self.fuzzy(df, query, "name", [], 0.4).orderBy("score", "pos")

    def fields(self, project: str, issue_type: str) -> DataFrame:
        return self.table("field").where((F.col("project_key") == project) & (F.lower("issue_type") == issue_type.lower()))

    def all_fields(self, custom_only: bool = False, query: str | None = None) -> DataFrame:
        df = self.table("field_global")
        df = df.where("custom") if custom_only else df
        return df if query is None else self.fuzzy(df, query, "name", ["id"], 0.4).orderBy("score", "pos")

    def field(self, name: str, project: str | None = None, issue_type: str | None = None) -> DataFrame:
        """By id or name, in the context first and then among all fields."""
        hit = lambda df, id_: df.where((F.col(id_) == name) | (F.lower("name") == name.lower())).select(F.col(id_).alias("id"), "name")
        out = hit(self.table("field_global"), "id").withColumn("at", F.lit(1))
        if project and issue_type:
            out = hit(self.fields(project, issue_type), "field_id").withColumn("at", F.lit(0)).unionByName(out)
        return out.orderBy("at").limit(1).select("id", "name")

    def options(self, project: str, issue_type: str, field_id: str) -> DataFrame:
        """Enabled options of a field, from its schema, else from its contexts (the global one first)."""
        own = self.fields(project, issue_type).where(F.col("field_id") == field_id).select(F.explode("allowed").alias("o"), F.lit(0).alias("at"))
        other = self.table("field_context").where(F.col("field_id") == field_id).select(F.explode("options").alias("o"), F.when(F.col("is_global"), 1).otherwise(2).alias("at")) if "field_context" in self.tables else own.limit(0)
        both = own.unionByName(other).where(~F.coalesce(F.col("o.disabled"), F.lit(False))) if "disabled" in own.schema["o"].dataType.fieldNames() else own.unionByName(other)
        first = both.agg(F.min("at").alias("first"))
        return both.join(first, F.col("at") == F.col("first")).select("o.*")

    def users(self, active: bool = True) -> DataFrame:
        df = self.table("user")
        return df.where("active IS NULL OR active") if active else df

    def boards(self, project: str) -> DataFrame:
        return self.table("board").where((F.col("project_key") == project) & (F.col("type") == "scrum"))

    def sprints(self, project: str) -> DataFrame:
        """Open sprints of a project's boards, each id once (the last board's)."""
        open_ = self.table("sprint").where(F.col("state").isin("active", "future")).join(self.boards(project).select("board_id", "pos"), "board_id")
        return open_.groupBy("sprint_id").agg(F.max_by(F.struct("name", "state", "board_id"), "pos").alias("s")).select("sprint_id", "s.*")

    def open_sprints(self) -> DataFrame:
        """project, sprint_id, name, state, pos of the open sprints of all projects' boards, each id once a project."""
        boards = self.table("board").where("type = 'scrum'").select("board_id", F.col("project_key").alias("project"), "pos")
        open_ = self.table("sprint").where(F.col("state").isin("active", "future")).select("sprint_id", "name", "state", "board_id").join(boards, "board_id")
        return open_.groupBy("project", "sprint_id").agg(F.max_by(F.struct("name", "state", "pos"), "pos").alias("s")).select("project", "sprint_id", "s.*")

    def components(self, project: str) -> DataFrame:
        return self.table("component").where(F.col("project_key") == project).select("id", "name")

    def versions(self, project: str) -> DataFrame:
        return self.table("version").where(F.col("project_key") == project).select("id", "name", "released")

    def priorities(self) -> DataFrame:
        return self.table("priority").select("id", "name")

    def hierarchy(self) -> DataFrame:
        """Levels with whole, non-negative ids and titles; type ids as sorted text."""
        df = self.table("hierarchy").where("id >= 0 AND trim(title) <> ''")
        return df.select("id", F.trim("title").alias("title"), F.array_sort(F.transform("type_ids", lambda x: x.cast("string"))).alias("type_ids")).orderBy("id")

    def fuzzy(self, df: DataFrame, query: str, id_col: str, keys: list[str], threshold: float) -> DataFrame:
        named = df.withColumn("name", F.col("name")).withColumn("__all", F.lit(1))
        values = self.spark.createDataFrame([(query.lower(), 1)], "wanted string, __all int")
        dim = named.select("__all", F.col(id_col).alias("id"), *({"name", *keys} - {"id"}))
        dim = dim if id_col == "name" or "name" in dim.columns else dim.withColumn("name", F.col("id"))
        hits = scored(values, dim, ["__all"], [k for k in keys if k != "name"], Options(threshold=threshold, ignore_place=False, least_run=1))
        return df.join(hits.groupBy("id").agg(F.min("score").alias("score")).withColumnRenamed("id", "__hit"), F.col(id_col) == F.col("__hit")).drop("__hit")


class PagesSource(DataSource):
    """Recorded REST pages: spark.read.format("recorded_pages").option("folder", ...).schema(...)."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagesReader(self.options["folder"], self.options.get("items", "values"))


class _PagesReader(DataSourceReader):
    def __init__(self, folder: str, items: str) -> None:
        self.folder, self.items = folder, items

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in sorted(Path(self.folder).glob("*.json"))] or [InputPartition("")]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value:
            body = json.loads(Path(partition.value).read_text(encoding="utf-8"))
            for item in body if isinstance(body, list) else body.get(self.items, []):
                yield int("".join(c for c in Path(partition.value).stem if c.isdigit()) or 0), json.dumps(item, ensure_ascii=False)
