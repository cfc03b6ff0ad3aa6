"""Raw metadata (JSON text, one object a row) as typed dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_j = F.get_json_object


def projects(raw: DataFrame) -> DataFrame:
    return raw.select(
        "pos", _j("raw", "$.id").alias("id"), _j("raw", "$.key").alias("key"), _j("raw", "$.name").alias("name"), F.coalesce(_j("raw", "$.projectTypeKey"), F.lit("software")).alias("project_type_key"),
        F.coalesce(_j("raw", "$.avatarUrls['48x48']"), _j("raw", "$.avatarUrls['32x32']")).alias("avatar"),
    )


def issue_types(raw: DataFrame) -> DataFrame:
    return raw.select("project_key", _j("raw", "$.id").alias("id"), _j("raw", "$.name").alias("name"), F.coalesce(_j("raw", "$.subtask").cast("boolean"), F.lit(False)).alias("subtask"), F.struct(_j("raw", "$.scope.type").alias("type"), _j("raw", "$.scope.project.id").alias("project_id")).alias("scope"))


_ALLOWED = "array<struct<id:string,name:string,value:string,children:array<struct<id:string,value:string>>>>"


def fields(raw: DataFrame) -> DataFrame:
    """Rows without a field id are dropped; an allowed value's name is its value, else its name."""
    allowed = F.from_json(_j("raw", "$.allowedValues"), _ALLOWED)
    shown = F.transform(allowed, lambda a: F.struct(a["id"].alias("id"), F.coalesce(F.nullif(a["value"], F.lit("")), a["name"]).alias("name"), a["children"].alias("children")))
    out = raw.select(
        "project_key", "issue_type", "pos", _j("raw", "$.fieldId").alias("field_id"), _j("raw", "$.name").alias("name"), _j("raw", "$.schema.type").alias("kind"), _j("raw", "$.schema.items").alias("items"), _j("raw", "$.schema.custom").alias("plugin"),
        F.coalesce(_j("raw", "$.required").cast("boolean"), F.lit(False)).alias("required"), shown.alias("allowed"),
    )
    return out.where("field_id IS NOT NULL")


def global_fields(raw: DataFrame) -> DataFrame:
    id_ = _j("raw", "$.id")
    return raw.select("pos", id_.alias("id"), _j("raw", "$.name").alias("name"), F.coalesce(_j("raw", "$.custom").cast("boolean"), id_.startswith("customfield_")).alias("custom"), F.lit(False).alias("required"))


def users(raw: DataFrame) -> DataFrame:
    return raw.select("pos", _j("raw", "$.name").alias("username"), _j("raw", "$.displayName").alias("display"), _j("raw", "$.emailAddress").alias("email"), _j("raw", "$.accountId").alias("account_id"), _j("raw", "$.active").cast("boolean").alias("active"))
