"""Rules over records, with findings as rows.

Each record is judged in place: its entries are an array, its schema joins as an array of fields by (project, type), and
the findings are an array that is exploded last. The records are read once and never shuffled (the schemas are small, and
Spark broadcasts them while they are). Rows whose project or type is missing or unknown are judged no further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspar.functions.scalars import is_meta_field, to_number
from loomspar.operators.cells import entries, first_named

#: Fixed values.
REQUIRED, TYPE, ENUM, PROJECT, ISSUE_TYPE, UNKNOWN = "REQUIRED_FIELD_MISSING", "INVALID_TYPE", "INVALID_ENUM_VALUE", "INVALID_PROJECT", "INVALID_ISSUE_TYPE", "UNKNOWN_FIELD"
FINDING = "array<struct<severity:string,code:string,field:string>>"


def _finding(code: str, field: Column | str, severity: str = "error") -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), (F.lit(field) if isinstance(field, str) else field).alias("field"))


def _some(*findings: Column) -> Column:
    return F.array_compact(F.array(*findings)).cast(FINDING)


def _wrong_type(kind: Column, text: Column, wanted: Column) -> Column:
    return (
        F.when(wanted == "string", kind != "string")
        .when(wanted == "number", ~((kind == "number") | ((kind == "string") & to_number(text).isNotNull())))
        .when(wanted == "array", kind != "array")
        .when(wanted.isin("user", "priority", "issuetype", "project"), ~kind.isin("string", "object"))
        .otherwise(False)
    )


def _refused(e: Column, allowed: Column, enum_arrays: str) -> Column:
    """Whether a value is none of those allowed: its name (without case) or id; of an array, any element."""
    get = lambda path: F.try_variant_get(e["value"], path, "string")
    one = F.when(e["kind"] == "object", F.coalesce(get("$.name"), get("$.id"))).otherwise(e["text"])
    many = F.try_variant_get(e["value"], "$", "array<string>") if enum_arrays == "elements" else F.array(F.lit(""))
    known = lambda x: F.coalesce(F.exists(allowed, lambda a: (F.lower(a["name"]) == F.lower(x)) | (a["id"] == x)), F.lit(False))
    return allowed.isNotNull() & ~F.coalesce(F.forall(F.when(e["kind"] == "array", many).otherwise(F.array(one)), known), F.lit(False))


def validate(records: DataFrame, fields: DataFrame, enum_arrays: str = "elements") -> DataFrame:
    """row_index, severity, code, field.

    records: row_index, raw. fields: project_key, issue_type, name, type, required, allowed (array of struct id, name;
    null if any value will do). enum_arrays: "elements" checks each element of an array, "whole" refuses arrays."""
    schemas = fields.groupBy(F.upper("project_key").alias("p"), F.upper("issue_type").alias("t")).agg(
        F.array_sort(F.collect_list(F.struct("name", F.lower("name").alias("low"), F.col("type").alias("wanted"), "required", "allowed"))).alias("fields")
    )
    projects = schemas.select(F.col("p").alias("kp")).distinct()
    rows = records.select("row_index", entries("raw").alias("entries"))
    rows = rows.select("row_index", "entries", first_named("entries", "project").alias("project"), first_named("entries", "issuetype").alias("kind"))
    rows = rows.withColumns({"p": F.upper("project"), "t": F.upper("kind")}).join(schemas, ["p", "t"], "left").join(projects, F.col("p") == F.col("kp"), "left")

    full = F.transform(F.filter("entries", lambda e: ~((e["kind"] == "null") | ((e["kind"] == "string") & (e["text"] == "")))), lambda e: e.withField("low", F.lower(e["key"])))
    rows = rows.withColumn("full", full)
    needed = F.filter("fields", lambda f: f["required"] & ~F.exists("full", lambda e: e["low"] == f["low"]))
    required = F.transform(needed, lambda f: _finding(REQUIRED, f["name"]))
    matched = F.transform(F.filter("full", lambda e: ~is_meta_field(e["key"])), lambda e: F.struct(e.alias("e"), F.get(F.filter("fields", lambda f: f["low"] == e["low"]), F.lit(0)).alias("f")))
    rows = rows.withColumns({"required": required, "matched": matched})
    e, f = (lambda m: m["e"]), (lambda m: m["f"])
    judged = F.transform("matched", lambda m: F.when(f(m).isNull(), _finding(UNKNOWN, e(m)["key"], "warning")).when(_wrong_type(e(m)["kind"], e(m)["text"], f(m)["wanted"]), _finding(TYPE, f(m)["name"])).when(_refused(e(m), f(m)["allowed"], enum_arrays), _finding(ENUM, f(m)["name"])))
    missing = _some(F.when(F.col("project").isNull(), _finding(REQUIRED, "Project")), F.when(F.col("kind").isNull(), _finding(REQUIRED, "Issue Type")))
    lost = F.when(F.col("kp").isNull(), _some(_finding(PROJECT, "Project"))).otherwise(_some(_finding(ISSUE_TYPE, "Issue Type")))
    found = F.when(F.size(missing) > 0, missing).when(F.col("fields").isNull(), lost).otherwise(F.concat(F.col("required").cast(FINDING), F.array_compact(judged).cast(FINDING)))
    return rows.select("row_index", F.explode(found).alias("finding")).select("row_index", "finding.*")


def summary(findings: DataFrame) -> DataFrame:
    return findings.groupBy("severity", "code", "field").agg(F.count(F.lit(1)).alias("n_findings"), F.countDistinct("row_index").alias("n_rows"))
