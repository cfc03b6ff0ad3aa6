"""Queries of readers, repair and document trees: texts of the driver's tables are wrapped, broken and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.functions import documents as D
from loomspar.functions import repair as R
from loomspar.plans.scalars import _pick, _sql_pick, _table
from loomspar.sources.readers import parse_texts


def _value(raw: DataFrame, key: str = "text") -> DataFrame:
    return raw.select(F.col("source").cast("bigint").alias("id"), F.get_json_object("raw", f"$.{key}").alias("text"), "error")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    inner = F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\n'), "p_brand")
    text = F.concat(F.lit("id,text,none,blank\n"), F.col("p_partkey").cast("string"), F.lit(',"'), F.replace(inner, F.lit('"'), F.lit('""')), F.lit('",,""\n'))
    out = parse_texts(p.select(F.col("p_partkey").cast("string").alias("source"), F.lit("csv").alias("fmt"), text.alias("text")))
    blank = F.get_json_object("raw", "$.blank")
    return out.select(F.col("source").cast("bigint").alias("id"), F.get_json_object("raw", "$.text").alias("text"), F.get_json_object("raw", "$.none").isNull().alias("null_cell"), (blank == "").alias("blank_cell"))


def csv_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with bare quotes inside, quoted and not."""
    p = _table(spark, sf_dir, "part")
    cell = _pick(F.col("p_partkey"), F.concat(F.lit('"the "'), "p_name", F.lit('" ring"')), F.concat(F.lit('a "'), "p_name", F.lit('" b')))
    text = F.concat(F.lit("id,text\n1,"), cell, F.lit("\n"))
    return _value(parse_texts(p.select(F.col("p_partkey").cast("string").alias("source"), F.lit("csv").alias("fmt"), text.alias("text"))))


def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    text = _pick(
        F.col("p_partkey"), F.concat(F.lit('{"text": "the "'), "p_name", F.lit('" ring"}')), F.concat(F.lit("{'text': '"), "p_name", F.lit("'}")), F.concat(F.lit('{"text": "'), "p_name", F.lit("\n"), "p_type", F.lit('"}')),
        F.concat(F.lit('[{"text": "'), "p_name", F.lit('"}]')), F.concat(F.lit('{"text": "C:\\'), "p_type", F.lit('"}')),
    )
    return _value(parse_texts(p.select(F.col("p_partkey").cast("string").alias("source"), F.lit("json").alias("fmt"), text.alias("text"))))


def yaml_multi_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    text = F.concat(F.lit("text: "), "p_name", F.lit("\n---\n- text: yes\n- text: 2024-01-02\n---\n---\ntext: \"say \""), "p_type", F.lit('" now"\n'))
    out = parse_texts(p.select(F.col("p_partkey").cast("string").alias("source"), F.lit("yaml").alias("fmt"), text.alias("text")))
    return out.select(F.col("source").cast("bigint").alias("id"), "row_index", F.get_json_object("raw", "$.text").alias("text"))


def quote_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    text = _pick(F.col("p_partkey"), F.concat(F.lit('a: "the "'), "p_name", F.lit('" ring"\nb: 1')), F.concat(F.lit("a: 'it's "), "p_name", F.lit("'\nb: 1")), F.concat(F.lit('a: "open '), "p_name"), F.concat(F.lit("a: "), "p_name"))
    return p.select(F.col("p_partkey").alias("id"), R.repair_details(text, "yaml").alias("r")).select("id", "r.output", "r.modified")


def custom_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    block = F.concat(F.lit("<<<\nline \""), "p_name", F.lit("\"\n\\d >> end\n>>>"))
    fmt = _pick(F.col("p_partkey"), "yaml", "json", "csv")
    text = _pick(F.col("p_partkey"), F.concat(F.lit("text: "), block), F.concat(F.lit('{"text": '), block, F.lit("}")), F.concat(F.lit("id,text\n1,"), block, F.lit("\n")))
    return _value(parse_texts(p.select(F.col("p_partkey").cast("string").alias("source"), fmt.alias("fmt"), text.alias("text"))))


def sanitize_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), R.nfkc(F.concat(F.lit("\u00a0 \uff46\uff55\uff4c\uff4c \ufb01\u200b "), "p_name", F.lit("\ufeff "))).alias("text"))


def _markup(c: str) -> F.Column:
    return F.concat(F.lit("## "), F.col(c), F.lit("\n\n- **"), F.col(c), F.lit("**\n- b\n1. one `x`\n\n"), F.col(c), F.lit("\n[l](http://e.org/) _it_\n```sql\nSELECT 1\n```"))


def markdown_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    tree = F.parse_json(D.markup_to_tree(_markup("p_name")))
    at = lambda path, kind: F.try_variant_get(tree, path, kind)
    return p.select(
        F.col("p_partkey").alias("id"), at("$.content[0].type", "string").alias("first"), at("$.content[0].attrs.level", "bigint").alias("level"), at("$.content[1].content[0].content[0].content[0].text", "string").alias("bold"),
        at("$.content[1].content[0].content[0].content[0].marks[0].type", "string").alias("mark"), at("$.content[4].attrs.language", "string").alias("lang"), at("$.content[3].content[2].marks[0].attrs.href", "string").alias("href"),
    )


def markdown_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), D.tree_to_plain(D.markup_to_tree(_markup("p_name"))).alias("text"))


QUERIES = {f.__name__: f for f in (csv_roundtrip, csv_repair, json_repair, yaml_multi_doc, quote_repair, custom_blocks, sanitize_nfkc, markdown_tree, markdown_plain_text)}
_NONE = "CAST(NULL AS VARCHAR) AS error"
SQL = {
    "csv_roundtrip": """SELECT p_partkey AS id, p_name || ', "' || p_type || '"' || chr(10) || p_brand AS text, true AS null_cell, true AS blank_cell FROM part""",
    "csv_repair": f"""SELECT p_partkey AS id, {_sql_pick('p_partkey', "'the \"' || p_name || '\" ring'", "'a \"' || p_name || '\" b'")} AS text, {_NONE} FROM part""",
    "json_repair": f"""SELECT p_partkey AS id, {_sql_pick('p_partkey', "'the \"' || p_name || '\" ring'", "p_name", "p_name || chr(10) || p_type", "p_name", "'C:\\' || p_type")} AS text, {_NONE} FROM part""",
    "yaml_multi_doc": """SELECT p_partkey AS id, CAST(i AS BIGINT) AS row_index, CASE i WHEN 0 THEN p_name WHEN 1 THEN 'yes' WHEN 2 THEN '2024-01-02' ELSE 'say "' || p_type || '" now' END AS text FROM part, range(4) t(i)""",
    "quote_repair": f"""SELECT p_partkey AS id, {_sql_pick('p_partkey', "'a: \"the \\\"' || p_name || '\\\" ring\"' || chr(10) || 'b: 1'", "'a: ''it''''s ' || p_name || '''' || chr(10) || 'b: 1'", "'a: \"open ' || p_name || '\"'", "'a: ' || p_name")} AS output, p_partkey % 4 < 3 AS modified FROM part""",
    "custom_blocks": f"""SELECT p_partkey AS id, 'line "' || p_name || '"' || chr(10) || '\\d >> end' AS text, {_NONE} FROM part""",
    "sanitize_nfkc": "SELECT p_partkey AS id, 'full fi ' || p_name AS text FROM part",
    "markdown_tree": "SELECT p_partkey AS id, 'heading' AS first, CAST(2 AS BIGINT) AS level, p_name AS bold, 'strong' AS mark, 'sql' AS lang, 'http://e.org/' AS href FROM part",
    "markdown_plain_text": "SELECT p_partkey AS id, p_name || chr(10) || chr(10) || '- ' || p_name || chr(10) || '- b' || chr(10) || chr(10) || '1. one x' || chr(10) || chr(10) || p_name || chr(10) || 'l it' || chr(10) || chr(10) || 'SELECT 1' AS text FROM part",
}
