"""Records from CSV, JSON and YAML text, files and Python rows.

Files are read whole by Spark (so any store that Spark reads will do), repaired, parsed and turned into one row a record:
source, row_index, raw (canonical JSON in the record's own key order), and error. A text that can't be parsed gives one
row with its error.
"""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar import errors
from loomspar.functions.repair import around_blocks, custom_blocks, double_escapes, escape_controls, repair_text, sanitize, yaml_base

FORMATS = {".csv": "csv", ".json": "json", ".yaml": "yaml", ".yml": "yaml"}
SCHEMA = "source string, row_index bigint, raw string, error string"


def csv_cells(text: str) -> Iterator[list[tuple[str, bool]]]:
    """Rows of cells with whether each was quoted; doubled quotes are one; blank lines are skipped."""
    row: list[tuple[str, bool]] = []
    cell = re.compile(r'(?:"(?P<q>(?:[^"]|"")*)"|(?P<u>[^,"\r\n]*))(?P<end>,|\r\n|\r|\n|$)')
    at = 0
    while at <= len(text):
        m = cell.match(text, at)
        if m is None:
            raise ValueError(f"quotes aren't closed at offset {at}")
        row.append((m["q"].replace('""', '"'), True) if m["q"] is not None else (m["u"], False))
        at = m.end()
        if m["end"] != ",":
            if row != [("", False)]:
                yield row
            row = []
            if not m["end"]:
                return


def parse_csv(text: str) -> list[dict]:
    """By the header's names; an empty cell is null if it wasn't quoted, else ''."""
    rows = list(csv_cells(text))
    if not rows:
        return []
    names = [c for c, _ in rows[0]]
    for i, r in enumerate(rows[1:], 2):
        if len(r) != len(names):
            raise ValueError(f"row {i} has {len(r)} cells, the header {len(names)}")
    return [{n: (None if c == "" and not quoted else c) for n, (c, quoted) in zip(names, r)} for r in rows[1:]]


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON value")


def parse_json(text: str) -> list[dict]:
    """An object is one record, an array its items. After a failure, escapes and control characters are mended once; if that
    doesn't help, the first error is raised."""
    load = lambda t: json.loads(t, parse_constant=_refuse)
    try:
        value = load(text)
    except ValueError as first:
        for mended in (escape_controls(double_escapes(text)), escape_controls(text)):
            with contextlib.suppress(ValueError):
                value = load(mended)
                break
        else:
            raise first
    if not isinstance(value, (dict, list)):
        raise ValueError("neither an object nor an array")
    return value if isinstance(value, list) else [value]


@cache
def _yaml_loader(base: type) -> type:
    import yaml

    class Loader(base):
        """Scalars of YAML 1.2: only true and false are booleans, 010 is ten and 0o10 eight, times and dates stay text.
        Digits may be parted by underscores."""

    ours = {
        "bool": (r"true|True|TRUE|false|False|FALSE", "tTfF", None),
        "int": (r"[-+]?(?:0b[01_]+|0o[0-7_]+|0x[0-9a-fA-F_]+|[0-9][0-9_]*)", "-+0123456789", _yaml_int),
        "float": (r"[-+]?(?:[0-9][0-9_]*)(?:\.[0-9_]*)?(?:[eE][-+]?[0-9]+)?|[-+]?\.[0-9][0-9_]*(?:[eE][-+]?[0-9]+)?", "-+.0123456789", lambda t: float(t.replace("_", ""))),
    }
    drop = {f"tag:yaml.org,2002:{k}" for k in (*ours, "timestamp")}
    Loader.yaml_implicit_resolvers = {k: [r for r in v if r[0] not in drop] for k, v in yaml.SafeLoader.yaml_implicit_resolvers.items()}
    for name, (pattern, first, make) in ours.items():
        Loader.add_implicit_resolver(f"tag:yaml.org,2002:{name}", re.compile(f"^(?:{pattern})$"), list(first))
        if make:
            Loader.add_constructor(f"tag:yaml.org,2002:{name}", lambda loader, node, make=make: make(loader.construct_scalar(node)))
    return Loader


def _yaml_int(text: str) -> int:
    sign, digits = (-1 if text[0] == "-" else 1), text.lstrip("+-").replace("_", "")
    base = {"0b": 2, "0o": 8, "0x": 16}.get(digits[:2], 10)
    return sign * int(digits if base == 10 else digits[2:], base)


def parse_yaml(text: str) -> list[dict]:
    """All documents of the stream; empty ones are skipped and lists flattened."""
    import yaml

    load = lambda t, base: list(yaml.load_all(t, _yaml_loader(base)))
    docs = None
    if (base := yaml_base(text)) is not yaml.SafeLoader:
        with contextlib.suppress(yaml.YAMLError):  # errors are told by the parser in Python
            docs = load(text, base)
    if docs is None:
        try:
            docs = load(text, yaml.SafeLoader)
        except yaml.YAMLError:
            docs = load(double_escapes(text), yaml.SafeLoader)
    out: list[dict] = []
    for d in docs:
        if isinstance(d, (dict, list)):
            out += d if isinstance(d, list) else [d]
        elif d is not None:
            raise ValueError("a document is neither a mapping nor a list")
    return out


PARSERS = {"csv": parse_csv, "json": parse_json, "yaml": parse_yaml}


def parse(text: str, fmt: str, blocks: bool = True, quotes: bool = True, always: bool = False) -> list[dict]:
    """Quotes are repaired first, outside of blocks (where the text doesn't parse as it is, unless always), then blocks are
    folded."""
    if quotes:

        def repaired(t: str) -> str:
            return repair_text(t, fmt, always) if fmt != "csv" or always or _broken_csv(t) else t

        text = around_blocks(text, repaired) if blocks else repaired(text)
    if blocks:
        text = custom_blocks(text, fmt)
    return [sanitize(r) for r in PARSERS[fmt](text)]


def _broken_csv(text: str) -> bool:
    try:
        parse_csv(text)
    except ValueError:
        return True
    return False


def _parsed(text: str | None, fmt: str | None, blocks: bool, quotes: bool, always: bool) -> list[tuple]:
    if fmt not in PARSERS:
        return [(0, None, f"{errors.INPUT_PARSE}: no format")]
    try:
        return [(i, json.dumps(r, ensure_ascii=False, default=str), None) for i, r in enumerate(parse(text or "", fmt, blocks, quotes, always))]
    except Exception as e:
        return [(0, None, f"{errors.INPUT_PARSE}: {e}")]


#: Short texts that repeat are parsed once a worker, as long as they are among the last ones.
_parsed_short = lru_cache(maxsize=1024)(_parsed)
SHORT = 2048


def _records(source: str, text: str | None, fmt: str | None, options: dict) -> list[tuple]:
    parsed = _parsed_short if text is None or len(text) <= SHORT else _parsed
    return [(source, *r) for r in parsed(text, fmt, **options)]


def parse_texts(texts: DataFrame, blocks: bool = True, quotes: bool = True, always: bool = False) -> DataFrame:
    """SCHEMA from rows of source, fmt and text. They are dealt out first: parsing takes far longer than moving them, and many
    of them may come from one small file."""
    options = {"blocks": blocks, "quotes": quotes, "always": always}

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [r for s, f, t in zip(b["source"], b["fmt"], b["text"]) for r in _records(s, t, f, options)]
            yield pd.DataFrame(rows, columns=["source", "row_index", "raw", "error"])

    return texts.select("source", "fmt", "text").repartition(F.xxhash64("source", "text")).mapInPandas(run, SCHEMA)


def read_files(spark: SparkSession, path: str, fmt: str | None = None, **options: bool) -> DataFrame:
    """Records of all files under a path; the format by their extensions unless given."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
    ext = F.lower(F.regexp_extract("source", r"(\.[^./]+)$", 1))
    found = F.lit(fmt) if fmt else F.create_map(*[F.lit(x) for kv in FORMATS.items() for x in kv])[ext]
    return parse_texts(files.withColumn("fmt", found), **options)


def read_records(spark: SparkSession, path: str | None = None, data: object = None, fmt: str | None = None, **options: bool) -> DataFrame:
    """One entry for all inputs: a path, a text with its format, an array of arrays (the first is the header), an array of
    objects, or one object."""
    if path is None and data is None:
        raise errors.EngineError(errors.VALIDATION, "neither a path nor data")
    if path is not None:
        return read_files(spark, path, fmt, **options)
    if isinstance(data, str):
        if fmt not in PARSERS:
            raise errors.EngineError(errors.INPUT_PARSE, "a text needs a format")
        return parse_texts(spark.createDataFrame([("data", fmt, data)], "source string, fmt string, text string"), **options)
    rows = [data] if isinstance(data, dict) else data
    if not isinstance(rows, list):
        raise errors.EngineError(errors.INPUT_PARSE, "data is of no known kind")
    if rows and (fmt == "csv" or isinstance(rows[0], list)):
        if not isinstance(rows[0], list):
            raise errors.EngineError(errors.INPUT_PARSE, "the header isn't an array")
        rows = [dict(zip(rows[0], r)) for r in rows[1:]]
    raw = [("data", i, json.dumps(sanitize(r), ensure_ascii=False, default=str), None) for i, r in enumerate(rows)]
    return spark.createDataFrame(raw, SCHEMA)


def normal_input(data: object) -> object:
    """Arrays as they are; {"issues": [{"fields": ...}]} gives the fields; {"fields": {"project": ...}} gives the fields."""
    if isinstance(data, dict):
        if isinstance(data.get("issues"), list):
            return [i.get("fields", i) if isinstance(i, dict) else i for i in data["issues"]]
        inner = data.get("fields")
        if isinstance(inner, dict) and "project" in inner:
            return inner
    return data


def input_kind(data: object) -> str:
    """bulk or single."""
    if isinstance(data, list):
        return "bulk"
    if isinstance(data, dict):
        if {"from", "data", "format"} & set(data):
            return "bulk"
        if {"Project", "project"} & set(data):
            return "single"
    raise errors.EngineError(errors.VALIDATION, "neither one record nor several")


__all__ = ["input_kind", "normal_input", "parse", "parse_texts", "read_files", "read_records"]
