"""Row-wise operators over Arrow batches: the input's columns stay, results come as one struct column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHUNK_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES from here on, if the session has Spark's default of 64 MB."""
    if spark.conf.get(_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the input doesn't have (compared as Spark does by default, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """64 bits of all of a row's columns; those with maps or variants, which have no hash, count as their JSON text."""
    parts = [F.col(f"`{f.name}`") if _hashable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields]
    return F.xxhash64(F.lit(seed), *parts)


def chunks(batch: pa.RecordBatch, by: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of the column `by`; a longer value is a slice of its own. No row is lost."""
    at, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(by)).fill_null(0).to_pylist()):
        if i > at and size + n > most:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if batch.num_rows > at:
        yield batch.slice(at)


def annotate(df: DataFrame, by: str, make: Callable[[], Callable[[pa.RecordBatch], list]], result: str, name: str, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """df's columns in keep (all by default) and a struct column of type `result`, one value a row from the function
    that make() gives once a task. Returns the frame and the struct's name."""
    small_batches(df.sparkSession)
    name = free_name(df, name)
    keep = df.columns if keep is None else keep
    kind = T.StructType([f for f in df.schema.fields if f.name in keep] + [T.StructField(name, T._parse_datatype_string(result))])
    arrow = to_arrow_schema(kind)
    column = arrow.field(name).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in chunks(batch, by) if batch.num_rows else ():
                made = pa.array(fn(part), column)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in arrow.names[:-1]] + [made], names=arrow.names)

    return df.mapInArrow(run, kind), name
