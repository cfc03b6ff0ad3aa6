"""Writing payloads in batches. The writer is given by the caller; one that assigns keys by row stands in for a service.

A sink is idempotent by (manifest, row_index): a task that runs again writes the same keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "row_index bigint, key string, error string"
Writer = Callable[[list[tuple[int, str]]], list[tuple[int, str | None, str | None]]]


def numbered(prefix: str = "ROW") -> Writer:
    """Keys by row index; payloads that hold "fail" are refused."""
    return lambda batch: [(i, None, "refused") if '"fail"' in p else (i, f"{prefix}-{i}", None) for i, p in batch]


def write(payloads: DataFrame, writer: Writer, batch_size: int = 50) -> DataFrame:
    """RESULT for rows of row_index and payload."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = list(zip(part["row_index"].tolist(), part["payload"].tolist()))
            for i in range(0, len(rows), batch_size):
                yield pd.DataFrame(writer(rows[i : i + batch_size]), columns=["row_index", "key", "error"])

    return payloads.select(F.col("row_index").cast("bigint").alias("row_index"), "payload").mapInPandas(run, RESULT)


def remove_marker(labels: DataFrame, marker: str, batch_size: int = 10) -> DataFrame:
    """row_index, batch, labels without the marker."""
    return labels.select("row_index", F.floor(F.col("row_index") / batch_size).cast("bigint").alias("batch"), F.array_remove("labels", marker).alias("labels"))
