"""Keyed lookups between groups of documents and hash buckets, in compact blobs.

Operators that ask something about every window or n-gram of a corpus would shuffle a row per occurrence. Here each
group of documents asks once per distinct key, as sorted 64-bit hashes in one blob per bucket; the bucket answers in
the same order, so no key travels back. A key that a third of all documents hold is asked once per group, which bounds
what one bucket reads. Groups are dealt by bytes of text: about sqrt(2048 bytes) of the whole, so that blobs grow as
the corpus does, within GROUP_BYTES; that bounds a task's memory whatever the corpus. Beyond some 2 TB groups stay at the
larger bound and blobs become smaller (about a dozen keys at 100 TB, still fewer rows than one a key).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspar.llm._rows import small_batches

U = np.uint64
GROUP_DOCS = 2048
#: The least and the most bytes of text in a group, on average.
GROUP_BYTES = (4 << 20, 64 << 20)


def group_count(n_docs: int) -> int:
    return max(1, math.ceil(n_docs / max(GROUP_DOCS, math.isqrt(n_docs))))


def groups_of_bytes(n_bytes: int) -> int:
    low, high = GROUP_BYTES
    return max(1, math.ceil(n_bytes / min(max(low, math.isqrt(2048 * n_bytes)), high)))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of fixed-width integers as byte planes, each compressed by itself (random ones stay as they are)."""
    z, parts = zstandard.ZstdCompressor(level=1, write_content_size=False), []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T
        made = []
        for p in planes:
            if not p.any():
                made.append(b"")  # zeros
                continue
            raw = p.tobytes()
            small = z.compress(raw)
            made.append(small if len(small) < len(raw) else raw)
        parts += [np.array([len(a), a.dtype.itemsize, *map(len, made)], np.uint32).tobytes(), *made]
    return b"".join(parts)


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays of pack(), as unsigned integers."""
    z, at, out = zstandard.ZstdDecompressor(), 0, []
    while at < len(blob):
        n, width = np.frombuffer(blob, np.uint32, 2, at).tolist()
        sizes = np.frombuffer(blob, np.uint32, width, at + 8).tolist()
        at += 8 + 4 * width
        planes = np.zeros((width, n), np.uint8)
        for plane, size in zip(planes, sizes):
            if size:
                raw = blob[at : at + size]
                plane[:] = np.frombuffer(raw if size == n else z.decompress(raw, max_output_size=n), np.uint8)
            at += size
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"u{width}"))
    return out


def delta(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned keys; undone by undelta()."""
    return np.diff(keys, prepend=U(0))


def undelta(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d.astype(U), dtype=U)


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted 64-bit keys fall into equal ranges; where each bucket's slice begins, and the end."""
    lows = np.array([b * 2**64 // buckets for b in range(buckets)], dtype=U)
    return np.searchsorted(keys, lows).tolist() + [len(keys)]


def compressed(docs: DataFrame, id_col: str, text_col: str, groups: int, deal: list[str]) -> DataFrame:
    """g (by the hash of the columns in deal), id, text bytes compressed by zstd (null stays null); the text is shuffled in
    this form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            texts = [None if x is None else z.compress(x) for x in b.column(2).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["g", "id", "z"])

    source = docs.select(
        F.pmod(F.xxhash64(*[F.col(c) for c in deal]), F.lit(groups)).cast("int").alias("g"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("z")
    )
    return source.mapInArrow(run, "g int, id long, z binary")


def plain(column: pa.ChunkedArray) -> list[bytes]:
    z = zstandard.ZstdDecompressor()
    return [b"" if x is None else z.decompress(x) for x in column.to_pylist()]


def ordered(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts of a group by id, then text (null ids last), so that every reading sees the same order."""
    ids, texts = table["id"].to_pylist(), plain(table["z"])
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


Ask = Callable[[list, list[bytes], int], list[bytes]]
Answer = Callable[[list[bytes]], list[bytes]]
Apply = Callable[[list, list[bytes], list[bytes]], pa.Table]


def lookup(docs: DataFrame, id_col: str, text_col: str, ask: Ask, answer: Answer, apply: Apply, schema: str, apart: bool = False) -> DataFrame:
    """ask(ids, texts, buckets) gives a blob per bucket; answer(blobs of one bucket) a blob for each; apply(ids, texts,
    answers by bucket) the result rows of the group. Rows of one id are in one group unless they may be apart."""
    small_batches(docs.sparkSession)
    groups = groups_of_bytes(docs.agg(F.sum(F.octet_length(F.col(text_col)) + 16)).first()[0] or 0)
    source = compressed(docs, id_col, text_col, groups, [id_col, text_col] if apart else [id_col])

    def asked(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blobs = ask(*ordered(table), groups)
        return pa.table({"g": pa.array([key[0].as_py()] * groups, pa.int32()), "b": pa.array(range(groups), pa.int32()), "blob": pa.array(blobs, pa.binary())})

    def answered(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.table({"g": table["g"], "b": table["b"], "blob": pa.array(answer(table["blob"].to_pylist()), pa.binary())})

    def applied(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        answers = dict(zip(right["b"].to_pylist(), right["blob"].to_pylist(), strict=True))
        return apply(*ordered(left), [answers[b] for b in range(groups)])

    requests = source.groupBy("g").applyInArrow(asked, "g int, b int, blob binary")
    answers = requests.groupBy("b").applyInArrow(answered, "g int, b int, blob binary")
    return source.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(applied, schema)
