"""Substring deduplication by Rabin-Karp hashes of every fixed-length word window.

Each group of documents asks for each distinct window hash, with the smallest document that holds it; the hash's bucket
answers whether a smaller document of another group holds it too. Repeated windows merge into maximal intervals, whose
words are removed. Two windows count as equal if their 64-bit hashes are: in a corpus of n windows about n**2 / 2**65
pairs would meet by chance (under 0.001 at 150 million windows).

Defined cases: a null or empty text has no words; a null id sorts after all others; rows with one id sort by text, and
of equal rows the first stays; with fewer words than a window nothing is removed. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._exchange import bucket_edges, delta, lookup, pack, undelta, unpack
from loomspar.llm._tokens import words, windows

WINDOW = 20
_LAST = np.iinfo(np.int64).max
SCHEMA = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def _distinct(texts: list[bytes], k: int):
    w = words(texts)
    at, keys = windows(w.hash, w.off, k)
    uniq, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return w, at, uniq, first, inverse


def _ask(k: int):
    def ask(ids: list, texts: list[bytes], buckets: int) -> list[bytes]:
        w, at, uniq, first, _ = _distinct(texts, k)
        doc = np.array([_LAST if x is None else x for x in ids], np.int64)[w.text_of_word()[at[first]]]
        edges = bucket_edges(uniq, buckets)
        return [pack(delta(uniq[i:j]), doc[i:j]) for i, j in zip(edges, edges[1:])]

    return ask


def _answer(blobs: list[bytes]) -> list[bytes]:
    parts = [unpack(b) for b in blobs]
    keys = np.concatenate([undelta(p[0]) for p in parts])
    docs = np.concatenate([p[1].view(np.int64) for p in parts])
    order = np.argsort(keys, kind="stable")
    sorted_keys, sorted_docs = keys[order], docs[order]
    later = np.zeros(len(keys), bool)
    if len(keys):
        head = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
        least = np.repeat(np.minimum.reduceat(sorted_docs, head), np.diff(np.append(head, len(keys))))
        later[order] = sorted_docs > least
    out, at = [], 0
    for p in parts:
        out.append(pack(np.packbits(later[at : at + len(p[0])])))
        at += len(p[0])
    return out


def _apply(k: int):
    def apply(ids: list, texts: list[bytes], answers: list[bytes]) -> pa.Table:
        w, at, uniq, first, inverse = _distinct(texts, k)
        edges = bucket_edges(uniq, len(answers))
        later = np.concatenate([np.unpackbits(unpack(a)[0], count=j - i) for a, i, j in zip(answers, edges, edges[1:])] + [np.empty(0, np.uint8)]).astype(bool)
        repeated = later[inverse]
        repeated |= np.arange(len(at)) != first[inverse]
        cover = np.zeros(len(w.hash) + 1, np.int64)
        cover[at[repeated]] += 1
        cover[at[repeated] + k] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        total = np.concatenate(([0], np.cumsum(gone)))
        rows = []
        for i, (doc, text) in enumerate(zip(ids, texts)):
            a, b = w.off[i], w.off[i + 1]
            removed, spans, kept = int(total[b] - total[a]), [], text.split()
            if removed:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone[a:b].view(np.int8), [0]))))
                spans = [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()]
                left, parts = 0, []
                for s in spans:
                    parts += kept[left : s["start"]]
                    left = s["end"]
                kept = parts + kept[left:]
            rows.append((doc, int(b - a), removed, spans, b" ".join(kept)))
        cols = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        arrays = [pa.array(c, t) for c, t in zip(cols, kinds)] + [pa.array(cols[4], pa.binary()).cast(pa.string())]
        return pa.table(arrays, names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return apply


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, removed word intervals, kept text (words joined by one space)."""
    return lookup(docs, id_col, text_col, _ask(window), _answer, _apply(window), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, i, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents, (SELECT 1 AS i)
), starts AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s, ws FROM w WHERE len(ws) >= 20
), keyed AS (
  SELECT doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) AS k FROM starts
), ranked AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM keyed
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1
), gonelist AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), pos AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w
), kept AS (
  SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS t FROM pos
  LEFT JOIN gone ON gone.doc_id = pos.doc_id AND gone.p = pos.p WHERE gone.p IS NULL GROUP BY pos.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN gonelist USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
