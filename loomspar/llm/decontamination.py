"""Benchmark decontamination with suffix arrays over the training texts.

Each slice of documents is a shard. Its suffix array holds all suffixes that begin with a word of the benchmark, sorted by
their first words: prefix doubling ranks them by one word, two, four, until a window is covered. Every suffix of a
benchmark item whose first words occur in the shard is searched by bisection, and the range found gives all places of its
window. A document and an item that share windows have their longest verbatim match found by bisecting its length: the
substrings of that length at the places in question are compared by rolling hashes, so memory follows the places, also
where a window repeats in both. Shards depend on nothing else, so a lost executor costs only its own slices.

The benchmark is read in blocks of at most BLOCK_BYTES of text, each sent to the executors once, so that what is
broadcast is bounded however large the benchmark is; results of several blocks are merged by the hashes of the whole rows
(equal rows have equal results, and come out as often as they came in).

Defined cases: null and empty texts have no words; items without words never match; an item with a null id hits words,
and is in no list of items; rows of one item id count as one item; an item shorter than the window matches as a whole;
repeated document rows repeat in the result. Word equality is that of 64-bit hashes within the benchmark's vocabulary, and
so is that of matches longer than a window.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._rows import annotate, free_name, row_hash
from loomspar.llm._tokens import ALNUM, U, mix, powers, texts_of, words

WINDOW = 10
BLOCK_BYTES = 16 << 20
RESULT = "struct<n_words:long,spans:array<struct<start:long,end:long>>,matches:array<struct<item_id:string,item_start:long,doc_start:long,length:long>>>"


_ROLL = 0xC2B2AE3D27D4EB4F
_UNROLL = pow(_ROLL, -1, 2**64)


class Rolled:
    """Hashes of all substrings of a sequence."""

    def __init__(self, token: np.ndarray) -> None:
        self.sums = np.zeros(len(token) + 1, U)
        np.cumsum(mix(token.astype(U)) * powers(_ROLL, len(token)), out=self.sums[1:])
        self.scale = powers(_UNROLL, len(token) + 1)

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.scale[start]


def _run(places: np.ndarray) -> int:
    """The longest run of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(places) != 1)
    return int(np.diff(np.concatenate(([-1], cut, [len(places) - 1]))).max())


class Probe:
    """The benchmark's side of the search: vocabulary, its suffixes as search keys, and the items and offsets of each."""

    def __init__(self, ids: list[str | None], texts: list[bytes], window: int) -> None:
        w = words(texts, ALNUM, lower=True)
        self.window, self.ids = window, ids
        self.vocabulary, token = np.unique(w.hash, return_inverse=True)
        self.token, self.off = token.astype(np.int64) + 1, w.off
        self.rolled = Rolled(self.token)
        size = np.minimum(w.counts, window)
        self.item = np.repeat(np.arange(len(ids)), np.maximum(w.counts - size + 1, 0) * (size > 0))
        first = np.concatenate([np.arange(w.off[i], w.off[i + 1] - size[i] + 1) for i in range(len(ids)) if size[i]] or [np.empty(0, np.int64)]).astype(np.int64)
        #: Places of the suffixes by key: all with key k are place[of[k]:of[k + 1]], by item, then offset.
        keys = self._keys(self.token, first, size[self.item])
        uniq, key = np.unique(keys, return_inverse=True)
        order = np.lexsort((first, self.item, key))
        self.place, self.item = first[order], self.item[order]
        self.of = np.searchsorted(key[order], np.arange(len(uniq) + 1))
        self.low = uniq
        self.length = size[self.item[self.of[:-1]]] if len(uniq) else np.empty(0, np.int64)
        self.high = self._keys(self.token, self.place[self.of[:-1]], self.length, last=True) if len(uniq) else uniq
        #: Keys by their first two words (a key of one word by itself), to leave out those that the shard doesn't have.
        head = self.place[self.of[:-1]]
        second = self.token[np.minimum(head + 1, max(len(self.token) - 1, 0))] if len(uniq) else head
        self.heads = np.where(self.length > 1, self.token[head] * (len(self.vocabulary) + 2) + second, -self.token[head]) if len(uniq) else head

    def _keys(self, token: np.ndarray, at: np.ndarray, size: np.ndarray | int, last: bool = False) -> np.ndarray:
        """The first words of the suffixes, filled up with the lowest word, or the highest, as strings in their order."""
        rows = np.full((len(at), self.window), 0xFFFFFFFF if last else 0, ">u4")
        for j in range(self.window):
            inside = j < size
            rows[:, j] = np.where(inside, token[np.minimum(at + j, max(len(token) - 1, 0))] if len(token) else 0, rows[:, j])
        return np.ascontiguousarray(rows).view(f"S{4 * self.window}").reshape(-1)

    def _suffixes(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix array of a shard (token: words of all texts, 0 for those that the benchmark doesn't have and after each
        text), and the keys of its suffixes."""
        rank, width = token, 1
        while width < self.window:
            ahead = np.zeros(len(rank), np.int64)
            ahead[:-width] = rank[width:] if width < len(rank) else 0
            # What no word of the benchmark follows ends there: ranks compare up to the first 0.
            code = np.where(rank > 0, rank * (int(rank.max(initial=0)) + 2) + ahead, 0)
            rank, width = np.unique(code, return_inverse=True)[1], 2 * width
            rank = rank + (code.min(initial=0) > 0)
        start = np.flatnonzero(token)
        array = start[np.argsort(rank[start], kind="stable")]
        stop = np.flatnonzero(token == 0)
        until = stop[np.searchsorted(stop, array)] if len(stop) else np.full(len(array), len(token))
        return array, self._keys(token, array, until - array)

    def search(self, texts: list[bytes]) -> list[dict]:
        """RESULT for each text."""
        w = words(texts, ALNUM, lower=True)
        if not len(self.low):
            return [{"n_words": int(n), "spans": [], "matches": []} for n in w.counts]
        at = np.minimum(np.searchsorted(self.vocabulary, w.hash), len(self.vocabulary) - 1)
        known = np.where(self.vocabulary[at] == w.hash, at + 1, 0)
        # Words of all texts with a zero after each text.
        token = np.zeros(len(known) + len(texts), np.int64)
        token[np.arange(len(known)) + w.text_of_word()] = known
        pairs = np.unique(token[:-1] * (len(self.vocabulary) + 2) + token[1:])
        asked = np.flatnonzero(np.isin(self.heads, pairs) | (self.heads < 0))
        array, keys = self._suffixes(token)
        lo, hi = np.searchsorted(keys, self.low[asked], "left"), np.searchsorted(keys, self.high[asked], "right")
        hit = np.flatnonzero(hi > lo)
        count = (hi - lo)[hit]
        key = np.repeat(asked[hit], count)
        pos = array[np.repeat(lo[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        cover = np.zeros(len(token) + 1, np.int64)
        np.add.at(cover, pos, 1)
        np.subtract.at(cover, pos + self.length[key], 1)
        covered = np.cumsum(cover)[:-1] > 0
        text_at = w.off + np.arange(len(w.off))  # where each text begins in token
        matches = self._matches(token, pos, key, text_at)
        out = []
        for i, n in enumerate(w.counts.tolist()):
            a = text_at[i]
            edge = np.flatnonzero(np.diff(np.concatenate(([0], covered[a : a + n].view(np.int8), [0])))) if i in matches else np.empty(0, int)
            out.append({"n_words": n, "spans": [{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()], "matches": matches.get(i, [])})
        return out

    def _matches(self, token: np.ndarray, pos: np.ndarray, key: np.ndarray, text_at: np.ndarray) -> dict[int, list[dict]]:
        """By text: its longest match with each item (of equal ones the first in the text, then in the item)."""
        if not len(pos):
            return {}
        rolled, out = Rolled(token), {}
        text = np.searchsorted(text_at, pos, "right") - 1
        order = np.lexsort((pos, key, text))
        pos, key, text = pos[order], key[order], text[order]
        edge = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1], [True])))
        for a, b in zip(edge.tolist(), edge[1:].tolist()):
            t = int(text[a])
            own, begin = np.unique(key[a:b], return_index=True)
            at = np.split(pos[a:b], begin[1:])  # the text's places of each of its keys
            users = [np.arange(self.of[k], self.of[k + 1]) for k in own.tolist()]
            item = np.concatenate([self.item[u] for u in users])
            of_key, place = np.repeat(np.arange(len(own)), [len(u) for u in users]), np.concatenate([self.place[u] for u in users])
            by = np.lexsort((place, item))
            item, of_key, place = item[by], of_key[by], place[by]
            cuts = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1], [True])))
            best: dict[str | None, dict] = {}
            for c, d in zip(cuts.tolist(), cuts[1:].tolist()):
                i = int(item[c])
                size = int(self.length[own[of_key[c]]])
                here = np.unique(np.concatenate([at[k] for k in np.unique(of_key[c:d]).tolist()]))
                n, p, o = self._longest(rolled, here, place[c:d], size)
                name, found = self.ids[i], (-n, p - int(text_at[t]), o - int(self.off[i]))
                old = best.get(name)
                if old is None or found < old:
                    best[name] = found
            out[t] = [{"item_id": k, "item_start": o, "doc_start": p, "length": -n} for k, (n, p, o) in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or ""))]
        return out

    def _longest(self, text: Rolled, here: np.ndarray, there: np.ndarray, size: int) -> tuple[int, int, int]:
        """Length and places of the longest common substring, from the places of windows that both have."""
        low, high = size, size if size < self.window else size + min(_run(here), _run(there)) - 1
        found = None
        length = high  # often all of it matches
        while found is None or low < high:
            extra = length - size + 1
            # A substring of this length begins where so many windows follow each other.
            starts = [x[: len(x) - extra + 1][x[extra - 1 :] - x[: len(x) - extra + 1] == extra - 1] for x in (here, there)]
            a, b = text.at(starts[0], length), self.rolled.at(starts[1], length)
            both = np.isin(a, b)
            if both.any():
                k = int(np.flatnonzero(both)[0])
                found, low = (length, int(starts[0][k]), int(starts[1][np.flatnonzero(b == a[k])[0]])), length
            elif length == size:
                raise AssertionError("windows at these places are equal")
            else:
                high = length - 1
            length = (low + high + 1) // 2
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    return [items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def _probing(shared, text_col: str):
    probe = shared.value
    return lambda batch: probe.search(texts_of(batch.column(text_col)))


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """docs' columns (those in keep) and a struct column RESULT with its name: words, hit spans, longest match by item."""
    spark, found, name = docs.sparkSession, [], ""
    blocks = _blocks(benchmark, item_col, item_text)
    keep = docs.columns if keep is None else keep
    row, again = free_name(docs, "row"), free_name(docs, "row_again")
    source = docs if len(blocks) == 1 else docs.withColumns({row: row_hash(docs), again: row_hash(docs, 1)})
    for block in blocks:
        rows = block.collect()  # at most about BLOCK_BYTES
        shared = spark.sparkContext.broadcast(Probe([r.id for r in rows], [r.text.encode() for r in rows], window))
        out, name = annotate(source, text_col, partial(_probing, shared, text_col), RESULT, "matched", keep if len(blocks) == 1 else [*keep, row, again])
        found.append(out)
    return (found[0] if len(blocks) == 1 else _merged(found, name, [row, again], keep)), name


def _merged(found: list[DataFrame], name: str, row: list[str], keep: list[str]) -> DataFrame:
    """One row for each document from those of all blocks. Equal rows are merged as one and come out as often again."""
    both = reduce(DataFrame.unionByName, found)
    words_, spans, matches, times = (free_name(both, x) for x in ("all_words", "all_spans", "all_matches", "all_times"))
    first = [F.first(F.col(f"`{c}`")).alias(c) for c in keep]
    parts = both.groupBy(*row).agg(
        *first, F.first(f"{name}.n_words").alias(words_), F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"{name}.spans")))).alias(spans),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"{name}.matches")))).alias(matches), (F.count(F.lit(1)) / len(found)).cast("int").alias(times),
    ).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    joined = F.aggregate(
        spans,
        F.array().cast("array<struct<start:long,end:long>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(x))),
    )
    return parts.select(*[F.col(f"`{c}`") for c in keep], F.struct(F.col(words_).alias("n_words"), joined.alias("spans"), F.col(matches).alias("matches")).alias(name))


def hit_words(name: str) -> F.Column:
    return F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    out, name = find_matches(docs, benchmark, window, text_col)
    return out.where(hit_words(name) == 0).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out, name = find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    items = F.array_sort(F.array_compact(F.array_distinct(F.col(f"{name}.matches.item_id"))))
    hit = hit_words(name)
    return out.select(
        "doc_id", F.col(f"{name}.n_words").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), keys AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS s FROM b WHERE len(ws) > 0)
), lengths AS (SELECT DISTINCT n FROM keys),
starts AS (
  SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS k
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM w, lengths WHERE len(ws) >= n)
), hits AS (
  SELECT doc_id, s, keys.n, item_id FROM starts JOIN keys ON starts.k = keys.k AND starts.n = keys.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS t
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
