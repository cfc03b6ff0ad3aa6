"""Quality rules: base measures of a text, and a verdict by labelling its lines as content or boilerplate.

A linear-chain conditional random field over the lines that hold a word is decoded by Viterbi; a text is kept if at
least MIN_SHARE of its words stand in content lines.

The field is fitted on the lines of at most SAMPLE labelled documents of either quality: those with the smallest hashes of
their ids, one row an id, of texts up to SAMPLE_BYTES, which bounds what the driver gathers. Documents have labels, lines
don't: a bad document may hold good lines, and a good one a menu. So lines are labelled in two steps. A model of single
lines is fitted on their documents' labels and labels each line by itself; where the lines then contradict the document
(content in less than MIN_SHARE of a good one's words, or in as much of a bad one's), all take the document's label. The
field, with its changes between lines, is fitted on these. Training is the only place with a bound; measures and labels
cover every line of every text.

Defined cases: a null, empty or blank text has no words and fails the base rule; an unknown label, or labels of one
class only, leave all lines content; repeated rows are judged singly; other columns of the documents stay as they are.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._crf import Chain, train
from loomspar.llm._rows import annotate
from loomspar.llm._tokens import U, mix, texts_of, windows, words

MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
MIN_SHARE = 0.5
SAMPLE, SAMPLE_BYTES = 1500, 32 << 10
FIT_TEXTS = 50
BOILERPLATE, CONTENT = 0, 1
RESULT = "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,base_failed:boolean,content_words:long,kept:boolean>"


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_SYMBOL = _class(b"#*$%&|<>")
_CLASSES = [_SYMBOL, _class(b"|"), _class(bytes(range(0x41, 0x5B))), _class(b"0123456789"), _class(b".!?"), _class(b",;:"), _class(b"{}[]()=/\\_@\"'")]
_INSIDE = (np.arange(256) & 0xC0) == 0x80  # bytes that continue a character


class Lines:
    """Measures of texts, and features of their lines that hold a word."""

    def __init__(self, texts: list[bytes]) -> None:
        w = words(texts)
        self.words = w
        data = np.frombuffer(w.buf, np.uint8)
        n = len(w.hash)
        inside = np.concatenate(([0], np.cumsum(_INSIDE[data])))
        chars = (w.end - w.start) - (inside[w.end] - inside[w.start])
        per_text = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[w.off])
        self.n_words, self.word_chars = w.counts, per_text(chars)

        at, keys = windows(w.hash, w.off, REPEAT_WINDOW)
        text = w.text_of_word()
        cover = np.zeros(n + 1, np.int64)
        if len(at):
            keys = mix(keys + text[at].astype(U) * U(0x9E3779B97F4A7C15))
            _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
            again = at[count[inverse] > 1]
            cover[again] += 1
            cover[again + REPEAT_WINDOW] -= 1
        repeated = np.cumsum(cover)[:-1] > 0
        self.n_repeat_words = per_text(repeated)

        end = np.flatnonzero(data == 10)
        begin = np.concatenate(([0], end[:-1] + 1))
        word_at = np.searchsorted(w.start, np.append(begin, len(data)))
        full = np.flatnonzero(np.diff(word_at))
        owner = np.searchsorted(w.text_start, begin[full], "right") - 1
        self.off = np.searchsorted(owner, np.arange(len(texts) + 1))
        dup = np.zeros(len(full), bool)
        seen: set[bytes] = set()
        last = -1
        for i, (a, b, t) in enumerate(zip(begin[full].tolist(), end[full].tolist(), owner.tolist())):
            if t != last:
                seen, last = set(), t
            line = w.buf[a:b]
            dup[i] = line in seen
            seen.add(line)
        self.n_dup_lines = np.diff(np.concatenate(([0], np.cumsum(dup)))[self.off])

        first, stop = word_at[full], word_at[full + 1]
        self.line_words = stop - first
        sums = []
        total_symbols = None
        for table in _CLASSES:
            run = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
            if table is _SYMBOL:
                total_symbols = run[w.text_start[1:]] - run[w.text_start[:-1]]
            sums.append(run[end[full]] - run[begin[full]])
        self.n_symbols = total_symbols
        line_of_word = np.repeat(np.arange(len(full)), self.line_words)
        key = mix(w.hash + line_of_word.astype(U) * U(0xC2B2AE3D27D4EB4F))
        _, where = np.unique(key, return_index=True)
        distinct = np.bincount(line_of_word[where], minlength=len(full))
        size = np.maximum(self.line_words, 1)
        length = np.maximum(np.add.reduceat(chars, first) if len(full) else np.empty(0), 1)
        tail = data[w.end[stop - 1] - 1] if len(full) else np.empty(0, np.uint8)
        run = np.concatenate(([0], np.cumsum(repeated)))
        self.features = np.column_stack([
            np.log1p(self.line_words), length / size, *[s / length for s in sums], *[np.minimum(s / size, 2) for s in sums[:4]],
            _CLASSES[4][tail], dup, (run[stop] - run[first]) / size, distinct / size, self.line_words <= 3, self.line_words <= 8,
        ]).astype(np.float64)


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = Lines(texts)
    return x.features, x.off, x.line_words


def _shares(content: np.ndarray, n_words: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Share of each text's words in content lines; 0 without words."""
    part = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[off])
    return part(content * n_words) / np.maximum(part(n_words), 1)


def line_labels(x: np.ndarray, off: np.ndarray, n_words: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Labels of the lines of labelled texts."""
    size = np.diff(off)
    whole = np.repeat(np.where(good, CONTENT, BOILERPLATE), size)
    single = train(x, np.arange(len(x) + 1), whole, 2)
    label = single.scores(x).argmax(1)
    agrees = (_shares(label == CONTENT, n_words, off) >= MIN_SHARE) == good
    return np.where(np.repeat(agrees, size), label, whole)


def fit(texts: list[bytes], good: list[bool]) -> Chain | None:
    """The field from whole labelled texts; None without lines of both labels."""
    if len(set(good)) < 2:
        return None
    parts = [_features(texts[i : i + FIT_TEXTS]) for i in range(0, len(texts), FIT_TEXTS)]  # each needs some 100 times its bytes
    size = np.concatenate([np.diff(off) for _, off, _ in parts])
    if not all(size[np.array(good) == g].any() for g in (True, False)):
        return None
    x, n_words = np.concatenate([x for x, _, _ in parts]), np.concatenate([n for _, _, n in parts])
    off = np.concatenate(([0], np.cumsum(size)))
    return train(x, off, line_labels(x, off, n_words, np.array(good)), 2)


def judge(chain: Chain | None, texts: list[bytes]) -> list[dict]:
    x = Lines(texts)
    content = x.line_words if chain is None else x.line_words * (chain.decode(x.features, x.off) == CONTENT)
    content = np.diff(np.concatenate(([0], np.cumsum(content)))[x.off])
    failed = (x.n_words < MIN_WORDS) | (100 * x.n_repeat_words > MAX_REPEAT_PERCENT * x.n_words)
    kept = ~failed & (content >= MIN_SHARE * x.n_words)
    names = RESULT[7:-1].split(",")
    cols = [x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, failed, content, kept]
    return [dict(zip((n.split(":")[0] for n in names), row)) for row in zip(*(c.tolist() for c in cols))]


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> tuple[list[bytes], list[bool]]:
    """Texts and labels of at most `limit` documents of either quality."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    picked = known.where("quality = 0").orderBy(order).limit(limit).unionByName(known.where("quality = 1").orderBy(order).limit(limit))
    quality = {r.doc_id: r.quality for r in picked.collect()}
    if not quality:
        return [], []
    ids = docs.sparkSession.createDataFrame([(i,) for i in quality], "sample_id long")
    texts = docs.select("doc_id", "text").where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    known = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id"), "left_semi")
    rows = known.groupBy("doc_id").agg(F.min("text").alias("text")).collect()  # 2 * limit rows of SAMPLE_BYTES at most
    rows.sort(key=lambda r: r.doc_id)
    return [(r.text or "").encode() for r in rows], [quality[r.doc_id] == 1 for r in rows]


def _judging(shared, text_col: str):
    return lambda batch: judge(shared.value, texts_of(batch.column(text_col)))


def measure(docs: DataFrame, labels: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """docs' columns (those in keep) and a struct column RESULT with its name."""
    chain = fit(*labelled_sample(docs, labels))
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    return annotate(docs, text_col, partial(_judging, shared, text_col), RESULT, "quality_rules", keep)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out, name = measure(docs, labels)
    return out.where(f"{name}.kept").drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out, name = measure(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=["doc_id"])
    return out.select("doc_id", *[f"{name}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words")])
