"""Token counts by fields and sections, attributed through token offsets.

Each document is rendered once from its fields (one line break between them) and encoded as a whole. The tokens' byte
spans come from the lengths of their byte strings, as a byte-level encoding keeps every byte. Spans are joined to the
fields and sections by bisection over their boundaries. Fields and sections each cover the whole rendering: the line
break after a field belongs to that field, the line break that ends a section to that section.

Rule for tokens that cross a boundary: the section with the token's first byte gets it ("start"), or that with its last
byte ("end"), or that with most of its bytes ("most"; of equal shares the first). No token is lost or counted twice, so
the counts of fields, and of sections, each add up to the document's count.

Defined cases: a null field is empty, and keeps its place and line break; a section is a line, so an empty text has one
empty section; texts of any length are encoded whole; repeated rows count apiece; other columns may stay (keep). Runs of
white space of RUN characters or more, which the pattern's engine can't take, are cut out where the pattern cuts anyway:
all of a run but its last character, or the whole run at the end of the text, is one piece to be merged.
"""

from __future__ import annotations

import base64
import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._rows import annotate
from loomspar.llm._tokens import texts_of

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How texts are cut before merging; belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RUN = 1024
#: The characters that the pattern takes as \s (Unicode's White_Space).
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RUNS = re.compile(f"{_SPACE}{{{RUN},}}")
MAX_VOCABULARY_BYTES = 32 << 20
RULES = ("start", "end", "most")
RESULT = "struct<n_tokens:long,field_tokens:array<long>,n_sections:long,section_tokens:array<long>,n_crossing:long>"


def read_vocabulary(path: str) -> bytes:
    """The ranks file, read by the driver and sent to the executors; its size is checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


class Encoder:
    def __init__(self, ranks_file: bytes, pattern: str = PATTERN) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._cut_and_merge, self._merge = encoding.encode_ordinary, encoding._encode_single_piece

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for m in _RUNS.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            out += self._cut_and_merge(text[at : m.start()])
            out += self._merge(text[m.start() : end].encode())
            at = end
        return out + self._cut_and_merge(text[at:]) if at else self._cut_and_merge(text)

    def ends(self, text: bytes) -> np.ndarray:
        """Byte offset after each token."""
        return np.cumsum(self.length[np.array(self.encode(text.decode()), np.int64)])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> tuple[np.ndarray, int]:
    """Tokens of each section (bounds: where each begins, and the end), and how many tokens cross a boundary."""
    if rule not in RULES:
        raise ValueError(rule)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    inner = bounds[1:-1]
    first, last = np.searchsorted(inner, starts, "right"), np.searchsorted(inner, ends - 1, "right")
    owner = last if rule == "end" else first
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        owner = owner.copy()
        for i in crossing.tolist():
            own = np.arange(first[i], last[i] + 1)
            share = np.minimum(ends[i], bounds[own + 1]) - np.maximum(starts[i], bounds[own])
            owner[i] = own[share.argmax()]
    return np.bincount(owner, minlength=len(bounds) - 1), len(crossing)


def _counting(shared, fields: list[str], rule: str):
    encoder = Encoder(shared.value)

    def count(batch: pa.RecordBatch) -> list[dict]:
        out = []
        for parts in zip(*(texts_of(batch.column(f)) for f in fields)):
            whole = b"\n".join(parts)
            ends = encoder.ends(whole)
            sizes = np.array([len(p) + 1 for p in parts])
            fields_at = np.concatenate(([0], np.cumsum(sizes)))
            fields_at[-1] = len(whole)
            breaks = np.flatnonzero(np.frombuffer(whole, np.uint8) == 10) + 1
            lines_at = np.concatenate(([0], breaks, [len(whole)]))
            by_field, _ = attribute(ends, fields_at, rule)
            by_line, crossing = attribute(ends, lines_at, rule)
            out.append({"n_tokens": len(ends), "field_tokens": by_field.tolist(), "n_sections": len(by_line), "section_tokens": by_line.tolist(), "n_crossing": crossing})
        return out

    return count


def count_tokens(docs: DataFrame, fields: list[str], vocabulary: str = VOCABULARY, rule: str = "start", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """docs' columns (those in keep) and a struct column RESULT with its name. The fields are strings, in this order."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return annotate(docs, fields[-1], partial(_counting, shared, list(fields), rule), RESULT, "tokens", keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["source", "lang", "text"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", *fields)
    out, name = count_tokens(docs, fields, keep=["doc_id"])
    by = [F.col(f"{name}.field_tokens")[i].alias(f"{f}_tokens") for i, f in enumerate(fields)]
    return out.select("doc_id", F.col(f"{name}.n_tokens").alias("n_tokens"), *by, F.col(f"{name}.n_sections").alias("n_sections"), F.col(f"{name}.n_crossing").alias("n_crossing"), F.col(f"{name}.section_tokens").alias("section_tokens"))
