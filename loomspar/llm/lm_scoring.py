"""Language-model scores by a weighted backoff automaton.

The model is a word trigram model with Dirichlet smoothing. Its automaton: the root, a state for each word and each pair
of words seen as a history, and one for the beginning of a text. A state's arcs are the words that followed its history,
with their smoothed probabilities; an arc leads to the state of the last two words. A failure arc, with the state's
backoff weight, leads to the state of the history without its first word, and in the end to the root, which has an arc
for every known word and one for unknown words. A text is read once from left to right: where a state has no arc for a
word, its failure arc is taken and the search goes on there; log probabilities and backoff weights add up.

Long texts are read in pieces of PIECE words, all pieces of a group in step. A piece is begun two words early from the
root, without adding: whatever came before, the state after two words is the longest history that they end.

Nothing of the model is held in one place: a group of documents builds the part of the automaton that its own texts can
reach. It asks the buckets, which hold the corpus counts by n-gram, so that a hot word's many followers are dealt out; the
answers carry the counts and the bucket's totals, which add up to those of the corpus.

Probabilities, with N training tokens (text ends included), V distinct ones, and D = n1 / (n1 + 2 n2) from how many words
were counted once and twice (0.5 where there are none):
  root: known w: (c(w) - D) / N; unknown: D V / N, or 1 if nothing was learned
  history h, without its first word h': (c(h w) + K p(w | h')) / (c(h) + K); failure arc: K / (c(h) + K), K by h's words
Every state's probabilities add up to 1 over the known words and one unknown word. Words are told apart by 64-bit hashes, longer n-grams by 56 bits.

Defined cases: a null or empty text is one end token; a null id is never held out and its crc32 is that of ''. Rows are
scored singly, so repeated rows repeat in the result. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from loomspar.llm._exchange import bucket_edges, delta, lookup, pack, undelta, unpack
from loomspar.llm._tokens import mix, words

U = np.uint64
END, START = (int(x) for x in mix(np.array([0xE0D, 0x57A], U)))
FOLDS, HELD = 5, 1
#: Weight of the shorter history against a history of one and of two words, in words.
PRIOR = (200.0, 20.0)
PIECE = 128
#: Pairs and triples are told apart by 56 bits of their hashes, words by all 64.
KEPT, SHIFT = U(2**64 - 2**8), (U(0), U(8), U(8))
_MUL = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def _numbered(hashes: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, the number of each item's, and how often each occurs among those to learn from."""
    keys, of = np.unique(hashes, return_inverse=True)
    return keys, of, np.bincount(of[learn], minlength=len(keys)).astype(np.uint32)


class Grams:
    """The n-grams of a group. Every token, ends included, ends one n-gram of each order: word, pair and triple are its
    numbers in the sorted keys. A triple that would begin before its text isn't one: -1."""

    def __init__(self, ids: list, texts: list[bytes]) -> None:
        w = words(texts, lower=True)
        self.bounds = np.concatenate(([0], np.cumsum(w.counts + 1)))
        n = int(self.bounds[-1])
        token = np.full(n, END, U)
        inside = np.ones(n, bool)
        inside[self.bounds[1:] - 1] = False
        token[inside] = w.hash
        self.first = np.zeros(n, bool)
        self.first[self.bounds[:-1]] = True
        self.train = np.array([not held_out(x) for x in ids], bool)
        learn = np.repeat(self.train, w.counts + 1)
        before = np.concatenate((token[:0], token[-1:], token[:-1]))
        before[self.first] = START
        pair = mix(before * _MUL[0] + token) & KEPT
        self.words, self.word, self.word_count = _numbered(token, learn)
        self.pairs, self.pair, self.pair_count = _numbered(pair, learn)
        third = np.flatnonzero(~self.first)
        self.triple = np.full(n, -1)
        self.triples, self.triple[third], self.triple_count = _numbered(mix(pair[third - 1] * _MUL[1] + token[third]) & KEPT, learn[third])

    @property
    def orders(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(self.words, self.word_count), (self.pairs, self.pair_count), (self.triples, self.triple_count)]


def _ask(ids: list, texts: list[bytes], buckets: int) -> list[bytes]:
    orders = Grams(ids, texts).orders
    edges = [bucket_edges(keys, buckets) for keys, _ in orders]
    return [pack(*(x for (keys, count), e, s in zip(orders, edges, SHIFT) for x in (delta(keys[e[b] : e[b + 1]] >> s), count[e[b] : e[b + 1]]))) for b in range(buckets)]


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint32) if not len(x) or x.max() < 1 << 32 else x


def _answer(blobs: list[bytes]) -> list[bytes]:
    """The corpus counts of each blob's n-grams, and the totals of the bucket's words."""
    parts = [unpack(b) for b in blobs]
    totals, answers = np.zeros(4, np.int64), [[] for _ in parts]
    for order in range(3):
        keys = [undelta(p[2 * order]) for p in parts]  # shifted, all by the same
        uniq, of = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(of, np.concatenate([p[2 * order + 1] for p in parts]), minlength=len(uniq)).astype(np.int64)
        if order == 0:
            totals = np.array([count.sum(), (count > 0).sum(), (count == 1).sum(), (count == 2).sum()], np.int64)
        at = 0
        for out, k in zip(answers, keys):
            out.append(_narrow(count[of[at : at + len(k)]]))
            at += len(k)
    return [pack(*out, totals) for out in answers]


class Automaton:
    """The states and arcs that a group's texts can reach. States: 0 is the root, 1 + i the history of word i, then that of
    a text's beginning, then those of pairs."""

    def __init__(self, g: Grams, counts: list[np.ndarray], totals: list[int]) -> None:
        word_count, pair_count, triple_count = counts
        n, v, once, twice = totals
        self.n, self.v = n, v
        discount = once / (once + 2 * twice) if once else 0.5
        n_words, known = len(g.words), word_count > 0
        begin = 1 + n_words
        root = np.where(known, (word_count - discount) / max(n, 1), discount * v / n if n else 1.0)
        # One token of each pair and triple, to see what they are made of.
        pair_at, triple_at = np.empty(len(g.pairs), np.int64), np.empty(len(g.triples), np.int64)
        pair_at[g.pair] = np.arange(len(g.pair))
        inner = np.flatnonzero(g.triple >= 0)
        triple_at[g.triple[inner]] = inner
        last = g.word[pair_at]
        ends = np.searchsorted(g.words, U(END))  # every group with a text has text ends
        texts = int(word_count[ends]) if n_words else 0  # as many texts begin as end
        history = np.where(g.first[pair_at], begin, 1 + g.word[pair_at - 1])
        seen = np.concatenate(([0], word_count, [texts]))
        p2 = (pair_count + PRIOR[0] * root[last]) / (seen[history] + PRIOR[0])
        of_pair, then = g.pair[triple_at - 1], g.pair[triple_at]
        p3 = (triple_count + PRIOR[1] * p2[then]) / (pair_count[of_pair] + PRIOR[1])

        state_of_pair = 2 + n_words + np.arange(len(g.pairs))
        self.begin = begin if texts else 0
        self.fail = np.concatenate((np.zeros(2 + n_words, np.int64), 1 + last))
        self.fail_weight = np.log10(np.concatenate(([1.0], PRIOR[0] / (seen[1:] + PRIOR[0]), PRIOR[1] / (pair_count + PRIOR[1]))))
        self.root_weight, self.root_to = np.log10(root), np.where(known, 1 + np.arange(n_words), 0)
        self.width = n_words
        two, three = np.flatnonzero(pair_count > 0), np.flatnonzero(triple_count > 0)
        key = np.concatenate((history[two] * self.width + last[two], state_of_pair[of_pair[three]] * self.width + g.word[triple_at[three]]))
        order = np.argsort(key)
        self.arc = key[order]
        self.weight = np.log10(np.concatenate((p2[two], p3[three])))[order]
        self.to = np.concatenate((state_of_pair[two], state_of_pair[then[three]]))[order]

    def read(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a word, one for each text, and the log10 probabilities."""
        score, to = np.zeros(len(state)), np.zeros(len(state), np.int64)
        live = np.arange(len(state))
        while len(live):
            at_root = state[live] == 0
            done = live[at_root]
            score[done] += self.root_weight[word[done]]
            to[done] = self.root_to[word[done]]
            live = live[~at_root]
            if not len(live):
                break
            key = state[live] * self.width + word[live]
            at = np.minimum(np.searchsorted(self.arc, key), max(len(self.arc) - 1, 0))
            hit = self.arc[at] == key if len(self.arc) else np.zeros(len(live), bool)
            found = live[hit]
            score[found] += self.weight[at[hit]]
            to[found] = self.to[at[hit]]
            live = live[~hit]
            score[live] += self.fail_weight[state[live]]
            state[live] = self.fail[state[live]]
        return to, score

    def scores(self, g: Grams) -> np.ndarray:
        """log10 probability of every token."""
        out = np.empty(len(g.word))
        size = np.diff(g.bounds)
        n_pieces = -(-size // PIECE)
        start = np.repeat(g.bounds[:-1], n_pieces)
        low = start + PIECE * (np.arange(len(start)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces))
        high = np.minimum(low + PIECE, np.repeat(g.bounds[1:], n_pieces))
        at = np.where(low > start, low - 2, low)
        order = np.argsort(at - high, kind="stable")  # the longest first
        low, high, at = low[order], high[order], at[order]
        state = np.where(at < low, 0, self.begin)
        while len(at):
            state, score = self.read(state, g.word[at])
            mine = at >= low
            out[at[mine]] = score[mine]
            at = at + 1
            live = int(np.searchsorted(at - high, 0, "left")) if (at < high).any() else 0
            low, high, at, state = low[:live], high[:live], at[:live], state[:live]
        return out


def _apply(ids: list, texts: list[bytes], answers: list[bytes]) -> pa.Table:
    g = Grams(ids, texts)
    got = [unpack(a) for a in answers]
    counts = [np.concatenate([x[i].astype(np.int64) for x in got]) for i in range(3)]
    model = Automaton(g, counts, np.sum([x[3].view(np.int64) for x in got], axis=0).tolist())
    known = counts[0][g.word]
    base = np.log10((known + 0.5) / (model.n + 0.5 * (model.v + 1)))
    first = g.bounds[:-1]
    total = lambda x: np.add.reduceat(x, first) if len(first) else x
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(~g.train), "n_tokens": pa.array(np.diff(g.bounds)), "n_known": pa.array(total((known > 0).astype(np.int64))),
        "train_tokens": pa.array(np.full(len(ids), model.n, np.int64)), "base_score": pa.array(total(base)), "score": pa.array(total(model.scores(g))),
    })


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by the model of those that aren't held out."""
    return lookup(docs, id_col, text_col, _ask, _answer, _apply, SCHEMA, apart=True)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
