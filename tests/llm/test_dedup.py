"""Substring deduplication and the n-gram join against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspar.llm import _tokens, ngram_join, substring_dedup
from loomspar.llm.ngram_join import Rule

DOCS = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def some_docs(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(60)]
    base = [[r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 19, 20, 21, 40, 90]))] for _ in range(n // 3)]
    out = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 0, 1, 2, 6])):
            if w:
                w[r.randrange(len(w))] = r.choice(vocabulary)
        if r.random() < 0.3:
            w += r.choice(base)
        out.append((r.choice([i, i * 1000 + 7, -i]), r.choice([" ", "\n", "  \t"]).join(w)))
    return out


SPECIAL = [(9001, None), (9002, ""), (9003, " \n "), (9004, "x"), (9005, "X"), (9006, "\x1ca b c"), (9007, "one two three"), (9007, "one two three"), (None, "one two three four five"), (None, None), (9008, "a b c d " * 300)]


def brute_repeats(docs, k=20):
    """By row in the order of ids (null last), then texts."""
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, (d[1] or "").encode()))
    seen, out = set(), []
    for doc, text in order:
        w = words(text)
        gone = set()
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            if key in seen:
                gone.update(range(i, i + k))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("seed", "group"), [(1, 2048), (2, 7), (3, 1)])
def test_substring_dedup(spark, monkeypatch, seed, group):
    monkeypatch.setattr("loomspar.llm._exchange.groups_of_bytes", lambda n: max(1, -(-70 // group)))
    docs = some_docs(seed) + SPECIAL
    random.Random(seed).shuffle(docs)
    df = spark.createDataFrame(docs, DOCS).withColumn("N_words", F.lit("clash"))
    got = substring_dedup.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_repeats(docs), key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert ngram_join.group(empty).count() == 0


def brute_groups(docs, rule):
    sets = []
    for _, text in docs:
        w = words(low(text))
        sets.append({tuple(w[i : i + rule.words]) for i in range(len(w) - rule.words + 1)} if len(w) >= rule.words else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i), doc)) for i, (doc, _) in enumerate(docs)]


@pytest.mark.parametrize(("seed", "rule"), [(4, Rule()), (5, Rule(5, 80, 100)), (6, Rule(1, 50, 100)), (7, Rule(2, 20, 100)), (8, Rule(1, 35, 100)), (9, Rule(3, 95, 100))])
def test_ngram_join(spark, monkeypatch, seed, rule):
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    docs = [d for d in some_docs(seed, 90)] + SPECIAL
    got = ngram_join.group(spark.createDataFrame(docs, DOCS), rule).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_groups(docs, rule), key=str)


def test_ngram_join_cut_into_strips(spark, monkeypatch):
    """The same components when groups are cut, frequent shingles gridded, ids joined and bits shared."""
    docs = some_docs(8, 90)
    expected = sorted(brute_groups(docs, Rule()), key=str)
    for name, value in (("STRIP", 3), ("TOLD_IDS", 0), ("BITMAP_BYTES", 0), ("FREQUENT_FROM", 2), ("REPORT_FROM", 1), ("HELD", 40), ("HELD_SLICES", 1), ("SLICE_BYTES", 2000), ("PIVOTS", 1), ("TOLD_GROUPS", 0), ("BUCKET_ENTRIES", 100), ("BLOCK_ROWS", 2), ("BLOCK_PIECE", 2), ("PAIRS", 5), ("BUCKET_GROUPS", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    assert sorted(map(tuple, ngram_join.group(spark.createDataFrame(docs, DOCS)).collect()), key=str) == expected


def test_components_stop_at_stars(spark, monkeypatch):
    """Components of chains, rings and random links; links that are stars already take no round, so the driver runs no jobs for it."""
    rounds, cut = [], ngram_join.cut
    monkeypatch.setattr(ngram_join, "cut", lambda df: rounds.append(1) or cut(df))
    r = random.Random(5)
    links = [(i, i + 1) for i in range(20)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(300, 301), (302, 301), (300, 301)]
    root = {x: x for e in links for x in e}
    for a, b in links:
        least, most = sorted((root[a], root[b]))
        root = {x: least if y == most else y for x, y in root.items()}
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    found = ngram_join.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, y) for x, y in root.items() if x not in loops) and len(rounds) > 1
    for stars in ([(1, 2), (1, 7), (4, 9)], []):
        rounds.clear()
        found = ngram_join.components(spark.createDataFrame(stars, "a long, b long")).collect()
        assert sorted(map(tuple, found)) == sorted({(x, a) for a, b in stars for x in (a, b)}) and len(rounds) == 1


def test_hub_of_near_copies(spark):
    r = random.Random(3)
    base = [f"v{i}" for i in range(120)]
    docs = []
    for i in range(60):
        w = list(base)
        for p in r.sample(range(120), 2 if i else 0):
            w[p] = f"e{i}_{p}"
        docs.append((i, " ".join(w)))
    got = ngram_join.group(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(docs, Rule()))


def test_links_between_sets_of_unlike_sizes(spark):
    """Bitmaps of all widths meet: at low thresholds a set links with one several times its size."""
    w = [f"q{i}" for i in range(400)]
    docs = [(1, " ".join(w[:40])), (2, " ".join(w[:135])), (3, " ".join(w[:340])), (4, " ".join(w[300:])), (5, " ".join(w[390:] + ["z"] * 3))]
    for rule in (Rule(4, 25, 100), Rule(4, 28, 100), Rule(4, 10, 100), Rule(4, 5, 100)):
        got = ngram_join.group(spark.createDataFrame(docs, DOCS), rule).collect()
        assert sorted(map(tuple, got)) == sorted(brute_groups(docs, rule))


def brute_kept(docs, rule):
    """Rows that stay: of a group its least row, and all rows without words."""
    groups = brute_groups([(i, t) for i, (_, t) in enumerate(docs)], rule)
    blank = [d for d in docs if not words(d[1])]
    return blank, {g for i, n, g in groups if n}


@pytest.mark.parametrize(("seed", "strip"), [(11, 2048), (12, 3)])
def test_keep_one(spark, monkeypatch, seed, strip):
    monkeypatch.setattr(ngram_join, "STRIP", strip)
    rule, r = Rule(5, 80, 100), random.Random(seed)
    docs = [(r.choice([1, 1, 2, 3, None, i]), t) for i, (_, t) in enumerate(some_docs(seed, 80))] + SPECIAL
    df = spark.createDataFrame(docs, DOCS).withColumns({"row_h": F.lit(0), "tags": F.create_map(F.lit("k"), F.col("text"))})
    got = ngram_join.keep_one(df, rule)
    rows = [(x.doc_id, x.text) for x in got.collect()]
    where = {}
    for i, g, in enumerate(g for _, _, g in brute_groups([(i, t) for i, (_, t) in enumerate(docs)], rule)):
        where.setdefault(docs[i], set()).add(g)
    blank, groups = brute_kept(docs, rule)
    full = [x for x in rows if words(x[1])]
    assert got.columns == df.columns and sorted(map(str, blank)) == sorted(str(x) for x in rows if not words(x[1]))
    assert sorted(g for x in full for g in where[x]) == sorted(groups)  # one row of each group
    least = {}
    for d in docs:
        for g in where[d] & groups:
            least[g] = min(least.get(g, (True, 0)), (d[0] is None, d[0] or 0))
    assert all((x[0] is None, x[0] or 0) == least[g] for x in full for g in where[x])


def test_keep_one_keeps_unlinked_rows_of_one_id(spark):
    r = random.Random(2)
    docs = [(7, " ".join(f"x{r.randrange(10**6)}" for _ in range(30))) for _ in range(200)]
    got = ngram_join.keep_one(spark.createDataFrame(docs + docs[:50], DOCS), Rule(5, 80, 100)).collect()
    assert sorted(map(tuple, got)) == sorted(docs)


def test_candidates_lose_no_link():
    rule, r = Rule(1, 60, 100), np.random.default_rng(1)
    each = [np.unique(r.integers(0, 40, r.integers(1, 30)).astype(np.uint64)) for _ in range(50)]
    size = np.array([len(e) for e in each])
    order = np.argsort(size, kind="stable")
    each, size = [each[i] for i in order], size[order]
    true = {(i, j) for i in range(50) for j in range(i + 1, 50) if rule.links(len(np.intersect1d(each[i], each[j])), size[i], size[j])}
    maps, spare, exact = ngram_join._bitmaps(each)
    tree = ngram_join.Tree(maps, size, spare)
    got = {(int(a), int(b)) for i, j in ngram_join.traverse(rule, tree, tree, lambda i, j: np.ones(len(i), bool)) for a, b in zip(i, j)}
    assert exact and got == true


def test_words_and_windows():
    texts = ["A b c  d", "", "x" * 10, "é ß \t1"]
    w = _tokens.words([t.encode() for t in texts])
    assert [w.buf[s:e].decode() for s, e in zip(w.start, w.end)] == [x for t in texts for x in words(t)]
    assert w.counts.tolist() == [3, 0, 1, 3]
    same = _tokens.words([b"q r q r"]).hash
    assert same[0] == same[2] and same[1] == same[3] and same[0] != same[1]
    at, keys = _tokens.windows(same, np.array([0, 4]), 2)
    assert at.tolist() == [0, 1, 2] and keys[0] == keys[2] != keys[1]
    long = _tokens.words([b"k" * (3 << 20) + b" z", b"z"])
    assert long.counts.tolist() == [2, 1] and long.hash[1] == long.hash[2]
    assert _tokens.texts_of(pa.array(["a", None])) == [b"a", b""]
