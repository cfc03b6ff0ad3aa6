"""Mixing, sharding, scoring and the pipeline: invariants and brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomspar.llm import lm_scoring, mixing, sharding

DOCS = "doc_id long, text string, source string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed=1, n=300):
    r = random.Random(seed)
    out = []
    for i in range(n):
        source = r.choice(["hot"] * 4 + ["b", "Z", "é", None])
        out.append((i, " ".join(f"w{r.randrange(50)}" for _ in range(r.choice([0, 1, 5, 60, 400]))), source))
    return out + [(2007, "x y", "b"), (2007, "x y", "b"), (None, "a b c", None), (1000, None, "b"), (1001, "", "empty"), (1002, "tiny", "small")]


def reshared(sizes):
    """Targets by resharing until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped, left = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / total for s in names}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        for s in over:
            capped.add(s)
            left -= 3 * sizes[s]


def test_plan_of_the_mix_has_no_draws(spark):
    """The driver plans the last joins alone, not again with all the steps of the draws after each exchange."""
    docs = spark.createDataFrame([(i, f"a b c {i}", str(i % 3)) for i in range(30)], "doc_id long, text string, source string")
    assert "RepartitionByExpression" not in mixing.taken_words(docs)._jdf.queryExecution().optimizedPlan().toString()


def test_mixing(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS).withColumn("size", F.lit(1)).withColumn("rank", F.lit(2))
    got = mixing.taken_words(df).collect()
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(words(t))
    target = reshared(sizes)
    source = {i: s for i, _, s in docs}
    assert sorted((r.id, r.size) for r in got if r.id is not None) == sorted((i, len(words(t))) for i, t, _ in docs if i is not None) and len(got) == len(docs)
    by = defaultdict(int)
    for r in got:
        s = source[r.id]
        assert r.source_size == sizes[s] and math.isclose(r.target, target[s], rel_tol=1e-9, abs_tol=1e-9) and 0 <= r.taken <= 3 * r.size
        by[s] += r.taken
    for s, t in target.items():
        assert abs(by[s] - t) <= 2 * mixing.BLOCK + 0.05 * t
    again = mixing.taken_words(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_slots_and_documents(spark):
    docs = corpus(2)
    df = spark.createDataFrame(docs, DOCS).withColumn("n_chars", F.lit(0).cast("long"))
    spans = mixing.mixed_spans(df).collect()
    df = df.withColumn("tags", F.create_map(F.lit("k"), F.col("text")))
    taken = {(r.id, r.size): r.taken for r in mixing.taken_words(df).collect() if r.id not in (2007, None)}
    sums = Counter()
    for r in spans:
        sums[r.id] += r.end - r.start
    assert all(sums[i] == n for (i, _), n in taken.items())
    slots = Counter((r.shard, r.slot) for r in spans)
    assert len({(r.shard, r.slot): r.block for r in spans}) == len(slots)
    made = mixing.mixed_documents(df)
    n = Counter()
    text = {i: t for i, t, _ in docs if i is not None}
    for r in made.collect():
        n[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text) and (r.doc_id is None or set(words(r.text)) <= set(words(text[r.doc_id])))
    assert made.columns == df.columns and all(n[i] == k for (i, _), k in taken.items())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 100, 640, 1000, 4097, 65537])
def test_permutation_is_a_bijection(spark, n):
    for key in (1, 2):
        got = [r.p for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit("k"), F.lit(key)).alias("p"), "id").orderBy("id").collect()]
        assert sorted(got) == list(range(n))
        if n >= 640:
            steps = Counter((b - a) % n for a, b in zip(got, got[1:]))
            assert max(steps.values()) <= 12 and sum(a == b for a, b in enumerate(got)) <= 12  # no steady step, few fixed places
            # Pairs of neighbours fall into 4 x 4 cells evenly: chi-square with 15 degrees of freedom, 0.1 % at 37.7.
            cells = Counter((a * 4 // n, b * 4 // n) for a, b in zip(got, got[1:]))
            assert sum((cells[i, j] - (n - 1) / 16) ** 2 / ((n - 1) / 16) for i in range(4) for j in range(4)) < 37.7


SOURCES = "rank int, source string, source_size long, target double, n_blocks long"


def test_uses_of_blocks(spark):
    sources = spark.createDataFrame([(1, "a", 1000 * 64, 3000.0 * 64, 1000), (2, "b", 640, 320.0, 10), (3, "c", 500 * 64, 400.0 * 64, 500)], SOURCES)
    uses = Counter((r.rank, r.block) for r in mixing.draws(sources).collect())
    assert all(uses[1, b] == 3 for b in range(1000)) and max(uses[2, b] for b in range(10)) == 1 and sum(uses[2, b] for b in range(10)) == 5
    assert max(uses[3, b] for b in range(500)) == 1 and sum(uses[3, b] for b in range(500)) == 400


def test_counts_of_shards_are_multinomial(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 1000)
    monkeypatch.setattr(mixing, "TOLD_SOURCES", 0)
    blocks = [40000, 30000, 29900, 100]
    sources = spark.createDataFrame([(i + 1, str(i), n * 64, n * 64.0, n) for i, n in enumerate(blocks)], SOURCES)
    chi = lambda counts: sum((counts.get((s, i + 1), 0) - n / 100) ** 2 / (n / 100) for s in range(100) for i, n in enumerate(blocks))
    drawn, final = 0.0, 0.0
    for seed in range(17, 22):
        monkeypatch.setattr(mixing, "SEED", seed)
        drawn += chi({(r.shard, r["rank"]): r.n for r in mixing.counts(sources)[0].collect()})
        rows = mixing.draws(sources).collect()
        final += chi(Counter((r.shard, r["rank"]) for r in rows))
        assert Counter(r["rank"] for r in rows) == {i + 1: n for i, n in enumerate(blocks)} and len({(r.shard, r.slot) for r in rows}) == len(rows) == 100000
        assert len({(r["rank"], r.block) for r in rows}) == 100000
    assert 1337 < drawn < 1676 and 1337 < final < 1676  # 1,500 degrees of freedom, 0.1 % on either side


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.taken_words(empty).count() == 0 and sharding.assign(empty)[0].count() == 0 and lm_scoring.score_texts(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], DOCS)
    assert [r.taken for r in mixing.taken_words(blank).collect()] == [0, 0]


def check_shards(rows, n_shards, near):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    total = sum(r.size for r in rows)
    for s in range(n_shards):
        assert abs(sum(r.size for r in by[s]) - total / n_shards) <= near * total / n_shards
    return by


@pytest.mark.parametrize(("n_shards", "part"), [(8, 64 << 20), (3, 20000), (1, 40000)])
def test_sharding(spark, monkeypatch, n_shards, part):
    monkeypatch.setattr(sharding, "PART_BYTES", part)
    docs = corpus(3, 900)
    df = spark.createDataFrame(docs, DOCS).withColumns({"shard": F.lit("clash"), "H": F.lit(1), "tags": F.create_map(F.lit("k"), F.col("text"))})
    out, c = sharding.assign(df, n_shards)
    got = out.withColumn("at", F.monotonically_increasing_id()).select("doc_id", "text", F.col(c["size"]).alias("size"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot"), F.col(c["text_crc32"]).alias("crc"), "at")
    rows = got.collect()
    assert len(rows) == len(docs) and set(df.columns) <= set(out.columns)
    for r in rows:
        raw = (r.text or "").encode()
        assert r.size == len(raw) + 1 and r.crc == zlib.crc32(raw)
    check_shards(rows, n_shards, 0.03)
    shards = defaultdict(set)
    for r in rows:
        shards[r.crc].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert [(r.shard, r.slot) for r in sorted(rows, key=lambda r: r.at)] == sorted((r.shard, r.slot) for r in rows)  # exchanged into order


@pytest.mark.parametrize("part", [64 << 20, 1000])
def test_a_text_too_large_for_a_shard_is_split(spark, monkeypatch, part):
    monkeypatch.setattr(sharding, "PART_BYTES", part)
    docs = [(i, "same text again", "a") for i in range(600)] + [(1000 + i, f"text number {i}", "a") for i in range(200)]
    out, c = sharding.assign(spark.createDataFrame(docs, DOCS))
    rows = out.select("text", F.col(c["size"]).alias("size"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot")).collect()
    check_shards(rows, 8, 0.05)


def test_texts_that_fit_a_shard_stay_whole(spark):
    """Copies that weigh most of a shard: whole, and the shards still even."""
    docs = [(1000 * g + i, f"copies of the text {g}", "a") for g, n in enumerate([90, 80, 70, 40, 40, 30, 5, 3]) for i in range(n)] + [(9000 + i, f"a text of its own {i}", "a") for i in range(400)]
    out, c = sharding.assign(spark.createDataFrame(docs, DOCS))
    rows = out.select("text", F.col(c["size"]).alias("size"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot")).collect()
    check_shards(rows, 8, 0.03)
    assert all(len({r.shard for r in rows if r.text == t}) == 1 for t in {r.text for r in rows})


def test_many_shards(spark):
    out, c = sharding.assign(spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")), 1000)
    rows = out.select(F.col(c["size"]).alias("size"), F.col(c["shard"]).alias("shard"), F.col(c["slot"]).alias("slot")).collect()
    check_shards(rows, 1000, 0.6)  # a shard has four rows


def test_splitters_are_exact_enough(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"), F.xxhash64(F.lit(1), "id").alias("d"), (F.col("id") % 7 + 1).alias("w"))
    total = keys.agg(F.sum("w")).first()[0]
    first = [0, *sharding.splitters(keys, [total * i / 5 for i in range(1, 5)], 0.005 * total / 5)]
    rows = keys.select("w", sharding.place_of(F.col("h"), F.col("d"), first).alias("s")).groupBy("s").agg(F.sum("w").alias("w")).collect()
    assert first == sorted(first) and sorted(r.s for r in rows) == list(range(5)) and all(abs(r.w - total / 5) <= 0.02 * total / 5 for r in rows)


# Scoring.


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


class Trigrams:
    """The model by its definition."""

    def __init__(self, docs):
        self.tokens = [(i, [*words(low(t)), "</s>"]) for i, t in docs]
        self.held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        self.c = Counter()
        for i, ts in self.tokens:
            if not self.held(i):
                seq = ["<s>", *ts]
                self.c.update((w,) for w in ts)
                self.c.update(zip(seq, seq[1:]))
                self.c.update(zip(seq, seq[1:], seq[2:]))
                self.c["<s>",] += 1
        self.words = {k[0] for k in self.c if len(k) == 1} - {"<s>"}
        self.n, self.v = sum(self.c[w,] for w in self.words), len(self.words)
        a, b = (sum(self.c[w,] == x for w in self.words) for x in (1, 2))
        self.d = a / (a + 2 * b) if a else 0.5

    def prob(self, h, w):
        if not h:
            return (self.c[w,] - self.d) / self.n if w in self.words else self.d * self.v / self.n
        k = lm_scoring.PRIOR[len(h) - 1]
        return (self.c[(*h, w)] + k * self.prob(h[1:], w)) / (self.c[h] + k)

    def score(self, ts):
        seq = ["<s>", *ts]
        return sum(math.log10(self.prob(tuple(seq[max(0, i - 2) : i]), seq[i])) for i in range(1, len(seq)))


@pytest.mark.parametrize(("seed", "piece", "groups"), [(5, 128, 3), (6, 1, 1), (7, 2, 5), (8, 3, 2)])
def test_base_scores_and_probabilities(spark, monkeypatch, seed, piece, groups):
    monkeypatch.setattr("loomspar.llm._exchange.groups_of_bytes", lambda n: groups)
    monkeypatch.setattr(lm_scoring, "PIECE", piece)
    docs = [(i, t) for i, t, _ in corpus(seed, 60)] + [(5, "W1 w2\n w3"), (5, "W1 w2\n w3"), (None, "q"), (None, None)]
    got = lm_scoring.score_texts(spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1))).collect()
    m = Trigrams(docs)
    for h in (("<s>",), ("w1",), ("w1", "w7"), ("<s>", "w3"), ("never",), ("never", "w1"), ()):
        assert math.isclose(sum(m.prob(h, w) for w in m.words) + m.prob(h, "unknown"), 1, rel_tol=1e-9)
    want = Counter()
    for i, ts in m.tokens:
        base = sum(math.log10((m.c[w,] + 0.5) / (m.n + 0.5 * (m.v + 1))) for w in ts)
        want[i, m.held(i), len(ts), sum(w in m.words for w in ts), m.n, round(base, 6), round(m.score(ts), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_nothing_learned(spark):
    held = next(i for i in range(100) if lm_scoring.held_out(i))
    r = lm_scoring.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert r.train_tokens == 0 and r.n_known == 0 and r.score == 0.0


# Pipeline.


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    r = random.Random(9)
    long = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randrange(400)}" for _ in range(n)).capitalize() + "."
    passage = long(14)
    base = [long(80) for _ in range(20)]
    docs = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)] + [(100 + i, t + " more", "en", "s0") for i, t in enumerate(base[:5])] + [(200, base[7] + " " + passage, "en", "s1"), (201, long(60) + "\n" + passage + "\n" + long(60), "en", "s2")]
    docs += [(300 + i, "\n".join(" | ".join("xyz"[k % 3] * 5 + str(r.randrange(999)) for k in range(20)) for _ in range(4)), "en", "s1") for i in range(8)] + [(400, None, None, None), (401, "short", "en", "s1")]
    spark.createDataFrame([(*x, len(x[1] or "")) for x in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(i, 1) for i in range(20)] + [(300 + i, 0) for i in range(8)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = corpus_pipeline.good(spark, docs, folder)
    ids = {r.doc_id for r in good.collect()}
    assert ids >= set(range(20)) and not ids & {400, 401} and not ids & set(range(300, 308))
    one = {r.doc_id for r in corpus_pipeline.distinct(spark, good, folder).collect()}
    assert one >= set(range(20)) and not one & set(range(100, 105)) and 201 in one
    clean = corpus_pipeline.clean(spark, good, folder)
    assert {r.doc_id for r in clean.collect()} == ids - {200, 201} and tuple(clean.columns) == corpus_pipeline.COLUMNS


def test_pipeline_runs(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    rows = out.collect()
    assert rows and set(out.columns) == {*corpus_pipeline.COLUMNS, "shard", "slot"}
    assert {r.doc_id for r in rows} <= set(range(20)) | {200}


def test_stages_take_nulls_and_repeats(spark, folder):
    """Null ids, texts and sources, equal rows, long words, an empty table: every stage gives documents' columns."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    r = random.Random(3)
    prose_ = " ".join(f"{r.choice('abcdefgh')}{r.randrange(400)}" for _ in range(60)).capitalize() + "."
    docs = [(None, prose_, None, None, None), (None, None, None, None, None), (1, "", "en", "a", 0), (2, "y" * 100000, "en", "a", 1), (3, prose_, "en", "a", 2), (3, prose_, "en", "a", 2), (4, None, "en", None, None)]
    for rows in (docs, []):
        df = spark.createDataFrame(rows, kinds)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, folder)
            assert tuple(out.columns)[:5] == corpus_pipeline.COLUMNS and (name == "sharding" or len(out.columns) == 5)
            got = out.collect()
            if name == "ngram_join" and rows:
                assert Counter((x.doc_id, x.text) for x in got) == Counter([(None, None), (1, ""), (2, "y" * 100000), (3, prose_), (4, None)])
            if name == "decontamination":
                assert len(got) == len(rows)
            if name == "sharding":
                assert Counter((x.doc_id, x.text) for x in got) == Counter((x[0], x[1]) for x in rows)
            if name == "mixing" and rows:
                assert {x.doc_id for x in got} <= {None, 2, 3} and all(x.text for x in got)
