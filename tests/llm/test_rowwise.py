"""Quality rules, decontamination, HTML extraction, token counts and chat formatting against plain versions."""

import base64
import hashlib
import json
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from loomspar.llm import _crf, chat_format, decontamination, html_extraction, quality_rules, token_counts

DOCS = "doc_id long, text string"
TEXTS = [None, "", " \n\t", "a", "Line one here.\nLine one here.\n\nLine  one here.", "x # * $ % & | < > é", "a b c d e f g h " * 4, "word " * 30000, "\r\n\x0b\x0c", "the cat sat on the mat and then it ran off to see the dog in the park by the lake"]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_measures(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    cover = {j for i in range(len(w) - 7) if c[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text), dup, len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w)


def test_base_measures(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), DOCS).withColumn("quality_rules", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out, name = quality_rules.measure(df, labels)
    got = {r.doc_id: tuple(r[name])[:6] for r in out.collect()}
    assert got == {i: base_measures(t) for i, t in enumerate(TEXTS)} and name != "quality_rules"
    assert {r.doc_id for r in quality_rules.keep_good(df, labels).collect()} == {i for i, t in enumerate(TEXTS) if not base_measures(t)[5]}


def prose(r, n):
    return " ".join(" ".join(r.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit"]) for _ in range(r.randint(4, 12))).capitalize() + "." for _ in range(n))


def test_labels_are_learned(spark):
    r = random.Random(1)
    good = ["\n".join(prose(r, 3) + f" {i}" for _ in range(4)) for i in range(60)]
    bad = ["\n".join(" | ".join(r.choice("abcdef") * 4 for _ in range(12)) for _ in range(5)) for _ in range(60)]
    chain = quality_rules.fit([t.encode() for t in good[:40] + bad[:40]], [True] * 40 + [False] * 40)
    kept = [x["content_words"] >= 0.5 * x["n_words"] for x in quality_rules.judge(chain, [t.encode() for t in good[40:] + bad[40:]])]
    assert np.mean(np.array(kept) == np.array([True] * 20 + [False] * 20)) >= 0.95


def junk(r, n):
    return " | ".join(r.choice("abcdef") * 4 + str(r.randrange(99)) for _ in range(n))


def test_lines_of_mixed_texts_are_told_apart():
    """Trained on documents' labels only; bad documents hold good lines, good ones a line of junk."""
    r = random.Random(4)

    def text(n_good, n_bad):
        lines = [(prose(r, 2), True) for _ in range(n_good)] + [(junk(r, r.randint(6, 16)), False) for _ in range(n_bad)]
        turn = r.randrange(len(lines))
        return lines[turn:] + lines[:turn]

    made = [(text(r.randint(3, 8), r.choice([0, 0, 1])), True) for _ in range(150)] + [(text(r.choice([0, 1, 2]), r.randint(4, 9)), False) for _ in range(150)]
    chain = quality_rules.fit(["\n".join(x for x, _ in t).encode() for t, _ in made], [g for _, g in made])
    shares, right, n = [], 0, 0
    for _ in range(100):
        lines = text(r.randint(1, 8), r.randint(1, 8))
        x = quality_rules.Lines(["\n".join(y for y, _ in lines).encode()])
        got = chain.decode(x.features, x.off) == quality_rules.CONTENT
        right, n = right + (got == np.array([g for _, g in lines])).sum(), n + len(lines)
        shares.append((got * x.line_words).sum() / x.line_words.sum())
    assert right / n >= 0.95 and np.mean([0 < s < 1 for s in shares]) >= 0.9
    assert chain.moves[0, 0] + chain.moves[1, 1] > chain.moves[0, 1] + chain.moves[1, 0]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "x" * 40000), (3, None), (4, "short one")], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)] * 2, "doc_id long, quality int")
    texts, good = quality_rules.labelled_sample(docs, labels)
    assert texts == [b"text 0", b"", b"short one"] and good == [True, True, False]
    assert quality_rules.fit([b"a b", b""], [True, False]) is None


def test_viterbi_is_best_path():
    rng = np.random.default_rng(2)
    chain = _crf.Chain(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2), np.zeros(3), np.ones(3))
    x, off = rng.normal(size=(14, 3)), np.array([0, 5, 5, 6, 14])
    got, emit = chain.decode(x, off), chain.scores(x)
    for a, b in zip(off, off[1:]):
        n = b - a
        paths = [[p >> i & 1 for i in range(n)] for p in range(2**n)]
        score = lambda p: sum(emit[a + i, y] for i, y in enumerate(p)) + (chain.begin[p[0]] if n else 0) + sum(chain.moves[p, q] for p, q in zip(p, p[1:]))  # noqa: E731, B023
        assert got[a:b].tolist() == max(paths, key=score)


# Decontamination.

ITEMS = [("1", "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu"), ("2", "One, two!"), ("3", None), ("4", "..."), ("10", "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (None, "one two"), ("5", "solo"), ("2", "one two")]
MARKED = [
    "x ALPHA beta gamma delta epsilon zeta eta theta iota kappa lam y", "alpha beta gamma delta epsilon zeta eta theta iota", "say one-two now", None, "", "one", "twoone two one two", "solo solo", "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu " * 3, "one. two"
]


def brute_hits(texts, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    keys = {}
    for i, t in items:
        w = split(t)
        n = min(k, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            keys.setdefault(tuple(w[s : s + n]), set()).add(i)
    out = []
    for t in texts:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in keys}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in keys:
                    hit.update(range(s, s + n))
                    found |= keys[tuple(w[s : s + n])]
        found -= {None}
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    docs = list(enumerate(MARKED)) + [(7, MARKED[7])]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in decontamination.query(spark, str(tmp_path)).collect())
    assert got == sorted((d, *h) for (d, _), h in zip(docs, brute_hits([t for _, t in docs], ITEMS)))


def test_decontamination_random(spark):
    r = random.Random(4)
    text = lambda n: " ".join(r.choice("abc") for _ in range(n))
    items = [(str(i), text(r.choice([1, 2, 3, 9, 10, 11, 14]))) for i in range(12)]
    texts = [text(r.choice([0, 5, 10, 60])) for _ in range(40)]
    probe = decontamination.Probe([i for i, _ in items], [t.encode() for _, t in items], 10)
    got = probe.search([t.encode() for t in texts])
    assert [(g["n_words"], sum(s["end"] - s["start"] for s in g["spans"]), len(g["matches"])) for g in got] == [h[:3] for h in brute_hits(texts, items)]
    for g, t in zip(got, texts):
        for m in g["matches"]:
            item = dict(items)[m["item_id"]].split()
            assert t.split()[m["doc_start"] : m["doc_start"] + m["length"]] == item[m["item_start"] : m["item_start"] + m["length"]]
            assert (m["length"], m["doc_start"], m["item_start"]) == longest_match(t.split(), item)


def longest_match(text, item):
    """Length and first places of the longest common substring."""
    n, p, o = max(((n, -p, -o) for p in range(len(text)) for o in range(len(item)) for n in [next((k for k in range(len(item) - o + 1) if text[p : p + k + 1] != item[o : o + k + 1] or o + k >= len(item)), 0)]), default=(0, 0, 0))
    return n, -p, -o


@pytest.mark.parametrize("window", [1, 2, 3, 5, 10])
def test_longest_matches(window):
    r = random.Random(window)
    text = lambda n: [r.choice("ab") for _ in range(n)]
    items = [(str(i), text(r.choice([1, 4, 12, 30]))) for i in range(8)]
    texts = [text(r.choice([0, 1, 3, 20, 40])) + (items[i % 8][1][2:25] if i % 3 else []) for i in range(20)]
    probe = decontamination.Probe([i for i, _ in items], [" ".join(t).encode() for _, t in items], window)
    for g, t in zip(probe.search([" ".join(t).encode() for t in texts]), texts):
        got = {m["item_id"]: (m["length"], m["doc_start"], m["item_start"]) for m in g["matches"]}
        best = {i: longest_match(t, w) for i, w in items}
        assert got == {i: b for i, b in best.items() if b[0] >= min(window, len(dict(items)[i]))}


def test_windows_that_repeat_in_both_sides():
    """Memory and time follow the places, not their pairs."""
    n = 20000
    probe = decontamination.Probe(["a", "b"], [b"na " * n, b"x y z " * 3000], 10)
    tracemalloc.start()
    start = time.perf_counter()
    got = probe.search([b"na " * (n - 5), b"z x y " * 4000 + b"na na"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [m["length"] for g in got for m in g["matches"]] == [n - 5, 9000] and peak < 200 << 20 and time.perf_counter() - start < 20


def test_contaminated_documents_go(spark):
    docs = spark.createDataFrame(list(enumerate(MARKED)), DOCS).withColumn("matched", F.lit(1)).withColumn("n_words", F.lit(2))
    out = decontamination.remove_contaminated(docs, spark.createDataFrame(ITEMS, "item_id string, text string"))
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 3, 4, 5}
    empty = spark.createDataFrame([], "item_id string, text string")
    assert decontamination.remove_contaminated(docs, empty).count() == len(MARKED)
    assert decontamination.remove_contaminated(docs.limit(0), spark.createDataFrame(ITEMS, "item_id string, text string")).count() == 0


# HTML.


def test_extraction_accuracy():
    pages = [html_extraction.leaf_blocks(html_extraction.labelled_page(77_000_000 + i)) for i in range(80)]
    off = np.concatenate(([0], np.cumsum([len(p) for p in pages])))
    got = html_extraction.trained().decode(np.concatenate([html_extraction.features(p) for p in pages]), off)
    assert np.mean(got == np.array([int(bool(b.main)) for p in pages for b in p])) >= 0.98


PAGE = """<html><head><title>no</title><script>var a = "</p>";</script></head><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav><div class="cookie-notice"><p>We use cookies to do things.</p></div>
<article><h1>A  title&nbsp;here</h1><p>First &amp; <b>bold</b> words&#33; a &lt;b&gt; c.<p>Second<br>line &bogus; ends.</article><section id="comments"><p>I like it very much.</p></section><footer>&copy; me</footer>"""


def test_extraction_of_a_page():
    assert html_extraction.extract(html_extraction.trained(), [PAGE])[0]["text"] == "A title here First & bold words! a <b> c. Second line &bogus; ends."


def test_extraction_edges(spark):
    pages = [(0, "u", None), (1, "u", ""), (2, "u", "  \n"), (3, "u", "<"), (4, "u", "<article><p>open"), (5, "u", "plain & simple text, all of it."), (6, "u", "<article>" + "<p>long text goes on. " * 20000), (4, "u", "<article><p>open")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("Extracted", F.lit(1))
    out, name = html_extraction.main_text(df)
    got = {r.page_id: r[name].text for r in out.collect()}
    assert out.count() == len(pages) and got[0] == got[1] == got[2] == "" and got[4] == "open" and len(got[6]) == 19 * 20000 - 1


#: Pages made by hand: html, texts of the article, texts of the rest. The last two were added after the training pages were settled.
LAYOUTS = [
("""<html><body><div id=top><a href=/>Site</a> <a href=/n>News</a> <a href=/s>Sport</a></div><div class=post><h1>How bees find their way</h1><p>Bees use the sun as a compass, and they remember landmarks near the hive.</p><div class=advert><p>Buy our honey today, it is the best honey.</p></div><p>When clouds hide the sun, they read the polarised light of the sky.</p><div class=comments><h3>2 comments</h3><div class=comment><p>Ann</p><p>I never knew that, thank you for this.</p></div></div></div><div class=footer>Copyright 2024 Bee News</div></body></html>""",
 ["How bees find their way","Bees use the sun as a compass, and they remember landmarks near the hive.","When clouds hide the sun, they read the polarised light of the sky."],
 ["Buy our honey today, it is the best honey.","I never knew that, thank you for this.","Copyright 2024 Bee News"]),
("""<div><div><div><a href=a>Home</a></div><div><a href=b>About us</a></div></div><div><div>The bridge over the river was closed on Monday after heavy rain.</div><div>Engineers said that the pillars had moved by two centimetres.</div><div>It will open again in spring, the city said.</div></div><div><div><a href=c>Privacy</a></div><div><a href=d>Terms</a></div></div></div>""",
 ["The bridge over the river was closed on Monday after heavy rain.","Engineers said that the pillars had moved by two centimetres.","It will open again in spring, the city said."],["Home","About us","Privacy","Terms"]),
("""<body><nav><a href=x>Start</a><a href=y>Shop</a></nav><main><h1>Results of the race</h1><p>The race was run on Sunday in good weather.</p><table><tr><th>Place<th>Name<tr><td>1<td>Maria Lopez<tr><td>2<td>John Smith</table><p>All runners reached the finish before noon.</p></main><aside><h3>Most read</h3><ul><li><a href=1>Ten shoes for you</a></li></ul></aside><form><label>Email</label><input><button>Subscribe</button></form></body>""",
 ["Results of the race","The race was run on Sunday in good weather.","Maria Lopez","John Smith","All runners reached the finish before noon."],["Most read","Ten shoes for you","Subscribe"]),
("""<body><table><tr><td><a href=1>Index</a><td><a href=2>Archive</a></tr></table><center><h2>My old home page</h2><p>Welcome to my page about model trains, which I build in my cellar.<p>The tracks are eleven metres long and cross three bridges.</center><hr><p>Last change: 3 May 1999. <a href=mailto:x>Mail me</a></body>""",
 ["My old home page","Welcome to my page about model trains, which I build in my cellar.","The tracks are eleven metres long and cross three bridges."],["Index","Archive"]),
("""<body><header class=site-header><h1>The Daily</h1><nav><ul><li><a href=a>World</a><li><a href=b>Money</a></ul></nav></header><div class=cookie-banner><p>We use cookies.</p><button>Accept</button></div><article><header><h1>Prices fall again</h1><p>By Jane Doe</p></header><p>Prices fell for the third month in a row, the office said.</p><figure><img src=x><figcaption>A market in the old town.</figcaption></figure><blockquote>We had not expected this, said a baker.</blockquote><ul><li>Bread is cheaper by two percent.</li><li>Milk costs the same.</li></ul><aside class=related><h4>Read also</h4><a href=q>Wages rise</a></aside><p>Economists expect a small rise in autumn.</p></article><section id=comments><p>First!</p></section><footer><p>Imprint</p></footer></body>""",
 ["Prices fall again","Prices fell for the third month in a row, the office said.","We had not expected this, said a baker.","Bread is cheaper by two percent.","Milk costs the same.","Economists expect a small rise in autumn."],["World","We use cookies.","Accept","Wages rise","First!","Imprint"]),
("""<body><div class="topbar"><span>Log in</span><span>Search</span></div><div class="breadcrumbs"><a href=/>Home</a> / <a href=/g>Garden</a></div><div id="content"><h1>Pruning apple trees</h1><div class="meta">Posted by Tom on 4 March</div><p>Cut in late winter, before the buds open.</p><h2>Tools</h2><ol><li>A sharp saw.</li><li>A pair of loppers.</li></ol><div class="sponsored"><a href=ad>Shears at half price!</a></div><p>Remove dead wood first, then branches that cross.</p><pre>cut above the bud</pre></div><div class="widget"><h3>Newsletter</h3><p>Get tips every week.</p></div><div id="footer"><p>All rights reserved.</p></div></body>""",
 ["Pruning apple trees","Cut in late winter, before the buds open.","Tools","A sharp saw.","A pair of loppers.","Remove dead wood first, then branches that cross."],["Log in","Home","Shears at half price!","Get tips every week.","All rights reserved."]),
("""<html><body><section class="hero"><h1>A short history of ice</h1></section><section class="story"><div><p>Ice was cut from lakes and kept in cellars under straw.</p></div><div><p>Ships carried it as far as India, where it was sold by weight.</p><p>Machines that made ice ended the trade.</p></div></section><ul class="menu"><li><a href=1>Next story</a></li><li><a href=2>All stories</a></li></ul><div class="replies"><p>Bob</p><p>My grandfather cut ice on our lake.</p></div></body></html>""",
 ["A short history of ice","Ice was cut from lakes and kept in cellars under straw.","Ships carried it as far as India, where it was sold by weight.","Machines that made ice ended the trade."],["Next story","All stories","My grandfather cut ice on our lake."]),
]


def test_extraction_on_other_layouts():
    """Comments and adverts in the article, bare divisions, tables: precision and recall by blocks."""
    right = missed = wrong = 0
    for page, main, other in LAYOUTS:
        text = html_extraction.extract(html_extraction.trained(), [page])[0]["text"]
        right += sum(x in text for x in main)
        missed += sum(x not in text for x in main)
        wrong += sum(x in text for x in other)
    assert right / (right + missed) >= 0.95 and right / (right + wrong) >= 0.9


def _block_texts(page):
    return [b.text for b in html_extraction.leaf_blocks(page)]


def test_pages_without_end_of_head():
    assert _block_texts("<html><head><title>no</title><meta name=x><body><p>Some text.</p></body></html>") == ["Some text."]
    assert _block_texts("<head><title>no</title><link rel=x><p>Some text.</p>") == _block_texts("<head><head></head><title>no</title>Some text.") == ["Some text."]
    assert _block_texts("<head><title>no <b>no</b></title><style>p {}</style><noscript><img src=x>no</noscript></head><body>a") == ["a"]
    page = PAGE.replace("</head>", "")
    assert html_extraction.extract(html_extraction.trained(), [page])[0]["text"] == html_extraction.extract(html_extraction.trained(), [PAGE])[0]["text"]


def test_references_without_number():
    tail = "<script>var no = '&#';</script><p>more &amp; &#33;</p><footer>end</footer>"
    for ref, text in (("&#", "&#"), ("&#x", "&#x"), ("&#;", "&#;"), ("&#xyz;", "&#xyz;"), ("&#65bc", "Abc"), ("&#<b>c</b>", "&#c"), ("&#&#", "&#&#")):
        for end in ("", ";"):
            assert _block_texts(f"<p>a {ref} b{tail}{end}") == [f"a {text} b", "more & !", *(["end"] if not end else ["end", ";"])]
    assert _block_texts("<p>a &#65") == ["a A"] and _block_texts("<p>a &#") == ["a &#"] and _block_texts("<p>a &am") == ["a &am"]
    assert _block_texts("<p>a &#<p") == ["a &#"] and _block_texts("<p>a &#&am") == ["a &#&am"] and _block_texts("<p>a ;&#<p") == ["a ;&#"]
    page = "<p>one\n</p><p>&# two</p>\n<p>three;</p>"
    assert [b.start for b in html_extraction.leaf_blocks(page)] == [page.index(t) for t in ("one", "&#", "three")]


def test_bad_marked_sections():
    for section in ("<![ x]>", "<![foo[ x ]>", "<![>", "<![CDATA[ x>", "<![if !IE]>", "<![endif]>", "<![CDATA[ x ]]>"):
        page = f"<p>a</p>{section}<p>b</p>"
        assert [(b.text, b.start) for b in html_extraction.leaf_blocks(page)] == [("a", 3), ("b", page.index("b</p>"))]
    assert _block_texts("<p>a</p><![ x") == ["a"]


# Tokens.


def test_token_counts(spark):
    docs = [(0, "s", "a b\nc  d"), (1, None, None), (2, "s", ""), (3, "s", "é\n\n日本" * 50), (0, "s", "a b\nc  d")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("tokens", F.lit(1))
    out, name = token_counts.count_tokens(df, ["source", "text"], keep=["doc_id"])
    rows = [(r.doc_id, r[name]) for r in out.collect()]
    assert len(rows) == len(docs)
    for _, t in rows:
        assert sum(t.field_tokens) == t.n_tokens == sum(t.section_tokens) and len(t.section_tokens) == t.n_sections


def test_offsets_cover_the_text():
    encoder = token_counts.Encoder(token_counts.read_vocabulary(token_counts.VOCABULARY))
    for text in ("", "a\nb", "naïve 日本\n\n  x", "z" * 5000):
        ends = encoder.ends(text.encode())
        assert (ends[-1] if len(ends) else 0) == len(text.encode()) and (np.diff(np.concatenate(([0], ends))) > 0).all()


def test_long_runs_are_cut_where_the_pattern_cuts(monkeypatch):
    encoder = token_counts.Encoder(token_counts.read_vocabulary(token_counts.VOCABULARY))
    r = random.Random(5)
    pieces = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "\u3000", "a", "Zé", "7", "'s", "!?", "'", "x1"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(40))) for _ in range(3000)]
    plain = [encoder._cut_and_merge(t) for t in texts]
    monkeypatch.setattr(token_counts, "_RUNS", re.compile(token_counts._RUNS.pattern.replace(str(token_counts.RUN), "2")))
    assert [encoder.encode(t) for t in texts] == plain


@pytest.mark.parametrize("c", [" ", "\n", "\u3000", "a", "7", "=", "é"])
def test_five_megabytes_of_one_character(c):
    encoder = token_counts.Encoder(token_counts.read_vocabulary(token_counts.VOCABULARY))
    text = ("x" + c * (5_000_000 // len(c.encode())) + "y").encode()
    ends = encoder.ends(text)
    assert ends[-1] == len(text) and (np.diff(ends) > 0).all()


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_equals_that_of_single_bytes(spark, rule):
    r = random.Random(7)
    texts = [(i, r.choice([None, "", "the", " the\n"]), "".join(r.choice(["\n", " the", "é", "of the\n", "  ", "ing", "x"]) for _ in range(r.randrange(30)))) for i in range(40)] + [(41, None, None), (41, None, None)]
    df = spark.createDataFrame(texts, "doc_id long, source string, text string")
    out, name = token_counts.count_tokens(df, ["source", "text"], rule=rule, keep=["doc_id"])
    got = [(x.doc_id, x[name].n_tokens, x[name].field_tokens, x[name].section_tokens, x[name].n_crossing) for x in out.collect()]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, token_counts.read_vocabulary(token_counts.VOCABULARY).splitlines())}
    plain = tiktoken.Encoding("plain", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def owner(section):
        """The section of a token from the sections of its bytes."""
        if rule == "most":
            c = Counter(section)
            return min(c, key=lambda x: (-c[x], x))
        return section[0 if rule == "start" else -1]

    want = []
    for doc, source, text in texts:
        parts = [(source or "").encode(), (text or "").encode()]
        whole = b"\n".join(parts)
        field = [0] * (len(parts[0]) + 1) + [1] * len(parts[1])
        line = [whole[:i].count(b"\n") for i in range(len(whole))]
        fields, lines, crossing, at = [0, 0], [0] * (whole.count(b"\n") + 1), 0, 0
        tokens = plain.encode_ordinary(whole.decode())
        for t in tokens:
            n = len(plain.decode_single_token_bytes(t))
            fields[owner(field[at : at + n])] += 1
            lines[owner(line[at : at + n])] += 1
            crossing += len(set(line[at : at + n])) > 1
            at += n
        want.append((doc, len(tokens), fields, lines, crossing))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rules_for_crossing_tokens():
    ends, bounds = np.array([3, 8, 10]), np.array([0, 4, 10])
    assert token_counts.attribute(ends, bounds, "start")[0].tolist() == [2, 1]
    assert token_counts.attribute(ends, bounds, "end")[0].tolist() == [1, 2]
    assert token_counts.attribute(ends, bounds, "most")[0].tolist() == [1, 2]
    assert token_counts.attribute(ends, bounds)[1] == 1
    assert token_counts.attribute(np.empty(0, np.int64), np.array([0, 0]))[0].tolist() == [0]
    with pytest.raises(ValueError):
        token_counts.attribute(ends, bounds, "?")


# Chat.

SCHEMAS = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}, "additionalProperties": False}}


def test_violations():
    s = SCHEMAS["add"]
    assert chat_format.violations({"x": 1}, s) == [] and chat_format.violations({"x": 1.0, "tags": ["a"]}, s) == []
    assert chat_format.violations({"y": 1}, s) == ["$.x: required", "$.y: unexpected"]
    assert chat_format.violations({"x": True, "tags": ["c", "a"]}, s) == ["$.tags[0]: enum", "$.x: type"]
    assert chat_format.violations([], s) == ["$: type"]


def test_linking(spark):
    call = lambda *c: json.dumps({"content": None, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in c]})
    result = lambda i, c="ok": json.dumps({"tool_call_id": i, "content": c})
    messages = [
        (1, 0, "user", 'say "hé"\n'), (1, 1, "tool", result("early")), (1, 2, "assistant", call(("c1", "add", {"x": 1}), ("c2", "add", '{"x": "no"}'), ("early", "add", {"x": 2}))), (1, 3, "tool", result("c2")), (1, 4, "tool", result("c1")), (1, 5, "tool", result("c1")), (1, 6, "tool", result("nobody")),
        (1, 7, "assistant", call(("c1", "nope", {}), ("c9", "add", "{bad"))), (2, 0, "tool", result("c1")), (2, 1, None, None), (2, 2, "user", "{not json"), (2, 3, "user", '{"a": NaN}'), (None, 0, "tool", result("c1")), (2, 4, "user", '{"tool_calls": "text"}'),
    ]
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string").withColumn("parsed", F.lit(1)).withColumn("c", F.lit(2)).withColumn("t", F.lit(3))
    out = chat_format.link_tools(df, SCHEMAS)
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert len(got) == len(messages) == out.count()
    assert got[1, 2].call_links == "linked,linked,linked" and got[1, 2].n_linked == 3 and got[1, 2].n_invalid == 1
    assert got[1, 7].call_links == "duplicate,unanswered" and got[1, 7].n_invalid == 2
    assert [got[1, t].link for t in (1, 3, 4, 5, 6)] == ["linked", "linked", "linked", "extra", "orphan"] and got[2, 0].link == "orphan" and got[None, 0].link == "orphan"
    order = [r.turn for r in sorted((r for k, r in got.items() if k[0] == 1), key=lambda r: tuple(r.order_key))]
    assert order.index(1) > order.index(2) and order[:2] == [0, 2]
    assert got[1, 0].json == '{"content":"say \\"hé\\"\\n","role":"user"}' and got[2, 1].json == '{"content":"","role":null}'
    assert json.loads(got[1, 2].json)["tool_calls"][0] == {"arguments": {"x": 1}, "id": "c1", "name": "add"}
    assert chat_format.link_tools(df.limit(0), SCHEMAS).count() == 0


def test_repeated_rows_stay(spark):
    messages = [(1, 0, "user", "x"), (1, 0, "user", "x")]
    assert chat_format.link_tools(spark.createDataFrame(messages, "conv_id long, turn long, role string, text string"), {}).count() == 2
