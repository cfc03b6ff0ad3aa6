"""Main text of web pages by a linear-chain conditional random field over the page's leaf blocks.

A page is parsed into leaf blocks: runs of text between the starts and ends of block-level elements. Each block has
features of its ancestors (tags, and hints in their class, id and role attributes) and of its text, and the field labels
blocks as main text or not; Viterbi gives the best labelling of the page. Main blocks are joined by one space.

The field is trained on labelled pages: TRAINING_PAGES pages written by labelled_page() from a fixed seed, which knows
for each block that it writes whether it is main text. Their layouts vary (with or without article and main elements,
sidebars, notices, adverts, forms, comments, link lists and tables in the text), as does the order of their parts. The
words are invented, so nothing but structure and shape can be learned. Training is bounded by its number of pages.

Defined cases: null, empty or blank html has no blocks and an empty text; broken markup is read as far as it goes (open
elements end with the page; a head without end tag ends at the first element or text that can't stand in it; a reference
without a number is text; marked sections that aren't ones are comments); unknown elements are inline; repeated rows are extracted singly; other columns stay.
"""

from __future__ import annotations

import html
import random
import re
from functools import lru_cache, partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspar.llm._crf import Chain, train
from loomspar.llm._rows import annotate

TRAINING_PAGES = 400
SEED = 5
OTHER, MAIN = 0, 1
RESULT = "struct<text:string,n_blocks:long,blocks:array<struct<start:long,main:boolean>>>"

BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td template textarea tfoot th thead title tr ul".split()
)
SILENT_TAGS = frozenset("script style noscript template iframe object svg math canvas audio video head title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a start tag ends, if they are open within the nearest list, table or section.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
CLOSES |= {t: {"p"} for t in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split()}
SCOPES = frozenset("ul ol dl table div section article aside main nav header footer form body blockquote td th".split())
SPACE = " \t\n\r\f\v"
#: Elements that leave an open head open.
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_NUMBER = re.compile(r"&#(?:[0-9]+|[xX][0-9a-fA-F]+)?;?")
_MARKED = re.compile(r"<!\[(?:temp|cdata|ignore|include|rcdata|if|else|endif)(?![-_.a-zA-Z0-9])", re.IGNORECASE)

ANCESTORS = ("article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "table", "section", "blockquote", "figure", "button", "select", "details")
HINTS = (
    ("main", r"content|article|post|entry|story|main|body|text"),
    ("advert", r"\bads?\b|advert|sponsor|promo|banner"),
    ("comments", r"comment|discuss|repl(?:y|ies)|disqus|respond"),
    ("notice", r"cookie|consent|gdpr|notice|alert|popup|modal|newsletter|subscri|paywall"),
    ("navigation", r"nav|menu|breadcrumb|pag(?:er|ination)|toc|tabs|skip"),
    ("side", r"side|related|recommend|widget|share|social|author-?box|tags?\b|popular|trending"),
    ("frame", r"foot|head(?:er)?\b|masthead|copyright|legal|logo"),
    ("form", r"form|login|signup|search"),
)
_HINTS = [(k, re.compile(v)) for k, v in HINTS]


class Block:
    __slots__ = ("features", "links", "main", "parts", "start", "text")

    def __init__(self, features: frozenset[str], start: int) -> None:
        self.features, self.start, self.parts, self.links, self.main, self.text = features, start, [], 0, None, ""


class _Blocks(HTMLParser):
    """Leaf blocks in page order. Attribute data-main of the nearest ancestor that has it labels a block."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=False)
        self.stack: list[tuple[str, frozenset[str], bool | None]] = []
        self.blocks: list[Block] = []
        self.open: Block | None = None
        self.silent = self.anchors = 0
        self.behind = False
        self.lines = [0]
        for m in re.finditer("\n", page):
            self.lines.append(m.end())
        self.feed(page)
        self._resume()
        rest = self.rawdata
        if rest and not rest.startswith("<"):
            self._text(html.unescape(rest))
        self._end()

    def _resume(self) -> None:
        """The parser stops at "&#" that it can't read as a reference, before it or (if a ";" follows anywhere) behind it."""
        while (self.rawdata or self.behind) and not self.cdata_elem:
            if self.behind:
                self.rawdata, self.offset, self.behind = "&#" + self.rawdata, self.offset - 2, False
            elif not self.rawdata.startswith("&#"):
                return
            end = _NUMBER.match(self.rawdata).end()
            self._text(html.unescape(self.rawdata[:end]))
            self.updatepos(0, end)
            self.rawdata = self.rawdata[end:]
            self.goahead(0)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        end = super().parse_marked_section(i, report) if _MARKED.match(self.rawdata, i) else -1
        return self.parse_bogus_comment(i) if end < 0 else end

    def _end(self) -> None:
        if self.open is not None:
            text = _one_space("".join(self.open.parts))
            if text:
                self.open.text = text
                self.blocks.append(self.open)
            self.open = None

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.silent -= tag in SILENT_TAGS
        self.anchors -= tag == "a"
        if tag in BLOCK_TAGS:
            self._end()

    def _end_head(self) -> None:
        while any(t == "head" for t, _, _ in self.stack):
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" or (self.stack and self.stack[-1][0] == "head" and tag not in HEAD_TAGS):
            self._end_head()
        if tag == "head" and any(t == "head" for t, _, _ in self.stack):
            return
        if ends := CLOSES.get(tag):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in ends:
                    while len(self.stack) > i:
                        self._pop()
                elif self.stack[i][0] in SCOPES:
                    break
        if tag in BLOCK_TAGS:
            self._end()
        if tag in VOID_TAGS:
            return
        features = {f"in:{tag}"} if tag in ANCESTORS else set()
        values = {k: v or "" for k, v in attrs}
        hint = " ".join(values.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label")).lower()
        if hint.strip():
            features |= {f"hint:{k}" for k, pattern in _HINTS if pattern.search(hint)}
        if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", ""):
            features.add("hidden")
        above, main = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (frozenset(), None)
        if "data-main" in values:
            main = values["data-main"] == "1"
        self.stack.append((tag, above | features, main))
        self.silent += tag in SILENT_TAGS
        self.anchors += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not any(t == "p" for t, _, _ in self.stack):
            self._end()
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in SCOPES and tag not in BLOCK_TAGS:
                return

    def handle_data(self, data: str) -> None:
        if data == "&#":  # the parser stops behind it
            self.behind = True
        else:
            self._text(data)

    def _text(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip(SPACE):
            self._end_head()
        if self.silent:
            return
        if self.open is None:
            if not data.strip(SPACE):
                return
            line, column = self.getpos()
            above, main = (self.stack[-1][1], self.stack[-1][2]) if self.stack else (frozenset(), None)
            tag = next((t for t, _, _ in reversed(self.stack) if t in BLOCK_TAGS), "")
            self.open = Block(above | {f"tag:{tag}"}, self.lines[min(line, len(self.lines)) - 1] + column)
            self.open.main = main
        self.open.parts.append(data)
        if self.anchors:
            self.open.links += len(data)

    def handle_entityref(self, name: str) -> None:
        self._reference(f"&{name}")

    def handle_charref(self, name: str) -> None:
        self._reference(f"&#{name}")

    def _reference(self, ref: str) -> None:
        line, column = self.getpos()
        at = self.lines[min(line, len(self.lines)) - 1] + column + len(ref)
        self._text(html.unescape(ref + ";" if self._page_char(at) == ";" else ref))

    def _page_char(self, at: int) -> str:
        return self.page[at : at + 1]

    def feed(self, data: str) -> None:
        self.page = data
        super().feed(data)


def _one_space(text: str) -> str:
    return " ".join(text.split())


def leaf_blocks(page: str | None) -> list[Block]:
    return _Blocks(page).blocks if page else []


NAMES = [f"in:{t}" for t in ANCESTORS] + [f"hint:{k}" for k, _ in HINTS] + ["hidden"]
NAMES += [f"tag:{t}" for t in ("p", "h1", "h2", "h3", "li", "td", "div", "blockquote", "pre", "a")]
_AT = {n: i for i, n in enumerate(NAMES)}


def features(blocks: list[Block]) -> np.ndarray:
    out = np.zeros((len(blocks), len(NAMES) + 8))
    seen_h1 = False
    for i, b in enumerate(blocks):
        for f in b.features:
            if f in _AT:
                out[i, _AT[f]] = 1
        n = len(b.text)
        words = b.text.count(" ") + 1
        stops = sum(b.text.count(c) for c in ".!?")
        seen_h1 |= "tag:h1" in b.features
        out[i, len(NAMES) :] = (
            np.log1p(words), min(words, 12) / 12, b.links / n, b.links > 0.6 * n, min(stops / words, 1), b.text[-1] in ".!?:\"”", seen_h1, i / len(blocks)
        )
    return out


# Labelled pages.


def labelled_page(seed: int) -> str:
    """A page whose blocks are labelled by data-main."""
    r = random.Random(seed)
    syllables = ["ka", "lo", "mir", "ten", "su", "vo", "ran", "el", "pi", "dor", "ash", "un", "que", "zi", "nor"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    some = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))

    def sentence() -> str:
        return some(2, 18).capitalize() + r.choice(".....?!")

    def prose(a: int, b: int) -> str:
        text = " ".join(sentence() for _ in range(r.randint(a, b)))
        if r.random() < 0.15:
            text = text.replace(" ", f' <a href="/{word()}">{word()}</a> ', 1)
        return f"<b>{text}</b>" if r.random() < 0.05 else text

    label = lambda: some(1, 3) + r.choice(["", "", "", "", ".", "?"])
    links = lambda a, b: "".join(f'<li><a href="/{word()}">{label()}</a></li>' for _ in range(r.randint(a, b)))

    def other(part: str) -> str:
        return f'<div data-main="0">{part}</div>' if r.random() < 0.3 else part.replace(">", ' data-main="0">', 1)

    soup = r.random() < 0.15  # a page of bare divisions, old ones with tables

    def navigation() -> str:
        if soup:
            cells = [f'<a href="/{word()}">{label()}</a>' for _ in range(r.randint(1, 7))]
            return other(r.choice(["<div>" + "".join(f"<div>{c}</div>" for c in cells) + "</div>", "<table><tr>" + "".join(f"<td>{c}" for c in cells) + "</tr></table>", f"<div>{' '.join(cells)}</div>"]))
        return other(r.choice([f"<nav><ul>{links(2, 9)}</ul></nav>", f'<div class="{r.choice(["menu", "navbar", "breadcrumb"])}"><ul>{links(2, 8)}</ul></div>', f"<header><p>{some(1, 4)}</p><ul>{links(0, 6)}</ul></header>"]))

    def advert() -> str:
        return other(f'<div class="{r.choice(["ad", "ads", "advert", "sponsored", "banner"])}">{prose(1, 3)}</div>')

    def notice() -> str:
        return other(f'<div class="{r.choice(["cookie-notice", "consent", "newsletter", "popup"])}"><p>{prose(1, 2)}</p><button>{some(1, 2)}</button></div>')

    def side() -> str:
        return other(f'<{(t := r.choice(["aside", "div"]))}{"" if t == "aside" and r.random() < 0.6 else " class=" + repr(r.choice(["sidebar", "related", "widget"]))}><h3>{some(1, 4)}</h3><ul>{links(1, 7)}</ul>{"<p>" + prose(1, 2) + "</p>" if r.random() < 0.5 else ""}</{t}>')

    def form() -> str:
        return other(f"<form><p>{some(1, 6)}</p><label>{some(1, 2)}</label><select><option>{word()}<option>{word()}</select><button>{word()}</button></form>")

    def comments() -> str:
        said = "".join(f'<div class="comment"><p>{word()}</p><p>{prose(1, 4)}</p></div>' for _ in range(r.randint(1, 5)))
        return other(f'<section {r.choice(["id", "class"])}="{r.choice(["comments", "discussion", "replies"])}"><h2>{some(1, 2)}</h2>{said}</section>')

    def footer() -> str:
        if soup and r.random() < 0.7:
            return navigation() if r.random() < 0.6 else other(f"<div>Copyright {some(1, 4)}</div>")
        return other(r.choice([f"<footer>&copy; {word()} &middot; {prose(1, 2)}</footer>", f"<footer><p>{prose(1, 2)}</p><ul>{links(0, 5)}</ul></footer>", f'<div id="footer">Copyright {word()} {some(2, 9)}</div>']))

    parts = []
    for _ in range(r.choice([1, 1, 2, 2, 3, 4, 6, 9, 14])):
        kind = r.random()
        if kind < 0.78:
            parts.append(f"<div>{prose(1, 5)}</div>" if soup and r.random() < 0.7 else f"<p>{prose(1, 7)}</p>" if r.random() < 0.85 else f"<p><b>{prose(1, 5)}<br>")
        elif kind < 0.86:
            parts.append(f"<h2>{some(1, 6)}</h2>")
        elif kind < 0.92:
            parts.append("<ul>" + "".join(f"<li>{some(1, 9)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
        elif kind < 0.95:
            parts.append(f"<blockquote>{prose(1, 3)}</blockquote>")
        elif kind < 0.97:
            parts.append("<table>" + "".join(f"<tr><td>{word()}<td>{some(1, 4)}" for _ in range(r.randint(1, 4))) + "</table>")
        else:
            parts.append(r.choice([advert, side])())
    if r.random() < 0.12:
        parts.insert(r.randint(0, len(parts)), advert())
    if r.random() < 0.08:
        parts.append(comments())
    title = "" if soup and r.random() < 0.4 else f"<h1>{some(1, 12)}</h1>"
    body = title + "".join(parts)
    shell = r.random()
    open_, close = ("<div", "</div>") if soup and shell < 0.8 else ("<article", "</article>") if shell < 0.6 else ("<main", "</main>") if shell < 0.75 else (f'<div class="{r.choice(["content", "post", "entry-content", "story-body"])}"', "</div>") if shell < 0.95 else ("<div", "</div>")
    main = f'{open_} data-main="1">{body}{close if r.random() < 0.9 else ""}'
    before = [f() for f in (navigation, notice, advert, side, form) if r.random() < (0.9 if f is navigation else 0.3)]
    after = [f() for f in (side, advert, comments, form, notice, footer) if r.random() < (0.9 if f is footer else 0.3)]
    if r.random() < 0.2:
        r.shuffle(before)
    return f"<!DOCTYPE html><html><head><title>{some(1, 9)}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def fit(pages: list[list[Block]]) -> Chain:
    """The field from pages whose blocks are labelled (not labelled: not main text)."""
    x = np.concatenate([features(p) for p in pages])
    off = np.concatenate(([0], np.cumsum([len(p) for p in pages])))
    return train(x, off, np.array([MAIN if b.main else OTHER for p in pages for b in p]), 2)


@lru_cache(maxsize=1)
def trained(n: int = TRAINING_PAGES, seed: int = SEED) -> Chain:
    return fit([leaf_blocks(labelled_page(seed * 1_000_003 + i)) for i in range(n)])


def extract(chain: Chain, pages: list[str | None]) -> list[dict]:
    found = [leaf_blocks(p) for p in pages]
    off = np.concatenate(([0], np.cumsum([len(b) for b in found])))
    label = chain.decode(np.concatenate([features(b) for b in found] + [np.zeros((0, len(NAMES) + 8))]), off) if off[-1] else np.empty(0, int)
    out = []
    for i, blocks in enumerate(found):
        main = (label[off[i] : off[i + 1]] == MAIN).tolist()
        text = " ".join(b.text for b, m in zip(blocks, main) if m)
        out.append({"text": text, "n_blocks": len(blocks), "blocks": [{"start": b.start, "main": m} for b, m in zip(blocks, main)]})
    return out


def _extracting(shared, column: str):
    return lambda batch: extract(shared.value, batch.column(column).to_pylist())


def main_text(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """pages' columns (those in keep) and a struct column RESULT with its name."""
    shared = pages.sparkSession.sparkContext.broadcast(trained())
    return annotate(pages, html_col, partial(_extracting, shared, html_col), RESULT, "extracted", keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out, name = main_text(pages, keep=["page_id", "url"])
    text = F.col(f"{name}.text")
    return out.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
