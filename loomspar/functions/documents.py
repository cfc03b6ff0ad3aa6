"""Light markup to a document tree (as JSON) and back to plain text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup that is understood.
_INLINE = re.compile(r"`(?P<code>[^`]+)`|\*\*(?P<b1>[^*]+)\*\*|__(?P<b2>[^_]+)__|\*(?P<i1>[^*]+)\*|_(?P<i2>[^_]+)_|\[(?P<label>[^\]]+)\]\((?P<href>[^)]+)\)")
_KINDS = (("fence", re.compile(r"^```(.*)$")), ("heading", re.compile(r"^(#{1,6})\s+(.+)$")), ("bulletList", re.compile(r"^[-*]\s+(.*)$")), ("orderedList", re.compile(r"^\d+\.\s+(.*)$")))
#: What ends a paragraph; a heading mark alone does, though it begins no heading.
_BREAKS = re.compile(r"^(?:```|#{1,6}\s|[-*]\s|\d+\.\s)")


def inline(text: str) -> list[dict]:
    """Text nodes with their marks: code, strong, em, link."""
    out, at = [], 0
    for m in _INLINE.finditer(text):
        if m.start() > at:
            out.append({"type": "text", "text": text[at : m.start()]})
        g = m.groupdict()
        if g["href"]:
            node = {"text": g["label"], "marks": [{"type": "link", "attrs": {"href": g["href"]}}]}
        else:
            mark, inside = next((k, g[n]) for k, names in (("code", ("code",)), ("strong", ("b1", "b2")), ("em", ("i1", "i2"))) for n in names if g[n])
            node = {"text": inside, "marks": [{"type": mark}]}
        out.append({"type": "text", **node})
        at = m.end()
    if at < len(text):
        out.append({"type": "text", "text": text[at:]})
    return out


def _paragraph(lines: list[str]) -> dict:
    content: list[dict] = []
    for i, line in enumerate(lines):
        content += ([{"type": "hardBreak"}] if i else []) + inline(line)
    return {"type": "paragraph", "content": content}


def _blocks(lines: list[str]) -> Iterator[dict]:
    i = 0
    while i < len(lines):
        kind, m = next(((k, m) for k, p in _KINDS if (m := p.match(lines[i]))), (None, None))
        if kind == "fence":
            end = next((j for j in range(i + 1, len(lines)) if lines[j].startswith("```")), len(lines))
            node = {"type": "codeBlock", "content": [{"type": "text", "text": "\n".join(lines[i + 1 : end])}]}
            yield node | ({"attrs": {"language": m[1].strip()}} if m[1].strip() else {})
            i = end + 1
        elif kind == "heading":
            yield {"type": "heading", "attrs": {"level": len(m[1])}, "content": inline(m[2])}
            i += 1
        elif kind:
            pattern, items = dict(_KINDS)[kind], []
            while i < len(lines) and (m := pattern.match(lines[i])):
                items.append({"type": "listItem", "content": [_paragraph([m[1]])]})
                i += 1
            yield {"type": kind, "content": items}
        elif not lines[i].strip():
            i += 1
        else:
            start = i
            i += 1
            while i < len(lines) and lines[i].strip() and not _BREAKS.match(lines[i]):
                i += 1
            yield _paragraph(lines[start:i])


def to_tree(text: str | None) -> dict:
    blocks = list(_blocks(text.split("\n"))) if text and text.strip() else []
    return {"version": 1, "type": "doc", "content": blocks or [_paragraph([])]}


def is_tree(value: object) -> bool:
    return isinstance(value, dict) and value.get("version") == 1 and value.get("type") == "doc" and isinstance(value.get("content"), list)


def _flat(node: dict) -> str:
    if node.get("type") == "hardBreak":
        return "\n"
    inner = [_flat(n) for n in node.get("content") or []]
    if node.get("type") == "bulletList":
        return "\n".join(f"- {t}" for t in inner)
    if node.get("type") == "orderedList":
        return "\n".join(f"{i}. {t}" for i, t in enumerate(inner, 1))
    return node.get("text") or "".join(inner)


def to_plain(tree: dict | None) -> str:
    return "\n\n".join(_flat(n) for n in (tree or {}).get("content") or [])


def _column(fn: Callable[[str], str]) -> Callable[[Column | str], Column]:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: fn(x) if isinstance(x, str) else None)

    return run


def markup_to_tree(c: Column | str) -> Column:
    """JSON text of the tree; parse_json() makes it a VARIANT."""
    return _column(lambda t: json.dumps(to_tree(t), ensure_ascii=False, separators=(",", ":")))(c)


def tree_to_plain(c: Column | str) -> Column:
    return _column(lambda t: to_plain(json.loads(t)))(c)
