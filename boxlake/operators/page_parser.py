"""Reads one HTML page into plain records. The only Python that runs per page.

It reports what is on the page - tables with their rows, links, headings and the officials line -
and decides nothing: every rule on top of it is a DataFrame expression.
"""

from __future__ import annotations

import re
from html import unescape

from boxlake.fixed_values import OFFICIALS_LABEL

PAGE = (
    "tables array<struct<table_id: string, classes: array<string>, caption: string, rows: array<struct<"
    "has_link: boolean, link_text: string, link_target: string, has_head: boolean, "
    "heads: array<string>, cells: array<string>>>>>, "
    "links array<string>, headings array<string>, officials string"
)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW_TEXT = frozenset(["script", "style", "template"])

# What follows a tag's name. Quoted attribute values may contain ">".
_REST = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
_OTHER = r"<!--(?s:.*?)-->|<[!?][^>]*>"
# A comment, a declaration, or a tag.
_TOKEN = re.compile(rf"{_OTHER}|<(/)?([a-zA-Z][^\s/>]*)({_REST})>")
# The same, but these are one token: a row of a player's link or none, bare head cells and bare cells; bare cells, bare head
# cells, any element of bare text, an element of raw text. Bare text has no tag in it.
_CELLS, _HEADS = (rf"(?:<{tag}(?=[\s>]){_REST}(?<!/)>[^<]*+</{tag}>)" for tag in ("td", "th"))
_LINK = rf"<th(?=[\s>]){_REST}(?<!/)><a(?=[\s>])({_REST})(?<!/)>([^<]*+)</a></th>"
_ROW = rf"<tr(?=[\s>]){_REST}(?<!/)>(?:{_LINK})?({_HEADS}*+)({_CELLS}*+)</tr>"
_RAW = "|".join(
    "".join(f"[{c}{c.upper()}]" for c in tag) + rf"(?=[\s/>]){_REST}>(?s:.*?</(?i:{tag})\s*>|.*)" for tag in sorted(_RAW_TEXT)
)
_TOKENS = re.compile(
    rf"({re.sub(r'\((?!\?)', '(?:', _ROW)})|({_HEADS}++)|({_CELLS}++)|<(?:{_RAW})"
    rf"|<(/)?([a-zA-Z][^\s/>]*)({_REST})>(?(4)|(?:([^<]*)</\5>)?)|{_OTHER}"
)
_ROW = re.compile(_ROW)
_TEXT = re.compile(rf"<t{_REST}>([^<]*)</t[dh]>")
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_HREF = re.compile(r"""\s+href=(?:"([^"]*)"|'([^']*)')""")
_STARTS = frozenset(["table", "tr", "th", "a", *_VOID, *_RAW_TEXT])  # tags whose start does more than open an element
_ENDS = frozenset(["table", "tr", "th", "td", "a", "caption", "h2", "strong"])


def _attributes(text: str) -> dict[str, str]:
    return {
        name.lower(): unescape(double or single or bare)
        for name, double, single, bare in _ATTRIBUTE.findall(text)
    }


class _Page:
    def __init__(self):
        self.pieces: list[str] = []  # the page's text so far, cut at every tag
        self.open: list[tuple] = []  # (tag, number of pieces before it, its record) of open elements
        self.within = {"table": [], "tr": [], "th": []}  # records of open elements that others ask for
        self.tables, self.links, self.headings = [], [], []
        self.crew_holder = self.officials = None

    def inside(self, tag):
        """Record of the innermost open element of a kind."""
        held = self.within[tag]
        return held[-1] if held else None

    def text_since(self, first: int) -> str:
        found = self.pieces[first:]
        return unescape(found[0] if len(found) == 1 else "".join(found))

    def row(self, text: str) -> None:
        """A whole row, as its tags one by one would make it."""
        given, name, heads, cells = _ROW.fullmatch(text).groups()
        heads, cells = _TEXT.findall(heads), _TEXT.findall(cells)
        target = None
        if name is not None:
            target, heads = self.link(given), [name, *heads]
        self.pieces += heads
        self.pieces += cells
        if "&" in text:
            name, heads, cells = name and unescape(name), [*map(unescape, heads)], [*map(unescape, cells)]
        if table := self.inside("table"):
            table["rows"].append({
                "has_link": name is not None, "link_text": name, "link_target": target, "has_head": bool(heads), "heads": heads, "cells": cells,
            })

    def cells(self, run: str, kind: str) -> None:
        """Cells or head cells that hold only text."""
        texts = _TEXT.findall(run)
        self.pieces += texts
        if row := self.inside("tr"):
            row[kind] += map(unescape, texts) if "&" in run else texts
            if kind == "heads":
                row["has_head"] = True

    def link(self, attributes: str) -> str | None:
        plain = _HREF.fullmatch(attributes)
        target = unescape(plain[plain.lastindex]) if plain else _attributes(attributes).get("href")
        if target is not None:
            self.links.append(target)
        return target

    def start(self, tag: str, attributes: str) -> None:
        record = True
        if tag == "table":
            given = _attributes(attributes)
            record = {
                "table_id": given.get("id"), "classes": given.get("class", "").split(), "caption": None, "rows": [],
            }
            self.tables.append(record)
        elif tag == "tr":
            record = {
                "has_link": False, "link_text": None, "link_target": None, "has_head": False, "heads": [], "cells": [],
            }
            if table := self.inside("table"):
                table["rows"].append(record)
        elif tag == "a":
            target, row = self.link(attributes), self.inside("tr")
            if row and not row["heads"] and not row["has_link"] and self.inside("th"):
                row.update(has_link=True, link_target=target)
        if tag not in _VOID:
            self.open.append((tag, len(self.pieces), record))
            if tag in self.within:
                self.within[tag].append(record)

    def end(self, tag: str) -> None:
        if self.open and self.open[-1][0] == tag:
            self.finish(self.open.pop())
        elif any(element[0] == tag for element in self.open):
            while self.finish(self.open.pop()) != tag:
                pass

    def finish(self, element) -> str:
        """An element has ended: the pieces since its start are its text."""
        tag, first, _ = element
        if tag in self.within:
            self.within[tag].pop()
        if tag in ("td", "th", "a"):
            if row := self.inside("tr"):
                if tag == "td":
                    row["cells"].append(self.text_since(first))
                elif tag == "th":
                    row["heads"].append(self.text_since(first))
                    row["has_head"] = True
                elif row["has_link"] and row["link_text"] is None:
                    row["link_text"] = self.text_since(first)
        elif tag == "caption":
            if (table := self.inside("table")) and table["caption"] is None:
                table["caption"] = self.text_since(first)
        elif tag == "h2":
            self.headings.append(self.text_since(first))
        elif tag == "strong" and self.crew_holder is None and self.open:
            if self.text_since(first).replace("\xa0", " ").strip() == OFFICIALS_LABEL:
                self.crew_holder = self.open[-1]
        if element is self.crew_holder:
            texts = (unescape(piece).strip() for piece in self.pieces[first:])
            self.officials = " ".join(text for text in texts if text)
        return tag


def _one_by_one(text: str) -> list[str | None]:
    """What ``_TOKENS`` splits a text into, tag by tag and for any text."""
    parts, at = [], 0
    while token := _TOKEN.search(text, at):
        closing, tag, attributes = token.groups()
        raw = tag.lower() if tag and not closing and tag.lower() in _RAW_TEXT else None
        parts += [text[at : token.start()], None, None, None, closing, None if raw else tag, attributes, None]
        at = token.end()
        if raw:
            close = re.compile(rf"</{raw}\s*>", re.IGNORECASE).search(text, at)
            at = close.end() if close else len(text)
    return [*parts, text[at:]]


def read_page(content: bytes | str) -> dict:
    text = content if isinstance(content, str) else bytes(content).decode("utf-8", "replace")
    # a raw-text tag whose name runs into a quote is no token of the pattern
    page = _read(_TOKENS.split(text)) or _read(_one_by_one(text))
    return {"tables": page.tables, "links": page.links, "headings": page.headings, "officials": page.officials}


def _read(split: list[str | None]) -> _Page | None:
    """The page of a split text; None if raw text was not told from other text."""
    parts, page = iter(split), _Page()
    pieces, opened, start, end = page.pieces, page.open, page.start, page.end
    pieces.append(next(parts))
    for row, heads, cells, closing, tag, attributes, alone, after in zip(*[parts] * 8, strict=True):
        if tag:
            tag = tag.lower()
            if closing:
                if opened and opened[-1][0] == tag and tag not in _ENDS and opened[-1] is not page.crew_holder:
                    opened.pop()
                else:
                    end(tag)
            else:
                if tag in _STARTS:
                    if tag in _RAW_TEXT:
                        return None
                    start(tag, attributes)
                else:
                    opened.append((tag, len(pieces), True))
                if attributes.endswith("/") and tag not in _VOID:
                    end(tag)
                if alone is not None:
                    pieces.append(alone)
                    end(tag)
        elif row:
            page.row(row)
        elif heads:
            page.cells(heads, "heads")
        elif cells:
            page.cells(cells, "cells")
        if after:
            pieces.append(after)
    while opened:
        page.finish(opened.pop())
    return page
