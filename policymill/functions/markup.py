"""Markup to structured plain text: one vectorised function, bypassed in the JVM for texts without markup."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from policymill.functions.values import clean, tidy_lines

_FENCED = {"p", "div", "blockquote", "pre", "ul", "ol", "section", "table", "h1", "h2", "h3", "h4", "h5", "h6"}
_SILENT = {"script", "style"}
_BOLD = {"b", "strong"}


class _Text(HTMLParser):
    """Writes text as it reads: rows, list items and headings get their marks when they close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[list[str]] = [[]]
        self.open: list[str] = []
        self.silent = 0
        self.bold = self.strong = self.plain = 0

    def _push(self, tag: str) -> None:
        self.open.append(tag)
        self.stack.append([])

    def _pop(self, tag: str) -> None:
        while self.open:
            last, text = self.open.pop(), "".join(self.stack.pop())
            self.stack[-1].append(self._wrap(last, text))
            if last == tag:
                return

    def _wrap(self, tag: str, text: str) -> str:
        t = text.strip()
        if tag in ("td", "th"):
            return " ".join(t.split()) + "\x1f"
        if tag == "tr":
            cells = [c.strip() for c in t.split("\x1f") if c.strip()]
            return " | ".join(cells) + "\n" if cells else ""
        if tag == "li":
            return f"\n- {t}\n" if t else ""
        if tag[0] == "h":
            return f"\n\n### {' '.join(t.split())}\n\n" if t else ""
        if tag == "p":
            flat, letters = " ".join(t.split()), self.strong + self.plain
            heading = 0 < len(flat) <= 100 and flat[-1] not in ".;," and letters and self.strong >= 0.9 * letters
            return f"\n\n### {flat}\n\n" if heading else f"\n\n{t}\n\n"
        return f"\n\n{t}\n\n"

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SILENT:
            self.silent += 1
        elif tag in _BOLD:
            self.bold += 1
        elif tag == "br":
            self.stack[-1].append("\n")
        elif tag in _FENCED or tag in ("tr", "td", "th", "li"):
            if tag in ("p", "li") and tag in self.open[-1:]:  # the one before was never closed
                self._pop(tag)
            if tag == "p":
                self.bold = self.strong = self.plain = 0
            self._push(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _BOLD:
            self.bold = max(0, self.bold - 1)
        elif tag in self.open:
            self._pop(tag)

    def handle_data(self, data: str) -> None:
        if not self.silent:
            n = len("".join(data.split()))
            if self.bold:
                self.strong += n
            else:
                self.plain += n
            self.stack[-1].append(data)

    def text(self) -> str:
        while self.open:
            self._pop(self.open[-1])
        return "".join(self.stack[0]).replace("\x1f", " ")


def plain_text(markup: str | None) -> str | None:
    """Text of one piece of markup."""
    if markup is None:
        return None
    p = _Text()
    p.feed(markup)
    p.close()
    return p.text()


def to_text(c: Column) -> Column:
    """Structured text of markup: `### ` headings, `- ` items, `a | b` rows; scripts and styles dropped; empty is NULL."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(plain_text, na_action="ignore")

    return tidy_lines(F.when(c.contains("<") | c.contains("&"), run(c)).otherwise(c))


def strip_tags(c: Column) -> Column:
    """Tags, scripts and styles replaced by blanks with regular expressions alone."""
    t = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"<[^<>]*>", " ")
    for name, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(ch))
    return clean(F.regexp_replace(t, r"[ \t\n\r\f]+", " "))
