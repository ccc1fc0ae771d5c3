"""HTML to text. The one scalar that needs a parser, so it runs as an Arrow batch."""

from __future__ import annotations

from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose text is not part of the visible text.
HIDDEN = frozenset({"script", "style", "template", "rt", "rp"})


class TextCollector(HTMLParser):
    """Collects the visible text pieces between tags, in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.buffer: list[str] = []
        self.hidden: list[str] = []

    def cut(self) -> None:
        if self.buffer:
            piece = "".join(self.buffer).strip()
            if piece:
                self.pieces.append(piece)
            self.buffer.clear()

    def handle_starttag(self, tag, attrs):
        self.cut()
        if tag in HIDDEN:
            self.hidden.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.cut()

    def handle_endtag(self, tag):
        self.cut()
        if tag in self.hidden:
            while self.hidden.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.hidden:
            self.buffer.append(data)

    def handle_comment(self, data):
        self.cut()

    def handle_decl(self, decl):
        self.cut()

    def handle_pi(self, data):
        self.cut()

    def unknown_decl(self, data):
        self.cut()


def visible_text(markup: str | None, separator: str = " ") -> str:
    if not markup:
        return ""
    if "<" not in markup and "&" not in markup:
        return markup.strip()
    collector = TextCollector()
    collector.feed(markup)
    collector.close()
    collector.cut()
    return separator.join(collector.pieces)


def _visible_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(visible_text).astype("object")


def html_to_text(c: Column) -> Column:
    """Visible text of an HTML fragment, its pieces joined by one blank."""
    return F.pandas_udf(_visible_text, "string")(F.coalesce(c, F.lit("")))


def _visible_blocks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda blocks: " ".join(
            visible_text(b) for b in (() if blocks is None else blocks))).astype("object")


def html_blocks_to_text(c: Column) -> Column:
    """Texts of an array of HTML fragments, joined by one blank."""
    return F.pandas_udf(_visible_blocks, "string")(c)
