"""Functions that no JVM expression gives exactly, as Arrow functions; rows that cannot change bypass them as nulls."""

from __future__ import annotations

import html
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize_whitespace


def arrow(fn, returns: str = "string"):  # noqa: ANN001, ANN202
    """An Arrow function that maps each non-null value."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, returns)


def decode_entities(c: Column) -> Column:
    return F.coalesce(arrow(html.unescape)(F.when(c.contains("&"), c)), c)


def dedupe_key(c: Column) -> Column:
    """Compatibility form without case, every run of other characters than a-z and 0-9 one space. ASCII stays in the JVM."""
    plain = c.rlike(r"^[\x00-\x7f]*$")
    folded = arrow(lambda x: unicodedata.normalize("NFKC", x).casefold())(F.when(~plain, c))
    return F.trim(F.regexp_replace(F.coalesce(folded, F.lower(c)), "[^a-z0-9]+", " "))


class _Text(HTMLParser):
    HIDDEN = ("script", "style", "noscript")

    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in self.HIDDEN

    def handle_endtag(self, tag: str) -> None:
        self.hidden = max(0, self.hidden - (tag in self.HIDDEN))

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.out.append(data.strip())


def _visible(page: str) -> str:
    parser = _Text()
    parser.feed(page)
    parser.close()
    return " ".join(filter(None, parser.out))


def html_to_text(c: Column) -> Column:
    """Visible text of a page: without scripts and styles, each piece between tags a word group of its own."""
    return normalize_whitespace(F.coalesce(arrow(_visible)(F.when(c.contains("<") | c.contains("&"), c)), c))


def unescaped(text: str) -> str:
    return html.unescape(text)


def key_of(text: str) -> str:
    """``dedupe_key`` of one text."""
    return re.sub("[^a-z0-9]+", " ", unicodedata.normalize("NFKC", text).casefold()).strip(" ")


def visible_text(page: str) -> str:
    """``html_to_text`` of one page, white space as the parser leaves it collapsed."""
    return " ".join(_visible(page).split())
