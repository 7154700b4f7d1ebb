"""Vocabularies as one regular expression each, over folded text."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def folded(term: str) -> str:
    """What :func:`keys.fold` makes of a literal."""
    return "".join(c for c in unicodedata.normalize("NFD", term.lower()) if unicodedata.category(c) != "Mn")


def quoted(term: str) -> str:
    return re.sub(r"([^\w\s'&-])", r"\\\1", term)


def alternation(terms: list[str], whole_words: bool = False) -> str:
    """Longest terms first, so that the leftmost match is the longest."""
    found = sorted({folded(t) for t in terms}, key=lambda t: (-len(t), t))
    body = "|".join(map(quoted, found))
    return rf"(?<![a-z0-9])(?:{body})(?![a-z0-9])" if whole_words else f"(?:{body})"


def has_any(c: Column, terms: list[str], whole_words: bool = False) -> Column:
    if not terms:
        return F.lit(False)
    # literal terms are looked for as they are; only those that are there are held against their surroundings
    held = reduce(or_, [c.contains(t) for t in sorted({folded(t) for t in terms})])
    return held & c.rlike(alternation(terms, True)) if whole_words else held
