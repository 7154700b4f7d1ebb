"""Canonical keys and content ids, as native expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lower-case Latin letters that decompose to a letter from a to z and marks.
_DECOMPOSED = [(chr(i), d[0]) for i in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if len(d := unicodedata.normalize("NFD", chr(i))) > 1 and "a" <= d[0] <= "z" and all(unicodedata.category(c) == "Mn" for c in d[1:])]
ACCENTED = "".join(c for c, _ in _DECOMPOSED)
PLAIN = "".join(p for _, p in _DECOMPOSED)
APOSTROPHES = "’‘"


def text(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that it reads many times, with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), 0)


def fold(c: Column | str) -> Column:
    """Lower case without accents."""
    return F.regexp_replace(F.translate(F.lower(text(c)), ACCENTED, PLAIN), r"\p{Mn}", "")


def canonical(c: Column | str) -> Column:
    """Key of a name: straight apostrophes, folded, single spaces, trimmed."""
    straight = F.translate(text(c), APOSTROPHES, "''")
    return F.trim(F.regexp_replace(fold(straight), r"(?U)\s+", " "))


def place_key(c: Column | str) -> Column:
    """Key of a place: hyphens, apostrophes and spaces are one."""
    return F.trim(F.regexp_replace(canonical(c), r"[-'\s]+", " "))


def loose_key(c: Column | str) -> Column:
    """Key for reconciliation: everything but letters and digits is a space."""
    return F.trim(F.regexp_replace(canonical(c), "[^a-z0-9]+", " "))


def header_key(c: Column | str) -> Column:
    """Key of a column heading: spaces are underscores."""
    return F.replace(canonical(c), F.lit(" "), F.lit("_"))


def content_id(*parts: Column | str, digits: int = 16) -> Column:
    """First digits of the SHA-256 of the parts joined by ``|``; null counts as empty."""
    joined = F.concat_ws("|", *[F.coalesce(text(p).cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, digits)


def event_id(name: Column | str, place: Column | str, kind: Column | str, address: Column | str | None = None) -> Column:
    """Id of an event from canonical keys; a blank address takes no part."""
    keys = [canonical(F.coalesce(text(c), F.lit(""))) for c in (name, place, kind)]
    short = content_id(*keys)
    if address is None:
        return short
    key = canonical(F.coalesce(text(address), F.lit("")))
    return F.when(key == "", short).otherwise(content_id(*keys, key))


def article_id(url: Column | str, title: Column | str, day: Column | str) -> Column:
    """Id of an article: of its URL, or of title and date where it has none."""
    u = F.trim(F.coalesce(text(url), F.lit("")))
    return F.when(u != "", content_id(u)).otherwise(content_id(title, day))


def text_hash(c: Column | str, digits: int = 16) -> Column:
    return F.substring(F.sha2(F.coalesce(text(c), F.lit("")), 256), 1, digits)
