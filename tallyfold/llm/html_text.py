"""Main text of HTML pages by line-block distribution.

The page is stripped of markup line by line: block elements end a line, inline
elements do not.  Each line has the length of its text outside links; sums of
that over sliding windows of lines form a distribution whose surge (the first
window over the threshold) and dive (the first after it with nothing) bound the
main text; the surge reaches back over adjoining lines of text, such as headings
and bylines.  Lines in containers that never hold it (navigation, footers,
forms, scripts, adverts, comments of readers ...) are not kept; where a page
marks its article, lines outside are treated so too.  Inside the article any
text surges, for short paragraphs are text there as well, and only a full
window of links dives, so lone links stay.  Containers told by their class or
id count nevertheless if they hold the page's only article or, where a page
marks none, more than half of its text.

Defined cases: null or empty html gives the empty text; broken, cut off and
unclosed markup is read as far as it goes; repeated rows are read one by one;
other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shipping import ship

#: Lines in a window, and the text length of a window at which the main text surges.
WINDOW = 3
SURGE = 120

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea head title dialog menu object canvas".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements whose start tag ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())
MARKED = re.compile(r"(?i)(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|popup|modal|newsletter|subscri\w*|comments?|replies|disqus|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|copyright|share|sharing|social|related|recommend\w*|pagination|pager|login|signup|search|toolbar|skip|disclaimer|legal)(?:$|[\s_-])")
#: Class names that say what a container goes with, or that head the text itself.
UNMARKED = re.compile(r"(?i)(?:with|without|has|have|no|not)[_-]|(?:post|entry|article|story|content|section|title)[_-]+header(?:$|[_-])")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTR = re.compile(r"(?i)\b(class|id|role|aria-hidden|hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"\s+")


def _boilerplate(tag: str, attrs: str, article: int = 0) -> bool:
    if tag in SKIP:
        return True
    if tag in ("article", "main", "body", "html") or not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if article and name in ("class", "id") and "header" in value:
            continue  # the heading of the article itself
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name in ("class", "id") and any(MARKED.search(x) and not UNMARKED.match(x) for x in value.split()):
            return True
    return False


def lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters outside links, in boilerplate, in the article) of each line."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool]] = []  # open block and boilerplate elements
    marks: list[tuple[int, bool]] = []  # open boilerplate elements: number, whether their tag alone tells
    within: list[tuple[tuple[int, bool], ...]] = []  # marks of each line
    n_marks = 0
    parts: list[str] = []
    linked = skip = article = in_link = 0
    raw_until = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((text, max(0, len(text) - linked), skip > 0, article > 0))
                within.append(tuple(marks))
            parts.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal skip, article
        flush()
        for name, bad in stack[to:]:
            skip -= bad
            if bad:
                marks.pop()
            article -= name == "article"
        del stack[to:]

    at, low = 0, None
    while True:
        m = TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        if m[2] is None:
            continue
        tag, ending = m[2].lower(), bool(m[1])
        if tag == "a":
            in_link = 0 if ending else 1
        if tag == "br":
            parts.append("\n")
            continue
        if tag in INLINE and (ending or not _boilerplate(tag, m[3], article)):
            if ending and any(n == tag for n, _ in stack):
                close(max(i for i, (n, _) in enumerate(stack) if n == tag))
            continue
        if ending:
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            flush() if found is None else close(found)
            continue
        if tag in ENDS_P:
            found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
            if found is not None:
                close(found)
            if tag == "li" and stack and stack[-1][0] == "li":
                close(len(stack) - 1)
        if tag not in RAW:
            flush()
        if tag in RAW:
            low = low or page.lower()
            raw_until = low.find(f"</{tag}", at)
            at = len(page) if raw_until < 0 else raw_until
            if raw_until >= 0:
                end = page.find(">", at)
                at = len(page) if end < 0 else end + 1
            continue
        if tag in VOID or m[3].endswith("/") and tag not in ENDS_P:
            continue
        bad = _boilerplate(tag, m[3], article) and not (tag == "header" and article)
        stack.append((tag, bad))
        skip += bad
        if bad:
            n_marks += 1
            marks.append((n_marks, tag in SKIP))
        article += tag == "article"
    if at < len(page):
        parts.append(page[at:])
    flush()
    return _without_wrappers(out, within)


def _without_wrappers(found: list[tuple[str, int, bool, bool]], within: list[tuple[tuple[int, bool], ...]]) -> list[tuple[str, int, bool, bool]]:
    """``found``, where containers told by class or id do not count as boilerplate if they hold the only article or most of the text."""
    if any(a and not b for _, _, b, a in found):
        return found
    soft = [not any(hard for _, hard in m) for m in within]
    marked = any(a and s for (_, _, _, a), s in zip(found, soft))
    held: dict[int, int] = {}
    for (_, n, _, a), m, s in zip(found, within, soft):
        if s and (a or not marked):
            for k, _ in m:
                held[k] = held.get(k, 0) + n
    total = sum(n for (_, n, _, _), s in zip(found, soft) if s)
    wrappers = {k for k, n in held.items() if n and (marked or 2 * n > total)}
    return [(t, n, any(k not in wrappers for k, _ in m), a) for (t, n, _, a), m in zip(found, within)]


def main_text(page: str | None) -> str:
    found = lines(page) if page else []
    article = any(a and not b for _, _, b, a in found)
    kept = [x for x in found if not x[2] and (x[3] or not article)]
    surge = 1 if article else SURGE
    size = [n for _, n, _, _ in kept]
    sums = [sum(size[i : i + WINDOW]) for i in range(len(size))]
    inside = [False] * len(kept)
    for i, n in enumerate(size):
        if i and inside[i - 1]:
            inside[i] = sums[i] > 0 or article and i + WINDOW > len(size)
        elif sums[i] >= surge and n:
            back = i
            while back and not inside[back - 1] and size[back - 1]:
                back -= 1
            if article:  # links before the text, if they fill no window
                start = back
                while start and not inside[start - 1] and not size[start - 1]:
                    start -= 1
                back = start if back - start < WINDOW else back
            inside[back : i + 1] = [True] * (i + 1 - back)
    out = [t for (t, n, _, _), x in zip(kept, inside) if x and (n or article)]
    return "\n\n".join(out or [t for t, n, _, _ in kept if n or article])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.selectExpr(f"`{id_col}` as page_id", f"`{url_col}` as url", f"cast(`{html_col}` as string) as html")
    kind = dict(rows.dtypes)
    ship(pages.sparkSession)
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
