"""Whole pages against an independent reader, and texts of several MB."""

import hashlib
import random
import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
import public_tokenizers as P
import pytest

from tallyfold.llm import bpe, exact_dedup, html_text, jaccard_join, packing, quality, suffix_dedup


class Reader(HTMLParser):
    """Texts of headings, paragraphs and items that stand in no menu, footer, form, advert, script or head."""

    DROPPED = {"nav", "footer", "header", "aside", "form", "script", "style", "head", "title", "template", "noscript"}
    BLOCKS = {"p", "h1", "h2", "h3", "h4", "li", "div", "article", "section", "ul", "blockquote", "body"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks, self.now = [], [], []

    def flush(self):
        text = " ".join("".join(self.now).split())
        if text:
            self.blocks.append(text)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.flush()
        if tag == "br":
            self.now.append(" ")
        elif tag in self.DROPPED or tag == "div":
            self.open.append((tag, tag in self.DROPPED or dict(attrs).get("class") in ("ad", "advert", "sidebar", "comments")))

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not any(bad for _, bad in self.open):
            self.now.append(data)


def test_pages_equal_an_independent_reader():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    for page in pages:
        r = Reader()
        r.feed(page)
        r.close()
        r.flush()
        assert html_text.main_text(page) == "\n\n".join(r.blocks)
    assert len(pages) == 250


@pytest.fixture(scope="module")
def long_docs(spark):
    """Two texts of about 3 MB that differ in one word, with a line without white space of 300,000 characters, and a short one."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 9))) for _ in range(40_000)]
    text = [rnd.choice(words) for _ in range(380_000)] + ["x" * 300_000]
    other = list(text)
    other[1000] = "changed"
    rows = [(1, " ".join(text)), (2, " ".join(other)), (3, "a short text")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache(), {i: t for i, t in rows}


def test_texts_of_several_mb(spark, long_docs):
    df, texts = long_docs
    words = {i: re.findall("[^ \t-\r]+", t) for i, t in texts.items()}
    assert {r.doc_id: (r.n_words, r.word_chars) for r in quality.ledger(df).collect()} == {i: (len(w), sum(map(len, w))) for i, w in words.items()}
    assert {r.doc_id: r.text_sha256 for r in exact_dedup.dedup(spark, df).collect()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
    assert {r.doc_id: r.component_id for r in jaccard_join.join(spark, df).collect()} == {1: 1, 2: 1, 3: 3}
    spans = [(r.doc_id, r.start_word, r.n_words) for r in suffix_dedup.repeated_spans(spark, df).collect() if r.is_copy]
    assert sorted(spans) == [(2, 0, 1000), (2, 1001, len(words[2]) - 1001)]
    encoded = {r.doc_id: r for r in bpe.encode_decode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert {i: r.decoded_sha256 for i, r in encoded.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}
    pieces = packing.pack(df, P.path("byte_bpe_50k.json")).groupBy("doc_id", "doc_tokens").sum("length").collect()
    assert {r.doc_id: (r.doc_tokens, r["sum(length)"]) for r in pieces} == {i: (r.n_tokens + 1, r.n_tokens + 1) for i, r in encoded.items()}
