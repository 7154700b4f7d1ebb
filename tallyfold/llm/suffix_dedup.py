"""Passages that repeat across documents, by sparse suffix arrays.

A text's suffixes start at its words.  Of each LENGTH-word window one suffix is
retained: the one among its first WINDOW whose head of HEAD words has the
smallest hash, so equal windows retain the same suffix wherever they stand.
The retained suffixes of all documents are sorted by their heads; those whose
neighbours have another head repeat nothing and go.  The rest are extended to
the left and right, to every LENGTH-word window they stand for, and these are
sorted and compared in turn, so a match that starts or ends anywhere is found
to its full extent, whatever the other occurrences share of it.  Runs of
repeated windows are the passages.

Sorting is by 64-bit hashes of heads and windows: it puts equal ones together,
which is what comparing neighbours needs.  Equal windows are found by partial
sums and joined with the first of them, so a passage that a third of the
documents share is no task of its own.

Defined cases: null, empty and shorter texts repeat nothing; rows without an id
are left out, as no span could name them; of equal passages
the one of the smallest (doc_id, position) is the first; rows that share an id
are read as one document's; repeats within one document alone are left; an
empty table gives no rows; other columns are ignored, and by
:func:`remove_copies` kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import may_join, surely_not
from .scratch import Scratch
from .shingles import gram_hashes, word_hashes
from .shipping import ship

LENGTH, HEAD = 50, 25
WINDOW = LENGTH - HEAD + 1
SLICE = 64
WORD = re.compile("[^ \\t-\\r]+")
_POSITION_BITS = 28


def retained(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the head at each word, position of the retained suffix of each window), of a text's word hashes."""
    if len(w) < LENGTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    heads = gram_hashes(w, HEAD)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    least = (heads & ~low) | np.arange(len(heads), dtype=np.uint64)
    span = 1
    while 2 * span <= WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - span)], least[WINDOW - span :])
    return heads, (least & low).astype(np.int64)


def _hashes(t: pa.Scalar) -> np.ndarray:
    return word_hashes((t.as_py() or b"").split())


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            head, ids, pos = [np.empty(0, np.uint64)], [], [np.empty(0, np.int64)]
            for i, t in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                heads, kept = retained(_hashes(t))
                kept = np.unique(kept)
                head.append(heads[kept])
                pos.append(kept)
                ids += [i] * len(kept)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(head).view(np.int64)), pa.array(ids, pa.int64()), pa.array(np.concatenate(pos).astype(np.int32))], ["head", "doc_id", "pos"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            hashes, ids, starts = [np.empty(0, np.uint64)], [], [np.empty(0, np.int64)]
            for i, t, shared in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist(), strict=True):
                w = _hashes(t)
                start = np.flatnonzero(np.isin(retained(w)[1], np.array(shared, np.int64)))
                hashes.append(gram_hashes(w, LENGTH)[start])
                starts.append(start)
                ids += [i] * len(start)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), pa.array(ids, pa.int64()), pa.array(np.concatenate(starts).astype(np.int32))], ["hash", "doc_id", "start"])


def repeated_spans(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, n_words, is_copy, other_doc_id), one row per passage and document.

    A span is a run of repeated windows that are all first occurrences or all
    copies; ``other_doc_id`` is the document of the first occurrence, for a
    first occurrence the last document that has it.
    """
    ship(spark)
    scratch = Scratch(spark, "suffix-dedup")
    texts = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(cast(`{text_col}` as string) as binary) as text").filter("doc_id is not null")
    suffixes = scratch.write(texts.mapInArrow(_suffixes, "head long, doc_id long, pos int"))
    twice = scratch.write(suffixes.groupBy("head").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo <> hi").select("head"))
    left = may_join(suffixes, "head", twice).join(twice.hint("merge"), "head")
    places = scratch.write(left.groupBy("doc_id").agg(F.collect_set("pos").alias("shared")))
    scratch.free(suffixes)
    extended = may_join(texts, "doc_id", places).join(places.hint("merge"), "doc_id").select("doc_id", "text", "shared")
    windows = scratch.write(extended.mapInArrow(_windows, "hash long, doc_id long, start int"))
    place = F.struct("doc_id", "start")
    firsts = windows.groupBy("hash").agg(F.min(place).alias("first"), F.max("doc_id").alias("last_doc")).filter("first.doc_id <> last_doc")
    firsts = scratch.write(firsts)
    met = may_join(windows, "hash", firsts).join(firsts.hint("merge"), "hash")
    marked = met.select("doc_id", "start", (place != F.col("first")).alias("is_copy"), F.when(F.col("doc_id") == F.col("first.doc_id"), F.col("last_doc")).otherwise(F.col("first.doc_id")).alias("other"))
    runs = marked.groupBy("doc_id", "is_copy").agg(F.array_sort(F.collect_list(F.struct("start", "other"))).alias("at"))
    # a window starts a run if the one before it is not in the list
    begins = F.filter("at", lambda x, i: (i == 0) | (F.get(F.col("at"), i - 1)["start"] < x["start"] - 1))
    ends = F.filter("at", lambda x, i: F.coalesce(F.get(F.col("at"), i + 1)["start"] > x["start"] + 1, F.lit(True)))
    spans = runs.select("doc_id", "is_copy", F.inline(F.zip_with(begins, ends, lambda b, e: F.struct(b["start"].alias("start_word"), (e["start"] - b["start"] + LENGTH).alias("n_words"), b["other"].alias("other_doc_id")))))
    return spans.select("doc_id", "start_word", "n_words", "is_copy", "other_doc_id")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans (start, count), which may overlap."""
    found = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for start, count in sorted(spans):
        stop = min(start + count, len(found))
        if start >= stop:
            continue
        begin, end = found[start][0], found[stop - 1][1]
        if begin > at:
            out.append(text[at:begin])
        at = max(at, end)
    return "".join(out) + text[at:]


def remove_copies(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (columns doc_id and text among others) without the copied passages; ``n_chars``, if there, follows.

    A document of which no word is left goes.  Documents without copies are
    not shuffled.
    """
    ship(docs.sparkSession)
    copies = spans.filter("is_copy").groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "n_words")).alias("_cuts"))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [cut_words(t or "", [(x["start_word"], x["n_words"]) for x in cuts]) for t, cuts in zip(b.column("text").to_pylist(), b.column("_cuts").to_pylist(), strict=True)]
            cols = {n: b.column(n) for n in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array(map(len, texts), pa.int64()).cast(cols["n_chars"].type)
            out = pa.RecordBatch.from_pydict(cols)
            yield out.filter(pa.array([bool(WORD.search(t)) for t in texts], pa.bool_()))

    keys = copies.select("doc_id")
    touched = may_join(docs, "doc_id", keys).join(copies.hint("merge"), "doc_id", "left")
    cut = touched.filter("_cuts is not null").select(*names, "_cuts").mapInArrow(run, docs.schema)
    return surely_not(docs, "doc_id", keys).unionByName(touched.filter("_cuts is null").select(*names)).unionByName(cut)
