"""Exact set-similarity join of documents on word shingles, as components.

Sets link when their Jaccard similarity is at least PERCENT / 100.  Steps:

1. Each set keeps a prefix of its shingles in hash order, long enough that
   linked sets share ``least(n)`` of the prefix, n being their size.
2. Shingles that prefixes of different sets share are counted; a set with fewer
   shared ones than ``least`` links with nothing.  Of the others the rarest
   shared ones are index entries: linked sets share one at least.
3. The index lists are kept in blocks by size of set.  Each block has a hub,
   the set whose shingles are the most common; the block's sets and the next
   larger block's are compared with it.  Links to hubs give first components.
4. Answers of other pairs derive from those of the hub: what two sets have in
   common is bounded by what each has of the hub and what else it shares with
   any set here, the triangle inequality of Jaccard distance skips sets much
   nearer to the hub or much farther, and sets that the hub has brought into
   one component need no comparison.  What remains is compared.

So links are exact, and a group of near copies costs comparisons in proportion
to its size.

Defined cases: null, empty and wordless texts have no shingles and are
components of their own; texts of one set share a component; rows that share an
id count as one document with all their links; a row without an id links as
any other, but names no component (null where no row of it has an id); ids lie
below 2 ** 62; an empty table gives no rows; other columns are ignored.  Shingles and sets are compared by 64-bit and
128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from .bitmap import may_join
from .components import components
from .scratch import Scratch
from .shipping import ship
from .shingles import shingle_set

PERCENT = 80
#: A prefix is longer than the usual one by a share of 1/EXTRA of the set.
EXTRA = 8
SLICE = 64


def least_overlap(n: np.ndarray | int):
    """Shingles that a set of n shares with any set it links with, at least."""
    return -(-n * PERCENT // 100)


def prefix_size(n: int) -> int:
    return min(n, n - least_overlap(n) + 1 + n // EXTRA)


#: :func:`prefix_size` in SQL.
PREFIX = f"least(n, n - (n * {PERCENT} + 99) div 100 + 1 + n div {EXTRA})"


def least_shared() -> Column:
    """Shingles that a set of ``n`` shares, within the prefixes, with any set it links with, at least."""
    return F.expr(f"1 + ((n * {PERCENT} + 99) div 100) div {EXTRA}")


#: Rows without an id are known by numbers from here on, which their texts give.
NO_ID = 1 << 62


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    number = F.lit(NO_ID).bitwiseOR(F.shiftrightunsigned(F.xxhash64(text), 2))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), number).alias("doc_id"), text.cast("binary").alias("text"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            size, s1, s2, prefix = [], [], [], []
            for t in part.column(1):
                x = shingle_set(t.as_py() or b"")
                key = xxh3_128_intdigest(x.tobytes())
                size.append(len(x))
                s1.append((key >> 64) - (1 << 63))
                s2.append((key & (1 << 64) - 1) - (1 << 63))
                prefix.append(x[: prefix_size(len(x))].view(np.int64))
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, prefix)]).astype(np.int32), pa.array(np.concatenate(prefix)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), lists], ["doc_id", "n", "s1", "s2", "prefix"])


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            sets = [shingle_set(t.as_py() or b"").tobytes() for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["doc_id", "whole"])


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a, c = b.column(2), b.column(3)
        both = [len(np.intersect1d(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), assume_unique=True)) for x, y in zip(a, c, strict=True)]
        size = [(len(x.as_buffer()) + len(y.as_buffer())) // 8 for x, y in zip(a, c, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()), pa.array([s - o for s, o in zip(size, both, strict=True)], pa.int64())], ["a", "b", "inter", "uni"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("whole")]
            ids = np.repeat(part.column("doc_id").to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets))], ["doc_id", "token"])


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, uni) of each pair (a, b)."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("whole").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("whole").alias("right"))
    rows = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "left", "right")
    return rows.mapInArrow(_overlaps, "a long, b long, inter long, uni long")


def _open_links(seen: DataFrame, sets: DataFrame, near: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links between components among the sets that a hub sees.

    Of a set's n shingles, ``shared`` are in another set here and ``inter`` in
    the hub.  Two sets have in common at most the lesser of what they have of
    the hub and the lesser of what else they share; pairs that could not link
    with that much, and pairs whose distances to the hub differ by more than a
    link's, are skipped.
    """
    there = seen.select("doc_id").distinct()
    tokens = scratch.write(sets.join(there.hint("merge"), "doc_id", "left_semi").mapInArrow(_shingles, "doc_id long, token long"))
    twice = scratch.write(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token"))
    shared = scratch.write(tokens.join(twice.hint("merge"), "token").groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared")))
    scratch.free(tokens)
    rows = seen.join(shared.hint("merge"), "doc_id").withColumn("inter", F.coalesce("inter", "n")).withColumn("rest", F.col("shared") - F.col("inter"))
    rows = rows.filter(f"100 * shared >= {PERCENT} * n").withColumn("bucket", F.floor(F.col("d") / F.lit(STEP)).cast("int"))
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "component", "n", "d", "inter", "rest")]
    left = rows.filter("component <> hub_component").select("hub", *side("a"), F.explode(F.array(F.col("bucket") - 1, F.col("bucket"), F.col("bucket") + 1)).alias("bucket"))
    right = rows.select("hub", *side("b"), "bucket")
    common = "least(inter_a, inter_b) + least(rest_a, rest_b)"
    met = left.join(right.hint("merge"), ["hub", "bucket"]).filter(f"component_a <> component_b and abs(d_a - d_b) <= {STEP} + 1e-9 and {100 + PERCENT} * ({common}) >= {PERCENT} * (n_a + n_b)")
    pairs = met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()
    known = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = scratch.write(pairs.join(known.hint("merge"), ["a", "b"], "left_anti"))
    return scratch.write(compare(pairs, sets).filter(LINKED).select("a", "b"))


LINKED = f"100 * inter >= {PERCENT} * uni"
#: Distances to a hub are compared by steps of STEP, the largest distance of a link.
STEP = 1 - PERCENT / 100


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_id (smallest id of its set)."""
    ship(spark)
    scratch = Scratch(spark, "jaccard-join")
    texts = _texts(docs, id_col, text_col)
    made = scratch.write(texts.mapInArrow(_sets, "doc_id long, n long, s1 long, s2 long, prefix array<long>"))
    members = scratch.write(made.select("doc_id", "n", "s1", "s2"))
    classes = scratch.write(members.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("class_id")))

    # 2. shared shingles and index entries
    entries = made.filter("n > 0").select("doc_id", "n", "s1", F.explode("prefix").alias("token"))
    shared = scratch.write(entries.groupBy("token").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi"), F.count(F.lit(1)).alias("df")).filter("lo <> hi").select("token", "df"))
    found = may_join(entries, "token", shared).join(shared.hint("merge"), "token")
    per_doc = found.groupBy("doc_id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("s"))
    per_doc = per_doc.filter(F.size("s") >= least_shared())
    reps = classes.select(F.col("class_id").alias("doc_id"))
    chosen = F.slice("s", F.lit(1), (F.size("s") - least_shared() + 1).cast("int"))
    # mean count over the prefix, shingles of its own counting nothing: the source of a group of copies is the most central
    central = F.aggregate("s", F.lit(0.0), lambda t, x: t + x["df"]) / F.expr(PREFIX)
    indexed = scratch.write(per_doc.join(reps.hint("merge"), "doc_id", "left_semi").select("doc_id", "n", central.alias("central"), F.transform(chosen, lambda x: x["token"]).alias("tokens")))
    scratch.free(made)

    # 3. blocks and hubs
    block = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    lists = indexed.select("doc_id", block.alias("block"), "central", F.explode("tokens").alias("token"))
    hubs = scratch.write(lists.groupBy("token", "block").agg(F.max(F.struct("central", (-F.col("doc_id")).alias("id"))).alias("h")).select("token", "block", (-F.col("h.id")).alias("hub")))
    own = hubs.select("token", "block", "hub")
    lower = hubs.select("token", (F.col("block") + 1).alias("block"), F.col("hub").alias("lower_hub"))
    placed = lists.select("token", "block", "doc_id").join(own.hint("merge"), ["token", "block"]).join(lower.hint("merge"), ["token", "block"], "left")
    placed = scratch.write(placed.select("token", "block", "doc_id", "hub", "lower_hub"))
    to_hub = placed.select(F.col("doc_id").alias("a"), F.explode(F.array("hub", "lower_hub")).alias("b")).filter("b is not null and a <> b").distinct()
    pairs = scratch.write(to_hub)
    wanted = scratch.write(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    sets = scratch.write(may_join(texts, "doc_id", wanted).join(wanted.hint("merge"), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_whole_sets, "doc_id long, whole binary"))
    near = scratch.write(compare(pairs, sets))
    links = near.filter(LINKED).select("a", "b")
    first = components(links, scratch)

    # 4. pairs that the hubs leave open; a hub sees the sets that were compared with it, and itself
    sizes = indexed.select("doc_id", "n")
    itself = near.select(F.col("b").alias("hub")).distinct().select("hub", F.col("hub").alias("doc_id"), F.lit(None).cast("long").alias("inter"), F.lit(0.0).alias("d"))
    seen = near.select(F.col("b").alias("hub"), F.col("a").alias("doc_id"), "inter", (1 - F.col("inter") / F.col("uni")).alias("d")).unionByName(itself)
    of = lambda c, name: first.select(F.col("node").alias(c), F.col("component").alias(name)).hint("merge")
    seen = seen.join(of("doc_id", "component"), "doc_id", "left").join(of("hub", "hub_component"), "hub", "left").withColumns({"component": F.coalesce("component", "doc_id"), "hub_component": F.coalesce("hub_component", "hub")})
    seen = scratch.write(seen)
    hubs = scratch.write(seen.filter("component <> hub_component").select("hub").distinct())
    seen = scratch.write(seen.join(hubs.hint("merge"), "hub", "left_semi").join(sizes.hint("merge"), "doc_id"))
    found = first
    if not seen.isEmpty():
        more = _open_links(seen, sets, near, scratch)
        if not more.isEmpty():
            found = components(links.union(more), scratch)

    named = classes.join(found.select(F.col("node").alias("class_id"), "component").hint("merge"), "class_id", "left")
    named = scratch.write(named.select("s1", "s2", "class_id", F.coalesce("component", "class_id").alias("component_id")))
    full = members.filter("n > 0").join(named.hint("merge"), ["s1", "s2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id")
    empty = members.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c)).alias(c)
    return full.unionByName(empty).select(known("doc_id"), "n_shingles", known("component_id"), known("class_id"))
