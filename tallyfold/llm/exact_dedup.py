"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest.  Documents come in loads,
by ranges of their ids, smaller ids first.  Each load is reduced to one row per
digest, the digests that the index has are taken out by a sort-merge anti-join,
and the rest is appended, so an old index is never rewritten or shuffled.

Defined cases: a null text counts as empty; empty texts form one group; of rows
that share an id and a text one stays, and each counts in ``group_size``; a row
with a null id stays only if its group has no other; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

BUCKETS = 64
#: A digest with more than one row in HOT_SHARE of the load is joined by broadcast; there are fewer than HOT_SHARE of those.
HOT_SHARE = 1000
#: Loads that documents come in.
LOADS = 2


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that tells rows apart and is the same each time it is read: the row's place in its file.

    Rows that come from no file are written out first.
    """
    place = lambda df: df.withColumn(name, F.concat_ws(":", "_metadata.file_path", "_metadata.row_index"))
    try:
        return place(docs)
    except AnalysisException:
        return place(Scratch(docs.sparkSession, "numbered").write(docs))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, row, text_sha256); ``row`` tells rows of one id apart: ``row_col`` if given, else a number that holds once the table is written."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))


def append_new(spark: SparkSession, load: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Appends the digests of ``load`` (one row each: text_sha256, keep_id) that ``table`` lacks; makes the table at first."""
    new = load.select("text_sha256", "keep_id")
    if spark.catalog.tableExists(table):
        index = spark.table(table).select("text_sha256")
        new = new.join(index.hint("merge"), "text_sha256", "left_anti")
    (new.repartition(buckets, "text_sha256").write.mode("append").bucketBy(buckets, "text_sha256").sortBy("text_sha256").saveAsTable(table))


def loads_of(rows: DataFrame, loads: int) -> list[DataFrame]:
    """``rows`` in ranges of ids of equal width, ascending; null ids come last."""
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or loads < 2:
        return [rows]
    cuts = [low + (high - low + 1) * k // loads for k in range(1, loads)]
    part = sum((F.when(F.col("doc_id") < c, 0).otherwise(1) for c in cuts), F.lit(0))
    return [rows.filter(part == k) for k in range(loads)]


def dedup(spark: SparkSession, docs: DataFrame, table: str | None = None, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, loads: int = LOADS, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and ``row_col`` if given (see :func:`numbered`).

    keep_id is the smallest id of the digest in the first load that had it;
    group_size counts rows of ``docs``.  Without ``table`` the index is
    made for this call and dropped.
    """
    scratch = Scratch(spark, "exact-dedup")
    rows = scratch.write(digests(docs, id_col, text_col, row_col))
    index_name = table or f"digest_index_{uuid.uuid4().hex}"
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "row")).alias("first")
    for part in loads_of(rows, loads):
        append_new(spark, part.groupBy("text_sha256").agg(first).select("text_sha256", F.col("first.doc_id").alias("keep_id")), index_name, buckets)
    index = spark.table(index_name).select("text_sha256", F.col("keep_id").alias("index_id"))
    sizes = rows.groupBy("text_sha256").agg(first, F.count(F.lit(1)).alias("group_size"))
    groups = sizes.join(index.hint("merge"), "text_sha256")
    groups = scratch.write(groups.select("text_sha256", F.col("index_id").alias("keep_id"), "group_size", F.when(F.col("first.doc_id").eqNullSafe(F.col("index_id")), F.col("first.row")).alias("keep_row")))
    if table is None:
        spark.sql(f"drop table {index_name}")
    floor = rows.count() // HOT_SHARE
    group = F.struct("keep_id", "group_size", "keep_row")
    hot = groups.filter(F.col("group_size") > floor).select("text_sha256", group.alias("hot"))
    # fewer than HOT_SHARE + 1 groups can exceed the floor, so this broadcast is bounded
    marked = rows.join(F.broadcast(hot), "text_sha256", "left")
    cold = marked.filter("hot is null").select("doc_id", "row", "text_sha256").join(groups.select("text_sha256", group.alias("g")).hint("merge"), "text_sha256")
    both = marked.filter("hot is not null").select("doc_id", "row", "text_sha256", F.col("hot").alias("g")).unionByName(cold)
    rest = [F.col("row").alias(row_col)] if row_col else []
    return both.select("doc_id", "g.keep_id", "g.group_size", F.coalesce(F.col("row") == F.col("g.keep_row"), F.lit(False)).alias("kept"), "text_sha256", *rest)
