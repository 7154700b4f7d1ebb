"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
it kept; all but the last return the columns of ``documents``.  Quality rules
and exact dedup judge row by row, whatever the rows' ids: of equal texts one
row stays.  Near copies and passages go by id: rows that share one count as one
document, and rows without an id are kept there.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import exact_dedup, jaccard_join, packing, quality, suffix_dedup
from tallyfold.llm.bitmap import without
from tallyfold.llm.scratch import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the current policy of the rule ledger keeps; the ledger is stored, then the policy applied to it."""
    rows = exact_dedup.numbered(docs, "_row")
    led = Scratch(spark, "pipeline-ledger").write(quality.ledger(rows, keep=["_row"]))
    return without(rows, "_row", quality.verdict(led).filter("not kept").select("_row")).drop("_row")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id; of rows with one id and text, or without an id, one."""
    rows = exact_dedup.numbered(docs, "_row")
    gone = Scratch(spark, "pipeline-exact").write(exact_dedup.dedup(spark, rows, row_col="_row").filter("not kept").select("_row"))
    return without(rows, "_row", gone).drop("_row")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked texts the document with the smallest id."""
    gone = Scratch(spark, "pipeline-near").write(jaccard_join.join(spark, docs).filter("doc_id <> component_id").select("doc_id"))
    return without(docs, "doc_id", gone)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they occur first; a document of nothing else goes."""
    spans = Scratch(spark, "pipeline-spans").write(suffix_dedup.repeated_spans(spark, docs))
    return suffix_dedup.remove_copies(docs, spans)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies), ("suffix_array_dedup", repeated_passages), ("packing", packed)]

#: SQL has no tokeniser and no exact form of the passages' removal; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
