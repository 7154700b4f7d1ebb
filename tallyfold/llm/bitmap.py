"""A filter of fixed size for rows that a later join would drop.

Hashes of the wanted keys set bits in at most ``2**(log2_bits - 6)`` words of
64 bits; the words are broadcast, which bounds the broadcast whatever the data.
A key without its bit is surely not wanted; the join that follows decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG2_BITS = 25


def _place(key: Column, log2_bits: int) -> Column:
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(1 << log2_bits)))


def bitmap(wanted: DataFrame, key: str, log2_bits: int = LOG2_BITS) -> DataFrame:
    """(_bm_word, _bm_bits): the words of the bitmap of ``wanted``'s keys that have a bit."""
    return wanted.select(_place(F.col(key), log2_bits).alias("_bm_at")).groupBy(F.shiftright("_bm_at", 6).alias("_bm_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bm_at & 63 as int))")).alias("_bm_bits"))


def _marked(rows: DataFrame, key: str, bits: DataFrame, log2_bits: int) -> DataFrame:
    at = _place(F.col(key), log2_bits)
    marked = rows.withColumn("_bm_at", at).withColumn("_bm_word", F.shiftright("_bm_at", 6)).join(F.broadcast(bits), "_bm_word", "left")
    return marked.withColumn("_bm_may", F.coalesce(F.expr("shiftright(_bm_bits, cast(_bm_at & 63 as int)) & 1") == 1, F.lit(False)))


def may_be_in(rows: DataFrame, key: str, bits: DataFrame, log2_bits: int = LOG2_BITS) -> DataFrame:
    """:func:`may_join` with a bitmap that is there already."""
    return _marked(rows, key, bits, log2_bits).filter("_bm_may").select(*rows.columns)


def may_join(rows: DataFrame, key: str, wanted: DataFrame, log2_bits: int = LOG2_BITS) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``wanted``'s."""
    return may_be_in(rows, key, bitmap(wanted, key, log2_bits), log2_bits)


def surely_not(rows: DataFrame, key: str, wanted: DataFrame, log2_bits: int = LOG2_BITS) -> DataFrame:
    """The rows that :func:`may_join` leaves out; null keys are among them."""
    return surely_not_in(rows, key, bitmap(wanted, key, log2_bits), log2_bits)


def surely_not_in(rows: DataFrame, key: str, bits: DataFrame, log2_bits: int = LOG2_BITS) -> DataFrame:
    """:func:`surely_not` with a bitmap that is there already."""
    return _marked(rows, key, bits, log2_bits).filter("not _bm_may").select(*rows.columns)


#: Bits of a row of a dense bitmap, as a power of 2.
CHUNK = 16


def dense_bitmap(wanted: DataFrame, key: str, log2_bits: int) -> DataFrame:
    """(_bm_chunk, _bm_words): a bitmap for many keys as arrays of all of its words, of which a broadcast takes little more than the bits."""
    log2_bits = max(log2_bits, CHUNK)
    at = F.xxhash64(key).bitwiseAND(F.lit((1 << log2_bits) - 1))
    # twice a bit's place and 1, or that of a word's first bit and 0, so that no word lacks
    marks = wanted.filter(F.col(key).isNotNull()).select((2 * at + 1).alias("_bm_at")).union(wanted.sparkSession.range(1 << (log2_bits - 6)).select((F.col("id") * 128).alias("_bm_at")))
    word = F.shiftright("_bm_at", 7).bitwiseAND(F.lit((1 << (CHUNK - 6)) - 1)).cast("int")
    bit = F.expr("shiftleft(_bm_at & 1, cast(shiftright(_bm_at, 1) & 63 as int))")
    marks = marks.withColumn("_bm_chunk", F.shiftright("_bm_at", CHUNK + 1).cast("int")).repartition("_bm_chunk")
    words = marks.groupBy("_bm_chunk", word.alias("_bm_word")).agg(F.bit_or(bit).alias("_bm_bits"))
    return words.groupBy("_bm_chunk").agg(F.sort_array(F.collect_list(F.struct("_bm_word", "_bm_bits"))).alias("_bm_words")).select("_bm_chunk", F.col("_bm_words._bm_bits").alias("_bm_words"))


def may_be_in_dense(rows: DataFrame, key: str, bits: DataFrame, log2_bits: int) -> DataFrame:
    """``rows`` without most of those whose ``key`` has no bit in a dense bitmap."""
    at = F.xxhash64(key).bitwiseAND(F.lit((1 << max(log2_bits, CHUNK)) - 1))
    marked = rows.withColumn("_bm_at", at).withColumn("_bm_chunk", F.shiftright("_bm_at", CHUNK).cast("int")).join(F.broadcast(bits), "_bm_chunk")
    here = f"shiftright(get(_bm_words, cast(shiftright(_bm_at, 6) & {(1 << (CHUNK - 6)) - 1} as int)), cast(_bm_at & 63 as int)) & 1"
    return marked.filter(F.expr(here) == 1).select(*rows.columns)


def without(rows: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``rows`` less those whose ``key`` is in ``dropped``; only rows that may be are shuffled."""
    keys = dropped.select(key)
    return surely_not(rows, key, keys).unionByName(may_join(rows, key, keys).join(keys.hint("merge"), key, "left_anti").select(*rows.columns))
