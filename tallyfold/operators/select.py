"""Samples, rotating batches, caps and generated search queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import loose_key


def among(rows: DataFrame, key: str, small: DataFrame, most: int = 100_000) -> DataFrame:
    """Rows whose ``key`` is in ``small``, which is broadcast if it has ``most`` rows at most; else both are shuffled."""
    keys = small.select(key).distinct()
    hint = "broadcast" if keys.limit(most + 1).count() <= most else "merge"
    return rows.join(keys.hint(hint), key, "left_semi")


def evenly_spaced(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """``k`` rows evenly spaced in ``order``, first and last among them; all if there are no more, the first for k = 1.

    The rows are those of a catalogue of snapshots, which one task can rank.
    """
    if k <= 0:
        return df.limit(0)
    ranked = df.withColumn("_i", F.row_number().over(Window.orderBy(*order)) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    if k == 1:
        return ranked.filter("_i = 0").drop("_i", "_n")
    places = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / (k - 1), 0).cast("int"))
    return ranked.filter((F.col("_n") <= k) | F.array_contains(places, F.col("_i"))).drop("_i", "_n")


def rotating_batch(df: DataFrame, position: str, k: int, turn: int) -> DataFrame:
    """``k`` rows from ``turn * k`` on, around the end; ``position`` counts from 0 without gaps."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    return df.crossJoin(F.broadcast(n)).filter(F.pmod(F.col(position) - F.lit(turn * k) % F.col("_n"), F.col("_n")) < k).drop("_n")  # one row


def week_turn(year: int, week: int) -> int:
    return year * 53 + week


def cap(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group; ``order`` must leave no ties."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= most).drop("_rn")


def queries_of(items: DataFrame, key: list[str], templates: DataFrame, k: int) -> DataFrame:
    """``items`` with the queries of the templates (pattern, pos, is_site), text and site queries interleaved, ``k`` distinct ones each.

    A pattern names columns in braces.  ``templates`` is a hand-written list.
    """
    made = items.crossJoin(F.broadcast(templates))
    q = F.col("pattern")
    for c in items.columns:
        q = F.replace(q, F.lit("{" + c + "}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    made = made.withColumn("query", F.trim(F.regexp_replace(q, r"\s+", " "))).withColumn("rank", 2 * F.col("pos") + F.col("is_site").cast("int"))
    once = made.groupBy(*key, "query").agg(F.min("rank").alias("rank"))
    return cap(once, key, [F.col("rank"), F.col("query")], k)


def search(queries: DataFrame, entries: DataFrame, least: float, k: int) -> DataFrame:
    """(query_id, url, share): entries that hold at least ``least`` of a query's tokens, the best ``k`` of each query.

    A token inside a longer word counts too: of the distinct words of titles and
    tokens, each word's substrings of the tokens' lengths meet the tokens by
    equality, and the tokens' words lead back to the entries.  Tokens hold no space.
    """
    from .triage import overlap

    tokens = queries.select("query_id", F.explode("tokens").alias("token")).distinct()
    sizes = tokens.agg(F.sort_array(F.collect_set(F.length("token"))).alias("_sizes"))
    words = entries.select("url", "title_key", F.explode(F.array_distinct(F.split("title_key", " "))).alias("w"))
    cut = lambda n: F.when(F.length("w") >= n, F.transform(F.sequence(F.lit(1), F.length("w") - n + 1), lambda i: F.substr("w", i, n))).otherwise(F.array().cast("array<string>"))
    parts = words.select("w").distinct().crossJoin(F.broadcast(sizes))  # one row
    parts = parts.select("w", F.explode(F.array_distinct(F.flatten(F.transform("_sizes", cut)))).alias("token"))
    held = parts.join(tokens.select("token").distinct().hint("merge"), "token")
    met = tokens.join(held.hint("merge"), "token").join(words.hint("merge"), "w").select("query_id", "url", "title_key").distinct()
    scored = met.join(queries.select("query_id", "tokens").hint("merge"), "query_id").withColumn("share", overlap(F.col("tokens"), F.col("title_key"))).filter(F.col("share") >= least)
    return cap(scored.select("query_id", "url", "share").distinct(), ["query_id"], [F.desc("share"), F.col("url")], k)


# Words of a query that tell nothing.
STOP_WORDS = ["de", "la", "le", "les", "du", "des", "un", "une", "et", "au", "aux", "en", "dans", "son", "sa", "ses", "cette", "agence", "site", "https", "http", "www", "com", "fr"]


def query_tokens(query: Column) -> Column:
    """Words of three letters or more that are no stop words, without what ``site:`` names."""
    words = F.split(loose_key(F.regexp_replace(F.coalesce(query, F.lit("")), r"site:\S+", " ")), " ")
    return F.filter(words, lambda t: (F.length(t) >= 3) & ~t.isin(STOP_WORDS))


def site_domains(query: Column) -> Column:
    """Domains that a query names by ``site:``, in order, each once, without ``*.``."""
    found = F.regexp_extract_all(F.coalesce(query, F.lit("")), F.lit(r"(?i)(?<![\w])site:([^\s\"']+)"), 1)
    return F.array_distinct(F.filter(F.transform(found, lambda d: F.regexp_replace(F.regexp_replace(d, r"^[()\[\]{}.,;]+|[()\[\]{}.,;]+$", ""), r"^\*\.", "")), lambda d: d != ""))


def site_search(queries: DataFrame, entries: DataFrame, domains: list[str], most_domains: int = 2, per_path: int = 200, least: float = 0.6, k: int = 10) -> DataFrame:
    """(query_id, rank, url) of the entries that answer each query (query_id, query), ``k`` at most.

    A query asks the domains that it names, then ``domains``, ``most_domains``
    of them.  Of each path of a domain the first ``per_path`` entries (domain,
    path, pos, url, title) are read; those count whose address and title hold
    at least ``least`` of the query's tokens, as words or inside of them.
    Domains come first in the order, then paths and positions; an address that
    comes again does not count.  The caps are those of the search itself.  A
    query without tokens finds nothing.
    """
    asked = queries.select("query_id", query_tokens(F.col("query")).alias("_tokens"), F.slice(F.array_distinct(F.concat(site_domains(F.col("query")), F.array(*[F.lit(d) for d in domains]).cast("array<string>"))), 1, max(1, most_domains)).alias("_domains"))
    asked = asked.filter(F.size("_tokens") > 0).select("query_id", "_tokens", F.posexplode("_domains").alias("_d", "domain"))
    read = cap(entries.filter("url <> ''"), ["domain", "path"], [F.col("pos"), F.col("url")], per_path).withColumn("_key", loose_key(F.concat_ws(" ", "url", "title")))
    met = asked.join(read.hint("merge"), "domain")
    share = F.size(F.filter("_tokens", lambda t: F.contains(F.col("_key"), t))) / F.size("_tokens")
    place = F.struct(F.col("_d"), F.col("path"), F.col("pos"), F.col("url"))
    once = met.filter(share >= least).groupBy("query_id", "url").agg(F.min(place).alias("_p"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("_p")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "url")
