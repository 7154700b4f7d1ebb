"""What the registered queries share: table reading and a registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import wordrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_words(x: str) -> str:
    """:func:`wordrules.words` in SQL."""
    return f"(' ' || trim(regexp_replace(regexp_replace({x}, '[.!?|\\n]+', ' | ', 'g'), '[^a-z0-9@|]+', ' ', 'g')) || ' ')"


def sql_rule(rule: wordrules.Rule, classes: wordrules.Classes) -> str:
    return wordrules.pattern(rule, classes)


def sql_says(words: str, rules: list[wordrules.Rule], classes: wordrules.Classes) -> str:
    return "(" + " or ".join(f"regexp_matches({words}, {quote(sql_rule(r, classes))})" for r in rules) + ")"
