"""The registered queries over the supplied tables, and their DuckDB SQL."""

from . import events, feeds, network, places, rules, runs, state, texts  # noqa: F401
from .common import QUERIES, SQL


def queries():
    return QUERIES


def oracle_sql():
    return SQL
