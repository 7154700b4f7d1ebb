"""Dates written in several ways; ``today`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keys import fold, once, text
from .lexicon import MONTHS

ISO = r"^\d{4}-\d{2}-\d{2}"
_MONTH = "(" + "|".join(MONTHS) + ")"
LONG_DATE = r"\b([0-3]?\d)(?:er)?\s+" + _MONTH + r"\s+(\d{4})\b"
SHORT_DATE = r"\b([0-3]?\d)(?:er)?\s+" + _MONTH + r"\b"


def iso_date(c: Column | str) -> Column:
    return F.when(F.trim(text(c)).rlike(ISO), F.try_to_date(F.substring(F.trim(text(c)), 1, 10), "yyyy-MM-dd"))


def _mail_body(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^[A-Za-z]{3},\s*", "")


def mail_timestamp(c: Column | str) -> Column:
    """Time of a date as in mail headers; the weekday, which Spark does not parse, goes first."""
    body = _mail_body(text(c))
    return F.coalesce(*[F.try_to_timestamp(body, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss")])


def article_date(c: Column | str) -> Column:
    """Day of an article: its own if written ISO, that in UTC if written as in mail headers (session zone UTC)."""
    return F.coalesce(iso_date(c), F.to_date(mail_timestamp(c)))


def article_date_local(c: Column | str) -> Column:
    """As :func:`article_date`, but a mail header's own day, not shifted to UTC."""
    return F.coalesce(iso_date(c), F.try_to_date(F.regexp_extract(_mail_body(text(c)), r"^(\d{1,2} [A-Za-z]{3} \d{4})", 1), "d MMM yyyy"))


def listed_date(c: Column | str) -> Column:
    """Day in a curated list: ISO, or d/m/yyyy inside a text, a week earlier if the text says so."""
    found = F.try_to_date(F.regexp_extract(text(c), r"(\d{1,2}/\d{1,2}/\d{4})", 1), "d/M/yyyy")
    return F.coalesce(iso_date(c), F.when(fold(c).contains("semaine precedant"), F.date_sub(found, 7)).otherwise(found))


def month_number(c: Column) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), c).cast("int")


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")


def text_date(c: Column | str) -> Column:
    """First "day month year" of a text, null if there is no such day."""
    return once(fold(c), _long_date)


def _long_date(t: Column) -> Column:
    part = lambda i: F.regexp_extract(t, LONG_DATE, i)
    return F.when(t.rlike(LONG_DATE), _day(part(3), month_number(part(2)).cast("string"), part(1)))


def title_date(title: Column | str, published: Column) -> Column:
    """struct(day, inferred): a title's date; a missing year is that of publication, rolled over at 300 days."""

    def read(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, SHORT_DATE, i)
        return F.when(t.rlike(SHORT_DATE), _day(F.year(published).cast("string"), month_number(part(2)).cast("string"), part(1)))

    roll = lambda near: F.when(F.datediff(near, published) > 300, F.add_months(near, -12)).when(F.datediff(published, near) > 300, F.add_months(near, 12)).otherwise(near)
    both = lambda t: F.struct(_long_date(t).alias("whole"), once(read(t), roll).alias("rolled"))
    return once(once(fold(title), both), lambda x: F.struct(F.coalesce(x["whole"], x["rolled"]).alias("day"), (x["whole"].isNull() & x["rolled"].isNotNull()).alias("inferred")))


def temporal_status(day: Column, status: Column, today: Column) -> Column:
    """Upcoming from ``today`` on, closed before; without a day by the announcement's status."""
    return F.when(day >= today, "upcoming").when(day.isNotNull(), "closed").when(status == "project", "upcoming").when(status == "confirmed", "closed").otherwise("unknown")


def effective_date(*days: Column | str) -> Column:
    return F.coalesce(*[text(d) for d in days])


def lookback(amount: int, unit: str, today: Column) -> Column:
    """First day of a window given as days (d), months of 30 days (m) or years of 365 (y)."""
    return F.date_sub(today, amount * {"d": 1, "m": 30, "y": 365}[unit])


def month_ranges(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(lo, hi): half-open ranges, cut at months, that tile the days from start to end."""
    months = F.explode(F.sequence(F.trunc(F.lit(start).cast("date"), "MM"), F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("m")
    rows = spark.range(1).select(months)
    return rows.select(F.greatest(F.lit(start).cast("date"), "m").alias("lo"), F.least(F.add_months("m", 1).cast("date"), F.date_add(F.lit(end).cast("date"), 1)).alias("hi"))
