"""Dates in columns and prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree.functions.text import at, piece

MONTHS = "January February March April May June July August September October November December".split()
EPOCH_MS_FROM = 946_684_800_000
DATE_SUFFIXES = ("date", "from", "to", "updated")


def epoch_ms_date(x: Column) -> Column:
    """yyyy-MM-dd (UTC) of milliseconds since 1970."""
    return F.date_format(F.timestamp_millis(x), "yyyy-MM-dd")


def is_date_column(name: str) -> bool:
    return name.lower().endswith(DATE_SUFFIXES)


def safe_year(x: Column) -> Column:
    return F.year(F.try_to_date(x, "yyyy-MM-dd"))


def year_prefix(x: Column) -> Column:
    return F.when(F.substring(x, 1, 4).rlike(r"^\d{4}$"), F.substring(x, 1, 4).cast("int"))


#: Four digits, and such that are no amount after a dollar sign and no side of a ratio.
ANY_YEAR = r"(?<!\d)(\d{4})(?!\d)"
NO_AMOUNT = r"(?<!\d)(?<!\$\s{0,3})(\d{4})(?!\d| to 1(?!\d)|-to-1(?!\d)| ?: ?1(?![\d,.]*\d))"


def years(text: Column, low: int, high: int, form: str = ANY_YEAR) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(form), F.lit(1)), lambda y: y.cast("int"))
    return F.filter(found, lambda y: y.between(low, high))


def first_year(text: Column) -> Column:
    return F.try_element_at(years(text, 1990, 2099), F.lit(1))


def max_year(text: Column, place: Column | None = None, window: int = 0, form: str = ANY_YEAR) -> Column:
    return F.array_max(years(text if place is None else piece(text, F.greatest(place, F.lit(0)), window), 2010, 2099, form))


def month_date(text: Column) -> Column:
    """The first "Month DD, YYYY" of the earliest month of the year that occurs with a year; null without one."""
    def one(month: Column) -> Column:
        tail = piece(text, at(text, month), 20)
        return F.when(F.size(years(tail, 1990, 2099)) > 0, F.trim(F.regexp_extract(piece(tail, F.lit(0), 18), r"(?s)^([^.]*)", 1)))

    return F.try_element_at(F.array_compact(F.transform(F.array(*[F.lit(m) for m in MONTHS]), one)), F.lit(1))


def effective_date(text: Column) -> Column:
    """A date after "effective", else any date, else empty."""
    start = at(F.lower(text), "effective") + 9
    return F.coalesce(month_date(piece(text, start, F.length(text))), month_date(text), F.lit(""))


def period_end(text: Column, lower: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_extract(piece(text, at(lower, "ended") + 5, 19), r"^\s*([A-Z][a-z]+ \d{1,2},? \d{4})", 1)), F.lit(""))


def http_date(text: Column) -> Column:
    """The time of an HTTP date header, as in "Tue, 15 Nov 1994 08:12:31 GMT"; null where it is none."""
    return F.try_to_timestamp(F.regexp_extract(text, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))


def quarter_of(day: Column) -> Column:
    """struct<year, quarter> that a day lies in."""
    return F.struct(F.year(day).alias("year"), F.quarter(day).alias("quarter"))


def years_back(wanted: int | str | None, this_year: int, first: int = 1993) -> int:
    """How many years of the index are asked for: a number, "all" since the first, none without one."""
    if wanted is None:
        return 0
    if wanted == "all":
        return this_year - first + 1
    if isinstance(wanted, str) or wanted < 0:
        raise ValueError(f"years must be a whole number from 0 on or 'all'; got {wanted!r}")
    return wanted
