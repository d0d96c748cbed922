"""Numbers in prose and cells: amounts, share counts, price ranges and ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree.functions.text import at, piece


def number(x: Column, drop: str = ",$") -> Column:
    """A double without the dropped characters; 0 where that is none."""
    cleaned = F.regexp_replace(F.trim(x), f"[{drop}]", "") if drop else F.trim(x)
    return F.coalesce(cleaned.try_cast("double"), F.lit(0.0))


def digits_only(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "").try_cast("bigint")


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin("1", "true"), F.lit(False))


_NUM = r"((?:\d|,(?=\d{3}))+(?:\.\d+)?)"


def price_range(text: Column) -> Column:
    """struct<low, high> of "from $a to $b" (or "ranging from"), nulls without one."""
    def one(word: str) -> Column:
        return F.replace(F.regexp_extract(text, rf"(?i){word} \$" + _NUM, 1), F.lit(","), F.lit("")).try_cast("double")

    return F.struct(one("from").alias("low"), one("to").alias("high"))


def repaired_price(price: Column, low: Column, high: Column) -> Column:
    """The middle of the range in place of a price over ten times its top or under a tenth of its bottom."""
    wrong = (price > 10 * high) | ((price > 0) & (price < 0.1 * low))
    return F.when(wrong, (low + high) / 2).otherwise(price)


_DOLLAR = r"(?s)\$\s*([\d,]*\d(?:\.\d+)?|\.\d+)"


def first_dollar(text: Column, tail: int = 12, words: tuple[tuple[str, float], ...] = (("billion", 1e9), ("million", 1e6))) -> Column:
    """The first dollar amount, times the multiplier that its next characters name; null without one."""
    value = F.replace(F.regexp_extract(text, _DOLLAR, 1), F.lit(","), F.lit("")).try_cast("double")
    after = F.lower(F.regexp_extract(text, _DOLLAR + f"(.{{0,{tail}}})", 2))
    times = F.lit(1.0)
    for word, by in reversed(words):
        times = F.when(F.contains(after, F.lit(word)), F.lit(by)).otherwise(times)
    return value * times


def plain_dollar(text: Column, place: Column, window: int) -> Column:
    """The first dollar amount within the window after a place, as written."""
    return F.replace(F.regexp_extract(piece(text, place, window), _DOLLAR, 1), F.lit(","), F.lit("")).try_cast("double")


def dollar_after(text: Column, lower: Column, label: str, window: int = 120) -> Column:
    start = at(lower, label)
    return first_dollar(piece(text, start, window + len(label)))


def dollar_before(text: Column, lower: Column, label: str, window: int = 40) -> Column:
    """The last dollar amount in the window before a label."""
    end = at(lower, label)
    start = F.greatest(end - window, F.lit(0))
    return F.replace(F.regexp_extract(piece(text, start, end - start), r"(?s).*\$\s*([\d,]*\d(?:\.\d+)?)", 1), F.lit(","), F.lit("")).try_cast("double")


def shares_near(text: Column, lower: Column, labels: list[str], window: int = 120) -> Column:
    """The first whole number of at least 1000 in the window after a label."""
    def one(label: str) -> Column:
        numbers = F.regexp_extract_all(piece(text, at(lower, label), window + len(label)), F.lit(r"(?<![\d.$])(\d{1,3}(?:,\d{3})+|\d+)"), F.lit(1))
        values = F.transform(numbers, lambda n: F.replace(n, F.lit(","), F.lit("")).try_cast("double"))
        return F.try_element_at(F.filter(values, lambda v: v >= 1000), F.lit(1))

    return F.coalesce(*[one(x) for x in labels])


def _first(labels: list[str], one: Callable[[Column], Column]) -> Column:
    """one of the first label that gives a value."""
    return F.try_element_at(F.array_compact(F.transform(F.array(*[F.lit(x) for x in labels]), one)), F.lit(1))


def money_near(text: Column, lower: Column, labels: list[str], window: int = 140) -> Column:
    return _first(labels, lambda x: first_dollar(piece(text, at(lower, x), F.length(x) + window)))


def nearest_decimal(text: Column, lower: Column, labels: list[str], window: int = 60) -> Column:
    """The decimal under 1000 nearest a label; one in parentheses is a loss."""
    form = r"(?s)\G(.*?)(\(?\$?\s?\(?\d+\.\d+)"

    def one(label: Column) -> Column:
        place = at(lower, label)
        start = F.greatest(place - window, F.lit(0))
        around = piece(text, start, place + F.length(label) + window - start)
        marks, found = (F.regexp_extract_all(around, F.lit(form), F.lit(g)) for g in (1, 2))
        ends = F.aggregate(F.arrays_zip(marks.alias("m"), found.alias("f")), F.struct(F.lit(0).alias("p"), F.array().cast("array<struct<d:int,v:double>>").alias("o")), lambda a, x: _step(a, x, place - start), lambda a: a["o"])
        return F.try_element_at(F.array_sort(ends), F.lit(1))["v"]

    return _first(labels, one)


def _step(acc: Column, x: Column, place: Column) -> Column:
    start = acc["p"] + F.length(x["m"])
    value = F.regexp_extract(x["f"], r"(\d+\.\d+)", 1).try_cast("double")
    signed = F.when(F.contains(x["f"], F.lit("(")), -value).otherwise(value)
    near = F.array(F.struct(F.abs(start - place).cast("int").alias("d"), signed.alias("v")))
    return F.struct((start + F.length(x["f"])).cast("int").alias("p"), F.when(value < 1000, F.concat(acc["o"], near)).otherwise(acc["o"]).alias("o"))


def clean_money(cell: Column) -> Column:
    """A table cell's amount: a dash is 0; signs, brackets and marks are left out; a bracketed footnote number or other text is null."""
    x = F.trim(cell)
    kept = F.regexp_replace(x, r"[$,()*†‡ ]", "")
    return F.when(x.isin("-", "—", "–"), F.lit(0.0)).when(~x.rlike(r"^\(\d{0,2}\)$") & kept.rlike(r"^[\d.]+$"), kept.try_cast("double"))


def clean_numeric(token: Column) -> Column:
    """A token's digits and dots without signs and marks; empty where anything else is in it."""
    kept = F.regexp_replace(token, r"[,$% *†‡()]", "")
    return F.when(kept.rlike(r"^[\d.]*$"), kept).otherwise(F.lit(""))


def share_count(cell: Column) -> Column:
    return F.when(cell.rlike(r"^[\d, ]+$"), F.expr("1") * F.regexp_replace(cell, "[, ]", "").try_cast("double")).otherwise(F.lit(None).cast("double"))


def shortest(x: Column) -> Column:
    """The shortest text that reads back as the same double, maybe with an exponent. Spark's own text is it up to 15 digits; a longer one may have digits too many (2E23, say). Numbers under 1E-307 keep Spark's text."""
    text = x.cast("string")
    forms = [F.format_string(f"%.{n}e", x) for n in (14, 15, 16)]
    return F.when(F.length(text) <= 16, text).otherwise(F.coalesce(*[F.when(f.try_cast("double") == x, f) for f in forms], text))


def plain_decimal(x: Column) -> Column:
    """A double as the shortest decimal that reads back, without an exponent and without a trailing .0."""
    text = F.replace(F.upper(shortest(x)), F.lit("E+"), F.lit("E"))
    digits = F.regexp_replace(F.replace(F.regexp_extract(text, r"^-?(\d\.\d+)E", 1), F.lit("."), F.lit("")), r"(?<=\d)0+$", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    large = F.when(F.length(digits) > power + 1, F.concat(F.substring(digits, F.lit(1), power + 1), F.lit("."), F.substring(digits, power + 2, F.lit(20)))).otherwise(F.rpad(digits, power + 1, "0"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    sign = F.when(F.startswith(text, F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return F.when(power.isNull(), F.regexp_replace(x.cast("string"), r"\.0$", "")).otherwise(F.concat(sign, F.when(power >= 0, large).otherwise(small)))


def format_float(x: Column) -> Column:
    """Text for CSV export: empty for null and 0, whole numbers without a point, else the shortest decimal without an exponent."""
    return F.when(x.isNull() | (x == 0), F.lit("")).otherwise(plain_decimal(x.cast("double")))


def ratio_to_one(text: Column) -> Column:
    """N of "N to 1" or "N:1" within 220 characters after "ratio", from 2 on: the first that is no year and 100,000 at the most, else the first that is spelled out ("N to 1"), whatever its size."""
    windows = F.regexp_extract_all(text, F.lit(r"(?is)ratio(?=(.{0,215}))"), F.lit(1))
    stated = lambda w, one: F.replace(F.regexp_extract(w, rf"(?is)([\d,.]*\d)(?:{one})(?!\d)", 1), F.lit(","), F.lit("")).try_cast("double")
    likely = F.filter(F.transform(windows, lambda w: stated(w, " to 1|-to-1| ?: ?1")), lambda v: (v >= 2) & (v <= 100_000) & ~v.between(1900, 2100))
    spelled = F.filter(F.transform(windows, lambda w: stated(w, " to 1|-to-1")), lambda v: v >= 2)
    return F.coalesce(F.try_element_at(likely, F.lit(1)), F.try_element_at(spelled, F.lit(1)))
