"""Text columns: markup removal in seven fixed flavours, names, windows, items and table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flavours of markup removal (fixed values): what a tag becomes, entities decoded, tags that break a line, whether white space collapses.
FLAVOURS = {
    "spaced": (" ", {"&nbsp;": " ", "&#160;": " ", "&#8217;": "'", "&#8216;": "'", "&amp;": "&"}, None, False),
    "paged": (" ", {"&nbsp;": " ", "&#160;": " ", "&quot;": '"', "&apos;": "'", "&amp;": "&"}, "/tr|/p|br|/div|/h1|/h2|/h3", False),
    "joined": ("", {"&nbsp;": " ", "&#160;": " ", "&#xa0;": " ", "&#xA0;": " "}, None, False),
    "lines": (" ", {"&nbsp;": " ", "&#160;": " ", "&#xa0;": " ", "&#xA0;": " ", "&amp;": "&"}, "/?(?:tr|td|th|p|br|li|div)(?![a-z0-9])", False),
    "collapsed": (" ", {"&nbsp;": " ", "&#160;": " ", "&amp;": "&"}, None, True),
    "cells": (" ", {"&nbsp;": " ", "&#160;": " ", "&#8212;": "-", "&#8211;": "-", "&amp;": "&"}, None, True),
    "plain": (" ", {}, None, False),
}
PAGE_MARK = "<<PAGE>>"


def strip_html(html: Column, flavour: str = "spaced") -> Column:
    """Text without tags. A tag left open swallows the rest; a stray > counts as a tag's end, but for "paged", which keeps it."""
    to, entities, breaks, collapse = FLAVOURS[flavour]
    out = html
    if flavour == "paged":
        out = F.regexp_replace(out, r"(?i)<hr[^>]*>", "\n\x01\n")
    if breaks:
        out = F.regexp_replace(out, rf"(?i)<(?:{breaks})[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]*>" if flavour == "paged" else r"<[^>]*>|>", to)
    out = F.regexp_replace(out, r"<[^>]*$", "")
    for entity, char in entities.items():  # the ampersand comes last, so that nothing is decoded twice
        out = F.replace(out, F.lit(entity), F.lit(char))
    if flavour == "paged":
        out = F.replace(out, F.lit("\x01"), F.lit(PAGE_MARK))
    return collapse_ws(out) if collapse else out


def collapse_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalise_name(name: Column) -> Column:
    """ASCII letters and digits in lower case, white space as hyphens, nothing else."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(name, r"(?U)[^A-Za-z0-9\s]", "")), r"(?U)\s", "-"), r"^-+|-+$", "")


def truncate(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…"))).otherwise(text)


def at(text: Column, needle: Column | str) -> Column:
    """0-based place of the first occurrence, null where there is none."""
    place = F.locate(needle, text) if isinstance(needle, str) else F.position(needle, text)
    return F.nullif(place, F.lit(0)) - 1


def piece(text: Column, start: Column, length: Column | int) -> Column:
    """A substring by 0-based start; null where the start is."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.substring(text, (start + 1).cast("int"), F.greatest(n, F.lit(0)).cast("int"))


def window_around(text: Column, place: Column, before: int = 220, after: int = 320) -> Column:
    start = F.greatest(place - before, F.lit(0))
    return piece(text, start, place + after - start)


def first_of(text: Column, needles: list[str]) -> Column:
    """Place of the first needle, in the order given, that occurs."""
    return F.coalesce(*[at(text, n) for n in needles])


def contains_any(text: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(text, F.lit(n))
    return out


def first_label(text: Column, labels: dict[str, str] | list[str], default: str = "") -> Column:
    """The label of the first needle, in the order given, that text contains."""
    pairs = labels.items() if isinstance(labels, dict) else [(x, x) for x in labels]
    out = None
    for needle, label in pairs:
        hit = F.contains(text, F.lit(needle))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(default))


def item_text(text: Column, item: str) -> Column:
    """The body from ITEM n to the next ITEM, else to the signatures, else 2000 characters; null without the item."""
    upper = F.upper(text)
    mark = f"ITEM {item}"
    start = at(upper, mark) + len(mark)
    rest = piece(upper, start, F.length(text))
    length = F.coalesce(at(rest, "ITEM "), at(rest, "\nSIGNATURE"), F.least(F.length(rest), F.lit(2000)))
    return F.trim(F.regexp_replace(piece(text, start, length), r"^[^A-Za-z0-9]+", ""))


def eightk_items(html: Column) -> Column:
    """array<struct<item_code, description>> of a current report, one for each code, in order of code and description."""
    parts = F.split(strip_html(html, "joined"), "Item ")
    form = r"(?s)^(\d)[.\s](\d{2})(?!\d)[\s.]*([A-Z][^.\n]*).*"
    found = F.transform(
        F.filter(F.slice(parts, 2, 1 << 20), lambda p: p.rlike(form)),
        lambda p: F.struct(F.concat_ws(".", F.regexp_extract(p, form, 1), F.regexp_extract(p, form, 2)).alias("item_code"), F.trim(F.regexp_extract(p, form, 3)).alias("description")),
    )
    once = lambda found, codes: F.filter(found, lambda x, i: F.array_position(codes, x["item_code"]) == i + 1)
    both = F.struct(found.alias("found"), F.transform(found, lambda x: x["item_code"]).alias("codes"))
    return F.array_sort(F.element_at(F.transform(F.array(both), lambda b: once(b["found"], b["codes"])), 1))


def is_item_code(text: Column) -> Column:
    return text.rlike(r"^\d\.\d{2}$")


def table_rows(html: Column) -> Column:
    """array<array<string>>: the cells of each table row, empty cells left out."""
    rows = F.split(html, r"(?i)</tr[^>]*>")
    return F.transform(rows, lambda r: F.filter(F.transform(F.split(r, r"(?i)</t[dh][^>]*>"), lambda c: strip_html(c, "cells")), lambda c: c != ""))


def byte_size(n: Column) -> Column:
    """A number of bytes for people: KB and MB with one decimal, GB and TB with two, of 1,024 each; "?" where it isn't known."""
    scaled = lambda power, form: F.format_string(form, n / float(1024**power))
    return F.when(n.isNull(), F.lit("?")).when(n < 1024**2, scaled(1, "%.1f KB")).when(n < 1024**3, scaled(2, "%.1f MB")).when(n < 1024**4, scaled(3, "%.2f GB")).otherwise(scaled(4, "%.2f TB"))
