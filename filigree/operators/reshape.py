"""Reshaping: flags to rows, provenance, running values, stars, tops and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROVENANCE = ["source_form", "source_accession", "source_document", "source_url", "source_lot", "source_page", "source_paragraph", "source_extracted_at"]


def flags_to_rows(rows: DataFrame, flags: dict[str, str], into: str) -> DataFrame:
    """A row for each flag (column -> label) that is set."""
    labels = F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(label)) for c, label in flags.items()]))
    return rows.withColumn(into, F.explode(labels)).drop(*flags)


def provenance(form: Column, accession: Column, document: Column, url: Column, lot: Column | None = None, page: Column | None = None, paragraph: Column | None = None, extracted_at: str = "") -> list[Column]:
    """The eight provenance columns that end every fact row."""
    given = [form, accession, document, url, lot, page, paragraph, F.lit(extracted_at)]
    return [(F.lit(None) if c is None else c).cast("string").alias(n) for n, c in zip(PROVENANCE, given)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sorted_columns(df: DataFrame, last: str = "wkt_geometry") -> DataFrame:
    names = sorted(c for c in df.columns if c != last)
    return df.select(*names, *[c for c in df.columns if c == last])


def carry_forward(rows: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """The last value that isn't null at or before each row of its group."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(w))


def running_pages(lines: DataFrame, is_break: Column, by: str, order: str, into: str = "page") -> DataFrame:
    """The 1-based page of each line: breaks at or before it, plus one."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(into, F.sum(is_break.cast("int")).over(w) + 1)


def lines_after(lines: DataFrame, is_heading: Column, is_end: Column, by: str, order: str, most: int = 500) -> DataFrame:
    """Lines behind the first heading of their group, up to the next end line, most lines at the most (a feature of the scan)."""
    w = Window.partitionBy(by)
    heading = F.min(F.when(is_heading, F.col(order))).over(w)
    marked = lines.withColumn("_h", heading)
    end = F.min(F.when(is_end & (F.col(order) > F.col("_h")), F.col(order))).over(w)
    return marked.withColumn("_e", end).where((F.col(order) > F.col("_h")) & (F.col(order) <= F.col("_h") + most) & (F.col("_e").isNull() | (F.col(order) < F.col("_e")))).drop("_h", "_e")


def top_per_key(rows: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def star(rows: DataFrame, by: str, order: str, member: str) -> DataFrame:
    """(by, hub, member, position): every member but the first, linked to the first."""
    w = Window.partitionBy(by).orderBy(order)
    ranked = rows.withColumns({"hub": F.first(member).over(w), "position": F.row_number().over(w) - 1})
    return ranked.where("position > 0").select(by, "hub", member, "position")


def router(rows: DataFrame, code: str, routes: dict[str, str], into: str) -> DataFrame:
    """Rows whose code has a route, with its name."""
    pairs = [F.lit(x) for kv in routes.items() for x in kv]
    return rows.withColumn(into, F.try_element_at(F.create_map(*pairs), F.col(code))).where(F.col(into).isNotNull())
