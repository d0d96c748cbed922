"""Which filings are in scope: slices, fetch buckets, gates and the plan of what to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.functions.dates import year_prefix

#: Fetch buckets and the form names that belong to them, in order (fixed values).
BUCKETS = {
    "form3": ["3", "3/A"],
    "form4": ["4", "4/A"],
    "form5": ["5", "5/A"],
    "form144": ["144", "144/A"],
    "form13f": ["13F-HR", "13F-HR/A"],
    "form8k": ["8-K", "8-K/A"],
    "sc13d": ["SC 13D", "SC 13D/A", "SCHEDULE 13D", "SCHEDULE 13D/A"],
    "sc13g": ["SC 13G", "SC 13G/A", "SCHEDULE 13G", "SCHEDULE 13G/A"],
    "def14a": ["DEF 14A", "DEFA14A", "PRE 14A"],
    "form10k": ["10-K", "10-K/A"],
}
LEAN = ["form3", "form4", "form5", "form8k"]


def in_slice(cik: Column, form: Column, filed: Column, ciks=None, forms=None, years: tuple[int, int] | None = None) -> Column:
    """True where a filing's company, form (as written) and year lie in the slice; an empty part of it admits all."""
    out = F.lit(True)
    if ciks:
        out = out & cik.isin(list(ciks))
    if forms:
        out = out & form.isin(list(forms))
    if years:
        out = out & year_prefix(filed).between(*years)
    return F.coalesce(out, F.lit(False))


def bucket_of(form: Column) -> Column:
    """The fetch bucket of a form name; null for a form without one."""
    pairs = [F.lit(x) for name, forms in BUCKETS.items() for f in forms for x in (f, name)]
    return F.try_element_at(F.create_map(*pairs), form)


def resolve_buckets(forms: list[str] | None) -> tuple[list[str], list[str]]:
    """(buckets in declared order, forms without one); without forms the lean set."""
    if forms is None:
        return list(LEAN), []
    wanted = {b for b, own in BUCKETS.items() if set(own) & set(forms)}
    known = {f for own in BUCKETS.values() for f in own}
    return [b for b in BUCKETS if b in wanted], [f for f in forms if f not in known]


def dispatch_plan(index: DataFrame, years: tuple[int, int] | None = None, ciks=None) -> DataFrame:
    """The rows of a filing index (cik, form_type, filed_date, accession_number, primary_document) to read, with bucket.

    Rows with a malformed company number, a short date, no accession number or a form without a bucket go.
    """
    rows = index.withColumns({"cik": F.col("cik").try_cast("bigint"), "bucket": bucket_of(F.col("form_type"))})
    keep = F.col("cik").isNotNull() & (F.length("filed_date") >= 4) & (F.coalesce("accession_number", F.lit("")) != "") & F.col("bucket").isNotNull()
    return rows.where(keep & in_slice(F.col("cik"), F.col("form_type"), F.col("filed_date"), ciks, None, years))


def plan_totals(plan: DataFrame) -> DataFrame:
    """Filings and distinct companies of each bucket."""
    return plan.groupBy("bucket").agg(F.count("*").alias("filings"), F.countDistinct("cik").alias("ciks"))


def gate(docs: DataFrame, index: DataFrame, key: str = "accession_number", forms=None, form: str = "form_type") -> DataFrame:
    """docs whose key is in the index (of the forms asked for). The join strategy is left to statistics."""
    allowed = index.where(F.col(form).isin(list(forms))) if forms else index
    return docs.join(allowed.select(key), key, "left_semi")


def missing(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requested rows that nothing known matches."""
    return requested.join(known.select(key), key, "left_anti")


def prefer_first(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of first, and those of second whose key first doesn't have."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"))
