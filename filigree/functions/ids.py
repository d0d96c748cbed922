"""Identifiers: registry numbers, accession numbers, paths and archive addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCHIVES = "https://www.sec.gov/Archives/edgar/data"


def strip_leading_zeros(x: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(x, "^0+", ""), F.lit("")), F.lit("0"))


def person_id(registry_number: Column) -> Column:
    return F.concat(F.lit("cik-"), registry_number)


def insert_accession_dashes(x: Column) -> Column:
    """10-2-6 digits with dashes; anything that isn't 18 digits stays."""
    return F.regexp_replace(x, r"^(\d{10})(\d{2})(\d{6})$", "$1-$2-$3")


def strip_accession_dashes(x: Column) -> Column:
    return F.replace(x, F.lit("-"), F.lit(""))


def pad_registry_number(x: Column) -> Column:
    """Ten digits from a number or text with digits; empty without any."""
    digits = F.regexp_replace(x.cast("string"), r"\D", "")
    return F.when(digits == "", F.lit("")).otherwise(F.lpad(digits, 10, "0"))


def archives_url(registry_number: Column, accession: Column, document: Column) -> Column:
    return F.concat_ws("/", F.lit(ARCHIVES), strip_leading_zeros(registry_number), strip_accession_dashes(accession), document)


def archives_path(registry_number: Column, accession: Column, document: Column) -> Column:
    """A document's path in the archives, as provenance has it."""
    return F.concat_ws("/", F.lit("/Archives/edgar/data"), F.regexp_replace(registry_number, "^0+", ""), strip_accession_dashes(accession), document)


def filing_path_parts(path: Column) -> Column:
    """struct<cik, accession, document> of .../{cik}/{accession}/{document}."""
    parts = F.split(path, "/")
    return F.struct(F.try_element_at(parts, F.lit(-3)).alias("cik"), F.try_element_at(parts, F.lit(-2)).alias("accession"), F.try_element_at(parts, F.lit(-1)).alias("document"))


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1)


def is_ownership_xml(name: Column) -> Column:
    return name.endswith(".xml")


def is_information_table(name: Column) -> Column:
    """An XML name with 13f, 13F or infotable in it."""
    return name.endswith(".xml") & name.rlike("13[fF]|infotable")


def is_prose(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(?:html?|txt)$")


def is_exhibit21(name: Column) -> Column:
    return is_prose(name) & F.lower(name).rlike("ex(?:hibit)?-?21")


def former_names(names: Column) -> Column:
    """"N (from A, until B)" for each struct<name, from, to>, joined by "; "; missing dates are left out."""

    def one(x):
        dates = F.array_compact(F.array(F.when(F.coalesce(x["from"], F.lit("")) != "", F.concat(F.lit("from "), x["from"])), F.when(F.coalesce(x["to"], F.lit("")) != "", F.concat(F.lit("until "), x["to"]))))
        return F.when(F.size(dates) > 0, F.concat(x["name"], F.lit(" ("), F.array_join(dates, ", "), F.lit(")"))).otherwise(x["name"])

    return F.coalesce(F.array_join(F.transform(names, one), "; "), F.lit(""))


def company_json_url(registry_number: Column, kind: str = "submissions") -> Column:
    """The address of a company's record ("submissions") or of its facts ("api/xbrl/companyfacts")."""
    return F.concat(F.lit(f"https://data.sec.gov/{kind}/CIK"), pad_registry_number(registry_number), F.lit(".json"))


def quarter_index_url(year: Column, quarter: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/full-index/"), year.cast("string"), F.lit("/QTR"), quarter.cast("string"), F.lit("/master.idx"))


def filing_folder_url(registry_number: Column, accession: Column) -> Column:
    return F.concat(F.concat_ws("/", F.lit(ARCHIVES), strip_leading_zeros(registry_number), strip_accession_dashes(accession)), F.lit("/"))
