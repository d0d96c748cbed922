"""Facts from filing prose: subsidiaries, holders, pay, proposals, fees, officers, offerings, earnings, activists.

Every parser is a Column of html -> struct or array of structs, built of string functions and higher-order functions,
so that documents stay in the JVM. Windows count characters, not bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from filigree.functions import dates, money
from filigree.functions.geo import bound
from filigree.functions.text import PAGE_MARK, at, collapse_ws, contains_any, eightk_items, first_label, first_of, item_text, piece, strip_html, table_rows, truncate, window_around  # noqa: F401

# ---- fixed values ------------------------------------------------------------------------------

NOT_SUBSIDIARIES = ["list of subsidiaries", "subsidiaries of", "exhibit", "table of contents", "name of subsidiary", "name and jurisdiction", "jurisdiction of", "page", "as of"]
JURISDICTIONS = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii", "Idaho",
    "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi",
    "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah", "Vermont", "Virginia",
    "Washington", "West Virginia", "Wisconsin", "Wyoming", "District of Columbia", "Puerto Rico", "Ireland", "Netherlands", "Luxembourg", "Bermuda",
    "Cayman Islands", "British Virgin Islands", "Singapore", "Hong Kong", "United Kingdom", "England", "England and Wales", "Scotland", "Canada",
    "Germany", "France", "Switzerland", "Japan", "China", "Australia", "Mexico", "Brazil", "India", "Spain", "Italy", "Israel", "Belgium", "Austria",
    "Sweden", "Norway", "Denmark", "Finland", "Poland", "Portugal", "Greece", "Turkey", "South Korea", "Korea", "Taiwan", "Malaysia", "Indonesia",
    "Thailand", "Philippines", "Vietnam", "New Zealand", "South Africa", "Argentina", "Chile", "Colombia", "United Arab Emirates", "Saudi Arabia",
    "Czech Republic", "Hungary", "Romania", "Mauritius", "Jersey", "Guernsey", "Gibraltar", "Barbados", "Panama", "Costa Rica",
]
COMPANY_SUFFIXES = "LLC INC INCORPORATED CORP CORPORATION LTD LIMITED LP LLP CO COMPANY GMBH AG SA BV NV PTY PLC SARL SRL SPA KG OY AB AS ULC".split()
OWNERSHIP_HEADINGS = ["security ownership of certain beneficial owners", "beneficial ownership of common stock", "principal stockholders", "security ownership of management"]
SECTION_WORDS = ["section", "item", "proposal", "executive compensation", "certain relationships"]
NOT_HOLDERS = ["based solely", "respect to", "the table", "number of shares", "beneficially owned", "common stock", "schedule 13", "footnote", "following table", "as of december", "pursuant to", "shares of"]
GROUPS = ["all directors", "directors and executive", "all executive officers", "officers as a group", "named executives"]
INSTITUTIONS = ["LLC", "L.L.C.", "Inc", "Corp", "L.P.", " LP", "Capital", "Asset", "Holdings", "Management", "Investors", "Trust", "Partners", "Group", "Fund", "Advisors"]
CHANGE_VERBS = {"resign": "resignation", "retire": "retirement", "appoint": "appointment", "name": "appointment", "elect": "election", "compensat": "compensation", "step down": "departure", "stepped down": "departure", "terminat": "departure", "depart": "departure", "transition": "departure"}
TITLES = ["Chief Executive Officer", "Chief Financial Officer", "Chief Operating Officer", "Chief Technology Officer", "Chief Accounting Officer", "Chief Legal Officer", "Chief Marketing Officer", "Executive Vice President", "Senior Vice President", "Executive Chairman", "General Counsel", "Vice President", "President", "Treasurer", "Controller", "Secretary", "Chairman", "Director"]
HONORIFICS = ["Mr.", "Ms.", "Mrs.", "Dr."]
NUMBER_WORDS = {w: str(i + 1) for i, w in enumerate("one two three four five six seven eight nine ten".split())}
AUDITORS = ["PricewaterhouseCoopers", "Ernst & Young", "Deloitte & Touche", "Deloitte", "KPMG", "Grant Thornton", "BDO USA", "RSM US", "Marcum", "Crowe"]
UNDERWRITERS = ["Goldman Sachs", "Morgan Stanley", "J.P. Morgan", "JPMorgan", "BofA Securities", "Merrill Lynch", "Citigroup", "Barclays", "Credit Suisse", "Deutsche Bank", "Wells Fargo Securities", "Jefferies", "Cowen", "Evercore", "RBC Capital Markets", "UBS Securities", "Piper Sandler", "Raymond James", "Allen & Company"]
RELATED_HEADINGS = ["transactions with related persons", "related person transactions", "related party transactions", "certain relationships and related"]
RELATIONSHIPS = {"immediate family": "family member", "family member": "family member", "executive officer": "officer", "director": "director", "officer": "officer", "5% stockholder": "5% holder", "beneficial owner": "beneficial owner", "affiliate": "affiliate", "greater than 5%": "5% holder"}
FISCAL_PERIODS = ["first quarter", "second quarter", "third quarter", "fourth quarter", "full year", "fiscal year", "fiscal fourth quarter"]

# ---- parsers -----------------------------------------------------------------------------------


def let(body: Callable[..., Column], *values: Column) -> Column:
    """body of the values, each evaluated once however often body names it. Plans stay small, too."""
    names = [f"v{i}" for i in range(len(values))]
    return bound(F.struct(*[v.alias(n) for v, n in zip(values, names)]), lambda s: body(*[s[n] for n in names]))


def of_text(html: Column, flavour: str, body: Callable[[Column, Column], Column]) -> Column:
    """body of the text without tags, and of that text in lower case."""
    return let(lambda text: let(lambda low: body(text, low), F.lower(text)), strip_html(html, flavour))


def distinct_by(rows: Column, key: Callable[[Column], Column]) -> Column:
    """The first of the elements with equal keys, in order."""
    return let(lambda rows: let(lambda keys: F.filter(rows, lambda x, i: F.array_position(keys, key(x)) == i + 1), F.transform(rows, key)), rows)


def found_in(rows: Column, read: Callable[[Column], Column]) -> Column:
    """read of each element, without nulls."""
    return F.filter(F.transform(rows, read), lambda x: x.isNotNull())


def first_place(rows: Column, test: Callable[[Column], Column]) -> Column:
    """0-based place of the first element that passes, null without one."""
    return F.array_min(found_in(F.transform(rows, lambda x, i: F.when(test(x), i)), lambda i: i))


def subsidiaries(html: Column) -> Column:
    """array<struct<name, jurisdiction>>, distinct, sorted by both."""
    lines = F.transform(F.split(strip_html(html, "lines"), "\n"), lambda x: F.regexp_replace(x, r"^[ \r]+|[ \r]+$", ""))

    def plausible(x: Column) -> Column:
        low = F.lower(x)
        bare = F.regexp_replace(F.trim(x), r"\.+$", "").rlike(f"(?i)^(?:{'|'.join(JURISDICTIONS)})$")
        return F.length(x).between(3, 300) & (F.length(F.regexp_replace(x, "[^A-Za-z]", "")) >= 3) & x.rlike("[A-Z]") & ~contains_any(low, NOT_SUBSIDIARIES) & ~bare

    def split(x: Column) -> Column:
        tail = F.trim(F.regexp_extract(x, r"^.*,(.*)$", 1))
        suffix = F.upper(F.regexp_replace(tail, "[^A-Za-z0-9]", "")).isin(COMPANY_SUFFIXES)
        pair = lambda n, j: F.struct(F.trim(n).alias("name"), F.trim(j).alias("jurisdiction"))
        return (
            F.when(F.contains(x, F.lit("\t")), pair(F.substring_index(x, "\t", 1), F.regexp_extract(x, r"^[^\t]*\t+(.*)$", 1)))
            .when(x.rlike(" {2,}"), pair(F.regexp_extract(x, r"^(.*) {2,}(.*?)$", 1), F.regexp_extract(x, r"^.* {2,}(.*?)$", 1)))
            .when((tail != "") & ~suffix, pair(F.regexp_extract(x, r"^(.*),.*$", 1), tail))
            .otherwise(pair(x, F.lit("")))
        )

    return F.array_sort(F.array_distinct(F.transform(F.filter(lines, plausible), split)))


def holder_row(line: Column) -> Column:
    """struct<name, holder_type, shares, percent_of_class> of a table line, null where it is none."""

    def of(tokens: Column, values: Column, last: Column) -> Column:
        percents = F.filter(F.slice(tokens, F.greatest(last + 2, F.lit(1)), F.size(tokens)), lambda t: F.contains(t, F.lit("%")))
        percent = F.regexp_replace(F.try_element_at(percents, F.lit(-1)), "[^0-9.]", "").try_cast("double")

        def row(name: Column, low: Column) -> Column:
            capitals = (name == F.upper(name)) & (F.size(F.split(name, r"\s+")) <= 2)
            bad = (F.length(name) < 3) | (F.length(name) > 70) | capitals | contains_any(low, NOT_HOLDERS) | name.rlike(r",\s*[A-Z]{2}\s*$")
            kind = F.when(contains_any(low, GROUPS), F.lit("group_total")).when(contains_any(name, INSTITUTIONS), F.lit("5pct_holder")).otherwise(F.lit("director_officer"))
            return F.when(~bad, F.struct(name.alias("name"), kind.alias("holder_type"), F.try_element_at(values, last + 1).try_cast("bigint").alias("shares"), percent.alias("percent_of_class")))

        return F.when(last >= 1, let(lambda name: row(name, F.lower(name)), F.array_join(F.slice(tokens, 1, F.greatest(last, F.lit(1))), " ")))

    def with_values(tokens: Column, values: Column) -> Column:
        is_shares = F.transform(values, lambda v, i: ~F.contains(F.try_element_at(tokens, i + 1), F.lit("%")) & (F.coalesce(v.try_cast("bigint"), F.lit(0)) >= 1000))
        return let(lambda last: of(tokens, values, last), F.array_max(F.transform(is_shares, lambda ok, i: F.when(ok, i).otherwise(F.lit(-1)))))

    return let(lambda tokens: let(lambda values: with_values(tokens, values), F.transform(tokens, money.clean_numeric)), F.split(F.trim(line), r"\s+"))


def beneficial_owners(html: Column) -> Column:
    """array<struct<name, holder_type, shares, percent_of_class, page, paragraph>> of the ownership table's lines, distinct by name and shares. Pages count from 1, paragraphs are lines behind the heading."""
    section = lambda x: contains_any(F.lower(x), SECTION_WORDS) & (F.length(x) < 120) & (F.length(F.regexp_replace(x, r"\D", "")) < 6)
    marks = lambda a: F.size(F.filter(a, lambda x: F.contains(x, F.lit(PAGE_MARK))))
    empty = F.array().cast("array<struct<name:string,holder_type:string,shares:bigint,percent_of_class:double,page:int,paragraph:int>>")

    def rows(body: Column, page: Column) -> Column:
        placed = F.transform(body, lambda x, i: F.struct(holder_row(x).alias("row"), i.alias("i")))
        kept = F.filter(placed, lambda x: x["row"].isNotNull())
        return F.transform(kept, lambda x: x["row"].withField("page", page + marks(F.slice(body, 1, x["i"]))).withField("paragraph", x["i"] + 1))

    def behind(lines: Column, head: Column) -> Column:
        page = marks(F.slice(lines, 1, head)) + 1
        body = let(lambda after: F.slice(after, 1, F.coalesce(first_place(after, section), F.size(after))), F.slice(lines, head + 2, 500))
        return F.when(head.isNotNull(), distinct_by(let(rows, body, page), lambda x: F.concat_ws("|", x["name"], x["shares"].cast("string"))))

    whole = let(lambda lines: let(lambda head: behind(lines, head), first_place(lines, lambda x: contains_any(F.lower(x), OWNERSHIP_HEADINGS))), F.transform(F.split(strip_html(html, "paged"), "\n"), F.trim))
    return F.coalesce(whole, empty)


def compensation_place(html: Column) -> Column:
    """0-based place of the first heading of the summary table with its column labels in the text of the next 6,000 characters; contents entries have none."""
    heading = "summary compensation table"
    parts = F.split(html, f"(?i){heading}")
    ends = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), F.array().cast("array<int>"), lambda acc, s: F.concat(acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(s) + len(heading)).cast("int"))))

    def labelled(end: Column) -> Column:
        text = F.lower(strip_html(piece(html, end - len(heading), 6000), "cells"))
        return F.contains(text, F.lit("salary")) & F.contains(text, F.lit("total"))

    return F.try_element_at(F.filter(ends, labelled), F.lit(1)) - len(heading)


def compensation_rows(html: Column) -> Column:
    """array<struct<name, fiscal_year, amounts>> of the summary table; a row without a name carries the last one on."""
    place = compensation_place(html)
    rows = table_rows(piece(html, place, 40_000))

    def of_year(cells: Column, at_year: Column) -> Column:
        names = F.filter(F.slice(cells, 1, at_year), lambda c: (F.size(F.split(F.substring_index(c, ",", 1), r"\s+")).between(2, 6)) & (F.length(F.regexp_replace(c, "[^A-Za-z]", "")) >= 4) & (F.length(F.regexp_replace(c, "[^0-9]", "")) <= 1))
        amounts = found_in(F.slice(cells, at_year + 2, F.size(cells)), money.clean_money)
        row = lambda amounts: F.when(F.size(amounts) >= 2, F.struct(F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("")).alias("name"), F.try_element_at(cells, at_year + 1).cast("int").alias("fiscal_year"), amounts.alias("amounts")))
        return F.when(at_year.isNotNull(), let(row, amounts))

    def read(cells: Column) -> Column:
        return let(lambda at_year: of_year(cells, at_year), first_place(cells, lambda c: c.rlike(r"^(?:199[5-9]|20\d\d)$")))

    def carried(found: Column, names: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = F.filter(F.slice(names, 1, i + 1), lambda n: n != "")
            return F.struct(F.coalesce(F.try_element_at(before, F.lit(-1)), F.lit("")).alias("name"), x["fiscal_year"].alias("fiscal_year"), x["amounts"].alias("amounts"))

        return F.transform(found, one)

    return let(lambda found: let(lambda names: carried(found, names), F.transform(found, lambda x: F.trim(F.substring_index(x["name"], ",", 1)))), found_in(rows, read))


def proposals(html: Column) -> Column:
    """array<struct<number, description, board_recommendation, proposal_type>>: first of each number, 20 at the most (a report's top)."""
    text = strip_html(html, "collapsed")
    windows = F.regexp_extract_all(text, F.lit(r"(?is)proposal (?=(.{0,700}))"), F.lit(1))

    def read(w: Column) -> Column:
        form = r"(?is)^[\s.:\-—#)]*(\d+|[a-z]+)[\s.:\-—#)(]*([^.\n]{0,110})"
        raw = F.lower(F.regexp_extract(F.substring(w, 1, 160), form, 1))
        number = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in kv]), raw), F.when(raw.try_cast("int").between(1, 20), raw.try_cast("int").cast("string")))
        low = F.lower(w)
        vote = F.when(contains_any(low, ["recommends a vote against", "recommends you vote against"]), F.lit("AGAINST")).when(contains_any(low, ["recommends a vote for", "recommends you vote for", "recommends that"]), F.lit("FOR")).otherwise(F.lit(""))
        kind = F.when(contains_any(low, ["shareholder proposal", "stockholder proposal"]), F.lit("shareholder")).otherwise(F.lit("company"))
        description = F.trim(F.regexp_extract(F.substring(w, 1, 160), form, 2))
        return F.when(number.isNotNull() & (F.length(description) >= 4), F.struct(number.alias("number"), description.alias("description"), vote.alias("board_recommendation"), kind.alias("proposal_type")))

    return F.slice(distinct_by(found_in(windows, read), lambda x: x["number"]), 1, 20)


def pay_ratio(html: Column) -> Column:
    def of(text: Column, low: Column) -> Column:
        ratio = money.ratio_to_one(text)
        median = money.plain_dollar(text, at(low, "median employee"), 400)
        ceo = money.plain_dollar(text, first_of(low, ["our ceo", "chief executive officer"]), 400)
        year = dates.max_year(text, at(low, "pay ratio") - 200, 400, dates.NO_AMOUNT)
        row = F.struct(year.alias("fiscal_year"), ceo.alias("ceo_total_comp"), median.alias("median_employee_comp"), ratio.alias("ratio"))
        return F.when(contains_any(low, ["pay ratio", "median employee"]) & (ratio.isNotNull() | median.isNotNull()), row)

    return of_text(html, "collapsed", of)


def audit_fees(html: Column) -> Column:
    def of(text: Column, low: Column) -> Column:
        place = at(low, "audit fees")
        fee = money.plain_dollar(text, place, 160)
        row = F.struct(
            dates.max_year(text, place - 300, 360, dates.NO_AMOUNT).alias("fiscal_year"), first_label(text, AUDITORS).alias("auditor_name"), fee.alias("audit_fees"), money.plain_dollar(text, first_of(low, ["audit-related fees", "audit related fees"]), 160).alias("audit_related_fees"),
            money.plain_dollar(text, at(low, "tax fees"), 160).alias("tax_fees"), money.plain_dollar(text, first_of(low, ["all other fees", "other fees"]), 160).alias("other_fees"),
        )
        return F.when(fee >= 50_000, row)

    return of_text(html, "collapsed", of)


def officer_changes(html: Column) -> Column:
    """array<struct<person_name, change_type, position_title, effective_date, reason_summary>> of a report with item 5.02, 25 at the most (a report's top)."""

    def of(text: Column, low: Column) -> Column:
        def places(mark: str) -> Column:
            """Where the mark's occurrences end, each with the mark's length."""
            starts = F.regexp_extract_all(text, F.lit(rf"(?s)\G(.*?{mark.replace('.', '[.]')})"), F.lit(1))
            ends = F.aggregate(starts, F.array().cast("array<int>"), lambda acc, s: F.concat(acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.length(s)).cast("int"))))
            return F.transform(ends, lambda end: F.struct(end.alias("end"), F.lit(len(mark)).alias("n")))

        def row(name: Column, window: Column, kind: Column) -> Column:
            change = F.struct(collapse_ws(name).alias("person_name"), kind.alias("change_type"), first_label(window, TITLES).alias("position_title"), dates.effective_date(window).alias("effective_date"), truncate(collapse_ws(window), 240).alias("reason_summary"))
            return F.when((F.length(name) >= 2) & (kind != ""), change)

        def read(x: Column) -> Column:
            name = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_extract(piece(text, x["end"], 200), r"(?s)^\s*((?:[A-Z]\S*(?:\s+|$)){1,3})", 1)), r"['’]s$", ""), r"[^\p{L}\p{N}]+$", "")
            return let(lambda window: let(lambda name, kind: row(name, window, kind), name, first_label(F.lower(window), CHANGE_VERBS)), window_around(text, x["end"] - x["n"]))

        found = distinct_by(found_in(F.concat(*[places(m) for m in HONORIFICS]), read), lambda x: F.concat_ws("|", x["person_name"], x["change_type"]))
        kind = "array<struct<person_name:string,change_type:string,position_title:string,effective_date:string,reason_summary:string>>"
        return F.when(F.contains(low, F.lit("item 5.02")), F.slice(found, 1, 25)).otherwise(F.array().cast(kind))

    return of_text(html, "spaced", of)


def related_parties(html: Column) -> Column:
    """array<struct<relationship, year, amount_usd, description>> of the related-party section's sentences, 30 at the most (a report's top)."""

    def of(text: Column, low: Column) -> Column:
        section = F.coalesce(item_text(text, "13"), *[piece(text, at(low, h) + len(h), 4000) for h in RELATED_HEADINGS])
        def row(s: Column, amount: Column) -> Column:
            return F.when(amount >= 1000, F.struct(first_label(F.lower(s), RELATIONSHIPS).alias("relationship"), dates.first_year(s).alias("year"), amount.alias("amount_usd"), truncate(collapse_ws(s), 240).alias("description")))

        def read(s: Column) -> Column:
            return let(lambda amount: row(s, amount), money.first_dollar(s, 14, (("billion", 1e9), ("million", 1e6), ("thousand", 1e3))))

        delegated = lambda section: contains_any(F.lower(section), ["incorporated by reference", "incorporated herein by reference"])
        found = let(lambda section: F.when(~delegated(section), F.slice(found_in(F.split(section, r"\. "), read), 1, 30)), section)
        return F.coalesce(found, F.array().cast("array<struct<relationship:string,year:int,amount_usd:double,description:string>>"))

    return of_text(html, "spaced", of)


def offering(html: Column) -> Column:
    def of(text: Column, low: Column) -> Column:
        kind = F.when(F.contains(low, F.lit("initial public offering")), F.lit("ipo")).when(contains_any(low, ["from time to time", "shelf"]), F.lit("shelf")).when(contains_any(low, ["selling stockholder", "selling securityholder"]), F.lit("secondary")).otherwise(F.lit(""))
        shares = money.shares_near(text, low, ["we are offering", "shares of common stock"])
        price = F.coalesce(money.dollar_before(text, low, "per share"), money.dollar_after(text, low, "offering price"))
        gross, net = money.dollar_after(text, low, "gross proceeds"), money.dollar_after(text, low, "net proceeds")
        row = F.struct(kind.alias("offering_type"), shares.alias("shares_offered"), price.alias("price_per_share"), gross.alias("gross_proceeds"), net.alias("net_proceeds"))
        return F.when(contains_any(low, ["prospectus", "registration statement"]) & (shares.isNotNull() | gross.isNotNull() | net.isNotNull()), row)

    return of_text(html, "spaced", of)


def underwriters(html: Column) -> Column:
    """The known underwriters that the underwriting section names, in their fixed order."""

    def of(text: Column, low: Column) -> Column:
        return let(lambda section: F.array_compact(F.array(*[F.when(F.contains(section, F.lit(u)), F.lit(u)) for u in UNDERWRITERS])), piece(text, at(low, "underwrit"), 6000))

    return of_text(html, "spaced", of)


def use_of_proceeds(html: Column) -> Column:
    def of(text: Column, low: Column) -> Column:
        section = piece(text, at(low, "use of proceeds"), 600)
        return F.when(section.isNotNull(), F.struct(F.lit("general").alias("category"), money.first_dollar(section).alias("amount_usd"), truncate(collapse_ws(section), 400).alias("narrative")))

    return of_text(html, "spaced", of)


def selling_holders(html: Column) -> Column:
    """array<struct<holder_name, shares_before, shares_offered, shares_after>>, 60 at the most (a report's top)."""
    place = first_of(F.lower(html), ["selling stockholder", "selling securityholder"])

    def read(cells: Column) -> Column:
        good = lambda c: (F.size(F.split(c, r"\s+")).between(2, 8)) & (F.length(c) <= 70) & (F.length(F.regexp_replace(c, "[^A-Za-z]", "")) >= 5) & ~c.rlike(r"\d") & ~contains_any(F.lower(c), ["shares", "name of"])
        name = F.try_element_at(F.filter(cells, good), F.lit(1))
        counts = F.filter(F.transform(cells, money.share_count), lambda v: v >= 100)
        return F.when(name.isNotNull() & (F.size(counts) >= 2), F.struct(name.alias("holder_name"), counts[0].alias("shares_before"), counts[1].alias("shares_offered"), F.try_element_at(counts, F.lit(3)).alias("shares_after")))

    return F.slice(found_in(table_rows(piece(html, place, 30_000)), read), 1, 60)


def earnings(html: Column) -> Column:
    def of(text: Column, low: Column) -> Column:
        gate = contains_any(low, ["revenue", "net sales"]) & contains_any(low, ["net income", "net loss", "per share"])
        revenue = money.money_near(text, low, ["total revenue", "net revenue", "net sales", "revenue"])
        income = money.money_near(text, low, ["net income", "net loss"])
        diluted = money.nearest_decimal(text, low, ["per diluted share", "diluted earnings per share"])
        basic = money.nearest_decimal(text, low, ["per basic share", "basic earnings per share"])
        row = F.struct(dates.period_end(text, low).alias("period_end_date"), first_label(low, FISCAL_PERIODS).alias("fiscal_period"), revenue.alias("revenue"), income.alias("net_income"), basic.alias("eps_basic"), diluted.alias("eps_diluted"))
        return F.when(gate & (revenue.isNotNull() | income.isNotNull() | diluted.isNotNull()), row)

    return of_text(html, "spaced", of)


ANCHOR = r"(?:\(1\) NAMES? OF REPORTING PERSON|1\. NAMES? OF REPORTING PERSONS|NAMES OF REPORTING PERSONS)"


def reporting_persons(html: Column) -> Column:
    """array<struct<name, source_of_funds, citizenship, sole_voting_power, shared_voting_power, aggregate_amount, percent_of_class, type_of_reporting_person>> of the cover blocks."""
    blocks = F.transform(F.slice(F.split(strip_html(html, "plain"), f"(?i){ANCHOR}"), 2, 1 << 30), lambda b: F.substring(b, 1, 6000))

    def short(b: Column, n: int) -> Column:
        return F.trim(F.substring(F.regexp_replace(F.regexp_extract(b, rf"\({n}\)([^\n]*)", 1), r"^[^A-Za-z0-9]+", ""), 1, 120))

    def whole(b: Column, n: int) -> Column:
        return F.coalesce(F.regexp_replace(F.regexp_extract(b, rf"(?s)\({n}\)(?=.{{0,119}}?(\d[\d,]*))", 1), ",", "").try_cast("bigint"), F.lit(0))

    def read(b: Column) -> Column:
        name = F.trim(F.regexp_extract(F.trim(F.regexp_replace(F.regexp_extract(b, r"(?s)^(.*?)(?:\([234]\)|\z)", 1), r"^[^\p{L}]+", "")), r"^([^\n]*)", 1))
        percent = F.coalesce(F.regexp_extract(b, r"(?s)\(13\)(?=.{0,119}?([\d.]*\d)%)", 1).try_cast("double"), F.lit(0.0))
        row = F.struct(name.alias("name"), short(b, 4).alias("source_of_funds"), short(b, 6).alias("citizenship"), whole(b, 7).alias("sole_voting_power"), whole(b, 8).alias("shared_voting_power"), whole(b, 9).alias("sole_dispositive_power"), whole(b, 10).alias("shared_dispositive_power"), whole(b, 11).alias("aggregate_amount"), percent.alias("percent_of_class"), short(b, 14).alias("type_of_reporting_person"))
        return F.when(F.length(name) >= 3, row)

    return found_in(blocks, read)


def activist(html: Column) -> Column:
    """struct<purpose_text, percent_owned, amendment_no>: the purpose item, the largest percentage from 0.1 to 100, the amendment's number."""

    def of(text: Column, low: Column) -> Column:
        return F.named_struct(F.lit("purpose_text"), truncate(F.coalesce(item_text(text, "4"), F.lit("")), 1000), F.lit("percent_owned"), max_percent(text), F.lit("amendment_no"), F.regexp_extract(text, r"(?is)amendment no\D*(\d+)", 1).try_cast("int"))

    return of_text(html, "plain", of)


def max_percent(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(r"([\d.]*\d)%"), F.lit(1)), lambda x: x.try_cast("double"))
    return F.coalesce(F.array_max(F.filter(found, lambda v: v.between(0.1, 100))), F.lit(0.0))


#: Types of reporting persons that are entities, and name parts that only entities have (fixed values).
ENTITY_TYPES, ENTITY_NAMES = "CO PN IA BD BK IC FI".split(), [" L.P.", " LLC", " Inc", " Corp"]


def is_entity(kind: Column, name: Column) -> Column:
    """Whether a reporting person is an entity rather than a natural person."""
    return F.coalesce(kind, F.lit("")).isin(ENTITY_TYPES) | contains_any(name, ENTITY_NAMES)
