"""The registry's fact tables: each document parsed once, into tagged rows; a fact table is a projection of those.

parse() joins documents (cik, accession_number, document, text) with the filing index and gives one row for each fact:
the table it belongs to, its key, where it comes from, and its cells as a variant, so that rows of thirty kinds share one
column. A document passes all its extractors in one projection; which ones is told by form, name and content. FactTables
makes tables of the rows, by name and only when asked: facts as projections, identities by one shuffle for all kinds.
write() stores the rows partitioned by table, so that a reader of one table reads that table's files, and counts what was
written while it is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from filigree.functions import ids, text
from filigree.functions.geo import bound
from filigree.operators import forms, prose, scope
from filigree.operators.lookup import first_wins
from filigree.operators.reshape import PROVENANCE

#: Columns of each table before the provenance columns, key first (fixed values). Types other than text stand in TYPES.
COLUMNS = {
    "insider_transaction": "transaction_nid person_nid issuer_cik direction security_title transaction_date transaction_code shares price_per_share total_value direct_indirect is_derivative equity_swap footnote_text",
    "holding": "holding_nid person_nid issuer_cik security_title as_of_date shares percent_of_class direct_indirect is_derivative",
    "role": "role_nid person_nid issuer_cik role_type officer_title since_date",
    "planned_sale": "planned_sale_nid person_nid issuer_cik security_class shares approx_sale_date broker_name aggregate_market_value payment_date securities_acquired_date nature_of_acquisition",
    "institutional_holding": "institutional_holding_nid manager_cik cusip name_of_issuer title_of_class figi value shares shares_type put_call investment_discretion voting_sole voting_shared voting_none other_managers quarter",
    "activist_filing": "activist_filing_nid filer_nid filer_type filer_name issuer_cik security_cusip security_class aggregate_amount percent_of_class sole_voting_power shared_voting_power sole_dispositive_power shared_dispositive_power type_of_reporting_person citizenship purpose_text source_of_funds member_of_group is_amendment original_filing_accession",
    "holder_group": "group_link_nid filer_a_nid filer_b_nid issuer_cik",
    "subsidiary": "subsidiary_nid parent_cik name jurisdiction",
    "related_party_transaction": "rpt_nid issuer_cik counterparty_name relationship year amount_usd description",
    "auditor": "auditor_record_nid issuer_cik auditor_name auditor_location pcaob_id fiscal_year",
    "corporate_event": "event_nid issuer_cik item_code description event_date",
    "officer_change": "officer_change_nid issuer_cik person_name person_nid change_type position_title effective_date reason_summary",
    "ma_event": "ma_event_nid issuer_cik counterparty_name counterparty_cik transaction_type effective_date consideration_summary deal_value_usd",
    "vote_result": "vote_result_nid issuer_cik meeting_date proposal_number proposal_description votes_for votes_against votes_abstain broker_non_votes outcome",
    "auditor_change": "auditor_change_nid issuer_cik prior_auditor new_auditor change_date reason_summary",
    "restatement": "restatement_nid issuer_cik filing_date period_restated_start period_restated_end items_affected reason_summary",
    "earnings_release": "earnings_release_nid issuer_cik period_end_date fiscal_period revenue net_income eps_basic eps_diluted guidance_revenue_low guidance_revenue_high guidance_eps_low guidance_eps_high",
    "proposal": "proposal_nid issuer_cik meeting_date proposal_number description board_recommendation proposal_type",
    "compensation": "compensation_nid person_name person_nid issuer_cik fiscal_year position_title salary bonus stock_awards option_awards non_equity_incentive pension_change other_compensation total",
    "pay_vs_performance": "pvp_nid issuer_cik fiscal_year ceo_actual_comp ceo_reported_comp avg_neo_actual_comp avg_neo_reported_comp total_shareholder_return peer_tsr net_income company_selected_measure",
    "ceo_pay_ratio": "ceo_pay_ratio_nid issuer_cik fiscal_year ceo_total_comp median_employee_comp ratio",
    "audit_fees": "audit_fees_nid issuer_cik fiscal_year auditor_name audit_fees audit_related_fees tax_fees other_fees",
    "fund_vote": "fund_vote_nid manager_cik series_id issuer_name security_cusip meeting_date proposal_description shares_voted shares_on_loan vote_for vote_against vote_abstain vote_withhold management_recommendation vote_source",
    "offering": "offering_nid issuer_cik offering_type shares_offered price_per_share gross_proceeds net_proceeds currency is_overallotment_exercised",
    "selling_stockholder": "ss_nid person_nid holder_name issuer_cik shares_before shares_offered shares_after pct_before pct_after",
    "underwriter": "underwriter_nid underwriter_name issuer_cik role shares_underwritten discount_per_share",
    "use_of_proceeds": "uop_nid issuer_cik category amount_usd narrative",
    "merger": "merger_nid target_cik target_name acquirer_cik acquirer_name consideration_type cash_per_share exchange_ratio deal_value_usd expected_close_date",
    "metric_fact": "metric_fact_nid issuer_cik tag ddate qtrs uom value dimensional_context",
}
IDENTITIES = {"person": "person_nid display_name cik", "security": "cusip name title_of_class", "institutional_manager": "manager_cik name"}
RECORDS = ("company", "filing_index", "sic")
NAMES = (*COLUMNS, *IDENTITIES, *RECORDS)
_DOUBLES = (
    "shares price_per_share total_value aggregate_market_value value voting_sole voting_shared voting_none percent_of_class amount_usd revenue net_income eps_basic eps_diluted salary bonus stock_awards option_awards non_equity_incentive "
    "pension_change other_compensation total ceo_total_comp median_employee_comp ratio audit_fees audit_related_fees tax_fees other_fees gross_proceeds net_proceeds shares_offered shares_before shares_after shares_underwritten"
)
_LONGS = "is_derivative is_amendment qtrs year fiscal_year aggregate_amount sole_voting_power shared_voting_power sole_dispositive_power shared_dispositive_power"
TYPES = dict.fromkeys(_DOUBLES.split(), "double") | dict.fromkeys(_LONGS.split(), "bigint")

PROXY, ANNUAL, REPORT, STATEMENT = ["DEF 14A", "DEFA14A", "PRE 14A"], ["10-K", "10-K/A"], ["8-K", "8-K/A"], ["S-1", "S-1/A"]
PROSPECTUS = ["424B1", "424B2", "424B3", "424B4", "424B5", "424B7", "424B8"]
STAKE = scope.BUCKETS["sc13d"] + scope.BUCKETS["sc13g"]
PAY = ["salary", "bonus", "stock_awards", "option_awards", "non_equity_incentive", "pension_change", "other_compensation", "total"]

#: A fact: its table and key, the extractor's stage, provenance (form, whose archive folder, lot, page, paragraph), cells.
FACT = "array<struct<table:string,nid:string,stage:int,form:string,accession:string,owner:string,lot:int,page:int,paragraph:int,cells:variant>>"


def named(name: Column, prefix: str = "p-") -> Column:
    return F.concat(F.lit(prefix), text.normalise_name(name))


class Emitter:
    """Facts of one extractor: what its rows have in common, and arrays of facts as columns."""

    def __init__(self, stage: int, form: Column | str, owner: Column):
        self.stage, self.owner, self.form = stage, owner, F.lit(form) if isinstance(form, str) else form

    def nid(self, *parts: Column | str) -> Column:
        return F.concat_ws("-", "accession_number", *[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])

    def fact(self, table: str, nid: Column, cells: dict[str, Column], lot: Column | None = None, page: Column | None = None, paragraph: Column | None = None, form: Column | None = None, accession: Column | None = None) -> Column:
        if unknown := set(cells) - set((COLUMNS | IDENTITIES)[table].split()):
            raise ValueError(f"{table} has no {unknown}")
        row = F.struct(*[c.cast(TYPES.get(n, "string")).alias(n) for n, c in cells.items()])
        places = [(F.lit(None) if c is None else c).cast("int").alias(n) for n, c in (("lot", lot), ("page", page), ("paragraph", paragraph))]
        acc = F.col("accession_number") if accession is None else accession
        return F.struct(F.lit(table).alias("table"), nid.alias("nid"), F.lit(self.stage).alias("stage"), (self.form if form is None else form).alias("form"), acc.alias("accession"), self.owner.alias("owner"), *places, F.to_variant_object(row).alias("cells"))

    def person(self, nid: Column, name: Column, cik: Column | None = None) -> Column:
        return self.fact("person", nid, {"display_name": name, "cik": F.lit("") if cik is None else cik})


def none() -> Column:
    return F.array().cast(FACT)


def each(found: Column, one: Callable[[Column, Column], Column]) -> Column:
    """one(element, place) of each element, places counted from 0; one may give a fact or, for several, an array of them."""
    return F.coalesce(F.transform(found, one), none())


def several(found: Column, some: Callable[[Column, Column], Column]) -> Column:
    return F.coalesce(F.flatten(F.transform(found, some)), none())


def single(x: Column, one: Callable[[Column], Column]) -> Column:
    """The fact of x, none where x is null."""
    return F.when(x.isNotNull(), bound(x, lambda v: F.array(one(v)))).otherwise(none())


def cells_of(x: Column, names: str) -> dict[str, Column]:
    return {n: x[n] for n in names.split()}


def listed(x: Column, **renamed: str) -> dict[str, Column]:
    return {n: x[c] for n, c in renamed.items()}


#: What an extractor gives: arrays of facts, each with the tables that they belong to, built when they are wanted.
Parts = list[tuple[str, Callable[[], Column]]]


def where(given: Column, parts: Parts) -> Parts:
    """parts of documents for which a condition holds."""
    return [(names, lambda make=make: F.when(given, make()).otherwise(none())) for names, make in parts]


# ---- extractors: arrays of facts of a document -------------------------------------------------


def ownership(doc: Column) -> Parts:
    """Forms 3, 4 and 5: owner, roles, transactions with the holdings after them, and standing holdings."""
    reporter, issuer, form = forms.reporter_cik(doc), forms.issuer_cik(doc), F.trim(doc["documentType"])
    kind, e = F.substring(form, 1, 1), Emitter(1, form, reporter)
    common = {"person_nid": ids.person_id(reporter), "issuer_cik": issuer}

    def role(x: Column, _: Column) -> Column:
        nid = F.concat_ws("-", reporter, issuer, F.when(kind == "3", F.lit("initial")), x["role_type"])
        return e.fact("role", nid, common | cells_of(x, "role_type officer_title") | {"since_date": F.when(kind == "3", doc["periodOfReport"])})

    def transaction(x: Column, i: Column) -> Column:
        way = F.when(x["acquired_disposed"] == "A", "purchase").when(x["acquired_disposed"] == "D", "sale")
        cells = common | {"direction": way} | cells_of(x, "security_title transaction_date transaction_code shares price_per_share total_value direct_indirect is_derivative")
        after = common | cells_of(x, "security_title direct_indirect is_derivative") | listed(x, as_of_date="transaction_date", shares="owned_after")
        return F.array_compact(F.array(F.when(way.isNotNull(), e.fact("insider_transaction", e.nid(i, way), cells, i)), e.fact("holding", e.nid(i, "h"), after, i)))

    def standing(x: Column, i: Column) -> Column:
        cells = common | cells_of(x, "security_title as_of_date shares direct_indirect is_derivative")
        infix = F.when(kind == "3", "h").otherwise("sh")
        return e.fact("holding", e.nid(infix, i), cells, i + F.when(kind == "3", 0).otherwise(forms.transaction_count(doc)))

    name = forms.owner_of(doc)["reportingOwnerId"]["rptOwnerName"]
    given = form.rlike("^[345](?:/A)?$") & (F.coalesce(forms.owner_of(doc)["reportingOwnerId"]["rptOwnerCik"], F.lit("")) != "") & (F.coalesce(doc["issuer"]["issuerCik"], F.lit("")) != "")
    parts: Parts = [
        ("person", lambda: F.array(e.person(common["person_nid"], F.coalesce(name, F.lit("")), reporter))),
        ("role", lambda: each(forms.roles(doc), role)),
        ("insider_transaction holding", lambda: F.when(kind != "3", several(forms.transactions(doc), transaction)).otherwise(none())),
        ("holding", lambda: F.when(kind != "4", each(forms.holdings(doc), standing)).otherwise(none())),
    ]
    return where(given, parts)


def sale_notice(doc: Column) -> Parts:
    """Form 144: planned sales, and the last three months' as transactions."""
    filer = ids.strip_leading_zeros(doc["filer_cik"])
    e = Emitter(1, "144", filer)
    common = {"person_nid": ids.person_id(filer), "issuer_cik": ids.strip_leading_zeros(doc["issuer_cik"])}

    def planned(x: Column, i: Column) -> Column:
        whole = cells_of(doc, "broker_name aggregate_market_value securities_acquired_date nature_of_acquisition")
        return e.fact("planned_sale", e.nid("plan", i), common | whole | cells_of(x, "security_class shares approx_sale_date"), i)

    def past(x: Column, i: Column) -> Column:
        cells = common | {"direction": F.lit("sale"), "transaction_code": F.lit("S"), "is_derivative": F.lit(0)} | cells_of(x, "security_title transaction_date shares total_value")
        return e.fact("insider_transaction", e.nid("hist", i), cells, i + F.size(doc["planned"]))

    parts: Parts = [("person", lambda: F.array(e.person(common["person_nid"], doc["filer_name"], filer))), ("planned_sale", lambda: each(doc["planned"], planned)), ("insider_transaction", lambda: each(doc["past"], past))]
    return where((doc["filer_cik"] != "") & (doc["issuer_cik"] != ""), parts)


def placement(doc: Column) -> Parts:
    """Form D: one offering, and what its proceeds are for."""
    issuer = ids.strip_leading_zeros(doc["issuer_cik"])
    e = Emitter(1, "D", issuer)
    cells = {"issuer_cik": issuer, "offering_type": F.lit("private_placement"), "currency": F.lit("USD"), "is_overallotment_exercised": F.lit("0")} | cells_of(doc, "gross_proceeds net_proceeds")
    use = e.fact("use_of_proceeds", e.nid("uop"), {"issuer_cik": issuer, "category": F.lit("general"), "narrative": doc["narrative"]})
    return where(doc["issuer_cik"] != "", [("offering use_of_proceeds", lambda: F.array_compact(F.array(e.fact("offering", e.nid("d"), cells), F.when(doc["narrative"] != "", use))))])


def manager_table(doc: Column) -> Parts:
    """13F: positions; the manager goes by its number."""
    manager = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(2, "13F-HR", manager)
    names = "cusip name_of_issuer title_of_class figi value shares shares_type put_call investment_discretion voting_sole voting_shared voting_none other_managers"

    def position(x: Column, _: Column) -> Column:
        held = e.fact("institutional_holding", e.nid(x["position"], x["cusip"]), {"manager_cik": manager} | cells_of(x, names), x["position"])
        return F.array(held, e.fact("security", x["cusip"], listed(x, name="name_of_issuer", title_of_class="title_of_class")))

    known = lambda: F.when(F.size(doc["infoTable"]) > 0, F.array(e.fact("institutional_manager", manager, {"name": manager}))).otherwise(none())
    return [("institutional_manager", known), ("institutional_holding security", lambda: several(forms.positions(doc), position))]


def stake(html: Column) -> Parts:
    """Schedules 13D and 13G: a filing and a holding of each reporting person, and links from the first to the others."""
    issuer = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(3, F.when(F.lower("document").contains("13g"), "SC 13G").otherwise("SC 13D"), issuer)
    nid = lambda x: named(x["name"], "rp-")

    def of(v: Column) -> Column:
        people, whole = v["people"], v["whole"]

        def one(x: Column, i: Column) -> Column:
            entity = prose.is_entity(x["type_of_reporting_person"], x["name"])
            filed = {"filer_nid": nid(x), "filer_type": F.when(entity, "entity").otherwise("person"), "filer_name": x["name"], "issuer_cik": issuer, "security_class": F.lit("Common Stock"), "purpose_text": whole["purpose_text"], "is_amendment": whole["amendment_no"].isNotNull().cast("int")}
            filed |= cells_of(x, "aggregate_amount percent_of_class sole_voting_power shared_voting_power sole_dispositive_power shared_dispositive_power type_of_reporting_person citizenship source_of_funds")
            held = {"person_nid": nid(x), "issuer_cik": issuer, "security_title": F.lit("Common Stock"), "shares": x["aggregate_amount"], "percent_of_class": x["percent_of_class"], "is_derivative": F.lit(0)}
            who = F.when(entity, e.fact("institutional_manager", nid(x), {"name": x["name"]})).otherwise(e.person(nid(x), x["name"]))
            return F.array(who, e.fact("activist_filing", e.nid(i, "act"), filed, i), e.fact("holding", e.nid(i, "h"), held, i))

        def link(x: Column, i: Column) -> Column:
            return e.fact("holder_group", e.nid("grp", i + 1), {"filer_a_nid": nid(people[0]), "filer_b_nid": nid(x), "issuer_cik": issuer})

        return F.concat(several(people, one), each(F.slice(people, 2, 1 << 30), link))

    return [("activist_filing holding holder_group person institutional_manager", lambda: bound(F.struct(prose.reporting_persons(html).alias("people"), prose.activist(html).alias("whole")), of))]


def _owners(e: Emitter, html: Column, issuer: Column, infix: str | None, with_roles: bool) -> Column:
    """Holdings of a table of owners, the people, and in proxies the roles of those that are no holders of five percent."""
    def one(x: Column, i: Column) -> Column:
        who, place = named(x["name"]), (None, x["page"], x["paragraph"])
        held = e.fact("holding", e.nid(*([infix] if infix else []), i), {"person_nid": who, "issuer_cik": issuer, "security_title": F.lit("Common Stock"), "shares": x["shares"], "percent_of_class": x["percent_of_class"], "is_derivative": F.lit(0)}, *place)
        role = e.fact("role", e.nid(i, who, "role"), {"person_nid": who, "issuer_cik": issuer, "role_type": F.lit("director_or_officer")}, *place)
        return F.array_compact(F.array(e.person(who, x["name"]), held, *([F.when(x["holder_type"] == "director_officer", role)] if with_roles else [])))

    return several(prose.beneficial_owners(html), one)


def _related(e: Emitter, html: Column, issuer: Column) -> Column:
    return each(prose.related_parties(html), lambda x, i: e.fact("related_party_transaction", e.nid("rpt", i), {"issuer_cik": issuer} | cells_of(x, "relationship year amount_usd description")))


def proxy(html: Column) -> Parts:
    """Proxy statements: owners and their roles, pay, proposals, the pay ratio, audit fees, related parties."""
    issuer = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(4, "DEF 14A", issuer)

    def pay(x: Column, i: Column) -> Column:
        amounts = {c: F.when(F.size(x["amounts"]) >= 8, F.try_element_at(x["amounts"], F.lit(k + 1))) for k, c in enumerate(PAY)}
        amounts |= {"salary": F.try_element_at(x["amounts"], F.lit(1)), "total": F.try_element_at(x["amounts"], F.lit(-1))}
        who = named(x["name"])
        return F.array(e.person(who, x["name"]), e.fact("compensation", e.nid("comp", i), {"person_name": x["name"], "person_nid": who, "issuer_cik": issuer, "fiscal_year": x["fiscal_year"]} | amounts))

    own = {"issuer_cik": issuer}
    proposal = lambda x, i: e.fact("proposal", e.nid("prop", i), own | listed(x, proposal_number="number") | cells_of(x, "description board_recommendation proposal_type"))
    ratio = lambda x: e.fact("ceo_pay_ratio", e.nid("payratio"), own | cells_of(x, "fiscal_year ceo_total_comp median_employee_comp ratio"))
    fees = lambda x: e.fact("audit_fees", e.nid("auditfees"), own | cells_of(x, "fiscal_year auditor_name audit_fees audit_related_fees tax_fees other_fees"))
    return [
        ("holding role person", lambda: _owners(e, html, issuer, None, True)), ("compensation person", lambda: several(prose.compensation_rows(html), pay)), ("proposal", lambda: each(prose.proposals(html), proposal)),
        ("ceo_pay_ratio", lambda: single(prose.pay_ratio(html), ratio)), ("audit_fees", lambda: single(prose.audit_fees(html), fees)), ("related_party_transaction", lambda: _related(e, html, issuer)),
    ]


def annual(html: Column) -> Parts:
    """Annual reports: owners (item 12) and related parties (item 13)."""
    issuer = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(6, "10-K", issuer)
    return [("holding person", lambda: _owners(e, html, issuer, "it12", False)), ("related_party_transaction", lambda: _related(e, html, issuer))]


def exhibit(html: Column) -> Parts:
    """Exhibit 21: subsidiaries."""
    parent = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(6, "10-K", parent)
    one = lambda x, i: e.fact("subsidiary", F.concat_ws("-", parent, "accession_number", i.cast("string")), {"parent_cik": parent} | cells_of(x, "name jurisdiction"))
    return [("subsidiary", lambda: each(prose.subsidiaries(html), one))]


def current_report(html: Column) -> Parts:
    """Current reports: items, officers' changes where there are items, and an earnings release."""
    issuer = ids.strip_leading_zeros(F.col("cik"))
    e = Emitter(5, "8-K", issuer)
    own = {"issuer_cik": issuer}

    def change(x: Column, i: Column) -> Column:
        who = named(x["person_name"])
        return F.array(e.person(who, x["person_name"]), e.fact("officer_change", e.nid("oc", i), own | {"person_nid": who} | cells_of(x, "person_name change_type position_title effective_date reason_summary")))

    def event(x: Column, _: Column) -> Column:
        return e.fact("corporate_event", e.nid(x["item_code"]), own | cells_of(x, "item_code description"))

    def release(x: Column) -> Column:
        return e.fact("earnings_release", e.nid("earnings"), own | cells_of(x, "period_end_date fiscal_period revenue net_income eps_basic eps_diluted"))

    return [
        ("corporate_event", lambda: each(text.eightk_items(html), event)),
        ("officer_change person", lambda: F.when(F.size(text.eightk_items(html)) > 0, several(prose.officer_changes(html), change)).otherwise(none())), ("earnings_release", lambda: single(prose.earnings(html), release)),
    ]


def offering(form: str, stage: int) -> Callable[[Column], Parts]:
    """Registration statements and prospectuses: the offering, selling holders, underwriters, the use of proceeds."""

    def extract(html: Column) -> Parts:
        issuer = ids.strip_leading_zeros(F.col("cik"))
        e = Emitter(stage, form, issuer)
        own = {"issuer_cik": issuer}

        def seller(x: Column, i: Column) -> Column:
            who = named(x["holder_name"])
            return F.array(e.person(who, x["holder_name"]), e.fact("selling_stockholder", e.nid("ss", i), own | {"person_nid": who} | cells_of(x, "holder_name shares_before shares_offered shares_after")))

        def offered(x: Column) -> Column:
            return e.fact("offering", e.nid("offering"), own | {"currency": F.lit("USD")} | cells_of(x, "offering_type shares_offered price_per_share gross_proceeds net_proceeds"))

        def use(x: Column) -> Column:
            return e.fact("use_of_proceeds", e.nid("uop"), own | cells_of(x, "category amount_usd narrative"))

        return [
            ("offering", lambda: single(prose.offering(html), offered)), ("selling_stockholder person", lambda: several(prose.selling_holders(html), seller)),
            ("underwriter", lambda: each(prose.underwriters(html), lambda x, i: e.fact("underwriter", e.nid("uw", i), own | {"underwriter_name": x}))), ("use_of_proceeds", lambda: single(prose.use_of_proceeds(html), use)),
        ]

    return extract


def metric_facts(doc: Column) -> Column:
    """Company facts; lots count through the whole file."""
    issuer = doc["cik"].cast("string")
    e = Emitter(8, "10-K", issuer)
    names = "tag ddate qtrs uom value dimensional_context"
    return each(forms.fact_list(doc), lambda x, i: e.fact("metric_fact", F.concat_ws("-", x["source_accession"], i.cast("string"), x["tag"]), {"issuer_cik": issuer} | cells_of(x, names), i, form=x["form"], accession=x["source_accession"]))


def _of_form(names: list[str]) -> Column:
    return ids.is_prose(F.col("document")) & F.col("form_type").isin(names)


#: Extractors: name -> (whether a document is one of theirs, what they read it as, its facts).
EXTRACTORS: dict[str, tuple[Callable[[], Column], Callable[[Column], Column], Callable[[Column], Parts]]] = {
    "ownership": (lambda: ids.is_ownership_xml(F.col("document")) & F.contains("text", F.lit("<ownershipDocument")), forms.ownership, ownership),
    "notice": (lambda: ids.is_ownership_xml(F.col("document")) & ~F.contains("text", F.lit("<ownershipDocument")) & forms.is_notice(F.col("text")), forms.notice, sale_notice),
    "placement": (lambda: ids.is_ownership_xml(F.col("document")) & ~F.contains("text", F.lit("<ownershipDocument")) & ~forms.is_notice(F.col("text")) & forms.has_economics(F.col("text")), forms.private_offering, placement),
    "manager": (lambda: ids.is_information_table(F.col("document")), lambda t: F.from_xml(t, forms.TABLE_13F, {"ignoreNamespace": "true"}), manager_table),
    "stake": (lambda: _of_form(STAKE), lambda t: t, stake),
    "proxy": (lambda: _of_form(PROXY), lambda t: t, proxy),
    "report": (lambda: _of_form(REPORT), lambda t: t, current_report),
    "annual": (lambda: _of_form(ANNUAL), lambda t: t, annual),
    "exhibit": (lambda: ids.is_exhibit21(F.col("document")), lambda t: t, exhibit),
    "statement": (lambda: _of_form(STATEMENT), lambda t: t, offering("S-1", 7)),
    "prospectus": (lambda: _of_form(PROSPECTUS), lambda t: t, offering("424B", 8)),
}


def tables_of(extractor: str) -> set[str]:
    """The tables that an extractor gives rows of."""
    return {t for names, _ in EXTRACTORS[extractor][2](F.col("text")) for t in names.split()}


def parse(docs: DataFrame, index: DataFrame, extracted_at: str = "", wanted: tuple[str, ...] = (*COLUMNS, *IDENTITIES)) -> DataFrame:
    """Facts of the documents whose filing is in the index, one row each, by one pass over docs.

    Columns: table, nid, stage, path, place (in the document), kinds (of the document), cells, and provenance. wanted: the
    tables that are asked for; parsers that none of them needs are not planned, and documents of other kinds not read on.
    """
    listed_forms = index.groupBy("accession_number").agg(F.max_by("form_type", F.struct("filed_date", "form_type")).alias("form_type"))
    rows = docs.join(listed_forms, "accession_number")
    used = [n for n in EXTRACTORS if tables_of(n) & set(wanted)]
    is_one = {n: EXTRACTORS[n][0]() for n in used}
    kinds = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in is_one.items()])) if used else F.array().cast("array<string>")
    rows = rows.withColumn("kinds", kinds).where(F.size("kinds") > 0)

    def facts(n: str) -> Column:
        def of(doc: Column) -> Column:
            parts = [make() for names, make in EXTRACTORS[n][2](doc) if set(names.split()) & set(wanted)]
            return F.concat(*parts) if len(parts) > 1 else parts[0]

        return F.when(F.array_contains("kinds", n), bound(EXTRACTORS[n][1](F.col("text")), of)).otherwise(none())

    found = [facts(n) for n in used] or [none()]
    return _exploded(rows.withColumn("facts", F.concat(*found) if len(found) > 1 else found[0]), extracted_at).where(F.col("table").isin(list(wanted)))


def parse_facts(companies: DataFrame, extracted_at: str = "") -> DataFrame:
    """Facts of company-facts JSON (text), as parse() gives them."""
    rows = companies.select(F.lit("").alias("accession_number"), F.lit("").alias("document"), F.array(F.lit("xbrl")).alias("kinds"), F.from_json("text", forms.FACTS).alias("d")).where("d.cik is not null")
    return _exploded(rows.withColumns({"cik": F.col("d.cik").cast("string"), "facts": metric_facts(F.col("d"))}), extracted_at)


def _exploded(rows: DataFrame, extracted_at: str) -> DataFrame:
    rows = rows.select(F.concat_ws("/", "cik", "accession_number", "document").alias("path"), "document", "kinds", F.posexplode("facts").alias("place", "x"))
    x = lambda n: F.col(f"x.{n}")
    url = ids.archives_path(x("owner"), x("accession"), F.col("document"))
    source = [x("form"), x("accession"), F.col("document"), url, x("lot").cast("string"), x("page").cast("string"), x("paragraph").cast("string"), F.lit(extracted_at)]
    return rows.select(x("table").alias("table"), x("nid").alias("nid"), x("stage").alias("stage"), "path", "place", "kinds", x("cells").alias("cells"), *[c.alias(n) for c, n in zip(source, PROVENANCE)])


class FactTables:
    """Tables of parsed facts, each built when it is asked for. facts: the stored facts, or what gives those of some tables."""

    def __init__(self, facts: DataFrame | Callable[[tuple[str, ...]], DataFrame], index: DataFrame, parsed: DataFrame):
        self._facts, self.index, self.parsed = facts, index, parsed

    def facts(self, names: tuple[str, ...] = (*COLUMNS, *IDENTITIES)) -> DataFrame:
        return self._facts(names) if callable(self._facts) else self._facts.where(F.col("table").isin(list(names)))

    def __getitem__(self, name: str) -> DataFrame:
        if name in COLUMNS:
            return projected(self.facts((name,)), COLUMNS[name], PROVENANCE)
        if name in IDENTITIES:
            return projected(identities(self.facts((name,))), IDENTITIES[name], [])
        companies = first_wins(forms.companies(self.parsed), ["cik"], ["name"])
        return {"company": lambda: companies, "filing_index": lambda: self.index, "sic": lambda: companies.where("sic <> ''").groupBy("sic").agg(F.max("sic_description").alias("description"))}[name]()

    def items(self):
        return ((n, self[n]) for n in NAMES)

    def written(self, root: str) -> tuple[FactTables, dict[str, int]]:
        """The facts stored under root, a folder for each table, and (table, rows) as counted by the writing job itself; identities count as often as they are named."""
        counts, facts = Observation("facts"), self.facts()
        seen = facts.observe(counts, *[F.count_if(F.col("table") == t).alias(t) for t in (*COLUMNS, *IDENTITIES)])
        seen.write.mode("overwrite").partitionBy("table").parquet(f"{root}/facts")
        return FactTables(facts.sparkSession.read.schema(facts.schema).parquet(f"{root}/facts"), self.index, self.parsed), counts.get


def projected(rows: DataFrame, columns: str, also: list[str]) -> DataFrame:
    """Facts of one table with their cells as columns."""
    key, *names = columns.split()
    return rows.select(F.col("nid").alias(key), *[F.try_variant_get("cells", f"$.{n}", TYPES.get(n, "string")).alias(n) for n in names], *also)


def identities(facts: DataFrame) -> DataFrame:
    """(table, nid, cells) of people, securities and managers of all forms: the first to name each, by one shuffle for all kinds."""
    return facts.where(F.col("table").isin(list(IDENTITIES))).groupBy("table", "nid").agg(F.min_by("cells", F.struct("stage", "path", "place")).alias("cells"))


def build(docs: DataFrame, index: DataFrame, parsed: DataFrame, companies: DataFrame | None = None, extracted_at: str = "") -> FactTables:
    """Every table of documents, a filing index, parsed submissions and company facts; only extractors of tables that are asked for are planned."""

    def facts(names: tuple[str, ...]) -> DataFrame:
        rows = parse(docs, index, extracted_at, names)
        return rows.unionByName(parse_facts(companies, extracted_at)) if companies is not None and "metric_fact" in names else rows

    return FactTables(facts, index, parsed)


def report(tables: FactTables, names: tuple[str, ...] = NAMES) -> DataFrame:
    """(table, rows) of tables."""
    return reduce(DataFrame.unionByName, [tables[t].agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows") for t in names])
