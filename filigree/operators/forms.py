"""Structured filings: ownership forms, sale notices, private offerings, manager holdings, company facts, submissions.

Each parser takes a DataFrame with a text column and adds a struct; each emitter turns parsed rows into fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from filigree.functions import ids, money
from filigree.functions.geo import bound



def _ownership_schema(whole: bool, transactions: bool = True, roles: bool = True, holdings: bool = True) -> str:
    """An ownership form's elements; those of a few texts are structs if whole, else maps, which from_xml fills sooner."""
    few = lambda names: f"struct<{','.join(f'{n}:string' for n in names.split())}>" if whole else "map<string,string>"
    v = few("value")
    after = f"postTransactionAmounts:struct<sharesOwnedFollowingTransaction:{v}>,ownershipNature:struct<directOrIndirectOwnership:{v}>"
    traded = f"transactionAmounts:struct<transactionShares:{v},transactionPricePerShare:struct<value:string,footnoteId:array<struct<_id:string>>>,transactionAcquiredDisposedCode:{v}>"
    tx = f"array<struct<securityTitle:{v},transactionDate:{v},transactionCoding:{few('transactionCode equitySwapInvolved')},{traded},{after}>>"
    table = lambda kind: f"{kind}Table struct<{','.join([f'{kind}Transaction:{tx}'] * transactions + [f'{kind}Holding:array<struct<securityTitle:{v},{after}>>'] * holdings)}>"
    owner = [f"reportingOwnerId:{few('rptOwnerCik rptOwnerName')}"] + [f"reportingOwnerRelationship:{few('isDirector isOfficer isTenPercentOwner isOther officerTitle')}"] * roles
    fields = ["documentType string", "periodOfReport string", f"issuer {few('issuerCik issuerName issuerTradingSymbol')}", f"reportingOwner array<struct<{','.join(owner)}>>"]
    fields += [table("nonDerivative"), table("derivative")] * (transactions or holdings) + ["footnotes struct<footnote:array<struct<_id:string,_VALUE:string>>>"] * transactions
    return ", ".join(fields)


OWNERSHIP = _ownership_schema(True)
TABLE_13F = (
    "infoTable array<struct<nameOfIssuer:string,titleOfClass:string,cusip:string,figi:string,value:string,shrsOrPrnAmt:struct<sshPrnamt:string,sshPrnamtType:string>,putCall:string,investmentDiscretion:string,"
    "otherManager:array<string>,votingAuthority:struct<Sole:string,Shared:string,None:string>>>"
)
_FACT = "array<struct<start:string,end:string,val:double,fy:int,fp:string,form:string,accn:string,frame:string>>"
FACTS = f"cik bigint, entityName string, facts map<string,map<string,struct<units:map<string,{_FACT}>>>>"
SUBMISSION = (
    "cik string, name string, sic string, sicDescription string, stateOfIncorporation string, fiscalYearEnd string, tickers array<string>, exchanges array<string>, entityType string,"
    "formerNames array<struct<name:string,`from`:string,`to`:string>>,"
    "filings struct<recent:struct<accessionNumber:array<string>,filingDate:array<string>,reportDate:array<string>,form:array<string>,primaryDocument:array<string>>>"
)
#: Concepts kept of company facts (fixed values).
CONCEPTS = """
Revenues RevenueFromContractWithCustomerExcludingAssessedTax CostOfRevenue GrossProfit OperatingIncomeLoss NetIncomeLoss
EarningsPerShareBasic EarningsPerShareDiluted ResearchAndDevelopmentExpense SellingGeneralAndAdministrativeExpense
Assets AssetsCurrent Liabilities LiabilitiesCurrent StockholdersEquity CashAndCashEquivalentsAtCarryingValue
LongTermDebtNoncurrent RetainedEarningsAccumulatedDeficit
NetCashProvidedByUsedInOperatingActivities NetCashProvidedByUsedInInvestingActivities NetCashProvidedByUsedInFinancingActivities
CommonStockSharesOutstanding WeightedAverageNumberOfSharesOutstandingBasic WeightedAverageNumberOfDilutedSharesOutstanding
""".split()


def parse_xml(docs: DataFrame, schema: str, into: str, text: str = "text") -> DataFrame:
    """docs with the parsed text in a column; docs that have been parsed already stay as they are."""
    if into in docs.columns:
        return docs
    return docs.withColumn(into, F.from_xml(text, schema, {"ignoreNamespace": "true"}))


def _like(x: Column, given: DataType, wanted: DataType) -> Column:
    """A parsed value with maps in place of structs, where they are wanted."""
    if isinstance(wanted, MapType):
        return F.when(x.isNotNull(), F.create_map(*[c for n in given.names for c in (F.lit(n), x[n])]))
    if isinstance(wanted, ArrayType):
        return F.transform(x, lambda e: _like(e, given.elementType, wanted.elementType))
    if isinstance(wanted, StructType):
        return F.when(x.isNotNull(), F.struct(*[_like(x[f.name], given[f.name].dataType, f.dataType).alias(f.name) for f in wanted]))
    return x


def ownership(text: Column, **parts: bool) -> Column:
    """An ownership form's parsed text, with the parts that are wanted; small elements are maps.

    Text where elements should stand is no map: such forms, and broken ones, are parsed again with structs, which pass over it.
    """
    small, whole = _ownership_schema(False, **parts), _ownership_schema(True, **parts)
    types = [StructType.fromDDL(s) for s in (whole, small)]

    def read(x: Column) -> Column:
        again = bound(F.from_xml(x["text"], whole, {"ignoreNamespace": "true"}), lambda d: F.struct(*[_like(d[f.name], types[0][f.name].dataType, f.dataType).alias(f.name) for f in types[1]], F.lit(None).cast("string").alias("_corrupt_record")))
        return F.when(x["d"]["_corrupt_record"].isNull(), x["d"]).otherwise(again)

    return bound(F.struct(text.alias("text"), F.from_xml(text, small + ", _corrupt_record string", {"ignoreNamespace": "true"}).alias("d")), read)


# ---- leaves: elements found by name wherever they stand ---------------------------------------


def leaves(text: Column, *names: str) -> Column:
    """The texts of the elements of these names, in order, trimmed and with references decoded; empty ones are left out."""
    found = F.regexp_extract_all(text, F.lit(rf"<({'|'.join(names)})(?:\s[^<>]*)?>\s*+([^<]*)</\1>"), F.lit(2))
    decoded = lambda x: F.when(F.contains(x, F.lit("&")), F.from_xml(F.concat(F.lit("<r><v>"), x, F.lit("</v></r>")), "v string")["v"]).otherwise(x)
    return F.transform(F.filter(F.transform(found, lambda x: F.rtrim(x)), lambda x: x != ""), decoded)


def leaf(text: Column, *names: str) -> Column:
    """The last of leaves(), '' without one."""
    return F.coalesce(F.try_element_at(leaves(text, *names), F.lit(-1)), F.lit(""))


def blocks(text: Column, name: str) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{name}(?:\s[^<>]*)?>(.*?)</{name}>"), F.lit(1))


def notice(text: Column) -> Column:
    """A sale notice as struct<filer_cik, filer_name, issuer_cik, broker_name, aggregate_market_value, securities_acquired_date, nature_of_acquisition, planned, past>."""
    amount = lambda x, *names: money.number(leaf(x, *names))
    planned = F.transform(blocks(text, "securitiesToBeSoldInfo"), lambda b: F.struct(leaf(b, "securitiesClassTitle").alias("security_class"), amount(b, "noOfUnitsToBeSold", "amountOfSecuritiesToBeSold").alias("shares"), leaf(b, "approxSaleDate").alias("approx_sale_date")))
    past = F.transform(blocks(text, "sellerDetails"), lambda b: F.struct(leaf(b, "securitiesClassTitle").alias("security_title"), leaf(b, "saleDate").alias("transaction_date"), amount(b, "amountSold", "noOfUnitsSold").alias("shares"), amount(b, "grossProceeds").alias("total_value")))
    return F.struct(
        leaf(text, "filerCik", "personCik").alias("filer_cik"), leaf(text, "personName", "filerName").alias("filer_name"), leaf(text, "issuerCik").alias("issuer_cik"), leaf(text, "brokerName", "brokerOrDealerName").alias("broker_name"),
        amount(text, "aggregateMarketValue").alias("aggregate_market_value"), leaf(text, "securitiesAcquiredDate").alias("securities_acquired_date"), leaf(text, "natureOfAcquisitionTransaction").alias("nature_of_acquisition"), planned.alias("planned"), past.alias("past"),
    )


def private_offering(text: Column) -> Column:
    """A private placement's notice as struct<issuer_cik, gross_proceeds, net_proceeds, investors, narrative>."""
    first = F.coalesce(F.try_element_at(leaves(text, "cik"), F.lit(1)), F.lit(""))
    return F.struct(
        first.alias("issuer_cik"), money.number(leaf(text, "totalOfferingAmount")).alias("gross_proceeds"), money.number(leaf(text, "totalAmountSold")).alias("net_proceeds"),
        F.coalesce(money.digits_only(leaf(text, "totalNumberAlreadyInvested")), F.lit(0)).alias("investors"), leaf(text, "useOfProceedsSummary").alias("narrative"),
    )


def is_notice(text: Column) -> Column:
    return text.rlike("<(?:securitiesToBeSoldInfo|sellerDetails)[\\s>]")


def has_economics(text: Column) -> Column:
    offering = private_offering(text)
    return text.rlike("<(?:totalOfferingAmount|totalAmountSold|totalNumberAlreadyInvested)[\\s>]") & ((offering["gross_proceeds"] != 0) | (offering["net_proceeds"] != 0) | (offering["investors"] != 0))


def classify(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with kind: form3, form4, form5, form144, formd or failed, by what their content has."""
    whole = F.col(text)
    form = F.regexp_extract(leaf(whole, "documentType"), r"^([345])(?:/A)?$", 1)
    return docs.withColumn("kind", F.when(form != "", F.concat(F.lit("form"), form)).when(is_notice(whole), F.lit("form144")).when(has_economics(whole), F.lit("formd")).otherwise(F.lit("failed")))


# ---- ownership forms, from their parsed XML ----------------------------------------------------


def owner_of(doc: Column) -> Column:
    """The last reporting owner, as later ones overwrite earlier ones."""
    return F.try_element_at(doc["reportingOwner"], F.lit(-1))


def reporter_cik(doc: Column) -> Column:
    return ids.strip_leading_zeros(owner_of(doc)["reportingOwnerId"]["rptOwnerCik"])


def issuer_cik(doc: Column) -> Column:
    return ids.strip_leading_zeros(doc["issuer"]["issuerCik"])


def _tagged(plain: Column, derivative: Column) -> Column:
    """Both tables' entries in order, each with its flag."""
    def flagged(a: Column, flag: int) -> Column:
        return F.coalesce(F.transform(a, lambda t: F.struct(t.alias("t"), F.lit(flag).alias("is_derivative"))), F.array())

    return F.concat(flagged(plain, 0), flagged(derivative, 1))


def transactions(doc: Column) -> Column:
    """array<struct> of an ownership form's transactions, non-derivative first; prices are repaired from their footnotes."""
    notes = F.map_from_entries(F.transform(F.coalesce(doc["footnotes"]["footnote"], F.array().cast("array<struct<_id:string,_VALUE:string>>")), lambda n: F.struct(n["_id"], n["_VALUE"])))

    def read(x: Column, notes: Column) -> Column:
        t = x["t"]
        amounts = t["transactionAmounts"]
        marks = F.coalesce(amounts["transactionPricePerShare"]["footnoteId"], F.array().cast("array<struct<_id:string>>"))
        given = F.struct(
            money.number(amounts["transactionPricePerShare"]["value"], "").alias("price"), money.number(amounts["transactionShares"]["value"], "").alias("shares"),
            F.array_join(F.transform(marks, lambda f: F.try_element_at(notes, f["_id"])), " ").alias("note"),
        )

        def priced(g: Column) -> Column:
            span = F.when(g["note"] != "", money.price_range(g["note"]))
            repaired = F.when(g["note"] == "", g["price"]).otherwise(bound(span, lambda p: F.coalesce(money.repaired_price(g["price"], p["low"], p["high"]), g["price"])))
            return bound(F.struct(g["shares"].alias("shares"), repaired.alias("price"), g["note"].alias("note")), row)

        def row(g: Column) -> Column:
            return F.struct(
                t["securityTitle"]["value"].alias("security_title"), t["transactionDate"]["value"].alias("transaction_date"), t["transactionCoding"]["transactionCode"].alias("transaction_code"), amounts["transactionAcquiredDisposedCode"]["value"].alias("acquired_disposed"),
                g["shares"].alias("shares"), g["price"].alias("price_per_share"), F.when((g["shares"] > 0) & (g["price"] > 0), g["shares"] * g["price"]).otherwise(F.lit(0.0)).alias("total_value"), t["ownershipNature"]["directOrIndirectOwnership"]["value"].alias("direct_indirect"),
                x["is_derivative"].alias("is_derivative"), money.number(t["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]["value"], "").alias("owned_after"), g["note"].alias("footnote_text"),
            )

        return bound(given, priced)

    both = _tagged(doc["nonDerivativeTable"]["nonDerivativeTransaction"], doc["derivativeTable"]["derivativeTransaction"])
    return bound(notes, lambda n: F.transform(both, lambda x: read(x, n)))


def transaction_count(doc: Column) -> Column:
    return sum((F.greatest(F.coalesce(F.size(a), F.lit(0)), F.lit(0)) for a in (doc["nonDerivativeTable"]["nonDerivativeTransaction"], doc["derivativeTable"]["derivativeTransaction"])), F.lit(0))


def roles(doc: Column) -> Column:
    """array<struct<role_type, officer_title>>: one for each flag that is set; the title is the officer's."""
    rel = owner_of(doc)["reportingOwnerRelationship"]
    flags = {"isDirector": "director", "isOfficer": "officer", "isTenPercentOwner": "ten_pct_owner", "isOther": "other"}
    title = lambda k: rel["officerTitle"] if k == "isOfficer" else F.lit(None).cast("string")
    return F.array_compact(F.array(*[F.when(money.truthy(rel[k]), F.struct(F.lit(v).alias("role_type"), title(k).alias("officer_title"))) for k, v in flags.items()]))


def holdings(doc: Column) -> Column:
    """array<struct> of the holdings that an ownership form states besides transactions."""
    def read(x: Column) -> Column:
        t = x["t"]
        shares = money.number(t["postTransactionAmounts"]["sharesOwnedFollowingTransaction"]["value"], "")
        return F.struct(t["securityTitle"]["value"].alias("security_title"), doc["periodOfReport"].alias("as_of_date"), shares.alias("shares"), t["ownershipNature"]["directOrIndirectOwnership"]["value"].alias("direct_indirect"), x["is_derivative"].alias("is_derivative"))

    return F.transform(_tagged(doc["nonDerivativeTable"]["nonDerivativeHolding"], doc["derivativeTable"]["derivativeHolding"]), read)


def positions(doc: Column) -> Column:
    """array<struct> of a manager's positions; position counts them before those without a CUSIP go."""
    num = lambda c: money.number(c, ",")

    def read(h: Column, i: Column) -> Column:
        return F.struct(
            i.alias("position"), h["cusip"].alias("cusip"), h["nameOfIssuer"].alias("name_of_issuer"), h["titleOfClass"].alias("title_of_class"), h["figi"].alias("figi"), num(h["value"]).alias("value"), num(h["shrsOrPrnAmt"]["sshPrnamt"]).alias("shares"),
            h["shrsOrPrnAmt"]["sshPrnamtType"].alias("shares_type"), h["putCall"].alias("put_call"), h["investmentDiscretion"].alias("investment_discretion"), num(h["votingAuthority"]["Sole"]).alias("voting_sole"), num(h["votingAuthority"]["Shared"]).alias("voting_shared"),
            num(h["votingAuthority"]["None"]).alias("voting_none"), F.array_join(h["otherManager"], ",").alias("other_managers"),
        )

    return F.filter(F.transform(doc["infoTable"], read), lambda h: F.coalesce(F.trim(h["cusip"]), F.lit("")) != "")


def _each(docs: DataFrame, text: str, found: Column, schema: str | None, *also: Column) -> DataFrame:
    """A row for each element of an array of structs, with its place as lot."""
    rows = parse_xml(docs, schema, "d", text) if schema else docs
    names = [c for c in docs.columns if c not in (text, "d")]
    return rows.select(*names, *also, F.posexplode(found).alias("lot", "x")).select(*names, "lot", *[c for c in rows.select(*also).columns], "x.*")


def _parties(doc: Column) -> list[Column]:
    return [ids.person_id(reporter_cik(doc)).alias("person_nid"), issuer_cik(doc).alias("issuer_cik")]


def _form(docs: DataFrame, text: str, **parts: bool) -> DataFrame:
    return docs if "d" in docs.columns else docs.withColumn("d", ownership(F.col(text), **parts))


def ownership_transactions(docs: DataFrame, text: str = "text") -> DataFrame:
    """Transactions of ownership forms, numbered by lot."""
    return _each(_form(docs, text, roles=False, holdings=False), text, transactions(F.col("d")), OWNERSHIP, *_parties(F.col("d")))


def ownership_roles(docs: DataFrame, text: str = "text") -> DataFrame:
    """Roles of an ownership form's owner: one row for each flag that is set."""
    return _each(_form(docs, text, transactions=False, holdings=False), text, roles(F.col("d")), OWNERSHIP, *_parties(F.col("d")))


def ownership_holdings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Holdings that an ownership form states besides transactions, numbered by lot."""
    return _each(_form(docs, text, transactions=False, roles=False), text, holdings(F.col("d")), OWNERSHIP, *_parties(F.col("d")))


def manager_holdings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Positions of a manager's information table."""
    return _each(docs, text, positions(F.col("d")), TABLE_13F).drop("lot")


def planned_sales(docs: DataFrame, text: str = "text") -> DataFrame:
    """Sales that a notice plans."""
    n = notice(F.col(text))
    return _each(docs, text, n["planned"], None, ids.strip_leading_zeros(n["issuer_cik"]).alias("issuer_cik"), n["filer_name"].alias("seller"))


def past_sales(docs: DataFrame, text: str = "text") -> DataFrame:
    """Sales of the last three months that a notice lists, numbered after its planned ones."""
    n = notice(F.col(text))
    rows = _each(docs, text, n["past"], None, ids.strip_leading_zeros(n["issuer_cik"]).alias("issuer_cik"), n["filer_name"].alias("seller"), F.size(n["planned"]).alias("_n"))
    return rows.withColumn("lot", F.col("lot") + F.col("_n")).drop("_n")


def private_offerings(docs: DataFrame, text: str = "text") -> DataFrame:
    """The offerings that notices of private placements state; notices without amounts or investors go."""
    names = [c for c in docs.columns if c != text]
    x = private_offering(F.col(text))
    return docs.where(has_economics(F.col(text))).select(*names, x.alias("x")).select(*names, ids.strip_leading_zeros(F.col("x.issuer_cik")).alias("issuer_cik"), F.lit("private_placement").alias("offering_type"), "x.gross_proceeds", "x.net_proceeds", "x.narrative")


def fact_list(doc: Column, concepts: list[str] | None = None) -> Column:
    """array<struct> of a company's facts of the wanted concepts, in order of taxonomy, concept, unit and place, as they stand in the file."""
    wanted = concepts or CONCEPTS
    blank = lambda c: F.coalesce(c, F.lit(""))

    def read(f: Column, tag: Column, uom: Column, place: Column) -> Column:
        context = F.when(blank(f["frame"]) != "", f["frame"]).otherwise(F.concat(F.coalesce(f["fy"], F.lit(0)).cast("string"), blank(f["fp"])))
        qtrs = F.when(blank(f["start"]) == "", 0).when(f["fp"] == "FY", 4).when(f["fp"].isin("Q1", "Q2", "Q3", "Q4"), 1).otherwise(0)
        form = F.when(blank(f["form"]) == "", F.lit("10-K")).otherwise(f["form"])
        return F.struct(tag.alias("tag"), place.alias("place"), f["end"].alias("ddate"), qtrs.alias("qtrs"), uom.alias("uom"), f["val"].alias("value"), context.alias("dimensional_context"), f["accn"].alias("source_accession"), form.alias("form"))

    def of_units(tag: Column, units: Column) -> Column:
        return F.flatten(F.transform(F.map_entries(units), lambda u: F.transform(F.coalesce(u["value"], F.array().cast(_FACT)), lambda f, i: read(f, tag, u["key"], i))))

    def of_taxonomy(t: Column) -> Column:
        kept = F.filter(F.map_entries(t["value"]), lambda c: c["key"].isin(wanted) & c["value"]["units"].isNotNull())
        return F.flatten(F.transform(kept, lambda c: of_units(F.concat_ws(":", t["key"], c["key"]), c["value"]["units"])))

    return F.flatten(F.transform(F.filter(F.map_entries(doc["facts"]), lambda t: t["value"].isNotNull()), of_taxonomy))


def company_facts(docs: DataFrame, concepts: list[str] | None = None, text: str = "text") -> DataFrame:
    """Facts of company-facts JSON, one row each."""
    rows = docs.select(F.from_json(text, FACTS).alias("d"))
    return rows.select(F.col("d.cik").alias("issuer_cik"), F.explode(fact_list(F.col("d"), concepts)).alias("x")).select("issuer_cik", "x.tag", "x.place", "x.ddate", "x.qtrs", "x.uom", "x.value", "x.dimensional_context", "x.source_accession")


def submissions(docs: DataFrame, text: str = "value") -> DataFrame:
    """Company records with their parallel filing arrays."""
    return docs.withColumn("s", F.from_json(text, SUBMISSION)).where("s is not null")


def companies(parsed: DataFrame) -> DataFrame:
    s = F.col("s")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return parsed.where((blank(s["cik"]) != "") & (blank(s["name"]) != "")).select(
        ids.strip_leading_zeros(s["cik"]).alias("cik"), s["name"].alias("name"), blank(s["sic"]).alias("sic"), blank(s["sicDescription"]).alias("sic_description"), blank(s["stateOfIncorporation"]).alias("state_of_incorporation"), blank(s["fiscalYearEnd"]).alias("fiscal_year_end"),
        F.array_join(s["tickers"], "; ").alias("tickers"), F.array_join(s["exchanges"], "; ").alias("exchanges"), blank(s["entityType"]).alias("entity_type"), ids.former_names(s["formerNames"]).alias("former_names"),
    )


def filing_index(parsed: DataFrame) -> DataFrame:
    """One row for each filing; arrays that are too short give empty cells, and filings without a number go."""
    r = F.col("s.filings.recent")
    given = lambda c: F.coalesce(r[c], F.array().cast("array<string>"))
    zipped = F.arrays_zip(given("accessionNumber").alias("a"), given("form").alias("f"), given("filingDate").alias("d"), given("reportDate").alias("r"), given("primaryDocument").alias("p"))
    x = F.col("x")
    blank = lambda c: F.coalesce(c, F.lit(""))
    return parsed.select(ids.strip_leading_zeros(F.col("s.cik")).alias("cik"), F.explode(zipped).alias("x")).where(blank(x["a"]) != "").select(x["a"].alias("accession_number"), "cik", blank(x["f"]).alias("form_type"), blank(x["d"]).alias("filed_date"), blank(x["r"]).alias("report_date"), blank(x["p"]).alias("primary_document"))
