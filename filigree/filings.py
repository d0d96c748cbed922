"""Queries of the fact tables: filings of every kind, three shapes of each, made from the rows of customer and parsed back.

filings() gives one document for each customer, by one scan: its kind is the customer's number modulo 13, its shape the next
digit modulo 3. Every 97th isn't in the filing index, and its facts must not appear. Each query is one fact table, or what
one kind of filing gives of it, with all columns and provenance; the SQL has the cells that the document states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filigree.operators import forms
from filigree.operators.reshape import PROVENANCE
from filigree.plans import registry, tables
from filigree.session import kept, read_table, spread

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
WHEN = "2024-06-01T00:00:00Z"

_OWNER = "<issuer><issuerCik>000{k}</issuerCik></issuer><reportingOwner><reportingOwnerId><rptOwnerCik>00{k1}</rptOwnerCik><rptOwnerName>{name}</rptOwnerName></reportingOwnerId><reportingOwnerRelationship>%s</reportingOwnerRelationship></reportingOwner>"
_MOVE = "<%sTransaction><securityTitle><value>%s</value></securityTitle><transactionDate><value>2024-01-15</value></transactionDate><transactionCoding><transactionCode>%s</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>{k}</value></transactionShares><transactionPricePerShare><value>%s</value>%s</transactionPricePerShare><transactionAcquiredDisposedCode><value>%s</value></transactionAcquiredDisposedCode></transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>{k2}</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></%sTransaction>"
_HELD = "<%sHolding><securityTitle><value>%s</value></securityTitle><postTransactionAmounts><sharesOwnedFollowingTransaction><value>%s</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>%s</value></directOrIndirectOwnership></ownershipNature></%sHolding>"


def _form(kind: str, flags: str, *parts: str) -> str:
    return f"<ownershipDocument><documentType>{kind}</documentType><periodOfReport>2024-02-01</periodOfReport>{_OWNER % flags}{''.join(parts)}</ownershipDocument>"


def _move(table: str, title: str, code: str, price: str, way: str, note: str = "") -> str:
    return f"<{table}Table>{_MOVE % (table, title, code, price, note, way, table)}</{table}Table>"


def _held(table: str, title: str, shares: str, nature: str) -> str:
    return f"<{table}Table>{_HELD % (table, title, shares, nature, table)}</{table}Table>"


_POSITION = "<{p}infoTable><{p}nameOfIssuer>{issuer}</{p}nameOfIssuer><{p}titleOfClass>COM</{p}titleOfClass><{p}cusip>{cusip}</{p}cusip><{p}value>{value}</{p}value><{p}shrsOrPrnAmt><{p}sshPrnamt>{shares}</{p}sshPrnamt><{p}sshPrnamtType>SH</{p}sshPrnamtType></{p}shrsOrPrnAmt>{more}<{p}votingAuthority><{p}Sole>3</{p}Sole><{p}Shared>2</{p}Shared><{p}None>1</{p}None></{p}votingAuthority></{p}infoTable>"


def _position(p: str, cusip: str, more: str = "") -> str:
    for a, b in (("{p}", p), ("{cusip}", cusip), ("{more}", more), ("{issuer}", "{name} &amp; Sons"), ("{value}", "{n}"), ("{shares}", "{k}")):
        out = (out if a != "{p}" else _POSITION).replace(a, b)
    return out


_COVER = "NAMES OF REPORTING PERSONS\n%s\n(2) CHECK\n(4) WC\n(6) Delaware\n(7) {n}\n(8) 0\n(9) {n}\n(10) 5\n(11) {n}\n(13) 7.5%%\n(14) %s\n"
_OWNERS = "<h2>Security Ownership of Certain Beneficial Owners</h2><table><tr><td>Larch Capital LLC</td><td>{n}</td><td>5.5%</td></tr></table><hr><p></p><table><tr><td>Mary Q Alder</td><td>{n}</td><td>1.2%</td></tr></table>"
_PAY = "<p>Summary Compensation Table</p><table><tr><th>Name</th><th>Year</th><th>Salary</th><th>Total</th></tr><tr><td>Ida B Rowan, Chief Executive Officer</td><td>2023</td><td>$10</td><td>20</td><td>30</td><td>40</td><td>50</td><td>60</td><td>70</td><td>{n}</td></tr><tr><td></td><td>2022</td><td>11</td><td>{n}</td></tr></table><p>Proposal 2 - Report on Peatland Use. A stockholder proposal. The board recommends a vote AGAINST it.</p>"
_RATIO = "<p>2023 CEO pay ratio. Our median employee earned $60,000. The ratio was {k100} to 1.</p><p>KPMG LLP billed in 2023:</p><table><tr><td>Audit Fees</td><td>${n100}</td></tr><tr><td>Tax Fees</td><td>$ 700</td></tr></table>"
_RELATED = "<p>Related Person Transactions</p> In 2023 we paid a firm of a director ${k1} million for work. A fee of $12 was waived. "
_OFFER = "<h1>Prospectus</h1> This is our initial public offering. We are offering {n} shares of common stock at $18.00 per share. We expect net proceeds of ${k1} million. The underwriters are Morgan Stanley and Goldman Sachs."
_SELLERS = "<h2>Selling Stockholders</h2><table><tr><td>Name</td><td>Before</td></tr><tr><td>1</td><td>Quillfen Holdings Trust</td><td>3,141,000</td><td>{n}</td><td>2,718,000</td></tr></table>"

#: kind -> (form, document, three texts); a form or document may differ by shape.
KINDS: list[tuple[str | list[str], str | list[str], list[str]]] = [
    (["4", "4/A", "4"], "form4.xml", [
        _form("4", "<isDirector>1</isDirector><isOfficer>true</isOfficer><isTenPercentOwner>0</isTenPercentOwner><officerTitle>CFO &amp; Treasurer</officerTitle>", _move("nonDerivative", "Common", "P", "2.5", "A")),
        _form("4/A", "<isTenPercentOwner>1</isTenPercentOwner><isOther>true</isOther><officerTitle>none</officerTitle>", _move("nonDerivative", "Common", "S", "5000", "D", '<footnoteId id="F1"/>'), _move("derivative", "Option", "M", "0", "X"), '<footnotes><footnote id="F1">Prices ranging from $10.00 to $12.00.</footnote></footnotes>'),
        "<ownershipDocument><documentType>4</documentType><issuer><issuerCik>{k}</issuerCik></issuer></ownershipDocument>",
    ]),
    (["3", "3/A", "3"], "form3.xml", [_form("3", "<isDirector>1</isDirector>", _held("nonDerivative", "Common", "{k}", "D"), _held("derivative", "Warrant", "5", "I")), _form("3/A", "<isOfficer>1</isOfficer>"), "<ownershipDocument><documentType>3"]),
    (["5", "5/A", "5"], "form5.xml", [
        _form("5", "<isOfficer>1</isOfficer><officerTitle>Clerk</officerTitle>", "<nonDerivativeTable>" + _MOVE % ("nonDerivative", "Common", "G", "4", "", "D", "nonDerivative") + _HELD % ("nonDerivative", "Units", "{k}", "I", "nonDerivative") + "</nonDerivativeTable>"),
        _form("5/A", "", _held("derivative", "Warrant", "7", "I")), _form("5", "<isOther>1</isOther>", _move("nonDerivative", "Common", "J", "0", "A")),
    ]),
    ("144", "primary.xml", [
        "<edgarSubmission><issuerInfo><issuerCik>00{k}</issuerCik></issuerInfo><filerInfo><filerCik>0{k1}</filerCik><filerName>{name}</filerName></filerInfo><securitiesInformation><brokerOrDealerName>Fern &amp; Moss</brokerOrDealerName><securitiesAcquiredDate>2021-09-30</securitiesAcquiredDate><natureOfAcquisitionTransaction>Grant</natureOfAcquisitionTransaction><aggregateMarketValue>{n}</aggregateMarketValue></securitiesInformation>"
        + "".join(f"<securitiesToBeSoldInfo><securitiesClassTitle>Class {c}</securitiesClassTitle><amountOfSecuritiesToBeSold>{{n}}</amountOfSecuritiesToBeSold><approxSaleDate>2024-10-15</approxSaleDate></securitiesToBeSoldInfo>" for c in "AB")
        + "<securitiesSoldInPast3Months><sellerDetails><securitiesClassTitle>Common</securitiesClassTitle><saleDate>2024-08-15</saleDate><amountSold>{k}</amountSold><grossProceeds>${n}</grossProceeds></sellerDetails></securitiesSoldInPast3Months></edgarSubmission>",
        "<edgarSubmission><issuerCik>{k}</issuerCik><filerCik>{k1}</filerCik><filerName>{name}</filerName><sellerDetails><securitiesClassTitle>Units</securitiesClassTitle><saleDate>2024-08-16</saleDate><noOfUnitsSold>9</noOfUnitsSold></sellerDetails></edgarSubmission>",
        "<edgarSubmission><issuerCik>{k}</issuerCik><sellerDetails><saleDate>2024-08-16</saleDate></sellerDetails></edgarSubmission>",
    ]),
    ("D", "primary.xml", [
        "<edgarSubmission><primaryIssuer><cik>0{k}</cik></primaryIssuer><offeringData><totalOfferingAmount>${n}</totalOfferingAmount><totalAmountSold>{k}</totalAmountSold><useOfProceedsSummary>Wells &amp; roads</useOfProceedsSummary></offeringData></edgarSubmission>",
        "<edgarSubmission><primaryIssuer><cik>0{k}</cik></primaryIssuer><relatedPerson><cik>77</cik></relatedPerson><offeringData><totalOfferingAmount>0</totalOfferingAmount><totalNumberAlreadyInvested>12 people</totalNumberAlreadyInvested></offeringData></edgarSubmission>",
        "<edgarSubmission><primaryIssuer><cik>0{k}</cik></primaryIssuer><offeringData><totalOfferingAmount>0</totalOfferingAmount><useOfProceedsSummary>nothing</useOfProceedsSummary></offeringData></edgarSubmission>",
    ]),
    ("13F-HR", ["q_infotable.xml", "13Ftable.xml", "q_infotable.xml"], [
        "<informationTable>" + _position("", "C{k}") + _position("", " ") + _position("", "ALLALIKE9") + "</informationTable>",
        '<n1:informationTable xmlns:n1="u">' + _position("n1:", "D{k}", "<n1:putCall>Put</n1:putCall><n1:investmentDiscretion>SOLE</n1:investmentDiscretion><n1:otherManager>4</n1:otherManager><n1:otherManager>7</n1:otherManager>") + "</n1:informationTable>",
        "<informationTable></informationTable>",
    ]),
    (["SC 13D", "SCHEDULE 13G/A", "SC 13D/A"], ["stake.htm", "x-13G.txt", "stake.htm"], ["<p>ITEM 4. Purpose: to hold. ITEM 5. Interest</p>" + _COVER % ("{name}", "IN"), "<p>(Amendment No. 3)</p>" + _COVER % ("Larch Partners LLC", "OO") + _COVER % ("Ida B Rowan", "IN"), "<p>withdrawn</p>"]),
    ("DEF 14A", "proxy.htm", [_OWNERS, _PAY, _RATIO]),
    ("8-K", "report.htm", ["<p>Item&#160;1.01 Entry into agreement.</p><p>Item 9.01 Exhibits</p>", "<p>Item 5.02 Departure of Officers</p><p>Ms. Rowan will resign as Chief Financial Officer, effective March 3, 2024. ({k})</p>", "<p>Results for the second quarter ended June 30, 2024. Total revenue was ${k1} million. Net income was $7 million, or $1.25 per diluted share.</p>"]),
    (["10-K", "10-K/A", "10-K"], "annual.htm", [_OWNERS, _RELATED, "<p>Nothing to tell</p>"]),
    ("10-K", ["b-ex21.htm", "exhibit-21.txt", "EX21_1.HTML"], ["<p>Larkmoor Mills {k}\tIreland</p><p>Delaware</p>", "Larkmoor Mills {k}    Ireland\nPinecask Funding, Inc.   Nevada", "<p>Voltbarn {k}, LLC</p><p>List of Subsidiaries</p><p>Pinecask Roads, Iowa</p>"]),
    ("S-1", "statement.htm", [_OFFER, _SELLERS, "<p>A memo, with use of proceeds: {k1} roads for $3 million</p>"]),
    ("424B4", "prospectus.htm", [_OFFER, _SELLERS, "<p>Nothing to tell</p>"]),
]


def _text(template: str) -> Column:
    """A template with the customer's values in place of {k} (number), {k1} (+ 1), {k2} (twice), {k100} (+ 100), {n} and {n100} (+ 1,000 and 60,000, with commas), {name}."""
    k = F.col("c_custkey")
    values = {"k": k, "k1": k + 1, "k2": k * 2, "k100": k + 100, "n": F.format_number(k + 1000, 0), "n100": F.format_number(k + 60_000, 0), "name": F.col("c_name")}
    parts = []
    for piece in template.split("{"):
        name, _, rest = piece.partition("}")
        parts += [values[name].cast("string"), F.lit(rest)] if parts else [F.lit(piece)]
    return F.concat(*parts)


def _by(kinds: list[int], of: Callable[[int, int], Column]) -> Column:
    kind, shape = F.col("c_custkey") % len(KINDS), (F.floor(F.col("c_custkey") / len(KINDS)) % 3)
    out = F.when(F.lit(False), F.lit(""))
    for n in kinds:
        for s in range(3):
            out = out.when((kind == n) & (shape == s), of(n, s))
    return out


def filings(spark, d: str, kinds: list[int]) -> tuple[DataFrame, DataFrame]:
    """(documents, filing index) of the wanted kinds."""
    one = lambda x, s: x if isinstance(x, str) else x[s]
    rows = spread(read_table(spark, d, "customer").select("c_custkey", "c_name")).where((F.col("c_custkey") % len(KINDS)).isin(kinds))
    acc = F.concat(F.lit("0000000001-24-"), F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("accession_number")
    cik = F.col("c_custkey").cast("string").alias("cik")
    docs = rows.select(cik, acc, _by(kinds, lambda n, s: F.lit(one(KINDS[n][1], s))).alias("document"), _by(kinds, lambda n, s: _text(KINDS[n][2][s])).alias("text"))
    index = rows.where("c_custkey % 97 <> 0").select(acc, cik, _by(kinds, lambda n, s: F.lit(one(KINDS[n][0], s))).alias("form_type"), F.lit("2024-05-01").alias("filed_date"))
    return docs, index


def facts(spark, d: str, kinds: list[int], *names: str) -> DataFrame:
    docs, index = filings(spark, d, kinds)
    return tables.parse(docs, index, WHEN, names)


# ---- SQL of the same rows ----------------------------------------------------------------------

_BASE = """with d as (select c_custkey as k, c_name as name, cast(c_custkey as varchar) as cik, c_custkey % 13 as kind, (c_custkey // 13) % 3 as shape, '0000000001-24-' || lpad(cast(c_custkey as varchar), 6, '0') as acc from customer where c_custkey % 97 <> 0)\n"""
_TYPES = {"double": "double", "bigint": "bigint"}


def _select(table: str, where: str, nid: str, form: str, document: str, owner: str = "cik", lot: str = "null", page: str = "null", paragraph: str = "null", source: str = "d", **cells: str) -> str:
    """SQL of one fact for each row of source where a condition holds; cells that aren't named are null."""
    key, *names = tables.COLUMNS[table].split()
    typed = [f"cast({cells.get(n, 'null')} as {_TYPES.get(tables.TYPES.get(n), 'varchar')}) as {n}" for n in names]
    url = f"'/Archives/edgar/data/' || ltrim({owner}, '0') || '/' || replace(acc, '-', '') || '/' || {document}"
    prov = [form, "acc", document, url, f"cast({lot} as varchar)", f"cast({page} as varchar)", f"cast({paragraph} as varchar)", f"'{WHEN}'"]
    return f"select {nid} as {key}, {', '.join(typed)}, {', '.join(f'{c} as {n}' for c, n in zip(prov, PROVENANCE))} from {source} where {where}"


def _oracle(*parts: str) -> str:
    return _BASE + "\nunion all\n".join(parts)


def facts_query(name: str, table: str, kinds: list[int], *parts: str) -> None:
    """Registers what some kinds of filings give of a table, with its SQL."""

    def run(spark, d: str) -> DataFrame:
        return tables.projected(facts(spark, d, kinds, table), tables.COLUMNS[table], PROVENANCE)

    run.__name__ = name
    QUERIES[name], ORACLE[name] = run, _oracle(*parts)


_P, _I = "'cik-' || (k + 1)", "cik"
_R = {"owner": "cast(k + 1 as varchar)"}
_T = {"person_nid": _P, "issuer_cik": _I}
_D = {"transaction_date": "'2024-01-15'", "shares": "k", "direct_indirect": "'D'"}
_A = {"as_of_date": "'2024-01-15'", "shares": "k * 2", "direct_indirect": "'D'"}

facts_query(
    "q_facts_transactions", "insider_transaction", [0, 1, 2, 3],
    _select("insider_transaction", "kind = 0 and shape = 0", "acc || '-0-purchase'", "'4'", "'form4.xml'", lot="0", direction="'purchase'", security_title="'Common'", transaction_code="'P'", price_per_share="2.5", total_value="k * 2.5", is_derivative="0", **_T, **_D, **_R),
    _select("insider_transaction", "kind = 0 and shape = 1", "acc || '-0-sale'", "'4/A'", "'form4.xml'", lot="0", direction="'sale'", security_title="'Common'", transaction_code="'S'", price_per_share="11", total_value="k * 11", is_derivative="0", **_T, **_D, **_R),
    _select("insider_transaction", "kind = 2 and shape = 0", "acc || '-0-sale'", "'5'", "'form5.xml'", lot="0", direction="'sale'", security_title="'Common'", transaction_code="'G'", price_per_share="4", total_value="k * 4", is_derivative="0", **_T, **_D, **_R),
    _select("insider_transaction", "kind = 2 and shape = 2", "acc || '-0-purchase'", "'5'", "'form5.xml'", lot="0", direction="'purchase'", security_title="'Common'", transaction_code="'J'", price_per_share="0", total_value="0", is_derivative="0", **_T, **_D, **_R),
    _select("insider_transaction", "kind = 3 and shape = 0", "acc || '-hist-0'", "'144'", "'primary.xml'", lot="2", direction="'sale'", security_title="'Common'", transaction_date="'2024-08-15'", transaction_code="'S'", shares="k", total_value="k + 1000", is_derivative="0", **_T, **_R),
    _select("insider_transaction", "kind = 3 and shape = 1", "acc || '-hist-0'", "'144'", "'primary.xml'", lot="0", direction="'sale'", security_title="'Units'", transaction_date="'2024-08-16'", transaction_code="'S'", shares="9", total_value="0", is_derivative="0", **_T, **_R),
)
facts_query(
    "q_facts_holdings", "holding", [0, 1, 2],
    _select("holding", "kind = 0 and shape < 2", "acc || '-0-h'", "case shape when 0 then '4' else '4/A' end", "'form4.xml'", lot="0", security_title="'Common'", is_derivative="0", **_T, **_A, **_R),
    _select("holding", "kind = 0 and shape = 1", "acc || '-1-h'", "'4/A'", "'form4.xml'", lot="1", security_title="'Option'", is_derivative="1", **_T, **_A, **_R),
    _select("holding", "kind = 1 and shape = 0", "acc || '-h-0'", "'3'", "'form3.xml'", lot="0", security_title="'Common'", as_of_date="'2024-02-01'", shares="k", direct_indirect="'D'", is_derivative="0", **_T, **_R),
    _select("holding", "kind = 1 and shape = 0", "acc || '-h-1'", "'3'", "'form3.xml'", lot="1", security_title="'Warrant'", as_of_date="'2024-02-01'", shares="5", direct_indirect="'I'", is_derivative="1", **_T, **_R),
    _select("holding", "kind = 2 and shape in (0, 2)", "acc || '-0-h'", "'5'", "'form5.xml'", lot="0", security_title="'Common'", is_derivative="0", **_T, **_A, **_R),
    _select("holding", "kind = 2 and shape = 0", "acc || '-sh-0'", "'5'", "'form5.xml'", lot="1", security_title="'Units'", as_of_date="'2024-02-01'", shares="k", direct_indirect="'I'", is_derivative="0", **_T, **_R),
    _select("holding", "kind = 2 and shape = 1", "acc || '-sh-0'", "'5/A'", "'form5.xml'", lot="0", security_title="'Warrant'", as_of_date="'2024-02-01'", shares="7", direct_indirect="'I'", is_derivative="1", **_T, **_R),
)
_ROLE = "(select d.*, r.* from d join (values (0, 0, 'director', null, '4'), (0, 0, 'officer', 'CFO & Treasurer', '4'), (0, 1, 'ten_pct_owner', null, '4/A'), (0, 1, 'other', null, '4/A'), (1, 0, 'director', null, '3'), (1, 1, 'officer', null, '3/A'), (2, 0, 'officer', 'Clerk', '5'), (2, 2, 'other', null, '5')) r(rkind, rshape, role, title, form) on kind = rkind and shape = rshape)"
facts_query(
    "q_facts_roles", "role", [0, 1, 2],
    _select("role", "true", "(k + 1) || '-' || cik || case kind when 1 then '-initial-' else '-' end || role", "form", "case kind when 0 then 'form4.xml' when 1 then 'form3.xml' else 'form5.xml' end", source=_ROLE, role_type="role", officer_title="title", since_date="case kind when 1 then '2024-02-01' end", **_T, **_R),
)
facts_query(
    "q_facts_planned_sales", "planned_sale", [3],
    *[_select("planned_sale", "kind = 3 and shape = 0", f"acc || '-plan-{i}'", "'144'", "'primary.xml'", lot=str(i), security_class=f"'Class {c}'", shares="k + 1000", approx_sale_date="'2024-10-15'", broker_name="'Fern & Moss'", aggregate_market_value="k + 1000", securities_acquired_date="'2021-09-30'", nature_of_acquisition="'Grant'", **_T, **_R) for i, c in enumerate("AB")],
)
_PLACED = {"issuer_cik": _I, "offering_type": "'private_placement'", "currency": "'USD'", "is_overallotment_exercised": "'0'"}
facts_query(
    "q_facts_placements", "offering", [4],
    _select("offering", "kind = 4 and shape < 2", "acc || '-d'", "'D'", "'primary.xml'", gross_proceeds="case shape when 0 then k + 1000 else 0 end", net_proceeds="case shape when 0 then k else 0 end", **_PLACED),
)
facts_query(
    "q_facts_proceeds", "use_of_proceeds", [4, 11],
    _select("use_of_proceeds", "kind = 4 and shape = 0", "acc || '-uop'", "'D'", "'primary.xml'", issuer_cik=_I, category="'general'", narrative="'Wells & roads'"),
    _select("use_of_proceeds", "kind = 11 and shape = 2", "acc || '-uop'", "'S-1'", "'statement.htm'", issuer_cik=_I, category="'general'", amount_usd="3000000", narrative="'use of proceeds: ' || (k + 1) || ' roads for $3 million'"),
)
_HOLD = {"manager_cik": "cik", "name_of_issuer": "name || ' & Sons'", "title_of_class": "'COM'", "value": "k + 1000", "shares": "k", "shares_type": "'SH'", "voting_sole": "3", "voting_shared": "2", "voting_none": "1"}
facts_query(
    "q_facts_positions", "institutional_holding", [5],
    _select("institutional_holding", "kind = 5 and shape = 0", "acc || '-0-C' || cik", "'13F-HR'", "'q_infotable.xml'", lot="0", cusip="'C' || cik", **_HOLD),
    _select("institutional_holding", "kind = 5 and shape = 0", "acc || '-2-ALLALIKE9'", "'13F-HR'", "'q_infotable.xml'", lot="2", cusip="'ALLALIKE9'", **_HOLD),
    _select("institutional_holding", "kind = 5 and shape = 1", "acc || '-0-D' || cik", "'13F-HR'", "'13Ftable.xml'", lot="0", cusip="'D' || cik", put_call="'Put'", investment_discretion="'SOLE'", other_managers="'4,7'", **_HOLD),
)
_PEOPLE13 = "(select d.*, p.* from d join (values (0, 0, 'IN', 'person'), (1, 0, 'OO', 'entity'), (1, 1, 'IN', 'person')) p(pshape, i, type, filer) on shape = pshape)"
_WHO = "case when shape = 0 then name when i = 0 then 'Larch Partners LLC' else 'Ida B Rowan' end"
_NID13 = "'rp-' || case when shape = 0 then lower(replace(name, '#', '')) when i = 0 then 'larch-partners-llc' else 'ida-b-rowan' end"
_FORM13, _DOC13 = "case shape when 0 then 'SC 13D' else 'SC 13G' end", "case shape when 0 then 'stake.htm' else 'x-13G.txt' end"
facts_query(
    "q_facts_stakes", "activist_filing", [6],
    _select("activist_filing", "kind = 6", "acc || '-' || i || '-act'", _FORM13, _DOC13, lot="i", source=_PEOPLE13, filer_nid=_NID13, filer_type="filer", filer_name=_WHO, issuer_cik=_I, security_class="'Common Stock'", aggregate_amount="k + 1000", percent_of_class="7.5", sole_voting_power="k + 1000", shared_voting_power="0", sole_dispositive_power="k + 1000",
            shared_dispositive_power="5", type_of_reporting_person="type", citizenship="'Delaware'", purpose_text="case shape when 0 then 'Purpose: to hold.' else '' end", source_of_funds="'WC'", is_amendment="case shape when 0 then 0 else 1 end"),
)
facts_query(
    "q_facts_stake_groups", "holder_group", [6],
    _select("holder_group", "kind = 6 and shape = 1", "acc || '-grp-1'", "'SC 13G'", "'x-13G.txt'", filer_a_nid="'rp-larch-partners-llc'", filer_b_nid="'rp-ida-b-rowan'", issuer_cik=_I),
)
facts_query(
    "q_facts_stake_holdings", "holding", [6, 7, 9],
    _select("holding", "kind = 6", "acc || '-' || i || '-h'", _FORM13, _DOC13, lot="i", source=_PEOPLE13, person_nid=_NID13, issuer_cik=_I, security_title="'Common Stock'", shares="k + 1000", percent_of_class="7.5", is_derivative="0"),
    *[_select("holding", f"kind = {kind} and shape = 0", f"acc || '-{infix}{i}'", f"'{form}'", f"'{doc}'", page=str(i + 1), paragraph=place, person_nid=f"'p-{nid}'", issuer_cik=_I, security_title="'Common Stock'", shares="k + 1000", percent_of_class=str(pct), is_derivative="0")
      for kind, infix, form, doc in ((7, "", "DEF 14A", "proxy.htm"), (9, "it12-", "10-K", "annual.htm")) for i, (nid, pct, place) in enumerate((("larch-capital-llc", 5.5, "1"), ("mary-q-alder", 1.2, "5")))],
)
facts_query(
    "q_facts_proxy_roles", "role", [7],
    _select("role", "kind = 7 and shape = 0", "acc || '-1-p-mary-q-alder-role'", "'DEF 14A'", "'proxy.htm'", page="2", paragraph="5", person_nid="'p-mary-q-alder'", issuer_cik=_I, role_type="'director_or_officer'"),
)
_PAID = {"person_name": "'Ida B Rowan'", "person_nid": "'p-ida-b-rowan'", "issuer_cik": _I}
facts_query(
    "q_facts_compensation", "compensation", [7],
    _select("compensation", "kind = 7 and shape = 1", "acc || '-comp-0'", "'DEF 14A'", "'proxy.htm'", fiscal_year="2023", salary="10", bonus="20", stock_awards="30", option_awards="40", non_equity_incentive="50", pension_change="60", other_compensation="70", total="k + 1000", **_PAID),
    _select("compensation", "kind = 7 and shape = 1", "acc || '-comp-1'", "'DEF 14A'", "'proxy.htm'", fiscal_year="2022", salary="11", total="k + 1000", **_PAID),
)
facts_query("q_facts_proposals", "proposal", [7], _select("proposal", "kind = 7 and shape = 1", "acc || '-prop-0'", "'DEF 14A'", "'proxy.htm'", issuer_cik=_I, proposal_number="'2'", description="'Report on Peatland Use'", board_recommendation="'AGAINST'", proposal_type="'shareholder'"))
facts_query("q_facts_pay_ratios", "ceo_pay_ratio", [7], _select("ceo_pay_ratio", "kind = 7 and shape = 2", "acc || '-payratio'", "'DEF 14A'", "'proxy.htm'", issuer_cik=_I, fiscal_year="2023", median_employee_comp="60000", ratio="k + 100"))
facts_query("q_facts_audit_fees", "audit_fees", [7], _select("audit_fees", "kind = 7 and shape = 2", "acc || '-auditfees'", "'DEF 14A'", "'proxy.htm'", issuer_cik=_I, fiscal_year="2023", auditor_name="'KPMG'", audit_fees="k + 60000", tax_fees="700"))
facts_query(
    "q_facts_events", "corporate_event", [8],
    *[_select("corporate_event", f"kind = 8 and shape = {s}", f"acc || '-{code}'", "'8-K'", "'report.htm'", issuer_cik=_I, item_code=f"'{code}'", description=f"'{told}'") for s, code, told in ((0, "1.01", "Entry into agreement"), (0, "9.01", "Exhibits"), (1, "5.02", "Departure of OfficersMs"))],
)
facts_query(
    "q_facts_officer_changes", "officer_change", [8],
    _select("officer_change", "kind = 8 and shape = 1", "acc || '-oc-0'", "'8-K'", "'report.htm'", issuer_cik=_I, person_name="'Rowan'", person_nid="'p-rowan'", change_type="'resignation'", position_title="'Chief Financial Officer'", effective_date="'March 3, 2024'", reason_summary="'Item 5.02 Departure of Officers Ms. Rowan will resign as Chief Financial Officer, effective March 3, 2024. (' || k || ')'"),
)
facts_query("q_facts_earnings", "earnings_release", [8], _select("earnings_release", "kind = 8 and shape = 2", "acc || '-earnings'", "'8-K'", "'report.htm'", issuer_cik=_I, period_end_date="'June 30, 2024'", fiscal_period="'second quarter'", revenue="(k + 1) * 1000000.0", net_income="7000000", eps_diluted="1.25"))
facts_query("q_facts_related_parties", "related_party_transaction", [7, 9], _select("related_party_transaction", "kind = 9 and shape = 1", "acc || '-rpt-0'", "'10-K'", "'annual.htm'", issuer_cik=_I, relationship="'director'", year="2023", amount_usd="(k + 1) * 1000000.0", description="'In 2023 we paid a firm of a director $' || (k + 1) || ' million for work'"))
_SUBS = "(select d.*, s.* from d join (values (0, 0, 'Larkmoor Mills ', '', 'Ireland', 'b-ex21.htm'), (1, 0, 'Larkmoor Mills ', '', 'Ireland', 'exhibit-21.txt'), (1, 1, 'Pinecask Funding, Inc.', null, 'Nevada', 'exhibit-21.txt'), (2, 0, 'Pinecask Roads', null, 'Iowa', 'EX21_1.HTML'), (2, 1, 'Voltbarn ', ', LLC', '', 'EX21_1.HTML')) s(sshape, i, head, tail, place, doc) on shape = sshape)"
facts_query("q_facts_subsidiaries", "subsidiary", [10], _select("subsidiary", "kind = 10", "cik || '-' || acc || '-' || i", "'10-K'", "doc", source=_SUBS, parent_cik="cik", name="case when tail is null then head else head || k || tail end", jurisdiction="place"))
_SOLD = {"issuer_cik": _I, "offering_type": "'ipo'", "shares_offered": "k + 1000", "price_per_share": "18", "net_proceeds": "(k + 1) * 1000000.0", "currency": "'USD'"}
_SHAPED = [(11, "S-1", "statement.htm"), (12, "424B", "prospectus.htm")]
facts_query("q_facts_offerings", "offering", [11, 12], *[_select("offering", f"kind = {n} and shape = 0", "acc || '-offering'", f"'{form}'", f"'{doc}'", **_SOLD) for n, form, doc in _SHAPED])
facts_query("q_facts_sellers", "selling_stockholder", [11, 12], *[_select("selling_stockholder", f"kind = {n} and shape = 1", "acc || '-ss-0'", f"'{form}'", f"'{doc}'", person_nid="'p-quillfen-holdings-trust'", holder_name="'Quillfen Holdings Trust'", issuer_cik=_I, shares_before="3141000", shares_offered="k + 1000", shares_after="2718000") for n, form, doc in _SHAPED])
facts_query("q_facts_underwriters", "underwriter", [11, 12], *[_select("underwriter", f"kind = {n} and shape = 0", f"acc || '-uw-{i}'", f"'{form}'", f"'{doc}'", underwriter_name=f"'{bank}'", issuer_cik=_I) for n, form, doc in _SHAPED for i, bank in enumerate(("Goldman Sachs", "Morgan Stanley"))])


def q_facts_metrics(spark, d: str) -> DataFrame:
    """Company facts with forms of their own and without, frames, missing years, two units; lots count through a company's file."""
    s = F.col("s_suppkey").cast("string")
    fact = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    doc = fact('{"cik":', s, ',"facts":{"us-gaap":{"Assets":{"units":{"USD":[{"start":"2020-01-01","end":"2020-12-31","val":', s, '.5,"fy":2020,"fp":"FY","form":"20-F","accn":"a-1"},{"end":"2021-03-31","val":7,"fy":null,"fp":null,"accn":"a-2","frame":"CY2021Q1I"}],"EUR":[{"start":"x","end":"2021-06-30","val":1,"fy":2021,"fp":"Q2","form":"10-Q","accn":"a-1"}]}},"NotWanted":{"units":{"USD":[{"end":"x","val":1,"accn":"x"}]}}},"dei":{"Revenues":{"units":{"USD":[{"start":"","end":"2022-01-01","val":2,"fy":2022,"fp":"Q1","form":"8-K","accn":"a-3"}]}}}}}')
    return tables.projected(tables.parse_facts(read_table(spark, d, "supplier").select(doc.alias("text")), WHEN), tables.COLUMNS["metric_fact"], PROVENANCE)


_METRICS = "(select cast(s_suppkey as varchar) as cik, m.* from supplier, (values (0, 'a-1', 'us-gaap:Assets', '2020-12-31', 4, 'USD', 0.5, '2020FY', '20-F'), (1, 'a-2', 'us-gaap:Assets', '2021-03-31', 0, 'USD', 7, 'CY2021Q1I', '10-K'), (2, 'a-1', 'us-gaap:Assets', '2021-06-30', 1, 'EUR', 1, '2021Q2', '10-Q'), (3, 'a-3', 'dei:Revenues', '2022-01-01', 0, 'USD', 2, '2022Q1', '8-K')) m(i, acc, tag, day, q, unit, v, context, form))"
QUERIES["q_facts_metrics"] = q_facts_metrics
ORACLE["q_facts_metrics"] = _select("metric_fact", "true", "acc || '-' || i || '-' || tag", "form", "''", lot="i", source=_METRICS, issuer_cik="cik", tag="tag", ddate="day", qtrs="q", uom="unit", value="case i when 0 then cast(cik as double) + 0.5 else v end", dimensional_context="context")


def q_facts_people(spark, d: str) -> DataFrame:
    """People of all kinds of filings: the first to name one gives the display name; numbered filers have their number."""
    kinds = [n for n in range(len(KINDS)) if n not in (4, 5, 10)]
    rows = facts(spark, d, kinds, "person")
    return tables.projected(tables.identities(rows), tables.IDENTITIES["person"], [])


QUERIES["q_facts_people"] = q_facts_people
ORACLE["q_facts_people"] = _BASE + """select 'cik-' || (k + 1) as person_nid, name as display_name, cast(k + 1 as varchar) as cik from d where kind in (0, 1, 3) and shape < 2 or kind = 2
union all select distinct 'rp-' || lower(replace(name, '#', '')), name, '' from d where kind = 6 and shape = 0
union all select distinct 'rp-ida-b-rowan', 'Ida B Rowan', '' from d where kind = 6 and shape = 1
union all select distinct case when kind = 8 then 'p-rowan' when kind in (11, 12) then 'p-quillfen-holdings-trust' else 'p-ida-b-rowan' end, case when kind = 8 then 'Rowan' when kind in (11, 12) then 'Quillfen Holdings Trust' else 'Ida B Rowan' end, '' from d where kind in (7, 8, 11, 12) and shape = 1
union all select distinct p.nid, p.name, '' from d, (values ('p-larch-capital-llc', 'Larch Capital LLC'), ('p-mary-q-alder', 'Mary Q Alder')) p(nid, name) where kind in (7, 9) and shape = 0"""


def q_facts_identities(spark, d: str) -> DataFrame:
    """Securities and managers: the first position of each CUSIP; managers by number, entities of stakes by name."""
    found = tables.identities(facts(spark, d, [5, 6], "security", "institutional_manager"))
    return found.select("table", "nid", F.try_variant_get("cells", "$.name", "string").alias("name"), F.try_variant_get("cells", "$.title_of_class", "string").alias("title_of_class"))


QUERIES["q_facts_identities"] = q_facts_identities
ORACLE["q_facts_identities"] = _BASE + """select 'institutional_manager' as "table", cik as nid, cik as name, cast(null as varchar) as title_of_class from d where kind = 5 and shape < 2
union all select distinct 'institutional_manager', 'rp-larch-partners-llc', 'Larch Partners LLC', null from d where kind = 6 and shape = 1
union all select 'security', case shape when 0 then 'C' else 'D' end || cik, name || ' & Sons', 'COM' from d where kind = 5 and shape < 2
union all select 'security', 'ALLALIKE9', min_by(name, cik || '/') || ' & Sons', 'COM' from d where kind = 5 and shape = 0 having count(*) > 0"""


def q_facts_counts(spark, d: str) -> DataFrame:
    """Facts of each table and form, of one parse of filings of all kinds."""
    rows = facts(spark, d, list(range(len(KINDS))), *tables.COLUMNS)
    return rows.groupBy("table", "source_form").agg(F.count("*").alias("rows"))


def _counts_sql() -> str:
    """Counts of what the queries above give of each table."""
    parts = [f"select '{t}' as \"table\", source_form from ({ORACLE[n].removeprefix(_BASE)})" for n, t in _TABLE_OF.items()]
    return _BASE + 'select "table", source_form, count(*) as "rows" from (' + " union all ".join(parts) + ") group by all"


#: The queries that together have every fact of filings(), and their tables.
_TABLE_OF = {
    "q_facts_transactions": "insider_transaction", "q_facts_holdings": "holding", "q_facts_stake_holdings": "holding", "q_facts_roles": "role", "q_facts_proxy_roles": "role", "q_facts_planned_sales": "planned_sale", "q_facts_placements": "offering",
    "q_facts_offerings": "offering", "q_facts_positions": "institutional_holding", "q_facts_stakes": "activist_filing", "q_facts_stake_groups": "holder_group", "q_facts_compensation": "compensation", "q_facts_proposals": "proposal",
    "q_facts_pay_ratios": "ceo_pay_ratio", "q_facts_audit_fees": "audit_fees", "q_facts_events": "corporate_event", "q_facts_officer_changes": "officer_change", "q_facts_earnings": "earnings_release", "q_facts_related_parties": "related_party_transaction",
    "q_facts_subsidiaries": "subsidiary", "q_facts_sellers": "selling_stockholder", "q_facts_underwriters": "underwriter", "q_facts_proceeds": "use_of_proceeds",
}
QUERIES["q_facts_counts"] = q_facts_counts
ORACLE["q_facts_counts"] = _counts_sql()


# ---- the registry's graph ------------------------------------------------------------------------

_GRAPH_KINDS = [0, 1, 2, 8]
_GRAPH_NODES = ("Company", "SicCode", "Person", "Filing", "InsiderTransaction", "Holding", "Role", "CorporateEvent")


def q_registry_graph(spark, d: str) -> DataFrame:
    """The fingerprint of the registry's graph over insider forms and current reports: nodes of each label, edges of each type, the first ids. Facts are parsed once and stored; every second company is known."""
    docs, index = filings(spark, d, _GRAPH_KINDS)
    k = F.col("c_custkey")
    known = read_table(spark, d, "customer").where((k % 2 == 0) & (k % len(KINDS)).isin(_GRAPH_KINDS))
    sic = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("70"), k % 5))
    parsed = forms.submissions(known.select(F.to_json(F.struct(F.lpad(k.cast("string"), 10, "0").alias("cik"), F.col("c_name").alias("name"), sic.alias("sic"), F.lit("Mills").alias("sicDescription"))).alias("value")))
    facts_ = kept(tables.parse(docs, index, WHEN, ("insider_transaction", "holding", "role", "corporate_event", "person")))
    index = index.withColumns({"report_date": F.lit(""), "primary_document": F.lit("")})
    return registry.graph(tables.FactTables(facts_, index, parsed), _GRAPH_NODES).fingerprint()


QUERIES["q_registry_graph"] = q_registry_graph
_OWN = {n: f"({ORACLE[q].removeprefix(_BASE)})" for n, q in (("tx", "q_facts_transactions"), ("held", "q_facts_holdings"), ("role", "q_facts_roles"), ("ev", "q_facts_events"))}
ORACLE["q_registry_graph"] = (
    _BASE.rstrip()
    + f""", co as (select cast(c_custkey as varchar) as cik, case when c_custkey % 3 = 0 then '' else '70' || (c_custkey % 5) end as sic from customer where c_custkey % 2 = 0 and c_custkey % 13 in (0, 1, 2, 8)),
f as (select * from d where kind in (0, 1, 2, 8)), tx as (select * from {_OWN["tx"]} where source_form <> '144'), held as (select * from {_OWN["held"]}), role as (select * from {_OWN["role"]}), ev as (select * from {_OWN["ev"]}),
days as (select cast(unnest(generate_series(date '1994-01-01', date '2031-12-31', interval 1 day)) as date) as day),
who as (select 'cik-' || (k + 1) as nid from f where kind in (0, 1) and shape < 2 or kind = 2 union all select distinct 'p-rowan' from f where kind = 8 and shape = 1),
n as (select 'Company' as label, cik as id from co union all select 'SicCode', sic from (select distinct sic from co where sic <> '') union all select 'Person', nid from who union all select 'Filing', acc from f
    union all select 'InsiderTransaction', transaction_nid from tx union all select 'Holding', holding_nid from held union all select 'Role', role_nid from role union all select 'CorporateEvent', event_nid from ev
    union all select 'Day', cast(day as varchar) from days union all select 'InsiderActivity', person_nid || '|' || issuer_cik from tx),
e as (select 'IN_INDUSTRY' as type from co where sic <> '' union all select 'FILED_BY' from f where cik in (select cik from co) union all select 'BY_INSIDER' from tx union all select 'IN_COMPANY' from tx where issuer_cik in (select cik from co)
    union all select 'REPORTED_IN' from (select source_accession from tx union all select source_accession from held union all select source_accession from role union all select source_accession from ev)
    union all select 'OWNED_BY' from held union all select 'IN_COMPANY' from held where issuer_cik in (select cik from co) union all select 'OF_PERSON' from role
    union all select 'AT_COMPANY' from role where issuer_cik in (select cik from co) union all select 'AT_COMPANY' from ev where issuer_cik in (select cik from co)
    union all select 'NEXT_DAY' from days where day < date '2031-12-31' union all select 'FILED_ON' from f union all select 'TRADED_ON' from tx union all select 'HELD_ON' from held where as_of_date is not null
    union all select 'ACTIVITY_OF' from tx union all select 'ACTIVITY_AT' from tx where issuer_cik in (select cik from co))
select 'label' as what, label as name, count(*) as n from n group by label union all select 'edge', type, count(*) from e group by type union all select 'id', id, 0 from (select id, label from n order by id, label limit 25)"""
)
