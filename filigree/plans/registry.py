"""The filing registry's graph: which tables are nodes, which columns are edges, and what is computed from them."""

from __future__ import annotations

from filigree.plans.blueprint import Graph, compile_blueprint
from filigree.plans.tables import FactTables

#: Node types: table, key, title, and edges as TYPE>Target(column) (fixed values).
NODES = """
Company company cik name IN_INDUSTRY>SicCode(sic)
SicCode sic sic description
Person person person_nid display_name
Security security cusip name
InstitutionalManager institutional_manager manager_cik name
Filing filing_index accession_number primary_document FILED_BY>Company(cik)
InsiderTransaction insider_transaction transaction_nid security_title BY_INSIDER>Person(person_nid) IN_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Holding holding holding_nid security_title OWNED_BY>Person(person_nid) IN_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
InstitutionalHolding institutional_holding institutional_holding_nid name_of_issuer OWNED_BY>InstitutionalManager(manager_cik) OF_SECURITY>Security(cusip) REPORTED_IN>Filing(source_accession)
Role role role_nid role_type OF_PERSON>Person(person_nid) AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Compensation compensation compensation_nid person_name OF_PERSON>Person(person_nid) AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Proposal proposal proposal_nid description AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
CeoPayRatio ceo_pay_ratio ceo_pay_ratio_nid fiscal_year FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
AuditFees audit_fees audit_fees_nid auditor_name FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
RelatedPartyTransaction related_party_transaction rpt_nid description AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
CorporateEvent corporate_event event_nid description AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
OfficerChange officer_change officer_change_nid person_name OF_PERSON>Person(person_nid) AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
EarningsRelease earnings_release earnings_release_nid fiscal_period FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Offering offering offering_nid offering_type FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
SellingStockholder selling_stockholder ss_nid holder_name OF_PERSON>Person(person_nid) AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Underwriter underwriter underwriter_nid underwriter_name FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
UseOfProceeds use_of_proceeds uop_nid category FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
ActivistFiling activist_filing activist_filing_nid filer_name AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
HolderGroup holder_group group_link_nid group_link_nid AT_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
MetricFact metric_fact metric_fact_nid tag FOR_COMPANY>Company(issuer_cik) REPORTED_IN>Filing(source_accession)
Subsidiary subsidiary subsidiary_nid name SUBSIDIARY_OF>Company(parent_cik) REPORTED_IN>Filing(source_accession)
"""
#: What is computed, in order (fixed values).
COMPUTE = [
    {"op": "derive", "from": "Filing", "set": {"filing_year": "year(filed_date)", "is_annual": "form_type == '10-K'", "is_quarterly": "form_type == '10-Q'", "is_8k": "form_type == '8-K'"}},
    {
        "op": "calendar", "type": "Day", "start": "1994-01-01", "end": "2031-12-31", "next_edge": "NEXT_DAY",
        "links": [
            {"from": "Filing", "date_col": "filed_date", "edge": "FILED_ON"}, {"from": "InsiderTransaction", "date_col": "transaction_date", "edge": "TRADED_ON"},
            {"from": "Holding", "date_col": "as_of_date", "edge": "HELD_ON"}, {"from": "CorporateEvent", "date_col": "event_date", "edge": "OCCURRED_ON"},
        ],
    },
    {"op": "chain", "from": "Filing", "group_by": ["cik"], "order_by": "filed_date", "edge": "NEXT_FILING"},
    {"op": "chain", "from": "InsiderTransaction", "group_by": ["person_nid", "issuer_cik"], "order_by": "transaction_date", "edge": "NEXT_TX"},
    {
        "op": "aggregate", "from": "InsiderTransaction", "group_by": ["person_nid", "issuer_cik"], "into": "InsiderActivity",
        "agg": {
            "n_transactions": "count(*)", "n_purchases": "sum(if(direction == 'purchase', 1, 0))", "n_sales": "sum(if(direction == 'sale', 1, 0))", "shares_bought": "sum(if(direction == 'purchase', shares, 0))", "shares_sold": "sum(if(direction == 'sale', shares, 0))",
            "buy_value": "sum(if(direction == 'purchase', total_value, 0))", "sell_value": "sum(if(direction == 'sale', total_value, 0))", "first_transaction": "min(transaction_date)", "last_transaction": "max(transaction_date)",
        },
        "edges": [{"to": "Person", "fk": "person_nid", "edge": "ACTIVITY_OF"}, {"to": "Company", "fk": "issuer_cik", "edge": "ACTIVITY_AT"}],
    },
]


def blueprint(only: tuple[str, ...] | None = None) -> dict:
    """The registry's blueprint; of some node types only, with the edges and computes among those."""
    nodes = {}
    for line in NODES.strip().splitlines():
        name, table, key, title, *edges = line.split()
        if only is None or name in only:
            nodes[name] = {"csv": f"processed/{table}.csv", "pk": key, "title": title, "connections": {"fk_edges": dict(_edge(e) for e in edges)}}
    for s in nodes.values():
        s["connections"]["fk_edges"] = {k: e for k, e in s["connections"]["fk_edges"].items() if e["target"] in nodes}
    compute = [op for op in COMPUTE if op["op"] == "calendar" or op["from"] in nodes]
    return {"nodes": nodes, "compute": [op | {"edges": [e for e in op["edges"] if e["to"] in nodes]} if "edges" in op else op for op in compute]}


def _edge(text: str) -> tuple[str, dict]:
    kind, _, rest = text.partition(">")
    target, _, column = rest.rstrip(")").partition("(")
    return kind, {"target": target, "fk": column}


def graph(tables: FactTables, only: tuple[str, ...] | None = None) -> Graph:
    """The graph of fact tables; stored ones are best, as every node type reads its own."""
    spec = blueprint(only)
    names = {s["csv"].removeprefix("processed/").removesuffix(".csv") for s in spec["nodes"].values()}
    return compile_blueprint({n: tables[n] for n in sorted(names)}, spec)
