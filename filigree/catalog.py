"""The driver's queries over its tables: name -> callable, and name -> DuckDB SQL with the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from filigree.functions import dates, geo, ids, money, text
from filigree.operators import forms, lookup, prose, reshape, scope
from filigree.plans import blueprint
from filigree.session import read_table, spread
from filigree.sources import datasets, files
from filigree.streaming import refresh

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
lit, col = F.lit, F.col


def query(sql: str | None):
    """Registers a query under its function's name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- grouping, ordering, filtering -------------------------------------------------------------


@query("select o_orderpriority as form_type, count(*) as n from orders group by 1 order by n desc, form_type limit 10")
def q_top_forms(spark, d):
    """Filings (orders) counted by form (priority), most frequent first."""
    return read_table(spark, d, "orders").groupBy(col("o_orderpriority").alias("form_type")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "form_type").limit(10)


@query("select count(*) as n from orders where o_orderpriority in ('1-URGENT', '2-HIGH')")
def q_in_filter_count(spark, d):
    return read_table(spark, d, "orders").where(col("o_orderpriority").isin("1-URGENT", "2-HIGH")).agg(F.count("*").alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders where o_orderstatus in ('F', 'O') group by 1, 2")
def q_group_in(spark, d):
    return read_table(spark, d, "orders").where(col("o_orderstatus").isin("F", "O")).groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by 1 order by n desc, o_custkey limit 10")
def q_top_filers(spark, d):
    return read_table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@query("select o_orderkey from orders where o_custkey in (1, 2, 3, 5, 8, 13, 21, 34, 55, 89) and o_orderstatus in ('F', 'O') and extract(year from o_orderdate) between 1993 and 1996")
def q_slice(spark, d):
    o = read_table(spark, d, "orders")
    return o.where(scope.in_slice(col("o_custkey"), col("o_orderstatus"), col("o_orderdate").cast("string"), [1, 2, 3, 5, 8, 13, 21, 34, 55, 89], ["F", "O"], (1993, 1996))).select("o_orderkey")


_PLAN_FORM = {"1-URGENT": "4", "2-HIGH": "8-K", "3-MEDIUM": "13F-HR", "4-NOT SPECIFIED": "SC 13D/A"}
_FORM_SQL = "case o_orderpriority " + " ".join(f"when '{k}' then '{v}'" for k, v in _PLAN_FORM.items()) + " else 'ARS' end"


@query(
    f"""select bucket, count(*) as filings, count(distinct o_custkey) as ciks from (
    select o_custkey, case {_FORM_SQL} when '4' then 'form4' when '8-K' then 'form8k' when '13F-HR' then 'form13f' when 'SC 13D/A' then 'sc13d' end as bucket, o_orderdate from orders)
    where bucket is not null and extract(year from o_orderdate) between 1993 and 1996 group by 1"""
)
def q_dispatch_plan(spark, d):
    form = F.coalesce(F.try_element_at(F.create_map(*[lit(x) for kv in _PLAN_FORM.items() for x in kv]), col("o_orderpriority")), lit("ARS"))
    index = read_table(spark, d, "orders").select(col("o_custkey").cast("string").alias("cik"), form.alias("form_type"), col("o_orderdate").cast("string").alias("filed_date"), col("o_orderkey").cast("string").alias("accession_number"), lit("doc.htm").alias("primary_document"))
    return scope.plan_totals(scope.dispatch_plan(index, (1993, 1996)))


@query("select l_orderkey, l_linenumber from lineitem l where exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o_orderpriority = '1-URGENT')")
def q_semi_gate_form(spark, d):
    index = read_table(spark, d, "orders").select(col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return scope.gate(read_table(spark, d, "lineitem"), index, "l_orderkey", ["1-URGENT"], "o_orderpriority").select("l_orderkey", "l_linenumber")


@query("select l_orderkey, l_linenumber from lineitem l where exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o_orderstatus = 'F')")
def q_semi_gate(spark, d):
    index = read_table(spark, d, "orders").where("o_orderstatus = 'F'").select(col("o_orderkey").alias("l_orderkey"))
    return scope.gate(read_table(spark, d, "lineitem"), index, "l_orderkey").select("l_orderkey", "l_linenumber")


@query("select c_custkey from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey)")
def q_anti_unknown(spark, d):
    return scope.missing(read_table(spark, d, "customer"), read_table(spark, d, "orders").select(col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey")


@query("select s_suppkey as k, 'file' as origin from supplier where s_suppkey % 3 = 0 union all select s_suppkey, 'zip' from supplier where s_suppkey % 3 <> 0")
def q_prefer_first(spark, d):
    """Individual files first, the archive for the rest."""
    s = read_table(spark, d, "supplier").select(col("s_suppkey").alias("k"))
    return scope.prefer_first(s.where("k % 3 = 0").withColumn("origin", lit("file")), s.withColumn("origin", lit("zip")), "k")


@query("select bucket, form_type from (values " + ", ".join(f"('{b}', '{f}')" for b, own in scope.BUCKETS.items() for f in own) + ", (null, 'ARS')) t(bucket, form_type)")
def q_form_buckets(spark, d):
    forms_ = [f for own in scope.BUCKETS.values() for f in own] + ["ARS"]
    return spark.range(1).select(F.explode(F.array(*map(lit, forms_))).alias("form_type")).select(scope.bucket_of(col("form_type")).alias("bucket"), "form_type")


# ---- joins and keys ----------------------------------------------------------------------------

_DIM = "select n_regionkey as k, n_name as v, n_nationkey as o from nation"


@query(f"select s_suppkey, dim.v as found from supplier left join (select k, arg_max(v, o) as v from ({_DIM}) group by k) dim on s_nationkey = dim.k")
def q_lookup_last_wins(spark, d):
    dim = read_table(spark, d, "nation").select(col("n_regionkey").alias("k"), col("n_name").alias("v"), col("n_nationkey").alias("o"))
    return lookup.lookup(read_table(spark, d, "supplier"), dim, "s_nationkey", "k", "v", "o", "found").select("s_suppkey", "found")


@query(f"select count(*) as unmatched from supplier where s_nationkey not in (select k from ({_DIM}))")
def q_unmapped_count(spark, d):
    dim = read_table(spark, d, "nation").select(col("n_regionkey").alias("k"), col("n_name").alias("v"), col("n_nationkey").alias("o"))
    return lookup.unmatched(lookup.lookup(read_table(spark, d, "supplier"), dim, "s_nationkey", "k", "v", "o", "found"), "found")


@query("select n_name, cast(r.id as bigint) as ptl_id from nation left join (select r_regionkey, row_number() over (order by r_name desc) as id from region) r on n_regionkey = r_regionkey")
def q_seq_pk_propagate(spark, d):
    parent = lookup.sequential_key(read_table(spark, d, "region").withColumn("o", -F.ascii("r_name") * 1000 - F.ascii(F.substring("r_name", 2, 1))), ["o"], "ptl_id").withColumnRenamed("r_regionkey", "n_regionkey")
    return lookup.propagate_key(parent, read_table(spark, d, "nation"), "n_regionkey", "ptl_id").select("n_name", "ptl_id")


@query("select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as id from orders")
def q_sequential_key(spark, d):
    return lookup.sequential_key(read_table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "id").select("o_orderkey", "id")


@query("select a.conv_id, a.turn, b.turn as parent from conversations a left join (select distinct conv_id, turn from conversations) b on a.conv_id = b.conv_id and b.turn = a.turn - 1")
def q_self_parent(spark, d):
    c = read_table(spark, d, "conversations").select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("name"), F.concat_ws("/", "conv_id", (col("turn") - 1).cast("string")).alias("parent_name"))
    return lookup.parent_key(c, "turn", "name", "parent_name", "parent").select("conv_id", "turn", "parent")


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) as r from events) where r = 1")
def q_first_wins_identity(spark, d):
    return lookup.first_wins(read_table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("select p_brand, arg_min(p_type, p_partkey) as p_type from part group by 1")
def q_dictionary_first(spark, d):
    return lookup.dictionary(read_table(spark, d, "part"), "p_brand", "p_type", col("p_partkey")).select("p_brand", "p_type")


@query("select r.k, r.remote, l.local from (select o_orderpriority as k, count(*) as remote from orders group by 1) r left join (select o_orderpriority as k, count(*) as local from orders where o_orderpriority < '4' or o_orderkey % 2 = 0 group by 1) l on r.k = l.k where l.local is distinct from r.remote")
def q_drifted_counts(spark, d):
    o = read_table(spark, d, "orders").withColumn("k", col("o_orderpriority"))
    count = lambda x: x.groupBy("k").agg(F.count("*").alias("n"))
    return lookup.drifted(count(o.where("k < '4' or o_orderkey % 2 = 0")), count(o), "k", "n")


@query("select n_name, count(*) as n from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey where r_name = 'ASIA' and o_orderstatus = 'F' group by 1")
def q_join_chain(spark, d):
    r, n, c, o = (read_table(spark, d, t) for t in ("region", "nation", "customer", "orders"))
    return r.where("r_name = 'ASIA'").join(n, r.r_regionkey == n.n_regionkey).join(c, c.c_nationkey == n.n_nationkey).join(o.where("o_orderstatus = 'F'"), o.o_custkey == c.c_custkey).groupBy("n_name").agg(F.count("*").alias("n"))


# ---- reshaping and windows ---------------------------------------------------------------------


@query("select doc_id, 'quality' as role_type from labels where quality = 1 union all select doc_id, 'toxic' from labels where toxic = 1")
def q_role_unpivot(spark, d):
    return reshape.flags_to_rows(read_table(spark, d, "labels"), {"quality": "quality", "toxic": "toxic"}, "role_type")


@query("select conv_id, h.hub, turn, cast(turn - hub as bigint) as position from conversations join (select conv_id, min(turn) as hub from conversations group by 1) h using (conv_id) where turn > h.hub")
def q_group_star(spark, d):
    return reshape.star(read_table(spark, d, "conversations"), "conv_id", "turn", "turn").select("conv_id", "hub", "turn", (col("turn") - col("hub")).alias("position"))


@query(
    """select 'L' || l_orderkey || '-' || l_linenumber as nid, l_quantity as amount, 'lineitem' as source_form, cast(l_orderkey as varchar) as source_accession, cast(l_linenumber as varchar) as source_lot from lineitem
    union all select 'O' || o_orderkey, o_totalprice, 'orders', cast(o_orderkey as varchar), null from orders union all select 'E' || event_id, value, 'events', cast(event_id as varchar), null from events"""
)
def q_union_info_rows(spark, d):
    def part(t, nid, amount, key, lot=None):
        prov = reshape.provenance(lit(t), col(key), lit(""), lit(""), lot)
        return read_table(spark, d, t).select(nid.alias("nid"), col(amount).alias("amount"), *prov)

    rows = reshape.union_all([
        part("lineitem", F.concat(lit("L"), col("l_orderkey"), lit("-"), col("l_linenumber")), "l_quantity", "l_orderkey", col("l_linenumber")),
        part("orders", F.concat(lit("O"), col("o_orderkey")), "o_totalprice", "o_orderkey"),
        part("events", F.concat(lit("E"), col("event_id")), "value", "event_id"),
    ])
    return rows.select("nid", "amount", "source_form", "source_accession", "source_lot")


@query("select event_id, last_value(v ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as v from (select *, case when event_id % 3 = 0 then event_type end as v from events)")
def q_carry_forward(spark, d):
    e = read_table(spark, d, "events").withColumn("v", F.when(col("event_id") % 3 == 0, col("event_type")))
    return reshape.carry_forward(e, "v", ["user_id"], ["ts", "event_id"]).select("event_id", "v")


_LINES = "select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(0, len(string_split(text, chr(10))))) as pos from documents"


@query(f"select doc_id, cast(pos as bigint) as pos, cast(sum(case when length(line) < 40 then 1 else 0 end) over (partition by doc_id order by pos) + 1 as bigint) as page from ({_LINES})")
def q_running_page(spark, d):
    lines = read_table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return reshape.running_pages(lines, F.length("line") < 40, "doc_id", "pos").select("doc_id", col("pos").cast("long").alias("pos"), "page")


@query(f"""with l as ({_LINES}), h as (select doc_id, min(pos) as h from l where length(line) < 60 group by 1), e as (select l.doc_id, min(pos) as e from l join h using (doc_id) where pos > h and length(line) > 400 group by 1)
    select l.doc_id, cast(pos as bigint) as pos from l join h using (doc_id) left join e using (doc_id) where pos > h and pos <= h + 5 and (e is null or pos < e)""")
def q_lines_after_heading(spark, d):
    lines = read_table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return reshape.lines_after(lines, F.length("line") < 60, F.length("line") > 400, "doc_id", "pos", 5).select("doc_id", col("pos").cast("long").alias("pos"))


@query("select user_id, event_id from (select *, row_number() over (partition by user_id order by value desc, event_id) as r from events) where r <= 5")
def q_topk_per_doc(spark, d):
    return reshape.top_per_key(read_table(spark, d, "events"), ["user_id"], [F.desc("value"), "event_id"], 5).select("user_id", "event_id")


@query("select median(l_quantity) as median_quantity, min(l_quantity) as least_quantity, max(l_quantity) as most_quantity from lineitem")
def q_median_min(spark, d):
    return read_table(spark, d, "lineitem").agg(F.percentile("l_quantity", 0.5).alias("median_quantity"), F.min("l_quantity").alias("least_quantity"), F.max("l_quantity").alias("most_quantity"))


@query("select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'purchase' when 'R' then 'sale' end as direction from lineitem where l_returnflag in ('A', 'R')")
def q_direction_router(spark, d):
    return reshape.router(read_table(spark, d, "lineitem"), "l_returnflag", {"A": "purchase", "R": "sale"}, "direction").select("l_orderkey", "l_linenumber", "direction")


# ---- graph -------------------------------------------------------------------------------------


@query("select cast(o_orderkey as varchar) as src, 'NEXT_FILING' as type, cast(n as varchar) as dst from (select o_orderkey, lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders) where n is not null")
def q_chain_orders(spark, d):
    return blueprint.chain(read_table(spark, d, "orders"), "o_orderkey", ["o_custkey"], col("o_orderdate"), "NEXT_FILING")


@query("select cast(event_id as varchar) as src, 'NEXT_TX' as type, cast(n as varchar) as dst from (select event_id, lead(event_id) over (partition by user_id, event_type order by cast(ts as date), event_id) as n from events) where n is not null")
def q_chain_events(spark, d):
    return blueprint.chain(read_table(spark, d, "events"), "event_id", ["user_id", "event_type"], col("ts").cast("date"), "NEXT_TX")


@query("""select cast(x as date) as day, case when x < timestamp '2031-12-31' then cast(x + interval 1 day as date) end as next_day, strftime(x, '%Y-%m') as month, year(x) || '-Q' || quarter(x) as quarter
    from (select unnest(generate_series(timestamp '1994-01-01', timestamp '2031-12-31', interval 1 day)) as x)""")
def q_calendar(spark, d):
    return blueprint.calendar(spark, "1994-01-01", "2031-12-31")


@query("select cast(o_orderkey as varchar) as src, 'FILED_ON' as type, strftime(o_orderdate, '%Y-%m-%d') as dst from orders where o_orderdate >= timestamp '1994-01-01' and o_orderdate < timestamp '1997-01-01'")
def q_calendar_links(spark, d):
    return blueprint.on_day(read_table(spark, d, "orders"), "o_orderkey", col("o_orderdate"), "FILED_ON", "1994-01-01", "1996-12-31")


@query("""select l_suppkey, l_partkey, count(*) as n_transactions, cast(sum(case when l_returnflag = 'A' then 1 else 0 end) as bigint) as n_purchases, cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as n_sales,
    round(sum(case when l_returnflag = 'A' then l_quantity else 0 end), 2) as shares_bought, round(sum(case when l_returnflag = 'R' then l_quantity else 0 end), 2) as shares_sold, min(l_shipdate) as first_transaction, max(l_shipdate) as last_transaction from lineitem group by 1, 2""")
def q_activity_aggregate(spark, d):
    out = blueprint.aggregate(read_table(spark, d, "lineitem"), ["l_suppkey", "l_partkey"], {
        "n_transactions": "count(*)", "n_purchases": "sum(if(l_returnflag == 'A', 1, 0))", "n_sales": "sum(if(l_returnflag == 'R', 1, 0))",
        "shares_bought": "sum(if(l_returnflag == 'A', l_quantity, 0))", "shares_sold": "sum(if(l_returnflag == 'R', l_quantity, 0))", "first_transaction": "min(l_shipdate)", "last_transaction": "max(l_shipdate)",
    })
    return out.withColumns({c: F.round(c, 2) for c in ("shares_bought", "shares_sold")})


@query("select o_orderkey, cast(year(o_orderdate) as bigint) as filing_year, o_orderstatus = 'F' as is_annual from orders")
def q_derive(spark, d):
    out = blueprint.derive(read_table(spark, d, "orders"), {"filing_year": "year(o_orderdate)", "is_annual": "o_orderstatus == 'F'"})
    return out.select("o_orderkey", col("filing_year").cast("bigint").alias("filing_year"), "is_annual")


_TPCH = {
    "nodes": {
        "Region": {"csv": "region.csv", "pk": "r_regionkey", "title": "r_name"},
        "Nation": {"csv": "nation.csv", "pk": "n_nationkey", "title": "n_name", "connections": {"fk_edges": {"IN_REGION": {"target": "Region", "fk": "n_regionkey"}}}},
        "Customer": {"csv": "customer.csv", "pk": "c_custkey", "title": "c_name", "connections": {"fk_edges": {"IN_NATION": {"target": "Nation", "fk": "c_nationkey"}}}},
        "Supplier": {"csv": "supplier.csv", "pk": "s_suppkey", "title": "s_name", "connections": {"fk_edges": {"BASED_IN": {"target": "Nation", "fk": "s_nationkey"}}}},
        "Order": {"csv": "orders.csv", "pk": "o_orderkey", "title": "o_orderpriority", "connections": {"fk_edges": {"FILED_BY": {"target": "Customer", "fk": "o_custkey"}}}},
    },
    "compute": [
        {"op": "derive", "from": "Order", "set": {"filing_year": "year(o_orderdate)"}},
        {"op": "calendar", "type": "Day", "start": "1994-01-01", "end": "1996-12-31", "next_edge": "NEXT_DAY", "links": [{"from": "Order", "date_col": "o_orderdate", "edge": "FILED_ON"}]},
        {"op": "chain", "from": "Order", "group_by": ["o_custkey"], "order_by": "o_orderdate", "edge": "NEXT_FILING"},
        {"op": "aggregate", "from": "Order", "group_by": ["o_custkey", "o_orderstatus"], "into": "Activity", "agg": {"n": "count(*)", "first": "min(o_orderdate)"}, "edges": [{"to": "Customer", "fk": "o_custkey", "edge": "ACTIVITY_OF"}]},
    ],
}


def _graph(spark, d):
    return blueprint.compile_blueprint({t: read_table(spark, d, t) for t in ("region", "nation", "customer", "supplier", "orders")}, _TPCH)


@query("select 'Order' as src_label, cast(o_orderkey as varchar) as src, 'FILED_BY' as type, 'Customer' as dst_label, cast(c_custkey as varchar) as dst from orders join customer on o_custkey = c_custkey")
def q_fk_edges(spark, d):
    return blueprint.fk_edges(read_table(spark, d, "orders"), "Order", "o_orderkey", "o_custkey", "FILED_BY", read_table(spark, d, "customer"), "Customer", "c_custkey")


@query("select l_orderkey, l_linenumber, l_suppkey from lineitem where l_suppkey not in (select s_suppkey from supplier where s_suppkey % 2 = 0)")
def q_dangling_keys(spark, d):
    return blueprint.dangling(read_table(spark, d, "lineitem"), "l_suppkey", read_table(spark, d, "supplier").where("s_suppkey % 2 = 0"), "s_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey")


@query("select distinct cast(l_partkey as varchar) as src, 'SUPPLIED_BY' as type, cast(l_suppkey as varchar) as dst from lineitem where l_partkey in (select p_partkey from part where p_size > 25) and l_suppkey in (select s_suppkey from supplier)")
def q_junction_edges(spark, d):
    bridge = read_table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return blueprint.junction_edges(bridge, read_table(spark, d, "part").where("p_size > 25"), "l_partkey", "p_partkey", read_table(spark, d, "supplier"), "l_suppkey", "s_suppkey", "SUPPLIED_BY")


@query("""with f as (select 'label' as what, 'Region' as name, (select count(*) from region) as n union all select 'label', 'Nation', (select count(*) from nation) union all select 'label', 'Customer', (select count(*) from customer) union all select 'label', 'Supplier', (select count(*) from supplier)
    union all select 'label', 'Order', (select count(*) from orders) union all select 'label', 'Day', 1096 union all select 'label', 'Activity', (select count(*) from (select distinct o_custkey, o_orderstatus from orders))
    union all select 'edge', 'IN_REGION', (select count(*) from nation) union all select 'edge', 'IN_NATION', (select count(*) from customer) union all select 'edge', 'BASED_IN', (select count(*) from supplier) union all select 'edge', 'FILED_BY', (select count(*) from orders join customer on o_custkey = c_custkey)
    union all select 'edge', 'NEXT_DAY', 1095 union all select 'edge', 'FILED_ON', (select count(*) from orders where year(o_orderdate) between 1994 and 1996) union all select 'edge', 'NEXT_FILING', (select count(*) - count(distinct o_custkey) from orders)
    union all select 'edge', 'ACTIVITY_OF', (select count(*) from (select distinct o_custkey, o_orderstatus from orders) join customer on o_custkey = c_custkey)) select what, name, cast(n as bigint) as n from f""")
def q_fingerprint(spark, d):
    return _graph(spark, d).fingerprint().where("what <> 'id'")


@query("select n_name, count(*) as n from region join nation on n_regionkey = r_regionkey join customer on c_nationkey = n_nationkey join orders on o_custkey = c_custkey where r_name = 'EUROPE' group by 1")
def q_two_hop(spark, d):
    """Orders -> customer -> nation -> region as a path pattern."""
    g = _graph(spark, d)
    path = g.nodes("Order").out("FILED_BY", "Customer").out("IN_NATION", "Nation").out("IN_REGION", "Region").rows
    named = g.node_rows.where("label = 'Nation'").select(col("id").alias("n2"), col("title").alias("n_name"))
    europe = g.node_rows.where("label = 'Region' and title = 'EUROPE'").select(col("id").alias("n3"))
    return path.join(europe, "n3").join(named, "n2").groupBy("n_name").agg(F.count("*").alias("n"))


_RICH = {
    "nodes": {
        "Supplier": {"csv": "supplier.csv", "pk": "s_suppkey", "title": "s_name", "properties": ["s_nationkey", "is_seven"], "sub_nodes": {"Offer": {"csv": "offers.csv", "pk": "offer", "parent_fk": "l_suppkey", "edge": "OFFER_OF"}}},
        "Part": {"csv": "part.csv", "pk": "p_partkey", "title": "p_name", "properties": ["p_brand"], "connections": {"junction_edges": {"SUPPLIED_BY": {"csv": "bridge.csv", "target": "Supplier", "source_fk": "l_partkey", "target_fk": "l_suppkey"}}}},
    },
    "compute": [{"op": "derive", "from": "Supplier", "set": {"is_seven": "s_nationkey == '7'"}}],
}


def _rich(spark, d):
    lines = read_table(spark, d, "lineitem").where("l_linenumber = 1")
    tables = {"supplier": read_table(spark, d, "supplier"), "part": read_table(spark, d, "part"), "bridge": lines.select("l_partkey", "l_suppkey").distinct(), "offers": lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("offer"), "l_suppkey")}
    return blueprint.compile_blueprint(tables, _RICH)


@query("select p_brand as brand, count(*) as n from (select distinct l_partkey, l_suppkey from lineitem where l_linenumber = 1) join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey where s_nationkey = 7 group by 1")
def q_property_match(spark, d):
    """Parts by brand whose supplier has given properties, one of them derived; junction edges."""
    g = _rich(spark, d)
    wanted = g.nodes("Supplier", s_nationkey=7, is_seven="true").rows.select(col("n0").alias("n1"))
    path = g.nodes("Part").out("SUPPLIED_BY", "Supplier")
    path.rows = path.rows.join(wanted, "n1", "left_semi")
    return path.select(0, "p_brand").groupBy(col("p_brand").alias("brand")).agg(F.count("*").alias("n"))


@query("select l_orderkey || '-1' as offer, s_name as title, cast(s_nationkey as varchar) as nation from lineitem join supplier on s_suppkey = l_suppkey where l_linenumber = 1")
def q_sub_nodes(spark, d):
    """Sub-nodes with what their parents are."""
    g = _rich(spark, d)
    path = g.nodes("Offer").out("OFFER_OF", "Supplier")
    own = g.node_rows.where("label = 'Supplier'").select(col("id").alias("n1"), "title", "properties")
    return path.rows.join(own, "n1").select(col("n0").alias("offer"), "title", F.try_element_at("properties", lit("s_nationkey")).alias("nation"))


@query("select s_suppkey::varchar as id, s_name as title, s_nationkey::varchar as s_nationkey from supplier order by s_name limit 25")
def q_project_ordered(spark, d):
    """Projection, order and limit over nodes."""
    return _rich(spark, d).nodes("Supplier").select(0, "id", "title", "s_nationkey").orderBy("title").limit(25)


@query("select count(*) as n from orders join customer on o_custkey = c_custkey")
def q_edge_count(spark, d):
    return _graph(spark, d).edge_count("FILED_BY")


@query("select 'Customer' as label, cast(c_custkey as varchar) as id, c_name as title from customer where c_custkey = 7 union all select 'Supplier', cast(s_suppkey as varchar), s_name from supplier where s_suppkey = 7 union all select 'Nation', cast(n_nationkey as varchar), n_name from nation where n_nationkey = 7 union all select 'Order', cast(o_orderkey as varchar), o_orderpriority from orders where o_orderkey = 7")
def q_any_label_match(spark, d):
    return _graph(spark, d).node_rows.where("id = '7'").select("label", "id", "title")


# ---- ids, text, money, dates -------------------------------------------------------------------


@query("""select o_orderkey, 'cik-' || o_custkey as person_nid, substr(a, 1, 10) || '-' || substr(a, 11, 2) || '-' || substr(a, 13) as dashed, coalesce(nullif(ltrim(p, '0'), ''), '0') as stripped,
    'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || a || '/doc.htm' as url, p as padded from (select *, lpad(cast(o_orderkey as varchar), 18, '0') as a, lpad(cast(o_custkey as varchar), 10, '0') as p from orders)""")
def q_ids(spark, d):
    a, p = F.lpad(col("o_orderkey").cast("string"), 18, "0"), ids.pad_registry_number(col("o_custkey"))
    dashed = ids.insert_accession_dashes(a)
    return read_table(spark, d, "orders").select("o_orderkey", ids.person_id(ids.strip_leading_zeros(p)).alias("person_nid"), dashed.alias("dashed"), ids.strip_leading_zeros(p).alias("stripped"), ids.archives_url(p, dashed, lit("doc.htm")).alias("url"), p.alias("padded"))


@query("select p_partkey, trim(regexp_replace(lower(regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9\\s]', '', 'g')), '\\s', '-', 'g'), '-') as nid from part")
def q_normalise_name(spark, d):
    return read_table(spark, d, "part").select("p_partkey", text.normalise_name(F.concat_ws(" ", "p_name", "p_type")).alias("nid"))


def _strip_sql(to: str, entities: dict, breaks: str | None, collapse: bool) -> str:
    x = "html"
    if breaks:
        x = f"regexp_replace({x}, '<(?:{breaks})[^>]*>', chr(10), 'gi')"
    x = f"regexp_replace(regexp_replace({x}, '<[^>]*>|>', '{to}', 'g'), '<[^>]*$', '')"
    for e, c in entities.items():
        x = f"replace({x}, '{e}', '{c.replace(chr(39), chr(39) * 2)}')"
    x = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))" if collapse else x
    return f"select page_id, md5({x}) as digest, length({x}) as n from pages"


def _strip_query(flavour: str):
    to, entities, breaks, collapse = text.FLAVOURS[flavour]

    def run(spark, d):
        x = text.strip_html(col("html"), flavour)
        return read_table(spark, d, "pages").select("page_id", F.md5(x.cast("binary")).alias("digest"), F.length(x).cast("long").alias("n"))

    run.__name__ = f"q_strip_html_{flavour}"
    run.__doc__ = f"Markup removal, {flavour}."
    query(_strip_sql(to, entities, breaks.replace("(?![a-z0-9])", "\\b") if breaks else None, collapse))(run)


for _flavour in ("spaced", "joined", "lines", "collapsed", "cells", "plain"):
    _strip_query(_flavour)


@query("select doc_id, list_max(list_filter(list_transform(regexp_extract_all(' ' || regexp_replace(text, '([^0-9])', '\\1 ', 'g') || ' ', '[^0-9]([0-9]{4})[^0-9]', 1), lambda x: cast(x as bigint)), lambda y: y between 2010 and 2099)) as year from documents")
def q_max_year(spark, d):
    return read_table(spark, d, "documents").select("doc_id", dates.max_year(col("text")).cast("long").alias("year"))


@query("select l_orderkey, l_linenumber, l_discount * 100 >= 0.1 as named, round(case when l_discount * 100 >= 0.1 then round(l_discount * 100, 2) else 0 end, 2) as percent from lineitem")
def q_max_percent(spark, d):
    said = F.concat(lit("holds 0.05% or "), F.format_string("%.2f", col("l_discount") * 100), lit("% of 250% shares"))
    p = prose.max_percent(said)
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (p > 0).alias("named"), F.round(p, 2).alias("percent"))


@query("select o_orderkey, o_custkey * 1000000.0 as amount, cast(o_custkey as double) * 1000 as plain from orders")
def q_first_dollar(spark, d):
    said = F.concat(lit("net proceeds of about $"), col("o_custkey"), lit(" million, and fees of $"), F.format_number(col("o_custkey") * 1000, 0), lit(" later"))
    return read_table(spark, d, "orders").select("o_orderkey", money.first_dollar(said).alias("amount"), money.plain_dollar(said, text.at(said, "fees"), 60).alias("plain"))


@query("select l_orderkey, l_linenumber, case when l_linenumber = 1 then l_quantity + 0.5 else l_quantity end as price from lineitem")
def q_price_repair(spark, d):
    q = col("l_quantity")
    note = F.concat(lit("prices ranging from $"), q.cast("int"), lit(".00 to $"), (q + 1).cast("int"), lit(".00, inclusive"))
    span = money.price_range(note)
    raw = F.when(col("l_linenumber") == 1, q * 1000).otherwise(q)
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", money.repaired_price(raw, span["low"], span["high"]).alias("price"))


@query("select event_id, strftime(ts, '%Y-%m-%d') as day from events")
def q_epoch_ms(spark, d):
    ms = F.unix_millis(col("ts").cast("timestamp"))
    return read_table(spark, d, "events").select("event_id", dates.epoch_ms_date(ms).alias("day"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def q_props_json(spark, d):
    return read_table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""select l_orderkey, l_linenumber, 'POINT(' || l_partkey || ' ' || l_suppkey || ')' as point, 'LINESTRING(' || l_partkey || ' ' || l_suppkey || ', ' || l_suppkey || '.5 ' || l_linenumber || ')' as line,
    'POLYGON((0 0, ' || l_partkey || ' 0, 0 ' || l_suppkey || ', 0 0))' as polygon, null::varchar as broken, 'MULTIPOLYGON(((0 0, ' || l_partkey || ' 0, 0 -7.25)))' as patched from lineitem""")
def q_wkt(spark, d):
    """Geometries of five shapes; points that are none and rings that are too short are left out."""
    def gj(kind, *parts):
        return geo.wkt(F.concat(lit(f'{{"type":"{kind}","coordinates":'), *[x if not isinstance(x, str) else lit(x) for x in parts], lit("}")))

    p, s, n = col("l_partkey").cast("string"), col("l_suppkey").cast("string"), col("l_linenumber").cast("string")
    return spread(read_table(spark, d, "lineitem")).select(
        "l_orderkey", "l_linenumber", gj("Point", "[", p, ",", s, "]").alias("point"), gj("LineString", "[[", p, ",", s, "],[", s, ".5,", n, "]]").alias("line"), gj("Polygon", "[[[0,0],[", p, ",0],[0,", s, "],[0,0]]]").alias("polygon"), gj("LineString", "[[", p, ",", s, "]]").alias("broken"),
        gj("MultiPolygon", '[[[[0,0],[1],["2",3],[', p, ",0],[0,-7.25,9]],[[1,1],[2,2]]],[[[3,3],[4,", s, "]]]]").alias("patched"),
    )


@query("select s_suppkey, 'POINT(' || (s_suppkey + 1) || '00000000000000000000 0.0000000000001)' as big, 'MULTIPOINT(1.1234567890123457 -2, 1250000000000 0.00015)' as several, (s_suppkey + 1) || '00000000000' as whole, case when s_suppkey % 2 = 0 then '' else '0.5' end as cell from supplier")
def q_plain_decimals(spark, d):
    """Large and tiny numbers without exponents, in geometries and CSV cells."""
    k = (col("s_suppkey") + 1).cast("string")
    big = geo.wkt(F.concat(lit('{"type":"Point","coordinates":['), k, lit("e20,1e-13]}")))
    several = geo.wkt(lit('{"type":"MultiPoint","coordinates":[[1.12345678901234567,-2.0],[1.25e12,1.5E-4]]}'))
    return read_table(spark, d, "supplier").select("s_suppkey", big.alias("big"), several.alias("several"), money.format_float((col("s_suppkey") + 1) * 1e11).alias("whole"), money.format_float((col("s_suppkey") % 2) / 2.0).alias("cell"))


@query("""select o_orderkey, cast(o_custkey as double) as bracketed, cast(o_custkey as double) * 1000 as marked, 0.0::double as dash, null::double as footnote, null::double as other from orders""")
def q_clean_money(spark, d):
    """Amounts of table cells in several spellings."""
    c, k = col("o_custkey"), F.format_number(col("o_custkey"), 0)
    thousands = F.format_number(c * 1000, 0)
    wide = F.when(F.length(k) <= 2, F.concat(lit("$ "), k, lit("†"))).otherwise(F.concat(lit("("), k, lit(")")))  # short bracketed numbers are footnotes
    return read_table(spark, d, "orders").select("o_orderkey", money.clean_money(wide).alias("bracketed"), money.clean_money(F.concat(lit("$"), thousands, lit("*"))).alias("marked"), money.clean_money(lit(" — ")).alias("dash"), money.clean_money(lit("(12)")).alias("footnote"), money.clean_money(F.concat(k, lit(" a"))).alias("other"))


@query("select upper(left(n_name, 1)) as ticker, cast(max(n_nationkey) as bigint) as cik from nation group by 1")
def q_tickers_last_wins(spark, d):
    """Tickers of a company map; the last entry of a ticker counts."""
    entry = F.concat(lit('"'), col("n_nationkey").cast("string"), lit('":{"cik_str":'), col("n_nationkey").cast("string"), lit(',"ticker":"'), F.lower(F.left("n_name", lit(1))), lit('","title":"x"}'))
    rows = read_table(spark, d, "nation").select(F.struct("n_nationkey", entry.alias("e")).alias("x")).agg(F.array_sort(F.collect_list("x")).alias("xs"))  # 25 nations
    raw = rows.select(F.concat(lit('{"skip":null,"none":{"cik_str":1,"ticker":"","title":"x"},'), F.array_join(F.transform("xs", lambda x: x["e"]), ","), lit("}")).alias("value"))
    return files.tickers(raw)


@query("select s_suppkey as k, case when s_suppkey % 3 = 0 then cast(s_suppkey as bigint) when s_suppkey % 3 = 1 then n.n_nationkey end as cik from supplier left join nation n on n_nationkey = s_nationkey")
def q_resolve_companies(spark, d):
    """Numbers stand for themselves, tickers are looked up, unknown ones are null."""
    known = read_table(spark, d, "nation").select(F.upper("n_name").alias("ticker"), col("n_nationkey").cast("bigint").alias("cik"))
    own = read_table(spark, d, "supplier").join(read_table(spark, d, "nation"), col("n_nationkey") == col("s_nationkey"), "left")
    name = F.when(col("s_suppkey") % 3 == 0, col("s_suppkey").cast("string")).when(col("s_suppkey") % 3 == 1, F.lower("n_name")).otherwise("no such name")
    return files.resolved(own.select(col("s_suppkey").alias("k"), name.alias("name")), known).select("k", "cik")


@query("select event_id, strftime(ts, '%Y-%m-%d') as dateUpdated, event_id as validTo, 'x' as plain from events")
def q_date_columns(spark, d):
    """Columns that are dates by name and whose first value is a time in milliseconds become dates."""
    e = read_table(spark, d, "events").select("event_id", F.when(col("event_id") > 3, F.unix_millis(col("ts").cast("timestamp"))).otherwise(F.unix_millis(col("ts").cast("timestamp"))).alias("dateUpdated"), col("event_id").alias("validTo"), lit("x").alias("plain"))
    return files.with_dates(e, "event_id")


@query("select o_orderkey, case when o_orderkey % 5 = 0 then '?' when o_orderkey % 5 = 1 then (o_custkey % 9 + 1) || '.0 KB' when o_orderkey % 5 = 2 then (o_custkey % 9 + 1) || '.5 MB' when o_orderkey % 5 = 3 then (o_custkey % 9 + 1) || '.25 GB' else (o_custkey % 9 + 1) || '.00 TB' end as size from orders")
def q_byte_size(spark, d):
    n = (col("o_custkey") % 9 + 1).cast("double")
    size = F.when(col("o_orderkey") % 5 == 1, n * 1024).when(col("o_orderkey") % 5 == 2, (n + 0.5) * 1024**2).when(col("o_orderkey") % 5 == 3, (n + 0.25) * 1024**3).when(col("o_orderkey") % 5 == 4, n * 1024**4)
    return read_table(spark, d, "orders").select("o_orderkey", text.byte_size(size.cast("bigint")).alias("size"))


@query("""select o_orderkey, 'https://data.sec.gov/submissions/CIK' || lpad(cast(o_custkey as varchar), 10, '0') || '.json' as record, 'https://data.sec.gov/api/xbrl/companyfacts/CIK' || lpad(cast(o_custkey as varchar), 10, '0') || '.json' as facts,
    'https://www.sec.gov/Archives/edgar/full-index/' || year(o_orderdate) || '/QTR' || quarter(o_orderdate) || '/master.idx' as quarter_index, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || lpad(cast(o_orderkey as varchar), 18, '0') || '/' as folder from orders""")
def q_url_templates(spark, d):
    day, a = col("o_orderdate"), F.lpad(col("o_orderkey").cast("string"), 18, "0")
    q = dates.quarter_of(day)
    return read_table(spark, d, "orders").select("o_orderkey", ids.company_json_url(col("o_custkey")).alias("record"), ids.company_json_url(col("o_custkey"), "api/xbrl/companyfacts").alias("facts"), ids.quarter_index_url(q["year"], q["quarter"]).alias("quarter_index"), ids.filing_folder_url(col("o_custkey").cast("string"), ids.insert_accession_dashes(a)).alias("folder"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as at, null::varchar as bad from events")
def q_http_date(spark, d):
    header = F.concat(F.date_format("ts", "E, dd MMM yyyy HH:mm:ss"), lit(" GMT"))
    show = lambda x: F.date_format(dates.http_date(x), "yyyy-MM-dd HH:mm:ss")
    return read_table(spark, d, "events").select("event_id", show(header).alias("at"), show(lit("yesterday")).alias("bad"))


@query("select p_partkey, 'caf' || chr(233) || ' \"' || p_partkey || '\" ' || chr(128578) || chr(10) || 'x' as object from part where p_partkey <= (select max(p_partkey) from part)")
def q_triples_unescaped(spark, d):
    """Escapes of literals are resolved."""
    line = F.concat(lit("<http://e/Q"), col("p_partkey").cast("string"), lit(r'> <http://e/label> "caf\u00e9 \"'), col("p_partkey").cast("string"), lit(r'\" \U0001F642\nx"@en .'))
    return files.triples(read_table(spark, d, "part").select(line.alias("value")), ["en"]).select(F.substring("subject", 11, 20).cast("bigint").alias("p_partkey"), "object")


@query("select user_id, event_id from events where user_id in (select user_id from events group by 1 order by min(event_id) limit 40)")
def q_entity_cap(spark, d):
    """Only the entities that come first."""
    e = read_table(spark, d, "events").withColumn("subject", col("user_id"))
    return files.first_entities(e, "event_id", 40).select("user_id", "event_id")


@query("select event_id, props || '' as nested, cast(json_extract_string(props, '$.k') as varchar) as number, '' as nothing from (select event_id, '{\"k\":' || json_extract_string(props, '$.k') || '}' as props from events)")
def q_json_cells(spark, d):
    """JSON values as cells: nested ones as JSON, null as nothing."""
    v = F.parse_json("props")
    return read_table(spark, d, "events").select("event_id", files.cell_text(v).alias("nested"), files.cell_text(F.variant_get(v, "$.k", "variant")).alias("number"), files.cell_text(F.parse_json(lit("null"))).alias("nothing"))


@query("select year, quarter from (select y as year, q as quarter from range(1993, 1999) a(y), range(1, 5) b(q)) where year > 1993 or quarter >= 3")
def q_quarters(spark, d):
    return files.quarters(spark, 1993, 1998).select(col("year").cast("long").alias("year"), col("quarter").cast("long").alias("quarter"))


@query("select o_orderkey, case when o_orderkey % 5 = 0 then 'fetch' when o_orderkey % 40 >= 14 then 'fetch' else 'probe' end as action from orders")
def q_refresh_actions(spark, d):
    now = lit("2024-03-01T00:00:00")
    m = read_table(spark, d, "orders").select("o_orderkey", F.when(col("o_orderkey") % 5 != 0, F.date_format(F.expr("timestamp'2024-03-01 00:00:00' - make_dt_interval(cast(o_orderkey % 40 as int))"), "yyyy-MM-dd'T'HH:mm:ss")).alias("fetched_at"), lit(100).alias("size_bytes"))
    return refresh.dataset_action(m, now, refresh.sweep_due(lit("2024-01-01"), now)).select("o_orderkey", "action")


@query("""select o_orderkey, case when o_orderkey % 7 = 0 or o_orderkey % 2 = 1 then 'build' when o_orderkey % 60 < 31 or o_orderkey % 3 = 0 then 'load' when o_orderkey % 5 = 0 then 'rebuild' when o_orderkey % 11 <= 5 then 'load' else 'rebuild' end as decision from orders""")
def q_freshness(spark, d):
    k = col("o_orderkey")
    c = read_table(spark, d, "orders").select("o_orderkey", (k % 7 == 0).alias("force"), (k % 2 == 0).alias("built"), (k % 60).alias("age_days"), F.when(k % 3 != 0, k % 11).alias("remote"), F.when(k % 5 != 0, lit(5)).alias("embedded"))
    return refresh.freshness(c).select("o_orderkey", "decision")


@query("select o_orderkey, case when gb < 4 then 'memory' when gb < 16 then 'mapped' else 'disk' end as mode from (select o_orderkey, (0.1 * (o_orderkey % 30) + 5.65 * (o_orderkey % 6)) * least((o_custkey + 1) / 6000.0, 1.0) as gb from orders)")
def q_storage_mode(spark, d):
    k = col("o_orderkey")
    return read_table(spark, d, "orders").select("o_orderkey", refresh.storage_mode(refresh.graph_size_gb(k % 30, k % 6, col("o_custkey") + 1, True, True, True)).alias("mode"))


# ---- documents: synthesised from table columns, parsed back ------------------------------------


def _doc(*parts):
    return F.concat(*[lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


@query("""select l_orderkey, l_linenumber, 'cik-' || l_suppkey as person_nid, cast(l_partkey as varchar) as issuer_cik, l_quantity as shares, cast(l_suppkey as double) as price_per_share, l_quantity * l_suppkey as total_value, case l_returnflag when 'A' then 'A' when 'R' then 'D' else 'N' end as acquired_disposed, strftime(l_shipdate, '%Y-%m-%d') as transaction_date, cast(0 as bigint) as is_derivative from lineitem""")
def q_form4_xml(spark, d):
    v = lambda tag, x: [f"<{tag}><value>", x, f"</value></{tag}>"]
    ad = F.when(col("l_returnflag") == "A", "A").when(col("l_returnflag") == "R", "D").otherwise("N")
    doc = _doc(
        "<ownershipDocument><documentType>4</documentType><issuer><issuerCik>000", col("l_partkey"), "</issuerCik></issuer><reportingOwner><reportingOwnerId><rptOwnerCik>00", col("l_suppkey"), "</rptOwnerCik></reportingOwnerId><reportingOwnerRelationship><isOfficer>1</isOfficer><isDirector>",
        (col("l_linenumber") % 2), "</isDirector></reportingOwnerRelationship></reportingOwner><nonDerivativeTable><nonDerivativeTransaction>", *v("securityTitle", lit("Common")), *v("transactionDate", F.date_format("l_shipdate", "yyyy-MM-dd")),
        "<transactionCoding><transactionCode>S</transactionCode></transactionCoding><transactionAmounts>", *v("transactionShares", col("l_quantity")), *v("transactionPricePerShare", col("l_suppkey")), *v("transactionAcquiredDisposedCode", ad), "</transactionAmounts></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>",
    )
    docs = spread(read_table(spark, d, "lineitem")).select("l_orderkey", "l_linenumber", doc.alias("text"))
    return forms.ownership_transactions(docs).select("l_orderkey", "l_linenumber", "person_nid", "issuer_cik", "shares", "price_per_share", "total_value", "acquired_disposed", "transaction_date", col("is_derivative").cast("long").alias("is_derivative"))


@query("""select l_orderkey, l_linenumber, 'cik-' || l_suppkey as person_nid, role_type from lineitem, (values ('officer', 0), ('director', 1)) r(role_type, odd) where odd = 0 or l_linenumber % 2 = 1""")
def q_form4_roles(spark, d):
    doc = _doc("<ownershipDocument><documentType>4</documentType><issuer><issuerCik>1</issuerCik></issuer><reportingOwner><reportingOwnerId><rptOwnerCik>00", col("l_suppkey"), "</rptOwnerCik></reportingOwnerId><reportingOwnerRelationship><isOfficer>true</isOfficer><isDirector>", (col("l_linenumber") % 2), "</isDirector></reportingOwnerRelationship></reportingOwner></ownershipDocument>")
    return forms.ownership_roles(spread(read_table(spark, d, "lineitem")).select("l_orderkey", "l_linenumber", doc.alias("text"))).select("l_orderkey", "l_linenumber", "person_nid", "role_type")


@query("select o_orderkey, cast(position as bigint) as position, lpad(cast(o_custkey as varchar), 9, '0') as cusip, cast(o_custkey as double) * 1000 as value, cast(o_custkey as double) as shares from orders, (values (0), (2)) p(position)")
def q_13f_xml(spark, d):
    one = lambda cusip: ["<n1:infoTable><n1:nameOfIssuer>X &amp; Co</n1:nameOfIssuer><n1:cusip>", cusip, "</n1:cusip><n1:value>", F.format_number(col("o_custkey") * 1000, 0), "</n1:value><n1:shrsOrPrnAmt><n1:sshPrnamt>", col("o_custkey"), "</n1:sshPrnamt><n1:sshPrnamtType>SH</n1:sshPrnamtType></n1:shrsOrPrnAmt></n1:infoTable>"]
    good = F.lpad(col("o_custkey").cast("string"), 9, "0")
    doc = _doc('<n1:informationTable xmlns:n1="u">', *one(good), *one(lit("")), *one(good), "</n1:informationTable>")
    return forms.manager_holdings(spread(read_table(spark, d, "orders")).select("o_orderkey", doc.alias("text"))).select("o_orderkey", col("position").cast("long").alias("position"), "cusip", "value", "shares")


@query("select o_orderkey, cast(o_custkey as varchar) as issuer_cik, cast(o_custkey as double) * 10 as shares, strftime(o_orderdate, '%m/%d/%Y') as approx_sale_date from orders")
def q_form144_xml(spark, d):
    doc = _doc("<edgarSubmission><issuerInfo><issuerCik>000", col("o_custkey"), "</issuerCik></issuerInfo><securitiesInformation><noOfUnitsToBeSold>7</noOfUnitsToBeSold></securitiesInformation><securitiesToBeSoldInfo><securitiesClassTitle>Common</securitiesClassTitle><noOfUnitsToBeSold>", F.format_number(col("o_custkey") * 10, 0), "</noOfUnitsToBeSold><approxSaleDate> ", F.date_format("o_orderdate", "MM/dd/yyyy"), "</approxSaleDate></securitiesToBeSoldInfo></edgarSubmission>")
    return forms.planned_sales(spread(read_table(spark, d, "orders")).select("o_orderkey", doc.alias("text"))).select("o_orderkey", "issuer_cik", "shares", "approx_sale_date")


@query("select o_orderkey, cast(o_custkey as varchar) as issuer_cik, 'private_placement' as offering_type, cast(o_custkey as double) * 1000 as gross_proceeds, cast(o_custkey as double) as net_proceeds, 'Plant & machines' as narrative from orders where o_custkey > 0")
def q_formd_xml(spark, d):
    doc = _doc("<edgarSubmission><primaryIssuer><cik>0", col("o_custkey"), "</cik></primaryIssuer><offeringData><offeringSalesAmounts><totalOfferingAmount>$", F.format_number(col("o_custkey") * 1000, 0), "</totalOfferingAmount><totalAmountSold>", col("o_custkey"), "</totalAmountSold></offeringSalesAmounts><useOfProceeds><useOfProceedsSummary>Plant &amp; machines</useOfProceedsSummary></useOfProceeds></offeringData></edgarSubmission>")
    return forms.private_offerings(read_table(spark, d, "orders").select("o_orderkey", doc.alias("text"))).select("o_orderkey", "issuer_cik", "offering_type", "gross_proceeds", "net_proceeds", "narrative")


@query("select o_orderkey, case o_orderkey % 4 when 0 then 'form3' when 1 then 'form144' when 2 then 'formd' else 'failed' end as kind from orders")
def q_schema_cascade(spark, d):
    docs = {0: "<ownershipDocument><documentType>3/A</documentType></ownershipDocument>", 1: "<e><securitiesToBeSoldInfo><noOfUnitsToBeSold>1</noOfUnitsToBeSold></securitiesToBeSoldInfo></e>", 2: "<e><offeringData><offeringSalesAmounts><totalOfferingAmount>5</totalOfferingAmount></offeringSalesAmounts></offeringData></e>", 3: "<informationTable/>"}
    pick = F.element_at(F.create_map(*[lit(x) for kv in docs.items() for x in kv]), (col("o_orderkey") % 4).cast("int"))
    return forms.classify(read_table(spark, d, "orders").select("o_orderkey", pick.alias("text"))).select("o_orderkey", "kind")


@query("select o_custkey as issuer_cik, 'us-gaap:Assets' as tag, strftime(o_orderdate, '%Y-%m-%d') as ddate, cast(4 as bigint) as qtrs, 'USD' as uom, o_totalprice as value, year(o_orderdate) || 'FY' as dimensional_context, cast(o_orderkey as varchar) as source_accession from orders")
def q_xbrl_flatten(spark, d):
    fact = _doc('{"cik":', col("o_custkey"), ',"entityName":"X","facts":{"us-gaap":{"Assets":{"label":"a","units":{"USD":[{"start":"2020-01-01","end":"', F.date_format("o_orderdate", "yyyy-MM-dd"), '","val":', col("o_totalprice"), ',"fy":', F.year("o_orderdate"), ',"fp":"FY","form":"10-K","accn":"', col("o_orderkey"), '"}]}},"OddConcept":{"units":{"USD":[{"end":"2020-01-01","val":1,"accn":"x"}]}}}}}')
    out = forms.company_facts(read_table(spark, d, "orders").select(fact.alias("text")))
    return out.select("issuer_cik", "tag", "ddate", col("qtrs").cast("long").alias("qtrs"), "uom", "value", "dimensional_context", "source_accession")


@query("select upper('t' || c_custkey) as ticker, c_custkey as cik from customer")
def q_tickers(spark, d):
    doc = _doc('{"0":{"cik_str":', col("c_custkey"), ',"ticker":"t', col("c_custkey"), '","title":"X"},"1":null,"2":{"cik_str":5,"ticker":"","title":"Y"}}')
    return files.tickers(read_table(spark, d, "customer").select(doc.alias("value")))


_SUB = '{"cik":"%s","name":"%s","sic":"1","tickers":["A","B"],"exchanges":["N"],"formerNames":[{"name":"Old","from":"1976","to":"2007"}],"filings":{"recent":{"accessionNumber":["%s-1","","%s-3"],"form":["10-K","8-K"],"filingDate":["2024-01-01"],"reportDate":[],"primaryDocument":["a.htm"]}}}'


def _submissions(spark, d):
    k = col("c_custkey").cast("string")
    return forms.submissions(read_table(spark, d, "customer").select(F.format_string(_SUB, F.lpad(k, 10, "0"), col("c_name"), k, k).alias("value")))


@query("select c_custkey || '-1' as accession_number, cast(c_custkey as varchar) as cik, '10-K' as form_type, '2024-01-01' as filed_date, '' as report_date, 'a.htm' as primary_document from customer union all select c_custkey || '-3', cast(c_custkey as varchar), '', '', '', '' from customer")
def q_submission_filings(spark, d):
    return forms.filing_index(_submissions(spark, d))


@query("select cast(c_custkey as varchar) as cik, c_name as name, 'A; B' as tickers, 'N' as exchanges, 'Old (from 1976, until 2007)' as former_names from customer")
def q_submission_companies(spark, d):
    return forms.companies(_submissions(spark, d)).select("cik", "name", "tickers", "exchanges", "former_names")


@query("select o_orderkey, item_code, description from orders, (values ('1.01', 'Entry into agreement'), ('5.02', 'Departure of Directors'), ('9.01', 'Exhibits')) i(item_code, description) where o_orderkey % 2 = 0 or item_code <> '1.01'")
def q_eightk_items(spark, d):
    first = F.when(col("o_orderkey") % 2 == 0, "<p>Item&#160;1.01 Entry into agreement.</p>").otherwise("<p>as told below Item 5.02 in an older paper</p>")
    doc = _doc("<html>", first, "<p>Item 9.01 Exhibits</p>\n<b>Item 5.02</b> Departure of Directors. More, and Item 9.01 Again\n</html>")
    rows = read_table(spark, d, "orders").select("o_orderkey", F.explode(text.eightk_items(doc)).alias("i"))
    return rows.select("o_orderkey", "i.item_code", "i.description")


@query("select o_orderkey, 'Purpose ' || o_orderpriority as body from orders")
def q_item_text(spark, d):
    doc = _doc("ITEM 3. Source of funds. ITEM 4. - Purpose ", col("o_orderpriority"), " ITEM 5. Interest")
    return read_table(spark, d, "orders").select("o_orderkey", F.regexp_replace(text.item_text(doc, "4"), r"^\W+", "").alias("body"))


@query("select s_suppkey, j.name as name, j.jurisdiction as jurisdiction from supplier, lateral (values (s_name || ' Holdings', 'Ireland'), ('Pinecask ' || s_suppkey || ', Inc.', 'Nevada'), ('Voltbarn ' || s_suppkey || ', LLC', '')) j(name, jurisdiction)")
def q_exhibit21(spark, d):
    doc = _doc("<html><h1>List of Subsidiaries</h1><p>", col("s_name"), " Holdings   Ireland</p><p>Pinecask ", col("s_suppkey"), ", Inc.  Nevada</p><p>Delaware</p><p>Voltbarn ", col("s_suppkey"), ", LLC</p><p>12</p></html>")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.subsidiaries(doc)).alias("x"))
    return rows.select("s_suppkey", "x.name", "x.jurisdiction")


@query("""select c_custkey, n.name, n.holder_type, n.shares, n.percent_of_class from customer, lateral (values ('Holder ' || c_custkey || ' Capital LLC', '5pct_holder', 1000 + c_custkey, 5.5), ('All directors and executive officers as a group', 'group_total', 9000 + c_custkey, null)) n(name, holder_type, shares, percent_of_class)""")
def q_ownership(spark, d):
    doc = _doc("<h2>Security Ownership of Certain Beneficial Owners</h2><table><tr><td>Holder ", col("c_custkey"), " Capital LLC</td><td>", F.format_number(col("c_custkey") + 1000, 0), "</td><td>5.5%</td></tr><tr><td>All directors and executive officers as a group</td><td>", F.format_number(col("c_custkey") + 9000, 0), "</td></tr><tr><td>Malvern, PA</td><td>19355</td></tr></table><p>Proposal 2</p><table><tr><td>Late Name Here</td><td>5,000</td></tr></table>")
    rows = spread(read_table(spark, d, "customer")).select("c_custkey", F.explode(prose.beneficial_owners(doc)).alias("x"))
    return rows.select("c_custkey", "x.name", "x.holder_type", "x.shares", "x.percent_of_class")


@query("select s_suppkey, 'Jane Q Doe' as name, cast(y as bigint) as fiscal_year, cast(s_suppkey + 1000 as double) as salary, cast(s_suppkey + 2000 as double) as total from supplier, (values (2023), (2022)) v(y)")
def q_comp_table(spark, d):
    row = lambda name, y: ["<tr><td>", name, f"</td><td>{y}</td><td>$", F.format_number(col("s_suppkey") + 1000, 0), "</td><td>&#8212;</td><td>", F.format_number(col("s_suppkey") + 2000, 0), "</td><td>(5)</td></tr>"]
    doc = _doc("<p>Contents: Summary Compensation Table 31</p><p>", F.repeat(lit("filler text "), 3500), "</p><p>Summary Compensation Table</p><table><tr><th>Name</th><th>Year</th><th>Salary</th><th>Total</th></tr>", *row("Jane Q Doe, Chief Executive Officer", 2023), *row("", 2022), "</table>")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.compensation_rows(doc)).alias("x"))
    return rows.select("s_suppkey", "x.name", col("x.fiscal_year").cast("long").alias("fiscal_year"), col("x.amounts")[0].alias("salary"), F.element_at("x.amounts", -1).alias("total"))


@query("select s_suppkey, n.number, n.description, n.board_recommendation, n.proposal_type from supplier, lateral (values ('1', 'Election of Directors ' || s_suppkey, 'FOR', 'company'), ('2', 'Report on Climate', 'AGAINST', 'shareholder')) n(number, description, board_recommendation, proposal_type)")
def q_proposals(spark, d):
    doc = _doc("<p>Proposal One: Election of Directors ", col("s_suppkey"), ". The board recommends a vote FOR each nominee.</p><p>", F.repeat(lit("filler text "), 70), "</p><p>Proposal 2 - Report on Climate. A stockholder proposal. The board recommends a vote AGAINST it.</p><p>see proposal 400 there</p>")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.proposals(doc)).alias("x"))
    return rows.select("s_suppkey", "x.*")


@query("select s_suppkey, cast(2024 as bigint) as fiscal_year, cast(s_suppkey + 60000 as double) as median_employee_comp, cast(s_suppkey + 100 as double) as ratio from supplier")
def q_pay_ratio(spark, d):
    doc = _doc("<p>2024 CEO pay ratio. Our median employee earned $", F.format_number(col("s_suppkey") + 60000, 0), ". The ratio was ", col("s_suppkey") + 100, " to 1.</p>")
    x = prose.pay_ratio(doc)
    return spread(read_table(spark, d, "supplier")).select("s_suppkey", x["fiscal_year"].cast("long").alias("fiscal_year"), x["median_employee_comp"].alias("median_employee_comp"), x["ratio"].alias("ratio"))


@query("select s_suppkey, 'KPMG' as auditor_name, cast(2023 as bigint) as fiscal_year, cast(s_suppkey + 50000 as double) as audit_fees, cast(s_suppkey as double) as tax_fees from supplier")
def q_audit_fees(spark, d):
    doc = _doc("<p>KPMG LLP billed in 2023:</p><table><tr><td>Audit Fees</td><td>$", F.format_number(col("s_suppkey") + 50000, 0), "</td></tr><tr><td>Tax Fees</td><td>$ ", col("s_suppkey"), "</td></tr></table>")
    x = prose.audit_fees(doc)
    return spread(read_table(spark, d, "supplier")).select("s_suppkey", x["auditor_name"].alias("auditor_name"), x["fiscal_year"].cast("long").alias("fiscal_year"), x["audit_fees"].alias("audit_fees"), x["tax_fees"].alias("tax_fees"))


@query("select s_suppkey, 'Smith' as person_name, 'resignation' as change_type, 'Chief Financial Officer' as position_title, 'March 3, 2024' as effective_date from supplier")
def q_officer_change(spark, d):
    doc = _doc("<p>Item 5.02 Departure of Officers</p><p>Mr. Smith will resign as Chief Financial Officer, effective March 3, 2024. (", col("s_suppkey"), ")</p>")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.officer_changes(doc)).alias("x"))
    return rows.select("s_suppkey", "x.person_name", "x.change_type", "x.position_title", "x.effective_date")


@query("select s_suppkey, 'director' as relationship, cast(2023 as bigint) as year, (s_suppkey + 1) * 1000000.0 as amount_usd from supplier")
def q_related_party(spark, d):
    doc = _doc("<p>Related Person Transactions</p> In 2023 we paid a firm of a director $", col("s_suppkey") + 1, " million for work. A fee of $12 was waived. ")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.related_parties(doc)).alias("x"))
    return rows.select("s_suppkey", "x.relationship", col("x.year").cast("long").alias("year"), "x.amount_usd")


@query("select s_suppkey, 'ipo' as offering_type, cast(s_suppkey + 10000 as double) as shares_offered, 18.0::double as price_per_share, (s_suppkey + 1) * 1000000.0 as net_proceeds, ['Goldman Sachs', 'Morgan Stanley'] as banks from supplier")
def q_offering(spark, d):
    doc = _doc("<h1>Prospectus</h1> This is our initial public offering. We are offering ", F.format_number(col("s_suppkey") + 10000, 0), " shares of common stock at $18.00 per share. We expect net proceeds of $", col("s_suppkey") + 1, " million. The underwriters are Morgan Stanley and Goldman Sachs.")
    x = prose.offering(doc)
    return spread(read_table(spark, d, "supplier")).select("s_suppkey", x["offering_type"].alias("offering_type"), x["shares_offered"].alias("shares_offered"), x["price_per_share"].alias("price_per_share"), x["net_proceeds"].alias("net_proceeds"), prose.underwriters(doc).alias("banks"))


@query("select s_suppkey, 'Quillfen Holdings Trust' as holder_name, 3141000.0::double as shares_before, cast(s_suppkey + 1000 as double) as shares_offered, 2718000.0::double as shares_after from supplier")
def q_selling_holders(spark, d):
    doc = _doc("<h2>Selling Stockholders</h2><table><tr><td>Name</td><td>Before</td></tr><tr><td>1</td><td>Quillfen Holdings Trust</td><td>3,141,000</td><td>", F.format_number(col("s_suppkey") + 1000, 0), "</td><td>2,718,000</td></tr></table>")
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.selling_holders(doc)).alias("x"))
    return rows.select("s_suppkey", "x.*")


@query("select s_suppkey, (s_suppkey + 1) * 1000000.0 as revenue, 7000000.0::double as net_income, 1.25::double as eps_diluted, 'second quarter' as fiscal_period, 'June 30, 2024' as period_end_date from supplier")
def q_earnings(spark, d):
    doc = _doc("<p>Results for the second quarter ended June 30, 2024. Total revenue was $", col("s_suppkey") + 1, " million. Net income was $7 million, or $1.25 per diluted share.</p>")
    x = prose.earnings(doc)
    return read_table(spark, d, "supplier").select("s_suppkey", *[x[c].alias(c) for c in ("revenue", "net_income", "eps_diluted", "fiscal_period", "period_end_date")])


@query("select s_suppkey, s_name as name, 'WC' as source_of_funds, s_suppkey + 1000 as sole_voting_power, s_suppkey + 5000 as aggregate_amount, 7.5::double as percent_of_class, 'IA' as type_of_reporting_person, cast(3 as bigint) as amendment_no, 7.5::double as percent_owned from supplier")
def q_sc13d(spark, d):
    doc = _doc("<p>(Amendment No. 3)</p>(1) NAMES OF REPORTING PERSON\n", col("s_name"), "\n(2) CHECK\n(4) WC\n(6) Delaware\n(7) ", F.format_number(col("s_suppkey") + 1000, 0), "\n(8) 0\n(11) ", F.format_number(col("s_suppkey") + 5000, 0), "\n(13) 7.5%\n(14) IA\n")
    a = prose.activist(doc)
    rows = spread(read_table(spark, d, "supplier")).select("s_suppkey", F.explode(prose.reporting_persons(doc)).alias("x"), a["amendment_no"].cast("long").alias("amendment_no"), a["percent_owned"].alias("percent_owned"))
    return rows.select("s_suppkey", *[f"x.{c}" for c in ("name", "source_of_funds", "sole_voting_power", "aggregate_amount", "percent_of_class", "type_of_reporting_person")], "amendment_no", "percent_owned")


@query("select 'N' || n_nationkey as src, 'P17' as type, 'R' || n_regionkey as dst from nation")
def q_ntriples(spark, d):
    n = read_table(spark, d, "nation")
    e, p = "http://example.org/entity/", "http://example.org/prop/direct/P17"
    a = n.select(_doc(f"<{e}N", col("n_nationkey"), f"> <{p}> <{e}R", col("n_regionkey"), "> .").alias("value"))
    b = n.select(_doc(f"<{e}N", col("n_nationkey"), '> <http://www.w3.org/2000/01/rdf-schema#label> "', col("n_name"), '"@en .').alias("value"))
    return files.entity_graph(files.triples(a.union(b), ["en"]))[1]


@query("select f.id, f.wkt from (select cast(n_nationkey as varchar) as id, 'POINT(' || n_nationkey || ' ' || n_regionkey || ')' as wkt from nation) f")
def q_geojson_features(spark, d):
    doc = _doc('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"id":', col("n_nationkey"), '},"geometry":{"type":"Point","coordinates":[', col("n_nationkey"), ",", col("n_regionkey"), "]}}]}")
    rows = files.features(read_table(spark, d, "nation").select(doc.alias("value")))
    return rows.select(F.try_element_at("properties", lit("id")).alias("id"), geo.wkt(col("geometry")).alias("wkt"))


@query("select time_bucket(interval 1 day, ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2")
def q_tumbling_windows(spark, d):
    from filigree.streaming.landing import windowed

    return windowed(read_table(spark, d, "events"), "ts", "1 day", "1 hour", "event_type").withColumn("total", F.round("total", 2))


# ---- the petroleum registry's datasets -----------------------------------------------------------

_VALUES = ", ".join(f"({i}, '{stem}', '{kind}', '{datasets.SERVICES[kind]}', {layer})" for i, (kind, stem, layer) in enumerate(datasets.ENTRIES))
_NEEDED = f"(select p_partkey, coalesce(e.stem, 'own_' || p_partkey % 160) as stem from part left join (values {_VALUES}) e(i, stem, kind, service, layer) on e.i = p_partkey % 160)"


def _needed(spark, d):
    """Parts as names of datasets; one in fifteen is no name of the catalog."""
    names = F.element_at(F.array(*[lit(stem) for _, stem, _ in datasets.ENTRIES]), (col("p_partkey") % 160 + 1).cast("int"))
    return read_table(spark, d, "part").select("p_partkey", F.when(col("p_partkey") % 160 < len(datasets.ENTRIES), names).otherwise(F.concat(lit("own_"), col("p_partkey") % 160)).alias("stem"))


@query(f"select p_partkey, n.stem, e.kind, e.service || '/' || e.layer || '/query?where=1%3D1&outFields=*&outSR=4326&f=geojson&resultOffset=' || p_partkey || '&resultRecordCount=1000' as url from {_NEEDED} n left join (values {_VALUES}) e(i, stem, kind, service, layer) on e.stem = n.stem")
def q_dataset_catalog(spark, d):
    """Where the catalog serves each name; unknown names have no kind and no address."""
    found = _needed(spark, d).join(datasets.catalog(spark), "stem", "left")
    return found.select("p_partkey", "stem", "kind", datasets.query_url(col("service"), col("layer"), col("p_partkey"), lit(1000)).alias("url"))


@query(f"""with n as (select distinct stem from {_NEEDED}), there as (select distinct stem from {_NEEDED} where p_partkey % 3 = 0)
    select n.stem, e.kind, case when e.stem is not null then 'served' when t.stem is not null then 'user_supplied' else 'unfetchable' end as standing from n left join (values {_VALUES}) e(i, stem, kind, service, layer) on e.stem = n.stem left join there t on t.stem = n.stem""")
def q_dataset_plan(spark, d):
    """What a blueprint needs except what the catalog serves, taken apart by the files that are there."""
    needed = _needed(spark, d)
    return datasets.plan(needed, datasets.catalog(spark), needed.where("p_partkey % 3 = 0")).select("stem", "kind", "standing")


@query("select * from (select user_id, event_id, dense_rank() over (order by first, user_id) as n from (select user_id, event_id, min(event_id) over (partition by user_id) as first from events)) where n <= (select count(distinct user_id) // 2 from events)")
def q_entity_cap_large(spark, d):
    """The first half of the entities by where they first stand, numbered by ranges instead of one task's top."""
    e = read_table(spark, d, "events").withColumnRenamed("user_id", "subject")
    half = e.agg(F.countDistinct("subject")).first()[0] // 2
    seen = lookup.sequential_key(e.groupBy("subject").agg(F.min("event_id").alias("_first")), ["_first", "subject"], "n").where(col("n") <= half)
    return e.join(seen.select("subject", "n"), "subject").select(col("subject").alias("user_id"), "event_id", "n")
