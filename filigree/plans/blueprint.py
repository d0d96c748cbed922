"""Blueprints: which tables are nodes, which keys are edges, and what is computed on top; compiled to DataFrame plans."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filigree.operators.lookup import first_wins


def nodes(rows: DataFrame, label: str, pk: str, title: str | None = None, order: list[str] | None = None, properties: list[str] | None = None) -> DataFrame:
    """(label, id, title, properties: map of text): one row for each key; of rows with equal keys the first by order."""
    used = rows.where(F.col(pk).isNotNull())
    props = F.create_map(*[x for c in properties or [] for x in (F.lit(c), F.col(c).cast("string"))]) if properties else F.lit(None).cast("map<string,string>")
    if order or properties:
        used = first_wins(used, [pk], order or sorted(properties))
        return used.select(F.lit(label).alias("label"), F.col(pk).cast("string").alias("id"), (F.col(title) if title else F.lit(None)).cast("string").alias("title"), props.alias("properties"))
    return used.groupBy(F.col(pk).cast("string").alias("id")).agg(F.min(F.col(title or pk).cast("string")).alias("title")).select(F.lit(label).alias("label"), "id", "title", props.alias("properties"))


def fk_edges(src: DataFrame, src_label: str, pk: str, fk: str, kind: str, dst: DataFrame, dst_label: str, dst_pk: str) -> DataFrame:
    """An edge for each row whose key has a target; dangling keys give none."""
    targets = dst.select(F.col(dst_pk).cast("string").alias("dst")).where("dst is not null")
    return src.select(F.col(pk).cast("string").alias("src"), F.col(fk).cast("string").alias("dst")).join(targets, "dst", "left_semi").select(F.lit(src_label).alias("src_label"), "src", F.lit(kind).alias("type"), F.lit(dst_label).alias("dst_label"), "dst")


def dangling(src: DataFrame, fk: str, dst: DataFrame, dst_pk: str) -> DataFrame:
    return src.where(F.col(fk).isNotNull()).join(dst.select(F.col(dst_pk).alias(fk)), fk, "left_anti")


def junction_edges(bridge: DataFrame, left: DataFrame, left_fk: str, left_pk: str, right: DataFrame, right_fk: str, right_pk: str, kind: str) -> DataFrame:
    """Edges of a many-to-many table whose both ends exist."""
    a, b = left.select(F.col(left_pk).alias(left_fk)).distinct(), right.select(F.col(right_pk).alias(right_fk)).distinct()
    return bridge.join(a, left_fk, "left_semi").join(b, right_fk, "left_semi").select(F.col(left_fk).cast("string").alias("src"), F.lit(kind).alias("type"), F.col(right_fk).cast("string").alias("dst"))


def chain(rows: DataFrame, pk: str, group: list[str], order: Column, kind: str) -> DataFrame:
    """(src, type, dst): each row to the next of its group by order, ties by key; rows without order are left out."""
    w = Window.partitionBy(*group).orderBy("_o", pk)
    led = rows.withColumn("_o", order).where("_o is not null").withColumn("dst", F.lead(pk).over(w))
    return led.where("dst is not null").select(F.col(pk).cast("string").alias("src"), F.lit(kind).alias("type"), F.col("dst").cast("string").alias("dst"))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(day, next_day, month, quarter): a day dimension with its next day, month and quarter."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("day"))
    nxt = F.when(F.col("day") < F.lit(end).cast("date"), F.date_add("day", 1))
    return days.select("day", nxt.alias("next_day"), F.date_format("day", "yyyy-MM").alias("month"), F.concat(F.year("day").cast("string"), F.lit("-Q"), F.quarter("day").cast("string")).alias("quarter"))


def on_day(rows: DataFrame, pk: str, day: Column, kind: str, start: str, end: str) -> DataFrame:
    """Edges from rows to their day of the calendar; days outside it and malformed days give none."""
    return rows.select(F.col(pk).cast("string").alias("src"), F.lit(kind).alias("type"), day.try_cast("date").alias("d")).where(F.col("d").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("src", "type", F.col("d").cast("string").alias("dst"))


_SAFE = [
    (re.compile(r"^year\((\w+)\)$"), lambda m: F.year(F.col(m[1]).try_cast("date"))),
    (re.compile(r"^(\w+) == '([^']*)'$"), lambda m: F.col(m[1]) == m[2]),
    (re.compile(r"^count\(\*\)$"), lambda m: F.count("*")),
    (re.compile(r"^(min|max)\((\w+)\)$"), lambda m: getattr(F, m[1])(m[2])),
    (re.compile(r"^sum\(if\((\w+) == '([^']*)', (\w+), 0\)\)$"), lambda m: F.coalesce(F.sum(F.when(F.col(m[1]) == m[2], F.lit(int(m[3])) if m[3].isdigit() else F.col(m[3])).otherwise(F.lit(0))), F.lit(0))),
]


def expression(text: str) -> Column:
    """A compute expression of a blueprint: year(c), c == 'x', count(*), min(c), max(c), sum(if(c == 'x', v, 0))."""
    for form, build in _SAFE:
        if m := form.match(text.strip()):
            return build(m)
    raise ValueError(f"not a compute expression: {text}")


def derive(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.withColumns({n: expression(e) for n, e in columns.items()})


def aggregate(rows: DataFrame, group: list[str], columns: dict[str, str]) -> DataFrame:
    return rows.groupBy(*group).agg(*[expression(e).alias(n) for n, e in columns.items()])


def deep_merge(base, addition, override: bool = False):
    """Objects merge key by key; elsewhere base stays unless override, and lists and plain values are replaced whole."""
    if isinstance(base, dict) and isinstance(addition, dict):
        return base | {k: deep_merge(base[k], v, override) if k in base else v for k, v in addition.items()}
    return addition if override and not isinstance(base, dict) else base


def tables_used(blueprint: dict) -> list[str]:
    """The distinct table names of nodes, junctions and sub-nodes, sorted."""
    found: set[str] = set()

    def walk(x) -> None:
        if isinstance(x, dict):
            if isinstance(x.get("csv"), str):
                found.add(re.sub(r"^.*/|\.[^./]*$", "", x["csv"]))
            for v in x.values():
                walk(v)
        elif isinstance(x, list):
            for v in x:
                walk(v)

    walk(blueprint)
    return sorted(found)


class Graph:
    """Node and edge DataFrames, with a small pattern builder: graph.nodes("A").out("R").nodes("B")."""

    def __init__(self, node_rows: DataFrame, edge_rows: DataFrame):
        self.node_rows, self.edge_rows = node_rows, edge_rows

    def nodes(self, label: str | None = None, **where) -> Pattern:
        found = self.node_rows if label is None else self.node_rows.where(F.col("label") == label)
        for c, v in where.items():  # anything but label, id and title is a property
            found = found.where((F.col(c) if c in ("id", "title") else F.try_element_at("properties", F.lit(c))) == F.lit(v).cast("string"))
        return Pattern(self, found.select(F.col("id").alias("n0"), F.col("label").alias("l0")), 0)

    def edge_count(self, kind: str) -> DataFrame:
        return self.edge_rows.where(F.col("type") == kind).agg(F.count("*").alias("n"))

    def fingerprint(self, first: int = 25) -> DataFrame:
        """(what, name, n): counts of labels and edge types, and the first ids (a report's top)."""
        labels = self.node_rows.groupBy("label").count().select(F.lit("label").alias("what"), F.col("label").alias("name"), F.col("count").alias("n"))
        types = self.edge_rows.groupBy("type").count().select(F.lit("edge").alias("what"), F.col("type").alias("name"), F.col("count").alias("n"))
        ids = self.node_rows.orderBy("id", "label").limit(first).select(F.lit("id").alias("what"), F.col("id").alias("name"), F.lit(0).cast("long").alias("n"))
        return labels.unionByName(types).unionByName(ids)


class Pattern:
    """A path so far: columns n0, n1, ... of node ids."""

    def __init__(self, graph: Graph, rows: DataFrame, last: int):
        self.graph, self.rows, self.last = graph, rows, last

    def out(self, kind: str, label: str | None = None) -> Pattern:
        """Along edges of a type, to nodes of a label."""
        edges = self.graph.edge_rows.where(F.col("type") == kind)
        if label:
            edges = edges.where(F.col("dst_label") == label)
        n = self.last
        step = edges.select(F.col("src").alias(f"n{n}"), F.col("src_label").alias(f"l{n}"), F.col("dst").alias(f"n{n + 1}"), F.col("dst_label").alias(f"l{n + 1}"))
        return Pattern(self.graph, self.rows.join(step, [f"n{n}", f"l{n}"]), n + 1)

    def select(self, at: int, *names: str) -> DataFrame:
        """Ids, titles or properties of the path's nodes number at."""
        own = self.graph.node_rows.select(F.col("id").alias(f"n{at}"), F.col("label").alias(f"l{at}"), "title", "properties")
        col = lambda c: F.col(f"n{at}") if c == "id" else F.col("title") if c == "title" else F.try_element_at("properties", F.lit(c))
        return self.rows.join(own, [f"n{at}", f"l{at}"]).select(*[col(c).alias(c) for c in names])

    def count(self) -> DataFrame:
        return self.rows.agg(F.count("*").alias("n"))

    def group(self, *by: str) -> DataFrame:
        return self.rows.groupBy(*by).agg(F.count("*").alias("n"))


def compile_blueprint(tables: dict[str, DataFrame], blueprint: dict) -> Graph:
    """The graph of a blueprint over tables by name: nodes, key edges, then computes in their order."""
    spec, frames = blueprint["nodes"], dict(tables)
    stem = lambda n: re.sub(r"^.*/|\.[^./]*$", "", spec[n]["csv"])
    rows = {n: frames[stem(n)] for n in spec}
    node_parts, edge_parts = [], []
    by_name = lambda path: frames[re.sub(r"^.*/|\.[^./]*$", "", path)]
    for n, s in spec.items():
        for kind, e in s.get("connections", {}).get("junction_edges", {}).items():
            t = e["target"]
            made = junction_edges(by_name(e["csv"]), rows[n], e["source_fk"], s["pk"], rows[t], e["target_fk"], spec[t]["pk"], kind)
            edge_parts.append(made.select(F.lit(n).alias("src_label"), "src", "type", F.lit(t).alias("dst_label"), "dst"))
        for label, sub in s.get("sub_nodes", {}).items():  # rows of a table of their own that belong to a node
            own = by_name(sub["csv"])
            if sub["pk"] not in own.columns:
                own = own.withColumn(sub["pk"], F.xxhash64(*[F.col(c) for c in own.columns]))
            node_parts.append(nodes(own, label, sub["pk"], sub.get("title"), properties=sub.get("properties")))
            edge_parts.append(fk_edges(own, label, sub["pk"], sub["parent_fk"], sub.get("edge", f"OF_{n.upper()}"), rows[n], n, s["pk"]))
    for n, s in spec.items():
        for kind, e in s.get("connections", {}).get("fk_edges", {}).items():
            t = e["target"]
            edge_parts.append(fk_edges(rows[n], n, s["pk"], e["fk"], kind, rows[t], t, spec[t]["pk"]))
    flat = lambda df, a, b: df.select(F.lit(a).alias("src_label"), "src", "type", F.lit(b).alias("dst_label"), "dst")
    for op in blueprint.get("compute", []):
        if op["op"] == "derive":
            rows[op["from"]] = derive(rows[op["from"]], op["set"])
        elif op["op"] == "chain":
            n = op["from"]
            edge_parts.append(flat(chain(rows[n], spec[n]["pk"], op["group_by"], F.col(op["order_by"]).try_cast("date"), op["edge"]), n, n))
        elif op["op"] == "calendar":
            spark = next(iter(rows.values())).sparkSession
            days = calendar(spark, op["start"], op["end"])
            node_parts.append(nodes(days.select(F.col("day").cast("string").alias("day")), op["type"], "day"))
            nxt = days.where("next_day is not null").select(F.col("day").cast("string").alias("src"), F.lit(op["next_edge"]).alias("type"), F.col("next_day").cast("string").alias("dst"))
            edge_parts.append(flat(nxt, op["type"], op["type"]))
            for link in op.get("links", []):
                if link["from"] in rows:
                    edge_parts.append(flat(on_day(rows[link["from"]], spec[link["from"]]["pk"], F.col(link["date_col"]), link["edge"], op["start"], op["end"]), link["from"], op["type"]))
        elif op["op"] == "aggregate":
            made = aggregate(rows[op["from"]], op["group_by"], op["agg"]).withColumn("_pk", F.concat_ws("|", *op["group_by"]))
            rows[op["into"]] = made
            node_parts.append(nodes(made, op["into"], "_pk"))
            for e in op.get("edges", []):
                edge_parts.append(fk_edges(made, op["into"], "_pk", e["fk"], e["edge"], rows[e["to"]], e["to"], spec[e["to"]]["pk"]))
    node_parts += [nodes(rows[n], n, s["pk"], s.get("title"), properties=s.get("properties")) for n, s in spec.items()]  # with what derive has added
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    return Graph(union(node_parts), union(edge_parts))
