"""Lookup joins, keys and identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filigree.session import kept


def lookup(rows: DataFrame, dim: DataFrame, on: str, key: str, value: str, order: str, into: str) -> DataFrame:
    """rows with the value of the dim row whose key equals their on; of equal keys the last (by order) wins.

    Blank keys and values of dim don't count. Unmatched rows get null, which unmatched() counts.
    """
    usable = dim.where((F.coalesce(F.col(key).cast("string"), F.lit("")) != "") & (F.coalesce(F.col(value).cast("string"), F.lit("")) != ""))
    last = usable.groupBy(F.col(key).alias(on)).agg(F.max_by(value, order).alias(into))
    return rows.drop(into).join(last, on, "left")


def unmatched(joined: DataFrame, into: str) -> DataFrame:
    return joined.agg(F.count_if(F.col(into).isNull()).alias("unmatched"))


def sequential_key(rows: DataFrame, order: list[str], into: str) -> DataFrame:
    """rows numbered 1..n by order. Numbering is global, but no task sees all rows.

    Rows are range-partitioned by the order; each partition is counted, and a row's number is its place in its
    partition plus the rows of the partitions before, a table with one row for each partition.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_o", F.struct(*order))
    parts = kept(keyed.repartitionByRange(n, "_o").withColumn("_p", F.spark_partition_id()))  # one dealing for both uses
    counts = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    within = F.row_number().over(Window.partitionBy("_p").orderBy("_o"))
    return parts.join(F.broadcast(before), "_p").withColumn(into, (within + F.col("_before")).cast("bigint")).drop("_o", "_p", "_before")


def propagate_key(parent: DataFrame, child: DataFrame, natural: str, into: str) -> DataFrame:
    """child with the parent's key for its natural key, null where there is none."""
    keys = parent.groupBy(natural).agg(F.max(into).alias(into))
    return child.drop(into).join(keys, natural, "left")


def parent_key(rows: DataFrame, key: str, name: str, parent_name: str, into: str) -> DataFrame:
    """A self join: the key of the row whose name is a row's parent name."""
    names = rows.where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(F.col(name).alias(parent_name)).agg(F.max(key).alias(into))
    return rows.drop(into).join(names, parent_name, "left")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first by order, which must tell rows apart."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")


def dictionary(rows: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """Each key with its first value by order."""
    return rows.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.min_by(value, order).alias(value))


def drifted(local: DataFrame, remote: DataFrame, key: str, count: str) -> DataFrame:
    """Keys whose remote count differs from the local one, or that only the remote side has."""
    a, b = local.select(key, F.col(count).alias("local")), remote.select(key, F.col(count).alias("remote"))
    return b.join(a, key, "left").where(~F.col("local").eqNullSafe(F.col("remote")))
