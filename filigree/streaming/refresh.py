"""Decisions of incremental runs. Each is a Column, so that a manifest of any size is decided by one Spark job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def age_days(stamp: Column, now: Column) -> Column:
    """Days since an ISO time; endless for one that can't be read."""
    t = F.try_to_timestamp(stamp)
    return F.coalesce((now.cast("timestamp").cast("double") - t.cast("double")) / 86_400, F.lit(float("inf")))


def dataset_action(manifest: DataFrame, now: Column, sweep_due: Column, cooldown_days: int = 14) -> DataFrame:
    """manifest (fetched_at, size_bytes) with action: fetch where nothing usable is there or it is old, probe in a sweep, else skip."""
    unusable = F.col("fetched_at").isNull() | F.col("size_bytes").isNull() | (F.col("size_bytes") < 5)
    old = age_days(F.col("fetched_at"), now) >= cooldown_days
    return manifest.withColumn("action", F.when(unusable | old, F.lit("fetch")).when(sweep_due, F.lit("probe")).otherwise(F.lit("skip")))


def sweep_due(last_check: Column, now: Column, cooldown_days: int = 30) -> Column:
    return last_check.isNull() | (age_days(last_check, now) >= cooldown_days)


def freshness(caches: DataFrame, cooldown_days: int = 31) -> DataFrame:
    """caches (force, built, age_days, remote, embedded) with decision: build, load or rebuild, and reason."""
    c = F.col
    reason = (
        F.when(c("force"), F.lit("force_rebuild"))
        .when(~c("built"), F.lit("no_cache"))
        .when(c("age_days") < cooldown_days, F.lit("within_cooldown"))
        .when(c("remote").isNull(), F.lit("remote_unreachable"))
        .when(c("embedded").isNull(), F.lit("embedded_mtime_missing"))
        .when(c("remote") <= c("embedded"), F.lit("remote_unchanged"))
        .otherwise(F.lit("remote_newer"))
    )
    kind = F.when(reason.isin("force_rebuild", "no_cache"), F.lit("build")).when(reason.isin("within_cooldown", "remote_unreachable", "remote_unchanged"), F.lit("load")).otherwise(F.lit("rebuild"))
    return caches.withColumns({"decision": kind, "reason": reason})


def graph_size_gb(years: Column, detailed: Column, ciks: Column, subsidiaries: bool, metrics: bool, events: bool) -> Column:
    """Expected size of a registry graph; 6000 companies are the whole universe."""
    share = F.when(ciks.isNull() | (ciks == 0), F.lit(1.0)).otherwise(F.least(ciks / 6000.0, F.lit(1.0)))
    each = 0.6 + 4.0 * metrics + 1.0 * events + 0.05 * subsidiaries
    return (0.1 * years + each * F.greatest(detailed, F.lit(0))) * share


def storage_mode(gb: Column) -> Column:
    return F.when(gb < 4, F.lit("memory")).when(gb < 16, F.lit("mapped")).otherwise(F.lit("disk"))


def largest_first(manifest: DataFrame, rows: str = "rows") -> DataFrame:
    return manifest.orderBy(F.desc(F.coalesce(F.col(rows), F.lit(0))), "name")
