"""The petroleum registry's datasets: which there are, where they are served, which of them a run needs, and refreshing them.

The catalog has the registry's layers, tables and map layers; a name is looked up in that order. plan() takes what a
blueprint needs apart into what the catalog serves, what users have put there themselves, and what nobody has. refresh()
brings the served ones up to date and survives being stopped: each dataset that is done is logged before the next counts,
and a later run goes on from the log.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions.geo import wkt
from filigree.sources.sinks import Store, table_path, write_table
from filigree.streaming import refresh as rules

#: Services that datasets come from (fixed values).
SERVICES = {
    "layer": "https://factmaps.sodir.no/api/rest/services/DataService/Data/FeatureServer",
    "table": "https://factmaps.sodir.no/api/rest/services/DataService/Data/FeatureServer",
    "factmaps": "https://factmaps.sodir.no/api/rest/services/Factmaps/FactMapsWGS84/FeatureServer",
}
#: Datasets of each kind, with their number in its service, in order of lookup (fixed values).
DATASETS = {
    "layer": """
        block 1001
        quadrant 1002
        sub_area 1003
        sbm_block 1004
        sbm_quadrant 1005
        areastatus 1100
        structural_elements 2000
        domes 2001
        faults_boundaries 2002
        sediment_boundaries 2004
        licence 3000
        licence_area_poly_hst 3002
        licence_document_area 3006
        licence_area_count 3011
        apa_gross 3102
        apa_open 3103
        announced_blocks_history 3104
        announced_history 3106
        apa_gross_history 3107
        afex_area 3200
        afex_area_history 3201
        business_arrangement_area 3300
        business_arrangement_history 3301
        seismic_acquisition 4000
        seismic_acquisition_poly 4008
        sbm_sample_point 4501
        sbm_survey_area 4502
        sbm_survey_line 4503
        sbm_survey_sub_area 4504
        wellbore 5000
        facility 6000
        pipeline 6100
        discovery 7000
        discovery_map_reference 7004
        discovery_poly_hst 7005
        field 7100
        play 7800
        sbm_occurrence 8001
        sbm_play_resource_estimate 8002
    """,
    "table": """
        company 1200
        strat_litho 2100
        strat_litho_wellbore 2101
        strat_litho_wellbore_core 2102
        strat_chrono 2200
        licence_additional_area 3001
        licence_transfer_hst 3003
        licence_document 3005
        licence_licensee_hst 3007
        licence_operator_hst 3008
        licence_phase_hst 3009
        licence_task 3010
        licensing_activity 3100
        business_arrangement_operator 3302
        business_arrangement_licensee_hst 3304
        business_arrangement_transfer_hst 3305
        petreg_licence 3400
        petreg_licence_licensee 3401
        petreg_licence_message 3402
        petreg_licence_operator 3403
        seismic_acquisition_company 4001
        seismic_acquisition_format 4002
        seismic_acquisition_fishery 4003
        seismic_acquisition_for_company 4004
        seismic_acquisition_licence 4005
        seismic_acquisition_licences 4006
        seismic_acquisition_polygon 4009
        seismic_acquisition_progress 4011
        seismic_acquisition_scientific 4012
        seismic_acquisition_vessel 4013
        seismic_acquisition_weekly_done 4014
        seismic_acquisition_weekly_plan 4015
        wellbore_casing 5001
        wellbore_co2 5002
        wellbore_core 5003
        wellbore_core_photo 5004
        wellbore_core_photo_aggr 5005
        wellbore_cutting 5006
        wellbore_document 5007
        wellbore_dst 5008
        wellbore_formation_top 5009
        wellbore_log 5011
        wellbore_mud 5012
        wellbore_oil_sample 5013
        wellbore_paly_slide 5014
        wellbore_thin_section 5015
        wellbore_history 5050
        facility_function 6001
        tuf 6200
        tuf_operator_hst 6201
        tuf_owner_hst 6202
        discovery_description 7001
        discovery_extends_into 7002
        discovery_licensee_hst 7003
        discovery_operator_hst 7006
        discovery_owner_hst 7007
        discovery_reserves 7008
        field_activity_status_hst 7101
        field_description 7102
        field_discoveries_incl_hst 7103
        field_extends_into 7104
        field_image 7106
        field_investment_expected 7107
        field_licensee_hst 7108
        field_operator_hst 7110
        field_owner_hst 7111
        field_pdo_hst 7112
        field_reserves 7113
        field_reserves_company 7114
        profiles 7300
        csd_injection 9001
    """,
    "factmaps": """
        wellbore_all 201
        wellbore_exploration_active 203
        wellbore_exploration 204
        wellbore_development 205
        wellbore_other 206
        wellbore_co2_factmaps 207
        facility_in_place 304
        facility_not_in_place 306
        facility_all 307
        pipeline_factmaps 311
        seismic_pending 403
        seismic_planned 404
        seismic_ongoing 405
        seismic_paused 406
        seismic_cancelled 407
        seismic_finished 421
        em_pending 409
        em_planned 410
        em_ongoing 411
        em_paused 412
        em_cancelled 413
        em_finished 422
        survey_all 420
        other_survey_pending 415
        other_survey_planned 416
        other_survey_ongoing 417
        other_survey_paused 418
        other_survey_cancelled 419
        other_survey_finished 423
        field_by_status 502
        discovery_active 503
        discovery_all 504
        discovery_history 505
        play_factmaps 540
        apa_gross_factmaps 603
        apa_open_factmaps 604
        blocks_factmaps 802
        quadrants_factmaps 803
        sub_areas_factmaps 804
    """,
}
ENTRIES = [(kind, *line.split()) for kind, lines in DATASETS.items() for line in lines.strip().splitlines()]


def catalog(spark: SparkSession) -> DataFrame:
    """(stem, kind, service, layer): a row for each dataset; of equal names the first by order of lookup."""
    first = {}
    for kind, stem, layer in ENTRIES:
        first.setdefault(stem, (stem, kind, SERVICES[kind], int(layer)))
    return spark.createDataFrame(list(first.values()), "stem string, kind string, service string, layer int")


def query_url(service, layer, offset, size):
    """Where a page of a dataset is served."""
    return F.concat(service, F.lit("/"), layer.cast("string"), F.lit("/query?where=1%3D1&outFields=*&outSR=4326&f=geojson&resultOffset="), offset.cast("string"), F.lit("&resultRecordCount="), size.cast("string"))


def plan(needed: DataFrame, known: DataFrame, present: DataFrame) -> DataFrame:
    """needed (stem), each once, with kind, service, layer and standing: served; user_supplied where the catalog lacks it but a file (present: stem) is there; else unfetchable."""
    files = present.select("stem").distinct().withColumn("_there", F.lit(True))
    rows = needed.select("stem").where("stem is not null").distinct().join(known, "stem", "left").join(files, "stem", "left")
    standing = F.when(F.col("kind").isNotNull(), "served").when(F.col("_there"), "user_supplied").otherwise("unfetchable")
    return rows.withColumn("standing", standing).drop("_there")


def paged_features(spark: SparkSession, folder: str, size: int = 1000) -> DataFrame:
    """(page, place, properties, geometry) of a dataset that has been landed by pages: files named by their offset, each a feature collection.

    Pages end with the first that has fewer than size features, or none at all; what lies behind it is no part of the
    dataset. Pages are read side by side; only their sizes are looked at for the end.
    """
    raw = spark.read.text(f"{folder}/*.json", wholetext=True).select("value", F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).try_cast("bigint").alias("page"))
    parsed = F.from_json("value", "features array<struct<properties:map<string,string>,geometry:string>>")["features"]
    pages = raw.where("page is not null").select("page", F.coalesce(F.size(F.from_json("value", "features array<string>")["features"]), F.lit(0)).alias("n"))
    end = pages.where(F.col("n") < size).agg(F.min("page")).first()[0]  # one number
    rows = raw.where("page is not null" if end is None else f"page <= {end}")
    return rows.select("page", F.posexplode(parsed).alias("place", "f")).select("page", "place", "f.properties", "f.geometry")


def feature_rows(rows: DataFrame) -> DataFrame:
    """Properties as they are, and the geometry as well-known text."""
    return rows.select("properties", wkt(F.col("geometry")).alias("wkt_geometry"))


# ---- refresh -----------------------------------------------------------------------------------

LOG = "_log"


class Log:
    """What a folder's datasets have come to: a file for each completed step, written whole; the last of a dataset counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def entries(self) -> dict[str, dict]:
        found: dict[str, dict] = {}
        for name in self.store.names(LOG):
            if name.endswith(".json"):
                entry = json.loads(self.store.read(f"{LOG}/{name}") or "{}")
                found[entry["stem"]] = found.get(entry["stem"], {}) | entry
        return found

    def add(self, **entry) -> None:
        self.store.write(f"{LOG}/{time.time_ns():020d}-{entry['stem']}.json", json.dumps(entry, sort_keys=True))

    def compact(self) -> None:
        """One entry for each dataset; the older ones go once it is there."""
        old = [n for n in self.store.names(LOG) if n.endswith(".json")]
        for entry in self.entries().values():
            self.add(**entry)
        for n in old:
            self.store.remove(f"{LOG}/{n}")


def actions(spark: SparkSession, stems: list[str], log: dict[str, dict], now: str, sweep: bool, cooldown_days: int = 14) -> dict[str, str]:
    """fetch, probe or skip for each dataset, the largest first."""
    if not stems:
        return {}
    rows = [(s, log.get(s, {}).get("fetched_at"), log.get(s, {}).get("size_bytes"), log.get(s, {}).get("rows")) for s in sorted(set(stems))]
    manifest = spark.createDataFrame(rows, "name string, fetched_at string, size_bytes bigint, rows bigint")
    decided = rules.largest_first(rules.dataset_action(manifest, F.lit(now), F.lit(sweep), cooldown_days))
    return {r["name"]: r["action"] for r in decided.collect()}  # as many rows as the catalog has at most


def refresh(spark: SparkSession, root: str, stems: list[str], fetch: Callable[[str], DataFrame], now: str, remote_rows: Callable[[str], int] | None = None, sweep: bool = False, workers: int = 4, on_event: Callable[[dict], None] = lambda e: None) -> dict[str, list]:
    """Brings datasets up to date and says what became of each: fetched, unchanged, cached, errors (stem, message).

    Each is a Spark job of its own (fetch gives its rows), a few at a time; its table is swapped in whole, and then it is
    logged. A failing dataset doesn't stop the others. Stopped at any point, a later run fetches only what isn't logged.
    on_event gets start, update and complete events, on the caller's thread. A probe fetches where remote_rows differs.
    """
    log = Log(spark, root)
    before = log.entries()
    todo = actions(spark, stems, before, now, sweep)
    report: dict[str, list] = {"fetched": [], "unchanged": [], "cached": [s for s, a in todo.items() if a == "skip"], "errors": []}
    work = [(s, a) for s, a in todo.items() if a != "skip"]
    on_event({"event": "start", "total": len(work)})

    def one(stem: str, action: str) -> dict:
        if action == "probe" and remote_rows is not None and remote_rows(stem) == before[stem].get("rows"):
            return {"stem": stem, "checked_at": now}
        write_table(fetch(stem), root, stem)
        path = table_path(spark, root, stem)
        return {"stem": stem, "fetched_at": now, "checked_at": now, "rows": spark.read.parquet(path).count(), "size_bytes": log.store.size(path.removeprefix(f"{log.store.root}/"))}

    try:
        with ThreadPoolExecutor(workers) as pool:
            running = {pool.submit(one, s, a): s for s, a in work}
            try:
                for n, job in enumerate(as_completed(running), 1):
                    stem = running[job]
                    try:
                        entry = job.result()
                    except Exception as e:  # a dataset's failure is its own
                        report["errors"].append((stem, str(e)))
                    else:
                        log.add(**entry)
                        report["fetched" if "fetched_at" in entry else "unchanged"].append(stem)
                    on_event({"event": "update", "stem": stem, "done": n, "total": len(work)})
            except BaseException:  # stopped: what runs is let end, nothing new begins
                pool.shutdown(wait=True, cancel_futures=True)
                raise
    finally:
        on_event({"event": "complete"} | {k: len(v) for k, v in report.items()})
    return report
