"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bridge
from checks.bridge import RUN_TS, TIE_BREAK, ZONES
from skytally.functions import (
    continent_code, continent_name, country_code_of_name, great_circle_km, manufacturer,
    partition_labels, to_double, to_int,
)
from skytally.layout import Lake
from skytally.operators import dimensions as dims
from skytally.operators import kpis, profile, quality, rollup, sketches, zones
from skytally.operators.enrich import fill_from_dimensions
from skytally.operators.pick import latest_per_flight
from skytally.plans import runs as run_plans
from skytally.plans.batch import RunSettings, replay, run_batch
from skytally.plans.gold import gold_tables
from skytally.plans.silver import silver_fact
from skytally.plans.state import current_fact, merge_batch
from skytally.schema import ATTEMPT, FLIGHTS_RAW, LABEL_COLUMNS
from skytally.session import apply_settings, scratch_path
from skytally.sinks import reports
from skytally.sinks.lake import label_hours, write_bronze, write_dimension, write_fact, write_gold
from skytally.sources import feed as feeds
from skytally.sources import reference_files as refs
from skytally.sources import runs as run_sources
from skytally.sources.lake import read_bronze, read_latest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

KEY = ("flight_id", *TIE_BREAK)


def portable(df: DataFrame) -> DataFrame:
    """Types and precision every SQL engine agrees on: bigint, text instants, 3 decimals."""
    def column(name: str, dtype: str) -> Column:
        value = F.col(f"`{name}`")
        if dtype in ("int", "smallint", "tinyint"):
            value = value.cast("long")
        elif dtype in ("double", "float"):
            value = F.round(value, 3)
        elif dtype.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return value.alias(name)
    return df.select(*(column(n, t) for n, t in df.dtypes))


def query(fn: Query) -> Query:
    """Register a query under its function's name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(apply_settings(spark), sf_dir.rstrip("/")))
    QUERIES[fn.__name__] = run
    return run


# what flagging needs, and the batch
FLAG_INPUT = ("batch_id", *quality.CODE_COLUMNS, "latitude", "longitude", "altitude",
              "ground_speed", "on_ground")

# what the Silver fact is made of, as far as KPIs and dimensions need it
SILVER_INPUT = tuple(
    c for c in (*FLIGHTS_RAW.names, *TIE_BREAK) if c != "source_zone"
)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver fact by the library's own plan, over the flagged observations."""
    return silver_fact(bridge.flagged(spark, sf_dir, SILVER_INPUT), bridge.airports_dim(spark),
                       bridge.airlines_dim(spark), tie_break=TIE_BREAK)


def labelled_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_hours(
        silver(spark, sf_dir), F.date_trunc("month", F.col("extraction_timestamp")))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows as a written table: several plans can then read it without redoing it."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_lake(spark: SparkSession) -> Lake:
    return Lake(scratch_path(spark, "lake"))


# --- ingest ------------------------------------------------------------------------------

INGEST_COLUMNS = (
    "extraction_timestamp", "batch_id", "source_zone", "flight_id", "callsign", "flight_number",
    "airline_icao", "aircraft_code", "origin_iata", "destination_iata", "latitude", "longitude",
    "altitude", "ground_speed", "heading", "on_ground", "airline_name", "status_text",
)


@query
def ingest_feed(spark, sf_dir):
    landed = feeds.read_feed(spark, bridge.land_feed(spark, sf_dir))
    return feeds.to_observations(landed, RUN_TS, "B1").select(*INGEST_COLUMNS)


@query
def ingest_rejects(spark, sf_dir):
    """What the ingest put into quarantine, with its reason."""
    lake = new_lake(spark)
    landed = feeds.read_feed(spark, bridge.land_feed(spark, sf_dir))
    feeds.stage_feed(landed, lake, RUN_TS, "B1")
    return feeds.read_quarantine(spark, lake).groupBy("reason").agg(F.count("*").alias("records"))


@query
def ingest_staged(spark, sf_dir):
    """The observations of a feed that was parsed once, beside its quarantine."""
    lake = new_lake(spark)
    landed = feeds.read_feed(spark, bridge.land_feed(spark, sf_dir))
    return feeds.stage_feed(landed, lake, RUN_TS, "B1").observations.select(*INGEST_COLUMNS)


@query
def collect_zones(spark, sf_dir):
    """Feeds landed per zone; zones overlap, one wanted zone has not landed anything."""
    rows = bridge.feed(spark, sf_dir, (
        "flight_id", "callsign", "latitude", "longitude", "altitude", "on_ground", "source_zone"))
    landing = zones.union_zones(rows, ZONES, list(ZONES)).select(
        F.to_json(F.struct(F.col("flight_id").alias("id"), "callsign", "latitude", "longitude",
                           "altitude", "on_ground")).alias("value"),
        F.col("source_zone").alias("zone"))
    path = scratch_path(spark, "zone-feeds")
    landing.write.partitionBy("zone").text(path)
    wanted = ["north", "southwest", "nowhere"]
    return feeds.collect_zones(spark, path, wanted, RUN_TS, "B1").select(
        "flight_id", "callsign", "source_zone", "latitude", "longitude", "altitude", "on_ground")


@query
def ingest_empty(spark, sf_dir):
    """One zone landed, a root where none has landed, and a root that is not there."""
    lines = bridge.landed_feed_lines(spark, sf_dir)
    full, empty = scratch_path(spark, "feed"), scratch_path(spark, "feed")
    lines.withColumn("zone", F.lit("north")).write.partitionBy("zone").text(full)
    lines.where(F.lit(False)).write.text(empty)

    def counts(landing: str, root: str) -> DataFrame:
        flights = feeds.collect_zones(spark, root, ["north", "nowhere"], RUN_TS, "B1")
        return flights.agg(F.lit(landing).alias("landing"), F.count("flight_id").alias("flights"),
                           F.count_distinct("source_zone").alias("zones"))
    return counts("full", full).unionByName(counts("empty", empty)).unionByName(
        counts("missing", f"{full}-missing"))


@query
def coerce_numeric(spark, sf_dir):
    rows = bridge.feed(spark, sf_dir, ("flight_id", "altitude", "on_ground", *TIE_BREAK))
    part = F.col("obs_part")
    raw_altitude = (
        F.when(part % 43 == 0, "N/A").when(part % 47 == 0, "").when(part % 59 == 0, "12e")
        .when(part % 61 == 0, "7d").when(part % 67 == 0, " 1500 ").when(part % 71 == 0, "1.5e3")
        .otherwise(F.col("altitude").cast("string"))
    )
    raw_ground = (
        F.when(part % 43 == 0, "1.0").when(part % 47 == 0, " 1 ").when(part % 59 == 0, "x")
        .otherwise(F.col("on_ground").cast("string"))
    )
    return rows.select(
        *KEY, to_double(raw_altitude).alias("altitude"), to_int(raw_ground).alias("on_ground"),
        to_int(F.col("altitude")).alias("altitude_int"),
    )


@query
def filter_zone(spark, sf_dir):
    rows = bridge.feed(spark, sf_dir)
    return zones.filter_feed(rows, ZONES, "tropics", "AL18", "B738").select(
        *KEY, "latitude", "longitude", "airline_icao", "aircraft_code",
    )


@query
def union_zones(spark, sf_dir):
    rows = bridge.feed(spark, sf_dir, ("flight_id", "latitude", "longitude", "source_zone", *TIE_BREAK))
    return zones.union_zones(rows, ZONES, ["north", "nowhere", "tropics", "southwest"]).select(
        *KEY, "source_zone",
    )


@query
def zones_on_grid(spark, sf_dir):
    """All zones as a table, one of them across the date line."""
    rows = bridge.feed(spark, sf_dir, ("flight_id", "latitude", "longitude", "source_zone", *TIE_BREAK))
    table = zones.zone_table(spark, {**ZONES, "pacific": zones.Box(60.0, -60.0, 150.0, -150.0)})
    return zones.union_zone_table(rows, table).select(*KEY, "source_zone")


@query
def dedup_zones(spark, sf_dir):
    rows = bridge.feed(spark, sf_dir, (
        "flight_id", "extraction_timestamp", "latitude", "longitude", "source_zone", *TIE_BREAK))
    collected = zones.union_zones(rows, ZONES, list(ZONES))
    order = (*TIE_BREAK, "source_zone")
    return zones.dedup_zones(collected, order).select(*KEY, "extraction_timestamp", "source_zone")


@query
def subzones(spark, sf_dir):
    """Zones JSON landed from region and nation, with a box per nation from its suppliers."""
    box = F.struct(
        F.max("s_acctbal").alias("tl_y"), F.min("s_suppkey").cast("double").alias("tl_x"),
        F.min("s_acctbal").alias("br_y"), F.max("s_suppkey").cast("double").alias("br_x"),
    )
    boxes = bridge.table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(box.alias("box"))
    nations = bridge.table(spark, sf_dir, "nation").join(
        bridge.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"),
    )
    # a region holds five nations, so the collected lists are small
    members = (
        nations.join(boxes, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .groupBy("r_name")
        .agg(F.array_sort(F.collect_list(
            F.when(F.col("box").isNotNull(), F.struct("n_nationkey", "n_name", "box")))).alias("m"))
    )
    entries = F.transform("m", lambda x: F.struct(x["n_name"].alias("key"), x["box"].alias("value")))
    info = F.struct(F.lit(90.0).alias("tl_y"), F.map_from_entries(entries).alias("subzones"))
    documents = members.select(F.to_json(F.create_map("r_name", info)).alias("value"), "r_name")
    path = scratch_path(spark, "zones")
    documents.write.partitionBy("r_name").text(path)
    return zones.subzones(refs.read_zones(spark, path))


# --- reference files ---------------------------------------------------------------------

def airports_csv(spark, sf_dir):
    path = bridge.land(bridge.airport_csv_lines(spark, sf_dir), "airports-csv")
    return refs.read_airports_csv(spark, path)


def airport_records(spark, sf_dir):
    path = bridge.land(bridge.airport_record_lines(spark, sf_dir), "airports-json")
    return refs.airports_of_records(refs.read_airport_records(spark, path))


def airline_records(spark, sf_dir):
    return refs.read_airline_records(
        spark, bridge.land(bridge.airline_record_lines(spark, sf_dir), "airlines"))


@query
def read_airports_csv(spark, sf_dir):
    return airports_csv(spark, sf_dir)


@query
def read_airports_records(spark, sf_dir):
    return airport_records(spark, sf_dir)


@query
def dim_airports_bulk(spark, sf_dir):
    return refs.airports_dimension(airports_csv(spark, sf_dir), RUN_TS)


@query
def dim_airlines_bulk(spark, sf_dir):
    return refs.airlines_dimension(airline_records(spark, sf_dir), RUN_TS)


@query
def filter_countries(spark, sf_dir):
    spec = "UNITED_STATES, FRANCE,SOUTH_KOREA,NEVERLAND"
    return refs.filter_countries(airport_records(spark, sf_dir), spec).select(
        "airport_iata", "country_name")


@query
def airports_per_country(spark, sf_dir):
    return profile.airports_per_country(airport_records(spark, sf_dir))


@query
def top_airlines_fleet(spark, sf_dir):
    return profile.top_airlines_by_fleet(airline_records(spark, sf_dir))


@query
def dim_freshness(spark, sf_dir):
    """Freshness of a snapshot just written, seen now-ish and from the far future."""
    path = f"{scratch_path(spark, 'dim')}/dim_airlines/_current"
    write_dimension(refs.airlines_dimension(airline_records(spark, sf_dir), RUN_TS), path)
    snapshot = refs.read_snapshot(spark, path)
    rows = snapshot.agg(F.count("*").alias("airlines"))
    now = refs.snapshot_freshness(snapshot, datetime.now(timezone.utc)).select(
        F.lit("now").alias("seen"), "fresh")
    later = refs.snapshot_freshness(snapshot, datetime(2100, 1, 1, tzinfo=timezone.utc)).select(
        F.lit("later").alias("seen"), "fresh")
    return now.unionByName(later).withColumn("airlines", rows.scalar())


# --- scalar expressions ------------------------------------------------------------------

@query
def normalize_codes(spark, sf_dir):
    return quality.normalize_codes(bridge.feed(spark, sf_dir, (*quality.CODE_COLUMNS, *KEY)))


def _origins(spark, sf_dir):
    key = F.col("s_nationkey")
    lineitem = bridge.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lineitem.join(
        bridge.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left",
    ).select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        bridge.airport_field(key, 1).alias("country_name"),
        F.lower(F.nullif(bridge.airport_field(key, 2), F.lit("None"))).alias("raw_code"),
    )


@query
def country_code(spark, sf_dir):
    return _origins(spark, sf_dir).withColumn(
        "country_code", country_code_of_name(F.col("country_name"))).drop("raw_code")


@query
def continent_code_(spark, sf_dir):
    return _origins(spark, sf_dir).withColumn(
        "continent_code", continent_code(F.col("raw_code"))).drop("country_name")


QUERIES["continent_code"] = QUERIES.pop("continent_code_")


@query
def continent_name_(spark, sf_dir):
    return _origins(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        continent_name(continent_code(F.col("raw_code"))).alias("continent_name"))


QUERIES["continent_name"] = QUERIES.pop("continent_name_")


@query
def manufacturer_(spark, sf_dir):
    return bridge.feed(spark, sf_dir, (*KEY, "aircraft_code")).withColumn(
        "manufacturer", manufacturer(F.col("aircraft_code")))


QUERIES["manufacturer"] = QUERIES.pop("manufacturer_")


@query
def haversine(spark, sf_dir):
    """Distance from each observation's position to the airport it comes from."""
    key = F.col("s_nationkey")
    rows = bridge.table(spark, sf_dir, "lineitem").join(
        bridge.table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    lat = F.when(~((F.col("l_linenumber") == 7) & (F.col("l_partkey") % 5 == 0)),
                 F.when(F.col("l_partkey") % 97 == 0, F.lit(float("nan")))
                 .otherwise((F.col("l_quantity") - 25) * 3.6))
    lon = (F.col("l_suppkey") % 360 - 180).cast("double")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        great_circle_km(lat, lon, bridge.airport_field(key, 4, "double"),
                        bridge.airport_field(key, 5, "double"))
        .alias("distance_km"),
    )


@query
def partition_labels_(spark, sf_dir):
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("l_linenumber") * 3)
    return bridge.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        *(c.alias(n) for n, c in partition_labels(at).items()))


QUERIES["partition_labels"] = QUERIES.pop("partition_labels_")


# --- quality -----------------------------------------------------------------------------

@query
def quality_flags(spark, sf_dir):
    return bridge.flagged(spark, sf_dir, (*FLAG_INPUT, *KEY)).select(*KEY, "data_quality_flags")


@query
def is_valid(spark, sf_dir):
    return bridge.flagged(spark, sf_dir, (*FLAG_INPUT, *KEY)).select(*KEY, "is_valid")


@query
def quality_profile(spark, sf_dir):
    return quality.quality_profile(bridge.flagged(spark, sf_dir, FLAG_INPUT))


@query
def flag_counts(spark, sf_dir):
    return quality.flag_counts(bridge.flagged(spark, sf_dir, FLAG_INPUT))


@query
def quality_report(spark, sf_dir):
    report = reports.quality_report(stored_flags(spark, sf_dir))
    return report.select("total_rows", "valid_rows", F.inline("top_flags"))


@query
def dimension_cardinality(spark, sf_dir):
    return profile.dimension_cardinality(quality.normalize_codes(
        bridge.feed(spark, sf_dir, quality.CODE_COLUMNS)))


@query
def distinct_over_runs(spark, sf_dir):
    """Distinct values per year, merged from one stored sketch per monthly run."""
    lake = new_lake(spark)
    rows = quality.normalize_codes(bridge.feed(spark, sf_dir, ("batch_id", *quality.CODE_COLUMNS)))
    sketches.run_sketches(rows, "batch_id").write.parquet(lake.sketches)
    runs = spark.read.schema(sketches.SKETCHES).parquet(lake.sketches)
    return sketches.merged_counts(runs.withColumn("year", F.substring("batch_id", 2, 4)), "year")


@query
def missing_rates(spark, sf_dir):
    return profile.missing_rates(bridge.feed(spark, sf_dir, (
        "flight_id", "airline_icao", "aircraft_code", "origin_iata", "destination_iata",
        "latitude", "longitude", "altitude", "ground_speed", "on_ground", "heading")))


@query
def feed_shares(spark, sf_dir):
    return profile.feed_shares(bridge.feed(spark, sf_dir, (
        "on_ground", "origin_iata", "destination_iata", "airline_icao", "aircraft_code")))


# --- Silver ------------------------------------------------------------------------------

@query
def dedup_latest(spark, sf_dir):
    rows = bridge.feed(spark, sf_dir, ("flight_id", "extraction_timestamp", "altitude", *TIE_BREAK))
    return latest_per_flight(rows, tie_break=TIE_BREAK)


@query
def enrich_dims(spark, sf_dir):
    """Some facts already carry a country code (possibly empty), which must survive."""
    part = F.col("obs_part")
    facts = bridge.flagged(spark, sf_dir, SILVER_INPUT).withColumn(
        "origin_airport_country_code",
        F.when(part % 11 == 0, "ZZ").when(part % 13 == 0, ""))
    return fill_from_dimensions(
        facts, bridge.airports_dim(spark), bridge.airlines_dim(spark),
    ).select(
        *KEY, "airline_name",
        *(f"{end}_airport_{c}" for end in ("origin", "destination")
          for c in ("country_code", "country_name", "latitude", "longitude")))


@query
def enrich_noop(spark, sf_dir):
    return fill_from_dimensions(bridge.flagged(spark, sf_dir, SILVER_INPUT)).select(
        *KEY, "airline_icao", "airline_name", "origin_airport_country_name")


@query
def silver_fact_(spark, sf_dir):
    facts = silver_fact(
        bridge.bronze(spark, sf_dir, SILVER_INPUT), bridge.airports_dim(spark),
        bridge.airlines_dim(spark), TIE_BREAK)
    return facts.select(
        *KEY, "extraction_timestamp", "batch_id", "airline_icao", "airline_name", "aircraft_code",
        "manufacturer", "origin_iata", "destination_iata", "origin_continent",
        "destination_continent", "origin_airport_country_code", "distance_km", "is_valid",
        "data_quality_flags", *LABEL_COLUMNS)


QUERIES["silver_fact"] = QUERIES.pop("silver_fact_")


# --- dimensions --------------------------------------------------------------------------

@query
def build_dim_airports(spark, sf_dir):
    return dims.airports_of_facts(silver(spark, sf_dir), RUN_TS)


@query
def build_dim_airlines(spark, sf_dir):
    return dims.airlines_of_facts(silver(spark, sf_dir), RUN_TS)


@query
def build_dim_aircraft_models(spark, sf_dir):
    return dims.aircraft_models_of_facts(silver(spark, sf_dir), RUN_TS)


@query
def build_dim_countries_continents(spark, sf_dir):
    return dims.countries_of_facts(silver(spark, sf_dir), RUN_TS)


def _dimension_counts(spark, sf_dir, **supplied):
    facts = stored(silver(spark, sf_dir), "silver")
    return dims.row_counts(dims.choose_dimensions(facts, RUN_TS, **supplied))


@query
def dim_counts(spark, sf_dir):
    return _dimension_counts(spark, sf_dir)


@query
def dims_fallback(spark, sf_dir):
    """Airlines supplied in bulk, airports derived from the fact."""
    bulk = refs.airlines_dimension(airline_records(spark, sf_dir), RUN_TS)
    return _dimension_counts(spark, sf_dir, airlines=bulk)


@query
def rollup_dimensions(spark, sf_dir):
    """Airports from the roll-up that the KPIs share, instead of from the fact."""
    rolled = rollup.RolledUp(stored(silver(spark, sf_dir), "silver"), scratch_path(spark, "rollup"))
    return rollup.dimensions_of_rollup(rolled, RUN_TS)["dim_airports"]


# --- KPIs --------------------------------------------------------------------------------

def _register_kpi(name: str) -> None:
    def kpi(spark, sf_dir):
        return kpis.KPIS[name](silver(spark, sf_dir), RUN_TS)
    kpi.__name__ = name
    query(kpi)


for _name in kpis.KPIS:
    _register_kpi(_name)

# KPI -> (its key columns, its measure)
KPI_SUMMARY = {
    "kpi_airline_volumes": (("airline_icao", "airline_name"), "active_flights_count"),
    "kpi_continental_regional": (
        ("origin_continent", "airline_icao", "airline_name"), "regional_flights_count"),
    "kpi_longest_flight": (("callsign", "origin_iata", "destination_iata"), "distance_km"),
    "kpi_continental_avg_distance": (("origin_continent",), "avg_distance_km"),
    "kpi_aircraft_manufacturers": (("manufacturer",), "active_flights_count"),
    "kpi_airline_aircraft_top3": (("origin_airport_country_code", "aircraft_code"), "usage_count"),
    "kpi_airport_imbalance": (("airport_iata",), "imbalance"),
}


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """All KPI tables as ``(kpi, label, measure)``."""
    parts = [
        table.select(
            F.lit(name).alias("kpi"), F.concat_ws("/", *KPI_SUMMARY[name][0]).alias("label"),
            F.col(KPI_SUMMARY[name][1]).cast("double").alias("measure"))
        for name, table in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def monthly_bronze(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose Bronze history holds every observation, one hour per month."""
    lake = new_lake(spark)
    write_bronze(bridge.bronze(spark, sf_dir).drop(*TIE_BREAK), lake, many_hours=True)
    return lake


@query
def gold_all(spark, sf_dir):
    """Replay of a whole Bronze history through Silver to Gold, read back from the lake."""
    lake = monthly_bronze(spark, sf_dir)
    loaded = replay(spark, lake, RUN_TS, bridge.airports_dim(spark), bridge.airlines_dim(spark))
    return summary(loaded.gold)


@query
def batch_run(spark, sf_dir):
    """One whole batch run over every observation; its KPIs read back from the lake."""
    lake = new_lake(spark)
    observations = bridge.feed(spark, sf_dir).drop(*TIE_BREAK)
    run_batch(observations, lake, RUN_TS, "B1", bridge.airports_dim(spark),
              bridge.airlines_dim(spark))
    return summary({name: spark.read.parquet(lake.gold(name)) for name in kpis.KPIS})


@query
def batch_retry(spark, sf_dir):
    """The same batch run twice, as after a failure behind Bronze: rows stay as they were."""
    lake = new_lake(spark)
    observations = bridge.feed(spark, sf_dir).drop(*TIE_BREAK)
    for _ in range(2):
        run_batch(observations, lake, RUN_TS, "B1", settings=RunSettings(load_silver_gold=False))
    bronze = read_bronze(spark, lake).agg(F.count("*").alias("bronze_rows"))
    runs = run_sources.read_run_metrics(spark, lake.run_metrics)
    return runs.select(F.col("extraction.rows").alias("extracted_rows")).crossJoin(F.broadcast(bronze))


@query
def batch_lost_append(spark, sf_dir):
    """A batch whose first append was lost before its commit, with its airborne flights written."""
    lake = new_lake(spark)
    observations = bridge.feed(spark, sf_dir).drop(*TIE_BREAK)
    flagged = quality.flag_quality(observations.withColumn("batch_id", F.lit("B1")))
    label_hours(flagged.where("on_ground = 0"), RUN_TS).withColumn(ATTEMPT, F.lit("lost")).write.partitionBy(
        *LABEL_COLUMNS, ATTEMPT).parquet(lake.bronze)
    run_batch(observations, lake, RUN_TS, "B1", settings=RunSettings(load_silver_gold=False))
    return read_bronze(spark, lake).groupBy("batch_id", *LABEL_COLUMNS).agg(
        F.count("*").alias("bronze_rows"), F.count_if(F.col("on_ground") == 0).alias("airborne"))


@query
def quality_report_json(spark, sf_dir):
    """The quality report as its JSON file has it."""
    lake = new_lake(spark)
    report = reports.quality_report(stored_flags(spark, sf_dir))
    reports.write_quality_report(report, lake, RUN_TS)
    return spark.read.schema(report.schema).json(lake.quality_report(RUN_TS)).select(
        "total_rows", "valid_rows", "on_ground", "on_flight", "pct_valid", F.inline("top_flags"))


@query
def kpi_row_counts(spark, sf_dir):
    facts = stored(silver(spark, sf_dir), "silver")
    return dims.row_counts(gold_tables(facts, RUN_TS))


@query
def top3_for_country(spark, sf_dir):
    lake = new_lake(spark)
    write_gold(kpis.airline_aircraft_top3(silver(spark, sf_dir), RUN_TS), lake,
               "kpi_airline_aircraft_top3", RUN_TS)
    return kpis.top3_for_country(read_latest(spark, lake, "kpi_airline_aircraft_top3")).drop("tech_hour")


@query
def latest_snapshot(spark, sf_dir):
    """Two snapshots of a Gold table, the earlier one over half of the history."""
    lake, name = new_lake(spark), "kpi_continental_avg_distance"
    facts = stored(silver(spark, sf_dir), "silver")
    earlier = RUN_TS - timedelta(hours=2)
    old = facts.where(F.col("extraction_timestamp") < "1998-07-01")
    write_gold(kpis.continental_avg_distance(old, earlier), lake, name, earlier)
    write_gold(kpis.continental_avg_distance(facts, RUN_TS), lake, name, RUN_TS)
    return read_latest(spark, lake, name)


# --- lake --------------------------------------------------------------------------------

BRONZE_COLUMNS = (
    "flight_id", "extraction_timestamp", "batch_id", "airline_icao", "altitude",
    "data_quality_flags", "is_valid", *LABEL_COLUMNS,
)


@query
def bronze_roundtrip(spark, sf_dir):
    return read_bronze(spark, monthly_bronze(spark, sf_dir)).select(*BRONZE_COLUMNS)


@query
def prune_partition(spark, sf_dir):
    return read_bronze(spark, monthly_bronze(spark, sf_dir), day="1997-05-01").select(*BRONZE_COLUMNS)


@query
def replay_bronze(spark, sf_dir):
    """Two batches with the same flights: the later, at 100 ft more, wins everywhere."""
    lake = new_lake(spark)
    write_bronze(bridge.bronze(spark, sf_dir).drop(*TIE_BREAK), lake, many_hours=True)
    first = read_bronze(spark, lake)
    write_bronze(first.withColumns({
        "extraction_timestamp": F.col("extraction_timestamp") + F.expr("INTERVAL 10 YEARS"),
        "altitude": F.col("altitude") + 100,
        "batch_id": F.lit("B2"),
    }), lake, many_hours=True, gathered=True)
    facts = silver_fact(read_bronze(spark, lake), bridge.airports_dim(spark),
                        bridge.airlines_dim(spark), stored=True)
    return facts.select("flight_id", "extraction_timestamp", "batch_id", "altitude", "is_valid")


@query
def merge_bronze(spark, sf_dir):
    """The history before 1996 and the observations since, merged by flight; the latter twice."""
    lake = new_lake(spark)
    rows = bridge.bronze(spark, sf_dir).drop(*TIE_BREAK)
    since = F.col("extraction_timestamp") >= "1996-01-01"
    for part in (~since, since, since):
        merge_batch(spark, lake, rows.where(part))
    facts = current_fact(spark, lake, bridge.airports_dim(spark), bridge.airlines_dim(spark))
    return facts.select("flight_id", "extraction_timestamp", "batch_id", "altitude", "is_valid")


@query
def silver_overwrite(spark, sf_dir):
    """Rewriting some hours of the fact leaves all others as they were."""
    lake = new_lake(spark)
    columns = ("flight_id", "batch_id", "airline_icao", *LABEL_COLUMNS)
    facts = labelled_silver(spark, sf_dir).select(*columns)
    write_fact(facts, lake, many_hours=True)
    reworked = facts.where(F.col("tech_year") >= "1999").withColumn("airline_icao", F.lit("REDONE"))
    write_fact(reworked, lake, many_hours=True)
    return spark.read.schema(facts.schema).parquet(lake.fact)


@query
def dim_snapshot(spark, sf_dir):
    """A dimension snapshot is replaced as a whole; airports that only the first one had are gone."""
    path = new_lake(spark).dimension("dim_airports")
    facts = stored(silver(spark, sf_dir), "silver")
    whole = dims.airports_of_facts(facts, RUN_TS)
    write_dimension(whole.withColumn("airport_iata", F.concat(F.lit("old "), "airport_iata")), path)
    write_dimension(whole, path)
    return refs.read_snapshot(spark, path).select("airport_iata", "country_code", "continent_code")


@query
def gold_idempotent(spark, sf_dir):
    """Two runs within one hour leave one snapshot: that of the second, over all flights."""
    lake, name = new_lake(spark), "kpi_airline_aircraft_top3"
    facts = stored(silver(spark, sf_dir), "silver")
    write_gold(kpis.airline_aircraft_top3(facts.where("airline_icao < 'AL2'"), RUN_TS), lake, name, RUN_TS)
    write_gold(kpis.airline_aircraft_top3(facts, RUN_TS), lake, name, RUN_TS + timedelta(minutes=10))
    return spark.read.parquet(lake.gold(name))


# --- runs --------------------------------------------------------------------------------

def stored_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reports need of the flagged observations, written once for their several passes."""
    return stored(bridge.flagged(spark, sf_dir, FLAG_INPUT).select(
        "batch_id", *quality.CODE_COLUMNS, "on_ground", "is_valid", "data_quality_flags"), "flags")


def run_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each monthly run reports about itself.

    A run takes 1/28 s per unit of its mean price. Every line number it sold at quantity 1 with
    the highest discount and tax counts as an error, so a run has at most seven.
    """
    rows = stored_flags(spark, sf_dir)
    counts = quality.quality_profile(rows, "batch_id")
    distinct = profile.dimension_cardinality(rows, "batch_id")
    source = bridge.table(spark, sf_dir, "lineitem")
    bad = (F.col("l_quantity") == 1) & (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08)
    started = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
    clock = (
        source.groupBy(F.date_format("l_shipdate", "'B'yyyyMM").alias("batch_id"),
                       started.alias("started"))
        .agg(F.floor(F.avg("l_extendedprice") / 28).cast("int").alias("seconds"),
             F.coalesce(F.bit_count(F.bit_or(F.when(bad, F.expr("shiftleft(1, l_linenumber)")))),
                        F.lit(0)).alias("errors_seen"))
    )
    error = F.struct(
        F.lit("silver_gold_error").alias("type"), F.lit("boom").alias("message"),
        F.lit("silver_gold").alias("phase"), F.lit(None).cast("string").alias("timestamp"))
    warning = F.struct(
        F.lit("low_quality").alias("type"), F.lit("low").alias("message"),
        F.lit(None).cast("string").alias("timestamp"))
    return (
        counts.join(distinct, "batch_id").join(clock, "batch_id")
        .withColumns({
            "extraction_rows": F.col("total_rows"),
            "ended": F.timestamp_add("SECOND", F.col("seconds"), F.col("started")),
            "errors": F.array_repeat(error, F.col("errors_seen")),
            "warnings": F.array_repeat(warning, F.col("low_quality").cast("int")),
            "kpi_rows": F.create_map(F.lit("airline_volumes"), F.lit(1).cast("long"),
                                     F.lit("kpi_airline_aircraft_top3"), F.col("unique_airports"),
                                     F.lit("no_such_kpi"), F.lit(9).cast("long")),
            "kpis_computed": F.lit(7),
        })
    )


def landed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run documents written as one JSON file per run and read back."""
    lake = new_lake(spark)
    reports.write_run_metrics(run_plans.run_documents(run_measures(spark, sf_dir)), lake)
    return run_sources.read_run_metrics(spark, lake.run_metrics)


@query
def run_metrics(spark, sf_dir):
    runs = run_plans.run_documents(run_measures(spark, sf_dir))
    return runs.select(
        "batch_id", "start_time", "end_time", "status", "num_errors", "num_warnings",
        "total_duration_seconds", F.col("extraction.rows").alias("rows"), "validation.valid_rows",
        "validation.invalid_rows", "validation.pct_valid", "analysis.on_ground_count",
        "analysis.in_flight_count", "analysis.pct_in_flight",
        F.col("dimensions.dim_airlines.unique_count").alias("airlines"),
        F.col("dimensions.dim_airports.unique_count").alias("airports"),
        F.col("dimensions.dim_aircraft_models.unique_count").alias("aircraft"),
        F.col("gold.kpis_computed").alias("kpis_computed"),
        F.col("gold.kpi_airline_volumes.rows").alias("volume_rows"),
        F.col("gold.kpi_airline_aircraft_top3.rows").alias("top3_rows"),
        F.col("gold.kpi_longest_flight.rows").alias("longest_rows"),
    )


@query
def run_history(spark, sf_dir):
    return run_plans.run_history(landed_runs(spark, sf_dir))


@query
def run_index(spark, sf_dir):
    """The history of runs by an index that was refreshed before half of them came, and after."""
    lake = new_lake(spark)
    runs = stored(run_plans.run_documents(run_measures(spark, sf_dir)), "runs")
    early = F.col("batch_id") < "B199601"
    for part in (early, ~early):
        reports.write_run_metrics(runs.where(part), lake)
        history = run_sources.refresh_run_index(spark, lake.run_metrics, lake.run_index)
    return run_plans.run_history(history)


@query
def run_trends(spark, sf_dir):
    return run_plans.run_trends(landed_runs(spark, sf_dir))


@query
def run_alerts(spark, sf_dir):
    """Alerts of all runs, and of one that extracted nothing."""
    measures = run_measures(spark, sf_dir)
    empty = measures.agg(F.min("started").alias("started")).select(
        F.lit("B0").alias("batch_id"), "started", F.col("started").alias("ended"))
    runs = run_plans.run_documents(measures).unionByName(run_plans.run_documents(empty))
    return run_plans.run_alerts(runs)


@query
def alert_documents(spark, sf_dir):
    """Alert documents written as JSON, one per run that has alerts, and read back."""
    lake = new_lake(spark)
    runs = run_plans.run_documents(run_measures(spark, sf_dir))
    reports.write_alerts(stored(run_plans.alert_documents(runs), "alerts"), lake)
    return spark.read.schema(run_plans.alert_documents(runs).schema).json(lake.alerts).select(
        "batch_id", "timestamp", "alert_count",
        F.array_join(F.transform("alerts", lambda a: a["type"]), ",").alias("types"))


@query
def history_csv(spark, sf_dir):
    """The run history exported as CSV and read back as text."""
    path = scratch_path(spark, "history")
    reports.export_history_csv(run_plans.run_history(landed_runs(spark, sf_dir)), path)
    return spark.read.option("header", True).csv(path).select(
        "batch_id", "status", "flights", "num_errors", "num_warnings", "end_time")


@query
def latest_outcome(spark, sf_dir):
    return run_plans.latest_outcome(run_plans.run_documents(run_measures(spark, sf_dir)))


@query
def run_log_status(spark, sf_dir):
    """Job logs landed per run: how far each got depends on its data."""
    runs = run_measures(spark, sf_dir)
    rows, errors = F.col("total_rows"), F.size("errors")
    stamp = F.date_format("started", "yyyy-MM-dd HH:mm:ss,SSS")
    phases = F.when(errors > 0, 5).when(rows % 7 == 0, 3).otherwise(6)
    lines = F.transform(
        F.sequence(F.lit(1), phases),
        lambda n: F.concat(stamp, F.lit(" INFO Phase "), n.cast("string"), F.lit(" : ...")))
    end = F.when(errors > 0, run_sources.LOG_FAILED).when(rows % 7 == 0, "...") \
        .otherwise(run_sources.LOG_SUCCEEDED)
    log = F.concat(F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n"), stamp, F.lit(" INFO "), end)
    path = scratch_path(spark, "logs")
    runs.select(log.alias("value"), "batch_id").write.partitionBy("batch_id").text(path)
    status = run_sources.job_log_status(
        run_sources.read_job_logs(spark, path, "*.txt"), datetime(2100, 1, 1, tzinfo=timezone.utc))
    return status.select(
        F.regexp_extract("file", "batch_id=([^/]+)/", 1).alias("batch_id"), "state", "reached",
        "phase", "finished", "success", "empty", "started")
