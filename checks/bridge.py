"""The driver's tables read as a flight feed.

One ``lineitem`` row is one observation. Attributes come from left joins on unique keys, so
the set of observations does not depend on which columns a query asks for, and only the joins
behind the requested columns are made.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skytally.functions import continent_code, country_code_of_name
from skytally.operators.enrich import BROADCAST_LIMIT_BYTES, broadcast_if_small, planned_bytes
from skytally.operators.pick import latest_per_flight
from skytally.operators.quality import flag_quality
from skytally.operators.zones import Box
from skytally.schema import FLIGHTS_RAW
from skytally.session import scratch_path
from skytally.sinks.lake import label_hours

RUN_TS = datetime(2026, 6, 21, 14, 30, tzinfo=timezone.utc)

# nation key -> IATA, country name, ISO code, continent, latitude, longitude
AIRPORTS = [
    ("JNB", "South Africa", "ZA", "AF", -26.14, 28.25),
    ("JFK", "united-states", "US", "NA", 40.64, -73.78),
    ("HND", "Japan", "JP", "AS", 35.55, 139.78),
    ("CDG", "France", "FR", "EU", 49.01, 2.55),
    ("DXB", "United Arab Emirates", "AE", "AS", 25.25, 55.36),
    ("CAI", "Egypt", "EG", "AF", 30.12, 31.41),
    ("GRU", "Brazil", "BR", "SA", -23.43, -46.47),
    ("SIN", "Singapore", "SG", "AS", 1.35, 103.99),
    ("LHR", "United Kingdom", "GB", "EU", 51.47, -0.45),
    ("IST", "Turkey", "TR", "AS", 41.26, 28.74),
    ("NBO", "Kenya", "KE", "AF", -1.32, 36.93),
    ("LAX", "United States", "US", "NA", 33.94, -118.41),
    ("ICN", "South Korea", "KR", "AS", 37.47, 126.45),
    ("FRA", "Germany", "DE", "EU", 50.03, 8.57),
    ("DOH", "Qatar", "QA", "AS", 25.27, 51.61),
    ("CMN", "Morocco", "MA", "AF", 33.37, -7.59),
    ("EZE", "Argentina", "AR", "SA", -34.82, -58.54),
    ("DEL", "India", "IN", "AS", 28.57, 77.1),
    ("MAD", "Spain", "ES", "EU", 40.47, -3.56),
    ("THR", "Iran", "IR", "AS", 35.69, 51.31),
    ("ADD", "Ethiopia", "ET", "AF", 8.98, 38.8),
    ("YYZ", "Canada", "CA", "NA", 43.68, -79.63),
    ("SYD", "Australia", "AU", "OC", -33.95, 151.18),
    ("AMS", "Netherlands", "NL", "EU", 52.31, 4.76),
    ("XXA", "Atlantis", None, "UNKNOWN", 0.0, -30.0),
]

# brand number - 1 -> raw aircraft code; a number beyond the list has none
AIRCRAFT = [
    "A320", "B738", "BCS3", "CRJ9", "CL60", "DH8D", "AT76", "E190", "E290", "EMB1", "MD11",
    "F100", "SU95", "AN26", "IL96", "TU54", "C172", " a20n", "b789 ", "A359", "B77W", "A321",
    "B38M", "",
]

AIRLINES = 40
UNNAMED_AIRLINE = 13  # has no row in the airlines dimension

ZONES = {
    "north": Box(90.0, 20.0, -180.0, 180.0),
    "tropics": Box(25.0, -25.0, -180.0, 180.0),
    "southwest": Box(0.0, -90.0, -180.0, 10.0),
}

# Bronze columns the tables can fill; the others are NULL in the feed
FILLED = (
    "extraction_timestamp", "batch_id", "source_zone", "flight_id", "callsign", "airline_icao",
    "aircraft_code", "origin_iata", "destination_iata", "latitude", "longitude", "altitude",
    "ground_speed", "on_ground",
)

# order of observations with equal timestamps, all descending
TIE_BREAK = ("obs_line", "obs_part", "obs_supplier")


@cache
def table_schema(sf_dir: str, name: str) -> StructType:
    """Schema of a table; reading it costs a job, so it is done once."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{name}.parquet").schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(table_schema(sf_dir, name)).parquet(f"{sf_dir}/{name}.parquet")


def text(value: str, column: Column) -> Column:
    return F.concat(F.lit(value), column.cast("string"))


def constants(values: Iterable, dtype: str = "string") -> Column:
    """A constant array, handed over as one text."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{dtype}>")


def airport_field(nation_key: Column, position: int, dtype: str = "string") -> Column:
    return F.get(constants((a[position] for a in AIRPORTS), dtype), nation_key)


def _feed_columns() -> dict[str, tuple[str, Column]]:
    """Column -> (the joins it needs, its expression)."""
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    qty = F.col("l_quantity")
    flight = text("F", F.col("l_orderkey"))
    brand = F.substring("p_brand", 7, 10).cast("int")
    return {
        "extraction_timestamp": ("", F.col("l_shipdate").cast("timestamp")),
        "batch_id": ("", F.date_format("l_shipdate", "'B'yyyyMM")),
        "source_zone": ("supplier region", F.lower("r_name")),
        "flight_id": ("", flight),
        "callsign": ("", F.concat(F.lit("C"), flight)),
        "airline_icao": ("", F.when(supp % 23 == 0, "  ")
                         .when(supp % 7 == 0, text(" al", supp % AIRLINES))
                         .otherwise(text("AL", supp % AIRLINES))),
        "aircraft_code": ("part", F.get(constants(AIRCRAFT), brand - 1)),
        "origin_iata": ("supplier", F.when(part % 31 != 0, airport_field(F.col("s_nationkey"), 0))),
        "destination_iata": ("orders", F.when(part % 37 == 0, "")
                             .otherwise(airport_field(F.col("c_nationkey"), 0))),
        "latitude": ("", F.when(~((line == 7) & (part % 5 == 0)), (qty - 25) * 3.7)),
        "longitude": ("", (supp % 360 - 180).cast("double")),
        "altitude": ("", F.when(part % 41 == 0, -100.0).otherwise(F.col("l_extendedprice") / 2)),
        "ground_speed": ("", qty * 12.1),
        "on_ground": ("", F.when(part % 53 == 0, None)
                      .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), 1)
                      .otherwise(0)),
        "obs_line": ("", line),
        "obs_part": ("", part),
        "obs_supplier": ("", supp),
    }


def feed(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, latest: bool = False,
) -> DataFrame:
    """Observations with the requested columns; by default all of Bronze and the tie-breakers.

    ``latest`` keeps the last observation of each flight, before any attribute is joined: the
    joins then see a fraction of the rows, and the one with the orders is already co-located.

    Attribute tables are broadcast up to a checked size, so that their joins do not shuffle every
    observation once more. Parts beyond that size are joined first: what the join with the orders
    yields then stays in the order of the flights, by which Bronze files are sorted.
    """
    known = _feed_columns()
    types = {f.name: f.dataType for f in FLIGHTS_RAW}
    wanted = list(columns or [*types, *TIE_BREAK])
    joins = {j for c in wanted if c in known for j in known[c][0].split()}
    rows = table(spark, sf_dir, "lineitem")
    if latest:
        rows = latest_per_flight(
            rows, "l_orderkey", "l_shipdate", ("l_linenumber", "l_partkey", "l_suppkey"))
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand") if "part" in joins else None

    def with_brands(rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(brands), F.col("l_partkey") == F.col("p_partkey"), "left")

    early = brands is not None and not latest and planned_bytes(brands) > BROADCAST_LIMIT_BYTES
    if early:
        rows = with_brands(rows)
    if "orders" in joins:
        # customers join the orders first: an order has several observations
        customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        routes = table(spark, sf_dir, "orders").join(
            broadcast_if_small(customers), F.col("o_custkey") == F.col("c_custkey"), "left",
        ).select("o_orderkey", "c_nationkey")
        rows = rows.join(routes, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if brands is not None and not early:
        rows = with_brands(rows)
    if "supplier" in joins:
        homes = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(broadcast_if_small(homes), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "region" in joins:
        regions = table(spark, sf_dir, "nation").join(
            table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"),
        ).select("n_nationkey", "r_name")
        rows = rows.join(regions, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(*(
        (known[c][1] if c in known else F.lit(None)).cast(types[c]).alias(c) if c in types
        else known[c][1].alias(c)
        for c in wanted
    ))


def flagged(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    return flag_quality(feed(spark, sf_dir, columns))


def bronze(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Flagged observations labelled by month: each month is one run's hour."""
    return label_hours(
        flagged(spark, sf_dir, columns), F.date_trunc("month", F.col("extraction_timestamp")),
    )


def airports_dim(spark: SparkSession) -> DataFrame:
    """The airports dimension as an inline table, whose size Catalyst knows."""
    rows = ", ".join(
        f"('{iata}', '{country}', {lat}D, {lon}D)" for iata, country, _, _, lat, lon in AIRPORTS
    )
    return (
        spark.sql(f"SELECT * FROM VALUES {rows} AS t(airport_iata, country_name, latitude, longitude)")
        .withColumn("country_code", country_code_of_name(F.col("country_name")))
        .withColumn("continent_code", continent_code(F.col("country_code")))
    )


def airlines_dim(spark: SparkSession) -> DataFrame:
    number = F.col("id")
    return spark.range(AIRLINES).where(number != UNNAMED_AIRLINE).select(
        text("AL", number).alias("airline_icao"), text("Airline ", number).alias("airline_name"),
    )


def land(lines: DataFrame, purpose: str) -> str:
    """Write text lines to the shared scratch folder and return their path."""
    path = scratch_path(lines.sparkSession, purpose)
    lines.write.text(path)
    return path


# records of a landed feed file: a compressed file is read by one task
FEED_FILE_RECORDS = 100_000


def land_feed(spark: SparkSession, sf_dir: str) -> str:
    """Land the feed as gzip files and return their path.

    As plain text its records take seven times the room, more than anything else the ingest writes.
    Several files per task keep the parsing spread over tasks, also where one task lands most records.
    """
    path = scratch_path(spark, "feed")
    (landed_feed_lines(spark, sf_dir).write.option("maxRecordsPerFile", FEED_FILE_RECORDS)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))
    return path


# by part key modulo 11; beyond the list stands the observation's own value
ON_GROUND_SPELLINGS = ("0", "0.0", "1.0", "1.7", "true", '"1"', '"1.0"', '"x"', '"N/A"', "null")


def landed_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records as JSON lines with the flaws the ingest must survive.

    Some altitudes are ``'N/A'``, empty or no number, some records have no id, some lines are
    cut off. ``on_ground`` comes as number, boolean, text or nothing.
    """
    part = F.col("obs_part")
    rows = feed(spark, sf_dir, (
        "flight_id", "callsign", "airline_icao", "aircraft_code", "origin_iata",
        "destination_iata", "latitude", "longitude", "altitude", "ground_speed", "on_ground",
        "obs_part", "obs_line",
    ))
    altitude = (
        F.when(part % 43 == 0, "N/A").when(part % 47 == 0, "").when(part % 59 == 0, "12e")
        .otherwise(F.col("altitude").cast("string"))
    )
    record = F.struct(
        F.when(part % 83 != 0, F.col("flight_id")).alias("id"),
        "callsign",
        text("N", F.col("obs_line")).alias("number"),
        "airline_icao", "aircraft_code",
        F.col("origin_iata").alias("origin_airport_iata"),
        F.col("destination_iata").alias("destination_airport_iata"),
        "latitude", "longitude", altitude.alias("altitude"), "ground_speed",
    )
    spellings = F.array(*(F.lit(x) for x in ON_GROUND_SPELLINGS))
    on_ground = F.coalesce(
        F.get(spellings, (part % 11).cast("int")), F.col("on_ground").cast("string"), F.lit("null"))
    fields = F.to_json(record)
    line = F.concat(F.substring(fields, F.lit(1), F.length(fields) - 1), F.lit(',"on_ground":'),
                    on_ground, F.lit("}"))
    return rows.select(
        F.when(part % 89 == 0, F.substring(line, F.lit(1), F.length(line) - 6)).otherwise(line)
        .alias("value")
    )


def airport_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An airports file with one record per customer: quotes, line breaks, padding, ``\\N``, short lines."""
    key = F.col("c_custkey")
    letters = [F.char(F.lit(65) + (F.floor(key / d) % 26).cast("int")) for d in (676, 26, 1)]
    iata = (
        F.when(key % 19 == 0, r"\N").when(key % 23 == 0, "ZZ")
        .when(key % 41 == 0, F.concat(F.lit(" "), *letters, F.lit(" ")))
        .otherwise(F.concat(*letters))
    )
    fields = [
        key.cast("string"),
        F.concat(F.lit('"Field ""'), key.cast("string"), F.lit('"", main'),
                 F.when(key % 43 == 0, "\nhall").otherwise(""), F.lit('"')),
        F.col("c_mktsegment"),
        F.concat(F.lit('"'), airport_field(F.col("c_nationkey"), 1), F.lit('"')),
        iata,
        F.when(key % 7 == 0, r"\N").otherwise(text("K", key)),
    ]
    head = F.concat_ws(",", *fields)
    lat = F.when(key % 29 == 0, r"\N").otherwise((F.col("c_acctbal") / 125).cast("string"))
    lon = (F.col("c_acctbal") / 62.5).cast("string")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 31 == 0, F.concat_ws(",", head, lat))
        .when(key % 37 == 0, F.concat_ws(",", head, lat, lon))
        .otherwise(F.concat_ws(
            ",", head, lat, lon, F.lit('10,1,"E","Zone/City","airport","file"')))
        .alias("value")
    )


def airport_record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    record = F.struct(
        F.when(key % 7 == 0, None).when(key % 11 == 0, "").otherwise(text("S", key)).alias("iata"),
        text("K", key).alias("icao"),
        F.col("s_name").alias("name"),
        airport_field(F.col("s_nationkey"), 1).alias("country"),
        F.when(key % 13 == 0, "").otherwise((F.col("s_acctbal") / 125).cast("string"))
        .alias("latitude"),
        (F.col("s_acctbal") / 62.5).alias("longitude"),
    )
    return table(spark, sf_dir, "supplier").select(F.to_json(record).alias("value"))


def airline_record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline records, several per ICAO code, one per supplier."""
    key = F.col("s_suppkey")
    number = key % AIRLINES
    record = F.struct(
        F.concat(text("Airline ", number), F.when(F.floor(key / AIRLINES) % 2 == 1, " bis")
                 .otherwise("")).alias("Name"),
        F.when(key % 17 == 0, None).when(key % 19 == 0, "").otherwise(text("AL", number))
        .alias("ICAO"),
        F.when(number % 3 != 0, text("I", number)).alias("IATA"),
        (key * 7 % 1000).alias("n_aircrafts"),
    )
    return table(spark, sf_dir, "supplier").select(F.to_json(record).alias("value"))
