"""Declared schemas: the Bronze contract, landed files and run documents."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, INT, LONG, TS = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType(),
)

LABEL_COLUMNS = ("tech_year", "tech_month", "tech_day", "tech_hour")


def _struct(*groups: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([
        T.StructField(name, dtype, nullable)
        for names, dtype, nullable in groups for name in names.split()
    ])


# One row per flight observation and run: 33 columns.
FLIGHTS_RAW = _struct(
    ("extraction_timestamp", TS, False),
    ("batch_id", STRING, False),
    ("source_zone", STRING, True),
    ("flight_id", STRING, False),
    ("callsign flight_number airline_icao airline_iata aircraft_code registration "
     "origin_iata destination_iata", STRING, True),
    ("latitude longitude altitude ground_speed heading", DOUBLE, True),
    ("on_ground", INT, True),
    ("vertical_speed", DOUBLE, True),
    ("icao_24bit aircraft_model airline_name", STRING, True),
    ("origin_airport_name origin_airport_country_code origin_airport_country_name", STRING, True),
    ("origin_airport_latitude origin_airport_longitude", DOUBLE, True),
    ("destination_airport_name destination_airport_country_code "
     "destination_airport_country_name", STRING, True),
    ("destination_airport_latitude destination_airport_longitude", DOUBLE, True),
    ("status_text", STRING, True),
)

# Bronze as stored: the contract, the quality verdict and the partition labels.
BRONZE = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in FLIGHTS_RAW]
    + list(_struct(
        ("data_quality_flags", STRING, True),
        ("is_valid", T.BooleanType(), True),
        (" ".join(LABEL_COLUMNS), STRING, True),
    ))
)

# A commit of Bronze: which folders (below which hours, "yyyy/yyyy-MM/yyyy-MM-dd/HH") hold a batch.
ATTEMPT = "attempt"
MANY_DAYS = "many"
COMMIT = "batch string, attempt string, row_count long, hours array<string>, committed_micros long"

# Feed spelling -> Bronze spelling; every other feed field keeps its name.
FEED_RENAMES = {
    "id": "flight_id",
    "number": "flight_number",
    "origin_airport_iata": "origin_iata",
    "destination_airport_iata": "destination_iata",
}

# Fields the ingest stamps itself rather than reading them from the feed.
STAMPED = ("extraction_timestamp", "batch_id", "source_zone")

CORRUPT = "_corrupt_record"

_FEED_NAME = {bronze: feed for feed, bronze in FEED_RENAMES.items()}

# The landed feed is read as text, whole numbers as they stand (text, number or boolean);
# conversion is a separate, tolerant step.
FLIGHT_FEED = T.StructType(
    [T.StructField(_FEED_NAME.get(f.name, f.name), T.VariantType() if f.dataType == INT else STRING, True)
     for f in FLIGHTS_RAW if f.name not in STAMPED]
    + [T.StructField(CORRUPT, STRING, True)]
)

# OpenFlights airports file: 14 columns without a header.
AIRPORTS_CSV = _struct(
    ("id name city country iata icao latitude longitude altitude tz dst tzdb type source",
     STRING, True),
    (CORRUPT, STRING, True),
)

AIRPORT_RECORDS = _struct(("iata icao name country latitude longitude", STRING, True))

AIRLINE_RECORDS = _struct(("Name ICAO IATA", STRING, True), ("n_aircrafts", LONG, True))

ZONE_BOX = _struct(("tl_y tl_x br_y br_x", DOUBLE, True))

# {"zone": {box..., "subzones": {"name": {box...}}}}
ZONES = T.MapType(STRING, T.StructType(
    list(ZONE_BOX) + [T.StructField("subzones", T.MapType(STRING, ZONE_BOX), True)]
))

DIMENSION_NAMES = ("dim_airlines", "dim_airports", "dim_aircraft_models", "dim_countries_continents")

KPI_NAMES = (
    "kpi_airline_volumes", "kpi_continental_regional", "kpi_longest_flight",
    "kpi_continental_avg_distance", "kpi_aircraft_manufacturers",
    "kpi_airline_aircraft_top3", "kpi_airport_imbalance",
)


def _counted(names: tuple[str, ...], field: str, *first: T.StructField) -> T.StructType:
    inner = T.StructType([T.StructField(field, LONG, True)])
    return T.StructType([*first, *(T.StructField(n, inner, True) for n in names)])


# One nested document per run.
RUN_METRICS = T.StructType([
    T.StructField("batch_id", STRING, True),
    T.StructField("start_time", STRING, True),
    T.StructField("extraction", _struct(("rows", LONG, True), ("duration_seconds", DOUBLE, True),
                                        ("rejected_rows", LONG, True))),
    T.StructField("validation", _struct(("valid_rows invalid_rows", LONG, True),
                                        ("pct_valid", DOUBLE, True))),
    T.StructField("analysis", _struct(("on_ground_count in_flight_count", LONG, True),
                                      ("pct_in_flight", DOUBLE, True))),
    T.StructField("dimensions", _counted(DIMENSION_NAMES, "unique_count")),
    T.StructField("gold", _counted(
        KPI_NAMES, "rows",
        T.StructField("kpis_computed", LONG, True), T.StructField("duration_seconds", DOUBLE, True),
    )),
    T.StructField("errors", T.ArrayType(_struct(("type message phase timestamp", STRING, True)))),
    T.StructField("warnings", T.ArrayType(_struct(("type message timestamp", STRING, True)))),
    T.StructField("end_time", STRING, True),
    T.StructField("total_duration_seconds", DOUBLE, True),
    T.StructField("status", STRING, True),
    T.StructField("num_errors", LONG, True),
    T.StructField("num_warnings", LONG, True),
])
