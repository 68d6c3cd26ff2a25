"""The SQL each query must agree with, over the same tables."""

from __future__ import annotations

from checks import bridge
from checks.bridge import AIRCRAFT, AIRLINES, AIRPORTS, UNNAMED_AIRLINE, ZONES
from skytally.schema import DIMENSION_NAMES, KPI_NAMES, LABEL_COLUMNS


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}::DOUBLE" if isinstance(value, float) else str(value)


def values(rows) -> str:
    return ", ".join("(" + ", ".join(map(lit, row)) + ")" for row in rows)


RUN_TS = bridge.RUN_TS.strftime("%Y-%m-%d %H:%M:%S")

SMALL = f"""
airports(nk, iata, country, cc, continent, lat, lon) AS (
  VALUES {values((i, *a) for i, a in enumerate(AIRPORTS))}),
airlines(icao, name) AS (
  SELECT 'AL' || n, 'Airline ' || n FROM range({AIRLINES}) t(n) WHERE n <> {UNNAMED_AIRLINE}),
codes(brand, code) AS (VALUES {values((i + 1, c) for i, c in enumerate(AIRCRAFT))}),
zones(zone, y1, y2, x1, x2) AS (VALUES {values((n, *b) for n, b in ZONES.items())})"""

FEED = SMALL + """,
feed AS (
  SELECT 'F' || l_orderkey AS flight_id, 'CF' || l_orderkey AS callsign,
    l_shipdate AS extraction_timestamp, 'B' || strftime(l_shipdate, '%Y%m') AS batch_id,
    lower(r_name) AS source_zone,
    CASE WHEN l_suppkey % 23 = 0 THEN '  ' WHEN l_suppkey % 7 = 0 THEN ' al' || (l_suppkey % 40)
         ELSE 'AL' || (l_suppkey % 40) END AS airline_icao,
    code AS aircraft_code,
    CASE WHEN l_partkey % 31 <> 0 THEN oa.iata END AS origin_iata,
    CASE WHEN l_partkey % 37 = 0 THEN '' ELSE da.iata END AS destination_iata,
    CASE WHEN NOT (l_linenumber = 7 AND l_partkey % 5 = 0) THEN (l_quantity - 25) * 3.7e0 END AS latitude,
    (l_suppkey % 360 - 180)::DOUBLE AS longitude,
    CASE WHEN l_partkey % 41 = 0 THEN -100e0 ELSE l_extendedprice / 2 END AS altitude,
    l_quantity * 12.1e0 AS ground_speed,
    CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 1
         ELSE 0 END AS on_ground,
    l_linenumber::BIGINT AS obs_line, l_partkey AS obs_part, l_suppkey AS obs_supplier
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN airports oa ON oa.nk = s_nationkey LEFT JOIN airports da ON da.nk = c_nationkey
  LEFT JOIN codes ON brand = CAST(substr(p_brand, 7) AS INT)
  LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

NORMALIZED = ", ".join(
    f"trim(upper({c})) AS {c}"
    for c in ("origin_iata", "destination_iata", "airline_icao", "aircraft_code"))

BRONZE = FEED + f""",
normalized AS (SELECT * REPLACE ({NORMALIZED}) FROM feed),
raised AS (
  SELECT *, nullif(concat_ws(',',
    CASE WHEN origin_iata IS NULL OR origin_iata = '' THEN 'MISSING_ORIGIN' END,
    CASE WHEN destination_iata IS NULL OR destination_iata = '' THEN 'MISSING_DESTINATION' END,
    CASE WHEN airline_icao IS NULL OR airline_icao = '' THEN 'MISSING_AIRLINE' END,
    CASE WHEN aircraft_code IS NULL OR aircraft_code = '' THEN 'MISSING_AIRCRAFT_CODE' END,
    CASE WHEN on_ground = 0 AND (latitude IS NULL OR longitude IS NULL) THEN 'MISSING_POSITION' END,
    CASE WHEN on_ground = 0 AND (altitude IS NULL OR altitude < 0 OR altitude > 50000)
         THEN 'INVALID_ALTITUDE' END,
    CASE WHEN on_ground = 0 AND (ground_speed IS NULL OR ground_speed < 0 OR ground_speed > 600)
         THEN 'INVALID_GROUND_SPEED' END,
    CASE WHEN on_ground = 0 AND (latitude IS NULL OR latitude < -90 OR latitude > 90
         OR longitude IS NULL OR longitude < -180 OR longitude > 180)
         THEN 'INCONSISTENT_POSITION' END), '') AS data_quality_flags
  FROM normalized),
bronze AS (
  SELECT *, data_quality_flags IS NULL AND coalesce(on_ground = 0, false) AS is_valid,
    strftime(date_trunc('month', extraction_timestamp), '%Y') AS tech_year,
    strftime(date_trunc('month', extraction_timestamp), '%Y-%m') AS tech_month,
    strftime(date_trunc('month', extraction_timestamp), '%Y-%m-01') AS tech_day,
    '00' AS tech_hour
  FROM raised)"""

MANUFACTURER = """CASE
    WHEN upper(aircraft_code) LIKE 'BCS%' THEN 'Airbus'
    WHEN upper(aircraft_code) LIKE 'CRJ%' THEN 'Bombardier'
    WHEN upper(aircraft_code) LIKE 'EMB%' THEN 'Embraer'
    WHEN upper(aircraft_code) LIKE 'CL%' THEN 'Bombardier'
    WHEN upper(aircraft_code) LIKE 'DH%' THEN 'De Havilland Canada'
    WHEN upper(aircraft_code) LIKE 'AT%' THEN 'ATR'
    WHEN upper(aircraft_code) LIKE 'E1%' OR upper(aircraft_code) LIKE 'E2%' THEN 'Embraer'
    WHEN upper(aircraft_code) LIKE 'MD%' THEN 'McDonnell Douglas'
    WHEN upper(aircraft_code) LIKE 'SU%' THEN 'Sukhoi'
    WHEN upper(aircraft_code) LIKE 'AN%' THEN 'Antonov'
    WHEN upper(aircraft_code) LIKE 'IL%' THEN 'Ilyushin'
    WHEN upper(aircraft_code) LIKE 'TU%' THEN 'Tupolev'
    WHEN upper(aircraft_code) LIKE 'A%' THEN 'Airbus'
    WHEN upper(aircraft_code) LIKE 'B%' THEN 'Boeing'
    WHEN upper(aircraft_code) LIKE 'F%' THEN 'Fokker'
    ELSE 'Other' END"""


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    chord = (f"power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) "
             f"* cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2)")
    known = " AND ".join(f"{x} IS NOT NULL" for x in (lat1, lon1, lat2, lon2))
    return f"CASE WHEN {known} THEN 2 * 6371e0 * asin(sqrt(least(1e0, {chord}))) END"


def silver_ctes(tie_break: tuple[str, ...]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("extraction_timestamp", *tie_break))
    return BRONZE + f""",
latest AS (
  SELECT * FROM bronze
  QUALIFY row_number() OVER (PARTITION BY flight_id ORDER BY {order}) = 1),
silver AS (
  SELECT latest.*, airlines.name AS airline_name,
    oa.cc AS origin_cc, oa.country AS origin_country, oa.lat AS origin_lat, oa.lon AS origin_lon,
    da.cc AS dest_cc, da.country AS dest_country, da.lat AS dest_lat, da.lon AS dest_lon,
    coalesce(oa.continent, 'UNKNOWN') AS origin_continent,
    coalesce(da.continent, 'UNKNOWN') AS destination_continent,
    {MANUFACTURER} AS manufacturer,
    {km('oa.lat', 'oa.lon', 'da.lat', 'da.lon')} AS distance_km
  FROM latest LEFT JOIN airports oa ON origin_iata = oa.iata
  LEFT JOIN airports da ON destination_iata = da.iata
  LEFT JOIN airlines ON airline_icao = icao)"""


SILVER = silver_ctes(bridge.TIE_BREAK)

# a lake read back has only Bronze columns; those the feed leaves NULL cannot order anything
REPLAYED = silver_ctes((
    *(c for c in bridge.FILLED if c not in ("flight_id", "extraction_timestamp")),
    "data_quality_flags", "is_valid",
))


def km_list(*columns: str) -> str:
    return ", ".join(f"round({c}, 3) AS {c}" for c in columns)


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


STAMP = f"'{RUN_TS}'"
KEY = "flight_id, obs_line, obs_part, obs_supplier"
LABELS = ", ".join(LABEL_COLUMNS)

ORACLES: dict[str, str] = {}


def oracle(name: str, ctes: str, body: str) -> None:
    ORACLES[name] = f"WITH {ctes.strip()} {body.strip()}" if ctes else body.strip()


# --- ingest ------------------------------------------------------------------------------

ALTITUDE = """CASE WHEN obs_part % 43 = 0 OR obs_part % 47 = 0 OR obs_part % 59 = 0 THEN NULL
  ELSE altitude END"""

oracle("ingest_feed", FEED, f"""
SELECT {STAMP} AS extraction_timestamp, 'B1' AS batch_id, 'global' AS source_zone, flight_id,
  callsign, 'N' || obs_line AS flight_number, airline_icao, aircraft_code, origin_iata,
  destination_iata, round(latitude, 3) AS latitude, round(longitude, 3) AS longitude,
  round({ALTITUDE}, 3) AS altitude, round(ground_speed, 3) AS ground_speed,
  NULL::DOUBLE AS heading, CASE WHEN obs_part % 11 < 2 THEN 0 WHEN obs_part % 11 < 6 THEN 1
    WHEN obs_part % 11 = 10 THEN on_ground END::BIGINT AS on_ground,
  NULL::VARCHAR AS airline_name, NULL::VARCHAR AS status_text
FROM feed WHERE obs_part % 83 <> 0 AND obs_part % 89 <> 0""")

oracle("ingest_rejects", "", """
SELECT CASE WHEN l_partkey % 89 = 0 THEN 'malformed' ELSE 'no_key' END AS reason,
  count(*) AS records
FROM lineitem WHERE l_partkey % 83 = 0 OR l_partkey % 89 = 0 GROUP BY 1""")

ORACLES["ingest_staged"] = ORACLES["ingest_feed"]

oracle("collect_zones", FEED, f"""
SELECT flight_id, callsign, zone AS source_zone, {km_list('latitude', 'longitude', 'altitude')},
  on_ground::BIGINT AS on_ground FROM feed
JOIN zones ON latitude BETWEEN y2 AND y1 AND longitude BETWEEN x1 AND x2 AND zone <> 'tropics'
QUALIFY row_number() OVER (PARTITION BY flight_id ORDER BY zone, feed.latitude,
  feed.longitude, feed.altitude, on_ground NULLS LAST) = 1""")

oracle("ingest_empty", FEED, """
SELECT 'full' AS landing, count(DISTINCT flight_id) AS flights, 1::BIGINT AS zones
FROM feed WHERE obs_part % 83 <> 0 AND obs_part % 89 <> 0
UNION ALL SELECT 'empty', 0, 0 UNION ALL SELECT 'missing', 0, 0""")

oracle("coerce_numeric", FEED, f"""
SELECT {KEY},
  round(CASE WHEN obs_part % 43 = 0 OR obs_part % 47 = 0 OR obs_part % 59 = 0 OR obs_part % 61 = 0
    THEN NULL WHEN obs_part % 67 = 0 OR obs_part % 71 = 0 THEN 1500e0 ELSE altitude END, 3) AS altitude,
  (CASE WHEN obs_part % 43 = 0 THEN NULL WHEN obs_part % 47 = 0 THEN 1
    WHEN obs_part % 59 = 0 THEN NULL ELSE on_ground END)::BIGINT AS on_ground,
  trunc(altitude)::BIGINT AS altitude_int
FROM feed""")

oracle("filter_zone", FEED, f"""
SELECT {KEY}, {km_list('latitude', 'longitude')}, airline_icao, aircraft_code
FROM feed JOIN zones ON zone = 'tropics'
WHERE latitude BETWEEN y2 AND y1 AND longitude BETWEEN x1 AND x2
  AND airline_icao = 'AL18' AND aircraft_code = 'B738'""")

oracle("union_zones", FEED, f"""
SELECT {KEY}, zone AS source_zone FROM feed
JOIN zones ON latitude BETWEEN y2 AND y1 AND longitude BETWEEN x1 AND x2""")

oracle("zones_on_grid", FEED, f"""
SELECT {KEY}, zone AS source_zone FROM feed
JOIN (SELECT * FROM zones UNION ALL VALUES ('pacific', 60e0, -60e0, 150e0, -150e0)) z
  ON latitude BETWEEN y2 AND y1
  AND CASE WHEN x1 <= x2 THEN longitude BETWEEN x1 AND x2 ELSE longitude >= x1 OR longitude <= x2 END""")

oracle("dedup_zones", FEED, f"""
SELECT {KEY}, {ts('extraction_timestamp')} AS extraction_timestamp, zone AS source_zone FROM feed
JOIN zones ON latitude BETWEEN y2 AND y1 AND longitude BETWEEN x1 AND x2
QUALIFY row_number() OVER (PARTITION BY flight_id
  ORDER BY extraction_timestamp DESC, obs_line, obs_part, obs_supplier, zone) = 1""")

oracle("subzones", "", """
SELECT r_name AS zone, count(*) AS subzone_count,
  string_agg(n_name, ',' ORDER BY n_nationkey) AS subzone_names
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) GROUP BY r_name""")

# --- reference files ---------------------------------------------------------------------

CSV_AIRPORTS = SMALL + """,
lettered AS (
  SELECT *, chr(65 + ((c_custkey // 676) % 26)::INT) || chr(65 + ((c_custkey // 26) % 26)::INT)
    || chr(65 + (c_custkey % 26)::INT) AS letters FROM customer JOIN airports ON nk = c_nationkey),
csv AS (
  SELECT letters AS airport_iata,
    CASE WHEN c_custkey % 7 <> 0 THEN 'K' || c_custkey END AS airport_icao,
    'Field "' || c_custkey || '", main' || CASE WHEN c_custkey % 43 = 0 THEN chr(10) || 'hall' ELSE '' END
      AS airport_name, country AS country_name,
    CASE WHEN c_custkey % 29 <> 0 OR (c_custkey % 31 = 0) THEN c_acctbal / 125 END AS latitude,
    c_acctbal / 62.5e0 AS longitude, cc, continent
  FROM lettered WHERE c_custkey % 19 <> 0 AND c_custkey % 23 <> 0 AND c_custkey % 31 <> 0)"""

RECORDS = SMALL + """,
records AS (
  SELECT 'S' || s_suppkey AS airport_iata, 'K' || s_suppkey AS airport_icao,
    s_name AS airport_name, country AS country_name,
    CASE WHEN s_suppkey % 13 <> 0 THEN s_acctbal / 125 END AS latitude,
    s_acctbal / 62.5e0 AS longitude
  FROM supplier JOIN airports ON nk = s_nationkey WHERE s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0)"""

FLEET = """
fleet AS (
  SELECT 'Airline ' || (s_suppkey % 40) || CASE WHEN (s_suppkey // 40) % 2 = 1 THEN ' bis' ELSE '' END
      AS "Name",
    CASE WHEN s_suppkey % 17 = 0 THEN NULL WHEN s_suppkey % 19 = 0 THEN ''
      ELSE 'AL' || (s_suppkey % 40) END AS "ICAO",
    CASE WHEN (s_suppkey % 40) % 3 <> 0 THEN 'I' || (s_suppkey % 40) END AS "IATA",
    s_suppkey * 7 % 1000 AS n_aircrafts FROM supplier)"""

BULK_AIRLINES = FLEET + """,
bulk AS (
  SELECT "ICAO" AS airline_icao, "IATA" AS airline_iata, "Name" AS airline_name FROM fleet
  WHERE "ICAO" <> ''
  QUALIFY row_number() OVER (PARTITION BY "ICAO" ORDER BY
    ("IATA" IS NOT NULL)::INT DESC, "IATA" NULLS LAST, "Name") = 1)"""

AIRPORT_FIELDS = "airport_iata, airport_icao, airport_name, country_name"

oracle("read_airports_csv", CSV_AIRPORTS,
       f"SELECT {AIRPORT_FIELDS}, {km_list('latitude', 'longitude')} FROM csv")

oracle("read_airports_records", RECORDS,
       f"SELECT {AIRPORT_FIELDS}, {km_list('latitude', 'longitude')} FROM records")

oracle("dim_airports_bulk", CSV_AIRPORTS, f"""
SELECT {AIRPORT_FIELDS}, cc AS country_code, continent AS continent_code,
  {km_list('latitude', 'longitude')}, {STAMP} AS last_updated FROM csv
QUALIFY row_number() OVER (PARTITION BY airport_iata ORDER BY
  (airport_icao IS NOT NULL)::INT + (latitude IS NOT NULL)::INT DESC,
  airport_icao NULLS LAST, airport_name, country_name, latitude NULLS LAST, longitude) = 1""")

oracle("dim_airlines_bulk", BULK_AIRLINES, f"SELECT *, {STAMP} AS last_updated FROM bulk")

oracle("filter_countries", RECORDS, """
SELECT airport_iata, country_name FROM records
WHERE country_name IN ('United States', 'united-states', 'France', 'South Korea')""")

oracle("airports_per_country", RECORDS,
       "SELECT country_name, count(*) AS airport_count FROM records GROUP BY country_name")

oracle("top_airlines_fleet", FLEET, """
SELECT * FROM fleet ORDER BY n_aircrafts DESC, "ICAO" NULLS FIRST, "Name" LIMIT 10""")

oracle("dim_freshness", BULK_AIRLINES, """
SELECT seen, fresh, (SELECT count(*) FROM bulk) AS airlines
FROM (VALUES ('now', true), ('later', false)) t(seen, fresh)""")

# --- scalar expressions ------------------------------------------------------------------

oracle("normalize_codes", BRONZE, f"""
SELECT origin_iata, destination_iata, airline_icao, aircraft_code, {KEY} FROM bronze""")

ORIGINS = SMALL + """,
origins AS (
  SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, country AS country_name,
    lower(cc) AS raw_code, cc, coalesce(continent, 'UNKNOWN') AS continent
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN airports ON nk = s_nationkey)"""

oracle("country_code", ORIGINS,
       "SELECT l_orderkey, l_linenumber, l_suppkey, country_name, cc AS country_code FROM origins")

oracle("continent_code", ORIGINS,
       "SELECT l_orderkey, l_linenumber, l_suppkey, raw_code, continent AS continent_code FROM origins")

oracle("continent_name", ORIGINS, """
SELECT l_orderkey, l_linenumber, l_suppkey, CASE continent WHEN 'AF' THEN 'Africa'
  WHEN 'AS' THEN 'Asia' WHEN 'EU' THEN 'Europe' WHEN 'NA' THEN 'North America'
  WHEN 'OC' THEN 'Oceania' WHEN 'SA' THEN 'South America' ELSE 'Unknown' END AS continent_name
FROM origins""")

oracle("manufacturer", FEED, f"SELECT {KEY}, aircraft_code, {MANUFACTURER} AS manufacturer FROM feed")

oracle("haversine", SMALL + """,
ends AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lat AS lat2, lon AS lon2,
    CASE WHEN NOT (l_linenumber = 7 AND l_partkey % 5 = 0) AND l_partkey % 97 <> 0 THEN (l_quantity - 25) * 3.6e0 END AS lat1,
    (l_suppkey % 360 - 180)::DOUBLE AS lon1
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN airports ON nk = s_nationkey)""",
       f"""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey,
  round({km('lat1', 'lon1', 'lat2', 'lon2')}, 3) AS distance_km FROM ends""")

oracle("partition_labels", """
shifted AS (SELECT *, l_shipdate + to_hours(l_linenumber * 3) AS t FROM lineitem)""", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_suppkey, l_partkey,
  strftime(t, '%Y') AS tech_year, strftime(t, '%Y-%m') AS tech_month,
  strftime(t, '%Y-%m-%d') AS tech_day, strftime(t, '%H') AS tech_hour FROM shifted""")

# --- quality -----------------------------------------------------------------------------

oracle("quality_flags", BRONZE, f"SELECT {KEY}, data_quality_flags FROM bronze")
oracle("is_valid", BRONZE, f"SELECT {KEY}, is_valid FROM bronze")


def missing(column: str) -> str:
    return f"count(*) FILTER ({column} IS NULL OR {column} = '')"


PROFILE = f"""
count(*) AS total_rows, count(*) FILTER (is_valid) AS valid_rows,
count(*) FILTER (on_ground = 1) AS on_ground, count(*) FILTER (on_ground = 0) AS on_flight,
{missing('origin_iata')} AS missing_origin, {missing('destination_iata')} AS missing_destination,
{missing('airline_icao')} AS missing_airline, {missing('aircraft_code')} AS missing_aircraft"""


def pct(part: str, whole: str) -> str:
    return f"round_even({part} / ({whole})::DOUBLE * 100, 1)"


oracle("quality_profile", BRONZE + f", counted AS (SELECT {PROFILE} FROM bronze)", f"""
SELECT *, {pct('valid_rows', 'total_rows')} AS pct_valid,
  {pct('on_ground', 'total_rows')} AS pct_on_ground,
  valid_rows / total_rows::DOUBLE * 100 < 70 AS low_quality FROM counted""")

FLAGS = BRONZE + """,
flags AS (
  SELECT flag, count(*) AS "count" FROM (
    SELECT unnest(string_split(data_quality_flags, ',')) AS flag FROM bronze) GROUP BY flag)"""

oracle("flag_counts", FLAGS, "SELECT * FROM flags")

oracle("quality_report", FLAGS + ", counted AS (SELECT count(*) AS total_rows, "
       "count(*) FILTER (is_valid) AS valid_rows FROM bronze)",
       "SELECT total_rows, valid_rows, flag, \"count\" FROM counted CROSS JOIN flags")

oracle("quality_report_json", FLAGS + f", counted AS (SELECT {PROFILE} FROM bronze)", f"""
SELECT total_rows, valid_rows, on_ground, on_flight, {pct('valid_rows', 'total_rows')} AS pct_valid,
  flag, "count" FROM counted CROSS JOIN flags""")

oracle("batch_retry", "", """
SELECT n AS extracted_rows, n AS bronze_rows
FROM (SELECT count(*) AS n FROM lineitem) CROSS JOIN (SELECT unnest([1, 2]))""")

oracle("batch_lost_append", FEED, """
SELECT 'B1' AS batch_id, '2026' AS tech_year, '2026-06' AS tech_month, '2026-06-21' AS tech_day,
  '14' AS tech_hour, count(*) AS bronze_rows, count(*) FILTER (on_ground = 0) AS airborne FROM feed""")

CARDINALITY = """
count(DISTINCT airline_icao) AS unique_airlines, count(DISTINCT aircraft_code) AS unique_aircraft"""

oracle("dimension_cardinality", BRONZE, f"""
SELECT {CARDINALITY}, (SELECT count(DISTINCT iata) FROM (SELECT origin_iata AS iata FROM bronze
  UNION ALL SELECT destination_iata FROM bronze)) AS unique_airports FROM bronze""")

oracle("distinct_over_runs", BRONZE, f"""
SELECT substr(batch_id, 2, 4) AS year, count(*) AS row_count, {CARDINALITY},
  any_value(p.unique_airports) AS unique_airports
FROM bronze JOIN (SELECT year, count(DISTINCT iata) AS unique_airports FROM (
    SELECT substr(batch_id, 2, 4) AS year, origin_iata AS iata FROM bronze
    UNION ALL SELECT substr(batch_id, 2, 4), destination_iata FROM bronze) GROUP BY year) p
  ON p.year = substr(batch_id, 2, 4)
GROUP BY substr(batch_id, 2, 4)""")

oracle("missing_rates", FEED + ", rates AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {pct(f'count(*) FILTER ({test})', 'count(*)')} AS missing_pct FROM feed"
    for c, test in [
        *((c, f"{c} IS NULL OR {c} = ''") for c in (
            "flight_id", "airline_icao", "aircraft_code", "origin_iata", "destination_iata")),
        *((c, f"{c} IS NULL") for c in (
            "latitude", "longitude", "altitude", "ground_speed", "on_ground")),
        ("heading", "true"),
    ]) + ")", "SELECT * FROM rates")

oracle("feed_shares", FEED, f"""
SELECT sum(on_ground)::BIGINT AS on_ground_rows, count(*) AS total_rows,
  {pct('sum(on_ground)', 'count(*)')} AS on_ground_pct,
  {pct("count(*) FILTER (origin_iata IS NULL OR origin_iata = '' OR destination_iata IS NULL "
       "OR destination_iata = '')", 'count(*)')} AS no_route_pct,
  {pct(missing('airline_icao'), 'count(*)')} AS no_airline_pct,
  {pct(missing('aircraft_code'), 'count(*)')} AS no_aircraft_pct FROM feed""")

# --- Silver ------------------------------------------------------------------------------

oracle("dedup_latest", FEED, f"""
SELECT flight_id, {ts('extraction_timestamp')} AS extraction_timestamp, round(altitude, 3) AS altitude,
  obs_line, obs_part, obs_supplier FROM feed
QUALIFY row_number() OVER (PARTITION BY flight_id ORDER BY feed.extraction_timestamp DESC,
  obs_line DESC, obs_part DESC, obs_supplier DESC) = 1""")

oracle("enrich_dims", BRONZE, f"""
SELECT {KEY}, airlines.name AS airline_name,
  CASE WHEN obs_part % 11 = 0 THEN 'ZZ' WHEN obs_part % 13 = 0 THEN '' ELSE oa.cc END
    AS origin_airport_country_code,
  oa.country AS origin_airport_country_name, oa.lat AS origin_airport_latitude,
  oa.lon AS origin_airport_longitude, da.cc AS destination_airport_country_code,
  da.country AS destination_airport_country_name, da.lat AS destination_airport_latitude,
  da.lon AS destination_airport_longitude
FROM bronze LEFT JOIN airports oa ON origin_iata = oa.iata
LEFT JOIN airports da ON destination_iata = da.iata LEFT JOIN airlines ON airline_icao = icao""")

oracle("enrich_noop", BRONZE, f"""
SELECT {KEY}, airline_icao, NULL::VARCHAR AS airline_name,
  NULL::VARCHAR AS origin_airport_country_name FROM bronze""")

oracle("silver_fact", SILVER, f"""
SELECT {KEY}, {ts('extraction_timestamp')} AS extraction_timestamp, batch_id, airline_icao,
  airline_name, aircraft_code, manufacturer, origin_iata, destination_iata, origin_continent,
  destination_continent, origin_cc AS origin_airport_country_code,
  round(distance_km, 3) AS distance_km, is_valid, data_quality_flags, {LABELS} FROM silver""")

# --- dimensions --------------------------------------------------------------------------

DIMENSIONS = SILVER + """,
seen(airport_iata, country_code, country_name, continent_code, latitude, longitude) AS (
  SELECT origin_iata, origin_cc, origin_country, origin_continent, origin_lat, origin_lon FROM silver
  UNION SELECT destination_iata, dest_cc, dest_country, destination_continent, dest_lat, dest_lon
  FROM silver),
dim_airports AS (
  SELECT airport_iata, NULL::VARCHAR AS airport_name, country_code, country_name, continent_code,
    latitude, longitude FROM seen WHERE airport_iata <> ''
  QUALIFY row_number() OVER (PARTITION BY airport_iata ORDER BY
    (country_code IS NOT NULL)::INT + (country_name IS NOT NULL)::INT DESC,
    country_code NULLS LAST, country_name, continent_code) = 1),
dim_airlines AS (
  SELECT airline_icao, NULL::VARCHAR AS airline_iata, max(airline_name) AS airline_name FROM silver
  WHERE airline_icao <> '' GROUP BY airline_icao),
dim_aircraft_models AS (
  SELECT DISTINCT aircraft_code, NULL::VARCHAR AS aircraft_model, manufacturer FROM silver
  WHERE aircraft_code <> ''),
dim_countries_continents AS (
  SELECT country_code, country_name, continent_code FROM seen WHERE country_code <> ''
  QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY country_name, continent_code) = 1)"""

for _dim in DIMENSION_NAMES:
    oracle(f"build_{_dim}", DIMENSIONS, f"SELECT *, {STAMP} AS last_updated FROM {_dim}")

oracle("rollup_dimensions", DIMENSIONS, f"SELECT *, {STAMP} AS last_updated FROM dim_airports")


def counts(names, **replaced: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS row_count FROM {replaced.get(n, n)}" for n in names)


oracle("dim_counts", DIMENSIONS, counts(DIMENSION_NAMES))
oracle("dims_fallback", DIMENSIONS + "," + BULK_AIRLINES, counts(DIMENSION_NAMES, dim_airlines="bulk"))

# --- KPIs --------------------------------------------------------------------------------

KPI_CTES = """,
active AS (SELECT * FROM silver WHERE is_valid),
routes AS (SELECT * FROM active WHERE distance_km IS NOT NULL AND origin_iata <> destination_iata),
kpi_airline_volumes AS (
  SELECT airline_icao, airline_name, count(*) AS active_flights_count FROM active
  GROUP BY airline_icao, airline_name ORDER BY 3 DESC, 1, 2 NULLS FIRST LIMIT 1),
kpi_continental_regional AS (
  SELECT origin_continent, airline_icao, airline_name, count(*) AS regional_flights_count
  FROM active WHERE origin_continent = destination_continent AND origin_continent <> 'UNKNOWN'
  GROUP BY origin_continent, airline_icao, airline_name
  QUALIFY row_number() OVER (PARTITION BY origin_continent
    ORDER BY count(*) DESC, airline_icao, airline_name NULLS FIRST) = 1),
kpi_longest_flight AS (
  SELECT callsign, airline_icao, airline_name, origin_iata, destination_iata, distance_km
  FROM routes ORDER BY round(distance_km, 6) DESC, flight_id LIMIT 1),
kpi_continental_avg_distance AS (
  SELECT origin_continent, avg(distance_km) AS avg_distance_km, min(distance_km) AS min_distance_km,
    max(distance_km) AS max_distance_km, count(*) AS flight_count
  FROM routes WHERE origin_continent <> 'UNKNOWN' GROUP BY origin_continent),
kpi_aircraft_manufacturers AS (
  SELECT manufacturer, count(*) AS active_flights_count FROM active WHERE manufacturer <> 'Other'
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
kpi_airline_aircraft_top3 AS (
  SELECT origin_cc AS origin_airport_country_code, aircraft_code, count(*) AS usage_count,
    row_number() OVER (PARTITION BY origin_cc ORDER BY count(*) DESC, aircraft_code) AS rank
  FROM active WHERE aircraft_code IS NOT NULL AND origin_cc IS NOT NULL
  GROUP BY origin_cc, aircraft_code QUALIFY rank <= 3),
departing AS (SELECT origin_iata AS iata, count(*) AS n FROM active GROUP BY 1),
arriving AS (SELECT destination_iata AS iata, count(*) AS n FROM active GROUP BY 1),
kpi_airport_imbalance AS (
  SELECT coalesce(d.iata, a.iata) AS airport_iata, coalesce(d.n, 0) AS departures,
    coalesce(a.n, 0) AS arrivals, coalesce(d.n, 0) - coalesce(a.n, 0) AS imbalance,
    abs(coalesce(d.n, 0) - coalesce(a.n, 0)) AS imbalance_abs
  FROM departing d FULL JOIN arriving a ON d.iata = a.iata ORDER BY 5 DESC, 1 LIMIT 1)"""

GOLD = SILVER + KPI_CTES

KPI_COLUMNS = {
    "kpi_airline_volumes": "*",
    "kpi_continental_regional": "*",
    "kpi_longest_flight": "* REPLACE (round(distance_km, 3) AS distance_km)",
    "kpi_continental_avg_distance":
        "* REPLACE (" + km_list("avg_distance_km", "min_distance_km", "max_distance_km") + ")",
    "kpi_aircraft_manufacturers": "*",
    "kpi_airline_aircraft_top3": "*",
    "kpi_airport_imbalance": "*",
}

for _kpi, _columns in KPI_COLUMNS.items():
    oracle(_kpi, GOLD, f"SELECT {_columns}, {STAMP} AS computed_at FROM {_kpi}")

SUMMARY = {
    "kpi_airline_volumes": ("airline_icao, airline_name", "active_flights_count"),
    "kpi_continental_regional": (
        "origin_continent, airline_icao, airline_name", "regional_flights_count"),
    "kpi_longest_flight": ("callsign, origin_iata, destination_iata", "distance_km"),
    "kpi_continental_avg_distance": ("origin_continent", "avg_distance_km"),
    "kpi_aircraft_manufacturers": ("manufacturer", "active_flights_count"),
    "kpi_airline_aircraft_top3": ("origin_airport_country_code, aircraft_code", "usage_count"),
    "kpi_airport_imbalance": ("airport_iata", "imbalance"),
}

oracle("gold_all", REPLAYED + KPI_CTES, " UNION ALL ".join(
    f"SELECT '{name}' AS kpi, concat_ws('/', {label}) AS label, "
    f"round({measure}::DOUBLE, 3) AS measure FROM {name}"
    for name, (label, measure) in SUMMARY.items()))

ORACLES["batch_run"] = ORACLES["gold_all"]

oracle("kpi_row_counts", GOLD, counts(KPI_NAMES))

oracle("top3_for_country", GOLD, """
SELECT * FROM kpi_airline_aircraft_top3 WHERE origin_airport_country_code = (
  SELECT coalesce(max(origin_airport_country_code) FILTER (origin_airport_country_code = 'US'),
    min(origin_airport_country_code)) FROM kpi_airline_aircraft_top3)""")

oracle("latest_snapshot", GOLD,
       f"SELECT {KPI_COLUMNS['kpi_continental_avg_distance']} FROM kpi_continental_avg_distance")

# --- lake --------------------------------------------------------------------------------

BRONZE_ROWS = f"""
SELECT flight_id, {ts('extraction_timestamp')} AS extraction_timestamp, batch_id, airline_icao,
  round(altitude, 3) AS altitude, data_quality_flags, is_valid, {LABELS} FROM bronze"""

oracle("bronze_roundtrip", BRONZE, BRONZE_ROWS)
oracle("prune_partition", BRONZE, BRONZE_ROWS + " WHERE tech_day = '1997-05-01'")

oracle("replay_bronze", REPLAYED, f"""
SELECT flight_id, {ts('extraction_timestamp + INTERVAL 10 YEARS')} AS extraction_timestamp,
  'B2' AS batch_id, round(altitude + 100, 3) AS altitude, is_valid FROM silver""")

oracle("merge_bronze", REPLAYED, f"""
SELECT flight_id, {ts('extraction_timestamp')} AS extraction_timestamp, batch_id,
  round(altitude, 3) AS altitude, is_valid FROM silver""")

oracle("silver_overwrite", SILVER, f"""
SELECT flight_id, batch_id,
  CASE WHEN tech_year >= '1999' THEN 'REDONE' ELSE airline_icao END AS airline_icao, {LABELS}
FROM silver""")

oracle("dim_snapshot", DIMENSIONS, "SELECT airport_iata, country_code, continent_code FROM dim_airports")

oracle("gold_idempotent", GOLD, """
SELECT *, '2026-06-21 14:30:00' AS computed_at, '2026' AS tech_year, '2026-06' AS tech_month,
  '2026-06-21' AS tech_day, '14' AS tech_hour FROM kpi_airline_aircraft_top3""")

# --- runs --------------------------------------------------------------------------------

RUNS = BRONZE + f""",
counted AS (SELECT batch_id, {PROFILE}, {CARDINALITY} FROM bronze GROUP BY batch_id),
ports AS (SELECT batch_id, count(DISTINCT iata) AS unique_airports FROM (
  SELECT batch_id, origin_iata AS iata FROM bronze
  UNION ALL SELECT batch_id, destination_iata FROM bronze) GROUP BY batch_id),
clock AS (
  SELECT 'B' || strftime(l_shipdate, '%Y%m') AS batch_id, date_trunc('month', min(l_shipdate)) AS started,
    floor(avg(l_extendedprice) / 28)::BIGINT AS seconds,
    count(DISTINCT l_linenumber) FILTER (l_quantity = 1 AND l_discount >= 0.1e0 AND l_tax >= 0.08e0)
      AS num_errors
  FROM lineitem GROUP BY 1),
runs AS (
  SELECT *, strftime(started, '%Y-%m-%dT%H:%M:%S.000000') AS start_time,
    strftime(started + to_seconds(seconds), '%Y-%m-%dT%H:%M:%S.000000') AS end_time,
    seconds::DOUBLE AS total_duration_seconds,
    CASE WHEN num_errors = 0 THEN 'success' ELSE 'failed' END AS status,
    (valid_rows / total_rows::DOUBLE * 100 < 70)::BIGINT AS num_warnings,
    {pct('valid_rows', 'total_rows')} AS pct_valid,
    CASE WHEN on_ground + on_flight > 0 THEN {pct('on_flight', '(on_ground + on_flight)')}
      ELSE 0e0 END AS pct_in_flight
  FROM counted JOIN ports USING (batch_id) JOIN clock USING (batch_id))"""

oracle("run_metrics", RUNS, """
SELECT batch_id, start_time, end_time, status, num_errors, num_warnings, total_duration_seconds,
  total_rows AS rows, valid_rows, total_rows - valid_rows AS invalid_rows, pct_valid,
  on_ground AS on_ground_count, on_flight AS in_flight_count, pct_in_flight,
  unique_airlines AS airlines, unique_airports AS airports, unique_aircraft AS aircraft,
  7::BIGINT AS kpis_computed, 1::BIGINT AS volume_rows, unique_airports AS top3_rows,
  0::BIGINT AS longest_rows FROM runs""")

oracle("run_history", RUNS, """
SELECT batch_id, status, total_duration_seconds, total_rows AS flights, pct_valid, pct_in_flight,
  unique_airlines AS airlines, unique_airports AS airports, num_errors, num_warnings, end_time
FROM runs""")

ORACLES["run_index"] = ORACLES["run_history"]

oracle("run_trends", RUNS,
       "SELECT batch_id, end_time, total_duration_seconds, pct_valid FROM runs")

oracle("run_alerts", RUNS, """
SELECT batch_id, 'CRITICAL' AS severity, 'pipeline_errors' AS type,
  num_errors || ' erreur(s) durant le batch' AS message FROM runs WHERE num_errors > 0
UNION ALL SELECT batch_id, 'WARNING', 'low_data_quality',
  printf('Qualité %.1f%% < seuil 70%%', pct_valid) FROM runs WHERE pct_valid < 70
UNION ALL SELECT batch_id, 'WARNING', 'sla_breach', 'Durée ' || seconds || 's > SLA 1800s'
FROM runs WHERE seconds > 1800
UNION ALL SELECT 'B0', 'WARNING', 'empty_extraction', 'Aucun vol extrait de l''API'""")

oracle("alert_documents", RUNS, """
SELECT batch_id, end_time AS timestamp,
  (num_errors > 0)::BIGINT + (pct_valid < 70)::BIGINT + (seconds > 1800)::BIGINT AS alert_count,
  concat_ws(',', CASE WHEN num_errors > 0 THEN 'pipeline_errors' END,
    CASE WHEN pct_valid < 70 THEN 'low_data_quality' END,
    CASE WHEN seconds > 1800 THEN 'sla_breach' END) AS types
FROM runs WHERE num_errors > 0 OR pct_valid < 70 OR seconds > 1800""")

oracle("history_csv", RUNS, """
SELECT batch_id, status, total_rows::VARCHAR AS flights, num_errors::VARCHAR AS num_errors,
  num_warnings::VARCHAR AS num_warnings, end_time FROM runs""")

oracle("latest_outcome", RUNS, """
SELECT batch_id, status, num_errors, status = 'success' AS succeeded FROM runs
ORDER BY end_time DESC, batch_id DESC LIMIT 1""")

oracle("run_log_status", RUNS, """
SELECT batch_id, CASE WHEN num_errors > 0 OR total_rows % 7 <> 0 THEN 'done' ELSE 'stalled' END AS state,
  CASE WHEN num_errors > 0 THEN 4 WHEN total_rows % 7 = 0 THEN 2 ELSE 5 END::BIGINT AS reached,
  CASE WHEN num_errors > 0 THEN 'Écriture Bronze' WHEN total_rows % 7 = 0 THEN 'Profil qualité'
    ELSE 'Silver + Gold (KPIs)' END AS phase,
  num_errors > 0 OR total_rows % 7 <> 0 AS finished,
  num_errors = 0 AND total_rows % 7 <> 0 AS success, false AS empty,
  strftime(started, '%Y-%m-%d %H:%M:%S') AS started FROM runs""")

