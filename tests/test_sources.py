from __future__ import annotations

import glob
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skytally.operators.profile import airports_per_country, top_airlines_by_fleet
from skytally.operators.zones import Box, dedup_zones, filter_feed, subzones, union_zones
from skytally.schema import FLIGHTS_RAW, ZONES
from skytally.sinks.lake import write_dimension
from skytally.sources import feed as feeds
from skytally.sources import reference_files as refs

BOXES = {"europe": Box.parse("72,33,-16,53"), "north": Box(90, 45, -180, 180), "empty": Box(-80, -90, 0, 1)}


def test_feed_conversion(spark, tmp_path, run_ts):
    lines = [
        {"id": "A1", "callsign": "C", "number": "N1", "origin_airport_iata": "OSL",
         "destination_airport_iata": "SEA", "latitude": 48, "longitude": "2.5", "altitude": "N/A",
         "ground_speed": "", "heading": "x", "on_ground": 0, "vertical_speed": 12.5},
        {"id": "A2", "on_ground": "1.0"},
        {"callsign": "no id"},
    ]
    text = "\n".join([*map(json.dumps, lines), '{"id": "A3", "latit'])
    (tmp_path / "feed.json").write_text(text)
    landed = feeds.read_feed(spark, str(tmp_path))
    df = feeds.to_observations(landed, run_ts, "b7")
    assert df.schema.names == FLIGHTS_RAW.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in FLIGHTS_RAW]
    one, two = df.orderBy("flight_id").collect()
    assert (one.flight_id, one.flight_number, one.origin_iata, one.destination_iata) == \
        ("A1", "N1", "OSL", "SEA")
    assert (one.latitude, one.longitude, one.altitude, one.ground_speed, one.heading, one.on_ground,
            one.vertical_speed) == (48.0, 2.5, None, None, None, 0, 12.5)
    assert (one.batch_id, one.source_zone, one.airline_name) == ("b7", "global", None)
    assert one.extraction_timestamp == run_ts.replace(tzinfo=None)
    assert (two.flight_id, two.on_ground) == ("A2", None)
    assert feeds.rejected(landed).count() == 2
    assert feeds.to_observations(landed, run_ts, "b", "asia").first().source_zone == "asia"


def test_empty_feed_has_the_schema(spark):
    df = feeds.empty_observations(spark)
    assert df.schema == FLIGHTS_RAW
    assert df.count() == 0


def test_zone_filter(observations):
    feed = observations({"flight_id": "in"}, {"flight_id": "out", "latitude": -20.0},
                        {"flight_id": "lost", "latitude": None},
                        {"flight_id": "fin", "airline_icao": "FIN"})
    assert {r.flight_id for r in filter_feed(feed, BOXES, "europe").collect()} == {"in", "fin"}
    assert {r.flight_id for r in filter_feed(feed, BOXES, "europe", "FIN", "AT76").collect()} == {"fin"}
    assert filter_feed(feed, BOXES, "atlantis").count() == 0
    assert filter_feed(feed, BOXES).count() == filter_feed(feed, BOXES, "global").count() == 4


def test_zone_union_and_dedup(observations):
    feed = observations({"flight_id": "both"}, {"flight_id": "one", "latitude": 40.0},
                        {"flight_id": "none", "latitude": -20.0})
    collected = union_zones(feed, BOXES, ["europe", "nowhere", "north", "empty"])
    assert sorted((r.flight_id, r.source_zone) for r in collected.collect()) == [
        ("both", "europe"), ("both", "north"), ("one", "europe")]
    assert collected.columns == feed.columns
    assert sorted((r.flight_id, r.source_zone) for r in dedup_zones(collected).collect()) == [
        ("both", "europe"), ("one", "europe")]
    assert union_zones(feed, BOXES, ["nowhere"]).count() == 0
    assert union_zones(feed, BOXES, ["global"]).count() == 3


def test_zone_feeds(spark, tmp_path, run_ts):
    for zone, ids in {"europe": ["A", "B"], "north": ["B", "C"], "asia": ["D"]}.items():
        folder = tmp_path / f"zone={zone}"
        folder.mkdir()
        lines = [json.dumps({"id": i, "callsign": zone}) for i in ids]
        (folder / "feed.json").write_text("\n".join([*lines, "{broken"]))
    (tmp_path / "zone=empty").mkdir()

    def collected(wanted):
        df = feeds.collect_zones(spark, str(tmp_path), wanted, run_ts, "b")
        assert df.columns == FLIGHTS_RAW.names
        return sorted((r.flight_id, r.source_zone) for r in df.collect())

    assert collected(["europe", "north", "empty", "nowhere"]) == [
        ("A", "europe"), ("B", "europe"), ("C", "north")]
    assert collected(["nowhere"]) == []
    assert len(collected(None)) == 4


def test_zone_documents(spark, tmp_path):
    corners = {"tl_y": 72.0, "tl_x": -16.0, "br_y": 33.0, "br_x": 53.0}
    assert Box.of_zone(corners) == Box.parse("72,33,-16,53")
    (tmp_path / "zones.json").write_text(json.dumps(
        {"europe": {**corners, "subzones": {"uk": corners}}}, indent=2))
    assert [tuple(r) for r in subzones(refs.read_zones(spark, str(tmp_path))).collect()] == [
        ("europe", 1, "uk")]


def test_subzones(spark):
    box = {"tl_y": 1.0, "tl_x": 1.0, "br_y": 0.0, "br_x": 2.0}
    doc = json.dumps({"europe": {**box, "subzones": {"poland": box, "uk": box}}, "asia": box,
                      "africa": {**box, "subzones": {}}})
    zones = spark.createDataFrame([(doc,)], "v string").select(F.from_json("v", ZONES).alias("zones"))
    assert [tuple(r) for r in subzones(zones).collect()] == [("europe", 2, "poland,uk")]


CSV = r"""1,"Tacoma ""SEA"", main","Seattle","United States","SEA","KSEA",47.45,-122.31,433,-8,"A","America/Los_Angeles","airport","OurAirports"
2,"No code","X","France",\N,"LFXX",1,2,3,4,"E","Z","airport","O"
3,"Gardermoen","Oslo","Norway"," OSL ",\N,60.19,\N,681,1,"E","Europe/Oslo","airport","OurAirports"
4,"Short","X","France","SHO","LFSH",1.5
5,"Eight","X","France","EIG","LFEI",1.5,2.5
6,"Two","X","France","TW","LFTW",1.5,2.5,3,4,"E","Z","airport","O"
7,\N,"X",,"NAM","\N",bad,2.5,3,4,"E","Z","airport","O"
"""


def test_airports_csv(spark, tmp_path, run_ts):
    path = tmp_path / "airports.dat"
    path.write_text(CSV)
    rows = {r.airport_iata: tuple(r)[1:] for r in refs.read_airports_csv(spark, str(path)).collect()}
    assert rows == {
        "SEA": ("KSEA", 'Tacoma "SEA", main', "United States", 47.45, -122.31),
        "OSL": (None, "Gardermoen", "Norway", 60.19, None),
        "EIG": ("LFEI", "Eight", "France", 1.5, 2.5),
        "NAM": (None, "\\N", "", None, 2.5),
    }
    dim = refs.airports_dimension(refs.read_airports_csv(spark, str(path)), run_ts)
    codes = {r.airport_iata: (r.country_code, r.continent_code) for r in dim.collect()}
    assert codes == {"SEA": ("US", "NA"), "OSL": ("NO", "EU"), "EIG": ("FR", "EU"),
                     "NAM": (None, "UNKNOWN")}


def test_airport_records_and_countries(spark, tmp_path):
    records = [{"iata": "OSL", "country": "Norway", "latitude": "x", "longitude": 2.5},
               {"iata": "", "country": "France"}, {"iata": None, "country": "France"},
               {"iata": "SEA", "country": "united-states"}, {"iata": "XXA", "country": "Atlantis"},
               {"iata": "NUL"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, records)))
    airports = refs.airports_of_records(refs.read_airport_records(spark, str(tmp_path)))
    assert {r.airport_iata: (r.latitude, r.longitude) for r in airports.collect()} == {
        "OSL": (None, 2.5), "SEA": (None, None), "XXA": (None, None), "NUL": (None, None)}

    def kept(spec):
        return {r.airport_iata for r in refs.filter_countries(airports, spec).collect()}
    assert kept("UNITED_STATES, NEVERLAND") == {"SEA"}
    assert kept(" all ") == kept("NEVERLAND") == kept("") == {"OSL", "SEA", "XXA", "NUL"}
    assert [tuple(r) for r in airports_per_country(airports).collect()] == [
        ("Atlantis", 1), ("Norway", 1), ("united-states", 1)]


def test_airline_records(spark, tmp_path, run_ts):
    records = [{"Name": "Alaska", "ICAO": "ASA", "IATA": "AS", "n_aircrafts": 310},
               {"Name": "Alaska Two", "ICAO": "ASA", "n_aircrafts": 1},
               {"Name": "Finnair", "ICAO": "FIN", "IATA": "AY", "n_aircrafts": 80},
               {"Name": "None", "ICAO": None, "n_aircrafts": 5}, {"Name": "Empty", "ICAO": ""}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, records)))
    landed = refs.read_airline_records(spark, str(tmp_path))
    dim = refs.airlines_dimension(landed, run_ts)
    assert sorted(tuple(r)[:3] for r in dim.collect()) == [
        ("ASA", "AS", "Alaska"), ("FIN", "AY", "Finnair")]
    assert [r.Name for r in top_airlines_by_fleet(landed, 2).collect()] == ["Alaska", "Finnair"]


def test_freshness_and_refresh(spark, tmp_path, run_ts):
    path = str(tmp_path / "dim_airlines" / "_current")
    as_of = datetime.now(timezone.utc)

    def table(name):
        return spark.createDataFrame([(name,)], "airline_name string")

    def fail():
        raise OSError("source is down")

    def name(df):
        return df.first().airline_name

    assert refs.read_snapshot(spark, path) is None
    assert refs.fresh_or_refreshed(spark, path, fail, as_of) is None
    assert name(refs.fresh_or_refreshed(spark, path, lambda: table("one"), as_of)) == "one"
    assert name(refs.fresh_or_refreshed(spark, path, lambda: table("two"), as_of)) == "one"
    later = as_of + timedelta(days=8)
    assert name(refs.fresh_or_refreshed(spark, path, fail, later)) == "one"
    assert name(refs.fresh_or_refreshed(spark, path, lambda: table("x").limit(0), later)) == "one"

    def breaks_while_running():
        return spark.range(3).select(F.raise_error(F.lit("bad record")).cast("string").alias("airline_name"))

    assert name(refs.fresh_or_refreshed(spark, path, breaks_while_running, later)) == "one"

    def from_itself():
        return refs.read_snapshot(spark, path).unionByName(table("two")).orderBy(F.desc("airline_name")).limit(1)

    assert name(refs.fresh_or_refreshed(spark, path, from_itself, later)) == "two"
    refs.fresh_or_refreshed(spark, path, lambda: table("one"), later)
    assert name(refs.fresh_or_refreshed(spark, path, lambda: table("two"), later)) == "two"


def test_freshness_counts_days_from_the_newest_file(spark, tmp_path):
    path = str(tmp_path / "dim")
    write_dimension(spark.range(10).repartition(3), path)
    files = glob.glob(f"{path}/version=*/*.parquet")
    newest = datetime(2026, 1, 10, tzinfo=timezone.utc)
    for i, f in enumerate(files):
        at = (newest - timedelta(days=i)).timestamp()
        os.utime(f, (at, at))
    snapshot = refs.read_snapshot(spark, path)
    row = refs.snapshot_freshness(snapshot, newest + timedelta(days=6.5), 7).first()
    assert row.age_days == pytest.approx(6.5) and row.fresh
    assert not refs.snapshot_freshness(snapshot, newest + timedelta(days=7), 7).first().fresh
