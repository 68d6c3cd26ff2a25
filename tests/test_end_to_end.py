"""From landed files to KPIs, the way a scheduled run would go."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from skytally.layout import Lake
from skytally.operators.kpis import top3_for_country
from skytally.plans import runs as run_plans
from skytally.plans.batch import replay, run_batch
from skytally.sources.feed import collect_zones
from skytally.sources.lake import read_bronze, read_latest, read_snapshot
from skytally.sources.reference_files import (
    airlines_dimension, airports_dimension, fresh_or_refreshed, read_airline_records, read_airports_csv,
)
from skytally.sources.runs import read_run_metrics

AIRPORTS = """1,"Gardermoen","Oslo","Norway","OSL","ENGM",60.19,11.1,681,1,"E","Z","airport","O"
2,"Tacoma","Seattle","United States","SEA","KSEA",47.45,-122.31,433,-8,"A","Z","airport","O"
3,"Denver","Denver","United States","DEN","KDEN",39.86,-104.67,5431,-7,"A","Z","airport","O"
"""
AIRLINES = [{"Name": "Alaska", "ICAO": "ASA", "IATA": "AS", "n_aircrafts": 310},
            {"Name": "Finnair", "ICAO": "FIN", "IATA": "AY", "n_aircrafts": 80}]


def position(flight_id, airline, aircraft, origin, destination, **more):
    return {"id": flight_id, "callsign": flight_id, "airline_icao": airline, "aircraft_code": aircraft,
            "origin_airport_iata": origin, "destination_airport_iata": destination, "latitude": 45.0,
            "longitude": "3.5", "altitude": 30000, "ground_speed": 450, "on_ground": 0, **more}


def land(folder, zone, *positions):
    path = folder / f"zone={zone}"
    path.mkdir(parents=True)
    (path / "feed.json").write_text("\n".join([*map(json.dumps, positions), "{cut"]))


def test_landed_files_to_kpis(spark, tmp_path):
    now = datetime.now(timezone.utc)
    (tmp_path / "airports.dat").write_text(AIRPORTS)
    (tmp_path / "airlines.json").write_text("\n".join(map(json.dumps, AIRLINES)))
    lake = Lake(str(tmp_path / "lake"))

    def dimensions():
        airports = fresh_or_refreshed(
            spark, lake.dimension("dim_airports"),
            lambda: airports_dimension(read_airports_csv(spark, str(tmp_path / "airports.dat")), now), now)
        airlines = fresh_or_refreshed(
            spark, lake.dimension("dim_airlines"),
            lambda: airlines_dimension(
                read_airline_records(spark, str(tmp_path / "airlines.json")), now), now)
        return airports, airlines

    land(tmp_path / "first", "europe", position("A", "FIN", "A320", "OSL", "SEA"),
         position("B", "asa ", "b738", "SEA", "DEN"))
    land(tmp_path / "first", "northamerica", position("B", "asa ", "b738", "SEA", "DEN"),
         position("C", "ASA", "B739", "DEN", "SEA"), position("D", "ASA", "B739", "DEN", ""))
    flights = collect_zones(spark, str(tmp_path / "first"), ["europe", "northamerica", "asia"], now, "r1")
    assert run_batch(flights, lake, now, "r1", *dimensions())
    assert read_bronze(spark, lake).count() == 4
    volume = read_latest(spark, lake, "kpi_airline_volumes").first()
    assert (volume.airline_icao, volume.airline_name, volume.active_flights_count) == ("ASA", "Alaska", 2)
    longest = read_latest(spark, lake, "kpi_longest_flight").first()
    assert (longest.callsign, round(longest.distance_km, -2)) == ("A", 7300)
    top3 = read_latest(spark, lake, "kpi_airline_aircraft_top3")
    assert [r.aircraft_code for r in top3_for_country(top3).collect()] == ["B738", "B739"]
    assert read_snapshot(spark, lake.dimension("dim_airports")).count() == 3  # bulk, not derived

    later = now + timedelta(hours=2)
    land(tmp_path / "second", "europe", position("A", "FIN", "A321", "OSL", "DEN"))
    flights = collect_zones(spark, str(tmp_path / "second"), ["europe"], later, "r2")
    assert run_batch(flights, lake, later, "r2", *dimensions())
    assert read_latest(spark, lake, "kpi_airline_volumes").first().airline_icao == "FIN"

    history = run_plans.run_history(read_run_metrics(spark, lake.run_metrics)).collect()
    assert [(r.batch_id, r.flights, r.pct_valid, r.status) for r in history] == [
        ("r2", 1, 100.0, "success"), ("r1", 4, 75.0, "success")]

    loaded = replay(spark, lake, later + timedelta(hours=2), *dimensions())
    assert {r.flight_id: r.aircraft_code for r in loaded.silver.collect()} == {
        "A": "A321", "B": "B738", "C": "B739", "D": "B739"}
    assert read_latest(spark, lake, "kpi_airline_volumes").first().airline_icao == "ASA"
