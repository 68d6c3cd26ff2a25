from __future__ import annotations

from datetime import timedelta

import pytest
from tests.conftest import FOUR_FLIGHTS, flight
from pyspark.sql import functions as F

from skytally.operators import kpis
from skytally.operators.dimensions import (
    aircraft_models_of_facts, airlines_of_facts, airports_of_facts, choose_dimensions,
    countries_of_facts, row_counts,
)
from skytally.operators.enrich import derive_columns, fill_from_dimensions
from skytally.operators.pick import latest_per_flight, most_complete_per_key
from skytally.operators.quality import flag_quality
from skytally.plans.gold import gold_tables
from skytally.plans.silver import silver_fact


@pytest.fixture
def silver(observations):
    def build(*rows):
        return silver_fact(flag_quality(observations(*rows)))
    return build


@pytest.fixture
def airports(spark):
    return spark.createDataFrame([
        ("OSL", "Norway", "NO", 60.19, 11.10), ("SEA", "United States", "US", 47.45, -122.31),
    ], "airport_iata string, country_name string, country_code string, latitude double, longitude double")


@pytest.fixture
def airlines(spark):
    return spark.createDataFrame([("SAS", "Scandinavian")], "airline_icao string, airline_name string")


def test_silver_derives_columns(silver):
    rows = silver(*FOUR_FLIGHTS).orderBy("flight_id").collect()
    assert [(r.origin_continent, r.destination_continent, r.manufacturer, round(r.distance_km, 3)) for r in rows] == [
        ("NA", "EU", "Embraer", 6702.501), ("EU", "EU", "ATR", 1476.536), ("EU", "NA", "Airbus", 7328.759),
        ("EU", "EU", "ATR", 1476.536)]


def test_latest_observation_wins(silver, run_ts):
    seen = [flight("S", "SAS", "Scandinavian", "AT76", "OSL", "SNN", altitude=1000.0 * i,
                   extraction_timestamp=run_ts + timedelta(minutes=minute)) for i, minute in enumerate((7, 41, 40, -3), 1)]
    for order in (seen, seen[::-1]):
        assert [r.altitude for r in silver(*order).collect()] == [2000.0]


def test_equal_timestamps_resolve_the_same_way_in_any_order(observations):
    rows = [{"callsign": c, "altitude": a} for c, a in (("A", 1.0), ("B", None), ("B", 2.0))]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        row, = latest_per_flight(observations(*order)).collect()
        assert (row.callsign, row.altitude) == ("B", 2.0)


def test_enrichment_fills_only_null(observations, airports, airlines):
    facts = observations(
        {"flight_id": "1", "airline_icao": "SAS", "origin_iata": "OSL", "destination_iata": "SEA"},
        {"flight_id": "2", "airline_icao": "XXX", "origin_iata": "ZZZ", "destination_iata": "SEA",
         "airline_name": "", "destination_airport_country_code": "CA"},
    )
    one, two = fill_from_dimensions(facts, airports, airlines).orderBy("flight_id").collect()
    assert (one.airline_name, one.origin_airport_country_code, one.origin_airport_country_name,
            one.origin_airport_latitude) == ("Scandinavian", "NO", "Norway", 60.19)
    assert one.destination_airport_country_code == "US"
    assert (two.airline_name, two.origin_airport_country_code) == ("", None)
    assert two.destination_airport_country_code == "CA"
    assert two.destination_airport_country_name == "United States"


def test_duplicate_dimension_keys_do_not_multiply_facts(observations, airports, airlines):
    twice = airlines.union(airlines.withColumn("airline_name", F.lit("Zephyr")))
    facts = observations({"airline_icao": "SAS", "origin_iata": "OSL"})
    rows = fill_from_dimensions(facts, airports.union(airports), twice).collect()
    assert [r.airline_name for r in rows] == ["Zephyr"]


def test_no_dimension_no_change(observations):
    facts = observations()
    assert fill_from_dimensions(facts) is facts


def test_unused_lookups_leave_the_plan(observations, airports, airlines):
    filled = fill_from_dimensions(
        observations(), airports, airlines, broadcast_limit=2**63).select("flight_id")
    assert "Join" not in filled._jdf.queryExecution().optimizedPlan().toString()


def test_four_flight_kpis(silver, run_ts):
    """Every KPI of the four flights, worked out by hand."""
    gold = {name: [tuple(r)[:-1] for r in table.collect()]      # without computed_at
            for name, table in gold_tables(silver(*FOUR_FLIGHTS), run_ts).items()}
    stats = {r[0]: (*(round(x, 3) for x in r[1:4]), r[4]) for r in gold.pop("kpi_continental_avg_distance")}
    assert stats == {"NA": (6702.501, 6702.501, 6702.501, 1), "EU": (3427.277, 1476.536, 7328.759, 3)}
    ((*longest, km),) = gold.pop("kpi_longest_flight")
    assert (longest, round(km, 3)) == (["H3", "SAS", "Scandinavian", "OSL", "SEA"], 7328.759)
    assert sorted(gold.pop("kpi_airline_aircraft_top3")) == [
        ("CA", "E190", 1, 1), ("IE", "AT76", 1, 1), ("NO", "A20N", 1, 1), ("NO", "AT76", 1, 2)]
    assert gold == {
        "kpi_airline_volumes": [("SAS", "Scandinavian", 3)],
        "kpi_continental_regional": [("EU", "SAS", "Scandinavian", 2)],
        "kpi_aircraft_manufacturers": [("ATR", 2)],
        "kpi_airport_imbalance": [("SEA", 0, 1, -1, 1)],        # YYC is +1; the alphabet decides
    }
    volume = gold_tables(silver(*FOUR_FLIGHTS), run_ts)["kpi_airline_volumes"].first()
    assert volume.computed_at == run_ts.replace(tzinfo=None)


def test_output_columns(silver, run_ts):
    columns = {n: t.columns for n, t in gold_tables(silver(*FOUR_FLIGHTS), run_ts).items()}
    assert columns == {
        "kpi_airline_volumes": ["airline_icao", "airline_name", "active_flights_count", "computed_at"],
        "kpi_continental_regional": ["origin_continent", "airline_icao", "airline_name",
                                     "regional_flights_count", "computed_at"],
        "kpi_longest_flight": ["callsign", "airline_icao", "airline_name", "origin_iata",
                               "destination_iata", "distance_km", "computed_at"],
        "kpi_continental_avg_distance": ["origin_continent", "avg_distance_km", "min_distance_km",
                                         "max_distance_km", "flight_count", "computed_at"],
        "kpi_aircraft_manufacturers": ["manufacturer", "active_flights_count", "computed_at"],
        "kpi_airline_aircraft_top3": ["origin_airport_country_code", "aircraft_code", "usage_count",
                                      "rank", "computed_at"],
        "kpi_airport_imbalance": ["airport_iata", "departures", "arrivals", "imbalance",
                                  "imbalance_abs", "computed_at"],
    }


def test_circular_flights_have_no_distance_statistics_but_count_at_their_airport(silver, run_ts):
    facts = silver(flight("R", "SAS", "Scandinavian", "AT76", "OSL", "OSL"))
    assert kpis.continental_avg_distance(facts, run_ts).count() == 0
    assert kpis.longest_flight(facts, run_ts).count() == 0
    (balance,) = kpis.airport_imbalance(facts, run_ts).collect()
    assert (balance.departures, balance.arrivals, balance.imbalance_abs) == (1, 1, 0)


@pytest.mark.parametrize("change", [{"on_ground": 1}, {"on_ground": None}, {"altitude": -5.0}])
def test_grounded_or_invalid_flights_are_left_out(silver, run_ts, change):
    facts = silver(*({**f, **change} for f in FOUR_FLIGHTS))
    assert {n: t.count() for n, t in gold_tables(facts, run_ts).items()} == dict.fromkeys(kpis.KPIS, 0)


def test_unknown_continents_are_not_ranked(silver, run_ts):
    lost = {"origin_airport_country_code": "ZZ", "destination_airport_country_code": "ZZ"}
    facts = silver({**FOUR_FLIGHTS[0], **lost})
    assert kpis.continental_regional(facts, run_ts).count() == 0
    assert kpis.continental_avg_distance(facts, run_ts).count() == 0
    assert kpis.longest_flight(facts, run_ts).count() == 1


def test_ties_follow_the_key(silver, run_ts):
    flights = [flight(f"T{i}", a, a, c, "YYC", "SEA")
               for i, (a, c) in enumerate([("ZZZ", "B738"), ("AAA", "A320"), ("MMM", "MD11")])]
    facts = silver(*flights)
    assert kpis.airline_volumes(facts, run_ts).first().airline_icao == "AAA"
    assert kpis.aircraft_manufacturers(facts, run_ts).first().manufacturer == "Airbus"
    assert kpis.longest_flight(facts, run_ts).first().callsign == "T0"
    assert [(r.aircraft_code, r["rank"]) for r in
            kpis.airline_aircraft_top3(facts, run_ts).orderBy("rank").collect()] == \
        [("A320", 1), ("B738", 2), ("MD11", 3)]


def test_top3_keeps_three_of_four(silver, run_ts):
    codes = ["B738"] * 4 + ["A320"] * 3 + ["MD11"] * 2 + ["F100"]
    facts = silver(*(flight(f"T{i}", "ACA", "Air Canada", c, "YYC", "SEA") for i, c in enumerate(codes)))
    rows = kpis.airline_aircraft_top3(facts, run_ts).orderBy("rank").collect()
    assert [(r.aircraft_code, r.usage_count) for r in rows] == [("B738", 4), ("A320", 3), ("MD11", 2)]


def test_top3_for_country(silver, run_ts):
    top3 = kpis.airline_aircraft_top3(silver(
        *FOUR_FLIGHTS, flight("U", "ACA", "Air Canada", "BCS3", "SEA", "YYC")), run_ts)
    codes = lambda df: [r.aircraft_code for r in df.collect()]
    assert codes(kpis.top3_for_country(top3)) == ["BCS3"]
    assert codes(kpis.top3_for_country(top3, "NO")) == ["A20N", "AT76"]
    no_us = top3.where("origin_airport_country_code <> 'US'")
    assert codes(kpis.top3_for_country(no_us)) == ["E190"]
    assert [r[0] for r in kpis.countries_listed(top3).collect()] == ["CA", "IE", "NO", "US"]


def test_dimensions_of_facts(silver, run_ts, rows_of):
    facts = silver(*FOUR_FLIGHTS)
    assert rows_of(airports_of_facts(facts, run_ts), "airport_iata", "continent_code") == [
        ("OSL", "EU"), ("SEA", "NA"), ("SNN", "EU"), ("YYC", "NA")]
    assert rows_of(airlines_of_facts(facts, run_ts), "airline_icao", "airline_name") == [
        ("ACA", "Air Canada"), ("SAS", "Scandinavian")]
    assert rows_of(aircraft_models_of_facts(facts, run_ts), "aircraft_code", "manufacturer") == [
        ("A20N", "Airbus"), ("AT76", "ATR"), ("E190", "Embraer")]
    assert rows_of(countries_of_facts(facts, run_ts), "country_code", "country_name") == [
        ("CA", "Canada"), ("IE", "Ireland"), ("NO", "Norway"), ("US", "United States")]


def test_dimension_choice_and_counts(silver, run_ts, airlines):
    chosen = choose_dimensions(silver(*FOUR_FLIGHTS), run_ts, airlines=airlines)
    assert {r.name: r.row_count for r in row_counts(chosen).collect()} == {
        "dim_airports": 4, "dim_airlines": 1, "dim_aircraft_models": 3, "dim_countries_continents": 4}


def test_most_complete_row_survives(spark):
    df = spark.createDataFrame([("A", None, "z"), ("A", "n", None), ("A", "b", "y"), ("A", "b", "x")],
                               "k string, p string, q string")
    assert [tuple(r) for r in most_complete_per_key(df, "k", ("p", "q")).collect()] == [("A", "b", "x")]


def test_deriving_is_rowwise(observations):
    row = derive_columns(observations()).first()
    assert (row.origin_continent, row.distance_km) == ("UNKNOWN", None)
