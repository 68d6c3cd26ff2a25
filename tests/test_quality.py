from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skytally.operators.quality import flag_counts, flag_quality, quality_profile
from skytally.sinks.reports import quality_report

INVALID = {
    "flight_id": "bad", "airline_icao": "", "aircraft_code": " ", "origin_iata": None,
    "altitude": 50_000.5,
}


@pytest.mark.parametrize(("change", "flags"), [
    ({}, None),
    ({"origin_iata": None}, "MISSING_ORIGIN"),
    ({"origin_iata": "   "}, "MISSING_ORIGIN"),
    ({"destination_iata": None}, "MISSING_DESTINATION"),
    ({"destination_iata": ""}, "MISSING_DESTINATION"),
    ({"airline_icao": None}, "MISSING_AIRLINE"),
    ({"aircraft_code": None}, "MISSING_AIRCRAFT_CODE"),
    ({"aircraft_code": "N/A"}, None),
    ({"latitude": None}, "MISSING_POSITION,INCONSISTENT_POSITION"),
    ({"longitude": None}, "MISSING_POSITION,INCONSISTENT_POSITION"),
    ({"latitude": 90.01}, "INCONSISTENT_POSITION"),
    ({"longitude": -180.5}, "INCONSISTENT_POSITION"),
    ({"latitude": 90.0, "longitude": -180.0}, None),
    ({"altitude": 50_001.0}, "INVALID_ALTITUDE"),
    ({"altitude": -0.5}, "INVALID_ALTITUDE"),
    ({"altitude": None}, "INVALID_ALTITUDE"),
    ({"altitude": float("nan")}, "INVALID_ALTITUDE"),
    ({"altitude": 0.0}, None),
    ({"altitude": 50000.0}, None),
    ({"ground_speed": 600.5}, "INVALID_GROUND_SPEED"),
    ({"ground_speed": None}, "INVALID_GROUND_SPEED"),
    ({"ground_speed": 600.0}, None),
    (INVALID, "MISSING_ORIGIN,MISSING_AIRLINE,MISSING_AIRCRAFT_CODE,INVALID_ALTITUDE"),
])
def test_flags(observations, change, flags):
    row = flag_quality(observations(change)).first()
    assert row.data_quality_flags == flags
    assert row.is_valid is (flags is None)


@pytest.mark.parametrize("on_ground", [1, None])
def test_only_airborne_flights_are_judged_and_valid(observations, on_ground):
    change = {"on_ground": on_ground, "altitude": -1.0, "latitude": None, "ground_speed": None}
    row = flag_quality(observations(change)).first()
    assert row.data_quality_flags is None
    assert row.is_valid is False


def test_codes_are_normalised(observations):
    row = flag_quality(observations({"origin_iata": " osl", "airline_icao": "sas "})).first()
    assert (row.origin_iata, row.airline_icao) == ("OSL", "SAS")


def test_profile(observations):
    flagged = flag_quality(observations({}, INVALID, {"on_ground": 1}, {"on_ground": None}))
    row = quality_profile(flagged).first()
    assert row.asDict() == {
        "total_rows": 4, "valid_rows": 1, "on_ground": 1, "on_flight": 2, "missing_origin": 1,
        "missing_destination": 0, "missing_airline": 1, "missing_aircraft": 1, "pct_valid": 25.0,
        "pct_on_ground": 25.0, "low_quality": True,
    }
    assert not quality_profile(flagged, min_pct_valid=25).first().low_quality


def test_empty_input_has_an_empty_profile(observations):
    flagged = flag_quality(observations().limit(0))
    assert quality_profile(flagged).count() == 0
    assert flag_counts(flagged).count() == 0


def test_flag_counts_and_report(observations):
    flagged = flag_quality(observations({}, INVALID, {"altitude": -1.0}, {"origin_iata": ""}))
    counts = [tuple(r) for r in flag_counts(flagged).collect()]
    assert counts == [
        ("INVALID_ALTITUDE", 2), ("MISSING_ORIGIN", 2), ("MISSING_AIRCRAFT_CODE", 1),
        ("MISSING_AIRLINE", 1)]
    report = quality_report(flagged).first()
    assert [tuple(r) for r in report.top_flags] == counts
    assert report.total_rows == 4


def test_profile_is_one_pass_even_per_group(observations):
    flagged = flag_quality(observations({}, {"batch_id": "b2", "altitude": -1.0}))
    rows = quality_profile(flagged, "batch_id").orderBy("batch_id").collect()
    assert [(r.batch_id, r.valid_rows) for r in rows] == [("b1", 1), ("b2", 0)]


def test_validity_does_not_need_the_flag_text(observations):
    flagged = flag_quality(observations()).where(F.col("is_valid")).select("flight_id")
    assert "concat_ws" not in flagged._jdf.queryExecution().optimizedPlan().toString()
