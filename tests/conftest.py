from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally.schema import FLIGHTS_RAW  # noqa: E402
from skytally.session import build_session  # noqa: E402

RUN_TS = datetime(2026, 6, 21, 14, 30, tzinfo=timezone.utc)

VALID = {
    "extraction_timestamp": RUN_TS, "batch_id": "b1", "source_zone": "europe", "flight_id": "V1",
    "callsign": "SAS77K", "airline_icao": "SAS", "aircraft_code": "AT76", "origin_iata": "BGO",
    "destination_iata": "SVG", "latitude": 59.6, "longitude": 5.4, "altitude": 17250.0,
    "ground_speed": 271.0, "heading": 184.0, "on_ground": 0, "vertical_speed": -320.0,
}

AIRPORT_SPOTS = {
    "YYC": ("CA", "Canada", 51.11, -114.02), "SEA": ("US", "United States", 47.45, -122.31),
    "OSL": ("NO", "Norway", 60.19, 11.10), "SNN": ("IE", "Ireland", 52.70, -8.92),
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def run_ts():
    return RUN_TS


@pytest.fixture
def observations(spark):
    """Build observations from the valid row with some values replaced."""
    def build(*changes: dict):
        rows = [{**dict.fromkeys(FLIGHTS_RAW.names), **VALID, **c} for c in (changes or ({},))]
        return spark.createDataFrame([tuple(r[n] for n in FLIGHTS_RAW.names) for r in rows], FLIGHTS_RAW)
    return build


def flight(flight_id, airline, name, aircraft, origin, destination, **more):
    row = {
        "flight_id": flight_id, "callsign": flight_id, "airline_icao": airline, "airline_name": name,
        "aircraft_code": aircraft, "origin_iata": origin, "destination_iata": destination,
    }
    for end, iata in (("origin", origin), ("destination", destination)):
        code, country, lat, lon = AIRPORT_SPOTS[iata]
        row |= {f"{end}_airport_country_code": code, f"{end}_airport_country_name": country,
                f"{end}_airport_latitude": lat, f"{end}_airport_longitude": lon}
    return {**row, **more}


FOUR_FLIGHTS = (
    flight("H1", "ACA", "Air Canada", "E190", "YYC", "OSL"),   # 6,702.501 km
    flight("H2", "SAS", "Scandinavian", "AT76", "OSL", "SNN"),  # 1,476.536 km
    flight("H3", "SAS", "Scandinavian", "A20N", "OSL", "SEA"),  # 7,328.759 km
    flight("H4", "SAS", "Scandinavian", "AT76", "SNN", "OSL"),
)


@pytest.fixture
def rows_of():
    """Collected rows as sorted tuples of the named columns."""
    def rows(df, *columns):
        return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    return rows
