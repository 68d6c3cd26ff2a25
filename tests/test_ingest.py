"""Quarantine, zones on a grid, airports over several lines, incremental run documents."""

from __future__ import annotations

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from skytally.layout import Lake
from skytally.operators.zones import GLOBAL_ZONE, Box, union_zone_table, union_zones, zone_cells, zone_table
from skytally.plans.batch import RunSettings, run_batch
from skytally.schema import FLIGHTS_RAW
from skytally.sources import feed as feeds
from skytally.sources import reference_files as refs
from skytally.sources.runs import read_run_metrics, refresh_run_index


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- quarantine --------------------------------------------------------------------------

LINES = ['{"id":"a","callsign":"A","altitude":"N/A"}', '{"id":"b","on_ground":1.7}', "{cut", '{"callsign":"keyless"}', "", "[1", '{"id":null}']


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "feed.json").write_text("\n".join(LINES))
    return str(tmp_path / "landing")


def test_one_pass_splits_observations_and_rejects(spark, lake, landing, run_ts):
    landed = feeds.read_feed(spark, landing)
    staged = feeds.stage_feed(landed, lake, run_ts, "b1")
    wanted = feeds.to_observations(landed, run_ts, "b1")
    assert staged.observations.columns == FLIGHTS_RAW.names
    assert sorted(map(str, staged.observations.collect())) == sorted(map(str, wanted.collect()))
    assert sum(staged.rejected_rows.values()) == feeds.rejected(landed).count()
    assert staged.rejected_rows == {"malformed": 2, "no_key": 2}
    rejects = feeds.read_quarantine(spark, lake)
    assert sorted((r.batch, r.reason, r.record, r.callsign, r.tech_hour) for r in rejects.collect() if r.record or r.callsign) == [
        ("b1", "malformed", "[1", None, "14"), ("b1", "malformed", "{cut", None, "14"), ("b1", "no_key", None, "keyless", "14")]
    assert "outcome" in plan_of(rejects)[plan_of(rejects).index("PartitionFilters"):]


def test_staging_again_replaces(spark, lake, landing, run_ts):
    for batch in ("b1", "b/2", "b1"):
        feeds.stage_feed(feeds.read_feed(spark, landing), lake, run_ts, batch)
    assert {(r.batch, r["count"]) for r in feeds.read_quarantine(spark, lake).groupBy("batch").count().collect()} == {("b1", 4), ("b/2", 4)}


def test_rejects_are_counted_in_the_run_document(spark, lake, tmp_path, run_ts):
    for zone in ("north", "south"):
        folder = tmp_path / "zones" / f"zone={zone}"
        folder.mkdir(parents=True)
        (folder / "feed.json").write_text("\n".join([*LINES, json.dumps({"id": zone})]))
    staged = feeds.stage_zones(spark, str(tmp_path / "zones"), ["north", "south"], lake, run_ts, "b1")
    assert sorted(r.flight_id for r in staged.observations.collect()) == ["a", "b", "north", "south"]
    assert run_batch(staged.observations, lake, run_ts, "b1", settings=RunSettings(load_silver_gold=False),
                     rejected_rows=sum(staged.rejected_rows.values()))
    run = read_run_metrics(spark, lake.run_metrics).first()
    assert (run.extraction.rows, run.extraction.rejected_rows) == (4, 8)
    assert {r.source_zone for r in feeds.read_quarantine(spark, lake).collect()} == {"north", "south"}


def test_no_feed_and_nothing_rejected(spark, lake, tmp_path, run_ts):
    assert feeds.read_quarantine(spark, lake).count() == 0
    staged = feeds.stage_zones(spark, str(tmp_path / "none"), ["north"], lake, run_ts, "b1")
    assert staged.observations.count() == 0 and staged.rejected_rows == {"malformed": 0, "no_key": 0}
    assert feeds.read_quarantine(spark, lake).count() == 0


# --- zones -------------------------------------------------------------------------------

BOXES = {
    "europe": Box(72.0, 35.0, -12.0, 40.0), "point": Box(10.0, 10.0, 20.0, 20.0), "world": Box(90.0, -90.0, -180.0, 180.0),
    "pacific": Box(60.0, -60.0, 150.0, -150.0), "beyond": Box(1e9, 80.0, -1e9, 1e9), "upside": Box(0.0, 10.0, 0.0, 10.0),
    "edge": Box(20.0, 10.0, 30.0, 40.0), "dateline": Box(90.0, -90.0, 180.0, -180.0),
}


@pytest.fixture
def positions(observations):
    rng = random.Random(3)
    spots = [(None, 0.0), (0.0, None), (float("nan"), 5.0), (5.0, float("nan")), (10.0, 20.0), (90.0, 180.0), (-90.0, -180.0), (92.5, 200.0),
             (-95.0, -500.0), (20.0, 40.0), (10.0, 30.0), (0.0, 180.0), (0.0, -180.0), (0.0, 150.0), (0.0, -150.0), (1e8, 1e8)]
    spots += [(rng.choice([10.0, 20.0, rng.uniform(-95, 95)]), rng.choice([30.0, -150.0, rng.uniform(-190, 190)])) for _ in range(300)]
    return observations(*({"flight_id": f"f{i}", "latitude": lat, "longitude": lon} for i, (lat, lon) in enumerate(spots)))


def hits(df):
    return sorted((r.flight_id, r.source_zone) for r in df.select("flight_id", "source_zone").collect())


@pytest.mark.parametrize("degrees", [10.0, 7.0, 180.0])
def test_grid_gives_the_rows_of_testing_every_box(spark, positions, degrees):
    table = zone_table(spark, BOXES)
    assert hits(union_zone_table(positions, table, degrees=degrees)) == hits(union_zones(positions, BOXES, list(BOXES)))
    some = ["europe", "pacific", "nowhere", GLOBAL_ZONE]
    assert hits(union_zone_table(positions, table, some, degrees)) == hits(union_zones(positions, BOXES, some))
    assert union_zone_table(positions, table, ["nowhere"]).count() == 0
    assert union_zone_table(positions, table).columns == positions.columns


def test_boxes_cross_the_date_line(observations):
    feed = observations(*({"flight_id": str(x), "latitude": 0.0, "longitude": float(x)} for x in (149, 150, 179, 180, -180, -150, -149, 0)))
    assert [f for f, _ in hits(union_zones(feed, BOXES, ["pacific"]))] == sorted(map(str, (150, 179, 180, -180, -150)))


def test_many_zones_meet_rows_in_a_hash_join_of_their_cells(spark, positions):
    rng, boxes = random.Random(4), {}
    for i in range(3000):
        y, x = rng.uniform(-90, 85), rng.uniform(-180, 175)
        boxes[f"z{i}"] = Box(y + rng.uniform(0, 5), y, x, x + rng.uniform(0, 5))
    table = zone_table(spark, boxes)
    assert zone_cells(table).count() < 4 * len(boxes)
    found = union_zone_table(positions, table)
    plan = plan_of(found)
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = sorted((r.flight_id, n) for r in positions.collect() for n, b in boxes.items()
                  if r.latitude is not None and r.longitude is not None and b.y2 <= r.latitude <= b.y1 and b.x1 <= r.longitude <= b.x2)
    assert hits(found) == want


# --- airports ----------------------------------------------------------------------------

def test_quoted_fields_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "airports.dat").write_text(
        '1,"Main\nhall, ""A""","X","Norway","OSL","ENGM",60.2,11.1,1,1,"E","Z","airport","O"\n'
        '2,"Plain","X","Ireland","SNN","EINN",52.7,-8.9,1,1,"E","Z","airport","O"\n'
        '3,"Short\nline","X","Ireland","SHO","EISH",1.5\n'
        '4,"Eight\nfields","X","Ireland","EIG","EIEG",1.5,2.5\n')
    rows = {r.airport_iata: (r.airport_name, r.latitude) for r in refs.read_airports_csv(spark, str(tmp_path)).collect()}
    assert rows == {"OSL": ('Main\nhall, "A"', 60.2), "SNN": ("Plain", 52.7), "EIG": ("Eight\nfields", 1.5)}


# --- run documents -----------------------------------------------------------------------

def test_second_refresh_opens_only_new_files(spark, tmp_path):
    logs, index = tmp_path / "logs" / "deep", str(tmp_path / "index")
    logs.mkdir(parents=True)

    def document(name, age, text=None):
        path = logs / f"{name}.json"
        path.write_text(text or json.dumps({"batch_id": name, "status": "success"}, indent=1))
        at = time.time() - age
        os.utime(path, (at, at))

    def refreshed():
        return sorted(r.batch_id for r in refresh_run_index(spark, str(tmp_path / "logs"), index).collect())

    assert refresh_run_index(spark, str(tmp_path / "none"), str(tmp_path / "no-index")).count() == 0
    document("r1", 5000)
    document("r2", 4000)
    document("bad", 4500, "{cut")
    assert refreshed() == ["r1", "r2"]
    os.chmod(logs / "r1.json", 0)
    (logs / "r1.json").write_bytes(b"")          # an old file is not opened again
    at = time.time() - 5000
    os.utime(logs / "r1.json", (at, at))
    document("r3", 10)
    document("r4", 3998)                          # came within the seconds of the last refresh
    assert refreshed() == ["r1", "r2", "r3", "r4"]
    assert refreshed() == ["r1", "r2", "r3", "r4"]
    whole = refresh_run_index(spark, str(tmp_path / "logs"), index)
    assert whole.columns == read_run_metrics(spark, str(tmp_path / "logs")).columns
    assert whole.agg(F.count("file_modified")).first()[0] == 4
