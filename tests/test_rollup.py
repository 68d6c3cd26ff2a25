"""KPIs and dimensions of the roll-up against those of the fact; sketches against exact counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import FOUR_FLIGHTS, RUN_TS

from skytally.layout import Lake
from skytally.operators import kpis
from skytally.operators.dimensions import choose_dimensions
from skytally.operators.enrich import derive_columns
from skytally.operators.profile import dimension_cardinality
from skytally.operators.quality import flag_quality
from skytally.operators.rollup import SETS, RolledUp, dimensions_of_rollup, kpis_of_rollup, roll_up
from skytally.operators.sketches import merged_counts, read_run_sketches, run_sketches, write_run_sketches
from skytally.plans.batch import RunSettings, run_batch

SPOTS = [("YYC", "CA", "Canada", 51.11, -114.02), ("OSL", "NO", "Norway", 60.19, 11.1), ("SNN", "IE", "Ireland", 52.7, -8.92),
         ("XXX", None, None, None, None), ("", "NO", "Norway", 60.0, 10.0), (None, "CA", "Kanada", None, None)]


def random_flights(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        row = {"flight_id": f"F{i}", "callsign": f"C{i}", "airline_icao": rng.choice(["SAS", "ACA", "", None, "DLH"]),
               "airline_name": rng.choice([None, "One", "Two"]), "airline_iata": rng.choice([None, "S1"]),
               "aircraft_code": rng.choice(["A320", "B738", "", None, "ZZZ"]), "aircraft_model": rng.choice([None, "m"]),
               "on_ground": rng.choice([0, 0, 0, 1, None]), "altitude": rng.choice([100.0, 100.0, -5.0])}
        for end in ("origin", "destination"):
            iata, code, country, lat, lon = rng.choice(SPOTS)
            row |= {f"{end}_iata": iata, f"{end}_airport_country_code": code, f"{end}_airport_country_name": country,
                    f"{end}_airport_latitude": lat, f"{end}_airport_longitude": lon, f"{end}_airport_name": rng.choice([None, "n"])}
        out.append(row)
    return out


def normal(df):
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("rows", [random_flights(200, 1), random_flights(7, 2), list(FOUR_FLIGHTS), random_flights(1, 3), []])
def test_same_kpis_and_dimensions_as_from_the_fact(spark, tmp_path, observations, rows):
    facts = derive_columns(flag_quality(observations(*rows) if rows else observations().limit(0)))
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.schema(facts.schema).parquet(str(tmp_path / "facts"))
    rolled = RolledUp(facts, str(tmp_path / "rollup"))
    for name, table in kpis_of_rollup(rolled, spark, RUN_TS).items():
        wanted = kpis.KPIS[name](facts, RUN_TS)
        assert dict(table.dtypes) == dict(wanted.dtypes), name
        assert normal(table) == normal(wanted), name
    for name, table in dimensions_of_rollup(rolled, RUN_TS).items():
        assert normal(table) == normal(choose_dimensions(facts, RUN_TS)[name]), name


def test_one_scan_combined_before_the_shuffle(spark, tmp_path, observations):
    facts = derive_columns(flag_quality(observations()))
    facts.write.parquet(str(tmp_path / "facts"))
    plan = roll_up(spark.read.schema(facts.schema).parquet(str(tmp_path / "facts")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Expand") == 1 and "SortAggregate" not in plan
    assert plan.index("Exchange") < plan.index("partial_count_if" if "partial_count_if" in plan else "partial_count")


def test_sets_are_told_apart_when_keys_are_null(observations):
    facts = derive_columns(flag_quality(observations(*random_flights(50, 4))))
    groups = roll_up(facts).collect()
    for name, keys in SETS.items():
        own = [r for r in groups if r["set"] == name]
        assert len(own) == facts.select(*keys).distinct().count()
        assert sum(r.valid for r in own) == facts.where("is_valid").count()


def test_a_batch_scans_its_fact_once_for_gold(spark, tmp_path, observations, monkeypatch):
    """All KPIs of a run come from the stored roll-up."""
    lake = Lake(str(tmp_path / "lake"))
    assert run_batch(observations(*FOUR_FLIGHTS), lake, RUN_TS, "b1")
    groups = spark.read.option("recursiveFileLookup", True).parquet(lake.rollup)
    assert groups.where("set = 'carrier'").agg(F.sum("active")).first()[0] == 4


def test_sketches_merge_to_counts_over_runs(spark, tmp_path):
    lake, rng = Lake(str(tmp_path / "lake")), random.Random(6)
    names = "batch_id string, airline_icao string, origin_iata string, destination_iata string, aircraft_code string"
    rows = [(f"b{i % 6}", rng.choice([None, "", f"A{rng.randrange(30_000)}"]), f"O{rng.randrange(20_000)}", f"O{rng.randrange(25_000)}",
             rng.choice(["", "B738", "A320", None])) for i in range(60_000)]
    df = spark.createDataFrame(rows, names).repartition(4)
    for b in range(6):
        for _ in range(2):  # a repeated run replaces its sketches
            write_run_sketches(run_sketches(df.where(f"batch_id = 'b{b}'"), "batch_id"), lake, f"tech_year=2026/tech_month=2026-0{b + 1}"
                               f"/tech_day=2026-0{b + 1}-01/tech_hour=10", f"b{b}")
    stored = read_run_sketches(spark, lake)
    for some in ("true", "tech_month <= '2026-03'", "batch in ('b1', 'b4')"):
        batches = [r.batch for r in stored.where(some).select("batch").collect()]
        part = df.where(F.col("batch_id").isin(batches))
        got, exact = merged_counts(stored.where(some)).first(), dimension_cardinality(part).first()
        assert got.row_count == part.count()
        assert got.unique_aircraft == exact.unique_aircraft == 3
        for kind in ("unique_airlines", "unique_airports"):
            assert got[kind] == pytest.approx(exact[kind], rel=0.05)  # three standard errors


def test_sketches_of_nothing(spark, tmp_path, observations):
    lake = Lake(str(tmp_path / "lake"))
    assert read_run_sketches(spark, lake).count() == 0
    nobody = observations({"airline_icao": None, "origin_iata": None, "destination_iata": None, "aircraft_code": None})
    row = merged_counts(run_sketches(nobody, "batch_id")).first()
    assert (row.row_count, row.unique_airlines, row.unique_airports, row.unique_aircraft) == (1, 0, 0, 0)
    assert run_batch(observations(*FOUR_FLIGHTS), lake, RUN_TS, "x/y", settings=RunSettings(load_silver_gold=False))
    row = merged_counts(read_run_sketches(spark, lake).where("batch = 'x/y'")).first()
    assert (row.row_count, row.unique_airlines, row.unique_airports, row.unique_aircraft) == (4, 2, 4, 4 - 1)
