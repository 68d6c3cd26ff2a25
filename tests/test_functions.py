from __future__ import annotations

import math
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skytally.functions import (
    continent_code, continent_name, country_code_of_name, great_circle_km, manufacturer,
    normalize_code, partition_label_path, partition_labels, percent, to_double, to_int,
)
from skytally.functions.codes import instant
from skytally.functions.reference import (
    CODE_OF_COUNTRY_NAME, CODE_OF_NAME_KEY, CONTINENT_NAMES, CONTINENT_OF_COUNTRY,
)
from skytally.layout import Lake


def values(spark, expression, inputs, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_every_named_country_has_a_continent_with_a_name():
    assert set(CODE_OF_NAME_KEY.values()) <= CONTINENT_OF_COUNTRY.keys()
    assert set(CONTINENT_OF_COUNTRY.values()) <= CONTINENT_NAMES.keys()


def test_every_country_name_resolves(spark):
    names = [*CODE_OF_COUNTRY_NAME, *(n.upper().replace(" ", "-") for n in CODE_OF_COUNTRY_NAME)]
    assert values(spark, country_code_of_name, names) == list(CODE_OF_COUNTRY_NAME.values()) * 2


def test_unknown_country_names_have_no_code(spark):
    # accented letters are dropped, not folded
    assert values(spark, country_code_of_name, ["Atlantis", "", None, "Côte d'Ivoire"]) == [None] * 4


def test_continent_of_every_country(spark):
    codes = list(CONTINENT_OF_COUNTRY)
    assert values(spark, continent_code, [c.lower() for c in codes]) == list(CONTINENT_OF_COUNTRY.values())
    assert values(spark, continent_code, ["ZZ", "", None]) == ["UNKNOWN"] * 3
    assert values(spark, continent_name, [*CONTINENT_NAMES, "XX", None]) == [
        *CONTINENT_NAMES.values(), None, None]


@pytest.mark.parametrize(("code", "name"), [
    ("BCS3", "Airbus"), ("B738", "Boeing"), ("b738", "Boeing"), ("CRJ9", "Bombardier"),
    ("CL60", "Bombardier"), ("DH8D", "De Havilland Canada"), ("AT76", "ATR"), ("A320", "Airbus"),
    ("E190", "Embraer"), ("E290", "Embraer"), ("EMB1", "Embraer"), ("E300", "Other"),
    ("MD11", "McDonnell Douglas"), ("M", "Other"), ("F100", "Fokker"), ("SU95", "Sukhoi"),
    ("AN26", "Antonov"), ("IL96", "Ilyushin"), ("TU54", "Tupolev"), ("C172", "Other"),
    ("B", "Boeing"), ("", "Other"), (None, "Other"),
])
def test_manufacturer(spark, code, name):
    assert values(spark, manufacturer, [code]) == [name]


def test_to_double(spark):
    given = ["12.5", " 12 ", "1e3", "-3", "N/A", "", None, "x", "7d", "7f", "0x1p3", "12e", "inf"]
    assert values(spark, to_double, given) == [
        12.5, 12.0, 1000.0, -3.0, None, None, None, None, None, None, None, None, math.inf]
    assert math.isnan(values(spark, to_double, ["nan"])[0])


def test_to_int(spark):
    assert values(spark, to_int, ["1", " 0 ", "1.0", "N/A", "", None, "x"]) == [
        1, 0, None, None, None, None, None]
    assert values(spark, to_int, [1.7, -1.7, None], "double") == [1, -1, None]


def test_normalize_code_trims_spaces_only(spark):
    assert values(spark, normalize_code, [" dal ", "\tdal", "", None, "n/a"]) == [
        "DAL", "\tDAL", "", None, "N/A"]


def test_percent_rounds_ties_to_even_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 80), (3, 80), (0, 0), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [1.2, 3.8, 0.0, 33.3]


def test_partition_labels(spark, run_ts):
    row = spark.range(1).select(*(
        c.alias(n) for n, c in partition_labels(instant(run_ts)).items())).first()
    assert row.asDict() == {
        "tech_year": "2026", "tech_month": "2026-06", "tech_day": "2026-06-21", "tech_hour": "14"}
    assert partition_label_path(run_ts) == \
        "tech_year=2026/tech_month=2026-06/tech_day=2026-06-21/tech_hour=14"
    paris = run_ts.astimezone(timezone(timedelta(hours=2)))
    assert partition_label_path(paris) == partition_label_path(run_ts)
    assert Lake("/x").quality_report(paris) == "/x/gold/_quality_logs/2026-06-21/14"
    assert spark.range(1).select(instant(run_ts) == instant(run_ts.replace(tzinfo=None))).first()[0]


def test_great_circle(spark):
    columns = [F.col(c) for c in "abcd"]
    df = spark.createDataFrame([
        (40.64, -73.78, 33.94, -118.41), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0),
        (None, 0.0, 0.0, 0.0), (0.0, 0.0, None, 0.0), (0.0, None, 0.0, 0.0), (0.0, 0.0, 0.0, None),
    ], "a double, b double, c double, d double")
    km = [r[0] for r in df.select(great_circle_km(*columns)).collect()]
    assert km[0] == pytest.approx(3974, abs=5)
    assert km[1] == pytest.approx(math.pi * 6371.0)
    assert km[2] == 0.0
    assert km[3:] == [None] * 4


def test_antipodes_never_leave_the_domain(spark):
    df = spark.range(-90, 91).select(F.col("id").cast("double").alias("a")).crossJoin(
        spark.range(0, 360, 7).select((F.col("id") - 180).cast("double").alias("b")))
    km = great_circle_km(F.col("a"), F.col("b"), -F.col("a"), F.col("b") + 180)
    assert df.where(km.isNull() | F.isnan(km)).count() == 0
