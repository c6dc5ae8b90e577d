"""Distinct counts from day bitmaps."""

import os

import pytest

from tripmart.operators.distinct import day_bitmaps, distinct_from_bitmaps
from tripmart.plans import taxi_days

FACTS = "trip_date string, company_id long, taxi_id string"


def _facts(spark, rows):
    return spark.createDataFrame(rows, FACTS).selectExpr("CAST(trip_date AS date) AS trip_date", "company_id", "taxi_id")


def _counts(spark, base, where="true"):
    days = taxi_days.read_days(spark, base).where(where)
    return {r.company_id: r.n for r in distinct_from_bitmaps(days, ["company_id"], "n").collect()}


def test_a_delivery_numbers_new_taxis_and_writes_its_days_only(spark, tmp_dir):
    taxi_days.add_days(_facts(spark, [("2024-01-01", 1, "a"), ("2024-01-01", 1, "a"), ("2024-01-01", 2, "b"),
                                      ("2024-01-01", None, "x"), ("2024-01-01", 1, None)]), tmp_dir)
    first = tmp_dir.removeprefix("file:") + "/days/trip_date=2024-01-01"
    before = sorted(os.listdir(first))
    taxi_days.add_days(_facts(spark, [("2024-01-02", 1, "a"), ("2024-01-02", 1, "c")]), tmp_dir)
    assert sorted(os.listdir(first)) == before
    assert _counts(spark, tmp_dir) == {1: 2, 2: 1}
    assert _counts(spark, tmp_dir, "trip_date = DATE '2024-01-01'") == {1: 1, 2: 1}
    ids = spark.read.parquet(f"{tmp_dir}/ids").collect()
    assert sorted(r.taxi_no for r in ids) == [1, 2, 3] and {r.taxi_id for r in ids} == {"a", "b", "c"}


def test_a_day_delivered_again_replaces_itself(spark, tmp_dir):
    taxi_days.add_days(_facts(spark, [("2024-01-01", 1, "a"), ("2024-01-01", 1, "b"), ("2024-01-02", 1, "a")]), tmp_dir)
    taxi_days.add_days(_facts(spark, [("2024-01-01", 1, "c")]), tmp_dir)
    assert _counts(spark, tmp_dir) == {1: 2}                          # a of the second day, c of the first
    assert _counts(spark, tmp_dir, "trip_date = DATE '2024-01-01'") == {1: 1}


@pytest.mark.parametrize("n", [32_768, 100_000])
def test_members_beyond_one_bucket(spark, n):
    ids = spark.range(1, n + 1).selectExpr("id AS no", "id * 7 AS member")
    members = ids.selectExpr("member", "member % 2 AS k")
    bitmaps = day_bitmaps(members, ids, ["k"], "member", "no")
    assert {r.k: r.n for r in distinct_from_bitmaps(bitmaps, ["k"], "n").collect()} == {0: n // 2, 1: n - n // 2}
    assert bitmaps.select("bucket").distinct().count() == -(-n // 32_768)


def test_a_span_of_days_opens_its_folders_only(spark, tmp_dir):
    taxi_days.add_days(_facts(spark, [(f"2024-01-0{d}", 1, f"t{d}") for d in range(1, 6)]), tmp_dir)
    days = taxi_days.read_days(spark, tmp_dir).where("trip_date >= DATE '2024-01-04'")
    assert len(days.select("_metadata.file_path").distinct().collect()) == 2
    company = spark.createDataFrame([(1, "C")], "company_id long, company string")
    assert [tuple(r) for r in taxi_days.taxis_per_company(days, company, 8).collect()] == [("C", 2)]


def test_empty_delivery(spark, tmp_dir):
    taxi_days.add_days(_facts(spark, [("2024-01-01", 1, "a")]), tmp_dir)
    taxi_days.add_days(_facts(spark, [("2024-01-01", 1, "a")]).where("false"), tmp_dir)
    assert _counts(spark, tmp_dir) == {1: 1}
