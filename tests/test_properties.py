"""Property tests: random small inputs, each checked against a
plain-Python model of the reference's behaviour."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.functions import rain_class
from tripmart.operators import _plan, dims, profile
from tripmart.schemas import PAYMENT_TYPE_MASTER_SCHEMA

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(keys=st.lists(st.tuples(st.integers(-50, 50), st.text("abc", max_size=3)), min_size=1, max_size=60,
                     unique=True),
       start=st.integers(1, 100), small=st.booleans())
def test_dense_ids_is_row_number(spark, monkeypatch, keys, start, small):
    monkeypatch.setattr(_plan, "ROWS_PER_RANGE", 10**6 if small else 7)
    df = spark.createDataFrame(keys, "a int, b string")
    got = sorted(tuple(r) for r in dims.dense_ids(df, [F.col("a"), F.col("b")], "id", start).collect())
    want = sorted((a, b, start + i) for i, (a, b) in enumerate(sorted(keys)))
    assert got == want


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-1000, 1000).map(lambda x: x / 8)), min_size=1,
                     max_size=80),
       small=st.booleans())
def test_exact_quartiles_equal_pandas(spark, monkeypatch, vals, small):
    monkeypatch.setattr(_plan, "ROWS_PER_RANGE", 10**6 if small else 7)
    if all(v is None for v in vals):
        vals = vals + [0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = profile.exact_quantiles(df, ["x"]).first()
    s = pd.Series(vals, dtype="float64")
    for q, c in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        assert got[c] == pytest.approx(s.quantile(q), rel=1e-12, abs=1e-12)


def _row_rule(r, p):
    nan = float("nan")
    r = nan if r is None else r
    p = nan if p is None else p
    if r != p:
        return "Other"
    return "Rainy" if r > 0 else "No"


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32)),
                               st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32))),
                     min_size=1, max_size=40))
def test_rain_class_equals_row_rule(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                               "i int, rain double, precipitation double")
    got = [r[1] for r in df.select("i", rain_class()).orderBy("i").collect()]
    assert got == [_row_rule(a, b) for a, b in rows]


@SETTINGS
@given(values=st.lists(st.sampled_from(["Cash", "Card", "X", "Y", "Test", "Mobile"]), min_size=1, max_size=40),
       master=st.lists(st.sampled_from(["Cash", "Card", "X"]), unique=True, max_size=3))
def test_update_master_keeps_old_ids_and_numbers_new_ones_densely(spark, values, master):
    m = spark.createDataFrame([(i + 1, v) for i, v in enumerate(master)], PAYMENT_TYPE_MASTER_SCHEMA)
    trips = spark.createDataFrame(
        [(i, dt.datetime(2024, 3, 12) + dt.timedelta(minutes=i), v) for i, v in enumerate(values)],
        "trip_id int, trip_start_timestamp timestamp_ntz, payment_type string")
    got = {r.payment_type: r.payment_type_id for r in
           dims.update_master(trips, m, "payment_type_id", "payment_type").collect()}
    # Model: old ids kept; new values numbered by first appearance.
    want = {v: i + 1 for i, v in enumerate(master)}
    for v in values:
        if v not in want:
            want[v] = len(want) + 1
    assert got == want


def test_distributed_positions_match_window_on_ties_free_weights(spark, monkeypatch):
    monkeypatch.setattr(_plan, "ROWS_PER_RANGE", 200)
    df = spark.range(0, 3000).select((F.col("id") % 97).alias("g"), F.col("id"), (F.col("id") % 5 + 1).alias("w"))
    got = _plan.with_positions(df, [F.col("g"), F.col("id")], "before", weight="w")
    want = df.withColumn("before", F.coalesce(
        F.sum("w").over(Window.orderBy("g", "id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    assert sorted(got.select("g", "id", "before").collect()) == sorted(want.select("g", "id", "before").collect())
