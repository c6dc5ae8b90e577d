"""Surrogate ids and masters (W1, X4, X6, J7), both numbering paths."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.operators import _plan, dims
from tripmart.operators.star import decode_keys, encode_keys
from tripmart.schemas import COMPANY_MASTER_SCHEMA, PAYMENT_TYPE_MASTER_SCHEMA


@pytest.fixture(params=[500, 10**6], ids=["many ranges", "one range"])
def path(request, monkeypatch):
    monkeypatch.setattr(_plan, "ROWS_PER_RANGE", request.param)
    return request.param


def _trips(spark, rows):
    return spark.createDataFrame(
        [(i, dt.datetime(2024, 3, 12, 0, 0, i % 60, i), c, p) for i, (c, p) in enumerate(rows)],
        "trip_id int, trip_start_timestamp timestamp_ntz, company string, payment_type string")


def test_dense_ids_equal_row_number(spark, path):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id"))
    got = dims.dense_ids(df, [F.col("k"), F.col("id")], "rid", start=11)
    want = df.withColumn("rid", (F.row_number().over(Window.orderBy("k", "id")) + 10).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_distributed_path_has_no_window_over_the_rows(spark, monkeypatch):
    """The large-set path ranks rows inside their range partition from a
    local sort: the only window left is the one over the per-partition
    totals (one row per partition), so no row goes through a single task."""
    import contextlib
    import io
    monkeypatch.setattr(_plan, "ROWS_PER_RANGE", 200)
    df = spark.range(0, 1000).select(F.col("id").alias("k"))
    out = dims.dense_ids(df, [F.col("k")], "rid")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_t" in windows[0]
    assert out.agg(F.min("rid"), F.max("rid"), F.countDistinct("rid")).first() == (1, 1000, 1000)


def test_build_master_first_appearance(spark, path):
    t = _trips(spark, [("B", "Cash"), ("A", "Card"), ("B", "Cash"), (None, "Cash")])
    m = {r.company: r.company_id for r in dims.build_master(t, "company_id", "company").collect()}
    assert m == {"B": 1, "A": 2}


def test_update_master_appends_with_stable_ids(spark, path):
    master = spark.createDataFrame([(1, "Credit Card"), (2, "Cash")], PAYMENT_TYPE_MASTER_SCHEMA)
    t = _trips(spark, [("A", "X"), ("A", "Cash"), ("A", "Y"), ("A", "X"), ("A", "Test")])
    got = sorted(tuple(r) for r in dims.update_master(t, master, "payment_type_id", "payment_type").collect())
    assert got == [(1, "Credit Card"), (2, "Cash"), (3, "X"), (4, "Y"), (5, "Test")]


def test_update_master_is_idempotent(spark, path):
    master = spark.createDataFrame([(1, "Cash")], PAYMENT_TYPE_MASTER_SCHEMA)
    t = _trips(spark, [("A", "X"), ("A", "Y")])
    once = dims.update_master(t, master, "payment_type_id", "payment_type")
    twice = dims.update_master(t, once, "payment_type_id", "payment_type")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_update_master_empty_master_starts_at_one(spark, path):
    empty = spark.createDataFrame([], COMPANY_MASTER_SCHEMA)
    t = _trips(spark, [("XXX", "c"), ("XY", "c")])
    got = sorted(tuple(r) for r in dims.update_master(t, empty, "company_id", "company").collect())
    assert got == [(1, "XXX"), (2, "XY")]


def test_b1_per_occurrence_form_fans_out(spark, path):
    """The reference's literal form: y, y, z -> three ids; encoding then
    turns the 3 trips into 5 rows (2 x 2 for y, 1 for z)."""
    master = spark.createDataFrame([(1, "x")], PAYMENT_TYPE_MASTER_SCHEMA)
    t = _trips(spark, [("A", "y"), ("A", "y"), ("A", "z")])
    grown = dims.update_master(t, master, "payment_type_id", "payment_type", dedupe=False)
    assert sorted(r.payment_type for r in grown.collect()) == ["x", "y", "y", "z"]
    comp = spark.createDataFrame([(1, "A")], COMPANY_MASTER_SCHEMA)
    assert encode_keys(t, grown, comp).count() == 5
    dedup = dims.update_master(t, master, "payment_type_id", "payment_type")
    assert encode_keys(t, dedup, comp).count() == 3


def test_encode_decode_roundtrip(spark, path):
    t = _trips(spark, [("A", "p"), ("B", "q"), ("A", "q")])
    comp = dims.build_master(t, "company_id", "company")
    pay = dims.build_master(t, "payment_type_id", "payment_type")
    back = decode_keys(encode_keys(t, pay, comp), comp, pay)
    assert sorted(back.select("trip_id", "company", "payment_type").collect()) == \
        sorted(t.select("trip_id", "company", "payment_type").collect())


def test_j7_new_values(spark):
    master = spark.createDataFrame([(1, "Cash")], PAYMENT_TYPE_MASTER_SCHEMA)
    t = _trips(spark, [("A", "Cash"), ("A", "X"), ("A", "X"), ("A", None)])
    assert [r.payment_type for r in dims.new_values(t, master, "payment_type").collect()] == ["X"]


def test_x5_date_dimension(spark):
    d = dims.date_dimension(spark)
    assert d.count() == 1827
    r = d.where(F.col("date") == F.lit("2024-03-16").cast("date")).first()
    assert (r.year, r.month, r.day, r.day_of_week, r.is_weekend) == (2024, 3, 16, 6, True)


def test_build_masters_one_pass_equals_per_column(spark, path):
    t = _trips(spark, [("B", "Cash"), ("A", "Card"), ("B", "Cash"), (None, "Mobile"), ("C", None)])
    both = dims.build_masters(t, {"company": "company_id", "payment_type": "payment_type_id"})
    for value_col, id_col in (("company", "company_id"), ("payment_type", "payment_type_id")):
        want = sorted(tuple(r) for r in dims.build_master(t, id_col, value_col).collect())
        assert sorted(tuple(r) for r in both[value_col].collect()) == want
        assert both[value_col].columns == [id_col, value_col]
