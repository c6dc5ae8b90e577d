"""Edge behaviour on tiny literal frames: one test per semantic rule of
"""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import (days_back, hour_floor, iso_weekday, rain_class, short_date, thousands,
                                weekday_name)
from tripmart.operators import analytics as an
from tripmart.operators import clean as cl
from tripmart.operators import profile
from tripmart.operators.weather import weather_rows
from tripmart.schemas import RAW_TRIP_FIELDS, RAW_TRIP_SCHEMA, WEATHER_JSON_SCHEMA, require_columns


def _raw_row(**over):
    base = {f: "1" for f in RAW_TRIP_FIELDS}
    base.update(trip_id="t1", taxi_id="x", trip_start_timestamp="2024-03-12T10:15:00.000",
                trip_end_timestamp="2024-03-12T10:30:00.000", payment_type="Cash", company="A",
                pickup_community_area="8", dropoff_community_area="32")
    base.update(over)
    return tuple(base[f] for f in RAW_TRIP_FIELDS)


def test_d1_group_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "company string, trip_id int")
    out = an.trips_per_company(df).collect()
    assert [(r.company, r.trip_count) for r in out] == [("a", 2)]


def test_d3_rain_class_missing_values_are_other(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0), (1.0, 1.0), (1.0, 2.0), (None, 0.0), (float("nan"), float("nan")), (0.0, None)],
        "rain double, precipitation double")
    got = [r[0] for r in df.select(rain_class()).collect()]
    assert got == ["No", "Rainy", "Other", "Other", "Other", "Other"]


def _pandas_rain(rain, precip):
    # The reference's rule, in plain Python with pandas' NaN semantics.
    r = float("nan") if rain is None else rain
    p = float("nan") if precip is None else precip
    if r != p:
        return "Other"
    return "Rainy" if r > 0 else "No"


def test_rain_class_parity_with_row_rule(spark):
    vals = [None, float("nan"), 0.0, 0.5, 1.0, -1.0]
    rows = [(a, b) for a in vals for b in vals]
    df = spark.createDataFrame(rows, "rain double, precipitation double")
    got = [r[0] for r in df.select(rain_class()).collect()]
    assert got == [_pandas_rain(a, b) for a, b in rows]


def test_d4_top_k_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3), ("d", 4)], "company string, trip_id int")
    full = df.withColumn("trip_id", F.col("trip_id"))
    out = an.trips_per_company(full, k=2).collect()
    assert [r.company for r in out] == ["a", "b"]          # all tie at 1; key order


def test_d6_exact_sum_empty_group_is_zero(spark):
    from tripmart.functions import exact_sum
    df = spark.createDataFrame([("a", None)], "company string, trip_total double")
    assert df.groupBy("company").agg(exact_sum("trip_total").alias("s")).first().s == 0


def test_d7_round_half_up_on_exact_sum(spark):
    from tripmart.functions import exact_sum, rounded
    df = spark.createDataFrame([(1.005,), (0.0,)], "x double")
    assert df.agg(rounded(exact_sum("x", 3), 2).alias("r")).first().r == 1.01


def test_d8_d9_missing_field_is_null_column(spark, tmp_dir):
    spark.createDataFrame([("t1",)], "trip_id string").write.json(tmp_dir)
    from tripmart.sources import read_trip_json
    df = read_trip_json(spark, tmp_dir)
    assert df.columns[:23] == list(RAW_TRIP_FIELDS)
    assert df.first().fare is None


def test_d10_quoted_numbers_read_as_text_then_cast(spark, tmp_dir):
    from tests.conftest import local_file
    local_file(tmp_dir, "day.json", '[{"trip_id": "1", "fare": "12.5", "trip_seconds": "300"}]')
    local_file(tmp_dir, "notes.txt", "not json")
    from tripmart.sources import read_trip_json
    df = read_trip_json(spark, tmp_dir)
    assert df.count() == 1
    r = df.select(F.col("fare").cast("double"), F.col("trip_seconds").cast("int")).first()
    assert r[0] == 12.5 and r[1] == 300


def test_d11_hour_floor_stays_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15),)], "ts timestamp_ntz")
    out = df.select(hour_floor("ts").alias("h"))
    assert out.schema["h"].dataType == T.TimestampNTZType()
    assert out.first().h == dt.datetime(2024, 3, 10, 2, 0)


def test_d11_hour_floor_independent_of_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # 02:30 does not exist that day
        assert df.select(hour_floor("ts")).first()[0] == dt.datetime(2024, 3, 10, 2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_d12_unequal_hourly_arrays_raise(spark):
    doc = {"hourly": {"time": ["2024-03-12T00:00", "2024-03-12T01:00"], "temperature_2m": [1.0],
                      "wind_speed_10m": [1.0, 2.0], "rain": [0.0, 0.0], "precipitation": [0.0, 0.0]}}
    df = spark.createDataFrame([doc], WEATHER_JSON_SCHEMA)
    with pytest.raises(Exception):
        weather_rows(df).collect()


def test_x2_weather_rows_and_renames(spark):
    doc = {"hourly": {"time": ["2024-03-12T00:00", "2024-03-12T01:00"], "temperature_2m": [1.5, 2.5],
                      "wind_speed_10m": [3.0, 4.0], "rain": [0.0, 0.2], "precipitation": [0.0, 0.3]}}
    df = weather_rows(spark.createDataFrame([doc], WEATHER_JSON_SCHEMA))
    assert df.columns == ["datetime", "temperature", "wind_speed", "rain", "precipitation"]
    rows = df.orderBy("datetime").collect()
    assert rows[1].datetime == dt.datetime(2024, 3, 12, 1, 0) and rows[1].temperature == 2.5


def test_d13_iso_weekday(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 11),), (dt.date(2024, 3, 17),)], "d date")
    assert [r[0] for r in df.select(iso_weekday("d")).collect()] == [1, 7]


def test_d14_day_slice_half_open(spark):
    rows = [(dt.datetime(2024, 3, 12, 0, 0),), (dt.datetime(2024, 3, 12, 23, 59, 59, 500000),),
            (dt.datetime(2024, 3, 13, 0, 0),), (dt.datetime(2024, 3, 11, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "trip_start_timestamp timestamp_ntz")
    assert cl.day_slice(df, "2024-03-12").count() == 2


def test_x1_clean_trips(spark):
    rows = [_raw_row(), _raw_row(trip_id="t2", fare=None), _raw_row(trip_id="t3", pickup_census_tract=None)]
    raw = spark.createDataFrame(rows, RAW_TRIP_SCHEMA)
    out = cl.clean_trips(raw)
    assert "pickup_census_tract" not in out.columns and "pickup_community_area_id" in out.columns
    got = {r.trip_id: r for r in out.collect()}
    assert set(got) == {"t1", "t3"}                      # null in a dropped field survives
    assert got["t1"].datetime_for_weather == dt.datetime(2024, 3, 12, 10, 0)
    assert got["t1"].pickup_community_area_id == 8
    assert out.schema["pickup_community_area_id"].dataType == T.ByteType()


def test_p5_strict_cast_rejects_like_reference(spark):
    raw = spark.createDataFrame([("8.0",)], "pickup_community_area_id string")
    with pytest.raises(Exception):
        cl.cast_types(raw, {"pickup_community_area_id": "tinyint"}).collect()
    lenient = cl.cast_types(raw, {"pickup_community_area_id": "tinyint"}, strict=False).first()[0]
    assert lenient is None


def test_x9_type_error_on_bad_input(spark):
    with pytest.raises(TypeError):
        cl.clean_trips("not a frame")
    with pytest.raises(TypeError):
        require_columns(spark.createDataFrame([(1,)], "a int"), ["b"])


def test_c8_keeps_all_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0)], "trip_id int, fare double")
    assert sorted(r.trip_id for r in an.rows_at_max(df, "fare").collect()) == [2, 3]


def test_c9_cap_takes_first_by_time(spark):
    rows = [(i, dt.datetime(2024, 3, 12, 0, i)) for i in range(10)]
    df = spark.createDataFrame(rows, "trip_id int, trip_start_timestamp timestamp_ntz")
    assert [r.trip_id for r in cl.capped_slice(df, "2024-03-12", cap=3).collect()] == [0, 1, 2]


def test_g7_argmin_first_strict_minimum(spark):
    items = spark.createDataFrame([(1, 0, "a", 5), (1, 1, "b", 2), (1, 2, "c", 2), (2, 0, "z", 7)],
                                  "doc int, pos int, name string, playCount bigint")
    out = {r.doc: r for r in an.argmin_total(items, ["doc"], "name", "playCount", ["pos"]).collect()}
    assert out[1].lowest_name == "b" and out[1].total_count == 9
    assert out[2].lowest_name == "z"
    assert out[1].message == "fewest plays: b (2)"


def test_f13_thousands(spark):
    assert spark.range(1).select(thousands(F.lit(1234567))).first()[0] == "1,234,567"


def test_f1_f8_f10(spark):
    r = spark.range(1).select(days_back(F.lit("2024-05-11")).alias("a"),
                              short_date(F.lit("2024-03-05").cast("date")).alias("b"),
                              weekday_name(F.lit(3)).alias("c"), weekday_name(F.lit(9)).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == ("2024-03-12", "24-03-05", "Wednesday", "Invalid workday")


def test_g8_describe_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, None, 4.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = profile.describe_numeric(df, ["x"]).first()
    want = pd.Series(vals, dtype="float64").describe()
    assert got["count"] == want["count"]
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%")):
        assert math.isclose(got[ours], want[theirs], rel_tol=1e-12), ours


@pytest.mark.parametrize("bins", [2, 1024])
def test_g8_quantiles_match_pandas_for_any_bins(spark, monkeypatch, bins):
    import random

    import pandas as pd
    monkeypatch.setattr(profile, "BINS", bins)
    random.seed(7)
    a = [float(random.randint(0, 50)) for _ in range(500)]
    b = [random.random() * 100 for _ in range(300)] + [None] * 200
    c = [random.choice((-1, 0, 1)) * 10.0 ** random.randint(-300, 300) for _ in range(500)]
    df = spark.createDataFrame(list(zip(a, b, c)), "x double, y double, z double")
    got = {r.column_name: r for r in profile.exact_quantiles(df, ["x", "y", "z"]).collect()}
    for col, vals in (("x", a), ("y", b), ("z", c)):
        s = pd.Series(vals, dtype="float64")
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert math.isclose(got[col][name], s.quantile(q), rel_tol=1e-12), (col, name)


def test_g8_quantiles_of_edge_values(spark):
    inf, nan = math.inf, math.nan
    rows = [(5e-324, -inf, 1.0, None), (1e-323, -1.0, nan, None), (1.5e-323, 0.0, nan, None), (2e-323, inf, nan, None),
            (2.5e-323, inf, nan, None)]
    df = spark.createDataFrame(rows, "tiny double, ends double, nans double, none double")
    got = {r.column_name: r for r in profile.exact_quantiles(df, df.columns).collect()}
    assert set(got) == {"tiny", "ends", "nans"}                     # no value, no row
    assert tuple(got["tiny"])[1:] == (1e-323, 1.5e-323, 2e-323)
    assert got["ends"].q25 == -1.0 and got["ends"].q50 == 0.0
    assert all(math.isnan(q) for q in tuple(got["nans"])[1:])        # the largest value, as in Spark's order


def test_g8_quantiles_sort_nothing(spark, monkeypatch):
    """Every pass is a hash aggregation: no sort, no range partitioning."""
    import contextlib
    import io
    plans = []
    histogram = profile._histogram

    def seen(values, brackets):
        real = type(values).collect

        def collect(self):
            with contextlib.redirect_stdout(io.StringIO()) as buf:
                self.explain()
            plans.append(buf.getvalue())
            return real(self)
        with monkeypatch.context() as m:
            m.setattr(type(values), "collect", collect)
            return histogram(values, brackets)

    monkeypatch.setattr(profile, "_histogram", seen)
    profile.exact_quantiles(spark.range(5000).selectExpr("id * 0.37 AS x"), "x")
    assert plans and all("HashAggregate" in p and "Sort" not in p and "rangepartitioning" not in p for p in plans)


def test_g8_describe_text_mode_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    r = profile.describe_text(df, ["v"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_g9_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y")], "a int, b string")
    got = {r.column_name: r for r in profile.null_profile(df).collect()}
    assert (got["a"].non_null_count, got["b"].non_null_count, got["a"].row_count) == (2, 2, 3)
    assert got["a"].data_type == "int" and got["b"].position == 1


def test_d17_weather_offset(spark):
    doc = {"hourly": {"time": ["2024-03-12T00:00"], "temperature_2m": [1.0], "wind_speed_10m": [1.0],
                      "rain": [0.0], "precipitation": [0.0]}}
    df = weather_rows(spark.createDataFrame([doc], WEATHER_JSON_SCHEMA), offset_hours=-5)
    assert df.first().datetime == dt.datetime(2024, 3, 11, 19, 0)


def test_c9_cap_over_a_large_day(spark):
    rows = [(i, dt.datetime(2024, 3, 12, 0, 0) + dt.timedelta(seconds=(i * 37) % 500)) for i in range(500)]
    df = spark.createDataFrame(rows, "trip_id int, trip_start_timestamp timestamp_ntz")
    got = sorted(r.trip_id for r in cl.capped_slice(df, "2024-03-12", cap=40).collect())
    want = sorted(i for _, i in sorted(((ts, i) for i, ts in rows))[:40])
    assert got == want


def test_d2_null_keys_never_match(spark):
    """Masters never hold NULL (built from non-null values), so the inner
    join drops a trip with a NULL key — as pandas' merge does here."""
    from tripmart.operators.star import encode_keys
    from tripmart.schemas import COMPANY_MASTER_SCHEMA, PAYMENT_TYPE_MASTER_SCHEMA
    trips = spark.createDataFrame([(1, "A", "Cash"), (2, None, "Cash")], "trip_id int, company string, payment_type string")
    comp = spark.createDataFrame([(1, "A")], COMPANY_MASTER_SCHEMA)
    pay = spark.createDataFrame([(1, "Cash")], PAYMENT_TYPE_MASTER_SCHEMA)
    assert [r.trip_id for r in encode_keys(trips, pay, comp).collect()] == [1]


def test_star_join_keeps_one_row_per_fact(spark):
    """SURVEY §5.4: with exactly one match per key, trips_full has one row per fact."""
    from tests.conftest import SF_ORACLE
    from tripmart.plans import standins as si
    star = si.load_star(spark, SF_ORACLE)
    full = star.full()
    assert full.count() == star.facts.count() == 10_000
    assert full.select("trip_id").distinct().count() == 10_000


def test_f19_html_unescape_matches_python(spark):
    import html as pyhtml

    from tripmart.functions import html_unescape
    samples = ["caf&#233; &amp; bar", "&#xE9;t&#xe9; &lt;b&gt;", "emoji &#128512; and &#x1F600;",
               "&amp;#233; stays literal", "plain text", "&copy; 2024 &middot; x&nbsp;y", "", "&#0; &#xD800;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(samples)], "i int, t string")
    got = [r[0] for r in df.select(html_unescape("t")).orderBy(df.i).collect()]
    for g, t in zip(got, samples):
        if "&#0;" in t:                       # invalid code points stay as written
            assert g == t
        else:
            assert g == pyhtml.unescape(t), t


def test_g8_describe_text_all_null_column(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "v string, w string")
    got = {r.column_name: r for r in profile.describe_text(df, ["v", "w"]).collect()}
    assert (got["w"]["count"], got["w"]["unique"], got["w"]["top"]) == (0, 0, None)
    assert (got["v"]["count"], got["v"]["top"], got["v"]["freq"]) == (2, "a", 2)


def test_argmin_in_array(spark):
    """First strict minimum, items without a count skipped, empty and missing arrays defined; no sort, no shuffle."""
    schema = "id int, contents struct<items array<struct<name string, playCount bigint>>>"
    docs = spark.createDataFrame([
        (1, ([("a", 5), ("b", 2), ("c", 2), (None, 9)],)), (2, ([],)), (3, (None,)), (4, None),
        (5, ([("x", None), ("y", 7)],)), (6, ([(None, 1)],))], schema)
    out = an.argmin_total_in_array(docs, "contents.items", "name", "playCount")
    got = {r.id: (r.lowest_name, r.lowest_count, r.lowest_place, r.total_count) for r in out.collect()}
    assert got == {1: ("b", 2, 1, 18), 2: (None, None, None, 0), 3: (None, None, None, 0), 4: (None, None, None, 0),
                   5: ("y", 7, 1, 7), 6: (None, 1, 0, 1)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_x9_every_row_is_typed_or_rejected(spark):
    raw = spark.createDataFrame([("1", "2.5", None), ("x", "1e400", None), (None, "", None), (None, None, "{broken")],
                                "trip_seconds string, fare string, bad string")
    rows = cl.typed_or_rejected(raw, {"trip_seconds": "int", "fare": "double"}, "bad").collect()
    got = [(r.trip_seconds, r.reject_reasons) for r in rows]
    assert got == [(1, []), (None, ["trip_seconds is no int"]), (None, ["fare is no double"]), (None, ["corrupt record"])]
    assert rows[0].fare == 2.5 and rows[1].fare == math.inf and rows[3].bad == "{broken"
