"""Sources and sinks (S1-S11): landed formats, folder scans, versions, HTML."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import local_file
from tripmart.operators import analytics as an
from tripmart.plans import standins
from tripmart.schemas import COMPANY_MASTER_SCHEMA, PLAYLIST_SCHEMA
from tripmart.sources import files, html


def test_s1_array_file_and_pretty_printed_file(spark, tmp_dir):
    local_file(tmp_dir + "/one", "d1.json", '[{"trip_id": "1"}, {"trip_id": "2"}]')
    local_file(tmp_dir + "/pretty", "d2.json", '[\n  {"trip_id": "3",\n   "fare": "1.5"},\n  {"trip_id": "4"}\n]\n')
    assert sorted(r.trip_id for r in files.read_trip_json(spark, tmp_dir + "/one").collect()) == ["1", "2"]
    pretty = files.read_trip_json(spark, tmp_dir + "/pretty", multi_line=True).collect()
    assert sorted(r.trip_id for r in pretty) == ["3", "4"]


def test_s6_nested_document_and_g7_argmin(spark, tmp_dir):
    doc = """{"contents": {"items": [
        {"name": "Song A", "playCount": 12000},
        {"name": "Song B", "playCount": 900},
        {"name": "Song C", "playCount": 900},
        {"name": "Song D", "playCount": 4000}]}}"""
    local_file(tmp_dir, "playlist.json", doc)
    df = files.read_nested_json(spark, tmp_dir, PLAYLIST_SCHEMA, multi_line=True)
    assert df.select(F.col("contents.items")[0]["name"]).first()[0] == "Song A"     # F15 path access
    items = df.select(F.posexplode("contents.items").alias("pos", "it")).select(
        F.lit(1).alias("doc"), "pos", F.col("it.name").alias("name"), F.col("it.playCount").alias("playCount"))
    r = an.argmin_total(items, ["doc"], "name", "playCount", ["pos"]).first()
    assert (r.lowest_name, r.lowest_count, r.total_count) == ("Song B", 900, 17800)
    assert r.message == "fewest plays: Song B (900)"


def test_s3_csv_roundtrip_keeps_microseconds_and_booleans(spark, tmp_dir):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("flag", T.BooleanType()),
                           T.StructField("x", T.DoubleType())])
    rows = [(dt.datetime(2024, 3, 12, 0, 0, 0, 123456), True, 0.1), (dt.datetime(2024, 3, 12), False, None)]
    files.write_csv(spark.createDataFrame(rows, schema), tmp_dir)
    back = sorted(tuple(r) for r in files.read_csv(spark, tmp_dir, schema).collect())
    assert back == sorted(rows)


def test_s4_folder_skips_other_files_and_empty_folder_is_empty(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    local_file(tmp_dir + "/day1", "x.csv", "a,b\n1,x\n")
    local_file(tmp_dir + "/day2", "y.csv", "a,b\n2,y\n")
    local_file(tmp_dir, "README.txt", "not a table")
    got = sorted(tuple(r) for r in files.read_csv_folder(spark, tmp_dir, schema).collect())
    assert got == [(1, "x"), (2, "y")]
    local_file(tmp_dir + "/empty", "only.txt", "nothing")
    assert files.read_csv_folder(spark, tmp_dir + "/empty", schema).count() == 0


def test_s10_dynamic_overwrite_replaces_only_present_days(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.date(2024, 3, 12)), (2, dt.date(2024, 3, 13))], "v int, trip_date date")
    files.write_dated_facts(df, tmp_dir)
    files.write_dated_facts(spark.createDataFrame([(9, dt.date(2024, 3, 13))], "v int, trip_date date"), tmp_dir)
    got = sorted((r.v, r.trip_date) for r in spark.read.parquet(tmp_dir).collect())
    assert got == [(1, dt.date(2024, 3, 12)), (9, dt.date(2024, 3, 13))]


def test_s11_master_versions(spark, tmp_dir):
    assert files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA).count() == 0
    files.write_master_version(spark.createDataFrame([(1, "A")], COMPANY_MASTER_SCHEMA), tmp_dir, 1)
    files.write_master_version(spark.createDataFrame([(1, "A"), (2, "B")], COMPANY_MASTER_SCHEMA), tmp_dir, 2)
    assert files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA).count() == 2
    assert files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA, version=1).count() == 1
    assert files.latest_version(spark, tmp_dir) == 2


PAGE = """<html><body><h1 id="firstHeading">Community areas</h1>
<table class="wikitable sortable plainrowheaders mw-datatable">
<tbody>
<tr><th>No.</th><th>Name</th></tr>
<tr><th>(code)</th><th>(name)</th></tr>
<tr><td> 01 </td><th scope="row"><a href="/wiki/Rogers_Park">Rogers Park</a></th><td>x</td></tr>
<tr><td>32</td><th scope="row"><a href="/wiki/Loop">The &amp; Loop </a></th><td>y</td></tr>
<tr><td>77</td><th scope="row"><a href="/wiki/Edgewater">Edgewater</a></th></tr>
<tr><td colspan="3">Total</td></tr>
</tbody></table>
<table class="other"><tr><td>99</td></tr></table>
</body></html>"""


def test_s7_html_table_rows(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<html>no table</html>")], "page_id long, html string")
    got = [(r.area_code, r.community_name) for r in html.html_table_rows(pages).orderBy("page_id", "row_index").collect()]
    assert got == [(1, "Rogers Park"), (32, "The & Loop"), (77, "Edgewater")]


def test_s7_nested_tables_and_missing_end_tags(spark):
    cls = "wikitable sortable plainrowheaders mw-datatable"
    inner = '<table><tr><td>5</td></tr><tr><th><a>in</a></th></tr></table>'
    page = (f"</table><!-- <table class='{cls}'> --><script>x='<tr>'</script><TABLE id=1 class='{cls}'><tr><tr>"
            f"<tr><td>1{'</td>'}<td>{inner}<th><a>A &lt; B<tr><td> 2 <th>x <a>C</a><a>D</a></th> <a>E</a><tr>foot")
    pages = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, f"<table class='{cls}'><tr></table>")], "page_id long, html string")
    got = sorted(tuple(r) for r in html.html_table_rows(pages).collect())
    assert got == [(1, 0, 1, "A < B"), (1, 1, 2, "C")]


def test_s7_list_links(spark):
    page = '<ul><li><a href="/a">Alpha &amp; co</a></li><li> <a class="x" href="/b"> Beta </a></li></ul>'
    pages = spark.createDataFrame([(5, page)], "page_id long, html string")
    got = [tuple(r) for r in html.html_list_links(pages).collect()]
    assert got == [(5, 1, "/a", "Alpha & co"), (5, 2, "/b", "Beta")]


def test_u2_concat_by_name_missing_columns_null(spark):
    a = spark.createDataFrame([(1, "x")], "id int, company string")
    b = spark.createDataFrame([("y", 2, 0.5)], "company string, id int, tips double")
    got = sorted(tuple(r) for r in files.concat_tables([a, b]).select("id", "company", "tips").collect())
    assert got == [(1, "x", None), (2, "y", 0.5)]


def test_s14_literal_rows_typed_and_empty(spark):
    from tripmart.sources import literal_rows
    df = literal_rows(spark, [(1, "A"), (2, None)], COMPANY_MASTER_SCHEMA)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, "A"), (2, None)]
    empty = literal_rows(spark, [], COMPANY_MASTER_SCHEMA)
    assert empty.count() == 0 and empty.columns == ["company_id", "company"]


def test_rows_are_dealt_by_day_in_bounded_tasks(spark):
    """A day of half the rows goes to many tasks, small days stay whole; no row is lost, without a day or not."""
    days = [None] * 30 + ["2024-01-31"] * 1000 + [f"2024-02-{1 + i % 28:02d}" for i in range(970)]
    df = spark.createDataFrame(list(enumerate(days)), "trip_id long, day string")
    placed = files.rebalanced(df, "day", rows_per_task=100).select("*", F.spark_partition_id().alias("task")).collect()
    assert sorted((r["trip_id"], r["day"]) for r in placed) == list(enumerate(days))
    tasks = {}
    for r in placed:
        tasks.setdefault(r["task"], []).append(r["day"])
    assert max(map(len, tasks.values())) <= 260
    assert sum("2024-01-31" in t for t in tasks.values()) == 10
    assert all(sum(d in t for t in tasks.values()) == 1 for d in set(days) - {"2024-01-31"})


def test_landing_moves_narrow_rows(spark):
    """The landed trips are the raw trips, and their text fields are made after the shuffle and the sort."""
    sf = "/root/testdata/sf0.001"
    path = standins.load_landing(spark, sf)
    want = standins.raw_trips(spark, sf)
    assert sorted(map(str, files.read_trip_json(spark, path).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    source = standins._raw_source(spark, sf).withColumn("ingest_date", F.to_date("ts"))
    plan = standins._raw_fields(files.rebalanced(source, "ingest_date").sortWithinPartitions("ingest_date"),
                                "ingest_date")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("POINT (") < plan.index("Sort [ingest_date")
