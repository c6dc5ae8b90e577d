"""Catalog tables in a second session."""

import contextlib
import io
import uuid

import pytest

from tests.conftest import SF_SMALL
from tripmart.plans import catalog, sql, standins


@pytest.fixture
def published(spark, tmp_dir):
    database = f"cat_{uuid.uuid4().hex[:8]}"
    catalog.publish(spark, standins.load_star(spark, SF_SMALL), tmp_dir, database)
    yield database, tmp_dir
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def _plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as buf:
        df.explain("formatted")
    return buf.getvalue()


def test_second_session_answers_from_the_tables(spark, published):
    database, _ = published
    star, other = standins.load_star(spark, SF_SMALL), spark.newSession()
    found = catalog.open_star(other, database)
    assert other.catalog.listTables() == []                     # no temporary view came along
    for text in (sql.A1_REVENUE, sql.A2_PICKUP):
        assert sql.run(other, found, text).collect() == sql.run(spark, star, text).collect()
    assert sql.weekday_rides(other, found).collect() == sql.weekday_rides(spark, star).collect()


def test_joins_are_chosen_by_statistics(spark, published):
    database, _ = published
    other = spark.newSession()
    star = catalog.open_star(other, database)
    detail = {r.col_name: r.data_type for r in other.sql(f"DESCRIBE EXTENDED {database}.company").collect()}
    size = int(detail["Statistics"].split(" ")[0])
    other.conf.set("spark.sql.adaptive.enabled", "false")
    joined = star.facts.join(star.company, "company_id")
    assert "BroadcastHashJoin" in _plan(joined)
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size // 100))
    assert "SortMergeJoin" in _plan(star.facts.join(star.company, "company_id"))


def test_new_and_lost_days_follow_the_folders(spark, published):
    database, base = published
    star = catalog.open_star(spark, database)
    n, days = star.facts.count(), [r[0] for r in star.facts.select("trip_date").distinct().sort("trip_date").collect()]
    one = star.facts.where(f"trip_date = DATE '{days[0]}'").collect()
    again = spark.createDataFrame(one, star.facts.schema).selectExpr(
        "* EXCEPT (trip_date)", "DATE '2030-01-01' AS trip_date")
    catalog.files.write_dated_facts(again, f"{base}/taxi_trips")
    catalog.refresh(spark, database, "taxi_trips")
    table = spark.table(f"{database}.taxi_trips")
    assert table.count() == n + len(one)
    assert table.where("trip_date = DATE '2030-01-01'").count() == len(one)


def test_names_lost_with_the_catalog_are_registered_again(spark, published):
    database, base = published
    n = spark.table(f"{database}.taxi_trips").count()
    spark.sql(f"DROP TABLE {database}.taxi_trips")              # external: the folders stay
    catalog.register(spark, base, database)
    assert spark.table(f"{database}.taxi_trips").count() == n
