"""Incremental ETL (M1-M3, X7): once-only, state carried across batches,
batch size does not change the decoded result, replays are idempotent."""

import os

import pytest

from tests.conftest import SF_SMALL
from tripmart.operators.star import decode_keys
from tripmart.plans import standins as si
from tripmart.session import scratch_path
from tripmart.sources import files
from tripmart.streaming import land_raw_trips, run_daily_etl, run_trip_stream
from tripmart.operators.clean import clean_trips


@pytest.fixture(scope="module")
def landing(spark):
    return land_raw_trips(si.raw_trips(spark, SF_SMALL), scratch_path(spark, "landing"))


def _decoded(res):
    return sorted(tuple(r) for r in decode_keys(res.facts, res.company, res.payment_type)
                  .select("trip_id", "company", "payment_type").collect())


def test_one_file_per_batch_equals_one_batch(spark, landing):
    per_file = run_daily_etl(spark, landing, scratch_path(spark, "etl1"), max_files_per_trigger=1)
    at_once = run_daily_etl(spark, landing, scratch_path(spark, "etl-all"))
    assert per_file.facts.select("batch").distinct().count() == 30      # one batch per day file
    assert at_once.facts.select("batch").distinct().count() == 1
    want = sorted(tuple(r) for r in clean_trips(si.raw_trips(spark, SF_SMALL))
                  .select("trip_id", "company", "payment_type").collect())
    assert _decoded(per_file) == want
    assert _decoded(at_once) == want
    for res in (per_file, at_once):
        ids = [r.company_id for r in res.company.collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1))            # unique, contiguous


def test_masters_grow_in_versions(spark, landing):
    base = scratch_path(spark, "etl-versions")
    run_daily_etl(spark, landing, base, max_files_per_trigger=1)
    versions = spark.read.parquet(f"{base}/payment_type_master").select("version").distinct().count()
    assert versions >= 1
    assert files.latest_version(spark, f"{base}/payment_type_master") >= 1


def test_rerun_with_same_checkpoint_adds_nothing(spark, landing):
    out, ckpt = scratch_path(spark, "m1-out"), scratch_path(spark, "m1-ckpt")
    first = run_trip_stream(spark, landing, out, ckpt).count()
    second = run_trip_stream(spark, landing, out, ckpt).count()
    assert first == second == clean_trips(si.raw_trips(spark, SF_SMALL)).count()


def test_replay_without_checkpoint_is_idempotent(spark, landing):
    """A batch replayed from scratch finds its master values present,
    writes no new master version, and overwrites its own fact folder."""
    base = scratch_path(spark, "etl-replay")
    a = run_daily_etl(spark, landing, base, checkpoint=f"{base}/ck1")
    first = _decoded(a)                      # read before the replay overwrites the folder
    v_before = files.latest_version(spark, f"{base}/company_master")
    b = run_daily_etl(spark, landing, base, checkpoint=f"{base}/ck2")
    assert files.latest_version(spark, f"{base}/company_master") == v_before
    assert _decoded(b) == first


def test_archive_moves_consumed_files(spark):
    raw = si.raw_trips(spark, SF_SMALL)
    landing = land_raw_trips(raw, scratch_path(spark, "landing-archive"))
    archive = scratch_path(spark, "archive")
    out = run_trip_stream(spark, landing, scratch_path(spark, "m3-out"), scratch_path(spark, "m3-ckpt"),
                          max_files_per_trigger=5, archive_dir=archive)
    assert out.count() == clean_trips(raw).count()
    local = archive[len("file:"):] if archive.startswith("file:") else archive
    moved = [f for _, _, fs in os.walk(local) for f in fs if f.endswith(".json")]
    assert len(moved) >= 1


def test_a_late_file_with_an_old_date_is_read(spark, tmp_dir):
    import json
    import os
    import time

    from tests.conftest import local_file
    from tripmart.schemas import RAW_TRIP_FIELDS
    from tripmart.streaming import ingest

    def rows(n):
        return json.dumps({f: None for f in RAW_TRIP_FIELDS} | {"trip_id": f"t{n}"})

    landing = f"{tmp_dir}/landing"
    drain = lambda: ingest._trip_source(spark, landing, None, None).select("trip_id").writeStream.format(
        "parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck").trigger(
        availableNow=True).start().awaitTermination()
    local_file(landing, "new.json", rows(1))
    drain()
    late = local_file(landing, "late.json", rows(2))
    os.utime(late, (time.time() - 40 * 86400,) * 2)
    drain()
    assert sorted(r.trip_id for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["t1", "t2"]


def _land(folder, name, day, trips, company="A", payment="Cash"):
    """One landed day file of complete trips."""
    import json

    from tests.conftest import local_file
    from tripmart.schemas import RAW_TRIP_FIELDS, TRIP_CAST_TYPES

    rows = []
    for t in trips:
        row = {f: "1" for f in RAW_TRIP_FIELDS} | {
            "trip_id": f"{t}", "taxi_id": "7", "company": company, "payment_type": payment,
            "trip_start_timestamp": f"{day}T08:00:00.000", "trip_end_timestamp": f"{day}T09:00:00.000"}
        rows.append(json.dumps(row))
    return local_file(folder, name, "\n".join(rows))


def _trips(res):
    return sorted((r.trip_id, r.company) for r in
                  decode_keys(res.facts, res.company, res.payment_type).select("trip_id", "company").collect())


@pytest.mark.parametrize("overwrite", ["dynamic", "static"])
def test_a_second_checkpoint_loses_nothing(spark, tmp_dir, overwrite):
    """Two days, then another checkpoint with a day of a new company, whatever the overwrite mode."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", overwrite)
    try:
        landing, base = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
        _land(landing, "d1.json", "2024-01-01", range(10), "A")
        _land(landing, "d2.json", "2024-01-02", range(10, 17), "B")
        run_daily_etl(spark, landing, base, max_files_per_trigger=1, checkpoint=f"{base}/ck1")
        _land(landing, "d3.json", "2024-01-03", range(17, 22), "C")
        res = run_daily_etl(spark, landing, base, checkpoint=f"{base}/ck2")
        want = [(str(t), "A" if t < 10 else "B" if t < 17 else "C") for t in range(22)]
        assert _trips(res) == sorted(want) and res.facts.count() == 22
        assert sorted((r.company_id, r.company) for r in res.company.collect()) == [(1, "A"), (2, "B"), (3, "C")]
        again = run_daily_etl(spark, landing, base, max_files_per_trigger=2, checkpoint=f"{base}/ck3")
        assert _trips(again) == sorted(want)            # re-batched replay adds nothing
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_uncommitted_folders_do_not_count(spark, tmp_dir, monkeypatch):
    """A job that dies between its facts and its commit leaves nothing a reader sees; the retry counts once."""
    from tripmart.sources import ledger

    landing, base = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    _land(landing, "d1.json", "2024-01-01", range(4))

    def die(*_, **__):
        raise RuntimeError("executor gone")

    with monkeypatch.context() as m:
        m.setattr(ledger, "append_commit", die)
        with pytest.raises(Exception, match="executor gone"):
            run_daily_etl(spark, landing, base)
    assert ledger.read_facts(spark, base) is None
    assert len(_trips(run_daily_etl(spark, landing, base))) == 4


def test_a_committed_batch_is_not_written_again(spark, tmp_dir):
    """The checkpoint forgets a batch that the ledger has: the replay finds its commit."""
    import shutil

    from tripmart.sources import ledger

    landing, base = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    _land(landing, "d1.json", "2024-01-01", range(4))
    run_daily_etl(spark, landing, base)
    local = base[len("file:"):] if base.startswith("file:") else base
    for name in ("0", ".0.crc"):
        shutil.move(f"{local}/checkpoint/commits/{name}", f"{local}/{name}-moved")
    assert len(_trips(run_daily_etl(spark, landing, base))) == 4
    assert len(ledger.commits(spark, base)) == 1


def test_two_writers_cannot_take_the_same_commit(spark, tmp_dir):
    from tripmart.sources import ledger

    ledger.append_commit(spark, tmp_dir, [], "w1", 0, "f1", ["2024-01-01"])
    with pytest.raises(Exception):
        ledger.append_commit(spark, tmp_dir, [], "w2", 0, "f2", ["2024-01-01"])
    known = ledger.commits(spark, tmp_dir)
    assert [c["folder"] for c in known] == ["f1"] and ledger.has_commit(known, "w1", 0)
    assert not ledger.has_commit(known, "w2", 0)


def test_a_corrected_day_replaces_and_readers_see_old_or_new(spark, tmp_dir):
    """Delivered again weeks later: the newest commit of the day wins; a frame made before keeps the old day."""
    first, second, base = f"{tmp_dir}/l1", f"{tmp_dir}/l2", f"{tmp_dir}/wh"
    _land(first, "d1.json", "2024-01-01", range(5))
    _land(first, "d2.json", "2024-01-02", range(5, 9))
    old = run_daily_etl(spark, first, base, mode="replace").facts
    _land(second, "d1-corrected.json", "2024-01-01", [1, 2, 100], "New")
    new = run_daily_etl(spark, second, base, checkpoint=f"{base}/ck2", mode="replace")
    assert sorted(r.trip_id for r in old.collect()) == sorted(map(str, range(9)))
    assert _trips(new) == sorted([("1", "New"), ("100", "New"), ("2", "New")] + [(str(t), "A") for t in range(5, 9)])
    late = f"{tmp_dir}/l3"
    _land(late, "late.json", "2024-01-01", [200])
    assert len(_trips(run_daily_etl(spark, late, base, checkpoint=f"{base}/ck3"))) == 8      # add keeps the day
    with pytest.raises(ValueError):
        run_daily_etl(spark, late, base, max_files_per_trigger=1, mode="replace")


def test_a_file_delivered_twice_counts_once_and_consumed_files_are_archived(spark, tmp_dir):
    import time

    landing, archive, base = f"{tmp_dir}/landing", f"{tmp_dir}/archive", f"{tmp_dir}/wh"
    for d in range(1, 5):
        _land(landing, f"d{d}.json", f"2024-01-0{d}", [d])
        time.sleep(0.02)
    run_daily_etl(spark, landing, base, max_files_per_trigger=1, archive_dir=archive)
    local = archive[len("file:"):] if archive.startswith("file:") else archive
    deadline = time.time() + 20
    moved = set()
    while time.time() < deadline and len(moved) < 3:    # cleaning runs behind the batches
        moved = {f for _, _, fs in os.walk(local) for f in fs if f.endswith(".json")}
    assert moved == {"d1.json", "d2.json", "d3.json"}   # all but the last batch's
    _land(landing, "d1.json", "2024-01-01", [1])        # the same file once more
    res = run_daily_etl(spark, landing, base, checkpoint=f"{base}/ck2")
    assert [t for t, _ in _trips(res)] == ["1", "2", "3", "4"]


def test_master_versions_by_pointer(spark, tmp_dir):
    """The version before is readable, and a read opens one version's folder however many there are."""
    from tripmart.schemas import COMPANY_MASTER_SCHEMA

    for v in range(1, 6):
        files.write_master_version(spark.createDataFrame([(i, f"c{i}") for i in range(v)], COMPANY_MASTER_SCHEMA), tmp_dir, v)
    assert files.latest_version(spark, tmp_dir) == 5
    newest = files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA)
    before = files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA, previous=True)
    assert (newest.count(), before.count(), files.read_master(spark, tmp_dir, version=2).count()) == (5, 4, 2)
    assert all("version=5" in f for f in newest.inputFiles()) and all("version=4" in f for f in before.inputFiles())
    spark.range(1).write.parquet(f"{tmp_dir}/version=6")                # written, never pointed to
    assert files.read_master(spark, tmp_dir, COMPANY_MASTER_SCHEMA).count() == 5


def test_masters_from_streaming_state(spark, tmp_dir):
    landing, base = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    import time
    from tripmart.streaming import run_master_stream

    for d, company in enumerate("BADAB", 1):
        _land(landing, f"d{d}.json", f"2024-01-0{d}", [d], company, "Cash" if d < 4 else "Card")
        time.sleep(0.02)
    got = run_master_stream(spark, landing, base, max_files_per_trigger=1)
    ids = sorted((r.company_id, r.company) for r in got["company"].collect())
    assert ids == [(1, "B"), (2, "A"), (3, "D")]
    assert files.latest_version(spark, f"{base}/company_master") == 3   # only batches with new values
    _land(landing, "d6.json", "2024-01-06", [6], "C", "Card")
    lost = run_master_stream(spark, landing, base, checkpoint=f"{base}/other")     # state starts empty
    assert sorted((r.company_id, r.company) for r in lost["company"].collect()) == ids + [(4, "C")]
    res = run_daily_etl(spark, landing, base)
    assert len(_trips(res)) == 6 and files.latest_version(spark, f"{base}/company_master") == 4
