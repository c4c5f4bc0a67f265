"""Staged publication: replayed batches, lost drivers, changed dates, compaction, readers of the last good run."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tests.conftest import envelope_rows, ev
from tests.test_jobs_stream import _land, _ride, _seeds
from triplake.config import LakeConfig
from triplake.operators import bronze as B
from triplake.plans import jobs
from triplake.plans import pipeline as P
from triplake.schemas import ENVELOPE_SCHEMA
from triplake.sinks import lake as sink
from triplake.sinks.publish import Files, Publisher
from triplake.sources import bus
from triplake.sources import lake as src
from triplake.streaming import bronze_stream


class Lost(RuntimeError):
    """The driver goes here."""


def _lose_after(monkeypatch, moves):
    """The next publication breaks off after some moves."""
    plain, left = Files.move, [moves]

    def move(self, source, target):
        if target.endswith("plan.json"):
            return plain(self, source, target)
        if not left[0]:
            monkeypatch.setattr(Files, "move", plain)
            raise Lost
        left[0] -= 1
        plain(self, source, target)

    monkeypatch.setattr(Files, "move", move)


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("moves", [0, 1, 3])
def test_a_replayed_batch_lands_once(spark, raw_frame, tmp_lake, monkeypatch, moves):
    df = B.transform(raw_frame(_ride(1, 1) + _ride(2, 2)))
    _lose_after(monkeypatch, moves)
    with pytest.raises(Lost):
        sink.append_bronze(df, tmp_lake, key="stream-q-7")
    sink.append_bronze(df, tmp_lake, key="stream-q-7")  # the plan stood: this finishes it
    assert sink.append_bronze(df, tmp_lake, key="stream-q-7") is False
    assert sink.append_bronze(df, tmp_lake, key="stream-q-8")
    got = src.read_bronze(spark, tmp_lake)
    assert got.count() == 12 and got.select("event_id").distinct().count() == 6
    assert [e.partition("-")[2] for e, _ in Publisher(spark, tmp_lake).log("")] == ["stream-q-7", "stream-q-8"]


def test_a_failed_write_leaves_nothing(spark, raw_frame, tmp_lake):
    df = B.transform(raw_frame(_ride(1, 1)))
    bad = df.withColumn("city", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        sink.append_bronze(bad, tmp_lake, key="stream-q-1")
    assert Files(spark, tmp_lake).files(tmp_lake) == []
    assert sink.append_bronze(df, tmp_lake, key="stream-q-1") and src.read_bronze(spark, tmp_lake).count() == 3


def test_done_keys_are_bounded(spark, raw_frame, tmp_lake, monkeypatch):
    monkeypatch.setattr(Publisher, "KEEP_DONE", 2)
    df = B.transform(raw_frame(_ride(1, 1)))
    for k in range(4):
        assert sink.append_bronze(df, tmp_lake, key=f"stream-q-{k}")
    assert Publisher(spark, tmp_lake).files.names(f"{tmp_lake}/_publish/done") == ["stream-q-2", "stream-q-3"]
    assert sink.append_bronze(df, tmp_lake, key="stream-q-3") is False


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from triplake.session import build_session
from triplake.sinks.publish import Files, Publisher
from triplake.sources import bus
from triplake.streaming import bronze_stream
spark = build_session(master="local[2]", shuffle_partitions=2, conf={{"spark.checkpoint.dir": {lake!r}}})
spark.sparkContext.setLogLevel("OFF")
if {when!r} == "moved":      # files are visible, neither the key nor Spark's commit is written
    Publisher._forget = lambda *a: os._exit(7)
elif {when!r} == "planned":
    Files.move = (lambda plain: lambda self, a, b: plain(self, a, b) if "plan.json" in b else os._exit(7))(Files.move)
bronze_stream.run_available(bus.file_stream(spark, {lake!r} + "/topic", 1), {lake!r} + "/bronze", {lake!r} + "/ckpt")
"""


@pytest.mark.parametrize("when", ["moved", "planned"])
def test_a_driver_killed_between_write_and_commit_leaves_no_copy(spark, tmp_path, when):
    lake = str(tmp_path)
    spark.createDataFrame(envelope_rows(_ride(1, 1) + _ride(2, 2)), ENVELOPE_SCHEMA).coalesce(1).write.parquet(f"file://{lake}/topic")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = KILLED.format(root=root, lake=lake, when=when)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 7, done.stderr[-2000:]
    assert os.listdir(f"{lake}/ckpt/offsets") and not [f for f in os.listdir(f"{lake}/ckpt/commits") if not f.startswith(".")]
    bronze_stream.run_available(bus.file_stream(spark, f"file://{lake}/topic", 1), f"file://{lake}/bronze", f"file://{lake}/ckpt")
    got = src.read_bronze(spark, f"file://{lake}/bronze")
    assert got.count() == 6 and got.select("event_id").distinct().count() == 6


def test_silver_tables_change_together(spark, raw_frame, tmp_lake, monkeypatch):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, _ride(1, 1))
    jobs.run_silver(spark, paths, None)
    old = [_rows(jobs.read_silver_daily(spark, paths)), _rows(jobs.read_silver_hourly(spark, paths))]
    _land(raw_frame, paths, _ride(2, 1) + _ride(3, 2))
    plain = sink.SILVER_PARTITIONS
    from triplake.operators import silver as S
    hourly = S.hourly_demand
    monkeypatch.setattr(S, "hourly_demand", lambda b: hourly(b).withColumn("city", F.raise_error(F.lit("no")).cast("string")))
    with pytest.raises(Exception):  # the first table's files are written by then
        jobs.run_silver(spark, paths, None)
    assert [_rows(jobs.read_silver_daily(spark, paths)), _rows(jobs.read_silver_hourly(spark, paths))] == old and plain
    monkeypatch.setattr(S, "hourly_demand", hourly)
    _lose_after(monkeypatch, 1)
    with pytest.raises(Lost):
        jobs.run_silver(spark, paths, None)
    assert Publisher(spark, f"{tmp_lake}/silver").recover() == 1  # as the next job does first
    daily = {str(r.event_date): r.total_rides for r in jobs.read_silver_daily(spark, paths).collect()}
    assert daily == {"2024-01-01": 2, "2024-01-02": 1} and jobs.read_silver_hourly(spark, paths).count() == 2


def test_compaction_keeps_rows_and_bounds_files(spark, raw_frame, tmp_lake):
    cfg = LakeConfig(rebalance_appends=False)
    for k in range(5):
        sink.append_bronze(B.transform(raw_frame(_ride(2 * k, 1) + _ride(2 * k + 1, 2))).repartition(3), tmp_lake, cfg)
    before = _rows(src.read_bronze(spark, tmp_lake))
    files = Files(spark, tmp_lake)
    many = len(files.files(tmp_lake))
    newest = Publisher(spark, tmp_lake).newest()
    assert sink.compact_bronze(spark, tmp_lake, before="2024-01-02") == 3  # three types of one closed date
    names = [p for p, _ in files.files(tmp_lake)]
    assert sum(p.startswith("event_date=2024-01-01") for p in names) == 3 and len(names) < many
    assert sink.compact_bronze(spark, tmp_lake) == 3 and len(files.files(tmp_lake)) == 6
    assert sink.compact_bronze(spark, tmp_lake) == 0 and _rows(src.read_bronze(spark, tmp_lake)) == before
    size = max(n for _, n in files.files(tmp_lake))
    for k in range(4):
        sink.append_bronze(B.transform(raw_frame([e for i in range(30) for e in _ride(100 * k + i, 3)])), tmp_lake, cfg)
    assert sink.compact_bronze(spark, tmp_lake, target_bytes=5 * size) == 3
    hot = [p for p, _ in files.files(tmp_lake) if p.startswith("event_date=2024-01-03")]
    assert 3 <= len(hot) and src.read_bronze(spark, tmp_lake).count() == 30 + 360
    assert Publisher(spark, tmp_lake).log(newest) is not None
    assert all("2024-01-03" in p for _, parts in Publisher(spark, tmp_lake).log(newest) for p in parts)  # compaction is no change


def test_shuffle_free_appends_have_no_exchange(spark, raw_frame, tmp_lake):
    from tests.conftest import plan_text
    assert "Exchange" not in plan_text(B.transform(raw_frame(_ride(1, 1))))
    sink.append_bronze(B.transform(raw_frame(_ride(1, 1))), tmp_lake, LakeConfig(rebalance_appends=False))
    assert src.read_bronze(spark, tmp_lake).count() == 3


def _tables(spark, paths):
    tables = jobs.lake_tables(spark, paths)
    return {k: _rows(df.select(*sorted(df.columns))) for k, df in tables.items()}


def test_incremental_runs_equal_full_ones(spark, raw_frame, tmp_lake):
    """Late rides, late payments, a second payment, a new date, a changed dimension; only what changed is rewritten."""
    paths = jobs.LakePaths(tmp_lake)
    _seeds(spark, paths)
    late = [ev("r1_9", "payment_completed", time="2024-01-04T10:00:00.000000+00:00", amount=9.0)]
    twice = [ev("r2_1", "payment_completed", time="2024-01-04T11:00:00.000000+00:00", amount=1.0)]
    steps = [(_ride(1, 1) + _ride(1, 2) + _ride(1, 3) + _ride(9, 1)[:2], None),
             (_ride(2, 2), ["2024-01-02"]),
             (late, ["2024-01-01"]),
             (_ride(1, 4) + twice, ["2024-01-01", "2024-01-02", "2024-01-04"]),  # all rides paid on the fourth
             ([ev("nobody", "payment_completed", time="2024-01-04T12:00:00.000000+00:00", amount=2.0)], ["2024-01-01", "2024-01-02", "2024-01-04"]),
             ([], [])]
    for k, (events, dates) in enumerate(steps):
        if events:
            _land(raw_frame, paths, events)
        before = {p: n for p, n in Files(spark, paths.gold_fct_rides).files(paths.gold_fct_rides)}
        rep = P.run_daily(spark, paths, None, strict_tests=False)
        detail = {s: d for s, _, d in rep.steps}["gold_facts"]
        after = {p: n for p, n in Files(spark, paths.gold_fct_rides).files(paths.gold_fct_rides)}
        if dates is not None:
            assert detail == f"{len(dates)} ride dates", (k, detail)
            kept = {p.split("/")[0] for p in before if p in after}
            assert kept >= {p.split("/")[0] for p in before} - {f"ride_date={d}" for d in dates}
        if k in (0, 4):
            continue
        got = _tables(spark, paths)
        full = jobs.LakePaths(f"{tmp_lake}-full-{k}", bronze_root=paths.bronze)
        _seeds(spark, full)
        P.run_daily(spark, full, None, strict_tests=False, full=True)
        assert got == _tables(spark, full), k
    # ids repeated in dates that stay in place count for `unique`
    fifth = "2024-01-05T10:00:00.000000+00:00"
    _land(raw_frame, paths, [ev("r1_1", "ride_ended", time=fifth, duration_min=1.0, fare_amount=3.0),
                             ev("else", "payment_completed", time=fifth, amount=1.0)])
    rep = P.run_daily(spark, paths, None, strict_tests=False)
    assert "fct_rides.ride_id unique" in rep.failed_tests
    sink.write_seed(spark.createDataFrame([("driver_1", "A", 3.5, "Z", "go", "2023-01-01")],
                                          "driver_id string, driver_name string, rating double, home_zone string, "
                                          "primary_vehicle string, joined_date string"), paths.seed_drivers)
    rep = P.run_daily(spark, paths, None, strict_tests=False)
    assert {s: d for s, _, d in rep.steps}["gold_facts"] == ""  # all facts carry the dimension
    assert {r.driver_rating for r in jobs.read_gold(spark, paths)["fct_rides"].collect()} == {3.5}


def test_gold_catches_up_after_a_run_that_stopped_before_it(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _seeds(spark, paths)
    _land(raw_frame, paths, _ride(1, 1))
    P.run_daily(spark, paths, None)
    _land(raw_frame, paths, _ride(2, 1))
    jobs.run_silver(spark, paths, None)
    jobs.load_raw(spark, paths, incremental=True)  # and the driver is lost
    P.run_daily(spark, paths, None)
    assert jobs.read_gold(spark, paths)["fct_rides"].count() == 2


def test_trimmed_logs_lead_to_a_full_load(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    for d in (1, 2, 3):
        _land(raw_frame, paths, _ride(1, d))
    log = Publisher(spark, paths.bronze)
    entries = [e for e, _ in log.log("")]
    log.trim(entries[-1], keep=1)
    assert [e for e, _ in log.log(entries[1])] == entries[2:] and log.log(entries[0]) is None and log.log(None) is None


def test_readers_keep_the_last_good_facts(spark, raw_frame, tmp_lake):
    paths = jobs.LakePaths(tmp_lake)
    _seeds(spark, paths)
    _land(raw_frame, paths, _ride(1, 1))
    P.run_daily(spark, paths, None)
    good = _tables(spark, paths)
    _land(raw_frame, paths, [ev("r5", "ride_ended", duration_min=5.0, fare_amount=2.0, driver_id="unknown")])
    for full in (False, True):
        with pytest.raises(P.TableTestError, match="relationships"):
            P.run_daily(spark, paths, None, full=full)
        now = _tables(spark, paths)
        assert {k: v for k, v in now.items() if k[0] == "gold"} == {k: v for k, v in good.items() if k[0] == "gold"}
        assert spark.table("gold.fct_rides").count() == 1
    P.run_daily(spark, paths, None, strict_tests=False)
    assert spark.table("gold.fct_rides").count() == 2


def test_plan_files_are_whole_or_absent(spark, tmp_lake):
    files = Files(spark, tmp_lake)
    files.write(f"{tmp_lake}/a/x.json", json.dumps({"k": "ü"}))
    files.write(f"{tmp_lake}/a/x.json", json.dumps({"k": "ö"}))
    assert json.loads(files.read(f"{tmp_lake}/a/x.json")) == {"k": "ö"} and files.names(f"{tmp_lake}/a") == ["x.json"]
    assert files.names(f"{tmp_lake}/none") == [] and files.files(f"{tmp_lake}/none") == []
    with pytest.raises(Exception):
        files.move(f"{tmp_lake}/none", f"{tmp_lake}/b")


def test_gate_counts_by_date_equal_the_whole_history(spark, raw_frame, tmp_lake, monkeypatch):
    from triplake.operators import quality as Q
    paths, cfg = jobs.LakePaths(tmp_lake), LakeConfig()

    def report():
        counted = jobs.gate_counts(spark, paths, cfg)
        bronze, silver = src.read_bronze(spark, paths.bronze), jobs.read_silver_daily(spark, paths)
        got, want = (_rows(Q.gate_report(bronze, silver, cfg, c)) for c in (counted, None))
        assert got == want
        return {str(r.event_date): r.c3 for r in counted.collect()}

    _land(raw_frame, paths, _ride(1, 1, amount=-1.0) + _ride(2, 2))
    jobs.run_silver(spark, paths, None)
    assert report() == {"2024-01-01": 1, "2024-01-02": 0}
    files = {p for p, _ in Files(spark, tmp_lake).files(f"{tmp_lake}/quality/bronze_counts")}
    _land(raw_frame, paths, _ride(3, 2, amount=-2.0) + _ride(4, 3, amount=0.0))
    assert report() == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1}
    now = {p for p, _ in Files(spark, tmp_lake).files(f"{tmp_lake}/quality/bronze_counts")}
    assert {p for p in files if "2024-01-01" in p} <= now  # that date was not counted again
    sink.compact_bronze(spark, paths.bronze)
    assert report() == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1}
    cfg = LakeConfig(valid_cities=("Elsewhere",))
    assert set(report()) == {"2024-01-01", "2024-01-02", "2024-01-03"}


def test_an_interrupted_backfill_goes_on(spark, raw_frame, tmp_lake, monkeypatch):
    paths = jobs.LakePaths(tmp_lake)
    _land(raw_frame, paths, [e for d in range(1, 6) for e in _ride(d, d)])
    plain, calls = sink.replace_date_partitions, []

    def failing(tables, home, state=None):
        if len(calls) == 2:
            raise Lost
        calls.append(state["backfill"]["done"])
        plain(tables, home, state)

    monkeypatch.setattr(sink, "replace_date_partitions", failing)
    with pytest.raises(Lost):
        jobs.backfill_silver(spark, paths, dates_at_once=2)
    assert jobs.read_silver_daily(spark, paths).count() == 4
    monkeypatch.setattr(sink, "replace_date_partitions", plain)
    _land(raw_frame, paths, _ride(7, 2))  # a finished range gets a late ride
    assert jobs.backfill_silver(spark, paths, dates_at_once=2) == 2  # the range of the second and the last one
    got = {str(r.event_date): r.total_rides for r in jobs.read_silver_daily(spark, paths).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1, "2024-01-04": 1, "2024-01-05": 1}
    assert jobs.backfill_silver(spark, paths, dates_at_once=2) == 3  # a new backfill computes all


def test_lakes_and_other_owners_keep_their_names(spark, raw_frame, tmp_lake):
    from triplake.plans import namespaces as ns
    one, two = (jobs.LakePaths(f"{tmp_lake}/{n}", namespace=f"{n}_") for n in ("one", "two"))
    for paths, rides in ((one, _ride(1, 1)), (two, _ride(1, 1) + _ride(2, 2))):
        _seeds(spark, paths)
        _land(raw_frame, paths, rides)
        P.run_daily(spark, paths, None)
    assert [spark.table(f"{n}_gold.fct_rides").count() for n in ("one", "two")] == [1, 2]
    assert [spark.table(f"{n}_staging.stg_rides").count() for n in ("one", "two")] == [1, 2]
    P.run_daily(spark, one, None)  # its own names are pointed to its new tables
    spark.range(3).write.parquet(f"{tmp_lake}/foreign")
    other = jobs.LakePaths(f"{tmp_lake}/one", namespace="foreign_")
    ns.ensure_namespaces(spark, other)
    spark.catalog.createTable("foreign_raw.rides", path=f"{tmp_lake}/foreign", source="parquet")
    with pytest.raises(ValueError, match="not registered by a lake"):
        ns.register_raw(spark, other)
    assert spark.table("foreign_raw.rides").count() == 3
    spark.sql("DROP TABLE foreign_raw.rides")
    ns.register_raw(spark, other)
    spark.sql("CREATE VIEW foreign_staging.stg_rides AS SELECT 1 AS mine")
    with pytest.raises(ValueError, match="not registered by a lake"):
        ns.register_staging_views(spark, other)
    assert spark.table("foreign_staging.stg_rides").columns == ["mine"]
