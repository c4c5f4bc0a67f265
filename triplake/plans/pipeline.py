"""The nightly run: Silver -> quality gate -> RAW -> Gold + table tests.

A plain function calls the layer jobs in order and stops at the first
failure; scheduling, retries and alerting belong to whatever runs it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from triplake.config import LakeConfig
from triplake.operators import quality as Q
from triplake.plans import jobs
from triplake.plans import namespaces as ns
from triplake.session import configure
from triplake.sources import lake as src


DIMENSIONS = ("dim_driver", "dim_rider")
FACTS = ("fct_rides", "fct_daily_city_metrics", "fct_hourly_demand")


class TableTestError(RuntimeError):
    """Raised when a Gold table test fails and the run is strict."""


@dataclass
class RunReport:
    date: str | None
    steps: list = field(default_factory=list)  # (step, status, detail)
    failed_tests: str = ""

    def add(self, step: str, status: str, detail: str = "") -> None:
        self.steps.append((step, status, detail))

    @property
    def ok(self) -> bool:
        return all(s != "failed" for _, s, _ in self.steps)


def run_daily(spark: SparkSession, paths: jobs.LakePaths, date: str | None,
              cfg: LakeConfig = LakeConfig(), strict_tests: bool = True, full: bool = False) -> RunReport:
    """Run the batch side for ``date`` (None = every date in Bronze).

    A failed table test raises unless ``strict_tests`` is false, which records it as a warning. RAW rides and the ride fact are
    brought up to date by replacing the dates that changed since the last run, or reloaded whole with ``full`` and where the
    logs of the layers cannot tell what changed; the result is the same.
    """
    configure(spark)
    rep = RunReport(date)
    ns.ensure_namespaces(spark, paths)

    wrote = jobs.run_silver(spark, paths, date) if date or not full else jobs.backfill_silver(spark, paths) > 0
    rep.add("silver_batch", "ok" if wrote else "skipped", "" if wrote else "no Bronze rows")

    # the gate covers the whole history, not just the run's date; only dates that received rides are read again
    try:
        bronze = src.read_bronze(spark, paths.bronze)
        silver = jobs.read_silver_daily(spark, paths)
    except src.MissingLayerError as exc:
        rep.add("dq_gate", "failed", str(exc))
        raise
    report = Q.gate_report(bronze, silver, cfg, None if full else jobs.gate_counts(spark, paths, cfg))
    try:
        Q.enforce(report)
    except Q.DataQualityError as exc:
        rep.add("dq_gate", "failed", str(exc))
        raise
    rep.add("dq_gate", "ok")

    raw_schemas = jobs.load_raw(spark, paths, incremental=not full)
    ns.register_raw(spark, paths, raw_schemas)
    ns.register_staging_views(spark, paths)
    rep.add("load_raw", "ok")

    tested_gold(spark, paths, cfg, rep, strict_tests, incremental=not full)
    if rep.failed_tests and strict_tests:
        raise TableTestError(rep.failed_tests)
    return rep


def tested_gold(spark: SparkSession, paths: jobs.LakePaths, cfg: LakeConfig, rep: RunReport, strict_tests: bool = False,
                incremental: bool = False) -> list:
    """Gold in dependency order: written aside, tested, then published. Returns the test rows (14 at most).

    A failed dimension test skips the facts and publishes nothing; so does a failed fact test of a strict run. Readers then
    keep the models of the last good run.
    """
    build = jobs.GoldBuild(spark, paths, incremental)
    build.write(list(DIMENSIONS))
    tests = Q.dim_tests(build.tables()).collect()
    rep.failed_tests = _failures(tests)
    rep.add("gold_dims", "failed" if rep.failed_tests else "ok")
    if rep.failed_tests:
        rep.add("gold_facts", "skipped", "dimension tests failed")
        return tests
    build.write(list(FACTS))
    rep.add("gold_facts", "ok", "" if build.dates is None else f"{len(build.dates)} ride dates")
    tests += Q.fact_tests(build.tables(), cfg, build.rides_of_other_dates()).collect()
    rep.failed_tests = _failures(tests)
    if not (rep.failed_tests and strict_tests):
        ns.register_gold(spark, paths, build.publish())
        ns.register_seeds(spark, paths)
    rep.add("table_tests", "warn" if rep.failed_tests else "ok", rep.failed_tests)
    return tests


def _failures(tests: list) -> str:
    return "; ".join(f"{t['model']}.{t['column_name']} {t['test']}: {t['failures']}" for t in tests if t["status"] != "pass")


def backfill(spark: SparkSession, paths: jobs.LakePaths, cfg: LakeConfig = LakeConfig(),
             strict_tests: bool = True) -> RunReport:
    """Every date found in Bronze, all layers whole. An interrupted one goes on with the dates that Silver still lacks."""
    return run_daily(spark, paths, None, cfg, strict_tests, full=True)
