"""Run in a subprocess by test_resilience.py (needs its own SparkContext with
task retries): the first attempt of some tasks dies mid-write; the written
layers must come out exact, with no duplicate and no missing rows."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from triplake.session import build_session  # noqa: E402


def main() -> None:
    lake = tempfile.mkdtemp(prefix="triplake-resilience-")
    spark = build_session(master="local[2,4]", shuffle_partitions=4,
                          conf={"spark.checkpoint.dir": f"{lake}/ckpt"})
    spark.sparkContext.setLogLevel("ERROR")
    from triplake.operators import silver as S
    from triplake.plans import jobs
    from triplake.sinks.lake import append_bronze
    from triplake.sources import lake as src
    from tests.conftest import envelope_rows, ev
    from triplake.operators import bronze as B
    from triplake.schemas import ENVELOPE_SCHEMA

    @F.udf("boolean")
    def die_once(x):  # test-only fault: the first attempt of a task fails
        tc = TaskContext.get()
        if tc is not None and tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("simulated executor loss")
        return True

    events = []
    for i in range(200):
        r = f"r{i}"
        t = f"2024-01-0{1 + i % 3}T10:00:00.000000+00:00"
        events += [ev(r, "ride_requested", time=t),
                   ev(r, "ride_ended", time=t, duration_min=10.0, fare_amount=100.0),
                   ev(r, "payment_completed", time=t, amount=100.0)]
    raw = spark.createDataFrame(envelope_rows(events), ENVELOPE_SCHEMA).repartition(4)
    bronze = B.transform(raw).filter(die_once(F.col("ride_id")))
    paths = jobs.LakePaths(lake)
    append_bronze(bronze, paths.bronze)
    landed = src.read_bronze(spark, paths.bronze)
    jobs.run_silver(spark, paths, None, bronze=landed.filter(die_once(F.col("ride_id"))))
    daily = jobs.read_silver_daily(spark, paths)
    out = {
        "rows": landed.count(),
        "distinct_events": landed.select("event_id").distinct().count(),
        "silver": sorted((str(r["event_date"]), r["total_rides"], r["revenue_pkr"]) for r in daily.collect()),
        "expected_silver": sorted((str(r["event_date"]), r["total_rides"], r["revenue_pkr"])
                                  for r in S.daily_city_metrics(B.transform(raw)).collect()),
    }
    print("RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
