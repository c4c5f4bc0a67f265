import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from triplake.session import build_session

    # catalog tests create databases: keep the session's default warehouse
    # out of the working directory (a cluster names its own)
    s = build_session(app_name="triplake-tests", master="local[4]", shuffle_partitions=4,
                      conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="triplake-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(spark):
    """A fresh folder under the session's shared dir."""
    from triplake.session import scratch_path

    return scratch_path(spark, "test")


def envelope_rows(events):
    """dicts (or raw strings) -> (key, value, timestamp) rows."""
    import datetime as dt

    out = []
    for e in events:
        value = e if isinstance(e, str) or e is None else json.dumps(e)
        key = e.get("ride_id") if isinstance(e, dict) else None
        out.append((key, value, dt.datetime(2024, 1, 1, 12, 0, 0)))
    return out


@pytest.fixture()
def raw_frame(spark):
    from triplake.schemas import ENVELOPE_SCHEMA

    def make(events):
        return spark.createDataFrame(envelope_rows(events), ENVELOPE_SCHEMA)

    return make


def ev(ride, etype, time="2024-01-01T10:00:00.000000+00:00", city="Karachi", **kw):
    d = {"event_id": f"{ride}#{etype}", "event_type": etype, "event_time": time, "ride_id": ride,
         "city": city, "rider_id": "rider_1", "driver_id": "driver_1", "vehicle_type": "go"}
    d.update(kw)
    return d


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="triplake-test-")


def plan_text(df) -> str:
    """The physical plan as printed by ``explain`` (captured)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
