"""Layer jobs: each reads a landed layer and writes the next one.

Layers are written tables, so every job starts from files: lineage never
spans layers and a lost executor only re-runs tasks of the current job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import LakeConfig
from triplake.operators import bronze as B
from triplake.operators import gold as G
from triplake.operators import quality as Q
from triplake.operators import raw as R
from triplake.operators import silver as S
from triplake.schemas import DAILY_CITY_METRICS_SCHEMA, HOURLY_DEMAND_SCHEMA, SEED_DRIVERS_SCHEMA, SEED_RIDERS_SCHEMA
from triplake.sinks import lake as sink
from triplake.sinks.publish import Publisher
from triplake.sources import lake as src


@dataclass(frozen=True)
class LakePaths:
    """Folder layout of one lake under a shared root."""

    root: str
    bronze_root: str | None = None  # share an already landed Bronze
    silver_root: str | None = None  # Silver elsewhere (holds daily_city_metrics/, hourly_demand/)
    namespace: str = ""  # prefix of the lake's catalog namespaces

    def __getattr__(self, name: str) -> str:  # bronze, silver_daily, raw_rides, ...
        if name.startswith("_"):
            raise AttributeError(name)
        if name == "bronze" and self.bronze_root:
            return self.bronze_root
        if name in ("silver_daily", "silver_hourly") and self.silver_root:
            sub = "daily_city_metrics" if name == "silver_daily" else "hourly_demand"
            return f"{self.silver_root.rstrip('/')}/{sub}"
        layout = {
            "bronze": "bronze",
            "silver_daily": "silver/daily_city_metrics",
            "silver_hourly": "silver/hourly_demand",
            "raw_rides": "raw/rides",
            "raw_daily": "raw/silver_daily_city_metrics",
            "raw_hourly": "raw/silver_hourly_demand",
            "seed_drivers": "seeds/seed_drivers",
            "seed_riders": "seeds/seed_riders",
        }
        if name in layout:
            return f"{self.root}/{layout[name]}"
        if name.startswith("gold_"):
            return f"{self.root}/gold/{name[5:]}"
        raise AttributeError(name)


GOLD_MODELS = ("dim_driver", "dim_rider", "fct_rides", "fct_daily_city_metrics", "fct_hourly_demand")
# the ride fact grows with volume: partition it by date so date-bounded reads
# prune. The daily/hourly facts stay whole: cities x days (x 24) rows at any
# scale, where one folder per day would only mean many tiny files.
GOLD_PARTITIONS = {"fct_rides": ("ride_date",)}
# RAW rides too, so that a run can replace the dates that changed
RAW_PARTITIONS = ("EVENT_DATE",)


# -- Bronze ------------------------------------------------------------------ #
def land_bronze(raw: DataFrame, paths: LakePaths, cfg: LakeConfig) -> None:
    """Batch backfill of bus messages into Bronze (same transform as the stream)."""
    sink.append_bronze(B.transform(raw, cfg), paths.bronze, cfg)


# -- Silver ------------------------------------------------------------------ #
def run_silver(spark: SparkSession, paths: LakePaths, date: str | None = None,
               bronze: DataFrame | None = None) -> bool:
    """Recompute Silver for one date (or all dates) from Bronze.

    Returns False and writes nothing when the selection is empty: old
    partitions stay as they are. Only the dates produced are replaced.
    """
    if bronze is None:
        bronze = src.read_bronze(spark, paths.bronze, [date] if date else None)
    bronze = S.for_date(bronze, date)
    if bronze.isEmpty():
        return False
    sink.replace_date_partitions({paths.silver_daily: S.daily_city_metrics(bronze), paths.silver_hourly: S.hourly_demand(bronze)},
                                 paths.silver_daily.rpartition("/")[0])
    return True


def backfill_silver(spark: SparkSession, paths: LakePaths, dates_at_once: int = 31) -> int:
    """Recompute Silver for every date in Bronze, some dates at a time; returns how many such ranges this call computed.

    Each range is recorded as done in the same publication as its partitions. A backfill that was interrupted goes on where it
    stopped; ranges with dates that Bronze has received since are computed again. After the last range the record is cleared.
    """
    home = paths.silver_daily.rpartition("/")[0]
    silver, landed = Publisher(spark, home), Publisher(spark, paths.bronze)
    silver.recover()
    bronze = src.read_bronze(spark, paths.bronze)
    dates = [n.partition("=")[2] for n in silver.files.names(paths.bronze) if n.startswith("event_date=")]
    state = silver.state()
    before = state.get("backfill") or {"since": landed.newest(), "done": []}
    log = landed.log(before["since"])
    stale = None if log is None else {p.split("/")[0].partition("=")[2] for _, parts in log for p in parts}
    done = [] if stale is None and before["done"] else [d for d in before["done"] if d not in (stale or ())]
    since, computed = landed.newest(), 0
    for k in range(0, len(dates), dates_at_once):
        own = dates[k:k + dates_at_once]
        if set(own) <= set(done):
            continue
        rows = bronze.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in own]))
        done = sorted({*done, *own})
        sink.replace_date_partitions({paths.silver_daily: S.daily_city_metrics(rows), paths.silver_hourly: S.hourly_demand(rows)}, home,
                                     {**state, "backfill": {"since": since, "done": done}})
        computed += 1
    silver.publish(sink.new_key("backfill"), state={**state, "backfill": None}, touched=[])
    return computed


# -- quality gate ------------------------------------------------------------- #
def gate_counts(spark: SparkSession, paths: LakePaths, cfg: LakeConfig) -> DataFrame:
    """The Bronze checks' violations, a row a date, kept beside the lake: only dates that received rides are read again.

    All dates are counted anew where the Bronze log cannot tell what changed or the checks are others.
    """
    checks = Q.bronze_rides_checks(cfg)
    landed, quality = Publisher(spark, paths.bronze), Publisher(spark, f"{paths.root}/quality")
    quality.recover()
    table, state = f"{paths.root}/quality/bronze_counts", quality.state()
    upto, named = landed.newest(), repr(checks)
    log = landed.log(state.get("bronze")) if state.get("checks") == named else None
    rides = B.slice_type(src.read_bronze(spark, paths.bronze), "ride_ended")
    if log is not None:
        touched = {p.split("/")[0].partition("=")[2] for _, parts in log for p in parts if p.endswith("=ride_ended")}
        rides = rides.filter(F.col("event_date").isin([F.lit(d).cast("date") for d in sorted(touched)]))
    counts = rides.groupBy("event_date").agg(*Q.violations(checks))
    key = sink.new_key("counts")
    staged = {f"{quality.stage(key)}/counts": table}
    sink.write_table(counts, *staged, ("event_date",))
    quality.publish(key, **{"replace" if log is None else "replace_parts": staged}, state={"bronze": upto, "checks": named}, touched=[])
    return spark.read.schema(counts.schema).parquet(table)


def read_silver_daily(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """Declared schema: no inference, and a table written empty (only a
    success marker, no data file) reads as empty instead of failing."""
    return src.read_layer(spark, paths.silver_daily, "silver", DAILY_CITY_METRICS_SCHEMA)


def read_silver_hourly(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return src.read_layer(spark, paths.silver_hourly, "silver", HOURLY_DEMAND_SCHEMA)


# -- RAW ------------------------------------------------------------------- #
def raw_schemas(spark: SparkSession) -> dict:
    """Columns of the RAW tables by attribute name, as their writers make them."""
    frames = {"rides": R.build_rides(spark.createDataFrame([], src.BRONZE_SCHEMA)),
              "daily": spark.createDataFrame([], DAILY_CITY_METRICS_SCHEMA), "hourly": spark.createDataFrame([], HOURLY_DEMAND_SCHEMA)}
    return {t: R.upper_columns(df).schema for t, df in frames.items()}


def load_raw(spark: SparkSession, paths: LakePaths, incremental: bool = False) -> dict:
    """Reload the three RAW tables from the lake, all or none.

    ``incremental`` replaces only the dates of ``rides`` that can have changed since the last load (``changed_dates``); where the
    Bronze log cannot tell, and by default, the whole table is reloaded. Returns the written schemas by table name (for
    catalog registration).
    """
    landed, raw = Publisher(spark, paths.bronze), Publisher(spark, f"{paths.root}/raw")
    raw.recover()
    upto = landed.newest()
    log = landed.log(raw.state().get("bronze")) if incremental else None
    bronze = src.read_bronze(spark, paths.bronze)
    dates = None if log is None else changed_dates(bronze, log)
    if dates is not None:
        bronze = bronze.filter((F.col("event_type") == "payment_completed") | F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
    rides = R.upper_columns(R.build_rides(bronze))
    aggregates = {paths.raw_daily: R.upper_columns(read_silver_daily(spark, paths)),
                  paths.raw_hourly: R.upper_columns(read_silver_hourly(spark, paths))}
    key = sink.new_key("raw")
    stage = raw.stage(key)
    whole = {}
    for path, df in aggregates.items():
        staged = f"{stage}/{path.rpartition('/')[2]}"
        sink.write_table(df, staged)
        whole[staged] = path
    if dates is None or dates:
        sink.write_table(rides, f"{stage}/rides", RAW_PARTITIONS)
    names = [f"{RAW_PARTITIONS[0]}={d}" for d in dates or []]
    raw.publish(key, replace=whole if dates is not None else {**whole, f"{stage}/rides": paths.raw_rides},
                replace_parts={f"{stage}/rides": paths.raw_rides} if dates else None,
                state={"bronze": upto}, touched=["*"] if dates is None else names)
    landed.trim(upto)
    schemas = [df.schema for df in (rides, *aggregates.values())]
    return dict(zip(("rides", "silver_daily_city_metrics", "silver_hourly_demand"), schemas))


def changed_dates(bronze: DataFrame, log: list[tuple[str, list[str]]]) -> list[str]:
    """Ride dates whose rows in RAW can differ after the logged changes: dates that received rides, dates of rides that
    received payments.

    The second reads the ride ids of all ended rides (one column, no date is rewritten for it); payment partitions that did not
    change are not read.
    """
    touched = {tuple(part.split("=")[1] for part in folder.split("/")) for _, folders in log for folder in folders}
    rides, paid = ({d for d, kind in touched if kind == wanted} for wanted in ("ride_ended", "payment_completed"))
    if paid:
        ids = B.slice_type(bronze, "payment_completed").filter(F.col("event_date").isin([F.lit(d).cast("date") for d in sorted(paid)]))
        ended = B.slice_type(bronze, "ride_ended").select("ride_id", "event_date")
        found = ended.join(ids.select("ride_id").distinct(), "ride_id", "left_semi").select("event_date").distinct()
        rides |= {str(r["event_date"]) for r in found.collect()}  # one row a date
    return sorted(rides)


def read_raw(spark: SparkSession, paths: LakePaths, table: str) -> DataFrame:
    """RAW tables addressed by name; columns come back lower-case."""
    return R.lower_columns(raw_table(spark, paths, table))


def raw_table(spark: SparkSession, paths: LakePaths, table: str) -> DataFrame:
    """A RAW table with its upper-case columns; the schema is declared, so a table without files reads as empty."""
    return src.read_layer(spark, getattr(paths, f"raw_{table}"), "raw", raw_schemas(spark)[table])


# -- Gold -------------------------------------------------------------------- #
def write_seeds(drivers: DataFrame, riders: DataFrame, paths: LakePaths) -> None:
    sink.write_seed(drivers, paths.seed_drivers)
    sink.write_seed(riders, paths.seed_riders)


def gold_models(spark: SparkSession, paths: LakePaths, rides: DataFrame | None = None) -> dict[str, DataFrame]:
    """Gold models as lazy plans over RAW tables and seeds (dependency order); ``rides`` instead of all RAW rides."""
    drivers = G.dim_driver(src.read_seed_drivers(spark, paths.seed_drivers))
    riders = G.dim_rider(src.read_seed_riders(spark, paths.seed_riders))
    rides = read_raw(spark, paths, "rides") if rides is None else rides
    return _models(drivers, riders, rides, read_raw(spark, paths, "daily"), read_raw(spark, paths, "hourly"))


def _models(drivers: DataFrame, riders: DataFrame, rides: DataFrame, daily: DataFrame, hourly: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_driver": drivers,
        "dim_rider": riders,
        "fct_rides": G.fct_rides(G.stg_rides(rides), drivers, riders),
        "fct_daily_city_metrics": G.fct_daily_city_metrics(G.stg_daily_city_metrics(daily)),
        "fct_hourly_demand": G.fct_hourly_demand(G.stg_hourly_demand(hourly)),
    }


def gold_schemas(spark: SparkSession) -> dict:
    """Columns of the Gold models, as their writers make them."""
    raw = [R.lower_columns(spark.createDataFrame([], s)) for s in raw_schemas(spark).values()]
    drivers, riders = (spark.createDataFrame([], s) for s in (SEED_DRIVERS_SCHEMA, SEED_RIDERS_SCHEMA))
    return {m: df.schema for m, df in _models(G.dim_driver(drivers), G.dim_rider(riders), *raw).items()}


class GoldBuild:
    """Gold models written beside the published ones, so that they can be tested before readers see them.

    An incremental build stages only the dates of ``fct_rides`` that RAW has replaced since the last publication; it is a full one
    where the RAW log cannot tell or a dimension has changed (its rows stand in all facts).
    """

    def __init__(self, spark: SparkSession, paths: LakePaths, incremental: bool = False) -> None:
        self.spark, self.paths = spark, paths
        self.gold, raw = Publisher(spark, f"{paths.root}/gold"), Publisher(spark, f"{paths.root}/raw")
        self.gold.recover()
        raw.recover()
        self.key = sink.new_key("gold")
        self.stage = self.gold.stage(self.key)
        self.written: list[str] = []
        self.dates: list[str] | None = None  # None: the whole table
        state = self.gold.state()
        self.state = {"raw": raw.newest(), "dimensions": self._dimensions() if incremental else None}
        log = raw.log(state.get("raw")) if incremental and state.get("dimensions") == self.state["dimensions"] else None
        if log is not None and not any("*" in parts for _, parts in log):
            self.dates = sorted({p.partition("=")[2] for _, parts in log for p in parts})
        rides = None
        if self.dates is not None:
            rides = read_raw(spark, paths, "rides").filter(F.col("event_date").isin([F.lit(d).cast("date") for d in self.dates]))
        self.plans = gold_models(spark, paths, rides)

    def _dimensions(self) -> str:
        """A digest of both dimensions' rows, whatever their order."""
        parts = []
        for df in (src.read_seed_drivers(self.spark, self.paths.seed_drivers), src.read_seed_riders(self.spark, self.paths.seed_riders)):
            r = df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(F.lit(k), *df.columns).cast("decimal(38,0)")) for k in range(2)]).first()
            parts.append(":".join(map(str, r)))
        return ",".join(parts)

    def write(self, models) -> None:
        for name in models:
            sink.write_table(self.plans[name], f"{self.stage}/{name}", GOLD_PARTITIONS.get(name, ()))
        self.written += models

    def tables(self) -> dict[str, DataFrame]:
        """The staged models."""
        schemas = gold_schemas(self.spark)
        return {m: self.spark.read.schema(schemas[m]).parquet(f"{self.stage}/{m}") for m in self.written}

    def rides_of_other_dates(self) -> DataFrame | None:
        """Published rides that an incremental build leaves in place and whose ids it has staged too (a repeat, normally none)."""
        if self.dates is None:
            return None
        published = read_gold_partial(self.spark, self.paths, ("fct_rides",))["fct_rides"]
        kept = published.filter(~F.col("ride_date").isin([F.lit(d).cast("date") for d in self.dates]))
        return kept.join(self.tables()["fct_rides"].select("ride_id").distinct(), "ride_id", "left_semi").select(*published.columns)

    def publish(self) -> dict:
        """Put the staged models in place of the published ones, all or none; returns their schemas."""
        parts = ["fct_rides"] if self.dates is not None and "fct_rides" in self.written else []
        staged = lambda names: {f"{self.stage}/{m}": getattr(self.paths, f"gold_{m}") for m in names}
        whole = set(GOLD_MODELS) <= set(self.written)
        self.gold.publish(self.key, replace=staged(m for m in self.written if m not in parts), replace_parts=staged(parts),
                          state=self.state if whole else None, touched=[])
        schemas = gold_schemas(self.spark)
        return {m: schemas[m] for m in self.written}


def build_gold(spark: SparkSession, paths: LakePaths, models=GOLD_MODELS) -> dict:
    """Materialise Gold models as tables, whole and without tests.

    Returns the written schemas by model name (for catalog registration).
    """
    build = GoldBuild(spark, paths)
    build.write(list(models))
    return build.publish()


def read_gold(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    return read_gold_partial(spark, paths, GOLD_MODELS)


def read_gold_partial(spark: SparkSession, paths: LakePaths, models) -> dict[str, DataFrame]:
    schemas = gold_schemas(spark)
    return {m: src.read_layer(spark, getattr(paths, f"gold_{m}"), "gold", schemas[m]) for m in models}


def lake_tables(spark: SparkSession, paths: LakePaths) -> dict[tuple[str, str], DataFrame]:
    """Every RAW and Gold table, for the row-count report."""
    out = {("raw", t): raw_table(spark, paths, t) for t in ("rides", "daily", "hourly")}
    names = {"daily": "silver_daily_city_metrics", "hourly": "silver_hourly_demand"}
    out = {(layer, names.get(t, t)): df for (layer, t), df in out.items()}
    for m, df in read_gold(spark, paths).items():
        out[("gold", m)] = df
    return out

