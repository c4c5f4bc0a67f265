"""Layers addressable by name: ``raw.*`` and ``gold.*`` tables, ``staging`` views.

Namespaces are created with an explicit location under the lake root, so
the catalog never falls back to a machine-local warehouse folder. Tables
are registered as external tables over the layer folders (seeds as CSV
tables beside Gold); staging models are catalog views ``staging.stg_*``
over ``raw.*``, which other sessions of the catalog see too. Every name
carries its lake's root as a property: only such names are pointed to
another folder, any other table or view of the name is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplake.operators import gold as G
from triplake.plans import jobs
from triplake.schemas import SEED_DRIVERS_SCHEMA, SEED_RIDERS_SCHEMA

RAW_TABLES = {"rides": "raw_rides", "silver_daily_city_metrics": "raw_daily",
              "silver_hourly_demand": "raw_hourly"}


OWNER = "triplake.lake"  # property of every table and view registered here: the lake's root


def named(paths: jobs.LakePaths, layer: str) -> str:
    """A layer's namespace; lakes that share a catalog have prefixes of their own."""
    return f"{paths.namespace}{layer}"


def ensure_namespaces(spark: SparkSession, paths: jobs.LakePaths,
                      names=("raw", "staging", "gold")) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for each layer, located in the lake."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {named(paths, n)} LOCATION '{paths.root}/_catalog/{named(paths, n)}.db'")


def _owned(spark: SparkSession, name: str) -> bool:
    """Whether an existing table or view was registered by a lake (and so may be pointed elsewhere)."""
    return OWNER in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _refuse_foreign(spark: SparkSession, name: str, root: str) -> None:
    """Raise if ``name`` exists and is not a lake's own: replacing it would lose someone's table, entry or view."""
    if spark.catalog.tableExists(name) and not _owned(spark, name):
        raise ValueError(f"{name} exists and was not registered by a lake; drop or rename it, or give the lake at {root} "
                         "a namespace prefix, before registering")


def _register(spark: SparkSession, name: str, path: str, schema=None, source: str = "parquet", root: str = "", **options: str) -> None:
    """External table over ``path``.

    With the schema the writer just used, nothing is inferred and date
    folders are discovered (and pruned) by the file index at read time;
    without it the schema is inferred and partition folders registered.
    """
    _refuse_foreign(spark, name, root)
    # dropping an external table only forgets it, the files stay
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=source, schema=schema, **options)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{OWNER}' = '{root or path}')")
    if schema is None and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def register_raw(spark: SparkSession, paths: jobs.LakePaths, schemas: dict | None = None) -> None:
    for table, attr in RAW_TABLES.items():
        _register(spark, f"{named(paths, 'raw')}.{table}", getattr(paths, attr), (schemas or {}).get(table), root=paths.root)


def register_gold(spark: SparkSession, paths: jobs.LakePaths, schemas: dict | None = None) -> None:
    for m in jobs.GOLD_MODELS:
        _register(spark, f"{named(paths, 'gold')}.{m}", getattr(paths, f"gold_{m}"), (schemas or {}).get(m), root=paths.root)


def register_seeds(spark: SparkSession, paths: jobs.LakePaths) -> None:
    """``gold.seed_drivers`` and ``gold.seed_riders`` over the seed CSV folders, with their declared types."""
    for name, path, schema in (("seed_drivers", paths.seed_drivers, SEED_DRIVERS_SCHEMA),
                               ("seed_riders", paths.seed_riders, SEED_RIDERS_SCHEMA)):
        _register(spark, f"{named(paths, 'gold')}.{name}", path, schema, source="csv", root=paths.root, header="true", enforceSchema="false",
                  mode="FAILFAST")


def register_staging_views(spark: SparkSession, paths: jobs.LakePaths) -> dict[str, DataFrame]:
    """Staging models as catalog views ``staging.stg_*`` over ``raw.*``, and by their short names in this session."""
    raw, staging = named(paths, "raw"), named(paths, "staging")
    models = {
        "stg_rides": (G.STG_RIDES, f"{raw}.rides WHERE {G.STG_RIDES_ROWS}"),
        "stg_daily_city_metrics": (G.STG_DAILY, f"{raw}.silver_daily_city_metrics"),
        "stg_hourly_demand": (G.STG_HOURLY, f"{raw}.silver_hourly_demand"),
    }
    views = {}
    for name, (columns, rows) in models.items():
        _refuse_foreign(spark, f"{staging}.{name}", paths.root)
        spark.sql(f"CREATE OR REPLACE VIEW {staging}.{name} TBLPROPERTIES ('{OWNER}' = '{paths.root}') AS "
                  f"SELECT {', '.join(columns)} FROM {rows}")
        views[name] = spark.table(f"{staging}.{name}")
        views[name].createOrReplaceTempView(name)
    return views


def register_all(spark: SparkSession, paths: jobs.LakePaths) -> None:
    ensure_namespaces(spark, paths)
    register_raw(spark, paths)
    register_gold(spark, paths)
    register_seeds(spark, paths)
    register_staging_views(spark, paths)
