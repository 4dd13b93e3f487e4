"""Stored tables as Spark SQL temporary views, under the names the dashboards
query (``fait_etat_vol``, ``dim_pays``, ..., ``airfields``, ``hotspots``, ...).

Nothing is parsed or rewritten here: the views are the stored DataFrames, so
SQL over them gets the same pushdown and partition pruning as the DataFrame
functions in ``plans.dashboard`` / ``plans.airfields``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from flightlake.operators.route import read_routed
from flightlake.plans.star_load import read_star
from flightlake.schemas import AIRPORT_SOURCES


def register_views(spark: SparkSession, warehouse: str | None = None,
                   tables_path: str | None = None) -> list[str]:
    """Register the star tables (from ``warehouse``) and the eight airport
    tables (from ``tables_path``); returns the view names."""
    names = []
    if warehouse:
        for name, df in read_star(spark, warehouse).items():
            df.createOrReplaceTempView(name)
            names.append(name)
    if tables_path:
        for name in AIRPORT_SOURCES:
            read_routed(spark, tables_path, name).createOrReplaceTempView(name)
            names.append(name)
    return names
