"""Routing of airport rows into the eight per-source tables.

One pass: the eight "tables" are the ``source_data=<name>`` partitions of
one dataset, written with a single partitioned write instead of eight
filtered jobs. Reading one table is a partition-pruned scan. Rows with an
unknown or null source are not written to any table; they are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightlake.operators.enrich import airport_enrich
from flightlake.operators.parse import airport_parse
from flightlake.operators import folds
from flightlake.operators.upsert import BATCH, LOADED, STREAM, append_batch
from flightlake.schemas import AIRPORT_SOURCES

UNROUTED = "__unrouted__"


def routable(sources=None):
    """Predicate: the row belongs to one of the known tables."""
    return F.col("source_data").isin(list(sources or AIRPORT_SOURCES))


def route_counts(df: DataFrame, sources=None) -> DataFrame:
    """Rows per target table of a batch, plus one ``__unrouted__`` line."""
    target = F.when(routable(sources), F.col("source_data")).otherwise(F.lit(UNROUTED))
    return df.groupBy(target.alias("target")).agg(F.count(F.lit(1)).alias("n_rows"))


def routed_table(df: DataFrame, name: str) -> DataFrame:
    """One of the eight tables (as a filter on ``source_data``)."""
    if name not in AIRPORT_SOURCES:
        raise ValueError(f"unknown table {name!r}")
    return df.filter(F.col("source_data") == F.lit(name))


def write_routed(df: DataFrame, path: str, batch_id: int, stream_id: str = "batch",
                 sources=None) -> None:
    """Write the routable rows of one batch under ``path/source_data=<name>/``
    and the batch's replay key (``operators.upsert``): a replay replaces the
    batch's own rows, and no other batch or stream can."""
    append_batch(df.filter(routable(sources)), path, stream_id, batch_id, ("source_data",))


SOURCE = StructField("source_data", StringType())


def _schema(spark) -> StructType:
    return airport_enrich(airport_parse(spark.createDataFrame([], "value string"))).schema


def read_all_routed(spark, path: str) -> DataFrame:
    """All eight tables, their folds included; a folder without rows reads as empty."""
    return folds.read_folded(spark, path, _schema(spark), SOURCE).drop(LOADED, STREAM, BATCH)


def fold_routed(spark, path: str, tables=None) -> str | None:
    """Fold the complete batches of the eight tables (or of ``tables``) while
    streams write them: their files then follow their size, not the batches."""
    return folds.fold(spark, path, _schema(spark), lambda rows: folds.spread(rows, SOURCE.name), SOURCE,
                      only=(lambda c: c.isin(list(tables))) if tables else None)


def read_routed(spark, path: str, name: str) -> DataFrame:
    """Scan one table: the ``source_data`` filter prunes the other seven."""
    return routed_table(read_all_routed(spark, path), name)
