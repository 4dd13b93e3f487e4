"""Keyed upsert (K2) and fact append (K3) on plain parquet, by appending.

A batch writes only its own rows, one per key for a dimension, under
``stream_id=<s>/batch_id=<n>`` with the time they were loaded. The pair is the
replay key: a replayed batch overwrites its own folder and no other, and two
streams, or a stream with a new checkpoint (which counts batches from 0 again),
have ids of their own and cannot meet. Reading a dimension keeps one row per
key, the one loaded last, so the cost of a batch is the batch's size;
``operators.folds`` folds complete batches while the streams run, and the
compaction job (``plans.star_load.compact``) copies a table at rest.

Tables are read with their declared schema: a missing folder, or one where no
batch has written rows yet, is an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from flightlake.functions.columns import utc_day
from flightlake.operators.dedup import desc_last, latest_per_key
from flightlake.session import path_exists

STREAM = "stream_id"
BATCH = "batch_id"
LOADED = "loaded_at"
DAY = "day"
DAY_FIELD = StructField(DAY, DateType())


def merge_upsert(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Insert-or-replace by ``key``: rows of ``batch`` win (one per key expected)."""
    kept = existing.join(batch.select(key), on=key, how="left_anti")
    return kept.unionByName(batch.select(*existing.columns))


def append_batch(rows: DataFrame, path: str, stream_id: str, batch_id: int,
                 partition: tuple[str, ...] = ()) -> None:
    """Write one batch under its replay key, inside the folders of ``partition``."""
    out = rows.withColumns({LOADED: F.current_timestamp(), STREAM: F.lit(str(stream_id)),
                            BATCH: F.lit(int(batch_id)).cast("bigint")})
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition, STREAM, BATCH).parquet(path))


def storage_schema(schema: StructType, unit: StructField | None = None) -> StructType:
    """``schema`` with the storage columns, and ``unit`` if it is none of its columns."""
    extra = [StructField(LOADED, TimestampType()), StructField(STREAM, StringType()),
             StructField(BATCH, LongType())]
    return StructType([*schema.fields, *extra, *([unit] if unit and unit.name not in schema.names else [])])


def read_batches(spark: SparkSession, path: str, schema: StructType,
                 unit: StructField | None = None) -> DataFrame:
    """All batches of a table with ``schema`` and the storage columns. ``unit``
    is the column of the outer folders, if there is one."""
    full = storage_schema(schema, unit)
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def latest_rows(batches: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: of the load that came last. Storage columns stay."""
    return latest_per_key(batches, [key], [desc_last(LOADED), desc_last(BATCH), desc_last(STREAM)])


def read_table(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """A dimension, its folds included: one row per key, without the storage columns."""
    from flightlake.operators.folds import read_folded

    return latest_rows(read_folded(spark, path, schema), key).drop(LOADED, STREAM, BATCH)


def fact_layout(rows: DataFrame, time_col: str = "fk_temps") -> DataFrame:
    """Fact rows with their UTC day, dealt out in ranges of days and times and in
    order, so that a window of minutes skips files and row groups."""
    out = rows.withColumn(DAY, utc_day(time_col))
    return out.repartitionByRange(DAY, time_col).sortWithinPartitions(DAY, time_col)


def append_fact(rows: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Append one batch's rows, in their ``fact_layout``, by day."""
    append_batch(rows, path, stream_id, batch_id, (DAY,))
