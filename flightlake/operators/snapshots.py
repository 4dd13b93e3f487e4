"""Snapshot table (K9): appended loads by day instead of a "current" file
rotated to "previous".

A load is rows of one or more snapshots, each of a page that has a name and a
number. Rows are kept under ``day=<d>/load_id=<id>``, in order of time, page
number and list position, so that a day of snapshots is a few files. Of several
loads of one page of a snapshot the latest counts, and a load with a given
``load_id`` that is written again replaces itself. No file is renamed, and a
failed write leaves the earlier snapshots untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType

from flightlake.functions.columns import utc_day
from flightlake.operators.folds import spread
from flightlake.session import path_exists

PAGE = "page"
PAGE_NO = "page_no"
DAY = "day"
LOAD = "load_id"
LOADED = "loaded_at"


def _day(df: DataFrame, time_col: str) -> Column:
    kind = df.schema[time_col].dataType
    if isinstance(kind, NumericType):
        return F.date_from_unix_date(F.floor(F.col(time_col) / F.lit(86_400)).cast("int"))
    return F.to_date(time_col) if isinstance(kind, TimestampNTZType) else utc_day(time_col)


def write_snapshot(df: DataFrame, path: str, time_col: str = "time", page: str = "0",
                   page_no: int | None = None, load_id: str | None = None) -> None:
    """Store state rows ``(time, pos, ...)`` of a page as one load.

    Pages are read back in the order of their numbers: ``page_no``, or the
    column of that name where ``df`` has one, or the number that the page's name
    is, else 0; then of their names. A column ``page`` holds several pages at once.
    """
    if page_no is None:
        page_no = int(page) if str(page).isdecimal() else 0
    rows = df.withColumns({
        DAY: _day(df, time_col),
        LOAD: F.lit(f"load-{load_id or uuid.uuid4().hex}"),
        LOADED: F.current_timestamp(),
        PAGE: (F.col(PAGE).cast("string") if PAGE in df.columns else F.lit(str(page))),
        PAGE_NO: (F.col(PAGE_NO) if PAGE_NO in df.columns else F.lit(page_no)).cast("int"),
    })
    (spread(rows, DAY).sortWithinPartitions(DAY, time_col, PAGE_NO, "pos")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY, LOAD).parquet(path))


def read_snapshots_table(spark: SparkSession, path: str, time_col: str = "time") -> DataFrame:
    """All stored rows, of the latest load of each page of a snapshot, with
    their page and ``day`` columns. Loads are compared on one row a page."""
    table = spark.read.option("basePath", path).parquet(path)
    last = (table.groupBy(F.col(time_col).alias("_t"), F.col(PAGE).alias("_p"))
            .agg(F.max(F.struct(LOADED, LOAD)).alias("_last"))
            .select("_t", "_p", F.col(f"_last.{LOAD}").alias("_load")))
    same = F.col(time_col).eqNullSafe(F.col("_t")) & (F.col(PAGE) == F.col("_p")) & (F.col(LOAD) == F.col("_load"))
    return table.join(last, same, "left_semi").drop(LOAD, LOADED)


def numbered(df: DataFrame, by: Sequence[str] = ("time",)) -> DataFrame:
    """Snapshot rows with the positions of all pages counted through, in the
    order of the pages' numbers (then names), and without the page. Only the
    sizes of the pages meet in one task of a snapshot."""
    by = list(by)
    sizes = df.groupBy(*by, PAGE_NO, PAGE).agg((F.max("pos") + 1).alias("_n"))
    before = Window.partitionBy(*by).orderBy(PAGE_NO, PAGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, PAGE_NO, PAGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (df.join(offsets, on=[*by, PAGE_NO, PAGE])
            .withColumn("pos", (F.col("_off") + F.col("pos")).cast("int")).drop("_off", PAGE_NO, PAGE))


def latest_two(spark: SparkSession, path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """``(previous, current)`` snapshots; ``None`` where a snapshot is missing.

    The two latest snapshots lie in the two latest days: only those days are
    read, and at most two times come back to the driver.
    """
    if not path_exists(spark, path):
        return None, None
    days = [r[0] for r in spark.read.option("basePath", path).parquet(path).select(DAY).distinct()
            .orderBy(F.col(DAY).desc()).limit(2).collect()]
    table = read_snapshots_table(spark, path).filter(F.col(DAY).isin(days)).drop(DAY)
    times = [r[0] for r in table.select("time").distinct()
             .orderBy(F.col("time").desc()).limit(2).collect()]
    pick = lambda t: numbered(table.filter(F.col("time") == F.lit(t)))
    current = pick(times[0]) if times else None
    previous = pick(times[1]) if len(times) > 1 else None
    return previous, current


def assign_positions(df: DataFrame, by: Sequence[str], order_col: str,
                     prefix_len: int = 4, pos_col: str = "pos") -> DataFrame:
    """Dense list positions 0..n-1 within each ``by`` group, in ``order_col``
    order (values unique within a group), without one task per group.

    Rows are split by the first ``prefix_len`` characters of ``order_col``
    (an order-preserving bucket). Each bucket numbers its own rows; a bucket's
    offset is the running total of the bucket counts before it, computed on
    the small count table (one row per group and bucket).
    """
    by = list(by)
    t = df.withColumn("_b", F.substring(F.col(order_col), 1, prefix_len))
    counts = t.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = t.withColumn("_r", F.row_number().over(
        Window.partitionBy(*by, "_b").orderBy(order_col)))
    return (local.join(offsets, on=by + ["_b"])
            .withColumn(pos_col, (F.col("_off") + F.col("_r") - 1).cast("int"))
            .drop("_b", "_r", "_off"))
