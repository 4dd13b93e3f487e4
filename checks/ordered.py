"""The order of a result as a column, so that a comparison that sorts both
sides still sees a wrong order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import checkpoint_root


def with_position(df: DataFrame) -> DataFrame:
    """``df`` with ``position``: the place (from 0) at which each row comes out.
    Only the sizes of its partitions meet in one task."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/ordered-{uuid.uuid4().hex}"
    # The id is the partition's number (upper 31 bits) and the place in it.
    df.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (rows.join(offsets, "_part")
            .withColumn("position", F.col("_off") + F.col("_id") - F.shiftleft("_part", 33))
            .select(*df.columns, "position"))
