"""Join helpers. No side is hinted: the planner broadcasts a side only when its
measured size is under ``autoBroadcastJoinThreshold``, and AQE re-plans from the
real shuffle sizes at run time; above that it is a shuffle join that AQE can
split when skewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exists_in(df: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows of ``df`` whose ``fk`` has a row in ``dim`` (dimension key unique, so
    this equals an inner join that reads no dim column). A semi join ships
    only the key column of the dimension."""
    keys = dim.select(F.col(pk).alias(f"_k_{pk}"))
    return df.join(keys, F.col(fk) == F.col(f"_k_{pk}"), "left_semi")
