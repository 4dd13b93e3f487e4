"""Airport-table dashboard queries (Q9-Q12) and the ordered preview.

``LIMIT 50`` with no ORDER BY returns any 50 rows; here a preview always has
an order (given, or all output columns), so the result is reproducible. Spark
plans it as ``TakeOrderedAndProject``: each task keeps its own top 50 and only
those meet in the final step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREVIEW_ROWS = 50

AIRFIELD_TABLE_COLUMNS = ["name", "country", "longitude", "latitude", "altitude_estimee_m",
                          "climat", "timestamp_ingestion", "geo_score", "source_data"]


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by=None) -> DataFrame:
    """First ``n`` rows under ``order_by`` (default: every column, nulls last)."""
    cols = order_by or df.columns
    order = [c if not isinstance(c, str) else F.col(c).asc_nulls_last() for c in cols]
    return df.orderBy(*order).limit(n)


def airfield_preview(airfields: DataFrame, n: int = PREVIEW_ROWS, order_by=None) -> DataFrame:
    """Q9: ``SELECT * FROM airfields`` preview."""
    return preview(airfields, n, order_by)


def hotspot_geo_score(hotspots: DataFrame) -> DataFrame:
    """Q10: mean geographic score over the hotspots table (one row)."""
    return hotspots.agg(F.avg("geo_score").alias("avg"))


def airfield_table(airfields: DataFrame, n: int = PREVIEW_ROWS, order_by=None,
                   columns=None) -> DataFrame:
    """Q11: the 9-column airfields table preview."""
    cols = columns or AIRFIELD_TABLE_COLUMNS
    return preview(airfields.select(*cols), n, order_by)


def country_altitude(airports: DataFrame, n: int = PREVIEW_ROWS, order_by=None) -> DataFrame:
    """Q12: country vs estimated altitude of airports (raw rows)."""
    return preview(airports.select("country", "altitude_estimee_m"), n, order_by)
