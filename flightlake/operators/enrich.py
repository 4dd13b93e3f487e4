"""Airport enrichment (D9): derived columns from position, code and name.

One projection, all built-in expressions, so the whole step stays inside a
single whole-stage-codegen span after the parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.columns import (
    altitude_estimate, climate, geo_score, icao_region, seconds_between, timezone_approx,
)

ENRICHED_COLUMNS = ["name", "icao", "iata", "country", "longitude", "latitude", "source_data",
                    "altitude_estimee_m", "timezone_approx", "climat", "airport_category",
                    "name_clean", "name_upper", "timestamp_ingestion", "processing_delay_s",
                    "geo_score"]


def airport_enrich(df: DataFrame, event_time: str | None = None) -> DataFrame:
    """Adds the 9 derived columns to parsed airport rows.

    ``processing_delay_s`` compares the batch's one ``current_timestamp`` with
    itself, so it is always 0 (parity). Pass ``event_time`` (a TIMESTAMP
    column) to measure event time -> ingestion instead.
    """
    now = F.current_timestamp()
    start = F.col(event_time) if event_time else F.col("timestamp_ingestion")
    return (df
            .withColumns({
                "altitude_estimee_m": altitude_estimate("latitude"),
                "timezone_approx": timezone_approx("longitude"),
                "climat": climate("latitude"),
                "airport_category": icao_region("icao"),
                "name_clean": F.trim(F.col("name")),
                "name_upper": F.upper(F.col("name")),
                "timestamp_ingestion": now,
            })
            .withColumns({
                "processing_delay_s": seconds_between(start, now),
                "geo_score": geo_score("latitude", "longitude"),
            }))
