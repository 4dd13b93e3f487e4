"""Structured Streaming wrappers.

Both pipelines are ``readStream`` -> stateless transform -> ``foreachBatch``.
Every query has a checkpoint location (progress survives a restart; the
airport stream of the original had none and skipped data on restart).
Inside a batch the rows are persisted once and released in ``finally``.
"""

from __future__ import annotations

import json
import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake.operators.enrich import airport_enrich
from flightlake.operators.parse import (
    airport_envelopes_with_raw, airport_rows, flight_state_parse_with_raw, map_flight_state,
    quarantined, snapshot_states_with_raw,
)
from flightlake.operators.route import route_counts, routable, write_routed
from flightlake.operators.upsert import append_batch
from flightlake.plans.star_load import load_star_batch
from flightlake.schemas import AIRPORT_SOURCES

log = logging.getLogger(__name__)


def _trigger(writer, trigger):
    """``None`` = next batch as soon as the last ends; a string = processing
    time interval ("10 seconds"); a dict = any ``trigger`` keyword
    (``{"availableNow": True}`` for tests and backfills)."""
    if trigger is None:
        return writer
    if isinstance(trigger, str):
        return writer.trigger(processingTime=trigger)
    return writer.trigger(**trigger)


def stream_id(spark, checkpoint: str) -> str:
    """Id of the streaming query that owns ``checkpoint``: Spark writes it there
    when the query first starts, and it stays the same over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def write_metrics(spark, counts: dict[str, int], batch_id: int, path: str,
                  pipeline: str, stream: str = "batch") -> None:
    """K8: one row per table of a batch (at most a handful) under the batch's
    replay key; a replayed batch replaces its rows."""
    rows = [(pipeline, str(t), int(n)) for t, n in sorted(counts.items())]
    df = spark.createDataFrame(rows, "pipeline string, target string, n_rows bigint")
    append_batch(df.coalesce(1), path, stream, batch_id, ("pipeline",))


def write_flight_batch(raw: DataFrame, batch_id: int, warehouse: str,
                       keep_category: bool = False, stream: str = "batch",
                       quarantine_path: str | None = None, metrics_path: str | None = None,
                       snapshots: bool = False) -> dict[str, int]:
    """K1 body: parse one raw batch once (persisted), load the star schema
    from it and, with ``quarantine_path``, keep the unparseable messages
    (replay-safe: under the batch's replay key).
    With ``metrics_path`` the per-table row counts (K8) are stored too."""
    parsed = (snapshot_states_with_raw(raw) if snapshots else flight_state_parse_with_raw(raw)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        states = map_flight_state(parsed.filter(~F.col("_bad")), keep_category)
        counts = load_star_batch(states, batch_id, warehouse, stream, persist=False)
        if quarantine_path:
            append_batch(quarantined(parsed), quarantine_path, stream, batch_id)
        if metrics_path and counts:
            write_metrics(raw.sparkSession, counts, batch_id, metrics_path, "flight_star", stream)
        return counts
    finally:
        parsed.unpersist()


def flight_star_stream(raw: DataFrame, warehouse: str, checkpoint: str, trigger=None,
                       keep_category: bool = False, query_name: str | None = None,
                       quarantine_path: str | None = None, metrics_path: str | None = None,
                       snapshots: bool = False) -> StreamingQuery:
    """K1: raw flight-state messages -> star schema under ``warehouse``. With
    ``snapshots`` a message is a whole snapshot document, split into states."""
    def write_batch(df: DataFrame, batch_id: int) -> None:
        write_flight_batch(df, batch_id, warehouse, keep_category,
                           stream_id(df.sparkSession, checkpoint), quarantine_path, metrics_path,
                           snapshots)

    w = (raw.select("value").writeStream.foreachBatch(write_batch).outputMode("append")
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict,
                batch_size: int = 10_000) -> None:
    """K4: executor-side batched JDBC inserts (no driver round trip)."""
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url=url, table=table, mode="append", properties=props)


def write_airport_batch(df: DataFrame, batch_id: int, tables_path: str | None = None,
                        jdbc: dict | None = None, show: bool = False,
                        sources=None, metrics_path: str | None = None,
                        stream: str = "batch", show_rows: int = 20) -> dict[str, int]:
    """D10 body: route one enriched batch into the per-source tables.

    Parquet: one partitioned write under the batch's replay key. JDBC
    (``jdbc={"url":..., "properties":...}``): one append per table present in
    the batch, each from the persisted rows. ``show`` prints the first
    ``show_rows`` rows. Returns rows per target, including the
    ``__unrouted__`` count.
    """
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if rows.isEmpty():  # K7
            return {}
        counts = {r["target"]: r["n_rows"] for r in route_counts(rows, sources).collect()}
        if tables_path:
            write_routed(rows, tables_path, batch_id, stream, sources)
        if jdbc:
            for target in counts:
                if target in (sources or AIRPORT_SOURCES):
                    jdbc_append(rows.filter(routable([target])), jdbc["url"], target,
                                jdbc.get("properties", {}))
        if show:  # K6 from the same persisted rows: the source is read once
            rows.show(n=show_rows, truncate=False)
        if metrics_path:
            write_metrics(df.sparkSession, counts, batch_id, metrics_path, "airports", stream)
        log.info("airport batch %s: %s", batch_id, counts)
        return counts
    finally:
        rows.unpersist()


QUARANTINED = "__quarantined__"


def write_airport_messages(raw: DataFrame, batch_id: int, tables_path: str | None = None,
                           jdbc: dict | None = None, show: bool = False,
                           metrics_path: str | None = None, stream: str = "batch",
                           quarantine_path: str | None = None) -> dict[str, int]:
    """One batch of raw envelopes (D8-D10): parsed once, routed, and the
    messages that yield no item kept with their text under ``quarantine_path``
    and counted as ``__quarantined__``."""
    parsed = airport_envelopes_with_raw(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = write_airport_batch(airport_enrich(airport_rows(parsed.filter(~F.col("_bad")))), batch_id,
                                     tables_path, jdbc, show, stream=stream)
        bad = quarantined(parsed)
        if quarantine_path:
            seen = Observation("quarantined")
            append_batch(bad.observe(seen, F.count(F.lit(1)).alias("rows")), quarantine_path, stream, batch_id)
            n_bad = seen.get.get("rows", 0)
        else:
            n_bad = bad.count() if metrics_path else 0
        if n_bad:
            counts = {**counts, QUARANTINED: n_bad}
        if metrics_path and counts:
            write_metrics(raw.sparkSession, counts, batch_id, metrics_path, "airports", stream)
        return counts
    finally:
        parsed.unpersist()


def airport_stream(raw: DataFrame, checkpoint: str, tables_path: str | None = None,
                   jdbc: dict | None = None, trigger="10 seconds", show: bool = False,
                   query_name: str | None = None, metrics_path: str | None = None,
                   quarantine_path: str | None = None) -> StreamingQuery:
    """D8 -> D9 -> D10 as one streaming query with a checkpoint.

    ``show=True`` prints each batch from inside the same query (one source
    read) instead of a second console query reading the topic again.
    """
    def write_batch(df: DataFrame, batch_id: int) -> None:
        write_airport_messages(df, batch_id, tables_path, jdbc, show, metrics_path,
                               stream_id(df.sparkSession, checkpoint), quarantine_path)

    w = (raw.select("value").writeStream.foreachBatch(write_batch).outputMode("update")
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def message_archive(raw: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """A second query on the same source, which keeps every message as it
    came (parquet; Spark's file sink writes each batch once)."""
    w = (raw.select("value").writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def console_stream(df: DataFrame, checkpoint: str, trigger="10 seconds",
                   truncate: bool = False) -> StreamingQuery:
    """K6: a separate console query (reads the source by itself)."""
    w = (df.writeStream.outputMode("append").format("console")
         .option("truncate", str(truncate).lower())
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()
