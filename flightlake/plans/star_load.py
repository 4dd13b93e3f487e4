"""One micro-batch into the star schema (K1 body, K7, K8), and the stored tables.

The batch is read from the source once and kept (``persist``) for the table
builds; every table appends the batch under its replay key. Row counts come
from ``observe`` on the writes themselves, so the report adds no extra jobs.

The dimensions are written first (together), then the fact, then its reading
times. So whoever sees a fact row finds its dimension rows, and whoever sees a
reading time finds the fact rows of that time. A warehouse that this loader
has made records the first in ``references``: existence joins over its tables
keep every row, and are left out (:func:`dashboard_tables`).
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from flightlake.operators import folds, star, upsert
from flightlake.operators.parse import map_flight_state, parse_json_struct
from flightlake.schemas import FLIGHT_STATE_SCHEMA
from flightlake.session import path_exists

log = logging.getLogger(__name__)

DIMENSIONS = [
    ("dim_pays", "pk_pays", star.dim_country),
    ("dim_vol", "pk_vol", star.dim_flight),
    ("dim_temps", "pk_temps", star.dim_time),
    ("dim_aeronef", "pk_aeronef", star.dim_aircraft),
    ("dim_position", "pk_position", star.dim_position),
]
FACT = "fait_etat_vol"
#: Distinct reading times of the fact, one row for each time and batch.
TIMES = f"{FACT}__times"
TIMES_SCHEMA = StructType([StructField("fk_temps", TimestampType())])
#: Fact keys whose dimension row is always there, in warehouses that record it.
REFERENCES = [("fk_position", "dim_position", "pk_position"), ("fk_aeronef", "dim_aeronef", "pk_aeronef"),
              ("fk_pays", "dim_pays", "pk_pays")]


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def load_star_batch(states: DataFrame, batch_id: int, warehouse: str,
                    stream_id: str = "batch",
                    persist: bool = True, parallel: bool = True) -> dict[str, int]:
    """Write one batch of mapped states; returns rows written per table.

    An empty batch writes nothing (K7). Safe to call again with the same
    ``stream_id``, ``batch_id`` and rows (replay after a failure); another
    source of batches needs a ``stream_id`` of its own. ``persist=False`` when
    the caller already keeps the batch. The five dimension writes are
    independent jobs; ``parallel`` submits them together so small micro-batches
    fill the cluster instead of queueing. Any failure fails the whole batch
    (which is then replayed; every write is idempotent).
    """
    spark = states.sparkSession
    base = warehouse.rstrip("/")
    batch = states.persist(StorageLevel.MEMORY_AND_DISK) if persist else states
    try:
        if batch.isEmpty():
            log.info("batch %s empty, nothing to write", batch_id)
            return {}
        counts: dict[str, int] = {}

        def dimension(name, key, build):
            rows, obs = _counted(build(batch), name)
            upsert.append_batch(rows, f"{base}/{name}", stream_id, batch_id)
            return name, obs.get.get("rows", 0)

        if not path_exists(spark, f"{base}/{FACT}") and not path_exists(spark, f"{base}/{DIMENSIONS[0][0]}"):
            (spark.createDataFrame(REFERENCES, "fact_key string, dimension string, dimension_key string")
             .coalesce(1).write.mode("overwrite").parquet(f"{base}/references"))
        tasks = [lambda d=d: dimension(*d) for d in DIMENSIONS]
        if parallel:
            with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
                # The threads carry the query's job group, so stop() reaches their jobs.
                results = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t))
                                                for t in tasks]]
        else:
            results = [t() for t in tasks]
        # Counted behind the range exchange, which reads its input twice to find the ranges.
        rows, obs = _counted(upsert.fact_layout(star.fact_state(batch)), FACT)
        upsert.append_fact(rows, f"{base}/{FACT}", stream_id, batch_id)
        results.append((FACT, obs.get.get("rows", 0)))
        times = star.fact_state(batch).select("fk_temps").distinct()
        upsert.append_batch(times.coalesce(1), f"{base}/{TIMES}", stream_id, batch_id)
        counts.update(dict(results))
        log.info("batch %s written: %s", batch_id, counts)
        return counts
    finally:
        if persist:
            batch.unpersist()


def _schemas(spark) -> dict:
    states = map_flight_state(parse_json_struct(spark.createDataFrame([], "value string"),
                                                FLIGHT_STATE_SCHEMA))
    return {name: df.schema for name, df in star.star(states).items()}


def read_star(spark, warehouse: str) -> dict[str, DataFrame]:
    """The six stored tables, their folds included; those that no batch has
    written yet are empty."""
    base, schemas = warehouse.rstrip("/"), _schemas(spark)
    out = {name: upsert.read_table(spark, f"{base}/{name}", schemas[name], key)
           for name, key, _ in DIMENSIONS}
    out[FACT] = (folds.read_folded(spark, f"{base}/{FACT}", schemas[FACT], upsert.DAY_FIELD)
                 .drop(upsert.LOADED, upsert.STREAM, upsert.BATCH))
    return out


def read_times(spark, warehouse: str) -> DataFrame:
    """``fk_temps``: every reading time of the stored fact, at least once."""
    return folds.read_folded(spark, f"{warehouse.rstrip('/')}/{TIMES}", TIMES_SCHEMA).select("fk_temps")


def dashboard_tables(spark, warehouse: str) -> tuple[DataFrame, tuple | None, DataFrame | None]:
    """``(fact, dims, times)`` for the dashboards. ``dims`` is nothing where the
    warehouse records that every fact row has its dimension rows, else the
    aircraft, position and country tables; ``times`` is nothing in a warehouse
    without reading times."""
    base = warehouse.rstrip("/")
    t = read_star(spark, base)
    held = path_exists(spark, f"{base}/references")
    dims = None if held else (t["dim_aeronef"], t["dim_position"], t["dim_pays"])
    return t[FACT], dims, read_times(spark, base) if held and path_exists(spark, f"{base}/{TIMES}") else None


def fold_dimensions(spark, warehouse: str) -> dict[str, str | None]:
    """Fold the complete batches of the five dimensions, and of the reading
    times, to one row per key, while streams run (``operators.folds``)."""
    base, schemas = warehouse.rstrip("/"), _schemas(spark)
    out = {name: folds.fold(spark, f"{base}/{name}", schemas[name], lambda rows, k=key: upsert.latest_rows(rows, k))
           for name, key, _ in DIMENSIONS}
    out[TIMES] = folds.fold(spark, f"{base}/{TIMES}", TIMES_SCHEMA, lambda rows: upsert.latest_rows(rows, "fk_temps"))
    return out


def close_days(spark, warehouse: str, before) -> str | None:
    """Rewrite the fact's days before ``before`` (a date, or text) once, in
    ranges of times and in order, while streams run. Rows that come late for a
    closed day are read from their batch, until the next call takes them in."""
    path = f"{warehouse.rstrip('/')}/{FACT}"
    return folds.fold(spark, path, _schemas(spark)[FACT], _in_order, upsert.DAY_FIELD,
                      only=lambda day: day < F.lit(str(before)).cast("date"))


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartitionByRange(upsert.DAY, "fk_temps").sortWithinPartitions(upsert.DAY, "fk_temps")


def compact(spark, warehouse: str, target: str) -> None:
    """Fold all batches of ``warehouse`` into the new folder ``target``: one row
    per key for dimensions, the fact by day and in time order. To be run while
    no stream writes (its last batch is committed); streams go on in ``target``.
    The rows keep the time they were loaded, so later batches still win."""
    base, to, schemas = warehouse.rstrip("/"), target.rstrip("/"), _schemas(spark)
    if path_exists(spark, to):
        raise ValueError(f"{to} exists; compaction writes a new folder")
    folded = {upsert.STREAM: F.lit("compacted"), upsert.BATCH: F.lit(0).cast("bigint")}
    for name, key, _ in DIMENSIONS:
        rows = upsert.latest_rows(folds.read_folded(spark, f"{base}/{name}", schemas[name]), key)
        rows.withColumns(folded).write.partitionBy(upsert.STREAM, upsert.BATCH).parquet(f"{to}/{name}")
    fact = folds.read_folded(spark, f"{base}/{FACT}", schemas[FACT], upsert.DAY_FIELD)
    (_in_order(fact.withColumns(folded)).write
     .partitionBy(upsert.DAY, upsert.STREAM, upsert.BATCH).parquet(f"{to}/{FACT}"))
    if path_exists(spark, f"{base}/references"):
        times = upsert.latest_rows(folds.read_folded(spark, f"{base}/{TIMES}", TIMES_SCHEMA), "fk_temps")
        times.withColumns(folded).write.partitionBy(upsert.STREAM, upsert.BATCH).parquet(f"{to}/{TIMES}")
        spark.read.parquet(f"{base}/references").write.parquet(f"{to}/references")
