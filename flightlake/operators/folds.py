"""Folding of appended batches while streams run (K2, K3, K5).

Streams append batches to a table under ``[unit/]stream_id=<s>/batch_id=<n>``.
A fold rewrites the rows of complete batches once, for the whole table or for
some of its units (the days of the fact, the routed tables), under
``<table>__folds/rows/fold=<name>``, and then puts one file with its marks under
``<table>__folds/marks/run=<k>``: for each unit, the fold that holds it and, for
each stream, the last batch in it.

Read rule: the marks of the newest run name the folds; a batch after its unit's
mark is read from where the stream wrote it. So a fold is there as a whole or
not at all, whenever it is killed, and no batch is lost or read twice.

* A stream's newest batch is never folded: it may be half written, or be
  replayed. A batch is complete as soon as its stream has written a later one.
* A fold deletes only what the run before it had already replaced, so that a
  reader that has planned by those marks still finds its files for as long as
  one more fold takes.
* One folding job at a time for a table; streams and readers as many as wanted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightlake.operators.upsert import BATCH, STREAM, read_batches, storage_schema
from flightlake.session import delete_folder, list_folders, path_exists

FOLD = "fold"
_MARKS = "run bigint, unit string, stream_id string, upto bigint, fold string"


class Marks:
    """Marks of one run: ``bounds[unit][stream]`` is the last batch folded, and
    ``folds[unit]`` the fold that holds it."""

    def __init__(self, run: int = 0, rows=()):
        self.run = run
        self.bounds: dict[str, dict[str, int]] = {}
        self.folds: dict[str, str] = {}
        for r in rows:
            self.folds[r["unit"]] = r["fold"]
            self.bounds.setdefault(r["unit"], {})[r["stream_id"]] = r["upto"]

    def covers(self, unit: str, stream: str, batch: int) -> bool:
        return batch <= self.bounds.get(unit, {}).get(stream, -1)

    def covered(self, unit_col: str | None) -> Column:
        """Batches that are in a fold; on partition columns alone."""
        alike: dict[tuple, list[str]] = {}
        for unit, bounds in self.bounds.items():
            alike.setdefault(tuple(sorted(bounds.items())), []).append(unit)
        return _any((_upto(dict(bounds)) & _in(unit_col, units)) for bounds, units in alike.items())


def _any(conds) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def _upto(bounds: dict[str, int]) -> Column:
    return _any((F.col(STREAM) == s) & (F.col(BATCH) <= n) for s, n in bounds.items())


def _in(unit_col: str | None, units) -> Column:
    return F.lit(True) if unit_col is None else F.col(unit_col).cast("string").isin(sorted(units))


def _root(path: str) -> str:
    return f"{path.rstrip('/')}__folds"


def marks(spark: SparkSession, path: str) -> Marks:
    """Marks of the newest run; at most two runs are there, with a row for each
    unit and stream."""
    if not path_exists(spark, f"{_root(path)}/marks"):
        return Marks()
    rows = spark.read.schema(_MARKS).parquet(f"{_root(path)}/marks").collect()
    run = max((r["run"] for r in rows), default=0)
    return Marks(run, [r for r in rows if r["run"] == run])


def _folded_rows(spark: SparkSession, path: str, schema: StructType, unit: StructField | None,
                 held: Marks, units=None) -> DataFrame | None:
    """Rows of the marked folds (of some units); a predicate on partition columns."""
    full = storage_schema(schema, unit)
    names = {u: f for u, f in held.folds.items() if units is None or u in units}
    if not names:
        return None
    rows = spark.read.schema(StructType([*full.fields, StructField(FOLD, StringType())])).parquet(f"{_root(path)}/rows")
    if unit is None:
        kept = rows.filter(F.col(FOLD).isin(sorted(names.values())))
    else:
        place = F.concat(F.col(FOLD), F.lit("/"), F.col(unit.name).cast("string"))
        kept = rows.filter(place.isin(sorted(f"{f}/{u}" for u, f in names.items())))
    return kept.select(*full.names)


def read_folded(spark: SparkSession, path: str, schema: StructType,
                unit: StructField | None = None, held: Marks | None = None) -> DataFrame:
    """Every row of a table once: its folds and the batches after them, with
    the storage columns."""
    held = held or marks(spark, path)
    open_rows = read_batches(spark, path, schema, unit)
    if not held.bounds:
        return open_rows
    later = open_rows.filter(~held.covered(unit.name if unit else None))
    folded = _folded_rows(spark, path, schema, unit, held)
    return folded.unionByName(later.select(*folded.columns))


def fold(spark: SparkSession, path: str, schema: StructType, combine: Callable[[DataFrame], DataFrame],
         unit: StructField | None = None, only: Callable[[Column], Column] | None = None) -> str | None:
    """Fold the complete batches of a table, with ``combine`` over the rows of
    its fold and of those batches. With a ``unit`` column, only the units that
    ``only(column)`` picks and that have such batches are rewritten. Returns
    the name of the fold, or nothing if there was nothing to fold."""
    name_of = unit.name if unit else None
    held = marks(spark, path)
    rows = read_batches(spark, path, schema, unit)
    newest = {r[STREAM]: r["n"] for r in rows.groupBy(STREAM).agg(F.max(BATCH).alias("n")).collect()}
    complete = {s: n - 1 for s, n in newest.items()}
    todo = rows.filter(_upto(complete) & ~held.covered(name_of))
    if unit is None:
        units = [] if todo.isEmpty() else [""]
    else:
        todo = todo.filter(only(F.col(name_of))) if only else todo
        units = [r[0] for r in todo.select(F.col(name_of).cast("string")).distinct().collect()]
    if not units:
        return None
    todo = todo.filter(_in(name_of, units))
    before = _folded_rows(spark, path, schema, unit, held, set(units))
    out = todo if before is None else before.unionByName(todo.select(*before.columns))
    name = f"{held.run + 1:08d}-{uuid.uuid4().hex[:8]}"
    (combine(out).withColumn(FOLD, F.lit(name)).write.mode("append")
     .partitionBy(FOLD, *([name_of] if unit else [])).parquet(f"{_root(path)}/rows"))
    lines = [(held.run + 1, u, s, n, held.folds[u]) for u, b in held.bounds.items() if u not in units for s, n in b.items()]
    lines += [(held.run + 1, u, s, n, name) for u in units for s, n in ({**held.bounds.get(u, {}), **complete}).items()]
    _put_marks(spark, path, lines)
    _clean(spark, path, name_of, held)
    return name


def _put_marks(spark: SparkSession, path: str, lines: list[tuple]) -> None:
    """The marks of a run as one file: there as a whole or not at all."""
    (spark.createDataFrame(lines, _MARKS).coalesce(1).write.mode("append")
     .partitionBy("run").parquet(f"{_root(path)}/marks"))


def _clean(spark: SparkSession, path: str, unit_col: str | None, held: Marks) -> None:
    """Delete what no reader by the marks ``held`` (the run before the newest)
    needs: older runs, folds that neither names, batches that it covers."""
    now = marks(spark, path)
    root = _root(path)
    for run in list_folders(spark, f"{root}/marks/run=*"):
        if int(run.rpartition("=")[2]) < held.run:
            delete_folder(spark, run)
    kept = set(held.folds.values()) | set(now.folds.values())
    for old in list_folders(spark, f"{root}/rows/{FOLD}=*"):
        if old.rpartition("=")[2] not in kept:
            delete_folder(spark, old)
    unit = f"{unit_col}=*/" if unit_col else ""
    for batch in list_folders(spark, f"{path.rstrip('/')}/{unit}{STREAM}=*/{BATCH}=*"):
        parts = [unquote(p.partition("=")[2]) for p in batch.split("/")[-3:]]
        if held.covers(parts[0] if unit_col else "", parts[1], int(parts[2])):
            delete_folder(spark, batch)


def spread(rows: DataFrame, *cols: str) -> DataFrame:
    """Rows dealt out for a partitioned write, in tasks of the session's
    advisory size: a large partition takes several, small ones share one."""
    return rows.hint("rebalance", *cols)

