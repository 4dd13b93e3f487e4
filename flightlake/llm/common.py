"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import uuid
import weakref

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import checkpoint_root

#: White space of the word rule ``[^\x20\x09-\x0D]+``, as a Java character class.
SPACE = r"[ \t-\r]"
WORD = r"[^ \t-\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read
    back: cuts the lineage, and a lost executor costs a read, not a rebuild."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python a few MB at a time, however long they are: the
    memory of a Python worker follows the batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def free_name(df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    return f"_{uuid.uuid4().hex}"


#: What a Python worker keeps between the tasks of one operator.
_memos: weakref.WeakSet = weakref.WeakSet()
_kept: list = []
_operator = [""]


def keeps(forget):
    """Have ``forget()`` called when a task of another operator begins."""
    _kept.append(forget)


def lean(run):
    """``run(batches)`` for ``mapInArrow``, by a worker that many operators
    share: what another operator remembered is dropped at the start, and the
    memory of the task's arrays and objects goes back to the system at its end."""
    operator = run.__module__

    def task(batches):
        if _operator[0] != operator:
            _operator[0] = operator
            for m in list(_memos):
                m.clear()
                m.before = {}
            for forget in _kept:
                forget()
            release()
        try:
            yield from run(batches)
        finally:
            release()

    return task


def release() -> None:
    """Unused memory of this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone
    if trim is not None:
        trim(0)


def words(text: Column) -> Column:
    """Array of the words of ``text``; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    return F.filter(parts, lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where the
    body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame, keep=None) -> DataFrame:
    """``df`` with its ``text`` compressed (binary), for a shuffle of whole
    texts; null stays null. Of a batch, the rows of ``keep(batch)`` if given."""
    names = df.columns
    schema = ", ".join(f"`{n}` {'binary' if n == 'text' else t}" for n, t in df.dtypes)

    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            if keep:
                b = b.filter(pa.array(keep(b)))
            texts = [z.compress(t.as_buffer().to_pybytes()) if t.is_valid else None for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()) if n == "text" else b.column(n) for n in names], names=names)

    return df.mapInArrow(lean(run), schema)


def unpacked(df: DataFrame, schema, edit=None, by: str | None = None) -> DataFrame:
    """Columns ``schema`` of a :func:`packed` table, with its texts as text
    again; ``edit(bytes, value of column by)`` may change them."""
    names = schema.names

    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            values = b.column(by).to_pylist() if by else [None] * b.num_rows
            texts = [(edit(z.decompress(t.as_py()), v) if edit else z.decompress(t.as_py())).decode(errors="ignore") if t.is_valid else None
                     for t, v in zip(b.column("text"), values)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names], names=names)

    return df.mapInArrow(lean(run), schema)


class Memo(dict):
    """Values made from their keys, of which between ``size`` and twice as many
    are remembered: those used since the last but one time ``size`` were made."""

    def __init__(self, make, size: int):
        self.make, self.size, self.before = make, size, {}
        _memos.add(self)

    __hash__ = object.__hash__

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value
