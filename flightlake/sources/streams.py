"""Raw message sources (S1-S5). Each returns a DataFrame with a ``value``
column (binary from Kafka, text from files) ready for the parsers.

The Kafka connector jar is not bundled; ``kafka_stream`` needs
``spark-sql-kafka-0-10`` on the classpath. The file sources need nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from flightlake.operators.parse import snapshot_split
from flightlake.session import path_exists

TEXT_SCHEMA = StructType([StructField("value", StringType(), True)])


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Subscribe to ``topic``. ``starting_offsets`` is "earliest"
    (flight states) or "latest" (airport envelopes). ``maxOffsetsPerTrigger``
    bounds a micro-batch so a backlog cannot produce one giant batch."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets)
         .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def file_stream(spark: SparkSession, path: str, whole_file: bool = False,
                max_files_per_trigger: int | None = None,
                clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Drop-folder stream. One message per line, or one per file with
    ``whole_file=True`` (snapshot documents). ``clean_source="delete"``
    removes picked-up files like a pick-up that does not keep its source;
    "archive" moves them to ``archive_dir``."""
    r = spark.readStream.format("text").option("wholetext", str(whole_file).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    return r.load(path)


def read_messages(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Batch twin of ``file_stream``; a missing path gives an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], TEXT_SCHEMA)
    return spark.read.text(path, wholetext=whole_file)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """S3 + P8: snapshot documents -> rows ``(time, pos, state)``. A missing
    path gives no rows (the caller then treats the snapshot as absent)."""
    return snapshot_split(read_messages(spark, path, whole_file=True))


def read_table(spark: SparkSession, path: str | None = None, *, jdbc_url: str | None = None,
               table: str | None = None, properties: dict | None = None) -> DataFrame:
    """Analytic table scan, parquet by default or JDBC when a URL is given.
    Credentials come from ``properties`` (arguments), never from code."""
    if jdbc_url:
        return spark.read.jdbc(jdbc_url, table, properties=properties or {})
    return spark.read.parquet(path)
