"""Airport stream: envelopes from a drop folder -> parse -> enrich -> routed
tables; stream result equals batch, replay changes nothing, unrouted counted."""

import os

from pyspark.sql import functions as F

from flightlake.operators import enrich, parse, route
from flightlake.plans import airfields as air
from flightlake.sources import fixtures as fx
from flightlake.sources.streams import file_stream
from flightlake.streaming import pipelines

SF001 = "/root/testdata/sf0.001"
KEEP = ["name", "icao", "iata", "country", "longitude", "latitude", "source_data",
        "altitude_estimee_m", "timezone_approx", "climat", "airport_category",
        "name_clean", "name_upper", "processing_delay_s", "geo_score"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*KEEP).collect()), key=repr)


def test_airport_stream_equals_batch(spark, scratch):
    inbox = os.path.join(scratch, "inbox")
    fx.airport_envelopes(spark, SF001).coalesce(2).write.text(inbox)
    tables = os.path.join(scratch, "tables")
    q = pipelines.airport_stream(file_stream(spark, inbox), os.path.join(scratch, "ckpt"),
                                 tables_path=tables, trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    batch = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, SF001)))
    stored = route.read_all_routed(spark, tables)
    assert _rows(stored) == _rows(batch.filter(route.routable()))
    for name in ["airfields", "hotspots", "airports"]:
        assert _rows(route.read_routed(spark, tables, name)) == \
            _rows(route.routed_table(batch, name))
    # Q9 over the stored table equals Q9 over the batch rows.
    stored_af = route.read_routed(spark, tables, "airfields").select(*KEEP)
    batch_af = route.routed_table(batch, "airfields").select(*KEEP)
    assert air.airfield_preview(stored_af).collect() == air.airfield_preview(batch_af).collect()


def test_write_airport_batch_replay_and_counts(spark, scratch):
    rows = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, SF001)))
    tables = os.path.join(scratch, "tables")
    metrics = os.path.join(scratch, "metrics")
    c1 = pipelines.write_airport_batch(rows, 7, tables, metrics_path=metrics)
    c2 = pipelines.write_airport_batch(rows, 7, tables, metrics_path=metrics)
    assert c1 == c2
    m = spark.read.parquet(metrics)
    assert {r.target: r.n_rows for r in m.collect()} == c1  # replay replaced, not added
    assert sum(c1.values()) == rows.count()
    stored = spark.read.parquet(tables)
    assert stored.count() == sum(v for k, v in c1.items() if k != route.UNROUTED)
    assert stored.filter(F.col("batch_id") != 7).count() == 0


def test_console_stream_runs(spark, scratch, capfd):
    inbox = os.path.join(scratch, "inbox")
    fx.airport_envelopes(spark, SF001).limit(2).coalesce(1).write.text(inbox)
    rows = enrich.airport_enrich(parse.airport_parse(file_stream(spark, inbox)))
    q = pipelines.console_stream(rows.select("name", "source_data"),
                                 os.path.join(scratch, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert q.lastProgress["numInputRows"] > 0


def test_airport_batch_show(spark, scratch, capsys):
    rows = enrich.airport_enrich(parse.airport_parse(fx.airport_envelopes(spark, SF001))).limit(5)
    counts = pipelines.write_airport_batch(rows, 0, show=True)
    assert sum(counts.values()) == 5


def test_unreadable_envelopes_are_kept_and_counted(spark, scratch):
    """Text that is no envelope, and envelopes without items."""
    good = '{"source_data":"airfields","items":[{"name":"x"}]}'
    bad = ["not json", '["airfields",1]', '{"source_data":"airfields","items":[]}', '{"source_data":"airfields"}', "{}"]
    inbox, out = os.path.join(scratch, "inbox"), {k: os.path.join(scratch, k) for k in ("ckpt", "tables", "metrics", "bad")}
    spark.createDataFrame([(v,) for v in [good, *bad]], "value string").coalesce(1).write.text(inbox)
    q = pipelines.airport_stream(file_stream(spark, inbox), out["ckpt"], out["tables"], trigger={"availableNow": True},
                                 metrics_path=out["metrics"], quarantine_path=out["bad"])
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted(r.raw for r in spark.read.parquet(out["bad"]).collect()) == sorted(bad)
    assert {r.target: r.n_rows for r in spark.read.parquet(out["metrics"]).collect()} == {"airfields": 1, pipelines.QUARANTINED: 5}
    assert [r.name for r in route.read_routed(spark, out["tables"], "airfields").collect()] == ["x"]


def test_routed_tables_fold_while_streams_write(spark, scratch):
    msgs = fx.airport_envelopes(spark, SF001, page_size=2).persist()
    tables, n = os.path.join(scratch, "tables"), 12
    part = F.pmod(F.xxhash64("value"), F.lit(n))
    for i in range(n):
        pipelines.write_airport_messages(msgs.filter(part == i).coalesce(1), i, tables)
        if i in (3, 4, 8, 9):
            route.fold_routed(spark, tables)
    batch = enrich.airport_enrich(parse.airport_parse(msgs))
    assert _rows(route.read_all_routed(spark, tables)) == _rows(batch.filter(route.routable()))
    names = [f for f in route.read_routed(spark, tables, "airfields").inputFiles() if "source_data=airfields" in f]
    # Two folds at most, and the batches after the older one (8 to 11); not one for each batch.
    assert len(names) <= 6, names
