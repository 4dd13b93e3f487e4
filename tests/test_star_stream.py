"""Star load: upsert is key-unique and idempotent, a replayed batch changes
nothing, and a file stream gives the same tables as one batch."""

import os

from pyspark.sql import functions as F

from flightlake.operators import parse, star, upsert
from flightlake.plans import star_load
from flightlake.sources import fixtures as fx
from flightlake.sources.streams import file_stream
from flightlake.streaming import pipelines

SF001 = "/root/testdata/sf0.001"

SPLIT = "2024-01-15 00:00:00"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _split(msgs_states):
    late = F.col("time_position") >= F.lit(SPLIT).cast("timestamp")
    return msgs_states.filter(~late | F.col("time_position").isNull()), msgs_states.filter(late)


def test_merge_upsert_matches_latest_overall(spark):
    states = parse.flight_state_parse(fx.flight_state_messages(spark, SF001))
    b1, b2 = _split(states)
    for build, key in [(star.dim_position, "pk_position"), (star.dim_flight, "pk_vol")]:
        merged = upsert.merge_upsert(build(b1), build(b2), key)
        assert _rows(merged) == _rows(build(states))
        assert merged.select(key).distinct().count() == merged.count()


def test_star_load_replay_is_noop(spark, scratch):
    states = parse.flight_state_parse(fx.flight_state_messages(spark, SF001))
    b1, b2 = _split(states)
    wh = os.path.join(scratch, "wh")
    c1 = star_load.load_star_batch(b1, 0, wh)
    c2 = star_load.load_star_batch(b2, 1, wh)
    assert c1["fait_etat_vol"] + c2["fait_etat_vol"] == star.fact_state(states).count()
    before = {k: _rows(v) for k, v in star_load.read_star(spark, wh).items()}
    star_load.load_star_batch(b2, 1, wh)
    after = {k: _rows(v) for k, v in star_load.read_star(spark, wh).items()}
    assert before == after
    one = star.star(states)
    for name in ["dim_pays", "dim_vol", "dim_temps", "dim_aeronef", "dim_position"]:
        assert after[name] == _rows(one[name].select(*star_load.read_star(spark, wh)[name].columns)), name
    fact_cols = one["fait_etat_vol"].columns
    got = star_load.read_star(spark, wh)["fait_etat_vol"].select(*fact_cols)
    assert _rows(got) == _rows(one["fait_etat_vol"])


def test_empty_batch_writes_nothing(spark, scratch):
    states = parse.flight_state_parse(fx.flight_state_messages(spark, SF001)).limit(0)
    assert star_load.load_star_batch(states, 0, os.path.join(scratch, "wh")) == {}
    assert not os.path.exists(os.path.join(scratch, "wh"))


def test_flight_stream_equals_batch(spark, scratch):
    msgs = fx.flight_state_messages(spark, SF001).withColumn(
        "late", F.get_json_object("value", "$.time_position").cast("bigint")
        >= F.unix_seconds(F.lit(SPLIT).cast("timestamp")))
    inbox = os.path.join(scratch, "inbox")
    for i, cond in enumerate([~F.coalesce(F.col("late"), F.lit(False)), F.col("late")]):
        msgs.filter(cond).select("value").coalesce(1).write.text(os.path.join(inbox, f"part{i}"))
    bad = ["not json", '["a00001",null,"FRANCE"]']
    spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1).write.text(
        os.path.join(inbox, "part2"))
    stream = file_stream(spark, os.path.join(inbox, "*"), max_files_per_trigger=1)
    wh = os.path.join(scratch, "wh")
    quarantine = os.path.join(scratch, "quarantine")
    metrics = os.path.join(scratch, "metrics")
    q = pipelines.flight_star_stream(stream, wh, os.path.join(scratch, "ckpt"),
                                     trigger={"availableNow": True},
                                     quarantine_path=quarantine, metrics_path=metrics)
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted(r.raw for r in spark.read.parquet(quarantine).collect()) == sorted(bad)
    facts = spark.read.parquet(metrics).filter(F.col("target") == "fait_etat_vol")
    assert facts.agg(F.sum("n_rows")).first()[0] == \
        star.fact_state(parse.flight_state_parse(fx.flight_state_messages(spark, SF001))).count()
    got = star_load.read_star(spark, wh)
    one = star.star(parse.flight_state_parse(fx.flight_state_messages(spark, SF001)))
    for name, df in one.items():
        assert _rows(got[name].select(*df.columns)) == _rows(df), name
    # A second run on the same checkpoint reads nothing new.
    q2 = pipelines.flight_star_stream(file_stream(spark, os.path.join(inbox, "*")), wh,
                                      os.path.join(scratch, "ckpt"),
                                      trigger={"availableNow": True})
    q2.awaitTermination(300)
    again = star_load.read_star(spark, wh)
    assert _rows(again["fait_etat_vol"]) == _rows(got["fait_etat_vol"])
