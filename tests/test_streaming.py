"""Streams give what batch gives; joins and windows against plain Python; pipelines."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import episode, memory, relational
from plumbline.plans.pipeline import ActionPlan, Pipeline, add_prompt, select_keys, step
from plumbline.streaming import state


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    def make(rows, schema, name):
        state.configure(spark)
        folder = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder + "/in")
        return spark.readStream.schema(schema).parquet(folder + "/in"), folder + "/ck"

    return make


@pytest.mark.parametrize("merge", [False, True])
def test_bank_stream_is_batch(spark, stream, merge):
    rng = random.Random(1)
    rows = [("cog", f"e{i % 3}", float(i), [rng.random() for _ in range(4)], False) for i in range(30)]
    df, ck = stream(rows, "role string, episode string, t double, v array<double>, reset boolean", "bank")
    out = state.run_available(state.bank_stream(df, 4, merge), f"bank{int(merge)}", ck)
    last = {r.episode: (r.times, r.vectors) for r in out.orderBy("t").collect()}
    table = spark.createDataFrame(rows, "role string, episode string, timestep double, feat array<double>, reset boolean")
    if merge:
        want = {r.episode: r.bank for r in memory.bank_merge(table, 4).collect()}
    else:
        want = {r.episode: r.bank for r in memory.bank_fifo(table, 4).orderBy("timestep").collect()}
    for e, (times, vectors) in last.items():
        assert times == pytest.approx([x["t"] for x in want[e]])
        assert [y for v in vectors for y in v] == pytest.approx([y for x in want[e] for y in x["v"]])


def test_session_and_integrator_streams(spark, stream):
    rng = random.Random(2)
    rows = [(f"c{i % 2}", i, rng.choice(["a", "b", None])) for i in range(40)]
    df, ck = stream(rows, "client string, seq long, text string", "sessions")
    got = {(r.client, r.seq): (r.run, r.step) for r in state.run_available(state.session_stream(df), "sess", ck).collect()}
    want = episode.label_islands(spark.createDataFrame(rows, "client string, seq long, text string"), "text", ["client"], ["seq"])
    assert got == {(r.client, r.seq): (r.run, r.step) for r in want.collect()}

    moves = [(f"e{i % 2}", i, [rng.uniform(-2, 2) for _ in range(7)], [0.5] * 7) for i in range(30)]
    df, ck = stream(moves, "episode string, seq long, delta array<double>, start array<double>", "moves")
    got = {r.seq: r.action for r in state.run_available(state.integrate_stream(df), "moves", ck).collect()}
    table = spark.createDataFrame(moves, "episode string, seq long, action array<double>, start array<double>")
    own = episode.Episodes(keys=("episode",), order=("seq",))
    for r in episode.integrate(table, F.col("start"), own).collect():
        assert got[r.seq] == pytest.approx(r.action)


def test_joins(spark):
    rng = random.Random(3)
    ts = lambda s: f"timestamp '2024-01-01 00:00:00' + interval {s} seconds"
    left = [(i, rng.randrange(3), rng.randrange(2000)) for i in range(60)]
    right = [(i, rng.randrange(3), 7 * rng.randrange(300)) for i in range(60)]
    make = lambda rows: spark.createDataFrame(rows, "i int, k int, s int").withColumn("ts", F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s)"))
    assert ts(1)
    a, b = make(left), make(right).select("k", "ts", F.col("s").alias("rs"), F.col("i").alias("ri"))
    found = {r.i: r.rs for r in relational.asof_join(a, b, ["k"], "ts", ["rs"]).collect()}
    assert found == {i: max((s for _, kk, s in right if kk == k and s <= t), default=None) for i, k, t in left}
    strict = {r.i: r.rs for r in relational.asof_join(a, b, ["k"], "ts", ["rs"], allow_equal=False, tolerance="100 seconds").collect()}
    assert strict == {i: max((s for _, kk, s in right if kk == k and s < t and s >= t - 100), default=None) for i, k, t in left}
    near = {(r.i, r.ri) for r in relational.range_join(a.drop("s"), b.withColumnRenamed("ts", "rts"), ["k"], "ts", "rts", 60).select("i", "ri").collect()}
    assert near == {(i, j) for i, k, t in left for j, kk, s in right if k == kk and abs(t - s) <= 60}


def test_pipeline(spark):
    double = step(lambda df: df.withColumn("x", F.col("x") * 2), predict_length=3)
    p = Pipeline([double, [double]], step(select_keys, ["x"]))
    assert [r.x for r in p(spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("y"))).collect()] == [4] and p.predict_length == 3
    with pytest.raises(Exception, match="UNRESOLVED"):
        select_keys(spark.range(1), ["none"])
    with pytest.raises(KeyError):
        ActionPlan.of(nonsense=1)
    with pytest.raises(ValueError):
        ActionPlan.of().pipeline()
    frames = spark.createDataFrame([("d", "e", i, [float(i)], "go", i == 0) for i in range(3)], "dataset string, episode_id string, frame_index int, state array<double>, prompt string, is_robot boolean")
    assert {r.prompt for r in add_prompt(frames, "do {prompt}").collect()} == {"do go"}
    assert text.replace_answer(frames) is frames


def test_event_windows(spark, stream):
    from plumbline.streaming.events import session_counts, windowed_counts

    rows = [(i, i % 2, "t", 1.0, f"2024-01-01 00:{m:02d}:00") for i, m in enumerate([0, 1, 5, 20, 40, 59])]
    df = spark.createDataFrame(rows, "event_id int, user_id int, event_type string, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert {r.events for r in windowed_counts(df, "10 minutes").collect()} == {3, 1}
    assert session_counts(df, "10 minutes").count() == 5
