"""Hand-worked goldens, properties and independence from partitions of the episode operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import numeric, text, vec
from plumbline.operators import batching, episode, memory, sampling, stats
from plumbline.operators.episode import Episodes

FRAMES = "dataset string, episode_id string, frame_index int, state array<double>"
STATES = [[0, 0, 3, 0], [1, 2, -3, 1], [3, 2, -3, 1], [6, 1, 3, 1]]
ND, PER = [3], [2]


def table(spark, rows=STATES, name="G", parts=3):
    return spark.createDataFrame([("d", name, i, [float(x) for x in s]) for i, s in enumerate(rows)], FRAMES).repartition(parts)


def got(df, column="action", digits=6):
    return [[round(x, digits) if not isinstance(x, list) else [round(y, digits) for y in x] for x in r[0]] for r in df.orderBy("frame_index").select(column).collect()]


def deltas(spark, parts=3):
    return episode.delta_action(episode.add_action(table(spark, parts=parts)), ND, PER)


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_add_and_delta(spark, parts):
    assert got(episode.add_action(table(spark, parts=parts))) == STATES[1:]
    assert got(deltas(spark, parts)) == [[1, 2, 0.283185, 1], [2, 0, 0, 1], [3, -1, -0.283185, 1]]


def test_add_action_edges(spark):
    assert got(episode.add_action(table(spark), 4)) == []
    assert got(episode.add_action(table(spark), 9)) == []
    null = spark.createDataFrame([("d", "e", 0, [1.0]), ("d", "e", 1, None), ("d", "e", 2, [3.0])], FRAMES)
    assert [r[0] for r in episode.add_action(null).orderBy("frame_index").select("action").collect()] == [None, [3.0]]
    bare = null.drop("state")
    assert episode.add_action(bare) is bare
    stored = table(spark).withColumn("action", F.array(F.lit(9.0)))
    assert episode.add_action(stored, prefer_existing=True) is stored


def test_chunks(spark):
    last = got(episode.add_chunk(deltas(spark), 2))
    assert last[2] == [3, -1, -0.283185, 1, 3, -1, -0.283185, 1] and last[0] == [1, 2, 0.283185, 1, 2, 0, 0, 1]
    assert got(episode.add_chunk(deltas(spark), 2, padding="zero", non_delta=ND))[2] == [3, -1, -0.283185, 1, 0, 0, 0, 1]
    assert got(episode.add_chunk(deltas(spark), 2, flat=False))[0] == [[1, 2, 0.283185, 1], [2, 0, 0, 1]]
    assert got(episode.add_chunk(deltas(spark), 4, pad_short=False)) == []
    assert episode.short_episodes(deltas(spark), 4).count() == 1
    with pytest.raises(ValueError):
        episode.add_chunk(deltas(spark), 2, padding="x")


def test_cumulative_chunks(spark):
    rows = got(episode.add_cumulative_chunk(deltas(spark), 2, gripper=ND))
    assert rows == [[1, 2, 0.283185, 1, 3, 2, 0.283185, 1], [2, 0, 0, 1, 5, -1, -0.283185, 1], [3, -1, -0.283185, 1, 6, -2, -0.566371, 1]]
    assert got(episode.add_cumulative_chunk(deltas(spark), 2, padding="zero", gripper=ND))[2] == [3, -1, -0.283185, 1, 3, -1, -0.283185, 1]
    assert got(episode.add_cumulative_chunk(deltas(spark), 1, gripper=[-1])) == got(deltas(spark))


def test_relative_and_absolute(spark):
    actions = table(spark, [[1, 2, 0], [4, 1, 1], [4, 4, 0]]).withColumnRenamed("state", "action")
    assert got(episode.relative_to_delta(actions, [2])) == [[1, 2, 0], [3, -1, 1], [0, 3, 0]]
    chunk = actions.withColumn("action", episode.chunk_to_delta(F.array(*(F.array(*map(F.lit, v)) for v in ([1.0, 2.0, 0.0], [4.0, 1.0, 1.0]))), [2]))
    assert got(chunk)[0] == [[1, 2, 0], [3, -1, 1]]
    back = episode.absolute_action(deltas(spark), ND, PER)
    assert all(abs(a - b) < 1e-9 or abs(abs(a - b) - 2 * math.pi) < 1e-9 for x, y in zip(got(back, digits=12), STATES[1:], strict=True) for a, b in zip(x, y, strict=True))


def test_integrate(spark):
    row = table(spark, [[0.1, 0, 0, 0.5, 0, 0, 1]]).withColumnRenamed("state", "action")
    assert got(episode.integrate(row, F.array(*map(F.lit, [0.0, 0, 0, 3, 0, 0, 1])))) == [[0.1, 0, 0, -2.783185, 0, 0, 1]]


def test_vectors(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("c")).first()["c"]
    d = vec.doubles
    assert value(vec.pad_right(d([1, 2]), 4)) == [1, 2, 0, 0] and value(vec.pad_right(d([1, 2]), 1)) == [1, 2]
    assert value(vec.quantize(vec.minmax(d([-1, 0, 1, 5]), d([-1]), d([1])))) == [0, 127, 254, 254]
    assert value(vec.bins_to_text(F.array(*map(F.lit, [0, 127, 254, 254])))) == " 0 127 254 254"
    assert value(vec.text_to_action(F.lit(" 0 127 254"), dims=3)) == [-1, 0, 1] and value(vec.text_to_action(F.lit("1 2"), dims=3)) is None
    z = value(vec.zscore(d([1, 2, 3, 4]), d([2.5] * 4), d([1.118034] * 4)))
    assert [round(x, 5) for x in z] == [-1.34164, -0.44721, 0.44721, 1.34164]
    assert value(vec.zscore_inverse(d([1, 1, 7]), d([2]), d([3]))) == [2 + 3 + 1e-6, 1 + 1e-6, 7 * (1 + 1e-6)]
    assert value(vec.unflatten(d([1, 2, 3, 4, 5, 6]), 2, 2)) == [[1, 2], [3, 4]]
    assert value(vec.take_dims(d([1, 2, 3]), d([7, 8, 9]), [-1, 0])) == [7, 2, 9]
    assert value(vec.cosine(d([1, 0]), d([1, 1]))) == pytest.approx(math.sqrt(0.5)) and value(vec.cosine(d([0, 0]), d([1, 1]))) is None
    assert value(vec.all_finite(d([1, float("inf")]))) is False
    with pytest.raises(Exception, match="not finite"):
        value(vec.require_finite(d([1, float("nan")])))
    assert value(F.array(*(F.bround(F.lit(x), 0) for x in (0.5, 1.5, 2.5)))) == [0, 2, 2]


def test_statistics(spark):
    rng = random.Random(1)
    rows = [[rng.uniform(-5, 5), float(i)] for i in range(1, 201)]
    frames = table(spark, rows)
    s = {r.dim: r for r in stats.dimension_stats(frames, "state").collect()}
    assert (s[1].n, s[1].min, s[1].max, s[1].q01, s[1].q99) == (200, 1, 200, 2, 198)
    assert s[1].mean == pytest.approx(100.5) and s[1].std == pytest.approx(57.7343, abs=1e-3)
    approx = {r.dim: r for r in stats.dimension_stats(frames, "state", exact=False).collect()}
    assert abs(approx[1].q99 - 198) <= 1
    assert stats.dimension_stats(frames.limit(1), "state").collect() == []
    merged = stats.merge_stats(stats.dimension_stats(frames, "state").union(stats.dimension_stats(frames.withColumn("dataset", F.lit("e")), "state"))).orderBy("dim").collect()
    assert merged[1]["pooled_mean"] == pytest.approx(100.5) and merged[1]["pooled_std"] == pytest.approx(s[1].std)
    with pytest.raises(Exception, match="too few"):
        stats.require_rows(stats.dimension_stats(frames, "state"), 500).collect()


def test_bank_merge_golden(spark):
    rows = spark.createDataFrame([("r", "e", float(t), v) for t, v in enumerate([[1.0, 0.0], [1.0, 1.0], [0.0, 1.0]])], "role string, episode string, timestep double, feat array<double>")
    bank = memory.bank_merge(rows, 2).first()["bank"]
    assert [(e["t"], e["v"]) for e in bank] == [(0.5, [1, 0.5]), (2, [0, 1])]
    assert [len(r.bank) for r in memory.bank_fifo(rows, 2).orderBy("timestep").collect()] == [1, 2, 2]


def test_text(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("c")).first()["c"]
    assert value(text.strip(F.lit("\t\n a b \r\n"))) == "a b"
    assert value(text.image_first(F.lit(" see <image> here<image>"))) == "<image>\nsee  here"
    assert value(text.image_first(F.lit(" no mark "))) == " no mark "
    turns = F.expr("array(named_struct('from', 'gpt', 'value', 'hi'), named_struct('from', 'human', 'value', 'q'), named_struct('from', 'gpt', 'value', ''))")
    kept = text.drop_leading_answer(turns)
    assert value(text.alternates(kept)) and not value(text.alternates(turns))
    assert value(text.render_chat(kept, "S")) == "S USER: q ASSISTANT:"
    assert value(text.pad_ids(F.array(F.lit(5), F.lit(6)), 4, newline=1)) == [5, 6, 1, 0]
    assert value(text.drop_suffix(F.lit("ssa</s> "), "</s>")) == "ssa"
    ids = F.array(*map(F.lit, [1, 2, 3, 4]))
    good, bad = (F.array(F.struct(F.lit(n).alias("total"), F.lit(2).alias("instruction"))) for n in (4, 5))
    assert value(text.mask_labels(ids, good)) == [-100, -100, 3, 4] and value(text.mask_labels(ids, bad)) == [-100] * 4
    assert value(text.splice_images(F.lit("a b<image>c"), lambda p: F.transform(F.split(p, " "), lambda w: F.length(w)))) == [1, 1, -200, 1]


def test_batching(spark):
    rows = spark.createDataFrame([(0, 0, [5, 0]), (0, 1, [7]), (1, 0, [1, 2, 3])], "batch int, slot int, input_ids array<int>").withColumn("labels", F.col("input_ids"))
    out = {(r.batch, r.slot): r for r in batching.collate(rows, max_length=2).collect()}
    assert (out[0, 1].input_ids, out[0, 1].labels, out[0, 1].attention_mask) == ([7, 0], [7, -100], [1, 0])
    assert out[0, 0].attention_mask == [1, 1] and out[1, 0].input_ids == [1, 2]
    stacked = {r.batch: r for r in batching.stack(rows, ["input_ids"]).collect()}
    assert stacked[0].input_ids == [[5, 0], [7]] and not stacked[0].input_ids_uniform and stacked[1].input_ids_uniform
    ids, mask, at = batching.insert_block(F.array(*map(F.lit, [4, 5, 0])), F.array(*map(F.lit, [1, 1, 0])), F.array(F.lit(8), F.lit(9)))
    r = spark.range(1).select(ids.alias("i"), mask.alias("m"), at.alias("a"), batching.extract_block(ids, at, 2).alias("b")).first()
    assert (r.i, r.m, r.a, r.b) == ([4, 5, 8, 9, 0], [1, 1, 1, 1, 0], 2, [8, 9])
    lay = {x.slot: x for x in batching.splice_layout(rows.where("batch = 0"), "input_ids", 0, 3, "batch", side="left").collect()}
    assert lay[0].kind == [1, 2, 2, 2] and lay[1].kind == [0, 0, 0, 1] and lay[1].position_ids == [0, 0, 0, 0] and lay[0].position_ids == [0, 1, 2, 3]


def frames_of(spark, sizes):
    return spark.createDataFrame([("d", f"e{i}", f) for i, n in enumerate(sizes) for f in range(n)], "dataset string, episode_id string, frame_index int")


@pytest.mark.parametrize(("sizes", "world"), [([20, 3, 9, 30, 7, 8], 1), ([5, 2], 1), ([9] * 9, 2)])
def test_group_schedule(spark, sizes, world):
    frames = frames_of(spark, sizes)
    seen = []
    for rank in range(world):
        rows = sampling.group_schedule(frames, 12, 4, rank, world, seed=1).collect()
        again = sampling.group_schedule(frames.repartition(5), 12, 4, rank, world, seed=1).collect()
        assert sorted(rows) == sorted(again)
        seen.append({r.episode_id for r in rows})
        batches = {}
        for r in rows:
            batches.setdefault(r.batch, {}).setdefault((r.slot, r.episode_id), []).append((r.pos, r.frame_index))
        for b in batches.values():
            assert sum(len(v) for v in b.values()) == 12
            for chosen in b.values():
                order = [f for _, f in sorted(chosen)]
                assert order == sorted(order)
            if len(seen[-1]) >= 3 and len(sizes) // world >= 3:
                assert len({e for _, e in b}) == 3
    if world > 1:
        assert not seen[0] & seen[1]
    with pytest.raises(ValueError):
        sampling.group_schedule(frames, 10, 4)


def test_other_schedules(spark):
    frames = frames_of(spark, [5, 3, 4])
    rows = sampling.stream_schedule(frames, 4, seed=2).collect()
    assert len(rows) == 12 and sorted({r.batch for r in rows}) == [0, 1, 2]
    lanes = sampling.stream_schedule(frames, 2, seed=2, parallel=True).collect()
    assert len(lanes) == 12 and len({(r.batch, r.slot) for r in lanes}) == 12
    files = spark.createDataFrame([("d", f"f{i}") for i in range(7)], "dataset string, file string")
    assert [sampling.oversample(files, f).count() for f in (0, 0.3, 1, 1.5, 2)] == [0, 3, 7, 11, 14]
    assert sampling.shard(frames, 0, 2).count() + sampling.shard(frames, 1, 2).count() == 12


def test_numeric(spark):
    assert numeric.kept_timesteps(300, [10, 15, 20])[:3] == [0, 11, 22] and len(numeric.kept_timesteps(300, "10,15,20")) == 45
    assert numeric.kept_timesteps(1000, "ddim10") == list(range(0, 1000, 100))
    with pytest.raises(ValueError):
        numeric.kept_timesteps(10, "ddim7")
    betas = [r.beta for r in numeric.beta_schedule(spark, "squaredcos_cap_v2", 10).orderBy("t").collect()]
    assert betas[-1] == 0.999 and betas == sorted(betas)


def test_islands_and_order(spark):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate([None, None, "a", "a", "b", "a"])], "k int, i int, t string")
    assert [(r.run, r.step) for r in episode.label_islands(rows, "t", ["k"], ["i"]).orderBy("i").collect()] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (3, 0)]
    assert episode.order_violations(rows, ["k"], ["t", "i"], "i").count() == 1
    own = Episodes(keys=("k",), order=("i",))
    assert episode.trim_tail(rows, 2, own).count() == 4
