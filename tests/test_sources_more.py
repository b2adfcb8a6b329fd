"""Decoders, strict view zips, splices, tokenizers, templates, retries, running sums with odd rows, merging banks."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import batching, memory, sampling
from plumbline.operators import episode as ep
from plumbline.sources import media
from plumbline.streaming.events import with_retry


def test_netpbm_decoder():
    rgb = b"".join(b"P6\n# c\n2 1\n255\n" + bytes(range(6 * f, 6 * f + 6)) + b"\n" for f in range(4))
    assert list(media.netpbm_decoder("video", rgb, [0, 2, 9])) == [(0, bytes(range(6))), (2, bytes(range(12, 18)))]
    depth = b"P5 1 2 65535\n" + (258).to_bytes(2, "big") + (3).to_bytes(2, "big")
    assert list(media.library_decoder("depth", depth, [0])) == [(0, (258).to_bytes(2, "little") + (3).to_bytes(2, "little"))]
    assert list(media.netpbm_decoder("video", b"", [0])) == []
    for bad in (b"P4 1 1 255\nx", b"P6 2 2 255\nxx", b"P6 2"):
        with pytest.raises(ValueError):
            list(media.netpbm_decoder("video", bad, [0]))


def test_zip_views_and_functions(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5, 6]), ([1, 2, 3], [4])], "a array<int>, b array<int>")
    loose = [[tuple(x) for x in r.z] for r in df.select(media.zip_views(F.col("a"), F.col("b"), strict=False).alias("z")).collect()]
    assert loose == [[(1, 4), (2, 5), (3, 6)], [(1, 4)]]
    with pytest.raises(Exception, match="several lengths"):
        df.select(media.zip_views(F.col("a"), F.col("b"))).collect()
    changed = df.select(media.per_view(F.col("a"), [lambda x: -x, lambda x: x * 10]).alias("v"), media.per_view(F.col("a"), lambda x: x + 1).alias("w")).first()
    assert changed.v == [-1, 20, 30] and changed.w == [2, 3, 4]


def test_splice_and_tokenizers(spark):
    df = spark.createDataFrame([([5, -200, 7, -200], [[1.0], [0.0], [2.0], [0.0]], [[[8.0], [9.0]]])], "ids array<int>, w array<array<double>>, im array<array<array<double>>>")
    assert df.select(batching.splice_values(F.col("ids"), -200, F.col("w"), F.col("im")).alias("s")).first().s == [[1.0], [8.0], [9.0], [2.0]]
    turns = spark.createDataFrame([([("human", "a b"), ("gpt", "c")],), ([],), (None,)], f"t {text.TURN}")
    rows = turns.select(text.tokenize_chat(F.col("t")).alias("x"), text.render_with(F.col("t"), "plain").alias("p")).collect()
    assert len(rows[0].x.input_ids) == 5 and rows[0].x.labels[:3] == [-100] * 3 and rows[0].x.labels[3:] == rows[0].x.input_ids[3:]
    assert rows[1].x.input_ids == [] and rows[2].x.input_ids is None and rows[0].p == "a b\nc\n"
    coded = turns.select(text.arrow_encoder(lambda s: [len(s)])(F.get("t", F.lit(0))["value"]).alias("c")).collect()
    assert [r.c for r in coded] == [[3], None, None]
    text.register_template("mine", seps=("|", "|"))
    assert turns.select(text.render_with(F.col("t"), "mine").alias("p")).first().p == "|USER: a b|ASSISTANT: c|"
    with pytest.raises(KeyError):
        text.render_with(F.col("t"), "none")


def test_retry():
    calls = []

    def shaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("again")
        return x

    assert with_retry(shaky, 3)(7) == 7 and calls == [7, 7, 7]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(shaky, 2)(1)


def test_cumulative_chunks_of_odd_rows(spark):
    rows = [("d", "e", i, [float(i), None if i == 2 else 1.0]) for i in range(4)] + [("d", "f", 0, None)]
    frames = spark.createDataFrame(rows, "dataset string, episode_id string, frame_index int, action array<double>")
    got = {(r.episode_id, r.frame_index): r.action for r in ep.add_cumulative_chunk(frames, 2, gripper=()).collect()}
    assert got[("e", 0)] == [0.0, 1.0, 1.0, 2.0] and got[("e", 1)] == [1.0, 1.0, 3.0, None] and got[("e", 2)] == [2.0, None, 5.0, None]
    assert got[("f", 0)] is None


def test_merging_bank_is_a_plain_fold(spark):
    rng = random.Random(3)
    rows = [("r", f"e{i % 2}", float(i), None if i == 7 else [rng.gauss(0, 1) for _ in range(5)]) for i in range(40)]
    rows += [("r", "zero", float(i), [0.0] * 5) for i in range(4)]

    def cosine(a, b):
        norm = 0 if a is None or b is None else (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return sum(x * y for x, y in zip(a, b, strict=True)) / norm if norm else -2.0

    def fold(entries, length):
        bank = []
        for t, v in entries:
            bank.append((t, v))
            if len(bank) > length:
                sims = [cosine(a[1], b[1]) for a, b in zip(bank, bank[1:], strict=False)]
                i = sims.index(max(sims))
                (s, a), (t2, b) = bank[i : i + 2]
                bank[i : i + 2] = [((s + t2) / 2, None if a is None or b is None else [(x + y) / 2 for x, y in zip(a, b, strict=True)])]
        return bank

    df = spark.createDataFrame(rows, "role string, episode string, timestep double, feat array<double>").repartition(3)
    got = {r.episode: [(e.t, e.v) for e in r.bank] for r in memory.bank_merge(df, 4).collect()}
    assert got.keys() == {"e0", "e1", "zero"}
    for e, bank in got.items():
        want = fold([(t, v) for _, k, t, v in rows if k == e], 4)
        assert [t for t, _ in bank] == pytest.approx([t for t, _ in want])
        assert all((a is None) == (b is None) and (a is None or a == pytest.approx(b)) for (_, a), (_, b) in zip(bank, want, strict=True))
    assert memory.bank_merge(df.limit(0), 4).collect() == []


def test_schedules_reach_all_sets(spark):
    """Of four episodes two are drawn for a batch: with many batches every pair and every frame pair occurs."""
    frames = spark.createDataFrame([("d", f"e{i}", f) for i in range(4) for f in range(200)], "dataset string, episode_id string, frame_index int")
    rows = sampling.group_schedule(frames.where("frame_index < 4"), 4, 2, seed=5).collect()
    assert len(rows) == 16
    rows = sampling.group_schedule(frames, 4, 2, seed=5).collect()
    pairs = {}
    for r in rows:
        pairs.setdefault(r.batch, {}).setdefault(r.slot, []).append(r)
    assert len({frozenset(x[0].episode_id for x in b.values()) for b in pairs.values()}) == 6
    for b in pairs.values():
        for group in b.values():
            places = [r.frame_index for r in sorted(group, key=lambda r: r.pos)]
            assert len(places) == 2 and places[0] < places[1]


def test_approximate_counts_are_near(spark):
    from plumbline.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    exact = {r.event_type: r.users for r in spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").agg(F.count_distinct("user_id").alias("users")).collect()}
    near = {r.event_type: r.users for r in QUERIES["users_per_type_approx"](spark, sf).collect()}
    assert near.keys() == exact.keys() and all(abs(near[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
