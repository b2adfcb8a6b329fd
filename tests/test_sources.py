"""Episode files, their index and quarantine; statistics documents; catalog; media references."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.sources import catalog, jsonl, media
from plumbline.sources.schema import with_views


def write(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return path


def test_episode_files(spark, tmp_path):
    write(tmp_path, "a/e1.jsonl", [json.dumps({"state": [i, 0], "prompt": "grüße"}) for i in range(40)] + ["", "  "])
    write(tmp_path, "b/c/e2.jsonl", ['{"state": [1.5], "prompt": "p", "extra": 1}', "not json", '{"prompt": "q"}'])
    write(tmp_path, "b/other.txt", ["{}"])
    frames = jsonl.read_episodes(spark, str(tmp_path), "d")
    good, bad = jsonl.quarantine(frames)
    rows = good.where(F.col("episode_id").endswith("e1.jsonl")).orderBy("frame_index").collect()
    assert [r.frame_index for r in rows] == list(range(40)) and [r.state[0] for r in rows] == list(range(40)) and rows[0].prompt == "grüße"
    assert [r["_corrupt"] for r in bad.collect()] == ["not json"] and good.count() == 42
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        jsonl.read_episodes(spark, str(tmp_path), "d", mode="FAILFAST").collect()


def test_index_cache(spark, tmp_path):
    data, cache = tmp_path / "data", str(tmp_path / "cache")
    write(data, "e1.jsonl", ["{}", "", "{}"])
    index = jsonl.cached_index(spark, str(data), cache)
    assert [tuple(r) for r in jsonl.index_totals(index).collect()] == [(2, 1)]
    assert jsonl.index_is_current(spark, str(data), index)
    write(data, "e1.jsonl", ["{}", "{}", "{}"])
    assert not jsonl.index_is_current(spark, str(data), index)
    assert jsonl.index_totals(jsonl.cached_index(spark, str(data), cache)).first()[0] == 3


def test_write_episodes(spark, tmp_path):
    frames = spark.createDataFrame([("d", f"e{i % 2}", i // 2, [float(i)]) for i in range(10)], "dataset string, episode_id string, frame_index int, state array<double>")
    jsonl.write_episodes(frames, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("episode=*/*.json"))
    assert len(files) == 2
    for f in files:
        assert [json.loads(x)["frame_index"] for x in f.read_text().splitlines()] == list(range(5))


def test_statistics_documents(spark, tmp_path):
    rows = jsonl.stats_from_json(spark, '{"norm_stats": {"action": {"min": [-1, 0], "max": [1, 2]}, "default": {"min": -1, "max": 1}}}', "d")
    assert {(r.key, tuple(r.min)) for r in rows.collect()} == {("action", (-1, 0)), ("default", (-1,))}
    document = jsonl.stats_to_json(rows).first()["document"]
    assert json.loads(document)["norm_stats"]["action"]["max"] == [1, 2]
    assert jsonl.read_stats(spark, str(tmp_path / "none.json")).first().min == [-1]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jsonl.read_stats(spark, str(tmp_path / "none.json"), required=True)


def test_catalog(spark, tmp_path):
    c = catalog.Catalog().register({"a": {"annotations": "x", "frequency": 0.3}, "b": {"annotations": "x"}}, "p", catalog.PROFILES["two_arms"])
    c.register({"p_a": {"annotations": "y"}})
    (tmp_path / "more.json").write_text(json.dumps({"prefix": "q", "datasets": {"z": {"annotations": "w"}}}))
    c.load(str(tmp_path))
    table = c.table(spark)
    assert [(r.dataset, r.annotations, r.frequency, r.meta.non_delta_mask) for r in table.collect()] == [("p_a", "y", 1.0, [-1]), ("p_b", "x", 1.0, [6, 13]), ("q_z", "w", 1.0, [-1])]
    assert c.mixture("p_a + q_z") == ["p_a", "q_z"]
    with pytest.raises(KeyError, match="nope"):
        c.mixture("p_a+nope")
    frames = spark.createDataFrame([("p_b", 1), ("who", 2)], "dataset string, x int")
    with pytest.raises(Exception, match="not in the catalog"):
        catalog.attach(frames, table).collect()
    assert catalog.attach(frames, table, strict=False).count() == 1
    entries = spark.createDataFrame([("k", "p", 0), ("k", "p", 1), ("m", "p", 2)], "dataset string, annotations string, registered int")
    assert {(r.dataset, r.registered) for r in catalog.last_registered(entries).collect()} == {("k", 1), ("m", 2)}
    assert catalog.first_of_path(entries, order="registered").count() == 1
    assert catalog.upsert(entries, entries.where("registered = 2").withColumn("annotations", F.lit("new"))).where("annotations = 'new'").count() == 1
    assert catalog.mix([frames, frames.drop("x")]).where("x is null").count() == 2


def test_media(spark, tmp_path):
    ref = lambda u, k=None: {"type": "video", "url": u, "frame_idx": k}
    write(tmp_path, "e.jsonl", [json.dumps({"prompt": "p", "images_1": ref("a.mp4", i), "images_10": ref("b.mp4", 0), "images_2": ref("a.mp4", 7)}) for i in range(3)])
    names = jsonl.infer_views(spark, str(tmp_path))
    assert names == ["images_1", "images_10", "images_2"]
    frames = media.views_map(jsonl.read_episodes(spark, str(tmp_path), "d", with_views(names)))
    wanted = media.media_requests(frames)
    assert [r.view for r in wanted.where("frame_index = 0").orderBy("place").collect()] == names
    assert [r.view for r in media.media_requests(frames, wanted=["images_2", "images_1", "images_5"]).where("frame_index = 1").orderBy("place").collect()] == ["images_2", "images_1"]
    assert {r.url: r.frames for r in media.requests_by_url(wanted).collect()} == {"a.mp4": [0, 1, 2, 7], "b.mp4": [0]}
    files = spark.createDataFrame([("a.mp4", bytearray(b"AA")), ("b.mp4", bytearray(b"B"))], "path string, content binary")
    pixels = media.decode(media.requests_by_url(wanted), files, media.passthrough_decoder)
    out = media.attach_media(frames, wanted, pixels, count=4).where("frame_index = 2").first()
    assert [None if p is None else bytes(p) for p in out.rgb_data] == [b"AA", b"B", b"AA", None]
    assert frames.select(media.view_mask(F.col("images"), 3).alias("m")).first().m == [True, True, False]
    one = spark.range(1)
    urls = one.select(*(media.join_url(F.lit(p), F.lit(u)).alias(f"c{i}") for i, (p, u) in enumerate([("/d/", "x"), ("/d", "/abs"), ("/d", "s3://b/x"), ("", "x")]))).first()
    assert list(urls) == ["/d/x", "/abs", "s3://b/x", "x"]


def test_builtin_catalog(spark):
    from plumbline.sources.seeds import builtin

    entries = builtin("/d").entries
    assert len(entries) == 5 + 1 + 1 + 5 + 50
    assert entries["maniskill_pickcube"]["annotations"] == "/d/maniskill/jsonl/PickCube-v0"
    assert entries["robotwin2_turn_switch"]["meta"]["non_delta_mask"] == [6, 13]
    path = spark.range(1).select(media.image_path("/out/", F.lit(2), F.lit(0), F.lit(1)).alias("p")).first().p
    assert path == "/out/2/0_1.png"
