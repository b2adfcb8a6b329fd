"""Registered queries over files and streams made from the driver tables: episode files, indexes, statistics documents,
catalogs, media, logs, request replay and keyed state. Each writes to the shared folder, reads back, and reports what
SQL says of the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numeric, text
from plumbline.operators import batching, sampling, stats
from plumbline.operators import episode as ep
from plumbline.plans.pipeline import Pipeline, select_keys, step
from plumbline.plans.queries import _ACT, _BASE, _EV, _STAT, _dataset_stats, _long, _r, _t
from plumbline.plans.registry import query
from plumbline.scratch import folder
from plumbline.sources import catalog, jsonl, media, seeds
from plumbline.sources.events import event_frames
from plumbline.streaming import state
from plumbline.streaming.events import replay_requests, with_retry

# Episode files.


def _episode_files(spark, sf_dir) -> str:
    at = folder(spark)
    jsonl.write_episodes(event_frames(spark, sf_dir).withColumn("user_id", F.col("episode_id")), at)
    return at


_LINE = "user_id long, state array<double>, prompt string, event_type string"


@query(f"WITH {_EV} SELECT episode_id AS user_id, frame_index, event_type, 'handle ' || first_type AS prompt, round(s0, 6) + 0.0 AS a, round(s1, 6) + 0.0 AS b, round(s2, 6) + 0.0 AS c, round(s3, 6) + 0.0 AS d FROM ev")
def jsonl_roundtrip(spark, sf_dir):
    frames = jsonl.read_episodes(spark, _episode_files(spark, sf_dir), "events", _LINE, pattern="*.json")
    good, _ = jsonl.quarantine(frames)
    parts = [_r(F.get("state", F.lit(i))).alias(c) for i, c in enumerate("abcd")]
    return good.select("user_id", "frame_index", "event_type", "prompt", *parts)


@query("SELECT n AS lines, count(*) AS files FROM (SELECT count(*) AS n FROM events GROUP BY user_id) GROUP BY 1")
def jsonl_index(spark, sf_dir):
    return jsonl.index_files(spark, _episode_files(spark, sf_dir), "*.json").groupBy("lines").agg(F.count(F.lit(1)).alias("files"))


@query("SELECT count(*) AS total_samples, count(DISTINCT user_id) AS total_files, true AS current_after, false AS current_when_changed FROM events")
def jsonl_cached_index(spark, sf_dir):
    at, cache = _episode_files(spark, sf_dir), folder(spark)
    jsonl.cached_index(spark, at, cache, "*.json")
    index = jsonl.cached_index(spark, at, cache, "*.json")  # the second time from the cache
    changed = jsonl.index_is_current(spark, at, index.withColumn("length", F.col("length") + 1), "*.json")
    now = jsonl.index_is_current(spark, at, index, "*.json")
    return jsonl.index_totals(index).select("total_samples", "total_files", F.lit(now).alias("current_after"), F.lit(changed).alias("current_when_changed"))


@query("""SELECT user_id, count(*) AS good, CAST(sum(CAST(event_id % 7 = 0 AS BIGINT)) AS BIGINT) AS bad FROM events GROUP BY user_id""")
def jsonl_quarantine(spark, sf_dir):
    """Every seventh line is broken off, and a blank one follows every fifth."""
    events = _t(spark, sf_dir, "events").select("event_id", "user_id", F.to_json(F.struct("user_id", "event_type")).alias("line"))
    lines = events.select("user_id", F.concat(F.col("line"), F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("\n"), F.expr("substring(line, 1, length(line) - 1)"))).otherwise(""), F.when(F.col("event_id") % 5 == 0, "\n  ").otherwise("")).alias("value"))
    at = folder(spark)
    lines.withColumn("u", F.col("user_id")).select("u", "value").repartition("u").write.partitionBy("u").text(at)
    frames = jsonl.read_episodes(spark, at, "events", "user_id long, event_type string", pattern="*.txt")
    good, bad = jsonl.quarantine(frames)
    per_file = good.groupBy("episode_id").agg(F.first("user_id").alias("user_id"), F.count(F.lit(1)).alias("good"))
    broken = bad.groupBy("episode_id").agg(F.count(F.lit(1)).alias("bad"))
    return per_file.join(broken, "episode_id", "left").select("user_id", "good", F.coalesce("bad", F.lit(0)).cast("long").alias("bad"))


@query("SELECT unnest(['images_1', 'images_10', 'images_2']) AS view")
def inferred_views(spark, sf_dir):
    at = folder(spark)
    ref = F.struct(F.lit("video").alias("type"), F.col("url"), F.lit(0).alias("frame_idx"))
    _t(spark, sf_dir, "pages").select(ref.alias("images_1"), ref.alias("images_2"), ref.alias("images_10"), "page_id").write.json(at)
    return spark.createDataFrame([(v,) for v in jsonl.infer_views(spark, at, pattern="*.json")], "view string")


# Statistics documents and guards.


@query(f"{_BASE}, {_STAT} SELECT dataset, dim, round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std, round(q01, 6) + 0.0 AS q01, round(hi, 6) + 0.0 AS top FROM stat")
def stats_document(spark, sf_dir):
    vectors = stats.as_vectors(_dataset_stats(spark, sf_dir), ["dataset"]).withColumn("key", F.lit("action"))
    at = folder(spark)
    jsonl.stats_to_json(vectors).select("document", "dataset").repartition("dataset").write.partitionBy("dataset").text(at)
    parts = [jsonl.read_stats(spark, f"{at}/dataset=ds{k}", f"ds{k}", required=True) for k in range(3)]  # a document a dataset
    rows = catalog.mix(parts).select("dataset", F.posexplode(F.arrays_zip("mean", "std", "q01", "max")).alias("dim", "x"))
    return rows.select("dataset", "dim", _r(F.col("x.mean")).alias("mean"), _r(F.col("x.std")).alias("std"), _r(F.col("x.q01")).alias("q01"), _r(F.col("x.max")).alias("top"))


@query("SELECT 'default' AS key, -1.0::DOUBLE AS lo, 1.0::DOUBLE AS hi")
def stats_default_document(spark, sf_dir):
    """A missing document is [-1, 1] under the default key."""
    rows = jsonl.read_stats(spark, f"{folder(spark)}/none.json")
    return rows.select("key", F.get("min", F.lit(0)).alias("lo"), F.get("max", F.lit(0)).alias("hi"))


@query("""SELECT o_custkey, n, round(mean, 6) + 0.0 AS mean FROM (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean FROM orders GROUP BY 1) WHERE n >= 2""")
def stats_two_rows(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select("o_custkey", F.array("o_totalprice").alias("x"))
    found = stats.require_rows(stats.dimension_stats(rows, "x", ("o_custkey",)))
    return found.select("o_custkey", "n", _r(F.col("mean")).alias("mean"))


@query("""SELECT event_type, count(*) AS n FROM (SELECT * FROM events ORDER BY md5('3|' || CAST(event_id AS VARCHAR)), event_id LIMIT 500) GROUP BY 1""")
def stats_sample(spark, sf_dir):
    """The optional cap on rows that statistics read (a sampling operator: 500 rows in drawn order)."""
    events = _t(spark, sf_dir, "events")
    return stats.sample_rows(events, ["event_id"], 500, seed=3).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# Catalog.


@query("""SELECT * FROM (VALUES ('calvin', 1::BIGINT), ('libero', 5::BIGINT), ('maniskill', 5::BIGINT), ('robotwin2', 50::BIGINT), ('simpler', 1::BIGINT)) AS t(family, datasets)""")
def catalog_seeds(spark, sf_dir):
    table = seeds.builtin().table(spark)
    return table.groupBy(F.split("dataset", "_")[0].alias("family")).agg(F.count(F.lit(1)).alias("datasets"))


@query("""SELECT * FROM (VALUES ('a_one', '/data/a', 1.0::DOUBLE, 6), ('a_two', '/data/b', 2.5::DOUBLE, 13), ('one', '', 0.5::DOUBLE, -1)) AS t(dataset, data_path_prefix, frequency, last_kept)""")
def catalog_files(spark, sf_dir):
    """Entries from documents in the shared folder; a later one replaces an earlier one of its name."""
    at = folder(spark)
    documents = [
        '{"prefix": "a", "meta": {"non_delta_mask": [6]}, "datasets": {"one": {"data_path_prefix": "/old"}, "two": {"data_path_prefix": "/data/b", "frequency": 2.5, "meta": {"non_delta_mask": [6, 13]}}}}',
        '{"datasets": {"a_one": {"data_path_prefix": "/data/a", "meta": {"non_delta_mask": [6]}}, "one": {"frequency": 0.5}}}',
    ]
    files = spark.createDataFrame(list(enumerate(documents)), "n int, value string").repartitionByRange(len(documents), "n")
    files.select("value").write.text(at)
    entries = catalog.Catalog().load(at, spark, "*.txt")
    wanted = entries.mixture("a_one+a_two+one")
    table = entries.table(spark).where(F.col("dataset").isin(wanted))
    return table.select("dataset", "data_path_prefix", "frequency", F.element_at("meta.non_delta_mask", -1).alias("last_kept"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 'new', 0.0 FROM customer WHERE c_custkey % 3 = 0""")
def catalog_upsert(spark, sf_dir):
    current = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    new = current.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_name"), F.lit(0.0).alias("c_acctbal"))
    return catalog.upsert(current, new, "c_custkey")


@query("""SELECT user_id, max_by(event_id, event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def catalog_last_registered(spark, sf_dir):
    return catalog.last_registered(_t(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("""SELECT url, min(page_id) AS page_id FROM pages GROUP BY url""")
def catalog_first_of_path(spark, sf_dir):
    return catalog.first_of_path(_t(spark, sf_dir, "pages").select("url", "page_id"), "url", "page_id")


@query(f"WITH {_EV} SELECT episode_id, frame_index, CASE dataset WHEN 'ds0' THEN '/a' WHEN 'ds1' THEN '/b' ELSE '' END AS data_path_prefix, CASE dataset WHEN 'ds1' THEN 13 ELSE 6 END AS last_kept, dataset = 'ds2' AS angles FROM ev")
def catalog_attach(spark, sf_dir):
    entries = catalog.Catalog().register(
        {"ds0": {"data_path_prefix": "/a", "meta": catalog.PROFILES["single_arm"]}, "ds1": {"data_path_prefix": "/b", "meta": catalog.PROFILES["two_arms"]}, "ds2": {"meta": catalog.PROFILES["single_arm_angles"]}}
    )
    found = catalog.attach(event_frames(spark, sf_dir), F.broadcast(entries.table(spark)))  # a row per registered dataset
    return found.select("episode_id", "frame_index", "data_path_prefix", F.element_at("meta.non_delta_mask", -1).alias("last_kept"), F.col("meta.periodic_mask").isNotNull().alias("angles"))


# Columns, masks and schedules.


@query(f"WITH {_EV} SELECT episode_id, frame_index FROM ev")
def selected_keys(spark, sf_dir):
    return Pipeline(step(select_keys, ["episode_id", "frame_index"]), [])(event_frames(spark, sf_dir))


@query(f"{_ACT} SELECT episode_id, count(DISTINCT frame_index) AS frames FROM act GROUP BY 1")
def missing_columns_are_no_ops(spark, sf_dir):
    """Without the columns that they work on, these leave the rows alone."""
    bare = ep.add_action(event_frames(spark, sf_dir), 1).drop("state", "action", "abs_action")
    for f in (ep.add_action, ep.delta_action, ep.relative_to_delta, ep.absolute_action, ep.add_chunk, ep.add_cumulative_chunk, text.replace_answer):
        bare = f(bare)
    return bare.groupBy("episode_id").agg(F.count(F.lit(1)).alias("frames"))


@query("""SELECT page_id, page_id % 2 = 0 AS first, page_id % 3 = 0 AS second, false AS third, CAST(page_id % 2 = 0 AS INTEGER) + CAST(page_id % 3 = 0 AS INTEGER) AS views, least(1, CAST(page_id % 2 = 0 AS INTEGER) + CAST(page_id % 3 = 0 AS INTEGER)) AS limited, 3 AS padded FROM pages""")
def view_masks(spark, sf_dir):
    ref = lambda n: F.when(F.col("page_id") % (n + 1) == 0, F.struct(F.lit("image").alias("type"), F.col("url"), F.lit(None).cast("int").alias("frame_idx")))
    views = media.views_map(_t(spark, sf_dir, "pages").select("page_id", ref(1).alias("images_1"), ref(2).alias("images_2")))
    mask, names = media.view_mask(F.col("images"), 3), media.select_views(F.col("images"))
    return views.select(
        "page_id", *(F.get(mask, F.lit(i)).alias(c) for i, c in enumerate(("first", "second", "third"))), F.size(names).alias("views"),
        F.size(media.select_views(F.col("images"), limit=1)).alias("limited"), F.size(media.pad_nulls(names, 3)).alias("padded"),
    )


@query("""SELECT vec_id, CAST(i AS INTEGER) AS place, round(e[i + 1] * CASE WHEN i = 0 THEN 2 ELSE -1 END + e[i + 33], 6) + 0.0 AS value FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), (SELECT unnest(range(32)) AS i)""")
def zipped_views(spark, sf_dir):
    """Two families of views side by side, after a function of each place."""
    v = F.col("embedding").cast("array<double>")
    own = media.per_view(F.slice(v, 1, 32), [lambda x: 2 * x, lambda x: -x])
    pairs = media.zip_views(own, F.slice(v, 33, 32), names=["a", "b"])
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(pairs).alias("place", "x"))
    return rows.select("vec_id", "place", _r(F.col("x.a") + F.col("x.b")).alias("value"))


@query("""SELECT vec_id, CAST(k * 8 + d AS INTEGER) AS dim, round(CASE WHEN k = 0 OR d = 7 THEN embedding[k * 8 + d + 1] ELSE embedding[k * 8 + d + 1] - embedding[k * 8 + d - 7] END, 6) + 0.0 AS value
FROM (SELECT vec_id, embedding::DOUBLE[] AS embedding FROM embeddings), (SELECT unnest(range(8)) AS k), (SELECT unnest(range(8)) AS d)""")
def chunk_deltas(spark, sf_dir):
    """Each embedding as a chunk of eight vectors, made relative along the chunk."""
    v = F.col("embedding").cast("array<double>")
    chunk = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.slice(v, k * 8 + 1, F.lit(8)))
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", chunk.alias("c"))
    return rows.select("vec_id", F.posexplode(F.flatten(ep.chunk_to_delta(F.col("c"), (-1,)))).alias("dim", "x")).select("vec_id", "dim", _r(F.col("x")).alias("value"))


@query("""SELECT user_id, CAST(row_number() OVER (ORDER BY md5('5|' || CAST(user_id AS VARCHAR)), user_id) - 1 AS BIGINT) AS place FROM (SELECT DISTINCT user_id FROM events)""")
def drawn_order(spark, sf_dir):
    return sampling.number_episodes(_t(spark, sf_dir, "events"), ["user_id"], 5).select("user_id", F.col("place").cast("long").alias("place"))


@query("""SELECT user_id % 4 AS rank, user_id, count(*) AS frames FROM events GROUP BY ALL""")
def batch_log(spark, sf_dir):
    at = folder(spark)
    batching.write_batch_log(event_frames(spark, sf_dir).select((F.col("episode_id") % 4).alias("rank"), "dataset", "episode_id", "frame_index"), at)
    back = spark.read.schema("dataset string, user_id long, frame_index int, rank long").option("sep", "\t").csv(at)
    return back.groupBy("rank", "user_id").agg(F.count(F.lit(1)).alias("frames"))


@query("""SELECT i, t FROM (SELECT CAST(row_number() OVER (ORDER BY t) - 1 AS BIGINT) AS i, t FROM (
  SELECT DISTINCT CAST(base + round_even(CAST(i AS DOUBLE) * (size - 1) / (n - 1), 0) AS BIGINT) AS t FROM (VALUES (0, 101, 10), (101, 100, 15), (201, 100, 20)) AS s(base, size, n), (SELECT unnest(range(20)) AS i) WHERE i < n))""")
def sectioned_timesteps(spark, sf_dir):
    return numeric.timestep_table(spark, 301, "10,15,20")


@query("""SELECT t, round(CASE WHEN t < 50 THEN 0.001 + (0.2 - 0.001) * t / 49 ELSE 0.2 END, 9) AS beta FROM (SELECT unnest(range(100)) AS t)""")
def beta_half_warmup(spark, sf_dir):
    return numeric.beta_schedule(spark, "warmup50", 100, 0.001, 0.2).select("t", F.round("beta", 9).alias("beta"))


# Tokens and sequences.


def _chat(spark, sf_dir) -> DataFrame:
    """Conversations as turns of human and gpt."""
    rows = _t(spark, sf_dir, "conversations").where("role in ('user', 'assistant')")
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text")))), lambda t: F.struct(F.when(t["role"] == "user", "human").otherwise("gpt").alias("from"), t["text"].alias("value")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


_WORDS = r"list_filter(regexp_split_to_array({0}, '[ \t\n\f\r\x0B]+'), lambda w: w <> '')"


@query(rf"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, coalesce(text, '')) - 1 AS i FROM conversations WHERE role IN ('user', 'assistant')),
w AS (SELECT conv_id, role, {_WORDS.format("(CASE WHEN role = 'user' THEN 'USER' ELSE 'ASSISTANT' END) || ': ' || text || (CASE WHEN i % 2 = 0 THEN ' ' ELSE '</s>' END)")} AS words FROM t),
n AS (SELECT conv_id, role, len(words) AS n, list_transform(words, lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 50000 + 1) AS ids FROM w)
SELECT conv_id, CAST(sum(n) AS BIGINT) AS ids, CAST(sum(list_sum(ids)) AS BIGINT) AS id_sum, CAST(sum(CASE WHEN role = 'user' THEN n ELSE 0 END) AS BIGINT) AS masked,
       CAST(coalesce(sum(CASE WHEN role = 'user' THEN 0 ELSE list_sum(ids) END), 0) AS BIGINT) AS label_sum FROM n GROUP BY conv_id""")
def tokenized_chat(spark, sf_dir):
    rows = _chat(spark, sf_dir).withColumn("t", text.tokenize_chat(F.col("turns")))
    total = lambda c, kept: F.aggregate(F.filter(c, kept), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "conv_id", F.size("t.input_ids").cast("long").alias("ids"), total(F.col("t.input_ids"), lambda x: x == x).alias("id_sum"),
        F.size(F.filter("t.labels", lambda x: x == text.IGNORED)).cast("long").alias("masked"), total(F.col("t.labels"), lambda x: x != text.IGNORED).alias("label_sum"),
    )


@query("""SELECT o_orderkey, CAST(n AS INTEGER) AS at, n + 3 AS attended, 900 + 901 + 902 AS block_sum, 12 + 3 AS size FROM (SELECT o_orderkey, o_custkey % 10 + 1 AS n FROM orders)""")
def inserted_blocks(spark, sf_dir):
    n = (F.col("o_custkey") % 10 + 1).cast("int")
    ids = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.when(i <= n, i).otherwise(0))
    mask = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: (i <= n).cast("int"))
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", ids.alias("ids"), mask.alias("mask"))
    new, ones, at = batching.insert_block(F.col("ids"), F.col("mask"), F.array(F.lit(900), F.lit(901), F.lit(902)))
    made = rows.select("o_orderkey", new.alias("ids"), ones.alias("mask"), at.alias("at"))
    add = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return made.select("o_orderkey", "at", add(F.col("mask")).cast("long").alias("attended"), add(batching.extract_block(F.col("ids"), F.col("at"), 3)).alias("block_sum"), F.size("ids").alias("size"))


@query("""SELECT vec_id, CAST(place AS INTEGER) AS place, round(value, 6) + 0.0 AS value FROM (
  SELECT vec_id, unnest(range(68)) AS place, unnest(list_concat(list_concat(e[1:1], [100.0, 101.0, 102.0]), list_concat(e[3:33], list_concat([200.0, 201.0, 202.0], e[35:64])))) AS value FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))""")
def spliced_values(spark, sf_dir):
    """Two image sentinels among 64 places give way to three patches each."""
    ids = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(i.isin(1, 33), text.IMAGE_ID).otherwise(i))
    words = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.array(x))
    images = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda k: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda p: F.array((k * 100 + p).cast("double"))))
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(batching.splice_values(ids, text.IMAGE_ID, words, images)).alias("place", "x"))
    return rows.select("vec_id", "place", _r(F.get("x", F.lit(0))).alias("value"))


# Media.


def _write_videos(spark, count: int) -> str:
    """``count`` files of three PPM frames of 2 by 1 pixels and three 16-bit PGM frames, made where they are written."""
    import pyarrow as pa

    at = folder(spark)

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for k in batch.column(0).to_pylist():
                rgb = b"".join(b"P6\n# made\n2 1\n255\n" + bytes([k % 256, f, 3, 4, 5, 6]) + b"\n" for f in range(3))
                depth = b"".join(b"P5 1 1 65535\n" + (1000 * f + k).to_bytes(2, "big") for f in range(3))
                store, root = (fs.LocalFileSystem(), "/" + at.removeprefix("file:").lstrip("/")) if at.startswith(("file:", "/")) else fs.FileSystem.from_uri(at)
                store.create_dir(root, recursive=True)
                for name, data in ((f"{k}.ppm", rgb), (f"{k}.pgm", depth)):
                    with store.open_output_stream(f"{root}/{name}") as out:
                        out.write(data)
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["k"])

    spark.range(count).select(F.col("id").alias("k")).mapInArrow(run, "k long").count()
    return at


def _video_frames(spark, sf_dir, at: str) -> DataFrame:
    k, f = F.col("page_id") % 20, (F.col("page_id") % 3).cast("int")
    ref = lambda kind, end: F.struct(F.lit(kind).alias("type"), F.concat(k.cast("string"), F.lit(end)).alias("url"), f.alias("frame_idx"))
    rows = _t(spark, sf_dir, "pages").select("page_id", ref("video", ".ppm").alias("images_1"), ref("video", ".pgm").alias("images_2"))
    wanted = media.media_requests(media.views_map(rows), ["page_id"])
    return wanted.withColumn("url", media.join_url(F.lit(at + "/"), F.col("url")))


def _pixel_sums(rows: DataFrame, frames: DataFrame) -> DataFrame:
    number = lambda c, i: F.conv(F.hex(F.substring(c, i, 1)), 16, 10).cast("int")
    rgb, depth = F.get("rgb_data", F.lit(0)), F.get("rgb_data", F.lit(1))
    return rows.select("page_id", F.size("rgb_data").alias("views"), F.octet_length(rgb).alias("bytes"), number(rgb, 1).alias("red"), number(rgb, 2).alias("green"), (number(depth, 1) + 256 * number(depth, 2)).alias("depth"))


_PIXELS = "SELECT page_id, 3 AS views, 6 AS bytes, CAST(page_id % 20 AS INTEGER) AS red, CAST(page_id % 3 AS INTEGER) AS green, CAST(1000 * (page_id % 3) + page_id % 20 AS INTEGER) AS depth FROM pages"


@query(_PIXELS)
def media_by_scan(spark, sf_dir):
    """Frames of videos and 16-bit depth decoded from a binary scan, each file once."""
    at = _write_videos(spark, 20)
    wanted = _video_frames(spark, sf_dir, at)
    files = spark.read.format("binaryFile").load(at).withColumn("path", F.concat(F.lit(at + "/"), F.element_at(F.split("path", "/"), -1)))
    pixels = media.decode(media.requests_by_url(wanted), files, media.library_decoder)
    pages = _t(spark, sf_dir, "pages").select("page_id")
    return _pixel_sums(media.attach_media(pages, wanted, pixels, ["page_id"], count=3), pages)


@query(_PIXELS)
def media_by_path(spark, sf_dir):
    """The same with paths sent to the tasks and no file content in a shuffle."""
    wanted = _video_frames(spark, sf_dir, _write_videos(spark, 20))
    pixels = media.decode_paths(media.requests_by_url(wanted), media.library_decoder)
    pages = _t(spark, sf_dir, "pages").select("page_id")
    return _pixel_sums(media.attach_media(pages, wanted, pixels, ["page_id"], count=3), pages)


# Streams.


def _stream(rows: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` as a file stream, and a folder for its results."""
    spark, at = rows.sparkSession, folder(rows.sparkSession)
    state.configure(spark)
    rows.write.parquet(f"{at}/in")
    return spark.readStream.schema(rows.schema).parquet(f"{at}/in"), at


@query("""SELECT user_id, event_id, run, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1 AS INTEGER) AS step FROM (
  SELECT user_id, event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS run FROM (
    SELECT user_id, event_id, CASE WHEN row_number() OVER w = 1 OR event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)))""")
def stream_sessions(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("client"), F.col("event_id").alias("seq"), F.col("event_type").alias("text"))
    df, at = _stream(rows)
    out = state.run_to_files(state.session_stream(df), at)
    return out.select(F.col("client").cast("long").alias("user_id"), F.col("seq").alias("event_id"), "run", "step")


@query("""WITH e AS (SELECT label, vec_id, list(vec_id) OVER w AS t, list(embedding::DOUBLE[]) OVER w AS x FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT CAST(label AS VARCHAR) AS episode, vec_id, CAST(len(t) AS INTEGER) AS size, CAST(t[1] AS BIGINT) AS oldest, round(list_sum(list_transform(x, lambda v: list_sum(v))), 4) + 0.0 AS total FROM e""")
def stream_bank(spark, sf_dir):
    rows = _t(spark, sf_dir, "embeddings").select(F.lit("cog").alias("role"), F.col("label").cast("string").alias("episode"), F.col("vec_id").cast("double").alias("t"), F.col("embedding").cast("array<double>").alias("v"), F.lit(False).alias("reset"))
    df, at = _stream(rows)
    out = state.run_to_files(state.bank_stream(df, 8), at)
    total = F.aggregate(F.flatten("vectors"), F.lit(0.0), lambda a, x: a + x)
    return out.select("episode", F.col("t").cast("long").alias("vec_id"), F.size("times").alias("size"), F.get("times", F.lit(0)).cast("long").alias("oldest"), (F.round(total, 4) + 0.0).alias("total"))


@query(f"""WITH {_EV} SELECT episode_id, frame_index, CAST(n AS INTEGER) AS frames, round(sum(0.5 * s0) OVER (PARTITION BY episode_id ORDER BY frame_index) + first_value(s0) OVER (PARTITION BY episode_id ORDER BY frame_index), 4) + 0.0 AS value FROM ev""")
def stream_integrate(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    rows = frames.select(F.col("episode_id").cast("string").alias("episode"), F.col("frame_index").cast("long").alias("seq"), F.transform("state", lambda x: 0.5 * x).alias("delta"), F.col("state").alias("start"))
    df, at = _stream(rows)
    out = state.run_to_files(state.integrate_stream(df, hold=(3,), angles=(2,)), at)
    lengths = out.groupBy("episode").agg(F.count(F.lit(1)).cast("int").alias("frames"))
    return out.join(lengths, "episode").select(F.col("episode").cast("long").alias("episode_id"), F.col("seq").cast("int").alias("frame_index"), "frames", (F.round(F.get("action", F.lit(0)), 4) + 0.0).alias("value"))


@query("""SELECT event_id, 'run/' || CAST(user_id AS VARCHAR) || '/' || CAST(event_id AS VARCHAR) || '_front.png' AS path, length(event_type) AS size FROM events""")
def replayed_requests(spark, sf_dir):
    """Requests replayed through a handler that fails once, and the paths at which their images would be kept."""
    df, at = _stream(_t(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))
    failed: list[int] = []

    def handle(batch: DataFrame, number: int) -> None:
        if number not in failed:
            failed.append(number)
            raise OSError("not there yet")
        path = media.image_path("run", F.col("user_id"), F.col("event_id"), F.lit("front"))
        batch.select("event_id", path.alias("path"), F.length("event_type").cast("long").alias("size")).write.mode("overwrite").parquet(f"{at}/replies/{number}")

    replay_requests(df, with_retry(handle, 3, (OSError,)), f"{at}/checkpoint").awaitTermination()
    return spark.read.schema("event_id long, path string, size long").option("recursiveFileLookup", True).parquet(f"{at}/replies")
