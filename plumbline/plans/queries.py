"""Registered queries over the driver tables: (spark, sf_dir) -> DataFrame, with DuckDB twins where SQL can say it.

Vector results are in long form (episode_id, frame_index, dim, value), rounded to six places on both sides; chunks are
reported as their place-weighted sums, which any change of order, padding or value moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import numeric, text, vec
from plumbline.operators import batching, memory, relational, sampling, stats
from plumbline.operators import episode as ep
from plumbline.plans.pipeline import ActionPlan, normalise_to_text
from plumbline.plans.registry import ORACLES, QUERIES, query  # noqa: F401
from plumbline.sources import catalog, media
from plumbline.sources.events import NON_DELTA, PERIODIC, event_frames
from plumbline.streaming.events import session_counts, windowed_counts


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(x: Column) -> Column:
    return F.round(x.cast("double"), 6) + 0.0


def _long(df: DataFrame, column: str = "action") -> DataFrame:
    rows = df.select("episode_id", "frame_index", F.posexplode(column).alias("dim", "x"))
    return rows.select("episode_id", "frame_index", "dim", _r(F.col("x")).alias("value"))


def _weighted(df: DataFrame, chunk: Column, dims: int = 4) -> DataFrame:
    """Long form of a chunk (an array of vectors): per dimension the sum of (step + 1) * value."""
    scaled = F.transform(chunk, lambda v, k: F.transform(v, lambda x: (k + 1) * x))
    return _long(df.withColumn("__w", F.aggregate(scaled, vec.doubles([0.0] * dims), vec.add)), "__w")


_EV = """ev AS (
  SELECT 'ds' || CAST(user_id % 3 AS VARCHAR) AS dataset, user_id AS episode_id, event_type,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame_index,
         first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_type,
         CAST(count(*) OVER (PARTITION BY user_id) AS INTEGER) AS n,
         CAST(value AS DOUBLE) AS s0, CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS s1,
         2 * pi() * (extract('hour' FROM ts) * 3600 + extract('minute' FROM ts) * 60 + extract('second' FROM ts)) / 86400 - pi() AS s2,
         CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s3
  FROM events
), st AS (
  SELECT dataset, episode_id, frame_index, n, event_type, first_type, CAST(dim AS INTEGER) AS dim, [s0, s1, s2, s3][dim + 1] AS s
  FROM ev, (SELECT unnest(range(4)) AS dim)
)"""


def _act(steps: int) -> str:
    """Actions (states some steps later) in long form; ``n`` is the number of frames that are left."""
    return f"""act AS (
  SELECT dataset, episode_id, frame_index, n - {steps} AS n, dim, first_type, s, a FROM (
    SELECT *, lead(s, {steps}) OVER (PARTITION BY episode_id, dim ORDER BY frame_index) AS a FROM st
  ) WHERE frame_index < n - {steps}
)"""


_DEL = """del AS (
  SELECT dataset, episode_id, frame_index, n, dim, first_type, s, a AS abs_a,
         CASE WHEN dim = 3 THEN a WHEN dim = 2 AND a - s > pi() THEN a - s - 2 * pi() WHEN dim = 2 AND a - s < -pi() THEN a - s + 2 * pi() ELSE a - s END AS a
  FROM act
)"""
_ACT, _BASE = f"WITH {_EV}, {_act(1)}", f"WITH {_EV}, {_act(1)}, {_DEL}"
_OUT = "SELECT episode_id, frame_index, dim, round(a, 6) + 0.0 AS value FROM "
_STAT = """stat AS (
  SELECT dataset, dim, count(a) AS n, avg(a) AS mean, stddev_pop(a) AS std, quantile_disc(a, 0.01) AS q01, quantile_disc(a, 0.99) AS q99, min(a) AS lo, max(a) AS hi
  FROM del GROUP BY dataset, dim
)"""


def _actions(spark: SparkSession, sf_dir: str, steps: int = 1) -> DataFrame:
    return ep.add_action(event_frames(spark, sf_dir), steps)


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.delta_action(_actions(spark, sf_dir), NON_DELTA, PERIODIC)


def _dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dimension_stats(_deltas(spark, sf_dir), "action", exact=True)


# Frames and actions.


@query(f"WITH {_EV} SELECT dataset, episode_id, frame_index, event_type FROM ev")
def frame_index(spark, sf_dir):
    return event_frames(spark, sf_dir).select("dataset", "episode_id", "frame_index", "event_type")


@query(f"{_ACT} {_OUT} act")
def add_action_1(spark, sf_dir):
    return _long(_actions(spark, sf_dir))


@query(f"WITH {_EV}, {_act(16)} {_OUT} act")
def add_action_16(spark, sf_dir):
    return _long(_actions(spark, sf_dir, 16))


@query(f"{_BASE} {_OUT} del")
def delta_action(spark, sf_dir):
    return _long(_deltas(spark, sf_dir))


@query(f"""{_ACT}, d AS (
  SELECT *, a - lag(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index) AS m FROM act
), k AS (
  SELECT *, CASE WHEN frame_index = 0 OR dim = 3 THEN a ELSE m END AS x FROM d
) SELECT episode_id, frame_index, dim, round(CASE WHEN dim = 2 AND x > pi() THEN x - 2 * pi() WHEN dim = 2 AND x < -pi() THEN x + 2 * pi() ELSE x END, 6) + 0.0 AS value FROM k""")
def relative_delta(spark, sf_dir):
    return _long(ep.relative_to_delta(_actions(spark, sf_dir), NON_DELTA, PERIODIC))


@query(f"""{_BASE}, b AS (SELECT *, CASE WHEN dim = 3 THEN a ELSE s + a END AS x FROM del)
SELECT episode_id, frame_index, dim, round(CASE WHEN dim = 2 AND x > pi() THEN x - 2 * pi() WHEN dim = 2 AND x < -pi() THEN x + 2 * pi() ELSE x END, 6) + 0.0 AS value,
       round(abs_a, 6) + 0.0 AS original FROM b""")
def absolute_roundtrip(spark, sf_dir):
    df = ep.absolute_action(_deltas(spark, sf_dir), NON_DELTA, PERIODIC)
    rows = df.select("episode_id", "frame_index", F.posexplode(F.arrays_zip("action", "abs_action")).alias("dim", "x"))
    return rows.select("episode_id", "frame_index", "dim", _r(F.col("x.action")).alias("value"), _r(F.col("x.abs_action")).alias("original"))


# Chunks.


def _chunk_sql(length: int, pad: str, keep: str = "") -> str:
    return f"""{_BASE}, c AS (
  SELECT episode_id, frame_index, dim, n, list(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND {length - 1} FOLLOWING) AS l,
         last_value(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z
  FROM del {keep}
) SELECT episode_id, frame_index, dim,
         round(list_sum(list_transform(range({length}), lambda k: (k + 1) * coalesce(l[k + 1], {pad}))), 6) + 0.0 AS value FROM c"""


_ZERO = "CASE WHEN dim = 3 THEN z ELSE 0.0 END"


@query(_chunk_sql(16, "z"))
def chunk_last_16(spark, sf_dir):
    return _weighted(ep.add_chunk(_deltas(spark, sf_dir), 16, padding="last", flat=False), F.col("action"))


@query(_chunk_sql(16, _ZERO))
def chunk_zero_16(spark, sf_dir):
    return _weighted(ep.add_chunk(_deltas(spark, sf_dir), 16, padding="zero", non_delta=NON_DELTA, flat=False), F.col("action"))


@query(_chunk_sql(60, "z", "WHERE n >= 60"))
def chunk_short_60(spark, sf_dir):
    return _weighted(ep.add_chunk(_deltas(spark, sf_dir), 60, padding="last", pad_short=False, flat=False), F.col("action"))


@query(f"{_BASE} SELECT dataset, episode_id, CAST(count(*) AS BIGINT) AS frames, 'fewer than 60 frames' AS error FROM del WHERE dim = 0 GROUP BY ALL HAVING count(*) < 60")
def short_episodes(spark, sf_dir):
    return ep.short_episodes(_deltas(spark, sf_dir), 60)


def _cumulative_sql(pad: str) -> str:
    return f"""{_BASE}, c AS (
  SELECT episode_id, frame_index, dim, list(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS l,
         last_value(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM del
), p AS (SELECT episode_id, frame_index, dim, list_transform(range(8), lambda k: coalesce(l[k + 1], {pad})) AS p FROM c)
SELECT episode_id, frame_index, dim,
       round(list_sum(list_transform(range(8), lambda k: (k + 1) * CASE WHEN dim = 3 THEN p[k + 1] ELSE list_sum(p[1:k + 1]) END)), 6) + 0.0 AS value FROM p"""


@query(_cumulative_sql("z"))
def chunk_cumulative_8(spark, sf_dir):
    return _weighted(ep.add_cumulative_chunk(_deltas(spark, sf_dir), 8, gripper=NON_DELTA), vec.unflatten(F.col("action"), 4))


@query(_cumulative_sql(_ZERO))
def chunk_cumulative_zero_8(spark, sf_dir):
    return _weighted(ep.add_cumulative_chunk(_deltas(spark, sf_dir), 8, padding="zero", gripper=NON_DELTA), vec.unflatten(F.col("action"), 4))


@query(f"""WITH {_EV} SELECT episode_id, frame_index, 32 AS size, round(s0 + 2 * s1 + 3 * s2 + 4 * s3, 6) + 0.0 AS value FROM ev""")
def pad_state_32(spark, sf_dir):
    df = event_frames(spark, sf_dir).withColumn("p", vec.pad_right(F.col("state"), 32))
    total = F.aggregate(F.transform("p", lambda x, i: (i + 1) * x), F.lit(0.0), lambda a, x: a + x)
    return df.select("episode_id", "frame_index", F.size("p").alias("size"), _r(total).alias("value"))


# Statistics.


@query(f"{_BASE}, {_STAT} SELECT dataset, dim, n, round(lo, 6) + 0.0 AS min, round(hi, 6) + 0.0 AS max FROM stat")
def stats_minmax(spark, sf_dir):
    return _dataset_stats(spark, sf_dir).select("dataset", "dim", "n", _r(F.col("min")).alias("min"), _r(F.col("max")).alias("max"))


@query(f"{_BASE}, {_STAT} SELECT dataset, dim, round(q01, 6) + 0.0 AS q01, round(q99, 6) + 0.0 AS q99 FROM stat")
def stats_q01_q99(spark, sf_dir):
    return _dataset_stats(spark, sf_dir).select("dataset", "dim", _r(F.col("q01")).alias("q01"), _r(F.col("q99")).alias("q99"))


@query(f"{_BASE}, {_STAT} SELECT dataset, dim, round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std FROM stat")
def stats_mean_std(spark, sf_dir):
    return _dataset_stats(spark, sf_dir).select("dataset", "dim", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"))


@query(f"{_BASE}, {_STAT} SELECT dim, round(min(q01), 6) + 0.0 AS q01, round(max(q99), 6) + 0.0 AS q99, round(min(lo), 6) + 0.0 AS min, round(max(hi), 6) + 0.0 AS max FROM stat GROUP BY dim")
def stats_merge_default(spark, sf_dir):
    merged = stats.merge_stats(_dataset_stats(spark, sf_dir))
    return merged.select("dim", *(_r(F.col(c)).alias(c) for c in ("q01", "q99", "min", "max")))


@query(f"""{_BASE}, {_STAT} SELECT s.dim, round(avg(mean), 6) + 0.0 AS mean, round(avg(std), 6) + 0.0 AS std,
       round(any_value(p.m), 6) + 0.0 AS pooled_mean, round(any_value(p.s), 6) + 0.0 AS pooled_std
FROM stat s JOIN (SELECT dim, avg(a) AS m, stddev_pop(a) AS s FROM del GROUP BY dim) p ON s.dim = p.dim GROUP BY s.dim""")
def stats_merge_mean(spark, sf_dir):
    merged = stats.merge_stats(_dataset_stats(spark, sf_dir))
    return merged.select("dim", *(_r(F.col(c)).alias(c) for c in ("mean", "std", "pooled_mean", "pooled_std")))


@query(f"""{_BASE}, c AS (
  SELECT dataset, dim, coalesce(l[k], z) AS a FROM (
    SELECT dataset, dim, list(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS l,
           last_value(a) OVER (PARTITION BY episode_id, dim ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM del
  ), (SELECT unnest(range(1, 5)) AS k)
) SELECT dataset, dim, count(*) AS n, round(avg(a), 6) + 0.0 AS mean, round(max(a), 6) + 0.0 AS max FROM c GROUP BY ALL""")
def stats_of_chunks(spark, sf_dir):
    chunks = ep.add_chunk(_deltas(spark, sf_dir), 4, flat=False)
    return stats.dimension_stats(chunks, "action", exact=True).select("dataset", "dim", "n", _r(F.col("mean")).alias("mean"), _r(F.col("max")).alias("max"))


def _level_stats(spark, sf_dir) -> DataFrame:
    """Statistics at three levels: (ds0, one prompt), ds0 and ds1 as a whole, all."""
    deltas = _deltas(spark, sf_dir)
    columns = ["min", "max"]
    vectors = lambda by, rows: stats.as_vectors(stats.dimension_stats(rows, "action", by, exact=True), by, columns)
    prompts = vectors(["dataset", "prompt"], deltas.where("dataset = 'ds0'")).where("prompt = 'handle view'")
    sets = vectors(["dataset"], deltas.where("dataset in ('ds0', 'ds1')")).withColumn("prompt", F.lit(None).cast("string"))
    everything = vectors(["one"], deltas.withColumn("one", F.lit(1))).select(F.lit(None).cast("string").alias("dataset"), F.lit(None).cast("string").alias("prompt"), *columns)
    return prompts.unionByName(sets).unionByName(everything)


@query(f"""{_BASE}, e AS (SELECT DISTINCT dataset, episode_id, first_type FROM del),
p AS (SELECT dataset, first_type, min(a) AS lo, max(a) AS hi FROM del WHERE dim = 0 AND dataset = 'ds0' AND first_type = 'view' GROUP BY ALL),
d AS (SELECT dataset, min(a) AS lo, max(a) AS hi FROM del WHERE dim = 0 AND dataset IN ('ds0', 'ds1') GROUP BY ALL),
g AS (SELECT min(a) AS lo, max(a) AS hi FROM del WHERE dim = 0)
SELECT e.episode_id, round(coalesce(p.lo, d.lo, g.lo), 6) + 0.0 AS min, round(coalesce(p.hi, d.hi, g.hi), 6) + 0.0 AS max
FROM e LEFT JOIN p ON e.dataset = p.dataset AND e.first_type = p.first_type LEFT JOIN d ON e.dataset = d.dataset CROSS JOIN g""")
def stats_fallback_join(spark, sf_dir):
    episodes = _deltas(spark, sf_dir).select("dataset", "episode_id", "prompt").distinct()
    found = stats.lookup_stats(episodes, _level_stats(spark, sf_dir))
    return found.select("episode_id", _r(F.get("min", F.lit(0))).alias("min"), _r(F.get("max", F.lit(0))).alias("max"))


# Normalising.


def _with_vectors(spark, sf_dir) -> DataFrame:
    table = stats.as_vectors(_dataset_stats(spark, sf_dir), ["dataset"])
    return _deltas(spark, sf_dir).join(F.broadcast(table), "dataset")  # a row per dataset




def _joined(value: str) -> str:
    return f"{_BASE}, {_STAT} SELECT episode_id, frame_index, d.dim, {value} AS value FROM del d JOIN stat t ON d.dataset = t.dataset AND d.dim = t.dim"


_SCALED = "((least(greatest(a, lo), hi) - lo) / (hi - lo + 1e-8) * 2 - 1)"
_BINS = f"CAST(least(greatest(round_even(({_SCALED} + 1) / 2 * 254, 0)::DOUBLE, 0), 254) AS INTEGER)"


@query(_joined("round(CAST((a - mean) / (std + 1e-6) AS FLOAT), 3) + 0.0"))
def zscore(spark, sf_dir):
    df = _with_vectors(spark, sf_dir).withColumn("z", vec.zscore(F.col("action"), F.col("mean"), F.col("std")))
    rows = df.select("episode_id", "frame_index", F.posexplode("z").alias("dim", "x"))
    return rows.select("episode_id", "frame_index", "dim", (F.round("x", 3) + F.lit(0.0).cast("float")).alias("value"))


@query(f"{_BASE} {_OUT} del")
def zscore_roundtrip(spark, sf_dir):
    df = _with_vectors(spark, sf_dir)
    scaled = F.zip_with(F.zip_with("action", "mean", lambda x, m: x - m), "std", lambda x, s: x / (s + vec.EPS_Z))  # in double, so that it returns
    return _long(df.withColumn("action", vec.zscore_inverse(scaled, F.col("mean"), F.col("std"))))


@query(_joined(f"round({_SCALED}, 6) + 0.0"))
def minmax_norm(spark, sf_dir):
    return _long(_with_vectors(spark, sf_dir).withColumn("action", vec.minmax(F.col("action"), F.col("min"), F.col("max"))))


@query(_joined(f"round(lo + (least(greatest({_SCALED} * 1.1, -1), 1) + 1) * 0.5 * (hi - lo), 5) + 0.0"))
def minmax_denorm(spark, sf_dir):
    df = _with_vectors(spark, sf_dir)
    wider = F.transform(vec.minmax(F.col("action"), F.col("min"), F.col("max")), lambda x: x * 1.1)
    rows = df.withColumn("b", vec.minmax_inverse(wider, F.col("min"), F.col("max"))).select("episode_id", "frame_index", F.posexplode("b").alias("dim", "x"))
    return rows.select("episode_id", "frame_index", "dim", (F.round("x", 5) + 0.0).alias("value"))


@query(_joined(_BINS))
def quantize_bins(spark, sf_dir):
    df = _with_vectors(spark, sf_dir).withColumn("q", vec.quantize(vec.minmax(F.col("action"), F.col("min"), F.col("max"))))
    return df.select("episode_id", "frame_index", F.posexplode("q").alias("dim", "value"))


_TEXT = f"""{_BASE}, {_STAT}, txt AS (
  SELECT d.episode_id, d.frame_index, string_agg(' ' || CAST({_BINS} AS VARCHAR), '' ORDER BY d.dim) AS answer
  FROM del d JOIN stat t ON d.dataset = t.dataset AND d.dim = t.dim GROUP BY ALL
)"""


@query(f"{_TEXT} SELECT episode_id, frame_index, answer FROM txt")
def action_string(spark, sf_dir):
    deltas = _deltas(spark, sf_dir)
    table = stats.as_vectors(stats.dimension_stats(deltas, "action", exact=True), ["dataset"], ["min", "max"]).withColumn("prompt", F.lit(None).cast("string"))
    return normalise_to_text(deltas, table).select("episode_id", "frame_index", "answer")


@query(f"""{_TEXT} SELECT episode_id, frame_index, CAST(k - 1 AS INTEGER) AS dim,
  round(CAST(regexp_extract_all(answer, '[0-9]+')[k] AS DOUBLE) / 254 * 2 - 1, 6) + 0.0 AS value FROM txt, (SELECT unnest(range(1, 5)) AS k)""")
def string_to_action(spark, sf_dir):
    return _long(action_string(spark, sf_dir).withColumn("action", vec.text_to_action(F.col("answer"), 255, 4)))


@query(f"""{_BASE}, {_STAT}, g AS (SELECT dim, min(lo) AS lo, max(hi) AS hi FROM stat GROUP BY dim), t AS (
  SELECT episode_id, frame_index, string_agg(' ' || CAST({_BINS} AS VARCHAR), '' ORDER BY d.dim) AS answer, any_value(first_type) AS first_type FROM del d JOIN g ON d.dim = g.dim GROUP BY ALL
) SELECT episode_id, frame_index, '<image>' || chr(10) || 'What action should the robot take to handle ' || first_type || '?' AS prompt, answer FROM t""")
def default_plan(spark, sf_dir):
    frames = event_frames(spark, sf_dir).withColumn("is_robot", F.col("frame_index") == 0)
    merged = stats.merge_stats(_dataset_stats(spark, sf_dir)).withColumn("one", F.lit(1))
    table = stats.as_vectors(merged, ["one"], ["min", "max"]).select(F.lit(None).cast("string").alias("dataset"), F.lit(None).cast("string").alias("prompt"), "min", "max")
    plan = ActionPlan.of(statistics=table, delta=True, non_delta=NON_DELTA, periodic=PERIODIC)
    return plan.pipeline()(frames).select("episode_id", "frame_index", "prompt", "answer")


@query(f"{_BASE} SELECT episode_id, frame_index, dim, CASE WHEN dim = 3 THEN CAST(a > 0 AS INTEGER)::DOUBLE ELSE round(a, 6) + 0.0 END AS value FROM del")
def binarize_gripper(spark, sf_dir):
    return _long(_deltas(spark, sf_dir).withColumn("action", vec.binarize_last(F.col("action"))))


# Episodes as groups, islands, folds.


@query(f"WITH {_EV} SELECT dataset, episode_id, count(*) AS frames, CAST(sum(frame_index) AS BIGINT) AS total FROM ev GROUP BY ALL")
def episode_counts(spark, sf_dir):
    frames = event_frames(spark, sf_dir).select("dataset", "episode_id", "frame_index")
    lists = frames.groupBy("dataset", "episode_id").agg(F.array_sort(F.collect_list("frame_index")).alias("f"))
    total = F.aggregate("f", F.lit(0).cast("long"), lambda a, x: a + x)
    return lists.select("dataset", "episode_id", F.size("f").cast("long").alias("frames"), total.alias("total"))


@query(f"WITH {_EV} SELECT episode_id, frame_index FROM ev WHERE frame_index < n - 16")
def tail_trim(spark, sf_dir):
    return ep.trim_tail(event_frames(spark, sf_dir), 16).select("episode_id", "frame_index")


@query(f"""{_BASE} {_OUT} del WHERE frame_index BETWEEN 10 AND 19""")
def frame_pushdown(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    part, lengths = ep.frame_range(frames.select("dataset", "episode_id", "frame_index", "state"), 10, 19, reach=1)
    rows = part.join(lengths, ["dataset", "episode_id"])
    later = rows.withColumn("action", F.lead("state").over(ep.EPISODES.ordered)).where((F.col("frame_index") < F.col("n") - 1) & F.col("frame_index").between(10, 19))
    return _long(ep.delta_action(later, NON_DELTA, PERIODIC))


@query("""SELECT event_id, user_id, run, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1 AS INTEGER) AS step FROM (
  SELECT *, CAST(sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS run FROM (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 0
                   WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS chg FROM events))""")
def text_sessions(spark, sf_dir):
    return ep.label_islands(_t(spark, sf_dir, "events"), "event_type", ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "run", "step")


@query("""SELECT event_id, CAST(sum(CAST(event_type = 'purchase' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS BIGINT) AS position FROM events""")
def running_positions(spark, sf_dir):
    events = _t(spark, sf_dir, "events").withColumn("m", (F.col("event_type") == "purchase").cast("int"))
    return ep.running_positions(events, "m", ["user_id"], ["ts", "event_id"]).select("event_id", "position")


@query("""SELECT event_id, before, value FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE value < before""")
def order_violations(spark, sf_dir):
    return ep.order_violations(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "before", "value")


@query("""WITH e AS (SELECT label, vec_id, embedding::DOUBLE[] AS v, lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM embeddings)
SELECT label, vec_id, round(list_cosine_similarity(v, b), 6) + 0.0 AS similarity FROM e""")
def adjacent_cosine(spark, sf_dir):
    rows = _t(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return ep.adjacent_similarity(rows, "v", ["label"], ["vec_id"]).select("label", "vec_id", _r(F.col("similarity")).alias("similarity"))


def _bank_rows(spark, sf_dir) -> DataFrame:
    rows = _t(spark, sf_dir, "embeddings")
    return rows.select(F.lit("cog").alias("role"), F.col("label").cast("string").alias("episode"), F.col("vec_id").cast("double").alias("timestep"), F.col("embedding").cast("array<double>").alias("feat"))


@query("""WITH RECURSIVE src AS (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k, CAST(vec_id AS DOUBLE) AS t, embedding::DOUBLE[] AS v FROM embeddings
), fold(label, k, bank) AS (
  SELECT label, 1::BIGINT, [{'t': t, 'v': v}] FROM src WHERE k = 1
  UNION ALL
  SELECT label, k, CASE WHEN len(l) <= 6 THEN l ELSE list_concat(l[1:p - 1], [{'t': (l[p].t + l[p + 1].t) / 2, 'v': list_transform(range(1, 65), lambda j: (l[p].v[j] + l[p + 1].v[j]) / 2)}], l[p + 2:]) END
  FROM (SELECT label, k, l, list_position(sims, list_max(sims)) AS p FROM (
    SELECT label, k, l, list_transform(range(1, len(l)), lambda i: list_cosine_similarity(l[i].v, l[i + 1].v)) AS sims FROM (
      SELECT s.label, s.k, list_append(f.bank, {'t': s.t, 'v': s.v}) AS l FROM fold f JOIN src s ON s.label = f.label AND s.k = f.k + 1)))
), ended AS (SELECT f.label, f.bank FROM fold f JOIN (SELECT label, max(k) AS k FROM src GROUP BY label) m ON f.label = m.label AND f.k = m.k)
SELECT CAST(label AS VARCHAR) AS episode, CAST(i - 1 AS INTEGER) AS place, CAST(k - 1 AS INTEGER) AS dim, round(bank[i].t, 6) + 0.0 AS t, round(bank[i].v[k], 6) + 0.0 AS value
FROM (SELECT label, bank, unnest(range(1, len(bank) + 1)) AS i FROM ended), (SELECT unnest(range(1, 65)) AS k)""")
def bank_merge_whole(spark, sf_dir):
    banks = memory.bank_merge(_bank_rows(spark, sf_dir), 6)
    rows = banks.select("episode", F.posexplode("bank").alias("place", "e")).select("episode", "place", _r(F.col("e.t")).alias("t"), F.posexplode("e.v").alias("dim", "x"))
    return rows.select("episode", "place", "dim", "t", _r(F.col("x")).alias("value"))


@query("""WITH e AS (SELECT label, vec_id, list(CAST(vec_id AS DOUBLE)) OVER w AS t, list(embedding::DOUBLE[]) OVER w AS x FROM embeddings
  WINDOW w AS (PARTITION BY label ORDER BY vec_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW))
SELECT CAST(label AS VARCHAR) AS episode, CAST(vec_id AS DOUBLE) AS timestep, CAST(len(t) AS INTEGER) AS size, t[1] AS oldest, CAST(k - 1 AS INTEGER) AS dim,
       round(list_sum(list_transform(x, lambda v: v[k])), 6) + 0.0 AS value FROM e, (SELECT unnest(range(1, 65)) AS k)""")
def bank_fifo_whole(spark, sf_dir):
    banks = memory.bank_fifo(_bank_rows(spark, sf_dir), 16)
    totals = F.transform("feat", lambda x, i: F.aggregate("bank", F.lit(0.0), lambda a, e: a + F.get(e["v"], i)))
    rows = banks.select("episode", "timestep", F.size("bank").alias("size"), F.get("bank", F.lit(0))["t"].alias("oldest"), F.posexplode(totals).alias("dim", "x"))
    return rows.select("episode", "timestep", "size", "oldest", "dim", _r(F.col("x")).alias("value"))


@query(f"""WITH RECURSIVE {_EV}, w(episode_id, frame_index, x0, x2, x3) AS (
  SELECT episode_id, frame_index, s0 + 0.5 * s0, CASE WHEN s2 + 0.5 * s2 > pi() THEN s2 + 0.5 * s2 - 2 * pi() WHEN s2 + 0.5 * s2 < -pi() THEN s2 + 0.5 * s2 + 2 * pi() ELSE s2 + 0.5 * s2 END, 0.5 * s3 FROM ev WHERE frame_index = 0
  UNION ALL
  SELECT e.episode_id, e.frame_index, w.x0 + 0.5 * e.s0, CASE WHEN w.x2 + 0.5 * e.s2 > pi() THEN w.x2 + 0.5 * e.s2 - 2 * pi() WHEN w.x2 + 0.5 * e.s2 < -pi() THEN w.x2 + 0.5 * e.s2 + 2 * pi() ELSE w.x2 + 0.5 * e.s2 END, 0.5 * e.s3
  FROM w JOIN ev e ON e.episode_id = w.episode_id AND e.frame_index = w.frame_index + 1
) SELECT episode_id, frame_index, round(x0, 6) + 0.0 AS x0, round(x2, 6) + 0.0 AS x2, round(x3, 6) + 0.0 AS x3 FROM w""")
def client_integrate(spark, sf_dir):
    frames = event_frames(spark, sf_dir).withColumn("action", F.transform("state", lambda x: 0.5 * x))
    path = ep.integrate(frames, F.col("state"), hold=(3,), angles=(2,))
    return path.select("episode_id", "frame_index", *(_r(F.get("action", F.lit(i))).alias(f"x{i}") for i in (0, 2, 3)))


@query("""WITH e AS (SELECT event_id, user_id, ts, sum(CAST(event_type = 'signup' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS episode FROM events)
SELECT event_id, CAST(episode AS BIGINT) AS episode, CAST(row_number() OVER (PARTITION BY user_id, episode ORDER BY ts, event_id) - 1 AS INTEGER) AS clock FROM e""")
def call_clock(spark, sf_dir):
    calls = _t(spark, sf_dir, "events").withColumn("first", F.when(F.col("event_type") == "signup", "True").otherwise("False"))
    return memory.call_clock(calls, "first", ["user_id"], ["ts", "event_id"]).select("event_id", "episode", "clock")


@query(f"""WITH {_EV} SELECT episode_id, frame_index, CAST(k AS INTEGER) AS step, round(CASE k WHEN 0 THEN s0 WHEN 1 THEN s1 WHEN 2 THEN s2 ELSE s3 END, 6) + 0.0 AS value FROM ev, (SELECT unnest(range(4)) AS k)""")
def queue_actions_whole(spark, sf_dir):
    rows = event_frames(spark, sf_dir).withColumn("chunk", vec.unflatten(F.col("state"), 1))
    return memory.queue_actions(rows, "chunk", ["episode_id", "frame_index"]).select("episode_id", "frame_index", "step", _r(F.get("action", F.lit(0))).alias("value"))


# Mixtures, sampling, schedules, collation.


@query("""SELECT source_table, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM (
  SELECT 'documents' AS source_table, text FROM documents UNION ALL SELECT 'benchmark', text FROM benchmark UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY 1""")
def mixture_union(spark, sf_dir):
    part = lambda name: _t(spark, sf_dir, name).withColumn("source_table", F.lit(name))
    mixed = catalog.mix([part("documents"), part("benchmark"), part("benchmark")])
    return mixed.groupBy("source_table").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("""WITH f AS (SELECT DISTINCT user_id % 3 AS d, user_id, (ARRAY[0.3, 1.5, 2.0])[user_id % 3 + 1]::DOUBLE AS f FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY md5('7|' || CAST(user_id AS VARCHAR)), user_id) AS rk, count(*) OVER (PARTITION BY d) AS n FROM f),
c AS (SELECT *, CAST(floor(f) AS INTEGER) + CASE WHEN rk <= ceil(round(n * (f - floor(f)), 9)) THEN 1 ELSE 0 END AS copies FROM r)
SELECT user_id, CAST(unnest(range(copies)) AS INTEGER) AS copy_id FROM c""")
def oversample(spark, sf_dir):
    files = _t(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("d"), "user_id").distinct()
    frequency = F.when(F.col("d") == 0, 0.3).when(F.col("d") == 1, 1.5).otherwise(2.0)
    return sampling.oversample(files, frequency, ["d"], "user_id", seed=7).select("user_id", "copy_id")


@query("""WITH u AS (SELECT DISTINCT 'ds' || CAST(user_id % 3 AS VARCHAR) AS dataset, user_id FROM events),
p AS (SELECT *, row_number() OVER (ORDER BY md5('5|' || dataset || '|' || CAST(user_id AS VARCHAR)), dataset, user_id) - 1 AS place FROM u)
SELECT e.event_id FROM events e JOIN p USING (user_id) WHERE place % 4 = 1""")
def rank_shard(spark, sf_dir):
    events = _t(spark, sf_dir, "events").withColumn("dataset", F.concat(F.lit("ds"), (F.col("user_id") % 3).cast("string")))
    return sampling.shard(events, 1, 4, ["dataset", "user_id"], seed=5).select("event_id")


@query(f"""WITH {_EV} SELECT episode_id, frame_index, CASE WHEN frame_index < n - 16 THEN frame_index ELSE CAST(('0x' || substr(md5('3|' || CAST(episode_id AS VARCHAR) || '|' || CAST(frame_index AS VARCHAR)), 1, 12))::BIGINT % (n - 16) AS BIGINT) END AS picked FROM ev""")
def tail_replacement(spark, sf_dir):
    frames = event_frames(spark, sf_dir)
    n = ep.EPISODES.length()
    return frames.select("episode_id", "frame_index", sampling.tail_frame(F.col("frame_index"), n, 16, 3, F.col("episode_id")).alias("picked"))


_HASH = "CAST('0x' || substr(md5({0}), 1, 12) AS BIGINT)"


@query(f"""WITH RECURSIVE {_EV}, u AS (SELECT dataset, episode_id, any_value(n) AS n FROM ev GROUP BY ALL),
p AS (SELECT *, row_number() OVER (ORDER BY md5('4|' || dataset || '|' || CAST(episode_id AS VARCHAR)), dataset, episode_id) - 1 AS place FROM u),
own AS (SELECT dataset, episode_id, n, place // 2 AS e FROM p WHERE place % 2 = 0), t AS (SELECT count(*) AS k, sum(n) AS total FROM own),
fe(batch, i, k, got) AS (
  SELECT CAST(unnest(range(greatest(1, total // 64)::BIGINT)) AS BIGINT), 0::BIGINT, k, []::BIGINT[] FROM t
  UNION ALL SELECT batch, i + 1, k, list_append(got, CASE WHEN list_contains(got, d) THEN k - 8 + i ELSE d END) FROM (
    SELECT *, {_HASH.format("'4|e|' || CAST(batch AS VARCHAR) || '|' || CAST(i AS VARCHAR)")} % (k - 8 + i + 1) AS d FROM fe WHERE i < 8)
), picked AS (SELECT batch, CAST(slot AS INTEGER) AS slot, got[slot + 1] AS e FROM fe, (SELECT unnest(range(8)) AS slot) WHERE i = 8),
chosen AS (SELECT batch, slot, dataset, episode_id, n FROM picked JOIN own USING (e)),
ff(batch, slot, dataset, episode_id, n, i, got) AS (
  SELECT batch, slot, dataset, episode_id, n, 0::BIGINT, []::BIGINT[] FROM chosen WHERE n > 8
  UNION ALL SELECT batch, slot, dataset, episode_id, n, i + 1, list_append(got, CASE WHEN list_contains(got, d) THEN n - 8 + i ELSE d END) FROM (
    SELECT *, {_HASH.format("'4|f|' || CAST(batch AS VARCHAR) || '|' || CAST(slot AS VARCHAR) || '|' || CAST(i AS VARCHAR)")} % (n - 8 + i + 1) AS d FROM ff WHERE i < 8)
)
SELECT batch, slot, dataset, episode_id, CAST(pos AS INTEGER) AS pos, CAST(list_sort(got)[pos + 1] AS INTEGER) AS frame_index FROM ff, (SELECT unnest(range(8)) AS pos) WHERE i = 8
UNION ALL SELECT batch, slot, dataset, episode_id, CAST(pos AS INTEGER), CAST(least(pos, n - 1) AS INTEGER) FROM chosen, (SELECT unnest(range(8)) AS pos) WHERE n <= 8""")
def group_schedule(spark, sf_dir):
    frames = event_frames(spark, sf_dir).select("dataset", "episode_id", "frame_index")
    return sampling.group_schedule(frames, 64, 8, rank=0, world=2, seed=1, epoch=3)


@query(f"""WITH {_EV}, u AS (SELECT dataset, episode_id, any_value(n) AS n FROM ev GROUP BY ALL),
p AS (SELECT *, row_number() OVER (ORDER BY md5('2|' || dataset || '|' || CAST(episode_id AS VARCHAR)), dataset, episode_id) - 1 AS place FROM u),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base, sum(n) OVER () AS total FROM p)
SELECT CAST((base + frame_index) // 32 AS BIGINT) AS batch, CAST((base + frame_index) % 32 AS INTEGER) AS slot, dataset, episode_id, frame_index
FROM ev JOIN b USING (dataset, episode_id) WHERE (base + frame_index) // 32 < total // 32""")
def stream_schedule(spark, sf_dir):
    frames = event_frames(spark, sf_dir).select("dataset", "episode_id", "frame_index")
    return sampling.stream_schedule(frames, 32, seed=2)


@query("""WITH c AS (SELECT conv_id AS batch, turn, list_transform(string_split_regex(trim(text), '\\s+'), lambda w: length(w)) AS ids FROM conversations),
n AS (SELECT *, least(max(len(ids)) OVER (PARTITION BY batch), 40) AS m FROM c)
SELECT batch, turn, CAST(m AS INTEGER) AS padded, CAST(least(len(ids), m) AS INTEGER) AS attended, CAST(list_sum(ids[1:m]) AS BIGINT) AS total,
       CAST(list_sum(ids[1:m]) - 100 * greatest(m - len(ids), 0) AS BIGINT) AS label_total FROM n""")
def pad_collate(spark, sf_dir):
    words = F.split(F.trim("text"), r"\s+")
    rows = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("batch"), "turn", F.transform(words, lambda w: F.length(w)).alias("input_ids")).withColumn("labels", F.col("input_ids"))
    out = batching.collate(rows, order=["turn"], max_length=40)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("batch", "turn", F.size("input_ids").alias("padded"), total("attention_mask").cast("int").alias("attended"), total("input_ids").alias("total"), total("labels").alias("label_total"))


@query("""SELECT conv_id AS batch, CAST(count(*) AS INTEGER) AS rows, string_agg(role, ',' ORDER BY turn) AS roles, count(DISTINCT len(string_split(text, ' '))) <= 1 AS words_uniform FROM conversations GROUP BY conv_id""")
def stack_batches(spark, sf_dir):
    rows = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("batch"), "turn", "role", F.split("text", " ").alias("word"))
    out = batching.stack(rows, ["role", "word"], order=["turn"], names={"role": "roles", "word": "words"})
    return out.select("batch", F.size("roles").alias("rows"), F.array_join("roles", ",").alias("roles"), "words_uniform")


# Text.


@query("""SELECT item_id, '<image>' || chr(10) || 'What action should the robot take to ' || text || '?' AS prompt FROM benchmark""")
def prompt_template(spark, sf_dir):
    return _t(spark, sf_dir, "benchmark").select("item_id", text.fill_prompt(F.col("text")).alias("prompt"))


@query("""SELECT doc_id, 'human|' || coalesce(lang, '') || '|gpt|' || coalesce(source, '') AS turns FROM documents""")
def to_conversation(spark, sf_dir):
    rows = text.with_conversation(_t(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("prompt"), F.col("source").alias("answer")))
    return rows.select("doc_id", F.array_join(F.transform("conversations", lambda t: F.concat(t["from"], F.lit("|"), t["value"])), "|").alias("turns"))


_CHAT = """WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'human' ELSE 'gpt' END AS who, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE role <> 'system')"""


def _turns(spark, sf_dir) -> DataFrame:
    rows = _t(spark, sf_dir, "conversations").where("role <> 'system'")
    turn = F.struct("turn", F.when(F.col("role") == "user", "human").otherwise("gpt").alias("from"), F.col("text").alias("value"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["from"], t["value"])).alias("turns"))


@query(f"""{_CHAT} SELECT conv_id, 'A chat. ' || string_agg(CASE WHEN who = 'human' THEN 'USER' ELSE 'ASSISTANT' END || ': ' || text || CASE WHEN i % 2 = 0 THEN ' ' ELSE '</s>' END, '' ORDER BY i) AS chat FROM c GROUP BY conv_id""")
def chat_render(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", text.render_chat(F.col("turns"), "A chat.").alias("chat"))


@query(f"""{_CHAT} SELECT conv_id, string_agg(text || CASE WHEN i % 2 = 0 THEN chr(10) ELSE '##' END, '' ORDER BY i) AS chat FROM c GROUP BY conv_id""")
def chat_plain(spark, sf_dir):
    return _turns(spark, sf_dir).select("conv_id", text.render_chat(F.col("turns"), seps=("\n", "##"), plain=True).alias("chat"))


@query(f"""{_CHAT}, s AS (SELECT *, first_value(who) OVER (PARTITION BY conv_id ORDER BY i) <> 'human' AS cut FROM c)
SELECT conv_id, CAST(count(*) AS INTEGER) AS turns, bool_and((who = 'human') = ((i - CAST(cut AS INTEGER)) % 2 = 0)) AS alternates FROM s WHERE NOT (cut AND i = 0) GROUP BY conv_id""")
def chat_roles(spark, sf_dir):
    kept = _turns(spark, sf_dir).withColumn("k", text.drop_leading_answer(F.col("turns"))).where(F.size("k") > 0)
    return kept.select("conv_id", F.size("k").alias("turns"), text.alternates(F.col("k")).alias("alternates"))


@query("""WITH m AS (SELECT item_id, left(text, 20) || ' <image> ' || substr(text, 21) || '<image>' || chr(10) AS v FROM benchmark)
SELECT item_id, regexp_replace('<image>' || chr(10) || regexp_replace(replace(v, '<image>', ''), '^\\s+|\\s+$', '', 'g'), '^\\s+|\\s+$', '', 'g') AS value FROM m""")
def image_token_norm(spark, sf_dir):
    v = F.concat(F.substring("text", 1, 20), F.lit(" <image> "), F.expr("substring(text, 21)"), F.lit("<image>\n"))
    return _t(spark, sf_dir, "benchmark").select("item_id", text.image_first(v).alias("value"))


@query("""SELECT item_id, translate(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10) || '_', '  ') AS prompt FROM benchmark""")
def prompt_clean(spark, sf_dir):
    return _t(spark, sf_dir, "benchmark").select("item_id", text.clean_prompt(F.col("text")).alias("prompt"))


@query("""WITH w AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark), c AS (SELECT item_id, w, CAST(len(w) // 2 AS INTEGER) AS h FROM w)
SELECT item_id, CAST(len(w) + 1 AS INTEGER) AS size, CAST(h AS INTEGER) AS at, CAST(list_sum(list_transform(w, lambda x: length(x))) - 200 AS BIGINT) AS total FROM c""")
def image_splice(spark, sf_dir):
    w = F.split("text", " ")
    h = F.floor(F.size(w) / 2).cast("int")
    marked = F.concat(F.array_join(F.slice(w, F.lit(1), h), " "), F.lit("<image>"), F.array_join(F.slice(w, h + 1, F.size(w)), " "))
    ids = text.splice_images(marked, lambda p: F.transform(F.split(p, " "), lambda x: F.length(x)))
    rows = _t(spark, sf_dir, "benchmark").select("item_id", ids.alias("ids"))
    return rows.select("item_id", F.size("ids").alias("size"), (F.array_position("ids", F.lit(-200)) - 1).cast("int").alias("at"), F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("""WITH w AS (SELECT item_id, list_transform(string_split(text, ' '), lambda x: length(x)) AS ids FROM benchmark)
SELECT item_id, CAST(CASE WHEN item_id % 2 = 0 THEN -100 * least(3, len(ids)) + list_sum(ids[4:]) ELSE -100 * len(ids) END AS BIGINT) AS total FROM w WHERE len(ids) > 3""")
def label_mask(spark, sf_dir):
    ids = F.transform(F.split("text", " "), lambda x: F.length(x))
    rows = _t(spark, sf_dir, "benchmark").select("item_id", ids.alias("ids")).where(F.size("ids") > 3)
    rounds = F.array(F.struct((F.size("ids") + F.col("item_id") % 2).cast("int").alias("total"), F.lit(3).alias("instruction")))
    labels = text.mask_labels(F.col("ids"), rounds)
    return rows.select("item_id", F.aggregate(labels, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("""SELECT item_id, contains(text, 'ing ') OR list_transform(string_split(text, ' '), lambda x: length(x))[-1] = 5 AS stops FROM benchmark""")
def stop_words(spark, sf_dir):
    ids = F.transform(F.split("text", " "), lambda x: F.length(x))
    return _t(spark, sf_dir, "benchmark").select("item_id", text.stops(ids, F.col("text"), [[5]], ["ing "]).alias("stops"))


@query("""SELECT item_id, regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\.$', '') AS body, md5(text)[1:8] AS short FROM benchmark""")
def suffix_and_id(spark, sf_dir):
    return _t(spark, sf_dir, "benchmark").select("item_id", text.drop_suffix(F.col("text"), ".").alias("body"), vec.short_id(F.col("text")).alias("short"))


# Numerics over rows.


@query("""SELECT p_partkey, CAST(i AS INTEGER) AS i, round(CASE WHEN i < 4 THEN cos(p_size * exp(-ln(10000) * i / 4)) ELSE sin(p_size * exp(-ln(10000) * (i - 4) / 4)) END, 6) + 0.0 AS value FROM part, (SELECT unnest(range(8)) AS i)""")
def timestep_embedding(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.posexplode(numeric.timestep_embedding(F.col("p_size").cast("double"), 8)).alias("i", "x"))
    return rows.select("p_partkey", "i", _r(F.col("x")).alias("value"))


@query("""SELECT p_partkey, CAST(i AS INTEGER) AS i, round(CASE WHEN i < 3 THEN sin(2 * pi() * p_size / (4 * pow(16 / 4.0, i / 2.0))) ELSE cos(2 * pi() * p_size / (4 * pow(16 / 4.0, (i - 3) / 2.0))) END, 6) + 0.0 AS periods,
  round(CASE WHEN i < 3 THEN sin(p_size * exp(-ln(10000) * i / 2)) ELSE cos(p_size * exp(-ln(10000) * (i - 3) / 2)) END, 6) + 0.0 AS positions FROM part, (SELECT unnest(range(6)) AS i)""")
def sincos_embeddings(spark, sf_dir):
    t = F.col("p_size").cast("double")
    both = F.arrays_zip(numeric.period_embedding(t, 6, 4.0, 16.0).alias("a"), numeric.position_embedding(t, 6).alias("b"))
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.posexplode(both).alias("i", "x"))
    return rows.select("p_partkey", "i", _r(F.col("x.a")).alias("periods"), _r(F.col("x.b")).alias("positions"))


_CDF = "0.5 * (1 + tanh(sqrt(2 / pi()) * (({0}) + 0.044715 * pow({0}, 3))))"


@query(f"""WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount * 20 - 1 AS x, l_tax * 10 - 0.4 AS m, l_quantity / 50 - 1 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round({_CDF.format("x")}, 6) + 0.0 AS cdf,
       round(0.5 * (s - 1 + exp(-s) + pow(x - m, 2) * exp(-s)), 6) + 0.0 AS kl,
       round(-0.5 * pow((x - m) * exp(-s), 2) - 0.5 * ln(2 * pi()), 6) + 0.0 AS log_density,
       round(CASE WHEN x < -0.999 THEN ln(greatest({_CDF.format("exp(-s) * (x - m + 1 / 255.0)")}, 1e-12)) WHEN x > 0.999 THEN ln(greatest(1 - {_CDF.format("exp(-s) * (x - m - 1 / 255.0)")}, 1e-12))
             ELSE ln(greatest({_CDF.format("exp(-s) * (x - m + 1 / 255.0)")} - {_CDF.format("exp(-s) * (x - m - 1 / 255.0)")}, 1e-12)) END, 4) + 0.0 AS log_bin FROM p""")
def gaussian_densities(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").withColumns({"x": F.col("l_discount") * 20 - 1, "m": F.col("l_tax") * 10 - 0.4, "s": F.col("l_quantity") / 50 - 1})
    x, m, s = F.col("x"), F.col("m"), F.col("s")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", _r(numeric.normal_cdf(x)).alias("cdf"), _r(numeric.normal_kl(x, F.lit(0.0), m, s)).alias("kl"),
        _r(numeric.normal_log_density(x, m, s)).alias("log_density"), (F.round(numeric.discretized_log_density(x, m, s), 4) + 0.0).alias("log_bin"),
    )


@query("""WITH t AS (SELECT unnest(range(100)) AS t)
SELECT 'linear' AS kind, t, round(0.001 + (0.2 - 0.001) * t / 99, 9) AS beta FROM t
UNION ALL SELECT 'quad', t, round(pow(sqrt(0.001) + (sqrt(0.2) - sqrt(0.001)) * t / 99, 2), 9) FROM t
UNION ALL SELECT 'const', t, 0.2 FROM t UNION ALL SELECT 'jsd', t, round(1.0 / (100 - t), 9) FROM t
UNION ALL SELECT 'warmup10', t, round(CASE WHEN t < 10 THEN 0.001 + (0.2 - 0.001) * t / 9 ELSE 0.2 END, 9) FROM t
UNION ALL SELECT 'squaredcos_cap_v2', t, round(least(1 - pow(cos(((t + 1) / 100.0 + 0.008) / 1.008 * pi() / 2), 2) / pow(cos((t / 100.0 + 0.008) / 1.008 * pi() / 2), 2), 0.999), 9) FROM t""")
def beta_schedules(spark, sf_dir):
    parts = []
    for kind in ("linear", "quad", "const", "jsd", "warmup10", "squaredcos_cap_v2"):
        bounds = (None, None) if kind in ("linear", "squaredcos_cap_v2", "jsd") else (0.001, 0.2)
        parts.append(numeric.beta_schedule(spark, kind, 100, *bounds).select(F.lit(kind).alias("kind"), "t", F.round("beta", 9).alias("beta")))
    return catalog.mix(parts)


@query("""SELECT i, 20 * i AS t FROM (SELECT unnest(range(50)) AS i)""")
def strided_timesteps(spark, sf_dir):
    return numeric.timestep_table(spark, 1000, "ddim50")


@query("""WITH e AS (SELECT vec_id, CAST(embedding[i + 1] AS DOUBLE) AS a, CAST(embedding[i + 33] AS DOUBLE) AS b, i FROM embeddings, (SELECT unnest(range(32)) AS i))
SELECT vec_id, CAST(i AS INTEGER) AS dim, round(0.25 * a + 0.75 * b, 6) + 0.0 AS lerp, round(a + 1.5 * (b - a), 6) + 0.0 AS guided, round((a + b) / 2, 6) + 0.0 AS mid,
       round(0.5 * a + 0.5 * b, 6) + 0.0 AS gated, round(a - b, 6) + 0.0 AS target, round(a * pow(0.9, 10), 6) + 0.0 AS integrated FROM e""")
def vector_blends_whole(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    a, b = F.slice(v, 1, 32), F.slice(v, 33, 32)
    made = F.arrays_zip(
        vec.lerp(0.25, a, b).alias("lerp"), vec.guidance(a, b, 1.5).alias("guided"), vec.midpoint(a, b).alias("mid"), vec.gate_blend(F.array_repeat(F.lit(0.5), 32), a, b).alias("gated"),
        vec.flow_target(a, b).alias("target"), vec.euler(a, lambda x, t: x, 10).alias("integrated"),
    )
    rows = _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(made).alias("dim", "x"))
    return rows.select("vec_id", "dim", *(_r(F.col(f"x.{c}")).alias(c) for c in ("lerp", "guided", "mid", "gated", "target", "integrated")))


@query("""SELECT l_returnflag, round(sum(l_quantity * CAST(l_linestatus = 'O' AS INTEGER)) / greatest(sum(CAST(l_linestatus = 'O' AS INTEGER)), 1), 6) AS masked,
  round(avg(CASE WHEN l_discount - 0.05 < 0 THEN 0.9 ELSE 0.1 END * pow(l_discount - 0.05, 2)), 9) AS expectile, round(avg(l_tax * (1 + 1 / (1 + exp(-l_discount)))), 6) AS rewarded FROM lineitem GROUP BY 1""")
def weighted_losses(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").withColumn("m", (F.col("l_linestatus") == "O").cast("double"))
    return rows.groupBy("l_returnflag").agg(
        F.round(stats.masked_mean(F.col("l_quantity"), F.col("m")), 6).alias("masked"), F.round(stats.expectile_loss(F.col("l_discount") - 0.05, 0.9), 9).alias("expectile"),
        F.round(stats.reward_weighted_mean(F.col("l_tax"), F.col("l_discount")), 6).alias("rewarded"),
    )


@query("""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS argmax, CAST(coalesce(list_max(list_filter(range(64), lambda i: embedding[i + 1] > 0.1)), 0) AS INTEGER) AS last_set, true AS finite FROM embeddings""")
def argmax_and_masks(spark, sf_dir):
    v = F.col("embedding")
    mask = F.transform(v, lambda x: (x > 0.1).cast("int"))
    return _t(spark, sf_dir, "embeddings").select("vec_id", stats.argmax(v).alias("argmax"), stats.last_unmasked(mask).alias("last_set"), vec.all_finite(vec.require_finite(v.cast("array<double>"))).alias("finite"))


# Media references.


@query("""WITH v AS (SELECT page_id, page_id % 3 AS k, url FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS place, 'images_' || CAST(CASE WHEN i = 0 THEN 1 WHEN i = 1 THEN 10 ELSE 2 END AS VARCHAR) AS view, '/data/' || CAST(CASE WHEN i = 0 THEN 1 WHEN i = 1 THEN 10 ELSE 2 END AS VARCHAR) || '.mp4' AS path
FROM v, (SELECT unnest(range(3)) AS i) WHERE i <= k""")
def view_requests(spark, sf_dir):
    ref = lambda n, least: F.when(F.col("page_id") % 3 >= least, F.struct(F.lit("video").alias("type"), F.lit(f"{n}.mp4").alias("url"), F.lit(0).alias("frame_idx")))
    frames = _t(spark, sf_dir, "pages").select("page_id", ref(1, 0).alias("images_1"), ref(2, 2).alias("images_2"), ref(10, 1).alias("images_10"))
    wanted = media.media_requests(media.views_map(frames), ["page_id"])
    return wanted.select("page_id", "place", "view", media.join_url(F.lit("/data/"), F.col("url")).alias("path"))


@query("""WITH g AS (SELECT p_partkey, p_size * 13 AS w, p_size * 7 + 20 AS h FROM part), r AS (SELECT *, least(224.0 / w, 224.0 / h) AS r FROM g)
SELECT p_partkey, CAST(greatest(w, h) AS INTEGER) AS side, CAST(floor((greatest(w, h) - w) / 2) AS INTEGER) AS pad_left, CAST(round_even(w * r, 0) AS INTEGER) AS fit_width, CAST(floor((224 - round_even(h * r, 0)) / 2) AS INTEGER) AS fit_top FROM r""")
def image_geometry(spark, sf_dir):
    w, h = F.col("p_size") * 13, F.col("p_size") * 7 + 20
    square, fit = media.square_padding(w, h), media.fit_padding(w, h, 224, 224)
    return _t(spark, sf_dir, "part").select("p_partkey", square["side"].alias("side"), square["left"].alias("pad_left"), fit["width"].alias("fit_width"), fit["top"].alias("fit_top"))


# Relational work over the driver tables.


@query("""SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def revenue_by_nation(spark, sf_dir):
    t = lambda n: _t(spark, sf_dir, n)
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 and 5 rows at any scale
    buyers = t("customer").select("c_custkey", "c_nationkey").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    # Lines are summed per order before they meet customers.
    lines = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    sold = lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("v").alias("v"))
    return sold.join(buyers, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "n_name").agg(F.round(F.sum("v"), 2).alias("revenue"))


@query("SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def documents_left_labels(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", "lang").join(_t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("""SELECT coalesce(c.k, s.k) AS nation, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON c.k = s.k""")
def nations_full_outer(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    s = _t(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    return c.join(s, "nation", "full").select("nation", F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("suppliers", F.lit(0)).alias("suppliers"))


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders FROM customer")
def customers_semi_anti(spark, sf_dir):
    c, o = _t(spark, sf_dir, "customer").select("c_custkey"), _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_semi").withColumn("has_orders", F.lit(True)).union(c.join(o, "c_custkey", "left_anti").withColumn("has_orders", F.lit(False)))


@query("""SELECT p.event_id AS purchase, e.event_id AS other FROM events p JOIN events e ON p.user_id = e.user_id AND abs(epoch_us(e.ts) - epoch_us(p.ts)) <= 3600000000
WHERE p.event_type = 'purchase' AND e.event_type <> 'purchase'""")
def near_purchases(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    p = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("p_ts"), F.col("event_id").alias("purchase"))
    o = e.where("event_type <> 'purchase'").select("user_id", F.col("ts").alias("o_ts"), F.col("event_id").alias("other"))
    return relational.range_join(p, o, ["user_id"], "p_ts", "o_ts", 3600).select("purchase", "other")


@query("""SELECT p.event_id, s.ts AS signup_ts, s.value AS signup_value FROM events p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON p.user_id = s.user_id AND p.ts >= s.ts WHERE p.event_type = 'purchase'""")
def last_signup(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    s = e.where("event_type = 'signup'").select("user_id", "ts", F.col("ts").alias("signup_ts"), F.col("value").alias("signup_value"))
    return relational.asof_join(p, s, ["user_id"], "ts", ["signup_ts", "signup_value"]).select("event_id", "signup_ts", "signup_value")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def orders_rollup(spark, sf_dir):
    return _t(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(grouping(l_returnflag) AS INTEGER) AS g FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def lines_cube(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.grouping("l_returnflag").cast("int").alias("g"))


@query("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_mktsegment), (c_nationkey), ())")
def customers_grouping_sets(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    sets = [[F.col("c_mktsegment")], [F.col("c_nationkey")], []]
    return c.groupingSets(sets, "c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n")).select("c_mktsegment", "c_nationkey", "n")


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1 HAVING count(*) > 10")
def users_per_type(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("n")).where("n > 10").drop("n")


@query()
def users_per_type_approx(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.01).alias("users"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice, CAST(r AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3""")
def top_orders(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return relational.top_rows(o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


@query("""SELECT event_id, CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense, CAST(ntile(4) OVER x AS INTEGER) AS quarter, lag(value) OVER x AS before, lead(value) OVER x AS after, nth_value(value, 2) OVER x AS second,
  round(percent_rank() OVER w, 6) AS percent, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS moving
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_type), x AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def event_analytics(spark, sf_dir):
    w, x = Window.partitionBy("user_id").orderBy("event_type"), Window.partitionBy("user_id").orderBy("ts", "event_id")
    return _t(spark, sf_dir, "events").select(
        "event_id", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense"), F.ntile(4).over(x).alias("quarter"), F.lag("value").over(x).alias("before"), F.lead("value").over(x).alias("after"),
        F.nth_value("value", 2).over(x).alias("second"), F.round(F.percent_rank().over(w), 6).alias("percent"), F.round(F.avg("value").over(x.rowsBetween(-2, 2)), 6).alias("moving"),
    )


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS last_hour FROM (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events)""")
def events_last_hour(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("s").rangeBetween(-3600, 0)
    return _t(spark, sf_dir, "events").withColumn("s", F.unix_timestamp(F.date_trunc("second", "ts"))).select("event_id", F.count(F.lit(1)).over(w).alias("last_hour"))


@query("""SELECT 'union' AS op, user_id FROM (SELECT user_id FROM events WHERE event_type = 'purchase' UNION SELECT user_id FROM events WHERE event_type = 'signup')
UNION ALL SELECT 'intersect', user_id FROM (SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'signup')
UNION ALL SELECT 'except', user_id FROM (SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase')
UNION ALL SELECT 'except_all', user_id FROM (SELECT user_id FROM events WHERE event_type = 'click' EXCEPT ALL SELECT user_id FROM events WHERE event_type = 'purchase')""")
def user_sets(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    of = lambda kind: e.where(F.col("event_type") == kind).select("user_id")
    parts = {"union": of("purchase").union(of("signup")).distinct(), "intersect": of("purchase").intersect(of("signup")), "except": of("click").subtract(of("purchase")), "except_all": of("click").exceptAll(of("purchase"))}
    return catalog.mix([d.select(F.lit(k).alias("op"), "user_id") for k, d in parts.items()])


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def tumbling_counts(spark, sf_dir):
    return windowed_counts(_t(spark, sf_dir, "events"), "1 hour").select("start", "event_type", "events", F.round("total", 4).alias("total"))


@query("""SELECT time_bucket(INTERVAL '30 minutes', ts) - k * INTERVAL '30 minutes' AS start, event_type, count(*) AS events FROM events, (SELECT unnest(range(2)) AS k) GROUP BY ALL""")
def sliding_counts(spark, sf_dir):
    return windowed_counts(_t(spark, sf_dir, "events"), "1 hour", "30 minutes").select("start", "event_type", "events")


@query("""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS end, count(*) AS events FROM (
  SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, CAST(coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= 1800000000, false) AS INTEGER) AS n FROM events)) GROUP BY user_id, s""")
def event_sessions(spark, sf_dir):
    return session_counts(_t(spark, sf_dir, "events"), "30 minutes")


@query("""SELECT date_trunc('day', ts) AS day, event_type, CAST(sum(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY ALL""")
def k_by_day(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k long"))
    return e.groupBy(F.date_trunc("day", "ts").alias("day"), "event_type").agg(F.sum("p.k").alias("k"))


@query("""SELECT user_id, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id""")
def type_maps(spark, sf_dir):
    n = _t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = n.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return maps.select("user_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts"))


@query("""SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1""")
def salted_supplier_sums(spark, sf_dir):
    out = relational.salted_sum(_t(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice")
    return out.select("l_suppkey", F.round("l_extendedprice", 2).alias("total"))


#: What entry() runs and the bench reports.
FLAGSHIP = "action_string"
HEADLINE = ["action_string", "delta_action", "chunk_last_16", "chunk_cumulative_8", "stats_q01_q99", "stats_fallback_join", "text_sessions", "bank_merge_whole", "client_integrate", "group_schedule", "revenue_by_nation", "near_purchases", "last_signup", "event_sessions", "chat_render", "pad_collate"]

from plumbline.plans import file_queries  # noqa: E402,F401 - registers its queries beside these
