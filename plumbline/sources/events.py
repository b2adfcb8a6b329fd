"""The driver tables as episodes: each user's events in time order are an episode of four-dimensional states."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.episode import EPISODES, number_frames, whole_episode

#: Of these states: the dimension that stays absolute, the angle, and its range.
NON_DELTA, PERIODIC, PERIOD = (3,), (2,), 2 * math.pi


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dataset, episode_id, frame_index, state, event_type, prompt`` from the events table.

    state: the value, ``k`` of the properties, the time of day as an angle from -pi, and 1 for a purchase. The prompt
    names the episode's first event type.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    state = F.array(
        F.col("value").cast("double"),
        F.get_json_object("props", "$.k").cast("double"),
        (F.lit(2 * math.pi) * seconds / 86400 - math.pi),
        (F.col("event_type") == "purchase").cast("double"),
    )
    rows = events.select(F.concat(F.lit("ds"), (F.col("user_id") % 3).cast("string")).alias("dataset"), F.col("user_id").alias("episode_id"), "ts", "event_id", "event_type", state.alias("state"))
    numbered = number_frames(rows, ["ts", "event_id"])
    return numbered.withColumn("prompt", F.concat(F.lit("handle "), whole_episode(numbered, "event_type", EPISODES))).drop("ts", "event_id")
