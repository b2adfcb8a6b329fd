"""Pipelines of DataFrame transforms, and the presets that training and statistics use."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text, vec
from plumbline.operators import episode, stats

Transform = Callable[[DataFrame], DataFrame]


class Pipeline:
    """Transforms in order; lists are taken apart. ``predict_length`` and ``statistic_mapping`` are those of the last
    transform that has them, lists included."""

    def __init__(self, *steps: Transform | Iterable[Transform]):
        self.steps: list[Transform] = []
        self.add(*steps)

    def add(self, *steps: Transform | Iterable[Transform]) -> Pipeline:
        for s in steps:
            if callable(s):
                self.steps.append(s)
            else:
                self.add(*s)
        return self

    def _last(self, name: str) -> Any:
        return next((getattr(s, name) for s in reversed(self.steps) if hasattr(s, name)), None)

    @property
    def predict_length(self) -> int | None:
        return self._last("predict_length")

    @property
    def statistic_mapping(self) -> Any:
        return self._last("statistic_mapping")

    def __call__(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s(df)
        return df


def step(function: Callable[..., DataFrame], *args, **attributes) -> Transform:
    """A transform of fixed arguments; keyword names in ``PUBLIC`` become its attributes, too."""
    own = {k: attributes.pop(k) for k in ("predict_length", "statistic_mapping") if k in attributes}

    def run(df: DataFrame) -> DataFrame:
        return function(df, *args, **attributes)

    for k, v in own.items():
        setattr(run, k, v)
    return run


def select_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exactly these columns; a missing one is an error."""
    return df.select(*keys)


def normalise_to_text(df: DataFrame, table: DataFrame, vocabulary: int = 255, pattern: str = " {value}") -> DataFrame:
    """``answer`` from ``action``: statistics by prompt of the first frame, dataset, or overall; clip, scale, quantise,
    write. A stored answer stays. Statistics shorter than the action repeat over its dimensions."""
    if "action" not in df.columns or "answer" in df.columns:
        return df
    first = df.withColumns({"__own": F.col("prompt"), "prompt": episode.whole_episode(df, "prompt")})
    found = stats.lookup_stats(first, table).withColumn("prompt", F.col("__own")).drop("__own")
    scaled = vec.minmax(F.col("action"), F.col("min"), F.col("max"))
    return found.withColumn("answer", vec.bins_to_text(vec.quantize(scaled, vocabulary), pattern)).drop("min", "max")


def add_prompt(df: DataFrame, template=text.PROMPT) -> DataFrame:
    """The template around ``prompt``, for episodes whose first frame is a robot's; others stay."""
    if "prompt" not in df.columns or "is_robot" not in df.columns:
        return df
    robot = F.coalesce(episode.whole_episode(df, "is_robot"), F.lit(False))
    return df.withColumn("prompt", F.when(robot, text.fill_prompt(F.col("prompt"), template)).otherwise(F.col("prompt")))


@dataclass
class ActionPlan:
    """Switches of the default pipeline; unknown or missing ones are errors when the plan is made."""

    statistics: DataFrame | None = None
    predict_length: int = 1
    delta: bool = False
    non_delta: tuple[int, ...] | None = None
    periodic: tuple[int, ...] | None = None
    chunk: int = 1
    padding: str = "last"
    pad_short: bool = True
    vocabulary: int = 255
    pattern: str = " {value}"
    template: Any = text.PROMPT
    prompt: bool = True
    normalise: bool = True
    answer: str | None = None

    @classmethod
    def of(cls, **config) -> ActionPlan:
        if unknown := set(config) - {f.name for f in fields(cls)}:
            raise KeyError(f"unknown keys: {', '.join(sorted(unknown))}")
        return cls(**config)

    def pipeline(self) -> Pipeline:
        if self.normalise and self.statistics is None:
            raise ValueError("missing keys: statistics")
        plan = Pipeline(step(episode.add_action, self.predict_length, predict_length=self.predict_length))
        if self.delta:
            plan.add(step(episode.delta_action, non_delta=self.non_delta, periodic=self.periodic))
        if self.chunk > 1:
            plan.add(step(episode.add_chunk, self.chunk, padding=self.padding, non_delta=self.non_delta, pad_short=self.pad_short))
        if self.normalise:
            plan.add(step(normalise_to_text, self.statistics, vocabulary=self.vocabulary, pattern=self.pattern, statistic_mapping=self.statistics))
        if self.prompt:
            plan.add(step(add_prompt, self.template))
        if self.answer is not None:
            plan.add(step(text.replace_answer, self.answer))
        return plan


def statistics_pipeline(frames: DataFrame, predict_length: int = 1, delta: bool = True, non_delta=None, periodic=None) -> DataFrame:
    """Per-dataset action statistics, all frames of all episodes: columns are pruned to what they need."""
    needed = frames.select("dataset", "episode_id", "frame_index", "state")
    actions = episode.add_action(needed, predict_length)
    return stats.dimension_stats(episode.delta_action(actions, non_delta, periodic) if delta else actions, "action")
