"""Schemas of the canonical tables."""

from __future__ import annotations

FRAME_REF = "struct<type:string,url:string,frame_idx:int>"
META = "struct<non_delta_mask:array<int>,periodic_mask:array<int>,periodic_range:double>"
TURNS = "array<struct<from:string,value:string>>"

DATASETS = f"dataset string, annotations string, data_path_prefix string, frequency double, meta {META}"
FRAMES = f"dataset string, episode_id string, frame_index int, state array<double>, action array<double>, prompt string, answer string, is_robot boolean, images map<string,{FRAME_REF}>, conversations {TURNS}"
#: One line of an episode file, without the views, whose names are open.
LINE = f"state array<double>, action array<double>, prompt string, answer string, is_robot boolean, conversations {TURNS}, reward double"
NORM_STATS = "dataset string, prompt string, key string, mean array<double>, std array<double>, q01 array<double>, q99 array<double>, min array<double>, max array<double>"


def with_views(names: list[str], base: str = LINE) -> str:
    """The line schema with image or depth views, such as ``images_1``."""
    return base + "".join(f", {n} {FRAME_REF}" for n in names)
