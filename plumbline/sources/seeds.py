"""The catalog's built-in entries: names and folders of public simulator datasets, built from a rule per family."""

from __future__ import annotations

from plumbline.sources.catalog import PROFILES, Catalog

# The families' data set names.
LIBERO = ["goal", "10", "spatial", "object"]
MANISKILL = ["PickCube", "StackCube", "PickSingleYCB", "PickSingleEGAD", "PickClutterYCB"]
ROBOTWIN = [
    "adjust_bottle",
    "beat_block_hammer",
    "blocks_ranking_rgb",
    "blocks_ranking_size",
    "click_alarmclock",
    "click_bell",
    "dump_bin_bigbin",
    "grab_roller",
    "handover_block",
    "handover_mic",
    "hanging_mug",
    "lift_pot",
    "move_can_pot",
    "move_pillbottle_pad",
    "move_playingcard_away",
    "move_stapler_pad",
    "open_laptop",
    "open_microwave",
    "pick_diverse_bottles",
    "pick_dual_bottles",
    "place_a2b_left",
    "place_a2b_right",
    "place_bread_basket",
    "place_bread_skillet",
    "place_burger_fries",
    "place_can_basket",
    "place_cans_plasticbox",
    "place_container_plate",
    "place_dual_shoes",
    "place_empty_cup",
    "place_fan",
    "place_mouse_pad",
    "place_object_basket",
    "place_object_scale",
    "place_object_stand",
    "place_phone_stand",
    "place_shoe",
    "press_stapler",
    "put_bottles_dustbin",
    "put_object_cabinet",
    "rotate_qrcode",
    "scan_object",
    "shake_bottle",
    "shake_bottle_horizontally",
    "stack_blocks_three",
    "stack_blocks_two",
    "stack_bowls_three",
    "stack_bowls_two",
    "stamp_seal",
    "turn_switch",
]


def builtin(root: str = "./data") -> Catalog:
    """A catalog with all built-in entries below ``root``."""
    entry = lambda notes, media: {"annotations": f"{root}/{notes}", "data_path_prefix": f"{root}/{media}", "frequency": 1.0}
    libero = {n: entry(f"libero/libero_{n}", f"libero/libero_{n}/video") for n in LIBERO}
    libero["pi0_all"] = entry("libero/libero_pi0_all", "libero/libero_pi0_all/image")
    catalog = Catalog()
    catalog.register(libero, "libero", PROFILES["single_arm"])
    catalog.register({"ABC": entry("calvin/task_ABC_D", "calvin/task_ABC_D/video")}, "calvin", PROFILES["single_arm_angles"])
    catalog.register({"all": entry("simpler", "simpler/video")}, "simpler", PROFILES["single_arm"])
    catalog.register({n.lower(): entry(f"maniskill/jsonl/{n}-v0", f"maniskill/video/{n}-v0/base/") for n in MANISKILL}, "maniskill", PROFILES["single_arm_angles"])
    catalog.register({n: entry(f"robotwin/jsonl/{n}", "robotwin/video") for n in ROBOTWIN}, "robotwin2", PROFILES["two_arms"])
    return catalog
