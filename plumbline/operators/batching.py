"""Collation: padding, masks, stacking, and blocks inside padded sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collate(df: DataFrame, batch: str = "batch", order: Sequence[str] = ("slot",), ids: str = "input_ids", labels: str = "labels", pad_id: int = 0, ignored: int = -100, max_length: int | None = None) -> DataFrame:
    """Pad ids and labels on the right to the batch's longest, then cut to ``max_length``; ``attention_mask`` comes
    from lengths, so an id that equals the padding stays attended. Rows stay rows, in ``order`` inside a batch."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    out = df.withColumns({"__n": longest, "__own": F.size(ids)})
    if max_length is not None:
        out = out.withColumns({"__n": F.least("__n", F.lit(max_length)), "__own": F.least("__own", F.lit(max_length))})
    fill = lambda c, v: F.concat(F.slice(c, F.lit(1), F.col("__n")), F.array_repeat(F.lit(v), F.greatest(F.lit(0), F.col("__n") - F.size(c))))
    mask = F.concat(F.array_repeat(F.lit(1), F.col("__own")), F.array_repeat(F.lit(0), F.col("__n") - F.col("__own")))
    made = {ids: fill(ids, pad_id), "attention_mask": mask}
    if labels in df.columns:
        made[labels] = fill(labels, ignored)
    return out.withColumns(made).drop("__n", "__own")


def stack(df: DataFrame, columns: Sequence[str], batch: str = "batch", order: Sequence[str] = ("slot",), names: dict[str, str] | None = None) -> DataFrame:
    """One row per batch: each column's values as an array in order, and ``<name>_uniform``, whether all vectors have
    one length (they can be stacked). ``names`` renames, such as action to actions."""
    names = names or {}
    rows = df.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct(*order, *columns))).alias("__r"))
    out = [F.col(batch)]
    for c in columns:
        value = F.col("__r")[c]
        out.append(value.alias(names.get(c, c)))
        if df.schema[c].dataType.typeName() == "array":
            out.append((F.size(F.array_distinct(F.transform(value, lambda v: F.size(v)))) <= 1).alias(f"{names.get(c, c)}_uniform"))
    return rows.select(*out)


def insert_block(ids: Column, mask: Column, block: Column) -> tuple[Column, Column, Column]:
    """Put a block at the first padded place: (ids, mask, where it begins). All padding follows the block."""
    at = F.aggregate(mask, F.lit(0), lambda n, m: n + m)
    new = F.concat(F.slice(ids, F.lit(1), at), block, F.slice(ids, at + 1, F.size(ids)))
    ones = F.concat(F.array_repeat(F.lit(1), at + F.size(block)), F.array_repeat(F.lit(0), F.size(mask) - at))
    return new, ones, at


def extract_block(ids: Column, at: Column, length: int) -> Column:
    return F.slice(ids, at + 1, F.lit(length))


def spliced_length(text_ids: Column, image_id: int, patches: Column | int) -> Column:
    """Places a sequence takes once every image sentinel is replaced by its patches."""
    images = F.size(F.filter(text_ids, lambda x: x == image_id))
    return F.size(text_ids) - images + images * F.lit(patches)


def splice_values(ids: Column, image_id: int, words: Column, images: Column) -> Column:
    """Vectors of a multimodal sequence: ``words`` has a vector for each id, ``images`` the patch vectors of each image;
    the j-th image sentinel gives way to all patches of the j-th image (to none if there are too few images)."""
    flags = F.transform(ids, lambda x: (x == image_id).cast("int"))
    # Places of the sentinels in order: the rank of one is its image's number.
    places = F.filter(F.transform(flags, lambda f, i: F.when(f == 1, i)), lambda i: i.isNotNull())
    none = F.slice(F.get(images, F.lit(0)), 1, 0)
    patches = lambda i: F.coalesce(F.get(images, F.array_position(places, i).cast("int") - 1), none)
    return F.flatten(F.transform(ids, lambda x, i: F.when(x == image_id, patches(i)).otherwise(F.array(F.get(words, i)))))


def splice_layout(df: DataFrame, ids: str, image_id: int, patches: int, batch: str, max_length: int | None = None, side: str = "right") -> DataFrame:
    """Bookkeeping of a multimodal splice: ``kind`` (0 padding, 1 text, 2 image), ``attention_mask`` and
    ``position_ids`` of every sequence, cut to ``max_length`` and padded to the batch's longest on ``side``."""
    if side not in ("left", "right"):
        raise ValueError("side is 'left' or 'right'")
    kinds = F.flatten(F.transform(ids, lambda x: F.when(x == image_id, F.array_repeat(F.lit(2), patches)).otherwise(F.array(F.lit(1)))))
    kinds = F.slice(kinds, 1, max_length) if max_length else kinds
    out = df.withColumn("kind", kinds).withColumn("__n", F.max(F.size("kind")).over(Window.partitionBy(batch)))
    pad = F.array_repeat(F.lit(0), F.col("__n") - F.size("kind"))
    out = out.withColumn("kind", F.concat("kind", pad) if side == "right" else F.concat(pad, F.col("kind")))
    mask = F.transform("kind", lambda k: (k > 0).cast("int"))
    first = F.lit(0) if side == "right" else F.col("__n") - F.aggregate(mask, F.lit(0), lambda a, m: a + m)
    places = F.transform("kind", lambda k, i: F.when(k > 0, i - first).otherwise(0).cast("int"))
    return out.withColumns({"attention_mask": mask, "position_ids": places}).drop("__n")


def write_batch_log(schedule: DataFrame, path: str) -> None:
    """One tab-separated folder per rank."""
    schedule.write.mode("overwrite").partitionBy("rank").option("sep", "\t").csv(path)
