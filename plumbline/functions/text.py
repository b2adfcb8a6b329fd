"""Text functions: prompts, conversations, chat rendering, stop strings, token splicing and label masks.

A conversation is ``array<struct<from:string, value:string>>`` with the speakers ``human`` and ``gpt``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE = "<image>"
#: The default prompt, the sentinels of labels and of image places.
PROMPT = "<image>\nWhat action should the robot take to {prompt}?"
IGNORED, IMAGE_ID = -100, -200
TURN = "array<struct<from:string,value:string>>"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` only takes spaces)."""
    return F.regexp_replace(text, r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$", "")


def fill_prompt(prompt: Column, template: str | Callable[[Column], Column] = PROMPT) -> Column:
    """The template with ``{prompt}`` filled in, or the template function applied."""
    if callable(template):
        return template(prompt)
    return F.replace(F.lit(template), F.lit("{prompt}"), prompt)


def replace_answer(df: DataFrame, default: str = " ") -> DataFrame:
    """Overwrite ``answer`` where the table has it; other tables stay as they are."""
    return df.withColumn("answer", F.lit(default)) if "answer" in df.columns else df


def to_conversation(prompt: Column | None, answer: Column | None) -> Column:
    """Two turns; a missing or null side is empty."""
    value = lambda c: F.lit("") if c is None else F.coalesce(c, F.lit(""))
    turn = lambda who, c: F.struct(F.lit(who).alias("from"), value(c).alias("value"))
    return F.array(turn("human", prompt), turn("gpt", answer))


def with_conversation(df: DataFrame) -> DataFrame:
    """Add ``conversations`` from ``prompt`` and ``answer``; a table that has it keeps it."""
    if "conversations" in df.columns:
        return df
    have = lambda c: F.col(c) if c in df.columns else None
    return df.withColumn("conversations", to_conversation(have("prompt"), have("answer")))


def image_first(message: Column) -> Column:
    """A message that mentions ``<image>`` begins with it, once; others stay."""
    body = strip(F.replace(message, F.lit(IMAGE), F.lit("")))
    return F.when(message.contains(IMAGE), strip(F.concat(F.lit(IMAGE + "\n"), body))).otherwise(message)


def drop_leading_answer(turns: Column) -> Column:
    """Without the first turn where it isn't human."""
    return F.when(F.get(turns, F.lit(0))["from"] != "human", F.slice(turns, F.lit(2), F.greatest(F.size(turns), F.lit(1)))).otherwise(turns)


def alternates(turns: Column) -> Column:
    """Whether human and gpt take turns, human first."""
    right = F.transform(turns, lambda t, i: t["from"] == F.when(i % 2 == 0, "human").otherwise("gpt"))
    return F.forall(right, lambda x: F.coalesce(x, F.lit(False)))


def render_chat(turns: Column, system: str = "", roles: tuple[str, str] = ("USER", "ASSISTANT"), seps: tuple[str, str] = (" ", "</s>"), plain: bool = False) -> Column:
    """One text from a conversation. Two styles: ``ROLE: message`` with alternating separators (an empty message is
    ``ROLE:``), and plain, messages and separators alone."""
    sep = lambda i: F.when(i % 2 == 0, seps[0]).otherwise(seps[1])
    role = lambda t: F.when(t["from"] == "human", roles[0]).otherwise(roles[1])
    full = lambda t: F.coalesce(t["value"], F.lit("")) != ""
    if plain:
        parts = F.transform(turns, lambda t, i: F.when(full(t), F.concat(t["value"], sep(i))).otherwise(""))
        return F.concat(F.lit(system), F.array_join(parts, ""))
    parts = F.transform(turns, lambda t, i: F.when(full(t), F.concat(role(t), F.lit(": "), t["value"], sep(i))).otherwise(F.concat(role(t), F.lit(":"))))
    return F.concat(F.lit(system + seps[0]), F.array_join(parts, ""))


def clean_prompt(text: Column) -> Column:
    """Stripped, with line feeds and underscores as spaces."""
    return F.translate(strip(text), "\n_", "  ")


def pad_ids(ids: Column, length: int, newline: int | None = None, pad: int = 0) -> Column:
    """Ids, the newline's id if given, cut to ``length`` and padded on the right."""
    full = ids if newline is None else F.concat(ids, F.array(F.lit(newline)))
    cut = F.slice(full, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(pad), F.lit(length) - F.size(cut)))


def splice_images(text: Column, encode: Callable[[Column], Column], bos: int | None = None) -> Column:
    """Ids of the parts between ``<image>`` marks, with the image sentinel at every mark. ``encode`` maps a part to
    ids; where ``bos`` is given each part begins with it, and only the first is kept."""
    parts = F.transform(F.split(text, IMAGE), lambda p: encode(p))
    if bos is not None:
        parts = F.transform(parts, lambda ids, i: F.when((i > 0) & (F.get(ids, F.lit(0)) == bos), F.slice(ids, F.lit(2), F.greatest(F.size(ids), F.lit(1)))).otherwise(ids))
    return F.flatten(F.transform(parts, lambda ids, i: F.when(i == 0, ids).otherwise(F.concat(F.array(F.lit(IMAGE_ID)), ids))))


def mask_labels(ids: Column, rounds: Column) -> Column:
    """Labels of a multi-round chat: -100 over each round's instruction, ids elsewhere.

    ``rounds`` is ``array<struct<total:int, instruction:int>>``: lengths in ids, in order. Where the lengths don't add
    up to the number of ids, everything is masked.
    """
    flags = F.flatten(F.transform(rounds, lambda r: F.concat(F.array_repeat(F.lit(True), r["instruction"]), F.array_repeat(F.lit(False), r["total"] - r["instruction"]))))
    masked = F.zip_with(ids, flags, lambda x, m: F.when(m, F.lit(IGNORED)).otherwise(x))
    return F.when(F.size(flags) == F.size(ids), masked).otherwise(F.transform(ids, lambda _: F.lit(IGNORED)))


def stops(ids: Column, text: Column, keyword_ids: Sequence[Sequence[int]], keywords: Sequence[str]) -> Column:
    """Whether generated ids end in a stop sequence or the text has a stop word."""
    test = F.lit(False)
    for k in keyword_ids:
        tail = F.slice(ids, F.greatest(F.size(ids) - len(k) + 1, F.lit(1)), F.lit(len(k)))
        test = test | (tail == F.array(*map(F.lit, k)))
    for w in keywords:
        test = test | text.contains(w)
    return test


def drop_suffix(text: Column, suffix: str) -> Column:
    """Without ``suffix`` at the end (a suffix, not a set of characters) and without outer white space."""
    bare = strip(text)
    return strip(F.when(bare.endswith(suffix), F.substring(bare, F.lit(1), F.length(bare) - len(suffix))).otherwise(bare)) if suffix else bare


def word_ids(text: Column, dim: int = 50_000) -> Column:
    """The built-in stand-in for a tokenizer: white-space words, each hashed to an id from 1 to ``dim``."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: (F.pmod(F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(dim)) + 1).cast("int"))


def tokenize_chat(turns: Column, encode: Callable[[Column], Column] = word_ids, system: str = "", roles: tuple[str, str] = ("USER", "ASSISTANT"), seps: tuple[str, str] = (" ", "</s>")) -> Column:
    """``struct<input_ids, labels>`` of a conversation: every turn is rendered and encoded by itself; what a human says
    (and the system's text) is masked in the labels."""
    name = lambda t: F.when(t["from"] == "human", roles[0]).otherwise(roles[1])
    text = lambda t, i: F.concat(F.when(i == 0, system + seps[0] if system else "").otherwise(""), name(t), F.lit(": "), F.coalesce(t["value"], F.lit("")), F.when(i % 2 == 0, seps[0]).otherwise(seps[1]))
    coded = F.transform(turns, lambda t, i: F.struct(encode(text(t, i)).alias("ids"), (t["from"] == "human").alias("masked")))
    labels = F.transform(coded, lambda c: F.when(c["masked"], F.transform(c["ids"], lambda _: F.lit(IGNORED))).otherwise(c["ids"]))
    return F.struct(F.flatten(F.transform(coded, lambda c: c["ids"])).alias("input_ids"), F.flatten(labels).alias("labels"))


def arrow_encoder(encode: Callable[[str], list[int]]):
    """A tokenizer in Python as a column function, in Arrow batches; null texts have no ids."""
    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return run


#: Chat templates by name: how :func:`render_chat` writes a conversation.
TEMPLATES: dict[str, dict] = {"two": {"seps": (" ", "</s>")}, "plain": {"seps": ("\n", "\n"), "plain": True}, "lines": {"seps": ("\n", "\n")}}


def register_template(name: str, **style) -> None:
    """Add or replace a template; unknown parts of a style are errors when it is rendered."""
    TEMPLATES[name] = dict(style)


def render_with(turns: Column, template: str) -> Column:
    """:func:`render_chat` in the style of a registered template."""
    if template not in TEMPLATES:
        raise KeyError(f"no such template: {template}")
    return render_chat(turns, **TEMPLATES[template])
