"""Functions on ``array<double>`` columns: padding, deltas, wrapping, normalising, quantising, chunks, similarity.

Dimension lists may hold negative indexes; they are resolved against each row's own vector, so ``[-1]`` is the last
dimension of vectors of any length.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS_Z = 1e-6
EPS_RANGE = 1e-8


def doubles(values: Sequence[float]) -> Column:
    """A literal vector; the empty list is an empty array<double>."""
    return F.array(*(F.lit(float(v)) for v in values)) if len(values) else F.expr("cast(array() as array<double>)")


def in_dims(i: Column, size: Column, dims: Sequence[int] | Column | None) -> Column:
    """Whether 0-based place ``i`` of a vector of ``size`` is among ``dims``, negative ones counted from its end."""
    if dims is None:
        return F.lit(False)
    if isinstance(dims, Column):
        return F.coalesce(F.array_contains(dims, i) | F.array_contains(dims, i - size), F.lit(False))
    positive, negative = [d for d in dims if d >= 0], [d for d in dims if d < 0]
    test = F.lit(False)
    if positive:
        test = test | i.isin(*positive)
    if negative:
        test = test | (i - size).isin(*negative)
    return test


def pad_right(vec: Column, n: int, fill: float = 0.0) -> Column:
    """Zero-pad on the right up to ``n`` places; longer vectors stay as they are."""
    return F.concat(vec, F.array_repeat(F.lit(float(fill)), F.greatest(F.lit(0), F.lit(n) - F.size(vec))))


def pad_right_rows(matrix: Column, n: int, fill: float = 0.0) -> Column:
    """:func:`pad_right` on each row of an array of vectors."""
    return F.transform(matrix, lambda v: pad_right(v, n, fill))


def wrap_once(x: Column, threshold: float | Column, shift: float | Column) -> Column:
    """One step back into range: above ``threshold`` minus ``shift``, below ``-threshold`` plus ``shift``."""
    return F.when(x > threshold, x - shift).when(x < -F.lit(threshold), x + shift).otherwise(x)


def wrap_dims(vec: Column, dims: Sequence[int] | Column | None, threshold: float | Column, shift: float | Column) -> Column:
    return F.transform(vec, lambda x, i: F.when(in_dims(i, F.size(vec), dims), wrap_once(x, threshold, shift)).otherwise(x))


def take_dims(vec: Column, other: Column, dims: Sequence[int] | Column | None) -> Column:
    """``vec`` with ``dims`` taken from ``other``."""
    return F.transform(vec, lambda x, i: F.when(in_dims(i, F.size(vec), dims), F.get(other, i)).otherwise(x))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def midpoint(a: Column, b: Column) -> Column:
    """Element-wise mean of two vectors."""
    return F.zip_with(a, b, lambda x, y: (x + y) / 2)


def lerp(t: Column | float, noise: Column, action: Column) -> Column:
    """t * noise + (1 - t) * action."""
    w = F.lit(t)
    return F.zip_with(noise, action, lambda n, a: w * n + (1 - w) * a)


def flow_target(noise: Column, action: Column) -> Column:
    return subtract(noise, action)


def gate_blend(gate: Column, a: Column, b: Column) -> Column:
    """gate * a + (1 - gate) * b, element by element."""
    return F.zip_with(F.arrays_zip(gate.alias("g"), a.alias("a")), b, lambda ga, y: ga["g"] * ga["a"] + (1 - ga["g"]) * y)


def guidance(unconditional: Column, conditional: Column, scale: float | Column) -> Column:
    """u + scale * (c - u)."""
    return F.zip_with(unconditional, conditional, lambda u, c: u + F.lit(scale) * (c - u))


def euler(x: Column, velocity: Callable[[Column, Column], Column], steps: int) -> Column:
    """Integrate from t = 1 down to 0 in ``steps`` steps of -1/steps; ``velocity(x, t)`` gives a vector."""
    dt = -1.0 / steps
    return F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), x, lambda acc, i: F.zip_with(acc, velocity(acc, 1.0 + i * dt), lambda a, v: a + v * dt))


def delta(action: Column, state: Column, non_delta=None, periodic=None, period: float | Column = 2 * math.pi) -> Column:
    """action - state; periodic dimensions wrapped once at half the period; ``non_delta`` keeps the action's values."""
    half = F.lit(period) / 2
    return take_dims(wrap_dims(subtract(action, state), periodic, half, F.lit(period)), action, non_delta)


def absolute(state: Column, action: Column, non_delta=None, periodic=None, half_range: float = math.pi) -> Column:
    """state + action; ``non_delta`` keeps the action's values, then periodic dimensions are wrapped once by a full
    turn (2 * half_range) beyond half_range."""
    return wrap_dims(take_dims(add(state, action), action, non_delta), periodic, half_range, 2 * half_range)


def zscore(vec: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / (std + 1e-6) as array<float>."""
    centred = F.zip_with(vec, mean, lambda x, m: x - m)
    return F.zip_with(centred, std, lambda x, s: x / (s + EPS_Z)).cast("array<float>")


def zscore_inverse(vec: Column, mean: Column, std: Column) -> Column:
    """x * (std + 1e-6) + mean; stats shorter than the vector are padded with mean 0 and std 1."""
    n = F.size(vec)
    longer = lambda a, fill: F.concat(a, F.array_repeat(F.lit(fill), F.greatest(F.lit(0), n - F.size(a))))
    scaled = F.zip_with(vec, longer(std, 1.0), lambda x, s: x * (s + EPS_Z))
    return F.zip_with(scaled, longer(mean, 0.0), lambda x, m: x + m)


def _with_bounds(vec: Column, low: Column, high: Column, f: Callable[[Column, Column, Column], Column]) -> Column:
    # A bound of length one serves all dimensions; a shorter bound repeats, so stats of D dims serve a flat T * D chunk.
    return F.transform(vec, lambda x, i: f(x, F.get(low, i % F.size(low)), F.get(high, i % F.size(high))))


def minmax(vec: Column, low: Column, high: Column) -> Column:
    """Clip to [low, high] and map to [-1, 1]."""
    return _with_bounds(vec, low, high, lambda x, a, b: (F.least(F.greatest(x, a), b) - a) / (b - a + EPS_RANGE) * 2 - 1)


def minmax_inverse(vec: Column, low: Column, high: Column) -> Column:
    """Clip to [-1, 1] and map to [low, high]."""
    return _with_bounds(vec, low, high, lambda x, a, b: a + (F.least(F.greatest(x, F.lit(-1.0)), F.lit(1.0)) + 1) * 0.5 * (b - a))


def quantize(vec: Column, vocabulary: int = 255) -> Column:
    """[-1, 1] to bins 0 .. vocabulary - 1; halves round to the even bin."""
    top = vocabulary - 1
    return F.transform(vec, lambda x: F.least(F.greatest(F.bround((x + 1) / 2 * top, 0), F.lit(0.0)), F.lit(float(top))).cast("int"))


def bins_to_text(bins: Column, pattern: str = " {value}") -> Column:
    """Bins written one after the other; ``{value}`` stands for the bin."""
    return F.array_join(F.transform(bins, lambda b: F.replace(F.lit(pattern), F.lit("{value}"), b.cast("string"))), "")


def text_to_action(text: Column, vocabulary: int = 255, dims: int = 7) -> Column:
    """The first ``dims`` numbers of a text, mapped back to [-1, 1]; null where there are fewer."""
    found = F.slice(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), 1, dims)
    return F.when(F.size(found) == dims, F.transform(found, lambda s: s.cast("double") / (vocabulary - 1) * 2 - 1))


def binarize_last(vec: Column) -> Column:
    """The last dimension becomes 1 if positive, else 0."""
    return F.transform(vec, lambda x, i: F.when(i == F.size(vec) - 1, (x > 0).cast("double")).otherwise(x))


def unflatten(flat: Column, dims: int, steps: int | None = None) -> Column:
    """Row-major flat chunk to an array of vectors; ``steps`` keeps the first so many."""
    rows = F.transform(F.sequence(F.lit(0), (F.size(flat) / dims).cast("int") - 1), lambda k: F.slice(flat, k * dims + 1, F.lit(dims)))
    return F.slice(rows, 1, steps) if steps else rows


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null for a zero vector."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def all_finite(vec: Column) -> Column:
    """Whether every value is a finite number (a null value is not)."""
    return F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))


def require_finite(vec: Column, what: str = "vector") -> Column:
    """The vector itself; raises with its extremes where a value is not finite. Null vectors pass."""
    note = F.concat(F.lit(f"{what} has values that are not finite: min "), F.array_min(vec).cast("string"), F.lit(", max "), F.array_max(vec).cast("string"))
    return F.when(vec.isNull() | all_finite(vec), vec).otherwise(F.raise_error(note).cast("array<double>"))


def short_id(name: Column, length: int = 8) -> Column:
    return F.substring(F.md5(name.cast("binary")), 1, length)
