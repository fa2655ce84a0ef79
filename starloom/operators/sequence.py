"""Ordered sequences per key: gaps, fills, moving windows, polynomial smoothing."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from starloom.operators import stats
from starloom.session import checkpointed


def gap_segments(df: DataFrame, keys: Sequence[str], t: str, tie: str, factor: float = 3.0) -> DataFrame:
    """Adds `segment` (long, from 0): a new one after each step above `factor` median steps of the key."""
    w = Window.partitionBy(*keys).orderBy(t, tie)
    steps = df.withColumn("__dt", F.col(t) - F.lag(t).over(w))
    middle = steps.groupBy(*keys).agg(F.percentile("__dt", F.lit(0.5)).alias("__m"))
    return stats.join_keys(steps, middle, keys).withColumn("segment", F.sum(F.when(F.col("__dt") > factor * F.col("__m"), 1).otherwise(0)).over(w)).drop("__dt", "__m")


def linear_fill(df: DataFrame, keys: Sequence[str], t: str, tie: str, value: str) -> DataFrame:
    """Adds `filled`: missing values between two known ones of the same keys, linear in time; the ends stay missing.

    With `segment` among the keys nothing is filled across a gap.
    """
    w = Window.partitionBy(*keys).orderBy(t, tie)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    known_t = F.when(F.col(value).isNotNull(), F.col(t))
    sides = df.withColumns({
        "__v0": F.last(value, ignorenulls=True).over(back), "__t0": F.last(known_t, ignorenulls=True).over(back),
        "__v1": F.first(value, ignorenulls=True).over(ahead), "__t1": F.first(known_t, ignorenulls=True).over(ahead),
    })
    between = F.col("__v0") + (F.col("__v1") - F.col("__v0")) * (F.col(t) - F.col("__t0")) / F.nullif(F.col("__t1") - F.col("__t0"), F.lit(0.0))
    return sides.withColumn("filled", F.coalesce(F.col(value), between, F.when(F.col("__t0") == F.col("__t1"), F.col("__v0")))).drop("__v0", "__t0", "__v1", "__t1")


def clamped_fill(df: DataFrame, keys: Sequence[str], t: str, tie: str, value: str) -> DataFrame:
    """As `linear_fill`, but the ends take the nearest known value, and keys without any 0."""
    w = Window.partitionBy(*keys).orderBy(t, tie)
    last = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first(value, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    inside = linear_fill(df.withColumns({"__last": last, "__first": first}), keys, t, tie, value)
    return inside.withColumn("filled", F.coalesce("filled", "__last", "__first", F.lit(0.0))).drop("__last", "__first")


def centred_mean(keys: Sequence[str], t: str, value: str, half: float) -> Column:
    """The mean of the values within `half` in time to both sides; nulls don't count."""
    return F.avg(value).over(Window.partitionBy(*keys).orderBy(t).rangeBetween(-half, half))


def moving(keys: Sequence[str], t: str, tie: str, before: int, after: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(t, tie).rowsBetween(-before, after)


def savgol_weights(window: int, order: int) -> np.ndarray:
    """Least-squares weights: row i gives the fitted polynomial's value at place i of the window."""
    x = np.arange(window) - window // 2
    design = np.vander(x, order + 1, increasing=True).astype(float)
    return design @ np.linalg.pinv(design)


def savgol(df: DataFrame, keys: Sequence[str], t: str, tie: str, value: str, window: int = 5, order: int = 2) -> DataFrame:
    """Adds `smooth`: the polynomial of the window about each row; both ends take their outermost window's polynomial.

    Keys shorter than the window use the largest odd window that fits them, and stay as they are where it would not exceed the
    order.  All of it is one window expression of rows within reach, so no key is gathered in Python.
    """
    w = Window.partitionBy(*keys).orderBy(t, tie)
    at = df.withColumns({"__i": F.row_number().over(w) - 1, "__n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    i, n = F.col("__i"), F.col("__n")
    smooth = F.col(value)
    for size in range(1, window + 1, 2):  # the size that a key of n rows gets
        if size <= order:
            continue
        weights = savgol_weights(size, order)
        half = size // 2

        def terms(row: int, first: int) -> Column:
            """Weights of one place in the window, which begins at the offset `first`."""
            return functools.reduce(Column.__add__, [F.lead(value, first + k).over(w) * float(x) for k, x in enumerate(weights[row])])

        here = terms(half, -half)
        for k in range(half):
            here = F.when(i == k, terms(k, -k)).when(i == n - 1 - k, terms(size - 1 - k, k - size + 1)).otherwise(here)
        smooth = F.when((n >= size) if size == window or size == window - 1 else n.between(size, size + 1), here).otherwise(smooth)
    return at.withColumn("smooth", smooth).drop("__i", "__n")


def clipped_savgol(df: DataFrame, keys: Sequence[str], t: str, tie: str, value: str, window: int = 5, order: int = 2, kappa: float = 3.0, gap: float = 3.0) -> DataFrame:
    """Adds `segment` and `smooth`: segments between gaps are filled and smoothed, residuals beyond kappa robust deviations of their
    segment are dropped and refilled, and the result is smoothed again."""
    rows = gap_segments(df, keys, t, tie, gap)
    by = [*keys, "segment"]
    first = savgol(clamped_fill(rows, by, t, tie, value), by, t, tie, "filled", window, order)
    residual = first.withColumn("__r", F.col(value) - F.col("smooth"))
    scale = stats.robust_sigma(residual, by, "__r").select(*by, F.col("median").alias("__m"), F.col("sigma").alias("__s"))
    good = F.abs(F.col("__r") - F.col("__m")) <= kappa * F.col("__s")
    kept = residual.join(scale, by, "left").withColumn("__kept", F.when(good, F.col(value))).drop("filled", "smooth", "__r", "__m", "__s")
    again = savgol(clamped_fill(kept, by, t, tie, "__kept"), by, t, tie, "filled", window, order)
    return again.drop("filled", "__kept")


def weighted_window(keys: Sequence[str], t: str, tie: str, value: str, weights: Sequence[float]) -> Column:
    """The weighted sum over the rows about each; null where the window leaves the sequence."""
    w, half = Window.partitionBy(*keys).orderBy(t, tie), len(weights) // 2
    terms = [F.lead(value, i - half).over(w) * float(x) for i, x in enumerate(weights)]
    return functools.reduce(Column.__add__, terms)


def percentile_norm(keys: Sequence[str], t: str, tie: str, value: str, half: int, low: float, high: float) -> Column:
    """The value's place between two moving percentiles, within 0 and 1; null where they are equal."""
    w = moving(keys, t, tie, half, half)
    lo, hi = (F.percentile(value, F.lit(p)).over(w) for p in (low, high))
    place = (F.col(value) - lo) / F.nullif(hi - lo, F.lit(0.0))
    return F.when(place.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), place)))


def adaptive_median(df: DataFrame, keys: Sequence[str], t: str, tie: str, value: str, levels: Sequence[tuple[float, int]], calm: int) -> DataFrame:
    """Adds `smooth`: a moving median whose half width follows the local scatter.

    The scatter is the moving (max - min) over one row to each side.  `levels` gives (scatter at least, half width) from
    the most restless down; below all of them the half width is `calm`.  The widest window is gathered once, and each row sorts
    the part of it that its own width asks for.
    """
    near = moving(keys, t, tie, 1, 1)
    widest = max([calm, *(half for _, half in levels)])
    half = F.lit(calm)
    for least, h in reversed(levels):
        half = F.when(F.col("__s") >= least, h).otherwise(half)
    df = df.withColumns({
        "__s": F.max(value).over(near) - F.min(value).over(near),
        "__w": F.collect_list(F.struct(F.col(value).alias("v"))).over(moving(keys, t, tie, widest, widest)),
        "__i": F.least(F.row_number().over(Window.partitionBy(*keys).orderBy(t, tie)) - 1, F.lit(widest)),
    }).withColumn("__h", half)
    low = F.greatest(F.col("__i") - F.col("__h"), F.lit(0))
    part = F.transform(F.slice("__w", low + 1, F.col("__i") + F.col("__h") - low + 1), lambda x: x["v"])
    df = df.withColumn("__w", F.sort_array(F.filter(part, lambda v: v.isNotNull())))
    n = F.size("__w")
    at = lambda i: F.get(F.col("__w"), i.cast("int"))
    return df.withColumn("smooth", (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).drop("__s", "__w", "__i", "__h")


def frame_fallback(df: DataFrame, frame: str, raw: str, smooth: str, kappa: float) -> DataFrame:
    """Adds `chosen`: the smooth value, or the raw one where smooth is null and in outlying frames.

    A frame's residual is the median of |raw - smooth|; it is outlying above the median residual by kappa 1.4826 MAD.
    """
    away = df.select(frame, F.abs(F.col(raw) - F.col(smooth)).alias("__d"))
    medians = checkpointed(stats.quantile(away, [frame], "__d", name="__r"))  # one row per frame
    typical = medians.agg(F.percentile("__r", F.lit(0.5)).alias("__m"))
    mad = medians.join(F.broadcast(typical)).agg(F.first("__m").alias("__m"), F.percentile(F.abs(F.col("__r") - F.col("__m")), F.lit(0.5)).alias("__s"))  # one row
    outlying = medians.join(F.broadcast(mad)).where(F.col("__r") > F.col("__m") + kappa * 1.4826 * F.col("__s")).select(frame, F.lit(True).alias("__out"))
    use_raw = F.col("__out").isNotNull() | F.col(smooth).isNull()
    return stats.join_keys(df, outlying, [frame], "left").withColumn("chosen", F.when(use_raw, F.col(raw)).otherwise(F.col(smooth))).drop("__out")
