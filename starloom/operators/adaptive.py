"""Median smoothing of pixel series with windows that follow each pixel's variability, over a cube of rows (frame, t, x, y, value).

Smoothing never crosses a gap in time.  A group is a tile of pixels in one segment between gaps, kept as one row of arrays; what
the whole cube decides (brightness of frames, the floor of deviations, outlying frames) comes from aggregations over all groups.  A
tile has a bounded number of pixels, a segment is one stretch of frames; tiles and segments are any number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators import sequence, stats
from starloom.session import checkpointed

METRICS = ("deviation", "gradient", "local_std", "combined")


@dataclass(frozen=True)
class AdaptiveModel:
    metric: str = "deviation"
    least: int = 3  # windows, in frames
    most: int = 51
    levels: int = 7
    smooth_gradient: int = 11
    low: float = 5.0  # percentiles of the running scale
    high: float = 80.0
    coarse: tuple[int, ...] = (11, 21, 51, 101)
    weight: float = 0.5  # of local_std in combined
    deviation_window: int = 21
    norm_window: int = 201
    brightness: float = 2.0
    scatter_angle: float = 50.0
    block: int = 1
    gap: float = 3.0
    kappa: float | None = 5.0

    def __post_init__(self) -> None:
        if self.metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        if self.block > 1 and self.metric != "deviation":
            raise ValueError("blocks are for the metric deviation")

    @property
    def scales(self) -> int:
        return len(self.coarse) if self.metric == "deviation" else 2 if self.metric == "combined" else 1


def odd(n: float) -> int:
    """At least 3, and the next odd number from even ones."""
    n = max(int(n), 3)
    return n + (n % 2 == 0)


def fitting(window: int, n: int) -> int:
    return odd(min(window, n if n % 2 else n - 1))


def rank_filter(a: np.ndarray, window: int, percent: float = 50.0) -> np.ndarray:
    """Running rank along the first axis of (times, pixels); beyond an end the series is reflected, its last value twice."""
    half, rank = window // 2, min(window - 1, int(window * percent / 100.0))
    padded, out = np.pad(a, ((half, half), (0, 0)), mode="symmetric"), np.empty_like(a)
    step = max(1, (1 << 22) // (len(a) * window))
    for k in range(0, a.shape[1], step):
        views = np.lib.stride_tricks.sliding_window_view(padded[:, k : k + step], window, axis=0)
        out[:, k : k + step] = np.partition(views, rank, axis=-1)[..., rank]
    return out


def running_deviation(a: np.ndarray, window: int) -> np.ndarray:
    half = window // 2
    padded, out = np.pad(a, ((half, half), (0, 0)), mode="symmetric"), np.empty_like(a)
    step = max(1, (1 << 22) // (len(a) * window))
    for k in range(0, a.shape[1], step):
        out[:, k : k + step] = np.lib.stride_tricks.sliding_window_view(padded[:, k : k + step], window, axis=0).std(axis=-1)
    return out


def filled_in_time(t: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Missing values of each pixel, linear in time, the nearest at the ends; a pixel without any is 0."""
    out = a.copy()
    for j in np.flatnonzero(~np.isfinite(a).all(axis=0)):
        known = np.isfinite(a[:, j])
        out[:, j] = np.interp(t, t[known], a[known, j]) if known.any() else 0.0
    return out


def block_means(a: np.ndarray, block_of: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """(times, blocks): means of the pixels that `whole` says lie in their block."""
    n = np.bincount(block_of[whole], minlength=block_of.max() + 1)
    sums = np.zeros((len(a), len(n)))
    np.add.at(sums.T, block_of[whole], a[:, whole].T)
    return sums / np.maximum(n, 1)


def measures(t: np.ndarray, filled: np.ndarray, reduced: np.ndarray, inner: tuple[bool, bool], model: AdaptiveModel) -> list[np.ndarray]:
    """The metric's variability before it is scaled: one per coarse window for deviation, gradient and local_std for combined."""
    n, out = len(t), []
    if model.metric == "deviation":
        for coarse in model.coarse:
            away = np.abs(reduced - rank_filter(reduced, fitting(coarse, n)))
            out.append(rank_filter(away, fitting(odd(model.smooth_gradient), n)))
        return out
    if model.metric in ("gradient", "combined"):
        slope = np.gradient(filled, t, axis=0) if n > 1 else np.zeros_like(filled)
        slope[: int(inner[0])] = 0.0  # beside a gap
        slope[n - int(inner[1]) :] = 0.0
        window = odd(model.smooth_gradient)
        out.append(np.abs(rank_filter(slope, window)) if n >= window else np.abs(slope))
    if model.metric in ("local_std", "combined"):
        window = fitting(odd(model.deviation_window), n)
        out.append(running_deviation(filled, window))
    return out


def running_scale(a: np.ndarray, model: AdaptiveModel, floor: float | None) -> np.ndarray:
    """Place between the running low and high percentile, from 0 to 1."""
    window = fitting(odd(model.norm_window), len(a))
    lo, hi = rank_filter(a, window, model.low), rank_filter(a, window, model.high)
    span = np.where(hi > lo, hi - lo, 1.0) if floor is None else np.maximum(hi - lo, floor)
    return np.clip((a - lo) / span, 0.0, 1.0)


def windows_of(norm: np.ndarray, model: AdaptiveModel) -> np.ndarray:
    windows = np.round(model.most - norm * (model.most - model.least)).astype(int)
    return np.clip(windows + 1 - windows % 2, odd(model.least), odd(model.most))


def smoothed(filled: np.ndarray, windows: np.ndarray, model: AdaptiveModel) -> np.ndarray:
    """Running medians with each place's window, on a few levels of windows; of equally near levels the smaller."""
    levels = np.unique([odd(round(w)) for w in np.linspace(model.least, model.most, model.levels)])
    level = levels[np.abs(windows[..., None] - levels).argmin(axis=-1)]
    out = np.empty_like(filled)
    for w in np.unique(level):
        out = np.where(level == w, rank_filter(filled, int(w)), out)
    return out


def frame_segments(cube: DataFrame, gap: float) -> DataFrame:
    """(frame, t, segment, before, after): the stretch of each frame, and whether a gap precedes or follows it.  One row per frame."""
    times = cube.groupBy("frame").agg(F.min("t").alias("t")).withColumn("__all", F.lit(1))
    parted = sequence.gap_segments(times, ["__all"], "t", "frame", gap)
    around = Window.partitionBy("__all").orderBy("t", "frame")
    before, after = F.lag("segment").over(around) != F.col("segment"), F.lead("segment").over(around) != F.col("segment")
    return parted.select("frame", "t", "segment", F.coalesce(before, F.lit(False)).alias("before"), F.coalesce(after, F.lit(False)).alias("after"))


def brightness_threshold(means: DataFrame, kappa: float) -> DataFrame:
    """One row (threshold) from one row per frame (frame, mean): mean plus kappa deviations of the clipped means."""

    def clip(rows: pd.DataFrame) -> pd.DataFrame:
        x = rows["mean"].to_numpy(float)
        x = x[np.isfinite(x)]
        for _ in range(5):
            if x.std() == 0:
                break
            x = x[np.abs(x - np.median(x)) < kappa * x.std()]
        return pd.DataFrame({"threshold": [float(x.mean() + kappa * x.std())]})

    return means.withColumn("__all", F.lit(1)).groupBy("__all").applyInPandas(clip, "threshold double")


def adaptive_smooth(cube: DataFrame, nx: int, ny: int, model: AdaptiveModel = AdaptiveModel(), tile: int = 16, angles: DataFrame | None = None) -> DataFrame:
    """(frame, x, y, value, smooth, window, variability) of rows (frame, t, x, y, value).

    A pixel's window is short where its variability, on a running scale, is high.  With the metric deviation the first coarse window
    counts in bright frames only, and with `angles` (frame, earth, moon) nothing counts in faint frames free of scattered light, if
    any frame has some.  Frames whose median change is outlying keep their values.  smooth is null where the value is unknown.
    """
    b, per = model.block, max(1, tile // model.block)
    frames = checkpointed(frame_segments(cube, model.gap))
    block = lambda c, n: F.least(F.floor(F.col(c) / b), F.lit(max(0, n // b - 1)))
    placed = cube.select("frame", "x", "y", F.col("value").cast("double").alias("value"), block("x", nx).alias("bx"), block("y", ny).alias("by")).join(frames, "frame")
    placed = placed.withColumns({"tx": F.floor(F.col("bx") / per), "ty": F.floor(F.col("by") / per)})

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["t", "frame"], kind="stable")
        order = rows[["frame", "t", "before", "after"]].drop_duplicates("frame")
        pixels = rows[["x", "y", "bx", "by"]].drop_duplicates(["x", "y"])
        at_t, at_p = pd.Index(order["frame"]).get_indexer(rows["frame"]), pd.MultiIndex.from_frame(pixels[["x", "y"]]).get_indexer(pd.MultiIndex.from_frame(rows[["x", "y"]]))
        a = np.full((len(order), len(pixels)), np.nan)
        a[at_t, at_p] = rows["value"].to_numpy(float)
        t = order["t"].to_numpy(float)
        filled = filled_in_time(t, a)
        blocks = pd.MultiIndex.from_frame(pixels[["bx", "by"]].drop_duplicates())
        block_of = blocks.get_indexer(pd.MultiIndex.from_frame(pixels[["bx", "by"]]))
        whole = ((pixels["x"] // b == pixels["bx"]) & (pixels["y"] // b == pixels["by"])).to_numpy()
        reduced = block_means(filled, block_of, whole) if b > 1 else filled
        found = measures(t, filled, reduced, (bool(order["before"].iloc[0]), bool(order["after"].iloc[-1])), model)
        return pd.DataFrame({
            "segment": rows["segment"].iloc[:1], "frames": [order["frame"].tolist()], "xs": [pixels["x"].tolist()], "ys": [pixels["y"].tolist()], "block_of": [(block_of if b > 1 else np.arange(len(pixels))).tolist()],
            "filled": [filled.ravel()], "known": [np.isfinite(a).ravel()], "measures": [[m.ravel() for m in found]], "sums": [reduced.sum(axis=1)], "n_blocks": [reduced.shape[1]],
        })

    kind = cube.schema["frame"].dataType.simpleString()
    arrays = "segment long, frames array<%s>, xs array<long>, ys array<long>, block_of array<int>, filled array<double>, known array<boolean>, measures array<array<double>>, sums array<double>, n_blocks long" % kind
    tiles = checkpointed(placed.groupBy("segment", "tx", "ty").applyInPandas(gather, arrays))

    per_frame = tiles.select("n_blocks", F.explode(F.arrays_zip("frames", "sums")).alias("f")).groupBy(F.col("f.frames").alias("frame")).agg((F.sum("f.sums") / F.sum("n_blocks")).alias("mean"))
    bright = F.col("mean") > F.col("threshold")
    flags = frames.join(per_frame, "frame").join(F.broadcast(brightness_threshold(per_frame, model.brightness)))  # one row
    calm = F.lit(False)
    if angles is not None:
        free = F.least(F.coalesce("earth", F.lit(float("inf"))), F.coalesce("moon", F.lit(float("inf")))) > model.scatter_angle
        flags = flags.join(angles.select("frame", free.alias("free")), "frame", "left").withColumn("free", F.coalesce("free", F.lit(True)))
        scattered = flags.agg(F.coalesce(F.bool_or(~F.col("free")), F.lit(False)).alias("scattered"))
        flags = flags.join(F.broadcast(scattered))  # one row
        calm = F.col("scattered") & F.col("free") & ~bright
    by_segment = flags.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("frame", F.struct(bright.alias("bright"), calm.alias("calm"))))).alias("flags"))

    values = tiles.select(F.posexplode("measures").alias("scale", "m")).select("scale", F.explode("m").alias("v"))
    wanted = {"deviation": [0.75], "combined": [0.01, 0.99]}.get(model.metric, [])
    limits = None
    for k, p in enumerate(wanted):
        q = stats.quantile(values, ["scale"], "v", p, f"q{k}")
        limits = q if limits is None else limits.join(q, "scale")
    work = tiles.join(by_segment, "segment")
    if limits is None:
        work = work.withColumn("limits", F.lit(None).cast("array<array<double>>"))
    else:
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("scale", F.array(*(f"q{k}" for k in range(len(wanted)))).alias("q")))), lambda s: s["q"])
        work = work.join(F.broadcast(limits.agg(ordered.alias("limits"))))  # one row

    def one(row) -> pd.DataFrame:
        n, p = len(row.frames), len(row.xs)
        filled, known = np.reshape(row.filled, (n, p)).astype(float), np.reshape(row.known, (n, p)).astype(bool)
        parts = [np.reshape(m, (n, -1)).astype(float) for m in row.measures]
        held = dict(row.flags)
        bright, calm = (np.array([bool(held[f][c]) for f in row.frames])[:, None] for c in ("bright", "calm"))
        if model.metric == "deviation":
            scaled = [running_scale(m, model, max(row.limits[i][0], 1e-10)) for i, m in enumerate(parts)]
            scaled[0] = scaled[0] * bright
            variability = norm = np.max([s * ~calm for s in scaled], axis=0)
        else:
            if model.metric == "combined":
                parts = [np.clip((m - lo) / (hi - lo + 1e-30), 0, 1) for m, (lo, hi) in zip(parts, row.limits)]
                parts = [(1 - model.weight) * parts[0] + model.weight * parts[1]]
            variability, norm = parts[0], running_scale(parts[0], model, None)
        block_of = np.asarray(row.block_of, int)
        windows, variability = windows_of(norm, model)[:, block_of], variability[:, block_of]
        at_t, at_p = np.repeat(np.arange(n), p), np.tile(np.arange(p), n)
        return pd.DataFrame({
            "frame": pd.Series([row.frames[i] for i in at_t], dtype=object), "x": np.asarray(row.xs)[at_p], "y": np.asarray(row.ys)[at_p], "filled": filled.ravel(),
            "smooth": smoothed(filled, windows, model).ravel(), "known": known.ravel(), "window": windows.ravel(), "variability": variability.ravel(),
        })

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                yield one(row)

    out = work.mapInPandas(run, f"frame {kind}, x long, y long, filled double, smooth double, known boolean, window int, variability double")
    if model.kappa is not None:
        out = sequence.frame_fallback(checkpointed(out), "frame", "filled", "smooth", model.kappa).drop("smooth").withColumnRenamed("chosen", "smooth")
    shown = lambda c: F.when(F.col("known"), F.col(c))
    return out.select("frame", "x", "y", shown("filled").alias("value"), shown("smooth").alias("smooth"), "window", "variability")
