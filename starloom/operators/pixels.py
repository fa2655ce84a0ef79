"""Pixel planes as rows (x, y, value): dilation, shifts, convolution, background mesh, apertures."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import scalars
from starloom.operators import spatial

OFFSET = tuple[int, int]


def disc(radius: int) -> list[OFFSET]:
    span = range(-radius, radius + 1)
    return [(dx, dy) for dx in span for dy in span if dx * dx + dy * dy <= radius * radius]


def _moved(df: DataFrame, offsets: Sequence[tuple], names: str) -> DataFrame:
    """Every row once per offset; `names` names the parts of an offset after dx and dy."""
    parts = ["dx", "dy", *names.split()]
    rows = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(parts, o))) for o in offsets))
    return df.withColumn("__o", F.explode(rows)).withColumns({"x": F.col("x") + F.col("__o.dx"), "y": F.col("y") + F.col("__o.dy")})


def dilate(marked: DataFrame, footprint: Sequence[OFFSET]) -> DataFrame:
    """The distinct pixels (x, y) that the footprint covers about the marked ones."""
    return _moved(marked.select("x", "y").distinct(), footprint, "").select("x", "y").distinct()


def mosaic(planes: DataFrame, offsets: dict[int, OFFSET]) -> DataFrame:
    """Planes (plane, x, y, value) moved by their offset; where several overlap the last plane's known value stays."""
    at = F.create_map(*(c for k, o in offsets.items() for c in (F.lit(k), F.array(F.lit(o[0]), F.lit(o[1])))))[F.col("plane")]
    moved = planes.where("value is not null").withColumn("__at", at).withColumns({"x": F.col("x") + F.col("__at")[0], "y": F.col("y") + F.col("__at")[1]})
    return moved.where("__at is not null").groupBy("x", "y").agg(F.max_by("value", F.struct("plane", "value")).alias("value"))


def _sums(plane: DataFrame, kernel: dict[OFFSET, float]) -> DataFrame:
    spread = _moved(plane, [(*o, float(w)) for o, w in kernel.items()], "w")
    return spread.groupBy("x", "y").agg(F.sum(F.col("value") * F.col("__o.w")).alias("sum"))


def convolve(plane: DataFrame, kernel: dict[OFFSET, float]) -> DataFrame:
    """Sums of the weighted values that the kernel moves onto each pixel of the plane; values outside it count as 0."""
    return plane.select("x", "y").join(_sums(plane, kernel), ["x", "y"])


def separable(plane: DataFrame, weights: Sequence[float]) -> DataFrame:
    """As `convolve` with the product of `weights` (of odd number) along x and along y, in two passes of their number instead of its square."""
    half = len(weights) // 2
    rows = _sums(plane, {(k - half, 0): w for k, w in enumerate(weights)}).withColumnRenamed("sum", "value")
    return plane.select("x", "y").join(_sums(rows, {(0, k - half): w for k, w in enumerate(weights)}), ["x", "y"])


def gaussian(sigma: float, reach: float = 4.0) -> list[float]:
    half = int(reach * sigma + 0.5)
    weights = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-half, half + 1)]
    return [w / sum(weights) for w in weights]


def mesh_background(plane: DataFrame, block: int) -> DataFrame:
    """(bx, by, level): the median of every block, then the median of the 3 x 3 blocks about each that exist."""
    mesh = plane.groupBy(F.floor(F.col("x") / block).alias("x"), F.floor(F.col("y") / block).alias("y")).agg(F.percentile("value", F.lit(0.5)).alias("level"))
    around = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    smooth = _moved(mesh, around, "").groupBy("x", "y").agg(F.percentile("level", F.lit(0.5)).alias("level"))
    return mesh.select("x", "y").join(smooth, ["x", "y"]).select(F.col("x").alias("bx"), F.col("y").alias("by"), "level")


def aperture_photometry(plane: DataFrame, stars: DataFrame, key: str, radius: float, inner: float, outer: float) -> DataFrame:
    """Per star (key, rx, ry) with a pixel in its aperture: n_pix, the median sky per pixel of the annulus, and flux less n_pix sky."""
    d = F.sqrt(F.pow(F.col("x") - F.col("rx"), 2) + F.pow(F.col("y") - F.col("ry"), 2))
    near = spatial.within(plane, stars, outer).withColumn("__d", d)
    inside, ring = F.col("__d") <= radius, F.col("__d") >= inner
    sums = near.groupBy(key).agg(
        F.sum(F.when(inside, F.col("value"))).alias("total"),
        F.count(F.when(inside, F.col("value"))).alias("n_pix"),
        F.percentile(F.when(ring, F.col("value")), F.lit(0.5)).alias("sky"),
    )
    return sums.where("n_pix > 0").select(key, "n_pix", "sky", (F.col("total") - F.col("n_pix") * F.coalesce("sky", F.lit(0.0))).alias("flux"))


def square_photometry(plane: DataFrame, stars: DataFrame, key: str, target: int, inner: int, outer: int, kappa: float = 3.0, rounds: int = 5) -> DataFrame:
    """Per star (key, rx, ry at whole pixels): flux over a square of `target` pixels a side, the sky in it, and their difference.

    The sky is the clipped median of the pixels between squares of `inner` and `outer` a side.  eflux comes from the plane's
    column `noise` if it has one, else from the clipped sky's deviation.  A star's pixels are few and meet in one group; stars
    at the same place are measured once.
    """
    places = stars.select("rx", "ry").distinct()
    far = lambda half: (F.abs(F.col("x") - F.col("rx")) <= half) & (F.abs(F.col("y") - F.col("ry")) <= half)
    near = spatial.within(plane, places, outer * 0.75).where(far(outer // 2))
    noise = F.col("noise") if "noise" in plane.columns else F.lit(None).cast("double")
    pixels = near.groupBy("rx", "ry").agg(
        F.sum(F.when(far(target // 2), F.col("value"))).alias("flux"),
        F.sqrt(F.sum(F.when(far(target // 2), noise * noise))).alias("__noise"),
        F.sort_array(F.collect_list(F.when(~far(inner // 2), F.col("value").cast("double")))).alias("__sky"),
    )
    for _ in range(rounds):
        pixels = pixels.withColumn("__sky", clipped("__sky", kappa))
    area = target * target
    sky = _median("__sky") * area
    eflux = F.coalesce("__noise", _deviation("__sky") * area)
    found = pixels.select("rx", "ry", "flux", sky.alias("sky"), (F.col("flux") - sky).alias("flux_wo_sky"), eflux.alias("eflux"))
    return stars.select(key, "rx", "ry").join(found, ["rx", "ry"]).drop("rx", "ry")


def _median(values: str) -> Column:
    """Of a sorted array; null of an empty one."""
    n = F.size(values)
    at = lambda i: F.get(F.col(values), i.cast("int"))
    return (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2


def _deviation(values: str) -> Column:
    """Null of an empty array."""
    n = F.nullif(F.size(values), F.lit(0))
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n
    return scalars.bound(mean, lambda m: F.sqrt(F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)) / n))


def clipped(values: str, kappa: float) -> Column:
    """The values of a sorted array within kappa deviations of its median."""
    limits = F.struct(_median(values).alias("middle"), (kappa * _deviation(values)).alias("far"))
    return scalars.bound(limits, lambda s: F.filter(values, lambda v: F.abs(v - s["middle"]) <= s["far"]))


def block_reduce(plane: DataFrame, block: int, nx: int, ny: int) -> DataFrame:
    """(bx, by, total, mean, n) of whole blocks; columns and rows beyond the last whole block are cut off."""
    whole = plane.where((F.col("x") < nx // block * block) & (F.col("y") < ny // block * block))
    cell = [F.floor(F.col(c) / block).cast("long").alias(f"b{c}") for c in ("x", "y")]
    return whole.groupBy(*cell).agg(F.sum("value").alias("total"), F.avg("value").alias("mean"), F.count("value").alias("n"))


def upsample(blocks: DataFrame, block: int, nx: int, ny: int, value: str) -> DataFrame:
    """Every pixel of nx x ny with its block's value; pixels beyond the last block take the last one's."""
    spread = lambda c, n: F.explode(F.sequence(F.col(c) * block, F.when(F.col(c) == n // block - 1, F.lit(n - 1)).otherwise(F.col(c) * block + block - 1)))
    return blocks.withColumn("x", spread("bx", nx)).withColumn("y", spread("by", ny)).select("x", "y", value)


def combine_bands(bands: DataFrame, keys: Sequence[str], value: str, noise: str, weight: str) -> DataFrame:
    """(keys, value, noise): the weighted sum of a pixel's bands over the sum of weights, and its deviation from theirs."""
    w = F.col(weight)
    total = F.sum(F.when(F.col(value).isNotNull(), w))
    mean = F.sum(F.col(value) * w) / F.nullif(total, F.lit(0))
    spread = F.sqrt(F.sum(F.pow(w * F.col(noise), 2))) / F.nullif(total, F.lit(0))
    return bands.groupBy(*keys).agg(mean.alias(value), spread.alias(noise))
