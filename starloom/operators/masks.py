"""Pixel masks from star catalogues, detector straps and coverage, as rows (x, y, mask)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import wcs

#: The mask's bits.
CATALOGUE, SATURATED, STRAP, EDGE, COVERAGE = 1, 2, 4, 8, 16
#: Stars down to the first and over the second magnitude are covered by a square of so many pixels.
SQUARES = [
    (18.0, 17.0, 3), (17.0, 16.0, 4), (16.0, 15.0, 5), (15.0, 14.0, 6), (14.0, 13.5, 7),
    (13.5, 12.0, 8), (12.0, 10.0, 10), (10.0, 9.0, 14), (9.0, 8.0, 16), (8.0, 7.0, 18),
]
#: Fixed values: (magnitude up to, body radius, cross length, cross half width) of bright stars, which begin below BRIGHT.
BRIGHT = 7.0
CROSSES = [(4.0, 22, 115, 7), (5.0, 15, 60, 5), (BRIGHT, 13, 20, 3)]


def placed(stars: DataFrame, nx: int, ny: int) -> DataFrame:
    """Stars at whole pixels strictly inside the plane."""
    at = stars.withColumns({"x": F.rint("x").cast("int"), "y": F.rint("y").cast("int")})
    return at.where(wcs.strictly_inside(F.col("x"), F.col("y"), nx, ny))


def spread(df: DataFrame, dx: tuple[Column, Column], dy: tuple[Column, Column], nx: int, ny: int) -> DataFrame:
    """Every pixel of the plane between offsets (both ends) about each row."""
    inside = lambda c, lo, hi, n: F.sequence(F.greatest(F.col(c) + lo, F.lit(0)), F.least(F.col(c) + hi, F.lit(n - 1)))
    some = (F.col("x") + dx[1] >= 0) & (F.col("x") + dx[0] < nx) & (F.col("y") + dy[1] >= 0) & (F.col("y") + dy[0] < ny)
    wide = df.where(some).withColumn("__px", F.explode(inside("x", *dx, nx)))
    return wide.withColumn("__py", F.explode(inside("y", *dy, ny)))


def star_squares(stars: DataFrame, nx: int, ny: int, scale: float = 1.0) -> DataFrame:
    """(x, y) of the pixels that the squares of stars (x, y, mag) cover."""
    mag = F.col("mag")
    size = F.lit(None).cast("int")
    for faint, bright, n in SQUARES:
        size = F.when((mag > bright) & (mag <= faint), int(n * scale)).otherwise(size)
    sized = placed(stars, nx, ny).withColumn("__n", size).where("__n > 0")
    half = F.floor((F.col("__n") - 1) / 2).cast("int"), F.floor(F.col("__n") / 2).cast("int")
    covered = spread(sized, (-half[0], half[1]), (-half[0], half[1]), nx, ny)
    return covered.select(F.col("__px").alias("x"), F.col("__py").alias("y")).distinct()


def star_crosses(stars: DataFrame, nx: int, ny: int, scale: float = 1.0) -> DataFrame:
    """(x, y) of the pixels under the bodies and crosses of bright stars."""
    mag = F.col("mag")
    shape = F.lit(None)
    for most, *sizes in reversed(CROSSES):
        upto = mag < most if most == BRIGHT else mag <= most
        shape = F.when(upto, F.array(*(F.lit(int(s * scale)) for s in sizes))).otherwise(shape)
    bright = placed(stars.where(mag < BRIGHT), nx, ny).withColumn("__s", shape)
    body, length, width = (F.col("__s")[i] for i in range(3))
    pixel = [F.col("__px").alias("x"), F.col("__py").alias("y")]
    disc = spread(bright, (-body, body), (-body, body), nx, ny)
    near = F.pow(F.col("__px") - F.col("x"), 2) + F.pow(F.col("__py") - F.col("y"), 2) <= F.pow(body + 1, 2)
    bars = [spread(bright, (-a, a - 1), (-b, b - 1), nx, ny).select(*pixel) for a, b in ((width, length), (length, width))]
    return disc.where(near).select(*pixel).unionByName(bars[0]).unionByName(bars[1]).distinct()


def strap_columns(straps: DataFrame, column: str, offset: int, nx: int, size: int = 6, first: int = 44) -> DataFrame:
    """x of the plane's columns within a strap; the list counts from the first science column."""
    size = max(1, size)
    half = (size if size % 2 else size + 1) // 2
    at = straps.select((F.col(column) - offset + first).cast("int").alias("x")).where((F.col("x") > 0) & (F.col("x") < nx))
    wide = at.select(F.explode(F.sequence(F.col("x") - half, F.col("x") + half)).alias("x"))
    return wide.where((F.col("x") >= 0) & (F.col("x") < nx)).distinct()


def catalogue_mask(grid: DataFrame, stars: DataFrame, bright: DataFrame | None, straps: DataFrame | None, nx: int, ny: int, limit: float = 13.0, scale: float = 1.0, strap_column: str = "column", offset: int = 0, strap_size: int = 6) -> DataFrame:
    """`grid` (x, y) with `mask`: CATALOGUE for squares of stars above the limit, SATURATED for crosses (of `bright`'s as well), STRAP."""
    some = stars.where(F.col("mag") < limit).select("x", "y", "mag")
    crossed = some if bright is None else some.unionByName(bright.select("x", "y", F.col("vmag").alias("mag")))
    parts = [star_squares(some, nx, ny, scale).withColumn("bit", F.lit(CATALOGUE)), star_crosses(crossed, nx, ny, scale).withColumn("bit", F.lit(SATURATED))]
    bits = parts[0].unionByName(parts[1]).groupBy("x", "y").agg(F.bit_or("bit").alias("bits"))
    out = grid.join(bits, ["x", "y"], "left").withColumn("mask", F.coalesce("bits", F.lit(0))).drop("bits")
    if straps is None or strap_size <= 0:
        return out
    columns = strap_columns(straps, strap_column, offset, nx, strap_size).withColumn("strap", F.lit(STRAP))  # at most nx rows
    return out.join(F.broadcast(columns), "x", "left").withColumn("mask", F.col("mask").bitwiseOR(F.coalesce("strap", F.lit(0)))).drop("strap")


def with_edges_and_coverage(mask: DataFrame, x_min: int, y_min: int, nx: int, ny: int, counts: DataFrame | None = None, least: int = 1) -> DataFrame:
    """Adds EDGE for the chip's dead columns and rows, and COVERAGE where `counts` (x, y, n) has fewer hits than `least`."""
    edge = F.when(wcs.detector_edge(F.col("x") + x_min, F.col("y") + y_min, nx, ny), EDGE).otherwise(0)
    out = mask.withColumn("mask", F.col("mask").bitwiseOR(edge))
    if counts is None:
        return out
    short = counts.where(F.col("n") < least).select("x", "y", F.lit(COVERAGE).alias("short"))
    return out.join(short, ["x", "y"], "left").withColumn("mask", F.col("mask").bitwiseOR(F.coalesce("short", F.lit(0)))).drop("short")


def combined(masks: DataFrame, keys: Sequence[str], mask: Column) -> DataFrame:
    """(keys, mask): all bits that are set in any row of a pixel."""
    return masks.groupBy(*keys).agg(F.bit_or(mask).alias("mask"))


def pixel_sums(values: DataFrame, pixel: str, value: str, mask: str, ignored: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, pixel, total, n, n_masked): sums per mapped pixel (from 0 on) of values without an ignored bit; partial sums merge by `merge_sums`."""
    bits = sum(1 << b for b in ignored)
    bad = F.col(mask).bitwiseAND(F.lit(bits)) != 0
    mapped = values.where(F.col(pixel) >= 0)
    return mapped.groupBy(*keys, pixel).agg(F.sum(F.when(~bad, F.col(value))).alias("total"), F.count(F.when(~bad, F.col(value))).alias("n"), F.count_if(bad).alias("n_masked"))


def merge_sums(parts: DataFrame, pixel: str, keys: Sequence[str] = ()) -> DataFrame:
    return parts.groupBy(*keys, pixel).agg(*(F.sum(c).alias(c) for c in ("total", "n", "n_masked")))
