"""Closeness and overlap on the sphere, the same at the poles and across 0/360 degrees.

Positions become unit vectors, and cells are cubes of space, so that neighbours are found by an equality join without a seam or a pole.
Polygons are convex, smaller than a half sphere, with straight (great circle) edges; overlaps are clipped in the tangent plane of the region
asked about, where great circles are straight lines.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import wcs
from starloom.session import checkpointed


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def separation(u: Sequence[Column], v: Sequence[Column]) -> Column:
    """Degrees between unit vectors, by their chord, which is exact for small angles too."""
    chord = F.sqrt(sum(((a - b) * (a - b) for a, b in zip(u, v)), F.lit(0.0)))
    return F.degrees(2 * F.asin(F.least(F.lit(1.0), chord / 2)))


def within_degrees(left: DataFrame, right: DataFrame, radius: float, name: str = "distance") -> DataFrame:
    """Rows of `left` (ra, dec) with rows of `right` (other_ra, other_dec) at most `radius` degrees away, and the distance; `right` should be the smaller side.

    Rows without a position meet nothing.  Positions are compared, not rows; the pairs of rows at a pair of positions are then joined to it.
    """
    if not 0 < radius < 180:
        raise ValueError("the radius is between 0 and 180 degrees")
    side = 2 * math.sin(math.radians(radius) / 2) * (1 + 1e-9) + 1e-12
    cells = lambda parts: [F.floor(p / side) for p in parts]
    ours, theirs = unit_vector(F.col("ra"), F.col("dec")), unit_vector(F.col("other_ra"), F.col("other_dec"))
    a = left.select("ra", "dec").distinct().withColumns({"__u": F.array(*ours)} | {f"__c{i}": c for i, c in enumerate(cells(ours))})
    b = right.select("other_ra", "other_dec").distinct().withColumn("__v", F.array(*theirs))
    for i, c in enumerate(cells(theirs)):
        b = b.withColumn(f"__d{i}", F.explode(F.sequence(c - 1, c + 1)))
    near = a.join(b.hint("merge"), [F.col(f"__c{i}") == F.col(f"__d{i}") for i in range(3)])  # Spark takes b for smaller than it is
    parts = lambda c: [F.col(c)[i] for i in range(3)]
    pairs = near.withColumn(name, separation(parts("__u"), parts("__v"))).where(F.col(name) <= radius).select("ra", "dec", "other_ra", "other_dec", name)
    return left.join(checkpointed(pairs), ["ra", "dec"]).join(right, ["other_ra", "other_dec"]).select(*left.columns, *right.columns, name)


def summed(corners: Column) -> list[Column]:
    """The sum of the corners' unit vectors."""

    def part(k: int) -> Column:
        return F.aggregate(corners, F.lit(0.0), lambda s, c: s + unit_vector(c["ra"], c["dec"])[k])

    return [part(k) for k in range(3)]


def in_polygon(ra: Column, dec: Column, corners: Column) -> Column:
    """Does the convex polygon of corners, an array of struct(ra, dec) in either sense of turning, hold the position?  Edges belong to it."""
    p = unit_vector(ra, dec)

    def side(a: Column, b: Column) -> Column:
        u, v = unit_vector(a["ra"], a["dec"]), unit_vector(b["ra"], b["dec"])
        normal = (u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0])
        return sum((n * x for n, x in zip(normal, p)), F.lit(0.0))

    n = F.size(corners)
    sides = F.transform(corners, lambda c, i: side(c, F.element_at(corners, ((i + 1) % n + 1).cast("int"))))
    near = sum((m * x for m, x in zip(summed(corners), p)), F.lit(0.0)) > 0  # not the polygon's opposite on the sphere
    return near & (F.forall(sides, lambda s: s >= -1e-15) | F.forall(sides, lambda s: s <= 1e-15))


def in_plane(corners: Column, ra0: Column, dec0: Column) -> Column:
    """Corners as struct(x, y) in degrees about a point; a corner on the far side makes the whole null."""
    placed = F.transform(corners, lambda c: F.struct(*(v.alias(n) for v, n in zip(wcs.tangent_plane_of(c["ra"], c["dec"], ra0, dec0), ("x", "y")))))
    return F.when(F.forall(placed, lambda p: p["x"].isNotNull()), placed)


def area(polygon: Column) -> Column:
    """Of an array of struct(x, y), positive where it turns to the left."""
    n = F.size(polygon)
    terms = F.transform(polygon, lambda p, i: F.struct(p.alias("p"), F.element_at(polygon, ((i + 1) % n + 1).cast("int")).alias("q")))
    return F.when(n > 2, F.aggregate(terms, F.lit(0.0), lambda s, t: s + t["p"]["x"] * t["q"]["y"] - t["q"]["x"] * t["p"]["y"]) / 2).otherwise(0.0)


def clipped(polygon: Column, window: Column) -> Column:
    """The part of a polygon inside a convex window, both arrays of struct(x, y): cut by one edge of the window after the other."""
    turned = F.when(area(window) < 0, F.reverse(window)).otherwise(window)
    n = F.size(turned)
    edges = F.transform(turned, lambda p, i: F.struct(p.alias("a"), F.element_at(turned, ((i + 1) % n + 1).cast("int")).alias("b")))

    def cut(points: Column, e: Column) -> Column:
        a, b = e["a"], e["b"]
        side = lambda p: (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])
        m = F.size(points)

        def crossing(p: Column, q: Column) -> Column:
            t = side(p) / (side(p) - side(q))
            return F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))

        def from_before(q: Column, i: Column) -> Column:
            p = F.element_at(points, ((i + m - 1) % m + 1).cast("int"))
            inside, came = side(q) >= 0, side(p) >= 0
            return F.when(inside & came, F.array(q)).when(inside, F.array(crossing(p, q), q)).when(came, F.array(crossing(p, q))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))

        return F.flatten(F.transform(points, from_before))

    return F.aggregate(edges, polygon, cut)


def centre(corners: Column) -> tuple[Column, Column]:
    """ra (0 to 360) and dec of the corners' mean vector."""
    x, y, z = summed(corners)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.atan2(z, F.hypot(x, y)))


def padding_candidates(regions: DataFrame, cells: DataFrame, width: float = 0.4) -> DataFrame:
    """(region, cell, coverage, distance, part, whole) of cells (cell, corners) that cover some of regions (region, target, corners), but for the target itself.

    Candidates are cells whose centre is within half a cell's diagonal of the region's; coverage is in per cent of the region's area.
    """
    ra, dec = centre(F.col("corners"))
    asked = regions.select("region", "target", "corners", ra.alias("ra"), dec.alias("dec"))
    other = cells.select("cell", F.col("corners").alias("cell_corners"), ra.alias("other_ra"), dec.alias("other_dec"))
    near = within_degrees(other.select("cell", "cell_corners", F.col("other_ra").alias("ra"), F.col("other_dec").alias("dec")), asked.withColumnsRenamed({"ra": "other_ra", "dec": "other_dec"}), width / 2 * math.sqrt(2))
    near = near.where(F.col("cell") != F.col("target"))
    flat = lambda c: in_plane(F.col(c), F.col("other_ra"), F.col("other_dec"))
    # written down, as Spark would else repeat each expression wherever the next one reads it
    placed = checkpointed(near.select("region", "cell", "distance", flat("corners").alias("whole"), flat("cell_corners").alias("window")))
    parts = checkpointed(placed.where("window IS NOT NULL").withColumn("part", clipped(F.col("whole"), F.col("window"))))
    share = 100 * F.abs(area(F.col("part"))) / F.abs(area(F.col("whole")))
    return parts.withColumn("coverage", share).where("coverage > 1e-9").select("region", "cell", "coverage", "distance", "part", "window", "whole")


def best_padding(regions: DataFrame, cells: DataFrame, width: float = 0.4, full: float = 99.9) -> DataFrame:
    """(region, status, best, coverage, distance, pairs): the cell that covers most of each region, the nearest of equals.

    status: full_coverage, combined_coverage where pairs of cells cover it together (`pairs`, by their mean distance), partial_coverage or
    no_overlap.  A region has the few candidates that lie about it.
    """
    found = padding_candidates(regions, cells, width)
    order = F.struct((-F.col("coverage")).alias("c"), "distance", "cell")
    best = found.groupBy("region").agg(F.min(order).alias("b"))
    best = best.select("region", F.col("b.cell").alias("best"), (-F.col("b.c")).alias("coverage"), F.col("b.distance").alias("distance"))
    some = found.join(best.where(F.col("coverage") < full).select("region"), "region", "left_semi")
    one = some.select("region", F.col("cell").alias("a"), F.col("coverage").alias("ca"), F.col("distance").alias("da"), "part", "whole")
    two = some.select("region", F.col("cell").alias("b"), F.col("coverage").alias("cb"), F.col("distance").alias("db"), "window")
    both = one.join(two, "region").where(F.col("a") < F.col("b"))
    together = F.col("ca") + F.col("cb") - 100 * F.abs(area(clipped(F.col("part"), F.col("window")))) / F.abs(area(F.col("whole")))
    pairs = both.withColumn("together", together).where(F.col("together") >= full)
    pairs = pairs.groupBy("region").agg(F.sort_array(F.collect_list(F.struct(((F.col("da") + F.col("db")) / 2).alias("mean_distance"), "a", "b", F.col("together").alias("coverage")))).alias("pairs"))
    out = regions.select("region").join(best, "region", "left").join(pairs, "region", "left")
    status = F.when(F.col("best").isNull(), "no_overlap").when(F.col("coverage") >= full, "full_coverage").when(F.col("pairs").isNotNull(), "combined_coverage").otherwise("partial_coverage")
    return out.select("region", status.alias("status"), "best", F.coalesce("coverage", F.lit(0.0)).alias("coverage"), "distance", "pairs")
