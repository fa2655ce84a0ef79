"""Joins by distance: both sides fall into square cells, only neighbouring cells meet.

Rows at the same place are joined once, as one place.  Copies of a row for the cells about it are never broadcast: Spark
judges them by their table's files, which may be a small part of them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import checkpointed

#: Pairs of places that a join by cells may look at, per place.
PAIRS = 64


def _cells(df: DataFrame, x: str, y: str, side: float, around: bool, reach: int = 1) -> DataFrame:
    cx, cy = F.floor(F.col(x) / side), F.floor(F.col(y) / side)
    if not around:
        return df.withColumn("__cx", cx).withColumn("__cy", cy)
    near = lambda c: F.explode(F.sequence(c - reach, c + reach))
    return df.withColumn("__cx", near(cx)).withColumn("__cy", near(cy)).hint("merge")


def _square(x: str, y: str, rx: str, ry: str) -> Column:
    return F.pow(F.col(x) - F.col(rx), 2) + F.pow(F.col(y) - F.col(ry), 2)


def within(left: DataFrame, right: DataFrame, radius: float, how: str = "inner") -> DataFrame:
    """Rows of `left` (x, y) with rows of `right` (rx, ry) at a distance of at most `radius`; `right` should be the smaller side.

    how: inner, left_semi or left_anti.
    """
    right = right if how == "inner" else right.select("rx", "ry").distinct()
    a, b = _cells(left, "x", "y", radius, False), _cells(right, "rx", "ry", radius, True)
    b = b.withColumnsRenamed({"__cx": "__rx", "__cy": "__ry"})
    on = (F.col("__cx") == F.col("__rx")) & (F.col("__cy") == F.col("__ry")) & (_square("x", "y", "rx", "ry") <= radius * radius)
    return a.join(b, on, how).drop("__cx", "__cy", "__rx", "__ry")


def _placed(x: str, y: str) -> Column:
    return (F.abs(F.col(x)) < float("inf")) & (F.abs(F.col(y)) < float("inf"))


def first_radius(left: DataFrame, right: DataFrame, radius: float) -> float:
    """At most `radius`, and so small that a join of left places (x, y) with right ones (rx, ry) looks at a bounded number of pairs a place."""
    limit = PAIRS * (left.count() + right.count())
    for _ in range(60):
        ours, theirs = _cells(left, "x", "y", radius, False), _cells(right, "rx", "ry", radius, True)
        counts = [df.groupBy("__cx", "__cy").agg(F.count(F.lit(1)).cast("double").alias(n)) for df, n in ((ours, "n"), (theirs, "m"))]
        pairs = counts[0].join(counts[1], ["__cx", "__cy"]).agg(F.sum(F.col("n") * F.col("m"))).first()[0] or 0.0
        if pairs <= limit:
            break
        radius /= 2 ** max(1, math.floor(math.log2(pairs / limit) / 2))
    return radius


def nearest(left: DataFrame, right: DataFrame, radius: float, key: str, right_key: str) -> DataFrame:
    """Rows of `left` (unique by `key`) with the nearest `right_key` at any distance, ties to the least; null only without places.

    Places are matched, not rows.  `radius` is only where the first one is sought, by `first_radius`; it is doubled for the places still
    without a match until none is left.  A place far from all others meets those of the cells about it, however many they are.
    """
    known = right.where(_placed("rx", "ry") & F.col(right_key).isNotNull())
    tiles = checkpointed(known.groupBy("rx", "ry").agg(F.min(right_key).alias(right_key)))
    todo = checkpointed(left.where(_placed("x", "y")).select("x", "y").distinct())
    found = []
    radius = first_radius(todo, tiles, radius)
    while not tiles.isEmpty() and not todo.isEmpty():
        pairs = within(todo, tiles, radius).withColumn("__d", _square("x", "y", "rx", "ry"))
        best = checkpointed(pairs.groupBy("x", "y").agg(F.min_by(right_key, F.struct("__d", right_key)).alias(right_key)))
        found.append(best)
        todo = checkpointed(todo.join(best, ["x", "y"], "left_anti"))
        radius *= 2
    if not found:
        return left.withColumn(right_key, F.lit(None).cast(right.schema[right_key].dataType))
    return left.join(reduce(DataFrame.unionByName, found), ["x", "y"], "left").select(*left.columns, right_key)


def greedy_thin(points: DataFrame, key: str, brightness: str, radius: float) -> DataFrame:
    """Points (key, x, y, brightness) kept when taken from the brightest on, each at more than `radius` from all kept before; ties go to the least key.

    Rounds instead of a sequence, with the same result.  Any two points of a cell are neighbours, so a cell keeps one point at
    most, and only the first undecided point of each can be the next: it is kept if no undecided neighbour comes before it, and its
    neighbours go.  Pairs of neighbours are never written down: a round compares points with the few first ones about them.
    The number of rounds is the length of the longest chain of ever fainter first points, at most the number of cells.
    """
    rank = F.struct((-F.col(brightness)).alias("b"), F.col(key).alias("k")).alias("rank")
    side, reach = radius / math.sqrt(2) * (1 - 1e-9), 2
    at = ["__cx", "__cy"]
    width = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = F.coalesce(_placed("x", "y"), F.lit(False))
    kept = checkpointed(points.where(~placed).select(rank))  # without a place, without neighbours
    undecided = checkpointed(_cells(points.where(placed).select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), rank), "x", "y", side, False))
    near = _square("x", "y", "rx", "ry") <= radius * radius
    while not undecided.isEmpty():
        first = undecided.groupBy(*at).agg(F.min(F.struct("rank", "x", "y")).alias("p"))
        first = checkpointed(first.select(F.col("p.rank").alias("first"), F.col("p.x").alias("rx"), F.col("p.y").alias("ry")))
        about = _cells(first, "rx", "ry", side, True, reach).withColumnsRenamed({"__cx": "__rx", "__cy": "__ry"})
        met = (F.col("__cx") == F.col("__rx")) & (F.col("__cy") == F.col("__ry")) & near
        blocked = about.join(undecided, met & (F.col("rank") < F.col("first")), "left_semi").select("first").distinct()
        new = checkpointed(first.join(blocked, "first", "left_anti"))
        kept = checkpointed(kept.union(new.select("first")).coalesce(width))
        gone = _cells(new, "rx", "ry", side, True, reach).withColumnsRenamed({"__cx": "__rx", "__cy": "__ry"})
        undecided = checkpointed(undecided.join(gone, met, "left_anti"))
    return points.join(kept.select(F.col("rank.k").alias(key)), key, "left_semi")
