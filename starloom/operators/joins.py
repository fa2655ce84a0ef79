"""Joins by closeness in one dimension: interpolation between two samples, the best match within a tolerance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators import spatial
from starloom.session import checkpointed


def interpolate_at(wanted: DataFrame, samples: DataFrame, key: str, t: str, value: str, width: float) -> DataFrame:
    """`wanted` with `value` linear between the samples of its key, clamped at both ends; null for a key without samples.

    Windows run per key and time slot of `width`, so that a long series isn't one task; what a slot has to know
    about earlier and later slots comes from one row per slot.  `samples` hold one row per key and time.
    """
    slot = F.floor(F.col(t) / width).alias("__slot")
    known = samples.where(F.col(value).isNotNull()).select(key, t, F.col(value).alias("__v"), slot)
    point = F.struct(F.col(t).alias("t"), F.col("__v").alias("v"))
    ends = known.groupBy(key, "__slot").agg(F.min(point).alias("lo"), F.max(point).alias("hi"))
    slots = ends.unionByName(wanted.select(key, slot).distinct(), allowMissingColumns=True).groupBy(key, "__slot").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    w = Window.partitionBy(key).orderBy("__slot")
    slots = slots.select(
        key, "__slot",
        F.last("hi", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
        F.first("lo", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("__after"),
    )
    both = wanted.select("*", slot, F.lit(True).alias("__asked")).unionByName(known, allowMissingColumns=True)
    seen = F.when(F.col("__v").isNotNull(), point)
    inside = Window.partitionBy(key, "__slot").orderBy(t)  # a range frame: rows of the same time see each other
    both = both.withColumns({
        "__a": F.last(seen, ignorenulls=True).over(inside.rangeBetween(Window.unboundedPreceding, 0)),
        "__b": F.first(seen, ignorenulls=True).over(inside.rangeBetween(0, Window.unboundedFollowing)),
    })
    both = both.where("__asked").join(slots, [key, "__slot"]).withColumns({"__a": F.coalesce("__a", "__before"), "__b": F.coalesce("__b", "__after")})
    a, b = F.col("__a"), F.col("__b")
    between = a["v"] + (b["v"] - a["v"]) * (F.col(t) - a["t"]) / F.nullif(b["t"] - a["t"], F.lit(0.0))
    return both.select(*wanted.columns, F.coalesce(between, a["v"], b["v"]).alias(value))


def best_within(left: DataFrame, right: DataFrame, a: str, b: str, tolerance: float, key: str, prefer: str) -> DataFrame:
    """Every row of `left` (unique by `key`) with the row of `right` that lies nearest within the tolerance; ties go to the least `prefer`.

    Values are matched, not rows: one row of `right` stands for its value.  They meet within a first width that bounds the pairs, which is
    doubled up to the tolerance for the values still without a match.
    """
    on_line = lambda df, c, x, y: df.withColumns({x: F.col(c).cast("double"), y: F.lit(0.0)})
    best = right.where(F.abs(F.col(b)) < float("inf")).groupBy(b).agg(F.min_by(F.struct(*right.columns), F.struct(prefer)).alias("__r"))
    best = checkpointed(on_line(best.select(F.col(f"__r.{prefer}").alias("__p"), "__r", F.col(b).alias("__b")), "__b", "rx", "ry"))
    todo = checkpointed(on_line(left.where(F.abs(F.col(a)) < float("inf")).select(F.col(a).alias("__a")).distinct(), "__a", "x", "y"))
    width, found, away = spatial.first_radius(todo, best, tolerance), [], F.abs(F.col("__a") - F.col("__b"))
    while True:
        pairs = spatial.within(todo, best, width * (1 + 1e-9)).where(away <= width)
        found.append(checkpointed(pairs.groupBy("__a").agg(F.min_by("__r", F.struct(away, "__p")).alias("__r"))))
        if width >= tolerance:
            break
        todo = checkpointed(todo.join(found[-1], "__a", "left_anti"))
        width = min(2 * width, tolerance)
    matched = reduce(DataFrame.unionByName, found)
    return left.join(matched.select(F.col("__a").alias(a), F.col("__r")), a, "left").select(*left.columns, "__r.*")
