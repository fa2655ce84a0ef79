"""Choosing rows: preference, order, upserts, greedy thinning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], largest: bool = False) -> DataFrame:
    """One whole row per key: the first by `order`.  A min_by aggregation, so it combines before the shuffle."""
    rank = F.struct(*(F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)))
    best = (F.max_by if largest else F.min_by)(F.struct(*df.columns), rank)
    return df.groupBy(*keys).agg(best.alias("__row")).select("__row.*")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows of both; per key the newest by `order`, and of equals the one from `new`."""
    both = old.withColumn("__from", F.lit(0)).unionByName(new.withColumn("__from", F.lit(1)))
    return keep_one(both, keys, [order, "__from"], largest=True).drop("__from")


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "value") -> DataFrame:
    """(keys, name): the value of each key's last row by `order`, as where tiles of a mosaic overlap."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


def first_of_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """(keys, name, n): the value of each group's first row by `order`, and the group's size."""
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(name), F.count(F.lit(1)).alias("n"))


def in_box(df: DataFrame, sides: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows whose columns lie in half-open intervals, counted from their lower ends."""
    inside = F.lit(True)
    for c, (lo, hi) in sides.items():
        inside = inside & (F.col(c) >= lo) & (F.col(c) < hi)
    return df.where(inside).withColumns({c: F.col(c) - lo for c, (lo, _) in sides.items()})


def first_valid(df: DataFrame, valid: Column, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first n valid rows by `order`; fewer are an error, raised when the rows are read."""
    rows = df.where(F.coalesce(valid, F.lit(False))).orderBy(*order).limit(n)
    found = rows.agg(F.count(F.lit(1)).alias("__n"))  # one row
    return found.join(rows, how="left").where(F.when(F.col("__n") >= n, True).otherwise(F.raise_error(F.format_string("%d valid rows of " + str(n), "__n")).cast("boolean"))).drop("__n")


def tiered_first(df: DataFrame, tiers: Sequence[Column], order: Sequence[Column | str]) -> DataFrame:
    """The one row in the best tier (the first condition that holds), first by `order`."""
    tier = F.lit(len(tiers))
    for i, t in reversed(list(enumerate(tiers))):
        tier = F.when(t, F.lit(i)).otherwise(tier)
    return df.withColumn("tier", tier).orderBy("tier", *order).limit(1)
