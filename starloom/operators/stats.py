"""Clipped, robust and masked aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import checkpointed


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where a null key equals a null key; the left side's keys stay."""
    other = right.select(*(F.col(c).alias(f"__right_{c}") if c in keys else F.col(c) for c in right.columns))
    on = [left[k].eqNullSafe(other[f"__right_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*(f"__right_{k}" for k in keys))


def ranked(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, __x, __n, __upto): the distinct known values of each key, their numbers of rows, and the rows up to each in order.

    Equal values are counted before they move, the distinct ones are dealt by range over many tasks, and what lies before a
    task's values comes from one row per key and task: no key is in one task, and no task holds a column.
    """
    x = F.col(value).cast("double")
    return in_order(df.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, x.alias("__x")).agg(F.count(F.lit(1)).alias("__n")), keys)


def in_order(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds __upto to rows (keys, __x, __n) of distinct values."""
    dealt = checkpointed(counts.repartitionByRange(*keys, "__x").withColumn("__part", F.spark_partition_id()))
    sums = dealt.groupBy(*keys, "__part").agg(F.sum("__n").alias("__s"))
    before = F.sum("__s").over(Window.partitionBy(*keys).orderBy("__part")) - F.col("__s")
    inside = F.sum("__n").over(Window.partitionBy(*keys, "__part").orderBy("__x"))
    both = join_keys(dealt, sums.withColumn("__before", before).drop("__s"), [*keys, "__part"])
    return checkpointed(both.withColumn("__upto", inside + F.col("__before")).drop("__part", "__before"))


def quantile_of(values: DataFrame, keys: Sequence[str], p: float, name: str) -> DataFrame:
    """(keys, name) of `ranked` rows or an interval of them: linear between the two nearest ranks."""
    ends = values.groupBy(*keys).agg(F.min(F.col("__upto") - F.col("__n")).alias("__first"), F.max("__upto").alias("__last"))
    place = F.lit(p) * (F.col("__last") - F.col("__first") - 1) + F.col("__first")
    holds = lambda rank: F.when((F.col("__upto") > rank) & (F.col("__upto") - F.col("__n") <= rank), F.col("__x"))
    found = join_keys(values, ends, keys).groupBy(*keys).agg(F.max(place).alias("__p"), F.max(holds(F.floor(place))).alias("__a"), F.max(holds(F.ceil(place))).alias("__b"))
    return found.select(*keys, (F.col("__a") + (F.col("__b") - F.col("__a")) * (F.col("__p") - F.floor("__p"))).alias(name))


def quantile(df: DataFrame, keys: Sequence[str], value: str, p: float = 0.5, name: str = "median") -> DataFrame:
    """Exact quantiles of keys with any number of rows; nulls and NaN don't count."""
    return quantile_of(ranked(df, keys, value), keys, p, name)


def sigma_clip(df: DataFrame, keys: Sequence[str], value: str, kappa: float = 3.0, rounds: int = 5) -> DataFrame:
    """Per key the bounds (lo, hi) after `rounds` of clipping at median +- kappa population deviations.

    The values are ranked once; each round reads them twice, for the median and the deviation between the last bounds.
    NaN counts as missing.
    """
    return clip_ranked(ranked(df, keys, value), keys, kappa, rounds).withColumnsRenamed({"__lo": "lo", "__hi": "hi"})


def clip_ranked(values: DataFrame, keys: Sequence[str], kappa: float, rounds: int) -> DataFrame:
    bounds, left = None, values
    for _ in range(rounds):
        if bounds is not None:
            left = join_keys(values, bounds, keys).where(F.col("__x").between(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
        middle = quantile_of(left, keys, 0.5, "__m")
        away = F.col("__x") - F.col("__m")  # sums about the median lose no digits
        n, s, s2 = F.sum("__n"), F.sum(F.col("__n") * away), F.sum(F.col("__n") * away * away)
        spread = join_keys(left, middle, keys).groupBy(*keys).agg(F.max("__m").alias("__m"), F.sqrt(F.greatest(s2 / n - F.pow(s / n, 2), F.lit(0.0))).alias("__s"))
        bounds = checkpointed(spread.select(*keys, (F.col("__m") - kappa * F.col("__s")).alias("__lo"), (F.col("__m") + kappa * F.col("__s")).alias("__hi")))
    return bounds


def sigma_clip_mean(df: DataFrame, keys: Sequence[str], value: str, kappa: float = 3.0, rounds: int = 5) -> DataFrame:
    values = ranked(df, keys, value)
    inside = join_keys(values, clip_ranked(values, keys, kappa, rounds), keys).where(F.col("__x").between(F.col("__lo"), F.col("__hi")))
    return inside.groupBy(*keys).agg((F.sum(F.col("__x") * F.col("__n")) / F.sum("__n")).alias("clipped_mean"), F.sum("__n").alias("n"))


def robust_scale(mad: Column, median: Column) -> Column:
    """1.4826 MAD, and never quite 0."""
    return 1.4826 * F.greatest(mad, 1e-12 * (1 + F.abs(median)))


def robust_sigma(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, median, sigma) with a sigma of 1.4826 MAD, for keys with any number of rows."""
    values = ranked(df, keys, value)
    middle = checkpointed(quantile_of(values, keys, 0.5, "__median"))
    away = join_keys(values, middle, keys).select(*keys, F.abs(F.col("__x") - F.col("__median")).alias("__d"), F.col("__n").alias("__times"))
    # the distances have an order of their own
    again = in_order(away.groupBy(*keys, "__d").agg(F.sum("__times").alias("__n")).withColumnRenamed("__d", "__x"), keys)
    mad = quantile_of(again, keys, 0.5, "__mad")
    return join_keys(middle, mad, keys).select(*keys, F.col("__median").alias("median"), robust_scale(F.col("__mad"), F.col("__median")).alias("sigma"))


def one_pass_clip(df: DataFrame, keys: Sequence[str], value: str, kappa: float) -> DataFrame:
    """Rows within mean +- kappa deviations of their key."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    return join_keys(df, stats, keys).where(F.abs(F.col(value) - F.col("__m")) <= kappa * F.col("__s")).drop("__m", "__s")


def masked_sums(df: DataFrame, keys: Sequence[str], value: str, masked: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(F.when(~masked, F.col(value))).alias("total"),
        F.count(F.when(~masked, F.col(value))).alias("n"),
        F.count(F.when(masked, F.lit(1))).alias("n_masked"),
    )


def snap_groups(df: DataFrame, steps: dict[str, float]) -> DataFrame:
    """Cells of the grid that values snap to (half to even), with their sizes; `steps` gives each column's step."""
    return df.groupBy(*((F.rint(F.col(c) / s) * s).alias(f"{c}_cell") for c, s in steps.items())).agg(F.count(F.lit(1)).alias("n"))


def binned_clip(df: DataFrame, keys: Sequence[str], t: str, value: str, width: float, kappa: float) -> DataFrame:
    """(keys, bin, t_mean, v_mean, n) over equal time bins from each key's first time.

    Bins of three rows or more, missing values included, drop values over kappa robust deviations off their median; means of a bin that
    loses all are null.  Medians come from ranks (see `ranked`), so a bin of any number of rows is dealt over many tasks.
    """
    start = df.groupBy(*keys).agg(F.min(t).alias("__t0"))
    bin_of = F.floor((F.col(t) - F.col("__t0")) / width).alias("__bin")
    rows = checkpointed(join_keys(df, start, keys).select(*keys, bin_of, F.col(t).alias("__t"), F.col(value).cast("double").alias("__v")))
    by = [*keys, "__bin"]
    sized = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__k"))
    scales = robust_sigma(rows, by, "__v").withColumnsRenamed({"median": "__m", "sigma": "__s"})
    bounds = join_keys(sized, scales, by, "left")
    inside = F.col("__v").isNotNull() & ((F.col("__k") < 3) | (F.abs(F.col("__v") - F.col("__m")) <= kappa * F.col("__s")))
    kept = lambda c: F.when(inside, F.col(c))
    out = join_keys(rows, bounds, by).groupBy(*by).agg(F.avg(kept("__t")).alias("t_mean"), F.avg(kept("__v")).alias("v_mean"), F.count(kept("__v")).alias("n"))
    return out.withColumnRenamed("__bin", "bin")


def vector_median(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """(keys, place, median) of arrays, place by place, for keys with any number of rows; nulls don't count, and a place of nulls has a null."""
    places = df.select(*keys, F.posexplode(vector).alias("__place", "__v"))
    by = [*keys, "__place"]
    found = join_keys(places.groupBy(*by).agg(F.count("__v").alias("__k")), quantile(places, by, "__v"), by, "left")
    return found.select(*keys, F.col("__place").cast("long").alias("place"), "median")


def ratio_to_largest(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the value over the table's largest one."""
    top = df.agg(F.max(value).alias("__top"))  # one row
    return df.join(F.broadcast(top)).withColumn(name, F.col(value) / F.col("__top")).drop("__top")


def positive_clipped_mean(df: DataFrame, value: str, kappa: float = 3.0, rounds: int = 5, name: str = "reference") -> DataFrame:
    """One row: the clipped mean of the positive, finite values of the whole table."""
    rows = df.where((F.col(value) > 0) & (F.col(value) < float("inf"))).select(F.lit(1).alias("__one"), value)
    return sigma_clip_mean(rows, ["__one"], value, kappa, rounds).select(F.col("clipped_mean").alias(name))


def first_seen_groups(df: DataFrame, order: Sequence[str], steps: dict[str, float], valid: Column) -> DataFrame:
    """Adds group_id (from 0 in the order in which a cell is first seen, -1 for rows that aren't valid) and each column's cell, group_<column>."""
    cells = {c: F.round(F.rint(F.col(c) / s) * s, 6) for c, s in steps.items()}
    ok = F.coalesce(valid, F.lit(False))
    for c in steps:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    rows = df.withColumns({f"group_{c}": F.when(ok, cell) for c, cell in cells.items()})
    names = [f"group_{c}" for c in steps]
    # one row per group: groups are pointings, few against frames
    first = rows.where(ok).groupBy(*names).agg(F.min(F.struct(*order)).alias("__first"))
    number = first.withColumn("group_id", (F.row_number().over(Window.orderBy("__first")) - 1).cast("int")).drop("__first")
    return rows.join(number, names, "left").withColumn("group_id", F.coalesce("group_id", F.lit(-1)))
