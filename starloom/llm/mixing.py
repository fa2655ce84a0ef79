"""Mixing sources to target weights by a temperature.

Token shares of the sources are raised to an exponent, and an interval of exponents is narrowed down until the mix
meets a target entropy or a repetition limit.  Without a budget the largest source is read once; with one, the normalised
weights share the budget's tokens out.  Each source is read whole as often as its weight asks, which may be not at
all, and once more in part: a prefix, by tokens, of a random permutation of its documents.

The permutation of a source is the order of a 64-bit hash, cut into blocks by its upper bits.  The prefix's last
block is found from the blocks' token sums, and only that block is put in order to find the last hash; all other
rows are decided where they stand.  Tokens are words (runs of characters that are no ASCII white space), or a given column.

Defined cases: a null source is a source of its own; a null or empty text has no tokens, a text of any length is
counted whole; documents without tokens are kept once per whole pass; an empty table gives an empty mix; repeated rows
are rows of their own, but rows that agree in all `identity` columns have one place in the permutation and so
enter the partial pass together; input columns named like the new ones are replaced; there may be any number of sources.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, fresh_name, materialise

SEED = 29
ADDED = ("mix_tokens", "copy_no", "mix_block", "mix_order")


def n_tokens(text: str = "text") -> Column:
    """Words as tokens: runs of characters that are no ASCII white space."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


#: For each exponent a: the sums over sources of p^a and of p^a ln p^a, p being a source's token share.
Sums = Callable[[Sequence[float]], list[tuple[float, float]]]


def sums_of(sizes: Sequence[float]) -> Sums:
    total = sum(sizes)

    def sums(exponents: Sequence[float]) -> list[tuple[float, float]]:
        raised = [[(t / total) ** a for t in sizes] for a in exponents]
        return [(sum(r), sum(x * math.log(x) for x in r)) for r in raised]

    return sums


def sums_of_table(per_source: DataFrame, total: int) -> Sums:
    """The same over rows with a column t, one aggregation for all exponents."""

    def sums(exponents: Sequence[float]) -> list[tuple[float, float]]:
        raised = [F.pow(F.col("t") / F.lit(total), F.lit(float(a))) for a in exponents]
        found = per_source.where("t > 0").agg(*(F.struct(F.sum(r), F.sum(r * F.log(r))).alias(f"s{i}") for i, r in enumerate(raised))).first()
        return [tuple(x) for x in found]

    return sums


def narrow(fits: Callable[[Sequence[float]], list[bool]], bits: int = 60, parts: int = 32) -> float:
    """The least exponent in [0, 1] that fits, or 1: each round halves the interval log2(parts) times."""
    if fits([0.0])[0]:
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(-(-bits // int(math.log2(parts)))):
        points = [low + (high - low) * i / parts for i in range(1, parts)]
        first = next((i for i, ok in enumerate(fits(points)) if ok), None)
        low, high = (low if not first else points[first - 1], points[first]) if first is not None else (points[-1], high)
    return high


def temperature(tokens: dict, repetition: float | None = 2.0, entropy: float | None = None, budget: int | None = None) -> float:
    """The exponent in [0, 1] that is closest to 0 (a flat mix) within the repetition limit, or that meets the entropy."""
    sizes = [t for t in tokens.values() if t > 0]
    return exponent_for(len(sizes), min(sizes, default=1), max(sizes, default=1), sum(sizes), sums_of(sizes), repetition, entropy, budget)


def exponent_for(n: int, least: int, most: int, total: int, sums: Sums, repetition: float | None, entropy: float | None, budget: int | None) -> float:
    if n < 2:
        return 1.0

    def fits(exponents: Sequence[float]) -> list[bool]:
        if entropy is not None:
            return [math.log(s) - e / s <= entropy for s, e in sums(exponents)]
        if repetition is None:
            return [True] * len(exponents)
        if budget is None:  # the largest source is read once, the smallest most often
            return [(most / least) ** (1 - a) <= repetition for a in exponents]
        return [budget * (least / total) ** a / s / least <= repetition for a, (s, _) in zip(exponents, sums(exponents))]

    return narrow(fits)


def passes(tokens: dict, exponent: float, budget: int | None = None) -> dict:
    """How often each source is read: 1 for the largest and more for smaller ones, or what the budget allows."""
    largest, total = max(tokens.values(), default=0), sum(tokens.values())
    if budget is None:
        return {s: (largest / t) ** (1 - exponent) if t > 0 else 1.0 for s, t in tokens.items()}
    norm = sum((t / total) ** exponent for t in tokens.values() if t > 0)
    return {s: budget * (t / total) ** exponent / norm / t if t > 0 else 1.0 for s, t in tokens.items()}


def mix(
    df: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    repetition: float | None = 2.0,
    entropy: float | None = None,
    budget: int | None = None,
    tokens: str | None = None,
    identity: Sequence[str] | None = None,
    ordered: bool = False,
    rows_per_block: int = 200_000,
    least_blocks: int = 64,
    seed: int = SEED,
) -> DataFrame:
    """All columns of `df`, one row per copy, plus `copy_no` (int, from 1), `mix_block` (int), `mix_order` (long) and `mix_tokens` (long).

    Sorted by mix_order the copies are the mixed order, and each mix_block is a stretch of it; no sort is forced here, unless
    `ordered` asks for it: then documents are dealt to partitions by their hash, each of them once however many its
    copies, and every partition is a mix of its own, in order.
    """
    size = (F.coalesce(F.col(tokens), F.lit(0)) if tokens else n_tokens(text)).cast("long")
    df = df.select("*", size.alias(name := fresh_name(df, "size"))).drop(*(c for c in ADDED if c != tokens))
    h, block, s, b, cut, times, part, upto, before = (fresh_name(df, x) for x in ("h", "block", "s", "b", "cut", "times", "part", "upto", "before"))
    rows = df.withColumn(h, F.xxhash64(F.lit(seed), *(identity or (key, text))))
    slim = materialise(rows.select(F.col(source).alias(s), h, F.col(name).alias("size")))  # texts are read once for it
    per_source = materialise(slim.groupBy(s).agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("n")))
    positive = F.when(F.col("t") > 0, F.col("t"))
    n, least, most, total, rows_most = per_source.agg(F.count(positive), F.min(positive), F.max(positive), F.sum(positive), F.max("n")).first()
    bits = max(1, math.ceil(math.log2(max(least_blocks, (rows_most or 0) / rows_per_block))))
    place = lambda x: (F.shiftright(x, 64 - bits) + (1 << (bits - 1))).cast("int")
    sums = sums_of_table(per_source, total or 1)
    exponent = exponent_for(n, least or 1, most or 1, total or 1, sums, repetition, entropy, budget)
    if budget is None:
        reads = F.pow(F.lit(most or 1) / positive, F.lit(1 - exponent))
    else:
        norm = sums([exponent])[0][0] if n else 1.0
        reads = F.lit(float(budget)) * F.pow(positive / F.lit(total or 1), F.lit(exponent)) / F.lit(norm) / positive
    reads = F.coalesce(reads, F.lit(1.0))  # a source without tokens is kept
    plan = per_source.select(s, F.floor(reads).cast("int").alias(times), F.round((reads - F.floor(reads)) * F.col("t")).cast("long").alias(part))
    # the block that each source's partial pass ends in, and the last hash of that block that it holds
    in_block = slim.groupBy(s, place(F.col(h)).alias(b)).agg(F.sum("size").alias("size"))
    in_block = in_block.withColumn(before, F.sum("size").over(Window.partitionBy(s).orderBy(b)) - F.col("size"))
    same = lambda x: F.col(f"x.{s}").eqNullSafe(F.col(f"{x}.{s}"))
    last = in_block.alias("x").join(plan.alias("p"), same("p")).where((F.col(part) > 0) & (F.col(before) <= F.col(part)) & (F.col(part) < F.col(before) + F.col("size")))
    last = last.select(f"x.{s}", b, before, part)
    inside = slim.alias("x").join(last.alias("l"), same("l") & (place(F.col(h)) == F.col(b))).select(f"x.{s}", h, "size", before, part)
    ordered = Window.partitionBy(s).orderBy(h)  # a range: rows of equal hashes stay together
    held = inside.withColumn(upto, F.col(before) + F.sum("size").over(ordered)).where(F.col(upto) <= F.col(part))
    held = held.groupBy(s).agg(F.max(h).alias(cut))
    plan = plan.alias("x").join(last.select(s, b).alias("l"), same("l"), "left").join(held.alias("c"), same("c"), "left").select(f"x.{s}", times, b, cut)
    plan = materialise(plan)  # one row per source; Spark broadcasts it while its size allows
    at = place(F.col(h))
    joined = rows.join(plan, F.col(source).eqNullSafe(F.col(s)))
    partial = F.coalesce((at < F.col(b)) | ((at == F.col(b)) & (F.col(h) <= F.col(cut))), F.lit(False))
    copies = F.col(times) + partial.cast("int")
    if ordered:
        joined = joined.where(copies > 0).repartition(at)
    out = joined.withColumn("copy_no", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies))))
    order = F.xxhash64(F.lit(seed + 1), F.col(h), F.col("copy_no"))
    out = out.withColumns({"mix_block": place(order), "mix_order": order, "mix_tokens": F.col(name)})
    kept = [c for c in df.columns if c != name and c not in ADDED]
    out = out.select(*kept, *ADDED)
    return out.sortWithinPartitions("mix_order") if ordered else out
