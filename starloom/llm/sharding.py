"""Uniform shuffle into shards with exact sizes by a hypergeometric communication matrix.

Each input partition is sorted by random keys and written down once with every row's place, so that a lost
executor can't change the order.  The driver draws how many rows of each partition go to each shard (a
multivariate hypergeometric, partition by partition, so that the shards get exactly their sizes).  A
partition's permuted rows are dealt out by its row of the matrix; one exchange brings them to their shards, where
they are permuted again, in sub-blocks of bounded size whose offsets come from their counts.  The driver holds
the matrix only: partitions x shards counts.

Defined cases: an empty table gives an empty result; fewer rows than shards leave shards empty; repeated
rows and ties are rows of their own, and null or very long columns are carried along unread; input columns
named shard or slot are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import fresh_name, materialise

#: `monotonically_increasing_id` counts a partition's rows below this bit.
ROW_BITS = 33
#: numpy draws from urns below this size.
SMALL_URN = 10**9


def draw_matrix(part_sizes: list[int], shard_sizes: list[int], seed: int) -> np.ndarray:
    """Counts by partition and shard with these exact margins, distributed as in a uniform shuffle."""
    rng = np.random.default_rng(seed)
    left, out = np.array(shard_sizes, np.int64), np.zeros((len(part_sizes), len(shard_sizes)), np.int64)
    for b, n in enumerate(part_sizes):
        total = int(left.sum())
        for s in range(len(left) - 1):  # one shard after the other: hypergeometric conditionals, exact at any size
            if n == 0:
                break
            good = int(left[s])
            take = n if total == good else good if total == n else draw_one(rng, good, total - good, n)
            out[b, s] = take
            total -= good
            n -= take
        out[b, -1] = n
        left -= out[b]
    return out


def draw_one(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` rows from the urn are good: numpy's draw below a billion rows, inversion above."""
    if good + bad < SMALL_URN:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    share = good / (good + bad)
    reach = int(40 * np.sqrt(n * share * (1 - share))) + 100  # beyond lies less than floating point can hold
    k = np.arange(max(low, mode - reach), min(high, mode + reach), dtype=np.float64)
    # log of P(k + 1) / P(k), summed from the mode to both sides
    ratio = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.append(0.0, np.cumsum(ratio))
    weights = np.exp(logs - logs.max())
    place = np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right")
    return int(max(low, mode - reach)) + int(min(place, len(weights) - 1))


def shard_rows(df: DataFrame, shards: int = 16, seed: int = 17, rows_per_block: int = 500_000) -> DataFrame:
    """All columns of `df`, plus `shard` (int) and `slot` (long, gapless from 0 in each shard)."""
    df = df.drop("shard", "slot")
    key, part, place, ends, sub, offset, number = (fresh_name(df, x) for x in ("key", "part", "place", "ends", "sub", "offset", "number"))
    # 64 bits of a random number and the row's own one: equal keys are next to impossible, and then have the order that is written
    keyed = df.withColumn(key, F.xxhash64(F.rand(seed), F.monotonically_increasing_id())).sortWithinPartitions(key)
    row = F.monotonically_increasing_id()
    keyed = materialise(keyed.withColumns({part: F.shiftright(row, ROW_BITS), place: row.bitwiseAND(F.lit((1 << ROW_BITS) - 1))}))
    sizes = sorted((r[0], r[1]) for r in keyed.groupBy(part).count().collect())  # one count per partition
    n = sum(c for _, c in sizes)
    matrix = draw_matrix([c for _, c in sizes], [n // shards + (s < n % shards) for s in range(shards)], seed)
    rows = [(p, r) for (p, _), r in zip(sizes, np.cumsum(matrix, axis=1).tolist())]
    # Spark broadcasts it only while its size allows
    deal = df.sparkSession.createDataFrame(rows, f"`{number}` long, `{ends}` array<long>")
    dealt = keyed.join(deal, F.col(part) == F.col(number)).withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col(place))).cast("int"))
    subs = max(4, -(-n // (shards * rows_per_block)))
    salted = F.xxhash64(F.col(key), F.lit(seed + 1))
    dealt = dealt.withColumn(sub, F.pmod(salted, F.lit(subs)).cast("int")).drop(part, place, ends, number)
    tally = dealt.groupBy("shard", sub).count()
    # shards x sub-blocks rows, one per half million of the input
    offsets = tally.withColumn(offset, F.sum("count").over(Window.partitionBy("shard").orderBy(sub)) - F.col("count")).drop("count")
    within = Window.partitionBy("shard", sub).orderBy(F.xxhash64(F.col(key), F.lit(seed + 2)), key)
    ranked = dealt.withColumn(place, F.row_number().over(within) - 1)
    return ranked.join(offsets, ["shard", sub]).withColumn("slot", (F.col(place) + F.col(offset)).cast("long")).select(*df.columns, "shard", "slot")
