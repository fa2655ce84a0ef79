"""Embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors form a class, represented by one row.  Each class gets a key of `bits` signs in each of several
tables; bits follow the number of classes and tables the target recall at the threshold, by rule (`choose_tables`).  Classes
that meet in a bucket are candidates.  Every candidate gets a block of bounded size, cut from its most crowded
bucket, and pairs of *blocks* that share a bucket are compared, so that no pair of vectors is ever a row:

- by their centres and radii alone, where the triangle inequality of angles shows that all of their vectors are linked or
  none is.  So a dense group of near copies costs its blocks' pairs, one centre each, not its vectors' pairs;
- else exactly, all vectors of one with all of the other, as a matrix product in double precision.

Links make connected components on the cluster, by repeated minima and pointer jumps.

Defined cases: null, empty and zero vectors and those with a null or non-finite component link with nothing; vectors of
different lengths aren't compared; an empty table gives no rows; ties don't arise, as every link counts; repeated rows with the same
id count as vectors; a row with a null id gets the least id it's linked to, or null; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import math
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, join_hot, map_rows, materialise
from starloom.llm.near_duplicates import ODD, mix64

#: Margin, in radians, within which blocks aren't judged by centres.
MARGIN = 1e-6
#: Vectors hashed at once in a task, which bounds the matrix of signs.
HASHED = 512
#: Columns compared at once.
SLICE = 2048


def choose_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables): 16 times as many keys as vectors, so that chance seldom fills a bucket; tables for the recall at the threshold."""
    bits = max(4, math.ceil(math.log2(max(1, n)))) + 4
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log1p(-recall) / math.log1p(-p))) if p < 1 else 1


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the positions of the vectors and their rows of length 1 in double precision; scaled first, so that no square over- or underflows."""
    column = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths, flat = pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts, out = np.cumsum(lengths) - lengths, {}
    for d in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == d)
        x = flat[starts[at][:, None] + np.arange(d)]
        x /= np.abs(x).max(axis=1, keepdims=True)
        out[d] = at, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def least_linked(link: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least name in the connected part of each row and column of a matrix of links."""
    none = np.iinfo(np.int64).max
    while True:
        to_right = np.concatenate([np.where(link[:, k : k + SLICE], left[:, None], none).min(axis=0) for k in range(0, len(right), SLICE)])
        new_right = np.minimum(right, to_right)
        new_left = left
        for k in range(0, len(right), SLICE):
            new_left = np.minimum(new_left, np.where(link[:, k : k + SLICE], new_right[k : k + SLICE], none).min(axis=1))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def fit_for_use(vector: list[float | None] | None) -> bool:
    return bool(vector) and None not in vector and bool(np.isfinite(x := np.asarray(vector, np.float64)).all()) and bool(x.any())


def with_identity(df: DataFrame) -> DataFrame:
    """(id, vector, same) of rows (id, vector): a digest of a usable vector's components, null for all others."""
    kind = df.schema["vector"].dataType.elementType.simpleString()

    def make():
        def identity(v: list[float | None] | None) -> bytes | None:
            return hashlib.blake2b((np.asarray(v, np.float64) + 0.0).tobytes(), digest_size=16).digest() if fit_for_use(v) else None

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*b.columns, pa.array([identity(v) for v in b.column(1).to_pylist()], pa.binary())], names=["id", "vector", "same"])

        return run

    return map_rows(df, make, f"id long, vector array<{kind}>, same binary")


def bucket_entries(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(class, bucket): one row per class and table."""

    def make():
        planes: dict[int, np.ndarray] = {}

        def buckets(u: np.ndarray) -> np.ndarray:
            d = u.shape[1]
            if d not in planes:
                planes.clear()
                planes[d] = np.random.default_rng((seed, d)).standard_normal((d, tables * bits))
            signs = (u @ planes[d] >= 0).reshape(len(u), tables, bits)
            keys = (signs @ (1 << np.arange(bits, dtype=np.int64))).astype(np.uint64)
            return mix64(keys ^ mix64(np.arange(1, tables + 1, dtype=np.uint64) * ODD + np.uint64(d)))

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            ids, owners, found = b.column(0).to_numpy(zero_copy_only=False), [], []
            for at, u in unit_rows(b.column(1)).values():
                owners.append(np.repeat(ids[at], tables))
                found += [buckets(u[k : k + HASHED]).ravel() for k in range(0, len(u), HASHED)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(owners)), pa.array(np.concatenate(found).view(np.int64))], names=["class", "bucket"])

        return run

    return map_rows(classes.select("class", "vector"), make, "class long, bucket long", max_bytes=1 << 18)


def blocks_of(candidates: DataFrame, block: int) -> DataFrame:
    """(class, block): each candidate's most crowded bucket, cut into parts of about `block` classes."""
    home = candidates.groupBy("class").agg(F.max(F.struct("n", "bucket"))["bucket"].alias("home"))
    home = materialise(home)
    sizes = home.groupBy("home").agg(F.count(F.lit(1)).alias("n_home"))
    cut = F.pmod(F.xxhash64("class"), F.ceil(F.col("n_home") / block))
    return join_hot(home, sizes, "home", "n_home").select("class", F.xxhash64("home", cut).alias("block"))


def block_pairs(in_block: DataFrame, candidates: DataFrame) -> DataFrame:
    """(a, b), a <= b: blocks that share a bucket.  A bucket's blocks are paired by lots of 64, so that a crowded bucket's pairs are made in many tasks."""
    by_bucket = candidates.select("class", "bucket").join(in_block, "class").groupBy("bucket").agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    lots = F.expr("transform(sequence(0, (size(blocks) - 1) div 64), i -> slice(blocks, i * 64 + 1, 64))")
    return (
        by_bucket.select("blocks").distinct()
        .select(lots.alias("lots"))
        .select("lots", F.posexplode("lots").alias("i", "left"))
        .select("left", F.explode(F.expr("slice(lots, i + 1, size(lots))")).alias("right"))
        .select("right", F.explode("left").alias("a"))
        .select("a", F.explode("right").alias("b"))
        .where("a <= b")
        .distinct()
    )


def summaries(members: DataFrame) -> DataFrame:
    """(block, centre, radius, n_rows, least): radius is the largest angle to the centre; null where lengths differ."""

    def of_block(table: pa.Table) -> pa.Table:
        units, centre, radius = unit_rows(table.column("vector")), None, None
        if len(units) == 1:
            ((_, u),) = units.values()
            total = u.sum(axis=0)
            if (length := np.linalg.norm(total)) > 1e-9:
                centre = total / length
                radius = float(np.arccos(np.clip(u @ centre, -1, 1)).max())
        out = {"block": table.column("block")[0].as_py(), "centre": centre, "radius": radius}
        out |= {"n_rows": pc.sum(table.column("size")).as_py(), "least": pc.min(table.column("class")).as_py()}
        kinds = (pa.int64(), pa.list_(pa.float64()), pa.float64(), pa.int64(), pa.int64())
        return pa.table([pa.array([c], k) for c, k in zip(out.values(), kinds)], names=list(out))

    return members.groupBy("block").applyInArrow(of_block, "block long, centre array<double>, radius double, n_rows long, least long")


def judged_by_centres(pairs: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """`pairs` with the rows and least class of both blocks and `linked`: true where all vectors are linked, false where none is, else null."""
    a, b = (blocks.select(*(F.col(c).alias(f"{c}_{side}") for c in blocks.columns)) for side in "ab")
    both = pairs.join(a, F.col("a") == F.col("block_a")).join(b, F.col("b") == F.col("block_b"))
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot)))
    angle = F.when(F.col("a") == F.col("b"), 0.0).when(F.col("centre_a").isNotNull() & F.col("centre_b").isNotNull() & (F.size("centre_a") == F.size("centre_b")), angle)
    reach, limit = F.col("radius_a") + F.col("radius_b"), math.acos(threshold)
    linked = F.when(angle + reach < limit - MARGIN, True).when((F.col("a") != F.col("b")) & (angle - reach > limit + MARGIN), False)
    return both.select("a", "b", "n_rows_a", "n_rows_b", "least_a", "least_b", linked.alias("linked"))


def exact_links(pairs: DataFrame, members: DataFrame, threshold: float, partners: int) -> DataFrame:
    """(class, n_links, root) of the links between the vectors of paired blocks, one row per class and task that found one."""
    lots = F.ceil(F.count(F.lit(1)) / partners).alias("lots")
    work = join_hot(pairs, pairs.groupBy("a").agg(lots, F.count(F.lit(1)).alias("n_pairs")), "a", "n_pairs")
    work = work.select("a", "b", F.pmod(F.xxhash64("b"), F.col("lots")).alias("lot"))
    sides = work.groupBy("a", "lot").agg(F.collect_list("b").alias("bs"))  # about `partners`
    sides = sides.select("a", "lot", F.explode(F.array_append(F.transform("bs", lambda b: F.struct(b.alias("block"), (b == F.col("a")).alias("own"), F.lit(1).alias("side"))), F.struct(F.col("a").alias("block"), F.lit(False).alias("own"), F.lit(0).alias("side")))).alias("s"))
    rows = sides.select("a", "lot", "s.*").join(members, "block").select("a", "lot", "side", "own", "class", "size", "vector")

    def of_group(table: pa.Table) -> pa.Table:
        side, own = (table.column(c).to_numpy() for c in ("side", "own"))
        ids, sizes = (table.column(c).to_numpy() for c in ("class", "size"))
        counts, root = np.zeros(len(ids), np.int64), ids.copy()
        for at, u in unit_rows(table.column("vector")).values():
            left, right = (at[side[at] == k] for k in (0, 1))
            if not left.size or not right.size:
                continue
            v, u = u[side[at] == 1], u[side[at] == 0]
            link = np.hstack([u @ v[k : k + SLICE].T >= threshold for k in range(0, len(v), SLICE)]) & (ids[left][:, None] != ids[right])
            counts[left] += link @ sizes[right]
            away = ~own[right]  # the block paired with itself has counted both ends
            counts[right[away]] += link[:, away].T @ sizes[left]
            root[left], root[right] = least_linked(link, ids[left], ids[right])
        hit = (counts > 0) | (root != ids)
        return pa.table([x[hit] for x in (ids, counts, root)], names=["class", "n_links", "root"])

    return rows.groupBy("a", "lot").applyInArrow(of_group, "class long, n_links long, root long")


def links_of_classes(classes: DataFrame, threshold: float, recall: float, block: int, partners: int, seed: int) -> DataFrame:
    """(class, n_links, root) of rows (class, size, vector), written down: linked rows of other classes, and a class of the same component."""
    n = classes.count()
    bits, tables = choose_tables(n, threshold, recall)
    entries = bucket_entries(classes, bits, tables, seed)
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    candidates = materialise(entries.join(crowded, "bucket"))  # adaptive execution splits a hot bucket: both sides come shuffled
    in_block = materialise(blocks_of(candidates, block))
    members = materialise(in_block.join(classes, "class"))
    blocks = materialise(summaries(members))
    judged = materialise(judged_by_centres(block_pairs(in_block, candidates), blocks, threshold))
    exact = exact_links(judged.where("linked IS NULL").select("a", "b"), members, threshold, partners)
    # whole blocks: each class of `block` is linked with all rows of the other
    sure = judged.where("linked")
    ends = sure.select("a", F.col("n_rows_b").alias("n"), F.least("least_a", "least_b").alias("root")).union(sure.where("a != b").select("b", "n_rows_a", F.least("least_a", "least_b"))).toDF("block", "n", "root")
    # the classes of a block need one edge each, to the least root; `between` joins the blocks' roots
    whole = ends.groupBy("block").agg(F.sum("n").alias("n_all"), F.min("root").alias("root"))
    own = judged.where("linked AND a = b").select(F.col("a").alias("block"), F.lit(True).alias("with_itself"))
    bulk = members.select("class", "size", "block").join(whole, "block").join(own, "block", "left")
    bulk = bulk.select("class", (F.col("n_all") - F.when(F.col("with_itself"), F.col("size")).otherwise(0)).alias("n_links"), "root")
    between = sure.where("a != b").select(F.greatest("least_a", "least_b").alias("class"), F.lit(0).cast("long").alias("n_links"), F.least("least_a", "least_b").alias("root"))
    return materialise(exact.unionByName(bulk).unionByName(between))


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, recall: float = 0.9999, block: int = 1024, partners: int = 32, seed: int = 12) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: other rows with a cosine of at least the threshold, and the least id reachable by links.

    `recall` is that of a pair exactly at the threshold; closer pairs are found more surely, and no pair below it is linked.
    """
    rows = materialise(with_identity(df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))))
    usable = rows.where("same IS NOT NULL")
    classes = usable.groupBy("same").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("size"), F.any_value("vector").alias("vector"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()))
    links = links_of_classes(classes.select("class", "size", "vector"), threshold, recall, block, partners, seed)
    labels = components(links.select(F.col("class").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("class").agg(F.sum("n_links").alias("n_links"))
    named = classes.drop("vector").join(counts, "class", "left").join(labels.withColumnRenamed("v", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    named = materialise(named)
    least = named.groupBy("label").agg(F.min("class_id").alias("component_id"), F.count(F.lit(1)).alias("n_classes"))
    full = join_hot(named, least, "label", "n_classes").select("same", "size", (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).cast("long").alias("n_links"), "component_id")
    linked = join_hot(usable.select("id", "same"), materialise(full), "same", "size").select("id", "n_links", "component_id")
    alone = rows.where("same IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
