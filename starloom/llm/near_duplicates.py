"""N-gram Jaccard join by MinHash banding.

Texts with equal word sequences form a class, represented by one row.  Each class gets the set of its
hashed word n-grams and MinHash values; bands and rows are chosen for a target recall at the threshold.
Band hashes are shuffled; a bucket of two or more classes makes candidates.  Every class gets a block of
bounded size (classes of the same, most crowded bucket lie together), and candidate *block pairs* rather
than document pairs are shuffled with the full sets and verified exactly, by counting common n-grams in
matrix products.  A block pair is verified once and returns one row per class with a link: how
many documents it is linked to, and the least class of its connected part.  So no pair of documents is ever
a row, and no bucket meets in one task as a whole.

Defined cases: a null text is empty; a text without words is a class of its own with no link; a
text of fewer words than n has its whole word sequence as its one n-gram, one of any length all of its n-grams;
an empty table gives no rows; ties don't arise, as every link counts; repeated rows with the same id
count as documents; a row with a null id gets its own class's id, which is null if all its ids are; extra
columns don't matter.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, components, map_rows, materialise

ODD = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(threshold: float, recall: float = 0.99999, most: int = 256) -> tuple[int, int]:
    """The most rows per band, which gives the fewest false candidates, for which at most `most` values reach the recall."""
    best = (most, 1)
    for rows in range(1, 33):
        p = threshold**rows
        bands = int(np.ceil(np.log1p(-recall) / np.log1p(-p))) if p < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_set(words: list[str], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams."""
    if not words:
        return np.empty(0, np.uint64)
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words])
    raw = b"".join(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in known)
    h = np.frombuffer(raw, np.uint64)[ids]
    out = np.zeros(max(1, len(words) - n + 1), np.uint64)
    for k in range(min(n, len(words))):
        out = mix64(out * ODD + h[k : k + len(out)] + np.uint64(k + 1))
    return np.unique(out)


def minhash(grams: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    least = np.full(len(seeds), np.iinfo(np.uint64).max)
    for at in range(0, len(grams), 256):  # slices that stay in the processor's cache
        part = grams[at : at + 256, None] ^ seeds
        part *= ODD
        part ^= part >> np.uint64(29)
        part *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, part.min(axis=0), out=least)
    return least


def verify(left: list[np.ndarray], right: list[np.ndarray], columns: int = 1024) -> np.ndarray:
    """Sizes of all intersections, by products of 0/1 matrices over slices of the common n-grams; positions are 32-bit, as blocks are bounded."""
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not common.size:
        return out
    sides = []
    for sets, flat in ((left, a), (right, b)):
        row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
        col = np.minimum(np.searchsorted(common, flat), common.size - 1).astype(np.int32)
        hit = common[col] == flat
        row, col = row[hit], col[hit]
        order = np.argsort(col, kind="stable")
        sides.append((row[order], col[order], len(sets)))
    for at in range(0, common.size, columns):
        ones = []
        for row, col, n in sides:
            lo, hi = np.searchsorted(col, (at, at + columns))
            m = np.zeros((n, min(columns, common.size - at)), np.float32)
            m[row[lo:hi], col[lo:hi] - at] = 1
            ones.append(m)
        out += ones[0] @ ones[1].T
    return out


def least_member(edges: np.ndarray, names: list[str]) -> list[str]:
    """The least name of each node's connected part; edges are pairs of positions."""
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, j in edges.tolist():
        i, j = find(i), find(j)
        if i != j:
            root[max((i, j), key=names.__getitem__)] = min((i, j), key=names.__getitem__)
    return [names[find(i)] for i in range(len(names))]


def class_of(words: list[str]) -> str:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def fingerprint(df: DataFrame, n: int, bands: int, rows: int, seed: int = 5) -> DataFrame:
    """(id, class, grams, bands): the number of n-grams, and one 64-bit hash per band; none for a text without words."""

    def make():
        word = re.compile(WORD)
        seeds = np.random.default_rng(seed).integers(1, 2**63, bands * rows, dtype=np.uint64)
        place = np.arange(bands, dtype=np.uint64)

        def one(text: str | None) -> tuple[str, int, list[int]]:
            words = word.findall(text or "")
            if not words:
                return class_of(words), 0, []
            grams = ngram_set(words, n)
            value = minhash(grams, seeds).reshape(bands, rows)
            h = place.copy()
            for k in range(rows):
                h = mix64(h * ODD + value[:, k])
            return class_of(words), len(grams), h.view(np.int64).tolist()

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            got = [one(t) for t in b.column(1).to_pylist()]
            cols = [pa.array(c, k) for c, k in zip(zip(*got), (pa.string(), pa.int64(), pa.list_(pa.int64())))]
            return pa.RecordBatch.from_arrays([b.column(0), *cols], names=["id", "class", "grams", "bands"])

        return run

    return map_rows(df, make, "id long, class string, grams long, bands array<long>")


def sets_of(df: DataFrame, n: int) -> DataFrame:
    """(class, grams) of rows (class, text)."""

    def make():
        word = re.compile(WORD)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [ngram_set(word.findall(t or ""), n).view(np.int64) for t in b.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["class", "grams"])

        return run

    return map_rows(df, make, "class string, grams array<long>")


def similar_classes(df: DataFrame, key: str, text: str, n: int, threshold: float, recall: float, block: int, block_grams: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links): (id, class), (class, class_id, size) and (class, n_links, root), all written down."""
    bands, rows = choose_bands(threshold, recall)
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    prints = materialise(fingerprint(docs, n, bands, rows))
    classes = materialise(
        prints.groupBy("class").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("size"), F.any_value("grams").alias("grams"), F.any_value("bands").alias("bands"))
    )
    entries = classes.select(F.unhex("class").alias("class"), F.explode("bands").alias("bucket"))  # the most rows of all: half the bytes
    crowded = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    candidates = materialise(entries.join(crowded, "bucket").withColumn("class", F.lower(F.hex("class"))))
    # The home of a class is its most crowded bucket, or that of a class it meets in a bucket: near copies, spread
    # over many bands, so share a home.  Homes are cut into blocks of about `block` classes and `block_grams` n-grams.
    own = candidates.groupBy("class").agg(F.max(F.struct("n", "bucket")).alias("home"))
    met = candidates.select("class", "bucket").join(own, "class").groupBy("bucket").agg(F.max("home").alias("home"))
    homes = candidates.select("class", "bucket").join(met, "bucket").groupBy("class").agg(F.max("home")["bucket"].alias("home"))
    homes = homes.join(classes.select("class", "grams"), "class")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("grams") / block_grams)).alias("parts")
    homes = homes.join(homes.groupBy("home").agg(parts), "home")
    number = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    blocks = materialise(homes.select("class", F.struct(F.col("home").alias("bucket"), number.alias("part")).alias("block")))
    in_bucket = candidates.select("class", "bucket").join(blocks, "class").groupBy("bucket").agg(F.collect_set("block").alias("blocks"))
    # A bucket's blocks are paired by lots of 64, so that the pairs of a crowded bucket are made in many tasks.
    lots = F.expr("transform(sequence(0, (size(blocks) - 1) div 64), i -> slice(blocks, i * 64 + 1, 64))")
    pairs = (
        in_bucket.select(F.array_sort("blocks").alias("blocks"))
        .select(lots.alias("lots"))
        .select("lots", F.posexplode("lots").alias("i", "left"))
        .select("left", F.explode(F.expr("slice(lots, i + 1, size(lots))")).alias("right"))
        .distinct()  # near copies meet in many bands, with the same blocks
        .select("right", F.explode("left").alias("a"))
        .select("a", F.explode("right").alias("b"))
        .where("a <= b")
        .distinct()
    )
    # copies of one text may have several ids or rows; one of them brings the text
    chosen = blocks.join(classes.select("class", "class_id", "size"), "class")
    # an id may stand at several texts: the class must agree as well
    texts = docs.join(chosen.select(F.col("class_id").alias("id")).distinct(), "id")
    unnamed = chosen.where("class_id IS NULL").select("class")  # all its ids are null
    unnamed = keyed_texts(docs.where("id IS NULL")).join(unnamed, "class", "left_semi").dropDuplicates(["class"])
    sets = sets_of(keyed_texts(texts).unionByName(unnamed), n).dropDuplicates(["class"]).join(chosen.select("class", "size", "block"), "class")
    sets = materialise(sets)
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array(F.struct(F.col("a").alias("k"), F.lit(0).alias("side")), F.struct(F.col("b").alias("k"), F.when(F.col("a") == F.col("b"), 0).otherwise(1).alias("side"))))).alias("s"))
    work = sides.join(sets, F.col("s.k") == F.col("block")).select("a", "b", F.col("s.side").alias("side"), "class", "size", "grams")

    def of_pair(group: pd.DataFrame) -> pd.DataFrame:
        first = group[group["side"] == 0]
        second = group[group["side"] == 1]
        same = second.empty
        if same:
            second = first
        left, right = ([np.asarray(g, np.int64).view(np.uint64) for g in part["grams"]] for part in (first, second))
        empty = pd.DataFrame({"class": pd.Series(dtype=str), "n_links": pd.Series(dtype="int64"), "root": pd.Series(dtype=str)})
        if not left or not right:
            return empty
        both = verify(left, right)
        union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - both
        link = both >= threshold * union - 1e-6
        if same:
            np.fill_diagonal(link, False)
        i, j = np.nonzero(link)
        if not i.size:
            return empty
        names = [*first["class"], *([] if same else second["class"])]
        edges = np.column_stack((i, j if same else j + len(left)))
        counts = link @ second["size"].to_numpy(np.int64)
        if not same:
            counts = np.concatenate((counts, link.T @ first["size"].to_numpy(np.int64)))
        out = pd.DataFrame({"class": names, "n_links": counts.astype("int64"), "root": least_member(edges, names)})
        return out[out["n_links"] > 0]

    links = materialise(work.groupBy("a", "b").applyInPandas(of_pair, "class string, n_links long, root string"))
    return prints.select("id", "class"), classes.select("class", "class_id", "size"), links


def keyed_texts(df: DataFrame) -> DataFrame:
    """(class, text) of rows (id, text)."""

    def make():
        word = re.compile(WORD)

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            names = [class_of(word.findall(t or "")) for t in b.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), b.column(0)], names=["class", "text"])

        return run

    return map_rows(df.select("text"), make, "class string, text string")


#: Classes with more than one in so many rows are joined by broadcast: fewer than this number.
HEAVY = 4096


def join_classes(members: DataFrame, full: DataFrame) -> DataFrame:
    """`members` with the row of `full` of their class; the rows of a large class stay where they are."""
    n = members.count()
    large = F.broadcast(full.where(F.col("size") * HEAVY > n))
    rest = members.join(large.select("class"), "class", "left_anti").join(full.where(F.col("size") * HEAVY <= n), "class")
    return members.join(large, "class").unionByName(rest)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.99999, block: int = 1024, block_grams: int = 1_000_000) -> DataFrame:
    """(doc_id, class_id, n_links, group_id) of every row.

    class_id is the least id among equal texts, n_links the number of other rows with an equal or similar
    text, group_id the least id of the connected group.
    """
    members, classes, links = similar_classes(df, key, text, n, threshold, recall, block, block_grams)
    per_class = links.groupBy("class").agg(F.sum("n_links").alias("n_links"))
    labels = components(links.select(F.col("class").alias("u"), F.col("root").alias("v")))
    named = classes.join(labels.withColumnRenamed("v", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = named.groupBy("label").agg(F.min("class_id").alias("group_id"))
    empty_class = class_of([])
    own = F.when(F.col("class") == empty_class, F.lit(0)).otherwise(F.col("size") - 1)
    full = named.join(least, "label").join(per_class, "class", "left")
    full = materialise(full.select("class", "size", "class_id", (F.coalesce("n_links", F.lit(0)) + own).cast("long").alias("n_links"), "group_id"))
    out = join_classes(members, full)
    alone = F.col("class") == empty_class  # texts without words aren't copies of each other
    return out.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        "n_links",
        F.when(alone, F.col("id")).otherwise(F.col("group_id")).alias("group_id"),
    )
