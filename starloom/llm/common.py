"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; a word is a run of anything else.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
SPACE_CHARS = " \t\n\v\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; one in the warehouse only where none is set, and on several machines only if that isn't a local folder."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fallback_folder(spark.sparkContext.master, spark.conf.get("spark.sql.warehouse.dir")))


def fallback_folder(master: str, warehouse: str) -> str:
    if not re.match(r"local(\[|$)", master) and not re.match(r"(?!file:)[\w+.-]+:", warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share: the warehouse is a local one")
    return warehouse + "/checkpoints"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate tables."""
    ensure_checkpoint_dir(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """As `materialise`, but in Parquet, which is smaller where values come again."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name not used by `df`, so that extra columns of any name can't clash."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in itertools.chain([stem], (f"{stem}_{i}" for i in itertools.count(1))) if n.lower() not in taken)


#: A key that holds more than one in so many rows is joined by broadcast; fewer than this number of keys do.
HOT = 4096


def join_hot(big: DataFrame, small: DataFrame, key: str, weight: str, total: int | None = None) -> DataFrame:
    """Inner join with `small`, which has one row per key and in `weight` the key's rows in `big`; rows of hot keys stay where they are."""
    if total is None:
        total = small.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT > total
    hot = small.where(is_hot)
    rest = big.join(F.broadcast(hot.select(key)), key, "left_anti").join(small.where(~is_hot), key)
    return big.join(F.broadcast(hot), key).unionByName(rest)


def pointer_jumps(to: DataFrame) -> DataFrame:
    """(u, p) of rows (u, p), every u with the end of its chain: no p leads further."""
    while True:
        members = to.groupBy("p").agg(F.count(F.lit(1)).alias("n_members"))
        further = members.join(to.select(F.col("u").alias("p"), F.col("p").alias("further")), "p", "left")
        jumped = join_hot(to, written(further), "p", "n_members").select("u", F.coalesce("further", "p").alias("p"), (F.col("further") != F.col("p")).alias("moved"))
        jumped = written(jumped)
        if jumped.where("moved").isEmpty():
            return to
        to = jumped.select("u", "p")


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the least node of each connected part of edges (u, v), by contraction.

    In each round every node points at its least neighbour, chains of pointers are jumped to their ends, and the edges between ends
    are what's left: at most half of the nodes, so the rounds are a logarithm of the longest part's size.  Tables are
    written, not checkpointed, as a checkpoint keeps its plan's estimated size, which grows with every join of a loop.
    """
    edges = edges.toDF("u", "v")
    both, label = written(edges.union(edges.select("v", "u")).where("u != v").distinct()), None
    while True:
        degree = both.groupBy("u").agg(F.count(F.lit(1)).alias("degree"), F.min("v").alias("least"))
        degree = written(degree)
        ends = pointer_jumps(written(degree.select("u", F.least("u", "least").alias("p"))))
        if label is None:
            label = ends
        else:
            members = label.groupBy("p").agg(F.count(F.lit(1)).alias("n_members")).join(ends.select(F.col("u").alias("p"), F.col("p").alias("further")), "p", "left")
            label = written(join_hot(label, written(members), "p", "n_members").select("u", F.coalesce("further", "p").alias("p")))
        nodes, n_ends = written(degree.select("u", "degree").join(ends, "u")), both.count()
        half = join_hot(both, nodes, "u", "degree", n_ends).select("v", F.col("p").alias("pu"))
        other = nodes.select(F.col("u").alias("v"), "degree", F.col("p").alias("pv"))
        both = written(join_hot(half, other, "v", "degree", n_ends).where("pu != pv").select("pu", "pv").distinct().toDF("u", "v"))
        if both.isEmpty():
            return label.select(F.col("u").alias("v"), F.col("p").alias("label"))


def chunks(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that no slice (but for a single larger row) holds much over `max_bytes`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, max_bytes: int = 8 << 20) -> DataFrame:
    """mapInArrow over bounded slices; `make` builds a worker's state once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for part in chunks(batches, max_bytes):
            f = f or make()
            yield f(part)

    return df.mapInArrow(run, schema)


class Memo(dict):
    """A dict that forgets everything when it exceeds `limit` entries, which bounds a worker's memory."""

    def __init__(self, limit: int) -> None:
        super().__init__()
        self.limit = limit

    def make_room(self, new: int) -> None:
        if len(self) + new > self.limit:
            self.clear()


def salt_buckets(rows_per_bucket: int, n_rows: int, least: int = 1) -> int:
    return max(least, -(-n_rows // rows_per_bucket))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))
