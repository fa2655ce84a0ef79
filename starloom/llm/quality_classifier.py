"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in Arrow slices.  The trees are fitted with numpy on the driver
from a bounded sample of labelled rows (`sample`, 20,000 by default, chosen by a hash of the id), and
flattened into arrays that every task traverses for all rows of a slice at once.

Defined cases: a null text is empty and is scored like any other; without labels, or with one class
only, every score is the (smoothed) share of label 1; equal texts get equal scores; an id with several
labels counts with its largest; of extra columns only one named like the score is replaced; a text of any length
is read whole; an empty table gives no rows.  Of labelled ids with several rows, `sample` rows at most are fitted on.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, map_rows

N_FEATURES = 20
WORDS = re.compile(WORD)
ALPHA = re.compile(r"[^\W\d_]+")


def statistics(text: str | None) -> list[float]:
    """The features; shares are relative to characters, words or lines."""
    t = text or ""
    words = WORDS.findall(t)
    n, chars = len(words), max(1, len(t))
    m = max(1, n)
    seen = Counter(words)
    lines = [x for x in t.split("\n") if x.strip()]
    many_lines = max(1, len(lines))
    letters = sum(map(len, ALPHA.findall(t)))
    upper = sum(map(str.isupper, words))
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    symbols = sum(map(t.count, "#*$%&|<>"))
    counts = np.fromiter(seen.values(), np.float64, len(seen))
    entropy = float(-(counts / m * np.log(counts / m)).sum()) if n else 0.0
    return [
        np.log1p(n),
        np.log1p(len(t)),
        sum(map(len, words)) / m,
        max(map(len, words), default=0),
        letters / chars,
        sum(map(str.isdigit, words)) / m,
        upper / m,
        symbols / chars,
        t.count("!") / m,
        t.count("|") / m,
        sum(map(t.count, ".?!")) / m,
        sum(map(t.count, ",;:")) / m,
        len(seen) / m,
        1 - pairs / max(1, n - 1),
        1 - triples / max(1, n - 2),
        entropy,
        max(seen.values(), default=0) / m,
        1 - len(set(lines)) / many_lines,
        np.log1p(len(lines)),
        sum(1 for x in lines if x.rstrip()[-1:] in ".!?\"'") / many_lines,
    ]


@dataclass
class Forest:
    """Trees of one depth, flattened: node k of a tree has children 2k+1 and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += v[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, l2: float = 1.0, least: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss with histogram splits."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    width = bins + 1
    flat = code + np.arange(x.shape[1]) * width
    margin = np.full(len(y), base)
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(inner):
            at = np.flatnonzero(node == k)
            if at.size:
                where = flat[at].ravel()
                size = x.shape[1] * width
                gs = np.bincount(where, np.repeat(g[at], x.shape[1]), size).reshape(-1, width).cumsum(axis=1)
                hs = np.bincount(where, np.repeat(h[at], x.shape[1]), size).reshape(-1, width).cumsum(axis=1)
                gt, ht = g[at].sum(), h[at].sum()
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(hs < least) | (ht - hs < least)] = -1
                for j, c in enumerate(cuts):
                    gain[j, len(c) :] = -1
                j, b = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[j, b] > 1e-9:
                    feature[k], threshold[k] = j, cuts[j][b]
            node = np.where(node == k, 2 * k + 1 + (x[:, feature[k]] > threshold[k]), node)
        leaf = node - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        margin += value[leaf]
        out.append((feature, threshold, value))
    return Forest(*(np.array(z) for z in zip(*out)), base)


def held_out(key: str):
    """True for the fold that no label is learned from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 20_000, **options) -> Forest:
    wanted = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(key))
        .groupBy(F.col(key).cast("long").alias("id"))
        .agg(F.max("quality").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    docs = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def make():
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [statistics(t) for t in b.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"])

        return run

    # at most `sample` small rows are broadcast, and collected
    labelled = docs.join(F.broadcast(wanted), "id").select("id", "y", "text")
    rows = map_rows(labelled, make, "id long, y int, x array<double>").orderBy("id", "x").limit(sample).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, N_FEATURES)
    return fit(x, np.array([r["y"] for r in rows], np.float64), **options)


def score(df: DataFrame, forest: Forest, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of `df` plus the score (double)."""
    df = df.drop(name)
    at = df.columns.index(text)

    def make():
        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([statistics(t) for t in b.column(at).to_pylist()], np.float64)
            return pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.scores(x), pa.float64())], names=[*b.schema.names, name])

        return run

    return map_rows(df, make, df.withColumn(name, F.lit(0.0)).schema)
