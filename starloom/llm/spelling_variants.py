"""Spelling variants: one-edit pairs of all frequent words by errata-trie merging.

The words form a trie, whose nodes are prefixes.  Heavy-path decomposition calls the child with the most
words below it heavy, every other child light, and merges each light subtree into its node small-to-large: its
words come again, as errata, with one character treated at that node.

- replaced: the light character becomes the heavy one.  Two light words whose errata coincide, or one that
  coincides with a word, differ by one replacement.
- skipped: without the light character.  Where that is a word, one insertion leads back.
- put in: with the heavy character before the light one (or at the end, for a word that ends at the node).  Where that is a word
  below the heavy child, one deletion leads back.

Every one-edit pair parts at exactly one node, by one of these, so it's found once.  A word has at most log2(words)
light edges, so the errata number words * log2(words) at most, whatever the words share.  Nodes are known by a
128-bit digest of their prefix, made character by character, so a word of any length takes linear space.

On Spark: prefixes are counted per node, light edges joined to the words below them (the few large ones by broadcast, see
`LARGE`), errata grouped where they coincide.  A group holds at most one word per letter of the alphabet.

Defined cases: a null text has no words; a null id hashes as the empty string; a text of any length is read whole, a run of
any length is one word; ties of n go to the word smallest in code-point order; repeated rows count again; an
empty table or one without frequent words gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import chunks, materialise, pointer_jumps, written

#: By Latin-1 byte: the letters as they are, A-Z in lower case, all else a space.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: A light edge with more than one word in so many is joined by broadcast.  A word has at most log2(words) light edges, so fewer than LARGE * log2(words) are.
LARGE = 256
#: Words, and code points of text, that a task counts before it hands the counts on.
HELD_WORDS, HELD_CHARS = 400_000, 64 << 20


def planted_edit(run: bytes, prefix: int, every: int) -> bytes:
    """The run (Latin-1), or where `every` divides the hash, the run without one code point; prefix is the crc32 of what precedes it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(df: DataFrame, key: str, text: str, least_chars: int, least_n: int, every: int) -> DataFrame:
    """(word, n) of all runs of letters, lower-cased, one code point left out where `every` divides crc32 of `<key>:<run>`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        chars = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for part in chunks(batches):
            for doc_id, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                found = Counter((t or "").encode("latin-1", "replace").translate(LETTERS).split(b" "))
                found.pop(b"", None)
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for w, n in found.items():
                    total[planted_edit(w, prefix, every)] += n
                chars += len(t or "")
                if len(total) > HELD_WORDS or chars > HELD_CHARS:
                    yield flush()
                    chars = 0
        yield flush()

    counted = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.where(F.length("word") >= least_chars).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def nodes_of(words: DataFrame) -> DataFrame:
    """(word_id, depth, node, letter) of rows (word_id, word): each node on a word's path, and the next letter (empty at its end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = hashlib.blake2b(digest_size=16)
        names, kinds = ["word_id", "depth", "node", "letter"], [pa.int64(), pa.int32(), pa.binary(), pa.string()]
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*held) if held else [()] * len(kinds)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            held.clear()
            return out

        for part in chunks(batches, 1 << 20):
            for word_id, word in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                state = root.copy()
                for depth, letter in enumerate([*word, ""]):
                    held.append((word_id, depth, state.digest(), letter))
                    state.update(letter.encode())
                    if len(held) >= 50_000:
                        yield flush()
        yield flush()

    return words.select("word_id", "word").mapInArrow(run, "word_id long, depth int, node binary, letter string")


def light_edges(paths: DataFrame) -> DataFrame:
    """(node, letter, heavy, n_below): the light edges of each node with two children or more, its end of word included."""
    edges = paths.groupBy("node", "letter").agg(F.count(F.lit(1)).alias("n_below"))
    child = F.when(F.col("letter") != "", F.struct("n_below", "letter"))
    heavy = edges.groupBy("node").agg(F.max(child)["letter"].alias("heavy"), F.count(F.lit(1)).alias("n_children")).where("n_children > 1")
    return edges.join(heavy, "node").where("letter != heavy").select("node", "letter", "heavy", "n_below")


def errata(words: DataFrame, paths: DataFrame, edges: DataFrame, n_words: int) -> DataFrame:
    """(target, place, word, n): each word with one character treated at each of its light edges.

    Errata of the same target and place are one edit apart from each other; the target, if it's a word, from each of them.
    """
    on = ["node", "letter"]
    large = F.broadcast(edges.where(F.col("n_below") * LARGE > n_words).select(*on, "heavy"))
    small = edges.where(F.col("n_below") * LARGE <= n_words).select(*on, "heavy")
    lit = paths.join(large, on).unionByName(paths.join(large.select(*on), on, "left_anti").join(small, on))
    lit = lit.select("word_id", "depth", "letter", "heavy").join(words, "word_id")

    def tail(more: int) -> Column:
        return F.expr(f"substring(word, depth + {1 + more})")

    head, ended = F.expr("substring(word, 1, depth)"), F.col("letter") == ""
    alone = F.concat(F.col("depth").cast("string"), F.lit(":"), "word")
    treated = F.array(
        F.when(~ended, F.struct(F.concat(head, "heavy", tail(1)).alias("target"), F.col("depth").cast("string").alias("place"))),
        # skipping one of two equal letters is the same at the second, further down
        F.when(~ended & (F.expr("substring(word, depth + 2, 1)") != F.col("letter")), F.struct(F.concat(head, tail(1)).alias("target"), F.concat(F.lit("-"), alone).alias("place"))),
        F.struct(F.concat(head, "heavy", tail(0)).alias("target"), F.concat(F.lit("+"), alone).alias("place")),
    )
    return lit.select("word", "n", F.explode(treated).alias("e")).where("e IS NOT NULL").select("e.target", "e.place", "word", "n")


def near_words(words: DataFrame, n_words: int) -> DataFrame:
    """(word, n_near, best) of rows (word_id, word, n): how many words are one edit away, and the one of largest n, as struct (minus n, word)."""
    paths = nodes_of(words)
    found = errata(words, paths, materialise(light_edges(paths)), n_words)
    # a target and place have at most one word per letter of the alphabet
    groups = found.repartition("target").groupBy("target", "place").agg(F.collect_list(F.struct((-F.col("n")).alias("minus_n"), "word")).alias("members"))
    own = words.select(F.col("word").alias("target"), F.struct((-F.col("n")).alias("minus_n"), "word").alias("own"))
    groups = groups.join(own, "target", "left").select(F.array_sort(F.array_compact(F.array_append("members", F.col("own")))).alias("members")).where("size(members) > 1")
    each = groups.select((F.size("members") - 1).alias("others"), F.slice("members", 1, 2).alias("first"), F.posexplode("members").alias("i", "m"))
    best = F.when(F.col("i") == 0, F.col("first")[1]).otherwise(F.col("first")[0])
    return each.select(F.col("m.word").alias("word"), "others", best.alias("best")).groupBy("word").agg(F.sum("others").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form of each word; n grows along a chain, so it ends and its length is a logarithm of n."""
    ends = pointer_jumps(written(forms.select(F.col("word").alias("u"), F.col("form").alias("p"))))
    return ends.select(F.col("u").alias("word"), F.col("p").alias("root"))


def group_variants(df: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 6, least_n: int = 5, ratio: int = 5, every: int = 199) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every frequent word.

    form is the near word of largest n, if that is at least `ratio` times the word's n; root the end of the chain of forms.
    `every` plants misspellings: a run loses one code point where it divides crc32 of `<key>:<run>`.
    """
    words = materialise(count_words(df, key, text, least_chars, least_n, every).withColumn("word_id", F.monotonically_increasing_id()))
    best = F.col("best.minus_n")
    near = near_words(words, words.count())
    named = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-best >= ratio * F.col("n"), F.col("best.word")).alias("form"), F.when(-best >= ratio * F.col("n"), -best).alias("form_n"),
    )
    named = materialise(named)
    return named.join(roots(named.where("form IS NOT NULL")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
