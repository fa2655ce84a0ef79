"""Learned decision lists over text statistics, all in DataFrame expressions.

Sequential covering: each rule starts empty and grows by the threshold test that gains most on the
growing two thirds of the labelled rows; it is then pruned on the other third, where any of its tests may
go, and kept if it still separates well there.  Rows that it covers leave, and the next rule is learned,
until none is precise enough.  Every step is one small aggregation; the driver holds nothing but counts
per feature and bin.  The list becomes one ordered `when ... when ... otherwise` expression.

Defined cases: a null text has no words; a text of any length is counted whole; an empty table gives no
rows; without labels, or with one class only, the list is empty and the base rules decide alone; equal
and repeated rows get equal verdicts; an id with several labels counts with its largest; of extra columns
only those named like a statistic are replaced by it in `text_statistics`, and none in `keep`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import SPACE_CHARS, SPACES, WORD, fresh_name, materialise

SYMBOLS = "#*$%&|<>"


def bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once, as the variable of a one-element transform."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that are found twice or more: sort windows, compare neighbours, count positions.

    `words` should be a column or a bound variable, as it is used for every window.
    """

    def of_sorted(s: Column) -> Column:
        near = lambda i: F.get(s, i)["w"]
        hit = F.filter(s, lambda x, i: (x["w"] == F.coalesce(near(i - 1), F.lit(""))) | (x["w"] == F.coalesce(near(i + 1), F.lit(""))))
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    texts = F.transform(words, lambda w, i: F.struct(F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    n = F.size(words) - 2
    # texts whose windows have distinct hashes have distinct windows: only the others are sorted
    all_differ = F.size(F.array_distinct(F.slice(hashes, 1, n))) == n
    sorted_windows = F.sort_array(F.slice(texts, 1, n))
    return F.when(n < 1, F.lit(0)).when(all_differ, F.lit(0)).otherwise(bound(sorted_windows, of_sorted))


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(df: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Adds one struct column of all STATISTICS (long).

    It is the row of a generator, which Spark neither copies into each of its uses nor pushes filters through.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(rf"[^{SPACES}]"))
    words = F.regexp_extract_all(value, F.lit(f"({WORD})"), 1)
    counted = bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("repeated")))
    found = bound(counted, lambda c: F.struct(
        c["n"].alias("n_words"),
        F.length(F.translate(value, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        c["repeated"].alias("n_repeat_words"),
    ))
    return df.withColumn(name, F.explode(F.array(found)))


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    once = fresh_name(df, "statistics")
    return with_statistics(df, once, text).withColumns({n: F.col(f"`{once}`.{n}") for n in STATISTICS}).drop(once)


def keep(df: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows that the base rules and the list leave, with their own columns."""
    once = fresh_name(df, "statistics")
    return with_statistics(df, once, text).where(verdict(rules, f"`{once}`.")).drop(once)


def base_failed(at: str = "") -> Column:
    """`at` goes before the statistics' names, such as the name of a struct and a dot."""
    n = F.col(f"{at}n_words")
    return (n < 50) | (100 * F.col(f"{at}n_repeat_words") > 50 * n)


def features(at: str = "") -> dict[str, Column]:
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = (F.col(at + n) for n in STATISTICS)
    words = F.greatest(n_words, F.lit(1))
    return {
        "n_words": n_words.cast("double"),
        "symbol_share": n_symbols / F.greatest(word_chars, F.lit(1)),
        "dup_line_share": n_dup_lines / words,
        "repeat_share": n_repeat_words / words,
        "word_length": word_chars / words,
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self, at: str = "") -> Column:
        f = features(at)[self.feature]
        return f > self.threshold if self.above else f <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Documents that pass all tests are rejected."""

    tests: tuple[Test, ...]

    def column(self, at: str = "") -> Column:
        return reduce(lambda a, b: a & b, [t.column(at) for t in self.tests])


def learn(
    labelled: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    bins: int = 24,
    precision: float = 0.9,
    least: int = 3,
) -> list[Rule]:
    """A list of rejecting rules from rows with the statistics and a 0/1 label (0 is rejected)."""
    names = list(features())
    rows = labelled.where(F.col(label).isin(0, 1) & ~base_failed()).select(
        *STATISTICS,
        (F.pmod(F.xxhash64(F.col(key)), F.lit(3)) < 2).alias("grow"),
        (F.col(label) == 0).cast("long").alias("bad"),
    )
    rows = rows.persist()
    try:
        grid = [i / bins for i in range(1, bins)]
        bad_grid = rows.agg(
            *(F.percentile_approx(f, grid, 10_000).alias(n) for n, f in features().items()),
            *(F.percentile_approx(F.when(F.col("bad") == 1, f), grid, 10_000).alias(f"{n}_bad") for n, f in features().items()),
        ).first()
        cuts = {n: with_middles(sorted({x for a in (bad_grid[n], bad_grid[f"{n}_bad"]) for x in a or ()})) for n in names}
        binned = rows
        for n, f in features().items():
            edges = F.array(*map(F.lit, cuts[n])) if cuts[n] else F.array().cast("array<double>")
            binned = binned.withColumn(f"bin_{n}", bins_below(edges, f))
        rules: list[Rule] = []
        while any(cuts.values()):  # each rule covers `least` bad rows or more, so this ends
            left = reduce(lambda d, r: d.where(~r.column()), rules, binned)
            grown: list[Test] = []
            while (best := best_test(left, grown, cuts, least)) is not None:  # each test leaves fewer rows
                grown.append(best[0])
                if best[1] >= 0.995:
                    break
            rule = prune(left, grown, precision, least)
            if rule is None:
                break
            rules.append(rule)
        return rules
    finally:
        rows.unpersist()


def with_middles(edges: list[float]) -> list[float]:
    return sorted({*edges, *((a + b) / 2 for a, b in zip(edges, edges[1:]))})


def bins_below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda x: x < value))


def counts(rows: DataFrame, candidates: list[tuple[Test, ...]], grow: bool | None) -> list[tuple[int, int]]:
    """(bad, all) covered by each conjunction, in one aggregation without a shuffle key."""
    rows = rows if grow is None else rows.where(F.col("grow") == grow)
    cover = [Rule(c).column() for c in candidates]
    sums = rows.agg(
        F.array(*(F.coalesce(F.sum(F.when(c, F.col("bad"))), F.lit(0)) for c in cover)).alias("bad"),
        F.array(*(F.count(F.when(c, True)) for c in cover)).alias("n"),
    ).first()
    return list(zip(sums["bad"], sums["n"]))


def best_test(rows: DataFrame, grown: list[Test], cuts: dict[str, list[float]], least: int) -> tuple[Test, float] | None:
    """The test with the largest precision gain weighted by the bad rows it keeps (smoothed).

    One aggregation by feature and bin; a row's bin is the number of cuts below its value.
    """
    left = rows.where("grow")
    if grown:
        left = left.where(Rule(tuple(grown)).column())
    places = F.array(*(F.struct(F.lit(n).alias("f"), F.col(f"bin_{n}").alias("b")) for n in cuts))
    histogram = left.select("bad", F.explode(places).alias("p")).groupBy("p.f", "p.b").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
    per_bin = {(r["f"], r["b"]): (r["bad"], r["n"]) for r in histogram.collect()}  # features x bins rows
    score = lambda bad, n: (bad + 0.5) / (n + 1)
    best = None
    for f, edges in cuts.items():
        bins = [per_bin.get((f, b), (0, 0)) for b in range(len(edges) + 1)]
        everything = tuple(map(sum, zip(*bins)))
        before = score(*everything) if grown else 0.5 * score(*everything)
        below, found = (0, 0), []
        for k in range(len(edges)):
            below = (below[0] + bins[k][0], below[1] + bins[k][1])
            above = (everything[0] - below[0], everything[1] - below[1])
            found += [(bad * (score(bad, n) - before), is_above, k, bad, n) for is_above, (bad, n) in ((True, above), (False, below)) if bad >= least]
        for is_above in (True, False):
            side = [x for x in found if x[1] == is_above]
            top = max((x[0] for x in side), default=0)
            if top > 0 and (best is None or top > best[0]):
                tied = [x for x in side if x[0] == top]
                _, _, k, bad, n = tied[len(tied) // 2]  # of thresholds that part these rows alike, the middle one
                best = (top, Test(f, is_above, edges[k]), bad / n)
    return best and best[1:]


def prune(rows: DataFrame, grown: list[Test], precision: float, least: int) -> Rule | None:
    """Drops the test without which the rule does best on the pruning rows, while it does no worse; None if it isn't precise enough."""
    if not grown:
        return None
    now = tuple(grown)
    while True:
        shorter = [now[:i] + now[i + 1 :] for i in range(len(now))] if len(now) > 1 else []
        forms = [now, *shorter]
        held, all_rows = counts(rows, forms, False), counts(rows, forms, None)
        worth = [(b + 0.5) / (n + 1) for b, n in held]
        best = max(range(1, len(forms)), key=worth.__getitem__, default=0)
        if not best or worth[best] < worth[0]:
            (b, n), (ab, an) = held[0], all_rows[0]
            return Rule(now) if ab >= least and ab >= precision * an and (n == 0 or b >= precision * n) else None
        now = forms[best]


def verdict(rules: list[Rule], at: str = "") -> Column:
    """True where a document stays: the base rules first, then the learned list in order."""
    out = F.when(base_failed(at), F.lit(False))
    for rule in rules:
        out = out.when(rule.column(at), F.lit(False))
    return out.otherwise(F.lit(True))


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 20_000, **options) -> list[Rule]:
    """Statistics of labelled documents, at most `sample` ids chosen by a hash of the id, then the list.

    The labelled texts are written down before anything is computed from them: a filter on statistics would else be
    pushed below the join, to all documents.
    """
    wanted = labels.where(F.col("quality").isin(0, 1)).groupBy(key).agg(F.max("quality").alias("quality"))
    wanted = wanted.orderBy(F.xxhash64(key), key).limit(sample)  # so many small rows are broadcast
    labelled = materialise(documents.select(key, F.col(text).alias("text")).join(F.broadcast(wanted), key))
    return learn(materialise(text_statistics(labelled).drop("text")), key=key, **options)
