"""Quality rules and classifier: every returned column, every statistic and whole trees against plain versions."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import quality_classifier, quality_rules
from starloom.llm.common import table
from starloom.llm.queries import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_row(text):
    t = text or ""
    words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated)


def plain_verdict(row, rules):
    n, chars, symbols, dup, repeat = row
    if n < 50 or 100 * repeat > 50 * n:
        return False
    f = {"n_words": n, "symbol_share": symbols / max(1, chars), "dup_line_share": dup / max(1, n), "repeat_share": repeat / max(1, n), "word_length": chars / max(1, n)}
    return not any(all(f[t.feature] > t.threshold if t.above else f[t.feature] <= t.threshold for t in r.tests) for r in rules)


def test_every_column_of_the_rules_query(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    rules = quality_rules.train(docs, table(spark, SF, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = queries()["op4_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts) and {r.kept for r in found} == {True, False}
    for r in found:
        row = plain_row(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == row
        assert r.base_failed == (row[0] < 50 or 100 * row[4] > 50 * row[0]) and r.kept == plain_verdict(row, rules)


def test_bad_labels_go_and_good_stay(spark):
    larger = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in table(spark, larger, "labels").collect()}
    kept = {r.doc_id: r.kept for r in queries()["op4_quality_rules"](spark, larger).collect()}
    good = [kept[i] for i, q in truth.items() if q == 1 and i in kept]
    bad = [kept[i] for i, q in truth.items() if q == 0 and i in kept]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.1 * len(bad)


def plain_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    n, m, chars = len(w), max(1, len(w)), max(1, len(t))
    lines = [x for x in t.split("\n") if x.strip()]
    share = lambda k: k / max(1, len(lines))
    c = Counter(w)
    return [
        math.log(1 + n), math.log(1 + len(t)), sum(len(x) for x in w) / m, max([len(x) for x in w], default=0), sum(x.isalpha() or (x.isalnum() and not x.isdecimal() and bool(re.match(r"[^\W\d_]", x))) for x in t) / chars,
        sum(x.isdigit() for x in w) / m, sum(x.isupper() for x in w) / m, sum(x in "#*$%&|<>" for x in t) / chars, sum(x == "!" for x in t) / m, sum(x == "|" for x in t) / m,
        sum(x in ".?!" for x in t) / m, sum(x in ",;:" for x in t) / m, len(c) / m, 1 - len({(a, b) for a, b in zip(w, w[1:])}) / max(1, n - 1), 1 - len({tuple(w[i : i + 3]) for i in range(n - 2)}) / max(1, n - 2),
        -sum(k / m * math.log(k / m) for k in c.values()), max(c.values(), default=0) / m, 1 - share(len(set(lines))), math.log(1 + len(lines)), share(sum(x.rstrip().endswith(tuple(".!?\"'")) for x in lines)),
    ]


def test_all_twenty_statistics(spark):
    texts = [r.text for r in table(spark, SF, "documents").limit(120).collect()]
    for t in [*texts, None, "", " \n\t", "A", "word " * 50, "1 2 3\nABC! x|y\nsame.\nsame.", "é Ünï ß 12 'q'\n\"end\""]:
        assert np.allclose(quality_classifier.statistics(t), plain_statistics(t), rtol=1e-12, atol=1e-12)


def plain_forest(x, y, trees, depth, rate=0.15, l2=1.0):
    """Boosting by trying every threshold of every feature at every node."""
    p = (y.sum() + 1) / (len(y) + 2)
    margin = np.full(len(y), np.log(p / (1 - p)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)

        def grow(rows, level):
            if level == depth:
                margin[rows] += rate * g[rows].sum() / (h[rows].sum() + l2)
                return
            best = (1e-9, None, None)
            for j in range(x.shape[1]):
                for c in np.unique(x[:, j])[:-1]:
                    left, right = rows[x[rows, j] <= c], rows[x[rows, j] > c]
                    if min(h[left].sum(), h[right].sum()) >= 1:
                        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
                        gain = score(left) + score(right) - score(rows)
                        if gain > best[0] + 1e-12:
                            best = (gain, j, c)
            if best[1] is None:  # all rows go left to the end
                grow(rows, level + 1)
                return
            grow(rows[x[rows, best[1]] <= best[2]], level + 1)
            grow(rows[x[rows, best[1]] > best[2]], level + 1)

        grow(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("trees,depth", [(1, 3), (4, 2), (6, 3)])
def test_whole_trees_by_brute_force(trees, depth):
    rng = np.random.default_rng(trees)
    x = rng.permuted(np.tile(np.arange(10.0), (4, 40)), axis=1).T
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 6) | (rng.random(400) < 0.1)).astype(float)
    forest = quality_classifier.fit(x, y, trees=trees, depth=depth, bins=64)
    assert np.allclose(forest.scores(x), plain_forest(x, y, trees, depth))


def test_scores_rank_the_held_out_fold(spark):
    larger = SF.replace("0.001", "0.01")
    truth = {r.doc_id: r.quality for r in table(spark, larger, "labels").collect()}
    held = [(truth[r.doc_id], r.score) for r in queries()["op10_quality_classifier"](spark, larger).collect() if r.held_out and r.doc_id in truth]
    good, bad = ([s for q, s in held if q == k] for k in (1, 0))
    assert good and bad and np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) >= 0.97
