"""Spelling variants, near vectors and fill-in-middle against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import fill_in_middle, near_vectors, spelling_variants
from starloom.llm.common import components, fallback_folder
from starloom.llm.queries import queries

SF = "/root/testdata/sf0.01"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain_variants(rows, least_chars=6, least_n=5, ratio=5, every=199):
    count = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            count[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in count.items() if len(w) >= least_chars and n >= least_n}
    near, patterns = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            patterns[i, w[:i], w[i + 1 :]].append(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for alike in patterns.values():
        for w in alike:
            near[w] |= {*alike} - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: f if f and words[f] >= ratio * words[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def as_set(df, *names):
    rows = [tuple(r) for r in df.select(*names).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


VARIANT = ("word", "n", "n_near", "form", "form_n", "root")


@pytest.mark.parametrize("seed,options", [(0, {}), (1, {"least_chars": 1, "least_n": 1, "ratio": 2, "every": 7}), (2, {})])
def test_variants_by_brute_force(spark, seed, options):
    """Few letters, so that words share prefixes, repeat letters and end inside others."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÀÿ"[: 2 + seed]) for _ in range(rng.randint(1, 8))) for _ in range(250)]
    rows = [(i, " ".join(rng.choices(words, k=300)).upper() if i % 3 else "\n".join(rng.choices(words, k=200))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_set(spelling_variants.group_variants(df, **options), *VARIANT) == plain_variants(rows, **options)


def test_variants_join_large_edges_by_either_way(spark, monkeypatch):
    rows = [(1, " ".join(f"{a}{b}{c}word" for a in "abc" for b in "abc" for c in "abcdé"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for large in (1, 10_000):
        monkeypatch.setattr(spelling_variants, "LARGE", large)
        assert as_set(spelling_variants.group_variants(df, least_n=1), *VARIANT) == plain_variants(rows, least_n=1)


def test_variants_of_rows_of_every_kind(spark):
    long_run = "ab" * 3_000
    rows = [(1, None), (2, ""), (None, "letter letter letters"), (3, "letter LETTER lettér퟿😀letter"), (3, "letter letter"), (4, f"{long_run} " * 5 + f"{long_run}c " * 30), (5, "ÀÀÀÀÀÀ àààààà " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("word", "n", "key", "target", "node")})
    found = as_set(spelling_variants.group_variants(df), *VARIANT)
    assert found == plain_variants(rows) and {r[3] for r in found} == {None, long_run + "c"}
    assert spelling_variants.group_variants(df.limit(0)).isEmpty() and spelling_variants.group_variants(df.where("doc_id < 3")).isEmpty()


def test_variants_chain_to_the_last_form(spark):
    rows = [(i, t) for i, t in enumerate(["abcdef " * 5, "abcdeg " * 25, "abcdxg " * 125, "abcyxg " * 625])]
    found = {r.word: (r.form, r.root) for r in spelling_variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"), every=10**12).collect()}
    assert found == {"abcdef": ("abcdeg", "abcyxg"), "abcdeg": ("abcdxg", "abcyxg"), "abcdxg": ("abcyxg", "abcyxg"), "abcyxg": (None, "abcyxg")}


def plain_links(rows, threshold=0.95):
    def unit(v):
        x = np.array([np.nan if c is None else c for c in v or []], float)
        if not x.size or not np.isfinite(x).all() or not x.any():
            return None
        x = x / abs(x).max()
        return x / np.sqrt(x @ x)

    units = [unit(v) for _, v in rows]
    links = [[i != j and a is not None and b is not None and a.size == b.size and a @ b >= threshold for j, b in enumerate(units)] for i, a in enumerate(units)]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            for j in np.flatnonzero(links[stack.pop()]):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((vec_id, sum(links[i]), least, vec_id == least))
    return sorted(out, key=str)


def clusters(seed, spreads, size, d=16):
    rng = np.random.default_rng(seed)
    rows = []
    for spread in spreads:
        centre = rng.standard_normal(d)
        for _ in range(size):
            x = centre + spread * rng.standard_normal(d)
            rows.append((x * rng.choice([0.5, 1, 3])).astype(np.float32).tolist())
    rng.shuffle(rows)
    return [(i, v) for i, v in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"block": 4, "partners": 2}])
def test_links_by_brute_force(spark, options):
    """Tight clusters, which centres judge, wide ones, which they can't, and chains between."""
    rows = clusters(1, [0.01, 0.02, 0.1, 0.2, 0.3, 0.5], 40)
    rows += [(1000 + i, rows[0][1]) for i in range(5)] + [(1000, rows[0][1]), (None, rows[1][1])]  # copies, a shared id, a null id
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = near_vectors.near_vectors(df, recall=0.999999, **options)
    assert sorted(map(tuple, found.collect()), key=str) == plain_links(rows)


def test_centres_judge_tight_blocks(spark):
    rows = clusters(3, [0.01, 0.4], 60)
    members = spark.createDataFrame([(i, i // 20, 2, v) for i, v in sorted(rows, key=lambda r: r[1][0] > 0)], "class long, block long, size long, vector array<float>")
    blocks = near_vectors.summaries(members).collect()
    assert [r.n_rows for r in blocks] == [40] * 6 and all(0 <= r.radius <= np.pi for r in blocks)
    flat = spark.createDataFrame([(k, [1.0, k / 10], 0.01, 1, k) for k in range(5)], "block long, centre array<double>, radius double, n_rows long, least long")
    pairs = spark.createDataFrame([(a, b) for a in range(5) for b in range(a, 5)], "a long, b long")
    unit = flat.withColumn("centre", F.transform("centre", lambda x: x / F.sqrt(F.col("centre")[0] ** 2 + F.col("centre")[1] ** 2)))
    angle = lambda a, b: np.arctan(b / 10) - np.arctan(a / 10)
    for r in near_vectors.judged_by_centres(pairs, unit, 0.95).collect():
        reach, limit = 0.02, np.arccos(0.95)
        expected = True if angle(r.a, r.b) + reach < limit else False if angle(r.a, r.b) - reach > limit else None
        assert r.linked is expected


def test_vectors_of_every_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 1e-3]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290])]
    rows += [(11, [1e-310, 0.0]), (None, [0.0, 1.0]), (None, None), (13, [-0.0, 1.0]), (14, [0.0, 5.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "same", "class", "size", "label", "block")})
    assert sorted(map(tuple, near_vectors.near_vectors(df).collect()), key=str) == sorted(((i, n, c, i == c) for i, n, c, _ in plain_links(rows)), key=str)
    assert near_vectors.near_vectors(df.limit(0)).isEmpty()


def test_recall_rule():
    for n in (1, 1000, 10**6, 10**9):
        bits, tables = near_vectors.choose_tables(n, 0.95, 0.999)
        assert 2**bits >= 16 * n and 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables >= 0.999


def test_components_of_hubs_and_chains(spark):
    edges = [(0, i) for i in range(100, 400)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (8, 9), (9, 8), (399, 1040)]
    found = {r.v: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {v: 8 if v in (8, 9) else 0 for e in edges if e != (7, 7) for v in e}


def test_no_local_folder_on_a_cluster():
    assert fallback_folder("local[4]", "file:/tmp/w") == "file:/tmp/w/checkpoints" and fallback_folder("yarn", "hdfs://n/w") == "hdfs://n/w/checkpoints"
    for warehouse in ("file:/tmp/w", "/tmp/w", "spark-warehouse"):
        with pytest.raises(ValueError):
            fallback_folder("spark://host:7077", warehouse)


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middles_by_brute_force(spark):
    long = "".join(random.Random(1).choices("ab \n\t é😀<>PSM", k=700_000))
    texts = [None, "", " ", "a", " a", "a ", " <", "<P>", "x <M> y", "é 😀 b\x0b\x0cc", "<", "<P", ">", "< P > <", long, "x" * 600_000, " " * 600_000, "a" + " " * 600_000 + "b"]
    rows = [(i, texts[i % len(texts)]) for i in range(12 * len(texts))]
    df = spark.createDataFrame([(i, t, "kept", "old") for i, t in rows], "doc_id long, text string, source string, output string")
    out = fill_in_middle.restored(fill_in_middle.fill_in_middle(df))
    assert out.columns == ["doc_id", "text", "source", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    seen = Counter()
    for r in out.collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, r.text) and r.restored == (r.text or "") and r.source == "kept"
        seen[r.form] += 1
    assert set(seen) == {"plain", "psm", "spm"}
    assert fill_in_middle.fill_in_middle(df.limit(0)).isEmpty() and fill_in_middle.restored(fill_in_middle.fill_in_middle(df.limit(0))).isEmpty()


def test_middles_of_null_and_shared_ids(spark):
    rows = [(None, "a b c d")] * 2 + [(7, "a b c d")] * 2
    out = [tuple(r)[2:] for r in fill_in_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(out) == 4 and len(set(out)) <= 2
    with pytest.raises(ValueError):
        fill_in_middle.restore("x", "other")


def test_queries_over_whole_tables(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = queries()["op13_fill_in_middle"](spark, SF).collect()
    assert len(found) == len(docs)
    for r in found:
        *head, output = plain_middle(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, *head, digest(output), digest(docs[r.doc_id] or ""))
    assert as_set(queries()["op11_spelling_variants"](spark, SF), *VARIANT) == plain_variants(docs.items())
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(map(tuple, queries()["op12_near_vectors"](spark, SF).collect()), key=str) == plain_links(vectors)
