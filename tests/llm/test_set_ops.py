"""Operators on whole tables against plain versions."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import html_text, mixing, near_duplicates, sharding


def test_shards_have_exact_sizes(spark):
    df = spark.createDataFrame([(i % 7, None if i % 5 else "x") for i in range(1003)], "key int, text string")
    out = sharding.shard_rows(df.repartition(5), 16, rows_per_block=50).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert Counter((r.key, r.text) for r in out) == Counter((i % 7, None if i % 5 else "x") for i in range(1003))
    assert sorted(len(s) for s in slots.values()) == [62] * 5 + [63] * 11
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(df.limit(0), 4).count() == 0
    assert {r.slot for r in sharding.shard_rows(df.limit(3), 16).collect()} == {0}
    clash = df.withColumns({"shard": F.lit("x"), "slot": F.lit(None).cast("string"), "part": F.lit(1), "place": F.lit("y" * 100_000)})
    again = sharding.shard_rows(clash, 4).collect()
    assert {r.part for r in again} == {1} and Counter(r.shard for r in again) == {0: 251, 1: 251, 2: 251, 3: 250}


def test_matrix_margins():
    m = sharding.draw_matrix([10, 0, 7, 3], [7, 7, 6], 1)
    assert m.sum(axis=1).tolist() == [10, 0, 7, 3] and m.sum(axis=0).tolist() == [7, 7, 6] and (m >= 0).all()
    means = np.mean([sharding.draw_matrix([10, 10], [5, 15], s) for s in range(2000)], axis=0)
    assert np.allclose(means, [[2.5, 7.5], [2.5, 7.5]], atol=0.15)


def test_draws_from_large_urns():
    rng = np.random.default_rng(3)
    for good, bad, n in ((10**10, 3 * 10**10, 4 * 10**5), (7, 10**11, 10**10), (10**9, 10**9, 2 * 10**9 - 5), (5 * 10**8, 6 * 10**8, 1000)):
        drawn = np.array([sharding.draw_one(rng, good, bad, n) for _ in range(400)])
        p, all_ = good / (good + bad), good + bad
        mean, deviation = n * p, np.sqrt(n * p * (1 - p) * (all_ - n) / (all_ - 1))
        assert (drawn >= max(0, n - bad)).all() and (drawn <= min(good, n)).all()
        assert abs(drawn.mean() - mean) < 5 * deviation / 20 + 1e-9 and 0.85 * deviation < drawn.std() < 1.15 * deviation
    m = sharding.draw_matrix([10**10] * 8, [2 * 10**10] * 4, 2)
    assert (m.sum(axis=0) == 2 * 10**10).all() and (m.sum(axis=1) == 10**10).all() and abs(m - 2.5 * 10**9).max() < 10**6


def test_large_urns_as_small_ones(monkeypatch):
    rng, small = np.random.default_rng(4), np.random.default_rng(5)
    exact = np.bincount(small.hypergeometric(30, 50, 20, 20_000), minlength=21) / 20_000

    class Urn:  # numpy's own draw is not to be used
        random = rng.random

    monkeypatch.setattr(sharding, "SMALL_URN", 0)
    ours = np.bincount([sharding.draw_one(Urn, 30, 50, 20) for _ in range(20_000)], minlength=21) / 20_000
    assert abs(ours - exact).max() < 0.015


def test_temperature():
    tokens = {"a": 1000, "b": 100, None: 10, "z": 0}
    a = mixing.temperature(tokens, repetition=2.0)
    reads = mixing.passes(tokens, a)
    assert abs(max(reads.values()) - 2) < 1e-6 and reads["a"] == 1 and reads["z"] == 1
    flat = mixing.temperature(tokens, repetition=1e9)
    assert flat == 0.0
    e = mixing.temperature(tokens, entropy=0.8)
    shares = np.array([t / 1110 for t in tokens.values() if t]) ** e
    shares /= shares.sum()
    assert abs(-(shares * np.log(shares)).sum() - 0.8) < 1e-6


def test_mix_keeps_every_row_and_meets_the_budget(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "a", "a", "a", "b"]), None if i % 50 == 0 else "w " * rng.randint(0, 9), 1) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, block int")
    out = mixing.mix(df, rows_per_block=20, least_blocks=4).collect()
    assert {r.doc_id for r in out} == set(range(400))
    tokens = Counter()
    for _, s, t, _ in rows:
        tokens[s] += len((t or "").split())
    reads = mixing.passes(tokens, mixing.temperature(tokens))
    got = Counter()
    for r in out:
        got[r.source] += r.mix_tokens
    for s in tokens:
        assert 0 <= tokens[s] * reads[s] + 0.5 - got[s] < 10
    assert mixing.mix(df.limit(0)).count() == 0
    assert {c for c in df.columns} <= set(mixing.mix(df).columns)


def test_mix_to_a_budget(spark):
    rng = random.Random(5)
    rows = [(i, "big" if i % 10 else rng.choice(["s1", "s2", None]), "w " * rng.randint(0, 9), "old", 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, copy_no string, h int")
    tokens = Counter()
    for _, s, t, _, _ in rows:
        tokens[s] += len(t.split())
    for budget, options in ((4000, {}), (40_000, {"repetition": 5.0}), (9000, {"entropy": 1.0})):
        out = mixing.mix(df, budget=budget, rows_per_block=20, least_blocks=4, **options).collect()
        reads = mixing.passes(tokens, mixing.temperature(tokens, budget=budget, **({"repetition": 2.0} | options)), budget)
        assert abs(sum(reads[s] * tokens[s] for s in tokens) - budget) < 1e-6 * budget
        got, copies = Counter(), Counter((r.doc_id, r.copy_no) for r in out)
        for r in out:
            got[r.source] += r.mix_tokens
        assert max(copies.values()) == 1 and all(0 <= tokens[s] * reads[s] + 0.5 - got[s] < 10 for s in tokens)
        assert {r.h for r in out} == {7} and len({r.mix_order for r in out}) == len(out)
        in_order = sorted(out, key=lambda r: r.mix_order)
        assert [r.mix_block for r in in_order] == sorted(r.mix_block for r in out)
    files = mixing.mix(df, ordered=True).withColumn("file", F.spark_partition_id()).collect()
    assert Counter((r.doc_id, r.copy_no, r.mix_order) for r in files) == Counter((r.doc_id, r.copy_no, r.mix_order) for r in mixing.mix(df).collect())
    assert all(a.file != b.file or a.mix_order < b.mix_order for a, b in zip(files, files[1:]))
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('w ', cast(id % 5 AS int)) AS text")
    assert mixing.mix(many, entropy=7.6).count() >= 3000 and mixing.mix(many).count() >= 3000  # any number of sources


PAGE = (
    "<html><head><title>t</title></head><body><nav><ul><li>menu</ul></nav><div class='ad big'>buy</div><article><h1>Head &amp; more</h1>"
    "<p>one\n two<p>three <b>bold</b><script>var x='</p>'</script></p><div id=comments><p>reader</p></div><aside>side</aside></article><footer>&copy;</footer>"
)


def test_pages(spark):
    boiler = "all pages of this host say the same long words again and again here today"
    loose = [(i, "http://h/x", f"<body><p>{boiler}</p><p>own text number {i} with words</p></body>", "q") for i in range(2, 5)]
    rows = [(0, None, None, "q"), (1, "http://h/1", PAGE, "q"), *loose, (9, "http://h/9", "", "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == {0: "", 1: "Head & more\none two\nthree bold", 9: "", **{i: f"own text number {i} with words" for i in range(2, 5)}}
    assert html_text.extract(df.limit(0)).count() == 0


def test_boilerplate_inside_articles_goes_by_coverage(spark):
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    letter, share, quote = words(14), "tell all your friends", words(30)
    page = lambda i: f"<article><p>{words(25)}</p><p class=x{i}>{letter}</p><p>{share}</p><p>{quote if i % 3 == 0 else words(5)}</p></article>"
    rows = [(i, f"http://h/{i}", page(i)) for i in range(30)] + [(i, f"http://few/{i}", page(i)) for i in range(100, 105)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for group_bytes in (8 << 20, 2000):  # one suffix array, and many
        for r in html_text.extract(df, group_bytes=group_bytes).collect():
            blocks = r.text.split("\n")
            few = r.page_id >= 100  # too few pages to tell a custom of the host
            assert (letter in blocks, share in blocks, len(blocks)) == ((True, True, 4) if few else (False, False, 2))
            assert (quote in blocks) == (r.page_id % 3 == 0)  # a third of the pages may quote the same


BLOCK_CASES = [
    ("<p>one <script>..</script> two</p>", ["one two"]),
    ("<p>one <button>x</button><svg><g><p>y</p></g></svg><label>z</label> two</p><select><option>q</select>", ["one two"]),
    ("<p>one <noscript><div>no</div></noscript>two<p>three", ["one two", "three"]),
    ("<p>a<nav><p>b</nav>c", ["a", "c"]),
    ('<p class="share-price">12</p><div class="share-buttons">s</div><p id="ad-slot-3">t</p><div class="comment_list"><p>u</p></div>', ["12"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<p>a</i></b> b</p></p>c<br>d", ["a b", "c d"]),
    ("<div>a<p>b</div>c<", ["a", "b", "c<"]),
    ("a &lt;b&gt; &amp;&nbsp;&#228;&unknown;", ["a <b> & ä&unknown;"]),
    ("<head><title>t</title>", []),
    ("<head><title>t</title><body>x", ["x"]),
    ("<div hidden>a</div><div aria-hidden=true>b</div><span role=search>c</span>d", ["d"]),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize("html,blocks", BLOCK_CASES)
def test_blocks(html, blocks):
    assert html_text.page_blocks(html) == (False, blocks)
    assert html_text.page_blocks(f"<nav>n</nav><article>{html or ''}</article><p>after") == (True, blocks) or html and "<head>" in html or (html or "").endswith("<")


@pytest.mark.parametrize("furniture", [
    '<article class="comment"><p>a reader comment</p></article>', '<article id="comment-17"><p>c</p></article>', '<article class="teaser"><p>t</p></article>', '<div class="user-comments"><p>c</p></div>',
    '<ul class="commentList"><li>c</ul>', '<p class="comment-text">c</p>', '<div class="adsbygoogle">buy</div>', '<section class="js-newsletter-signup">join</section>',
    '<div style="color:red; DISPLAY : none">unseen</div>', '<p style="visibility:hidden">unseen</p>',
])
def test_furniture_inside_and_outside_the_article(furniture):
    assert html_text.page_blocks(f"<body>{furniture}<article><p>one</p>{furniture}<p>two</p></article>{furniture}</body>") == (True, ["one", "two"])
    assert html_text.page_blocks(f'<body>{furniture}<div id="story"><p>one</p>{furniture}two</div></body>') == (False, ["one", "two"])


@pytest.mark.parametrize("kept", ['<p class="commentary">x</p>', '<div class="story-text">x</div>', '<article class="post">x</article>', '<p style="display:block">x</p>', '<p class="reader">x</p>'])
def test_what_only_looks_like_furniture(kept):
    assert html_text.page_blocks(f"<article>{kept}</article>") == (True, ["x"])


def test_deep_markup_takes_linear_time():
    for html in ("<b>" * 100_000 + "<div>x</div>" * 20_000, "<p>" + "<b>" * 100_000 + "</i>" * 100_000, "<p><td>" + "<b>" * 50_000 + "<div>" * 50_000, "<li>" * 100_000):
        began = time.perf_counter()
        html_text.page_blocks(html)
        assert time.perf_counter() - began < 10


def test_parts_of_a_large_host_find_what_they_share(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    pool = [" ".join(word() for _ in range(rng.choice([3, 11, 12, 20, 30]))) for _ in range(40)]
    rows = []
    for i in range(60):
        blocks = [rng.choice(pool) + (" " + " ".join(word() for _ in range(15)) if rng.random() < 0.4 else "") for _ in range(2)] + [f"{word()} {word()}"]
        rows.append((None if i % 20 == 0 else i // 2 if i < 8 else i, f"http://h/{i}", "".join(f"<p>{b}</p>" for b in blocks)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole, parts = ({r.url: r.text for r in html_text.extract(df, group_bytes=b).collect()} for b in (8 << 20, 500))
    assert whole == parts and len(parts) == 60 and any(t.count("\n") < 2 for t in whole.values())


def test_shared_tokens_by_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        page = np.repeat(np.arange(3), rng.randint(1, 25))
        tokens = np.array([rng.randint(0, 2) for _ in page])
        want, n, k = np.zeros(len(page), bool), len(page), 4
        for i in range(n - k + 1):
            for j in range(n - k + 1):
                if page[i] != page[j] and (tokens[i : i + k] == tokens[j : j + k]).all():
                    want[i : i + k] = True
        assert (html_text.shared_tokens(tokens, page, k) == want).all()


def plain_links(texts, n=5, threshold=0.8):
    sets = {}
    for i, t in texts.items():
        w = (t or "").split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = {i: set() for i in texts}
    for i, a in sets.items():
        for j, b in sets.items():
            if i != j and a and b and len(a & b) >= threshold * len(a | b):
                links[i].add(j)
    return links


def test_near_duplicates(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts, at = {}, 0
    for family in range(12):
        base = rng.choices(words, k=rng.randint(30, 120))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[at] = " ".join(copy)
            at += 1
    texts |= {at: None, at + 1: "", at + 2: "a b", at + 3: "a  b", at + 4: "a b c"}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, class int")
    links = plain_links(texts)
    root = {}
    for i in texts:
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root[i] = min(seen)
    for block in (2048, 3):  # small blocks make many block pairs
        got = {r.doc_id: r for r in near_duplicates.near_duplicates(df, block=block).collect()}
        assert {i: got[i].n_links for i in texts} == {i: len(links[i]) for i in texts}
        assert {i: got[i].group_id for i in texts} == root
    assert near_duplicates.near_duplicates(df.limit(0)).count() == 0


def test_duplicates_stage_keeps_one_row_a_group(spark):
    rng = random.Random(9)
    long = lambda: [f"v{rng.randrange(10**6)}" for _ in range(60)]
    base, other, third, fourth = long(), long(), long(), long()
    near = [*base[:-1], "changed"]
    rows = [(1, base), (1, base), (1, base), (2, near), (2, other), (None, third), (None, third), (5, fourth), (None, fourth), (None, [*third[:-1], "x"]), (6, []), (6, [])]
    df = spark.createDataFrame([(i, " ".join(t), "kept") for i, t in rows], "doc_id long, text string, row string")
    out = corpus_pipeline.duplicates_stage(spark, df.repartition(3), "")
    assert out.columns == df.columns
    texts = dict(enumerate(" ".join(t) for _, t in rows))
    links, groups, seen = plain_links(texts), [], set()
    for i in texts:
        todo, found = [i], {i}
        while todo:
            new = links[todo.pop()] - found
            found |= new
            todo += new
        if i not in seen:
            seen |= found
            groups.append(found)
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(groups) == 6
    for g in groups:
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        least = min(ids, default=None)
        assert sum((least, texts[i]) in got for i in g if rows[i][0] == least) >= 1
    assert Counter(i for i, _ in got) == Counter([1, 2, None, 5, 6, 6])


def test_links_of_texts_without_an_id(spark):
    words = [f"u{i}" for i in range(60)]
    bridge, one, two = list(words), [*words[:-5], *"abcde"], [*"fghij", *words[5:]]
    rows = [(4, one), (None, bridge), (None, bridge), (3, two), (None, ["alone"] * 9)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    links = plain_links({i: " ".join(t) for i, (_, t) in enumerate(rows)})
    assert [len(links[i]) for i in range(5)] == [2, 3, 3, 2, 0]
    got = Counter((r.doc_id, r.n_links, r.group_id) for r in near_duplicates.near_duplicates(df).collect())
    assert got == {(4, 2, 3): 1, (3, 2, 3): 1, (None, 3, 3): 2, (None, 0, None): 1}


def test_bands_reach_the_recall():
    bands, rows = near_duplicates.choose_bands(0.8)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99999 and bands * rows <= 256
