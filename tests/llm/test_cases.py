"""Every operator on empty tables, nulls, empty and very long texts, repeated rows, ties and columns with clashing names; queries against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import chat_format, html_text, media, mixing, near_duplicates, piece_bpe, quality_classifier, quality_rules, sharding, token_counts
from starloom.llm.common import table
from starloom.llm.queries import model_path, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i}" for i in range(60_000))
TEXTS = [None, "", "a b c d e f", "a b c d e f", LONG, LONG + " end", "x" * 30_000, "\n\n \t"]
EXTRA = ("class", "id", "size", "h", "block", "n_words", "n_tokens", "score", "shard", "slot", "copy_no", "mix_order", "words", "statistics", "key", "part", "label", "root", "html", "grams")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else 2, t, None if i % 3 == 0 else "s") for i, t in enumerate(TEXTS)] + [(None, "null id", "s")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("kept") for c in EXTRA})


def labels_of(docs):
    return docs.select("doc_id", (F.coalesce(F.col("doc_id"), F.lit(0)) % 2).cast("int").alias("quality"))


OPERATORS = {
    "tokens": lambda d: token_counts.count_tokens(d, model_path()),
    "pieces": lambda d: piece_bpe.encode_decode(d, model_path()),
    "statistics": quality_rules.text_statistics,
    "rules": lambda d: quality_rules.keep(d, []),
    "shards": lambda d: sharding.shard_rows(d, 3),
    "payloads": lambda d: media.read_back(media.store_payload(d)),
    "images": lambda d: media.image_columns(d, "doc_id", "text"),
    "mix": mixing.mix,
    "pages": lambda d: html_text.extract(d.withColumns({"page_id": F.col("doc_id"), "url": F.col("source"), "html": F.col("text")})),
    "near": near_duplicates.near_duplicates,
    "score": lambda d: quality_classifier.score(d, quality_classifier.fit(np.empty((0, 20)), np.empty(0))),
    "chat": lambda d: chat_format.format_turns(d.withColumns({"conv_id": F.col("doc_id"), "turn": F.lit(0), "role": F.col("source")})),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_of_every_kind(docs, name):
    out = OPERATORS[name](docs)
    n = out.count()
    if name == "rules":
        assert n == 2  # the two long texts of many words
    elif name == "mix":
        assert n >= docs.count() and set(docs.columns) <= set(out.columns)
    else:
        assert n == docs.count()
    if name in ("tokens", "score", "shards", "mix", "rules"):
        assert {c for c in EXTRA if out.schema[c].dataType.simpleString() == "string"} >= set(EXTRA) - {"n_words", "n_tokens", "score", "shard", "slot", "copy_no", "mix_order"}
    empty = OPERATORS[name](docs.where("false"))
    assert empty.count() == 0 and empty.columns == out.columns


@pytest.mark.parametrize("i", range(len(corpus_pipeline.STAGES)))
def test_stages_on_rows_of_every_kind(spark, docs, tmp_path, i):
    labels_of(docs).write.parquet(str(tmp_path / "labels.parquet"))
    name, stage = corpus_pipeline.STAGES[i]
    out = stage(spark, docs, str(tmp_path))
    empty = stage(spark, docs.where("false"), str(tmp_path))
    if i < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns == empty.columns
        assert out.select("class", "score", "n_words").distinct().count() <= 1  # the documents' own columns
    assert empty.count() == 0 and out.count() >= 1


def plain_pipeline_kept(spark, docs):
    """Ids that the third stage may keep: one of each group of links by plain set arithmetic."""
    sets = {}
    for r in docs.collect():
        w = WORD.findall(r.text or "")
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i in ids:
        for g in sets[i]:
            holders.setdefault(g, []).append(i)
    common = Counter((a, b) for h in holders.values() if len(h) < 400 for k, a in enumerate(h) for b in h[k + 1 :])
    for (a, b), n in common.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {find(i) for i in ids}


def test_pipeline_stage_by_stage(spark):
    documents = table(spark, SF, "documents")
    docs, seen = documents, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        seen.append(docs)
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), documents.schema).cache()
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in (*seen, docs)]
    rules = quality_rules.train(documents, table(spark, SF, "labels"))
    want = {r.doc_id for r in quality_rules.text_statistics(documents).where(quality_rules.verdict(rules)).collect()}
    assert ids[1] == want < ids[0] and ids[2] <= ids[1]
    assert ids[3] == plain_pipeline_kept(spark, seen[2]) and ids[4] == ids[3]
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    coded = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.tokens_stage(spark, docs, SF).collect())
    assert coded == Counter((r.doc_id, len(model.encode(r.text or "", add_eos=True))) for r in docs.collect())


def test_query_digests_by_plain_python(spark):
    documents = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    for r in queries()["op3_sentencepiece"](spark, SF).collect():
        ids = model.encode(documents[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    shards = queries()["op5_sharding"](spark, SF).collect()
    sizes = Counter(r.shard for r in shards)
    assert len(shards) == len(documents) and max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
    for r in shards:
        raw = documents[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None) and 0 <= r.slot < sizes[r.shard]
    for r in queries()["op6_media"](spark, SF).collect():
        raw = documents[r.doc_id].encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        stored = b"P5\n64 %d\n255\n" % (len(padded) // 64) + padded
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(raw), len(padded), len(stored))
        assert (r.payload_sha256, r.tail_crc32) == (hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert r.media_sha256 == hashlib.sha256(stored).hexdigest()
        image = np.frombuffer(padded, np.uint8).reshape(-1, 64)
        assert r.feature == f"{plain_hash(image)}-{zlib.crc32(media.npy_tile(image)):08x}"


def plain_hash(image):
    """The difference hash from the exact area of every pixel, row by row."""
    rows, columns = image.shape
    weights = []
    for n, size in ((8, rows), (9, columns)):
        edge = np.linspace(0, size, n + 1)
        at = np.arange(size)
        weights.append(np.clip(np.minimum(edge[1:, None], at + 1) - np.maximum(edge[:-1, None], at), 0, None))
    small = np.rint(weights[0] @ image.astype(float) @ weights[1].T * (72 / (rows * columns)) * 256)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def test_query_of_rules_by_plain_python(spark):
    for r in queries()["op4_quality_rules"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "text"), "doc_id").collect():
        words = WORD.findall(r.text or "")
        triples = Counter(zip(words, words[1:], words[2:]))
        covered = {k + j for k, g in enumerate(zip(words, words[1:], words[2:])) if triples[g] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert (r.n_words, r.n_repeat_words, r.base_failed) == (len(words), len(covered), failed) and not (failed and r.kept)


def test_query_of_pages_by_plain_python(spark):
    from html import unescape

    pages = {r.page_id: r.html or "" for r in table(spark, SF, "pages").collect()}
    for r in queries()["op8_html_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)
        parts = re.split(r"</?(?:p|h[1-6]|div|ul|li)>", article.group(1)) if article else []
        blocks = [" ".join(unescape(re.sub(r"<br>", " ", p).replace("<b>", "").replace("</b>", "")).split()) for p in parts]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def text_of(n, symbols=0, word=5, lines=0):
    words = [f"{i:0{word}d}" for i in range(n)]
    for i in range(symbols):
        words[i] += "#"
    return " ".join(words) + "\nsame line here" * lines


def test_a_list_of_several_rules(spark):
    """Three kinds of bad texts, of which one needs two tests at once."""
    rng, rows = random.Random(4), []
    for i in range(1200):
        kind = i % 6
        if kind == 0:
            rows.append((i, text_of(rng.randint(100, 130), symbols=60), 0))  # as long as good ones
        elif kind == 1:
            rows.append((i, text_of(rng.randint(100, 130), word=4), 0))
        elif kind == 2:
            rows.append((i, text_of(rng.choice([325, 345, 365]), lines=25), 0))  # long and with repeated lines
        elif kind == 3:
            rows.append((i, text_of(rng.choice([79, 89, 99]), lines=7), 1))  # as many of them alone are fine
        elif kind == 4:
            rows.append((i, text_of(rng.choice([400, 420, 440])), 1))  # as is length alone
        else:
            rows.append((i, text_of(rng.randint(100, 130)), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    rules = quality_rules.train(df.drop("quality"), df.select("doc_id", "quality"))
    kept = {r.doc_id: r.kept for r in quality_rules.text_statistics(df).select("doc_id", quality_rules.verdict(rules).alias("kept")).collect()}
    assert len(rules) >= 3 and all(kept[i] == bool(q) for i, _, q in rows)


def test_a_rule_of_two_tests(spark):
    """Bad where both shares are high: either one alone is good."""
    rng, rows = random.Random(8), []
    for i in range(2000):
        symbols, lines = rng.choice([10, 80]), rng.choice([2, 30])
        rows.append((200, 1000, symbols, lines, 0, i, int(not (symbols == 80 and lines == 30))))
    df = spark.createDataFrame(rows, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, doc_id long, quality int")
    rules = quality_rules.learn(df)
    assert [len(r.tests) for r in rules] == [2] and {t.feature for t in rules[0].tests} == {"symbol_share", "dup_line_share"}
    assert df.where(quality_rules.verdict(rules) != (F.col("quality") == 1)).count() == 0


def test_pruning_drops_any_test(spark):
    Test = quality_rules.Test
    rows = [(200, 1000, 50 if i % 2 else 0, 0, 0, i % 3 > 0, int(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, grow boolean, bad long")
    useless, needed = Test("n_words", True, 100.0), Test("symbol_share", True, 0.01)
    harmful = Test("word_length", True, 9.0)
    for grown in ([useless, needed], [needed, useless]):
        assert quality_rules.prune(df, grown, 0.9, 3).tests == (needed,)
    assert quality_rules.prune(df, [useless], 0.9, 3) is None and quality_rules.prune(df, [harmful], 0.9, 3) is None


def plain_fit_stump(x, y, rate=0.15, l2=1.0):
    """One tree of depth 1 by trying every threshold of every feature."""
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = y - p, np.full(len(y), p * (1 - p))
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
    best = max(
        ((score(x[:, j] <= c) + score(x[:, j] > c), j, c) for j in range(x.shape[1]) for c in np.unique(x[:, j])[:-1] if min(h[x[:, j] <= c].sum(), h[x[:, j] > c].sum()) >= 1),
        key=lambda b: b[0],
    )
    left = x[:, best[1]] <= best[2]
    base = np.log(p / (1 - p))
    out = np.where(left, base + rate * g[left].sum() / (h[left].sum() + l2), base + rate * g[~left].sum() / (h[~left].sum() + l2))
    return 1 / (1 + np.exp(-out))


def test_a_tree_by_brute_force():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (300, 5)).astype(float)
    y = (x[:, 3] > 6).astype(float)
    forest = quality_classifier.fit(x, y, trees=1, depth=1, bins=64)
    assert np.allclose(forest.scores(x), plain_fit_stump(x, y))


def test_statistics_and_held_out_accuracy(spark):
    documents = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for t in list(documents.values())[:60] + [None, ""]:
        w, f = WORD.findall(t or ""), quality_classifier.statistics(t)
        assert f[0] == np.log1p(len(w)) and f[2] == sum(map(len, w)) / max(1, len(w)) and f[7] == sum(c in "#*$%&|<>" for c in t or "") / max(1, len(t or ""))
        assert np.isclose(f[12], len(set(w)) / max(1, len(w))) and len(f) == quality_classifier.N_FEATURES
    larger = SF.replace("0.001", "0.01")  # the smallest tables hold out 19 labels
    truth = {r.doc_id: r.quality for r in table(spark, larger, "labels").collect()}
    found = queries()["op10_quality_classifier"](spark, larger).collect()
    assert len(found) == table(spark, larger, "documents").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(truth[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in truth]
    assert held and sum(a == b for a, b in held) >= 0.9 * len(held)
