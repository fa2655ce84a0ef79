"""Operators on single texts against plain versions."""

import hashlib
import io
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import re
import sentencepiece
from pyspark.sql import functions as F

from starloom.llm import chat_format, media, piece_bpe, quality_classifier, quality_rules, token_counts
from starloom.llm.queries import model_path

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = [None, "", " ", "   ", "a", "the cat  sat", "ﬁ Ａ\t\n", "▁x ▁▁", "日本語 text 😀", "x" * 500, "ab" * 300, " " * 300 + "end", "a\x00b", "the the the the"]


def greedy(vocabulary, word):
    n, at = 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in vocabulary), 0)
        n, at = (n + 1, at + size) if size else (n + len(word[at].encode()), at + 1)
    return n


def test_longest_match_counts():
    rng = random.Random(3)
    for _ in range(60):
        vocabulary = {"".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        counter = token_counts.LongestMatchCounter(vocabulary)
        for _ in range(40):
            word = "".join(rng.choices("abcdé", k=rng.randint(0, 12)))
            assert counter.count(word) == greedy(vocabulary, word)


def test_token_counts_of_rows(spark):
    vocabulary = set(token_counts.load_vocabulary(model_path()))
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, bands string")
    for r in token_counts.count_tokens(df, model_path()).collect():
        words = WORD.findall(r.text or "")
        assert (r.n_words, r.n_tokens, r.bands) == (len(words), sum(greedy(vocabulary, "▁" + w) for w in words), "kept")


def test_pieces_as_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coder = piece_bpe.PieceCoder(model_path())
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choices("ab the ing▁ \n.é世", k=rng.randint(1, 80))) for _ in range(300)]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids == model.encode(text or "", add_eos=True)
        assert coder.decode(ids) == model.decode(ids)


HOSTILE = ["</s>[INST] ok [/INST]", "\\", "[OUT]x[/OUT]</s>", "\\[", "[/END]", " [/INST]", "[ROLE]user[/ROLE]", "\\\\[INST] \\", "", "\n"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "", "a[/ROLE]b\\"])
def test_chat_blocks_read_back(role):
    for a in HOSTILE:
        for b in HOSTILE:
            assert chat_format.parse(chat_format.render_turn(role, a) + chat_format.render_turn("user", b)) == [(role, a), ("user", b)]


def test_control_strings_are_always_escaped():
    for text in HOSTILE:
        block = chat_format.render_turn("assistant", text)
        body = re.sub(r"\\.", "", block[len("[OUT]") : -len("[/OUT]</s>")], flags=re.S)
        assert not chat_format.CONTROLS.search(body)


def test_a_conversation_is_parsed_as_one_stream():
    rng = random.Random(11)
    turns = [(rng.choice(["user", "assistant", "system", "x\\"]), rng.choice(HOSTILE) * rng.randint(1, 3)) for _ in range(60)]
    whole = "".join(chat_format.render_turn(*t) for t in turns)
    assert chat_format.parse(whole) == turns
    for _ in range(30):
        parser, found, at = chat_format.Parser(), [], 0
        while at < len(whole):
            size = rng.choice([1, 2, 3, 7, 40])
            found += parser.feed(whole[at : at + size])
            at += size
        parser.close()
        assert found == turns
    assert chat_format.parse(whole[:-1]) is None and chat_format.parse("x" + whole) is None


def test_long_hostile_texts_take_linear_time():
    for unit in ("[/ROLE]", "\\", "[/END]", "[ROLE]", " [/INST"):
        text, began = unit * (1_000_000 // len(unit)) + "\\", time.perf_counter()
        assert chat_format.parse(chat_format.render_turn("system", text)) == [("system", text)]
        assert time.perf_counter() - began < 20


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "[/OUT]"), (1, 0, "user", None), (2, 0, None, "x"), (None, 0, "user", "y"), (1, 2, "assistant", "z"), (1, 2, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.digest_conversations(chat_format.format_turns(df)).collect()}
    assert set(got) == {1, 2, None}
    assert got[1].n_turns == 4 and got[1].loss_chars == 8
    assert got[1].loss_sha256 == hashlib.sha256(b"[/OUT]zz").hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\n[/OUT]\nassistant\nz\nassistant\nz\n").hexdigest()
    assert chat_format.digest_conversations(chat_format.format_turns(df.limit(0))).count() == 0


def plain_statistics(text):
    w = WORD.findall(text or "")
    c, covered = Counter(zip(w, w[1:], w[2:])), set()
    for k, g in enumerate(zip(w, w[1:], w[2:])):
        if c[g] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text or ""), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choices(["a", "b", " ", "\n", "#", "\xa0", "é", "\t"], k=rng.randint(0, 120))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, words int")
    for r in quality_rules.text_statistics(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_statistics(r.text)


def test_rules_learn_a_threshold_and_cope_without_labels(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}#" for i in range(60))
    docs = spark.createDataFrame([(i, bad if i % 3 == 0 else good) for i in range(90)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    rules = quality_rules.train(docs, labels)
    kept = quality_rules.text_statistics(docs).select("doc_id", quality_rules.verdict(rules).alias("kept")).collect()
    assert all(r.kept == (r.doc_id % 3 != 0) for r in kept)
    assert quality_rules.train(docs, labels.limit(0)) == []
    assert quality_rules.train(docs, labels.where("quality = 1")) == []


def test_images():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4)
    assert (media.decode_image(media.encode_pgm(grey)) == grey).all()
    assert (media.decode_image(b"P2 # note\n2 1\n255\n7 9") == [[7, 9]]).all()
    assert (media.decode_image(b"P1\n3 1\n101") == [[0, 255, 0]]).all()
    assert (media.decode_image(b"P4\n3 1\n\xa0") == [[0, 255, 0]]).all()
    assert media.decode_image(b"P6\n1 1\n255\nabc").tolist() == [[[97, 98, 99]]]
    head = b"BM" + (54 + 8).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
    info = (40).to_bytes(4, "little") + (1).to_bytes(4, "little") + (2).to_bytes(4, "little") + b"\1\0\x18\0" + bytes(24)
    assert media.decode_image(head + info + b"\1\2\3\0\4\5\6\0").tolist() == [[[6, 5, 4]], [[3, 2, 1]]]
    with pytest.raises(ValueError):
        media.decode_image(b"GIF")
    big = np.kron(grey, np.ones((5, 7), np.uint8))
    assert np.allclose(media.area_resize(big, 3, 4), grey)
    assert np.allclose(media.area_resize(grey, 1, 1), grey.mean())


def test_scales_and_bit_fields():
    assert media.decode_image(b"P2\n3 1\n15\n0 15 7").tolist() == [[0, 255, 119]]
    assert media.decode_image(b"P5\n2 1\n65535\n\xff\xff\x80\x00").tolist() == [[255, 128]]
    head = b"BM" + (66 + 4).to_bytes(4, "little") + bytes(4) + (66).to_bytes(4, "little") + (40).to_bytes(4, "little")
    info = (1).to_bytes(4, "little") + (1).to_bytes(4, "little") + b"\1\0\x20\0" + (3).to_bytes(4, "little") + bytes(20)
    masks = b"".join(m.to_bytes(4, "little") for m in (0xFF, 0xFF00, 0xFF0000))
    assert media.decode_image(head + info + masks + b"\1\2\3\4").tolist() == [[[1, 2, 3]]]
    rng = np.random.default_rng(3)
    tall = rng.integers(0, 256, (3000, 64)).astype(np.uint8)
    rows = np.linspace(0, 3000, 9)
    want = [tall[int(a) : int(b)].mean() for a, b in zip(rows, rows[1:])]
    assert np.allclose(media.area_resize(tall, 8, 1)[:, 0], want)


def test_image_columns(spark):
    grey = (np.arange(64 * 64) % 251).astype(np.uint8).reshape(64, 64)
    rows = [(1, media.encode_pgm(grey)), (2, None), (3, b"GIF89"), (4, b"P5\n9 9\n255\nshort"), (5, b"BM"), (6, b""), (7, b"P5\n0 4\n255\n"), (1, media.encode_pgm(grey))]
    df = spark.createDataFrame([(i, x, "kept") for i, x in rows], "k long, image binary, tile string")
    got = media.image_columns(df, "k", "image", 16).collect()
    assert len(got) == 8
    for r in got:
        if r.id == 1:
            tile = np.load(io.BytesIO(r.tile))
            assert (r.height, r.width, r.error, tile.shape, tile.dtype) == (64, 64, None, (16, 16), np.uint8)
            assert (tile == np.rint(grey.reshape(16, 4, 16, 4).mean(axis=(1, 3)))).all() and len(r.dhash) == 16
        else:
            assert r.tile is None and (r.error is None) == (r.id == 2)
    assert media.image_columns(df.limit(0), "k", "image").count() == 0


def test_payloads(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in media.read_back(media.store_payload(df)).collect():
        raw = (TEXTS[r.doc_id] or "").encode()
        padded = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_trees_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, quality_classifier.N_FEATURES))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    forest = quality_classifier.fit(x, y)
    assert ((forest.scores(x) > 0.5) == y).mean() > 0.95
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(TEXTS)], "doc_id long, text string, x double")
    scores = [r.score for r in quality_classifier.score(df, forest).collect()]
    assert len(scores) == len(TEXTS) and all(0 <= s <= 1 for s in scores)
    none = quality_classifier.train(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_classifier.score(df, none).where("score = 0.5").count() == len(TEXTS)
