from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from marlgrid.llm import language
from marlgrid.llm.queries import op1_language, read

SF = "/root/testdata/sf0.01"


def brute_bits(text: str) -> set:
    cleaned = "".join(c if c.isalpha() else " " for c in text.lower())
    cleaned = " " + " ".join(cleaned.split()) + " "
    return {
        cleaned[i : i + n]
        for n in range(1, language.LONGEST + 1)
        for i in range(len(cleaned) - n + 1)
    } - {" "}


def presence(texts: list[str]) -> np.ndarray:
    """One row of n-gram bits per text; all zero for a text without a letter."""
    bits = np.zeros((len(texts), language.BUCKETS), np.float32)
    bucket, row = language.buckets(texts)
    bits[row, bucket] = 1
    return bits


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The normalized kernel between rows of bits; 0 for a row without any."""
    size = np.sqrt(np.outer(left.sum(1), right.sum(1)))
    return left @ right.T / np.maximum(size, 1.0)


def test_presence_is_that_of_ngrams():
    texts = ["", "...", "a", "Ab, ab! ab", "Größe", "中文字", "the theater"]
    bits = presence(texts)
    for row, text in zip(bits, texts, strict=True):
        if not any(c.isalpha() for c in text):
            assert row.sum() == 0
        else:
            # Hashing may bring two n-grams together, but makes none.
            assert len(brute_bits(text)) - 2 <= row.sum() <= len(brute_bits(text))
    alone = np.concatenate([presence([text]) for text in texts])
    assert (alone == bits).all()


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    rng = np.random.default_rng(7)
    texts = ["some words that go on and on " * 40, "x" * 500, "  , " * 90 + "ab", "ab" + " ." * 99, " " * 200]
    texts += ["".join(rng.choice(list("abcdefghij")) for _ in range(240))]
    texts += ["".join(rng.choice(list("abé  ,\u0e01\u0e34中")) for _ in range(300)) for _ in range(40)]
    whole = [language.buckets([text])[0] for text in texts]
    for segment in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language, "SEGMENT", segment)
        for text, want in zip(texts, whole, strict=True):
            assert language.buckets([text])[0].tolist() == want.tolist(), (segment, text)
        bucket, row = language.buckets(texts[:6])
        assert all(bucket[row == i].tolist() == whole[i].tolist() for i in range(6))


def test_marks_belong_to_words():
    for word in ("नमस्ते", "สวัสดี", "e\u0301te\u0301"):
        assert len(language.buckets([word])[0]) > len(language.buckets([word[0]])[0])
        spaced = " ".join(word)
        assert set(language.buckets([word])[0]) != set(language.buckets([spaced])[0])
    assert language.has_letters("1a") and not language.has_letters("\u0301 12 ½ !")


def test_kernel_with_landmarks_is_the_dense_one(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["the cat", "the cat", "le chat", "1", "", "x" * 90]
    texts += ["".join(rng.choice(list("abcdefgh é,"), 80)) for _ in range(30)]
    marks = [language.buckets([text])[0] for text in texts if language.has_letters(text)][::2]
    bits = presence(texts)
    landmarks = np.zeros((len(marks), language.BUCKETS), np.float32)
    for i, mark in enumerate(marks):
        landmarks[i, mark] = 1
    want = kernel(bits, landmarks)
    for shared in (1, 50, language.SHARED):
        monkeypatch.setattr(language, "SHARED", shared)
        bucket, row = language.buckets(texts)
        got = language.Landmarks(marks).kernel(bucket, row, len(texts))
        assert np.allclose(got, want, atol=1e-6)
    assert np.isclose(want[1, 0], 1) and 0 < want[2, 0] < 1 and not want[3].any()


def test_landmarks_are_whole_texts_where_there_are_enough(spark, monkeypatch):
    rows = [(i, f"the text number {'abcdefgh'[i % 8:]} and more of it " * (1 + 50 * (i % 2)), "en") for i in range(60)]
    rows += [(100 + i, "le texte" + "".join(map(chr, range(0x4E00, 0x4F00))), "fr") for i in range(5)]
    monkeypatch.setattr(language, "LANDMARK_BUCKETS", 100)
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    found = []
    monkeypatch.setattr(language, "fit", lambda values, labels, marks: found.extend(marks) or labels)
    assert set(language.learn(docs, "doc_id", F.lit(True))) == {"en", "fr"}
    # Those of the other language are cut, as all of its texts are longer.
    assert sorted(len(mark) == 100 for mark in found).count(True) == 5


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in op1_language(spark, SF).collect()}
    docs = read(spark, SF, "documents").collect()
    assert len(rows) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert {d.doc_id for d in held} == {i for i, r in rows.items() if r.held_out}
    assert np.mean([rows[d.doc_id].lang_pred == d.lang for d in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_nulls_empty_texts_and_clashing_columns(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang").limit(100)
    odd = [(1_001, None, "en"), (1_002, "", "en"), (1_003, "12 !?", None), (1_003, "\u0301 !", None)]
    rows = docs.unionByName(
        spark.createDataFrame([*odd, (None, "the and of", None)], docs.schema)
    ).withColumns({"score": F.lit("old"), "extra": F.lit(1)})
    model = language.learn(rows, "doc_id", F.lit(True))
    got = language.identify(rows, model).filter("doc_id > 1000 or doc_id is null").collect()
    assert sorted((r.doc_id or 0, r.lang_pred, r.score, r.extra) for r in got)[1:] == [
        (1_001, "und", 0.0, 1),
        (1_002, "und", 0.0, 1),
        (1_003, "und", 0.0, 1),
        (1_003, "und", 0.0, 1),
    ]
    none = rows.filter("false")
    assert language.learn(none, "doc_id", F.lit(True)) is None
    assert language.identify(none, None).count() == 0
    assert {r.lang_pred for r in language.identify(rows, None).collect()} == {"und"}


def made_up(rng, start: int, n: int) -> str:
    """A text in a script of 8,000 letters, the first ones most frequent."""
    return "".join(chr(start + int(x)) for x in 8_000 ** rng.random(n) - 1)


def test_long_texts_in_large_scripts(spark):
    rng = np.random.default_rng(4)
    scripts = {"a": 0x4E00, "b": 0x6E00, "c": 0xAC00}
    rows = [(made_up(rng, at, 400), lang) for lang, at in scripts.items() for _ in range(60)]
    schema = "doc_id int, text string, lang string"
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
    model = language.learn(docs, "doc_id", F.lit(True))
    long = [(i, made_up(rng, at, 200_000), lang) for i, (lang, at) in enumerate(scripts.items())]
    got = language.identify(spark.createDataFrame(long, schema), model).collect()
    assert {r.lang: r.lang_pred for r in got} == {lang: lang for lang in scripts}


def test_all_languages_share_the_sample(spark, monkeypatch):
    rng = np.random.default_rng(5)
    langs = {f"l{k:03}": 0x4E00 + 60 * k for k in range(300)}
    word = lambda at: "".join(chr(at + int(x)) for x in rng.integers(0, 60, 4))
    rows = [(" ".join(word(at) for _ in range(30)), lang) for lang, at in langs.items() for _ in range(4)]
    schema = "doc_id int, text string, lang string"
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
    for texts in (25_600, 600):
        monkeypatch.setattr(language, "ALL_TEXTS", texts, raising=False)
        model = language.learn(docs, "doc_id", F.lit(True))
        assert model.languages == sorted(langs)
        got = language.identify(docs, model).collect()
        assert np.mean([r.lang == r.lang_pred for r in got]) > 0.99


def test_a_key_of_many_rows_counts_once(spark, monkeypatch):
    rows = [(1, f"the text {'ab' * i}", "en") for i in range(300)]
    rows += [(i, "le texte", "fr") for i in range(2, 9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    monkeypatch.setattr(language, "fit", lambda values, labels, *_: labels)
    assert sorted(language.learn(docs, "doc_id", F.lit(True))) == ["en", *["fr"] * 7]
