from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlgrid.llm import bpe
from marlgrid.llm.queries import VOCABULARY, op6_bpe, read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def awkward_texts(n: int) -> list[str]:
    rng = random.Random(5)
    alphabets = [
        "abcdefghijklmnopqrstuvwxyz",
        "thein",
        "!?.'$%",
        "aéÉ中😀ñ\u0301Σς",
        "ab1!' \n\t\x0b\x0c\x1c\x85\u00a0\u2003\u200b",
        "ABCthein'stMDLL ",
    ]
    texts = ["", " \n", "İstanbul ΣΑΣ", "it's IT'S !'s 'S", "a<|endoftext|>b", "<|ENDOFTEXT|> <|"]
    for _ in range(n):
        letters = rng.choice(alphabets)
        texts.append("".join(rng.choice(letters) for _ in range(rng.randrange(300))))
        texts.append((rng.choice(alphabets) * 60)[: rng.randrange(1, 300)])
    return texts


@pytest.mark.parametrize(("leaf", "window"), [(8, 1), (16, 2), (64, 8)])
def test_tree_gives_what_the_library_gives(library, monkeypatch, leaf, window):
    monkeypatch.setattr(bpe, "WORD_CHARS", 4)
    encoder = bpe.TreeEncoder(Tokenizer.from_file(VOCABULARY), leaf, window)
    for text in awkward_texts(250):
        ids, counts = encoder.encode([text, "", text + " b"])
        want = library.encode(text, add_special_tokens=False).ids
        more = library.encode(text + " b", add_special_tokens=False).ids
        assert (ids.tolist(), counts.tolist()) == ([*want, *more], [len(want), 0, len(more)]), text


def test_long_runs_and_a_full_store(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    encoder = bpe.TreeEncoder(Tokenizer.from_file(VOCABULARY))
    rng = random.Random(2)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "a", "ab!", "é"):
        text = "".join(rng.choice(letters) for _ in range(50_000))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text])[0].tolist() == want
        assert encoder.encode(["x y " + text[:5_000]])[0].tolist() == library.encode(
            "x y " + text[:5_000], add_special_tokens=False
        ).ids


def test_another_vocabulary_without_word_ends():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = bpe.TreeEncoder(tokenizer, 16, 2)
    rng = random.Random(4)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "thein", "!?-="):
        text = "".join(rng.choice(letters) for _ in range(3_000))
        assert encoder.encode_run(text).tolist() == tokenizer.encode(text).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_file_through_the_operator(spark, monkeypatch, name):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 64)
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    assert bpe.splits_words(tokenizer) == name.startswith("word")
    texts = [*awkward_texts(40), "Some words,  and\n\nmore 123 words!", "ab" * 3_000, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in bpe.encode(docs, path, decoded="decoded").collect():
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids, texts[row.doc_id]
        assert row.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_that_no_vocabulary_has(spark, library):
    lists = [[320, 999_999, 321], [49_407, 5], [-1], [], None]
    rows = spark.createDataFrame(list(enumerate(lists)), "n int, ids array<int>")
    for row in bpe.decode(rows.filter("n != 2"), VOCABULARY).collect():
        assert row.decoded == library.decode(lists[row.n] or [], skip_special_tokens=False)


def test_nulls_repeats_and_clashing_columns(spark, library):
    texts = [None, "", "  ", "Same text", "Same text", "x" * 20_000]
    rows = [(i, text, "old", "old") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string, decoded string")
    encoded = bpe.encode(docs, VOCABULARY)
    nothing = encoded.withColumn("ids", F.when(F.col("doc_id") != 3, F.col("ids")))
    got = {r.doc_id: r for r in bpe.decode(nothing, VOCABULARY).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids if i != 3 else None
        assert got[i].ids == ids
        assert got[i].decoded == library.decode(ids or [], skip_special_tokens=False)
    at_once = bpe.encode(docs, VOCABULARY, decoded="decoded").collect()
    for row in at_once:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    none = spark.createDataFrame([], "doc_id int, text string")
    assert bpe.decode(bpe.encode(none, VOCABULARY), VOCABULARY).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = op6_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (row.doc_id, len(ids), digest(" ".join(map(str, ids))), digest(decoded))
        assert tuple(row) == want
