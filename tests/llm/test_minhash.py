from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from graphs import components

from marlgrid.llm import minhash
from marlgrid.llm.queries import op8_near_duplicates, read


def weighted(text: str | None) -> Counter:
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", (text or "").lower()) if w]
    n = minhash.SHINGLE
    if 0 < len(words) < n:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows: list[tuple], least: float = 0.8) -> dict:
    """Class of each key; keys must be unique."""
    sets = {key: weighted(text) for key, text in rows}
    by_shingle: dict = {}
    pairs = set()
    for key, counted in sets.items():
        for shingle in counted:
            others = by_shingle.setdefault(shingle, [])
            pairs.update((other, key) for other in others)
            others.append(key)
    links = [(a, b) for a, b in pairs if jaccard(sets[a], sets[b]) >= least]
    return components(list(sets), links)


def edited(rng: random.Random, text: str, share: float) -> str:
    words = text.split()
    return " ".join(f"z{rng.random()}" if rng.random() < share else w for w in words)


def awkward_texts() -> list[str | None]:
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(3_000)}" for _ in range(n))
    texts: list = [None, "", " \n", "one", "One\n", "two words", "a b c d e", "a b c d e f"]
    base = prose(300)
    texts += [base] * 20 + [base.upper(), base.replace(" ", "\n ")]
    # Near copies of one text, far enough apart that not all are linked with all.
    texts += [edited(rng, base, rng.choice([0.005, 0.01, 0.03])) for _ in range(80)]
    # A passage that many texts share.
    passage = prose(60)
    texts += [f"{prose(rng.randrange(5, 80))} {passage} {prose(20)}" for _ in range(60)]
    for _ in range(30):
        other = prose(rng.randrange(30, 400))
        texts += [other, edited(rng, other, 0.01), other + " " + prose(len(other) // 60)]
    loop = "la le li lo lu ma me mi"
    texts += [(loop + " ") * n for n in (10, 12, 30, 31, 300)]
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        # Many tiles, and pairs in many pieces.
        monkeypatch.setattr(minhash, "TILE_LEFT", 3)
        monkeypatch.setattr(minhash, "TILE_RIGHT", 7)
        monkeypatch.setattr(minhash, "WEIGHT_LEFT", 2_000)
        monkeypatch.setattr(minhash, "PAIRS", 5)
    rows = list(enumerate(awkward_texts()))
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, kept string")
    got = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_repeated_rows_missing_keys_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text), (5, text), (9, text + " x"), (None, text), (None, "other"), (7, None)]
    schema = "doc_id int, text string"
    got = minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in got) == [
        (0, 0, True),
        (0, 5, False),
        (5, 5, True),
        (5, 5, True),
        (7, 7, True),
        (9, 5, False),
    ]
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_rows_without_a_key_are_compared(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(900)}" for _ in range(400)]
    near = lambda i: " ".join([*base[:i], "new", *base[i:]])
    alone = " ".join(f"v{rng.randrange(900)}" for _ in range(90))
    # Near copies without a key; some of a row with one, others only of each other.
    rows = [(4, near(3), "a")] + [(None, near(i), "b") for i in (50, 51, 52)]
    rows += [(None, f"{alone} {i}", "c") for i in (1, 1, 2, 3)] + [(None, None, "d"), (None, " ", "d")]
    # One key with several texts, and one text under a key over and over.
    rows += [(8, f"text number {i} of one key and no other", "e") for i in range(5)]
    rows += [(8, near(70), "b")] * 3
    docs = spark.createDataFrame(rows, "doc_id int, text string, class_id string").repartition(5)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    found = Counter(tuple(r) for r in got)
    assert found[4, 4, True] == 1 and found[None, 4, False] == 3
    # Repeated rows of key 8 are one document, which is a near copy of that of key 4.
    assert found[8, 4, False] == 3 and found[8, 8, True] == 5
    assert found[None, None, True] == 3 and found[None, None, False] == 3


def test_a_very_long_text(spark):
    rng = random.Random(12)
    words = [f"w{rng.randrange(50_000)}" for _ in range(300_000)]
    long = " ".join(words)
    words[1_000:1_000] = ["more"] * 3
    rows = [(1, long), (2, " ".join(words)), (3, long[: len(long) // 2]), (4, "x" * 1_000_000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_only_texts_of_buckets_move(spark, conf):
    # As with more texts than can be sent to every task.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(21)
    texts = [" ".join(f"{rng.randrange(10**9)}" for _ in range(900)) for _ in range(400)]
    rows = [*enumerate(texts), (400, texts[7] + " more"), (401, texts[9].replace(" ", "\n", 1))]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4).localCheckpoint()
    before = shuffled(spark)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: {400: 7, 401: 9}.get(i, i) for i in range(402)}
    assert shuffled(spark) - before < 0.25 * sum(len(text) for text in texts)


def shuffled(spark) -> int:
    """Bytes that this application has written for shuffles."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    executors = context.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_agreement_estimates_similarity():
    rng = random.Random(3)
    bases = [" ".join(f"w{rng.randrange(500)}" for _ in range(150)) for _ in range(60)]
    others = [edited(rng, base, 0.03) + " " + base[: 7 * i] for i, base in enumerate(bases)]
    signs = []
    for texts in (bases, others):
        shingle, weight, owner, _ = minhash.shingles(texts)
        signs.append(minhash.signatures(shingle, weight, owner, len(texts)))
    agreeing = (signs[0] == signs[1]).mean(axis=1)
    exact = np.array([jaccard(weighted(a), weighted(b)) for a, b in zip(bases, others)])
    # Four standard errors of the mean, and of one text.
    assert abs((agreeing - exact).mean()) < 4 * 0.0625 / np.sqrt(60)
    assert np.abs(agreeing - exact).max() < 4 * 0.0625


def test_similarities_are_exact():
    texts = [t for t in awkward_texts()[-60:] if t]
    left, right = texts[:-1], texts[1:]
    digests = (minhash.shingles(left)[3], minhash.shingles(right)[3])
    got = minhash.similarities(left, right, digests)
    assert np.allclose(got, [jaccard(weighted(a), weighted(b)) for a, b in zip(left, right)])
    assert minhash.similarities(["a"], ["b"], ([b"x"], [b"y"])).tolist() == [-1]


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in read(spark, folder, "documents").collect()]
    got = {r.doc_id: r.class_id for r in op8_near_duplicates(spark, folder).collect()}
    assert got == brute(rows)


def test_a_bucket_is_connected_as_by_all_pairs(monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(minhash, "PAIRS", 7)
    for _ in range(30):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, 60))]
        texts = [edited(rng, " ".join(base), rng.choice([0.0, 0.02, 0.05])) for _ in range(25)]
        elements = minhash._elements(texts)[1]
        node = np.arange(len(texts))
        component = node // 2 * 2
        outside = np.flatnonzero(component != 0)
        links = minhash._bucket_links([outside, node], node, component, elements, 0.8)
        sets = [weighted(text) for text in texts]
        assert all(jaccard(sets[a], sets[b]) >= 0.8 for a, b in links)
        given = [(int(c), i) for i, c in enumerate(component)]
        pairs = [(a, b) for a in node.tolist() for b in range(a) if jaccard(sets[a], sets[b]) >= 0.8]
        wanted = components(node.tolist(), given + [p for p in pairs if max(p) > 1])
        assert components(node.tolist(), given + links) == wanted
