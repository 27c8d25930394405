from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import assert_same, duck

from marlgrid.llm import spelling
from marlgrid.llm.queries import SQL, op11_spelling, read

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id bigint, text string"


def brute_counts(rows: list[tuple]) -> dict[str, int]:
    found: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[i:] == long[i + 1 :]


def brute(rows: list[tuple]) -> set[tuple]:
    counts = brute_counts(rows)
    forms: dict = {}
    near: dict = {w: [] for w in counts}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    for word, others in near.items():
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None
    found = set()
    for word in words:
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        found.add((word, counts[word], len(near[word]), form, counts.get(form), root))
    return found


def awkward_rows() -> list[tuple]:
    rng = random.Random(4)
    words = ["aaaaa", "aaaaaa", "aaaaaaa", "aabaa", "abaaa", "Straße", "Strasse", "ÀÉÎõü", "àÉÎõü"]
    words += ["x÷y×z", "AbCdE", "four", "fives", "fivess", "ffives", "abcde" * 20]
    words += ["abcde" * 20 + "f", "abcdf" + "abcde" * 19, "abcde" * 12 + "abc", "abcde" * 12 + "abcd"]
    words += ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(90)]
    rows: list = [(None, None), (1, None), (2, ""), (3, " 1 "), (None, "wordy wordy wordy")]
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(90)))
        rows.append((i, text.replace(" ", rng.choice([" ", "\n", "-", "'", "\u4e2d"]))))
    rows += [rows[20]] * 5 + [(99, "veryoften " * 4_000 + "veryofte veryofte veryofte")]
    return rows


def got(table) -> list[tuple]:
    return [tuple(r) for r in table.collect()]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(spelling, "NAME_CHARS", 7)
        monkeypatch.setattr(spelling, "BATCH_ROWS", 50)
        monkeypatch.setattr(spelling, "COUNTED_WORDS", 3)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = awkward_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, word string, place int")
    try:
        found = got(spelling.variants(docs))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute(rows)
    assert len(found) == len(want) and set(found) == want
    assert any(row[3] and row[3] != row[5] for row in want), "no chain of forms"


def test_no_words(spark):
    assert got(spelling.variants(spark.createDataFrame([], SCHEMA))) == []
    assert got(spelling.variants(spark.createDataFrame([(1, None), (2, "ab cd")], SCHEMA))) == []


def test_a_very_long_word(spark):
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefghij") for _ in range(20_000))
    other = word[:9_000] + word[9_001:]
    rows = [(i, f"{word} {word} {other}") for i in range(4)]
    found = {r[0]: r for r in got(spelling.variants(spark.createDataFrame(rows, SCHEMA)))}
    assert found[other][1:] == (4, 1, word, 8, word)
    assert found[word][2:] == (1, None, None, word)


def test_names_of_long_words_are_those_of_their_rotations(monkeypatch):
    word = "abcabdab"
    plain = [name for name, _ in spelling.rotations(word)]
    monkeypatch.setattr(spelling, "NAME_CHARS", 0)
    mixed = [name for name, _ in spelling.rotations(word)]
    others = [name for name, _ in spelling.rotations("abcabdaba")]
    assert len(set(plain)) == len(set(mixed))
    # The word as a whole is what the longer one is without its last letter.
    assert set(mixed) & set(others)


def test_a_group_counts_a_pair_once():
    # aab and ab meet under the names of both a's.
    new = np.array([1, 0, 1, 0], bool)
    place = np.array([0, 1, 0, 1])
    role = np.array([spelling.EDITED, spelling.WHOLE, spelling.REPEATED, spelling.WHOLE])
    found = spelling.scan(new, place, role)
    assert [x.tolist() for x in found] == [[0, 1], [1, 1], [1, 0]]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    found = op11_spelling(spark, SF)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert set(got(found)) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert assert_same(op11_spelling(spark, folder), duck(folder), SQL["op11_spelling"]) > 0
