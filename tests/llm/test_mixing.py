from __future__ import annotations

import random
from collections import defaultdict

import pytest
from compare import assert_same, duck
from pyspark.sql import functions as F

from marlgrid.llm import mixing, queries

LEVELS = [
    mixing.Level("domain", {"web": 3.0, "none": 0.0}),
    mixing.Level("lang", {"en": 2.0}),
    mixing.Level("source", {}),
]


def brute_budgets(leaves: dict, levels, budget: float, epochs: int) -> dict:
    """Budget of each leaf; the fill level of each family is found by bisection."""
    weight = lambda level, name: level.weights.get(name, level.other)
    rooms = {
        leaf: held * epochs * all(weight(lv, x) > 0 for lv, x in zip(levels, leaf))
        for leaf, held in leaves.items()
    }
    found = {}

    def fill(prefix, given):
        depth = len(prefix)
        if depth == len(levels):
            found[prefix] = given
            return
        children = {leaf[: depth + 1] for leaf in leaves if leaf[:depth] == prefix}
        room = {c: sum(r for k, r in rooms.items() if k[: depth + 1] == c) for c in children}
        weights = {c: weight(levels[depth], c[-1]) for c in children}
        low, high = 0.0, 1e9
        for _ in range(200):
            middle = (low + high) / 2
            taken = sum(min(room[c], middle * weights[c]) for c in children)
            low, high = (middle, high) if taken < given else (low, middle)
        for c in children:
            fill(c, min(room[c], high * weights[c]))

    fill((), min(budget, sum(rooms.values())))
    return found


def awkward_documents(n: int = 600) -> list[tuple]:
    rng = random.Random(4)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        domain = "web" if hot else rng.choice(["web", "books", "none", None])
        lang = "en" if hot else rng.choice(["en", "fr", None])
        source = "hot" if hot else rng.choice(["a", "b", "c", None])
        rows.append((i, domain, lang, source, rng.choice([None, 0, -4, 1, 7, 30, 400])))
    return rows + rows[:20]


@pytest.mark.parametrize(("share", "epochs", "bucket"), [(0.5, 1, 4_096), (0.9, 3, 5), (9.0, 2, 50)])
def test_against_brute_force(spark, monkeypatch, share, epochs, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    rows = awkward_documents()
    docs = spark.createDataFrame(
        [(*row, "old") for row in rows],
        "doc_id int, domain string, lang string, source string, n_tokens int, copies string",
    )
    got = mixing.mix(docs, LEVELS, share, epochs, seed=1).collect()
    assert len(got) == len(rows)
    leaves, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        leaf, n = (r.domain, r.lang, r.source), max(r.n_tokens or 0, 0)
        leaves[leaf] += n
        taken[leaf] += n * r.copies
        largest[leaf] = max(largest[leaf], n)
    budgets = brute_budgets(leaves, LEVELS, share * sum(leaves.values()), epochs)
    for leaf, budget in budgets.items():
        assert taken[leaf] <= budget + 1e-3
        # The prefix ends with the document that does not fit.
        assert taken[leaf] > budget - largest[leaf] - 1 or taken[leaf] == leaves[leaf] * epochs
        copies = {r.copies for r in got if (r.domain, r.lang, r.source) == leaf}
        assert max(copies) - min(copies) <= 1
    assert all(r.copies == 0 for r in got if r.domain == "none")


def test_the_prefix_follows_the_seeded_order(spark):
    rows = [(i, "web", "en", "a", 10) for i in range(200)]
    schema = "doc_id int, domain string, lang string, source string, n_tokens int"
    docs = spark.createDataFrame(rows, schema)

    def taken(share, seed):
        mixed = mixing.mix(docs, LEVELS, share, 1, seed).filter("copies > 0")
        return {r.doc_id for r in mixed.collect()}

    assert len(taken(0.25, 1)) == 50 and len(taken(0.5, 1)) == 100
    assert taken(0.25, 1) < taken(0.5, 1)
    assert taken(0.25, 1) != taken(0.25, 2)


@pytest.mark.parametrize("share", [0.0, 0.26, 0.501, 1.0, 1.3])
def test_rows_that_are_alike_are_counted_off(spark, share):
    rows = [(7, "web", "en", "a", 10)] * 700 + [(8, "web", "en", "a", 3)] * 40
    rows += [(9, "web", "en", "a", 0)] * 50 + [(None, "web", "en", "a", 10)] * 10
    schema = "doc_id int, domain string, lang string, source string, n_tokens int"
    docs = spark.createDataFrame(rows, schema).repartition(6)
    got = mixing.mix(docs, LEVELS, share, 2, 3).collect()
    assert len(got) == len(rows)
    held = sum(r[4] for r in rows)
    passes, rest = divmod(int(share * held + 1e-6), held)
    taken = sum((r.copies - passes) * r.n_tokens for r in got)
    assert rest - 10 < taken <= rest and {r.copies for r in got} <= {passes, passes + 1}


def test_documents_without_tokens_at_the_border(spark):
    rows = [(i, "web", "en", "a", 10 if i % 3 else 0) for i in range(300)]
    schema = "doc_id int, domain string, lang string, source string, n_tokens int"
    got = mixing.mix(spark.createDataFrame(rows, schema), LEVELS, 0.5, 1, 5).collect()
    order = {
        r.doc_id: r.place
        for r in mixing._placed(
            spark.createDataFrame([(r[0], 0, 1) for r in rows], "_key int, _passes int, _buckets int"), 5
        )
        .selectExpr("_key doc_id", "_place place")
        .collect()
    }
    so_far, want = 0, set()
    for i in sorted(order, key=order.get):
        so_far += rows[i][4]
        if so_far <= 1_000:
            want.add(i)
    assert {r.doc_id for r in got if r.copies} == want
    assert any(rows[i][4] == 0 for i in want)


def test_inner_names_are_free_for_other_columns(spark):
    names = "_n _key _passes _rest _buckets _place _bucket _border _end _some _all _budget _held".split()
    names += ["level 0", "of level 0", "_part", "_tokens", "_domain", "_copies", "__n"]
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents")
    many = docs.withColumns({name: F.concat(F.lit(name), "doc_id") for name in names})
    levels = [mixing.Level("lang", {}), mixing.Level("source", {})]
    plain = mixing.mix(docs, levels, 0.5, 2, 1, tokens="n_chars").collect()
    got = mixing.mix(many, levels, 0.5, 2, 1, tokens="n_chars").collect()
    assert {r.doc_id: r.copies for r in got} == {r.doc_id: r.copies for r in plain}
    assert all(r[name] == f"{name}{r.doc_id}" for r in got for name in names)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id int, domain string, lang string, source string, n_tokens int")
    assert mixing.mix(docs, LEVELS, 0.5, 2, 1).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op5_mixture(spark, folder).collect()
    assert len(got) == queries.read(spark, folder, "documents").count()
    texts = {r.doc_id: r.text for r in queries.read(spark, folder, "documents").collect()}
    assert all(r.n_tokens == len(texts[r.doc_id].split()) for r in got)
    leaves, taken = defaultdict(int), defaultdict(int)
    for r in got:
        leaves[r.domain, r.lang, r.source] += r.n_tokens
        taken[r.domain, r.lang, r.source] += r.n_tokens * r.copies
    budget = queries.MIXTURE_SHARE * sum(leaves.values())
    budgets = brute_budgets(leaves, queries.MIXTURE, budget, queries.MIXTURE_EPOCHS)
    largest = max(r.n_tokens for r in got)
    assert all(budgets[k] - largest - 1 < taken[k] <= budgets[k] + 1e-3 for k in leaves)


def test_extra_columns_stay(spark):
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents").withColumn("domain", F.lit(1))
    mixed = queries.mixed(queries.mixture_columns(docs))
    assert {r.domain for r in mixed.collect()} == {1}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    sql = queries.SQL["op5_mixture"]
    assert assert_same(queries.op5_mixture(spark, folder), duck(folder), sql) > 0
