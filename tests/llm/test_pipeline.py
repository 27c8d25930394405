from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import psutil
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from test_classifiers import brute_posteriors, by_matrix
from test_minhash import brute as brute_classes
from test_minhash import shuffled
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from marlgrid.llm import quality, queries, texts, toxicity

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark):
    docs = queries.read(spark, SF, "documents")
    # Columns that the operators also add must come through as they are.
    docs = docs.withColumns({"rejected": F.lit("mine"), "copies": F.lit(7), "kept": F.lit(None)})
    labels = {r.doc_id: r for r in queries.read(spark, SF, "labels").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        assert after <= before and after
        if name != "token_ids":
            assert docs.columns == columns
            assert {(r.rejected, r.copies, r.kept) for r in rows} == {("mine", 7, None)}
        if name == "toxicity":
            # The model has 399 labelled documents to learn from here.
            toxic = [i in after for i, r in labels.items() if r.toxic]
            assert sum(toxic) <= 0.1 * len(toxic)
            assert not [i for i in before - after if i in labels and not labels[i].toxic]
        if name == "quality":
            assert all(labels[i].quality for i in after if i in labels)
        if name == "near_duplicates":
            texts = [r.text for r in rows]
            assert len(set(texts)) == len(texts) < len(before)
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_inner_names_are_free_for_other_columns(spark):
    folder = "/root/testdata/sf0.001"
    names = ["_row", "_rejected", "_copies", "_tokens", "_domain", "_p", "_evidence", "_passes", "_host"]
    names += ["_id", "_text", "__row", "p_toxic", "evidence", "least", "class_id", "_pass"]
    plain = queries.read(spark, folder, "documents")
    many = plain.withColumns({name: F.concat(F.lit(name), "doc_id") for name in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, many, folder)
        assert got.columns == many.columns, name
        rows = got.collect()
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in names), name
        want = Counter(r.doc_id for r in stage(spark, plain, folder).collect())
        assert Counter(r.doc_id for r in rows) == want, name


def test_the_whole_against_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    labels = queries.read(spark, folder, "labels")
    docs = queries.read(spark, folder, "documents")
    rows = docs.collect()
    categories = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.learn(docs, labels, categories, "doc_id")
    rated = by_matrix(chain, [r.text for r in rows])[:, -1]
    rows = [r for r, p in zip(rows, rated) if p < chain[-1].threshold]
    model = quality.learn(docs, labels, F.col("quality") == 1, "doc_id")
    evidence = quality._evidence_of(model)([r.text for r in rows])[0]
    groups = [(r.source, r.lang, e) for r, e in zip(rows, evidence)]
    posteriors = [p for _, _, p in brute_posteriors(groups, model.prior)]
    assert np.abs(np.array(posteriors) - 0.5).min() > 1e-6
    rows = [r for r, p in zip(rows, posteriors) if p >= 0.5]
    classes = brute_classes([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if classes[r.doc_id] == r.doc_id]
    spark.createDataFrame(rows, docs.schema).coalesce(1).write.parquet(f"{tmp_path}/kept")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/kept/*.parquet'")
    taken = con.execute(f"SELECT doc_id, copies FROM ({queries.SQL['op5_mixture']})").fetchall()
    copies = {doc_id: n for doc_id, n in taken if n}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want: Counter = Counter()
    for r in rows:
        if r.doc_id in copies:
            ids = tokenizer.encode(r.text, add_special_tokens=False).ids
            decoded = tokenizer.decode(ids, skip_special_tokens=False)
            digest = hashlib.sha256(decoded.encode()).hexdigest()
            want[r.doc_id, r.lang, r.source, len(ids), tuple(ids), digest] = copies[r.doc_id]
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((*r[:4], tuple(r.ids), r.decoded_sha256) for r in got) == want


def test_run_and_registration(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    folder = "/root/testdata/sf0.001"
    assert corpus_pipeline.run(spark, folder).count() > 0
    registered = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in registered) == list(range(1, 14))


def test_rows_without_an_id_stay(spark):
    docs = queries.read(spark, "/root/testdata/sf0.001", "documents")
    nameless = docs.limit(3).withColumn("doc_id", F.lit(None).cast("bigint"))
    kept = corpus_pipeline.near_duplicates(spark, docs.unionByName(nameless), SF)
    assert kept.filter("doc_id is null").count() == 3


def test_one_row_of_each_group_stays(spark):
    text = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(6)]
    rows = [
        # Repeated rows, and a near copy.
        (1, text[0]), (1, text[0]), (2, text[0] + " more"),
        # Copies and a near copy without an id.
        (None, text[1]), (None, text[1]), (None, text[1] + " more"),
        # An id with two texts, one of them another document's.
        (3, text[2]), (4, text[2]), (4, text[3]),
        # A copy without an id of a document that has one.
        (5, text[4]), (None, text[4] + " more"),
        # No words, no copies.
        (6, None), (6, None), (None, ""),
        (None, text[5]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    nameless = [t for i, t in got if i is None and (t or "").startswith(text[1])]
    assert len(nameless) == 1
    rest = [x for x in got if x != (None, nameless[0])]
    wanted = [(1, text[0]), (3, text[2]), (4, text[3]), (None, text[4] + " more")]
    wanted += [(6, None), (6, None), (None, ""), (None, text[5])]
    order = lambda x: (x[0] or 0, x[1] or "")
    assert sorted(rest, key=order) == sorted(wanted, key=order)


def test_texts_that_are_kept_do_not_move(spark, conf):
    # As with more dropped rows than can be sent to every task.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(22)
    texts = [" ".join(f"{rng.randrange(10**9)}" for _ in range(900)) for _ in range(400)]
    rows = [*enumerate(texts), (400, texts[7] + " more"), (401, texts[9]), (None, texts[11])]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4).localCheckpoint()
    before = shuffled(spark)
    got = Counter(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == Counter([*(i for i in range(400) if i != 11), None])
    assert shuffled(spark) - before < 0.25 * sum(len(text) for text in texts)


def test_tasks_get_whole_texts_in_small_batches(spark, conf):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": [batch.num_rows], "size": [batch.nbytes]})

    for told, most in (("64m", 2_000_000), ("500k", 512_000)):
        conf(texts.BATCH_SETTING, told)
        docs = spark.range(0, 3_000, 1, 1).selectExpr("id doc_id", "repeat('word ', 1200) text")
        docs = docs.selectExpr("*", "'en' lang", "'web' source")
        assert corpus_pipeline.token_ids(spark, docs, "").agg(F.sum("n_tokens")).first()[0] == 3_600_000
        rows = docs.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r.n for r in rows) == 3_000
        assert max(r.size for r in rows) < 1.1 * most


def test_freed_memory_is_given_back():
    resident = psutil.Process().memory_info
    held = [np.ones(64_000, np.uint8) for _ in range(2_000)]
    # What lies between is freed, but no end of the heap is.
    some = held[::20]
    del held
    before = resident().rss
    texts.give_back()
    assert before - resident().rss > 60_000_000
    assert all(x.all() for x in some)
