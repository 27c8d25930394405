from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marlgrid.llm import sieve as module
from marlgrid.llm.sieve import sieve


@pytest.mark.parametrize("most", [module.MOST_BITS, 1 << 10])
def test_no_key_is_lost_and_few_others_pass(spark, monkeypatch, most):
    monkeypatch.setattr(module, "MOST_BITS", most)
    rows = spark.range(20_000).select("id", F.lit("x").alias("_words"))
    keys = spark.range(0, 40_000, 25).withColumnRenamed("id", "key")
    maybe, others = sieve(rows, F.xxhash64("id"), keys, F.xxhash64("key"))
    assert maybe.columns == others.columns == rows.columns
    first, second = ({r.id for r in part.collect()} for part in (maybe, others))
    assert not first & second and first | second == set(range(20_000))
    assert first >= set(range(0, 20_000, 25))
    # Of 19,200 others one in 16 and less; 1,600 keys leave few of 1,024 bits free.
    assert len(first) < (800 + 1_200 if most > 1 << 10 else 20_000)


def test_without_keys_nothing_passes(spark):
    rows, keys = spark.range(50), spark.range(0)
    maybe, others = sieve(rows, F.xxhash64("id"), keys, F.xxhash64("id"))
    assert (maybe.count(), others.count()) == (0, 50)


def test_every_bit_of_a_word(spark):
    keys = spark.range(-64, 64)
    maybe, others = sieve(spark.range(-64, 64), F.col("id"), keys, F.col("id"))
    assert (maybe.count(), others.count()) == (128, 0)
    assert sieve(spark.range(64), F.col("id"), spark.range(63, 64), F.col("id"))[0].collect()[0].id == 63
