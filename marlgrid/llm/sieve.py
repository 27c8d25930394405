"""Telling rows that a join cannot meet from the others before the join moves them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.texts import free_prefix

# Bits for each key, and in all: 4 MB. With more keys than they are meant for more rows pass.
BITS_PER_KEY = 16
MOST_BITS = 1 << 25
_WORD = 64


def sieve(rows: DataFrame, by: Column, keys: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``by`` may be a ``key`` of ``keys``, and the others.

    ``by`` and ``key`` are bigints whose bits are as good as random, and no nulls. Every row
    that has a key is in the first part, and so is about one in ``BITS_PER_KEY`` of those that
    have none, or more if there are very many keys: a join with the keys has to follow. No row of
    either part has moved; one row of bits goes to the tasks, of ``MOST_BITS`` whatever
    the number of keys. ``keys`` is read twice, ``rows`` once for each part.
    """
    spark = rows.sparkSession
    name = f"{free_prefix(rows.columns)}words"
    wanted = max(_WORD, keys.count() * BITS_PER_KEY)
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    place = lambda of: F.pmod(of, F.lit(bits))
    slot = lambda of: F.shiftright(place(of), 6).cast("int")
    bit = lambda of: (place(of) % _WORD).cast("int")
    own = keys.select(
        slot(key).alias("slot"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(key)).alias("word"),
    )
    none = spark.range(bits // _WORD).select(
        F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("word")
    )
    words = own.unionByName(none).groupBy("slot").agg(F.bit_or("word").alias("word"))
    listed = F.array_sort(F.collect_list(F.struct("slot", "word")))["word"]
    words = words.agg(listed.alias(name))
    passes = F.getbit(F.get(name, slot(by)), bit(by)) == 1
    return rows.join(words, passes, "left_semi"), rows.join(words, passes, "left_anti")
