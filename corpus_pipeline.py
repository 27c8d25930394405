"""From raw documents to token ids: the stages of a training corpus.

Each stage takes what the one before it kept. ``run`` writes every stage's rows as
Parquet in the shared folder and reads them back for the next one, so that a lost
executor never costs more than one stage. The stages lower the session's size of Arrow
batches, see ``small_batches``: executors serve all of them one after another, and keep
what the largest batches took.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.llm import bpe, minhash, queries
from marlgrid.llm.sieve import sieve
from marlgrid.llm.texts import free_prefix, small_batches
from marlgrid.sources.scratch import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers does not find toxic."""
    small_batches(spark)
    prefix = free_prefix(docs.columns)
    rated = queries.toxicity_rated(spark, docs, sf_dir, prefix=prefix)
    return rated.filter(~F.col(f"{prefix}rejected")).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good by their own signs and those of their source."""
    small_batches(spark)
    prefix = free_prefix(docs.columns)
    rated = queries.quality_rated(spark, docs, sf_dir, prefix=prefix)
    return rated.filter(~F.col(f"{prefix}rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, and every row whose text has no word.

    Rows are compared by written row numbers, so rows without an id, repeated rows and
    several texts of one id are compared like all others. A row without an id stays
    before one with an id, then the one of the smallest id.
    """
    small_batches(spark)
    row = f"{free_prefix(docs.columns)}row"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = minhash.near_duplicates(rows.select(row, "text"), key=row)
    # Only classes of several rows matter; their smallest row tells them apart.
    several = classes.filter(~F.col("kept")).select("class_id").distinct()
    members = materialize(classes.join(several, "class_id").select("class_id", row), "copies")
    named = members.join(rows.select(row, "doc_id"), row)
    # A null is the least value of a struct's field.
    stay = named.groupBy("class_id").agg(F.min(F.struct("doc_id", row)).alias("least"))
    dropped = members.join(stay.select(F.col("least")[row].alias(row)), row, "left_anti")
    dropped = materialize(dropped.select(row), "dropped-rows")
    # However many are dropped, texts that are surely kept do not move to be compared with them.
    maybe, sure = sieve(rows, F.xxhash64(row), dropped, F.xxhash64(row))
    kept = sure.unionByName(maybe.join(dropped, row, "left_anti"))
    return kept.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, as often as it takes them."""
    prefix = free_prefix(docs.columns)
    mixed = queries.mixed(queries.mixture_columns(docs, prefix), prefix)
    copies = F.col(f"{prefix}copies")
    passes = F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias(f"{prefix}pass")
    return mixed.filter(copies > 0).select(*docs.columns, passes).drop(f"{prefix}pass")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and a digest of the text decoded from them."""
    small_batches(spark)
    docs = docs.select("doc_id", "lang", "source", "text")
    decoded = bpe.encode(docs, queries.VOCABULARY, decoded="decoded")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

# No SQL for the stages: classifiers, signatures and the tokenizer are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
