"""The tables: declared schemas, batch readers and file-stream readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.functions.money import units

# Declared so that neither a batch read nor a stream has to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


# Decimals of the amounts that are stored as doubles.
DECIMALS = {
    "c_acctbal": 2,
    "s_acctbal": 2,
    "p_retailprice": 2,
    "o_totalprice": 2,
    "l_quantity": 2,
    "l_extendedprice": 2,
    "l_discount": 2,
    "l_tax": 2,
    "value": 2,
}


def units_of(name: str) -> Column:
    """The amount column ``name`` in whole units, by its declared decimals."""
    return units(F.col(name), DECIMALS[name])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch read of one table. ``{name}.parquet`` may be a file or a folder of files."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream_table(
    spark: SparkSession, sf_dir: str, name: str, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """File stream over one table; new files under the path become new micro-batches.

    All files present at the start form one micro-batch by default, so no row of
    theirs is late, in whatever order the files cover time. Where files arrive in
    time order, ``max_bytes_per_trigger`` works a backlog off in smaller steps.

    The braces make the path a glob, which the file source needs in order to
    accept a single file as well as a folder.
    """
    reader = spark.readStream.schema(SCHEMAS[name])
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(f"{sf_dir}/{{{name}.parquet}}")
