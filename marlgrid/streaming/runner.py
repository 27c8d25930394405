"""Running a stream over what is available and reading what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marlgrid.session import ROCKSDB, scratch_path


def stream_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with the settings that streams need.

    Event time needs ``timestamp``; with the session in UTC the cast from
    ``timestamp_ntz`` does not move a value. Custom state needs the RocksDB store,
    which also keeps state off the JVM heap and saves only the changes of a batch. All
    other settings are those of the caller's session.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return session


def append_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes the input present now and appends the result to Parquet files in ``path``.

    ``checkpoint`` keeps offsets and state. A later call with the same two folders
    takes up where this one ended, also after a failure, and writes no row twice.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_once(
    spark: SparkSession, name: str, build: Callable[[SparkSession], DataFrame]
) -> DataFrame:
    """Runs the stream that ``build`` makes, in fresh folders, and reads its result."""
    stream = build(stream_session(spark))
    folder = scratch_path(spark, name)
    append_available(stream, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
