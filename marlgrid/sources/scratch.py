"""Written intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlgrid.session import scratch_dir, scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage, outlives executors, fixes values that a recomputation could
    change (slice numbers), and gives the planner real file sizes, so that a
    small result is broadcast only because its size was measured.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Removes every table and stream checkpoint that this application has written.

    To be called when the results that read them are done with: a result is lazy, and
    reads its intermediate tables only when it is itself computed.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
