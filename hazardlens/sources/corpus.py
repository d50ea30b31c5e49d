"""Tables with an id and a text column as corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, per_core: int = 4) -> DataFrame:
    """The rows, dealt evenly to ``per_core`` tasks for each core of the cluster.

    A scan makes tasks by bytes. Where short rows are much work each, a table that is a few tasks to read would keep as few
    cores busy, however many there are.
    """
    return rows.repartition(per_core * rows.sparkSession.sparkContext.defaultParallelism)
