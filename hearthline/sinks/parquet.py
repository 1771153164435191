"""Parquet tables and staged intermediate results."""

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: str | None = None,
    partitions: int | None = None,
    rebalance: bool | None = None,
) -> int:
    """Replace the table at ``path`` with ``df`` and return the number of rows written.

    ``partitions`` spreads the rows over that many tasks. ``rebalance`` shuffles by
    ``partition_by`` and lets adaptive execution split large and join small pieces, for
    few, even files; without ``partitions`` it is the default of tables that are
    partitioned, which every task would else write a file of for each value. Other
    tables are not shuffled: every task writes its own rows.

    The rows are counted by the write itself. The count sits above any shuffle, in
    the stage that writes, where a repeated task is not counted twice.
    """
    if rebalance is None:
        rebalance = partition_by is not None and partitions is None
    if partitions is not None:
        df = df.repartition(partitions)
    elif rebalance:
        df = df.hint("rebalance", *([partition_by] if partition_by else []))
    written = Observation()
    writer = (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return written.get["rows"]


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, a folder that all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


class Staged(NamedTuple):
    table: DataFrame
    rows: int
    path: str


def stage(df: DataFrame, name: str, path: str | None = None) -> Staged:
    """``df`` written to the shared folder and read back, with its number of rows.

    Cuts the lineage, so that several readers neither recompute the input nor depend
    on the executors that made it, and gives Catalyst the real size for its joins.
    Like a checkpoint, the files stay until ``unstage`` or until the folder is cleaned;
    ``staging`` deletes them by itself.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    rows = write_table(df, path)
    return Staged(spark.read.schema(df.schema).parquet(path), rows, path)


def unstage(spark: SparkSession, path: str) -> None:
    """Delete staged files that nobody reads any more, or what a failed write left.

    The folder becomes a database for a moment and is dropped with all that is in it: SQL's
    way to delete files in any store that Spark writes to, in every kind of session.
    """
    name, place = f"unstage_{uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@contextmanager
def staging(spark: SparkSession) -> Iterator:
    """A ``stage`` whose files are deleted at the end, also if something failed."""
    paths: list[str] = []

    def staged(df: DataFrame, name: str) -> Staged:
        paths.append(f"{shared_folder(spark)}/{name}-{uuid4().hex}")
        return stage(df, name, paths[-1])

    try:
        yield staged
    finally:
        for path in paths:
            unstage(spark, path)
