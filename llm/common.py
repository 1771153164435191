"""Helpers of the operators: named columns, written tables, range buckets, prefix sums."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SAMPLED = 40  # rows sampled for each range bucket; they steer the balance only


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The columns named by the values, renamed to the keys.

    Found by position and exact name, so that extra columns, also some that differ
    only by case or share internal names, never get in the way.
    """
    names = df.columns
    plain = df.toDF(*(f"_c{i}" for i in range(len(names))))
    return plain.select(
        *(F.col(f"_c{names.index(column)}").alias(name) for name, column in columns.items())
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temp folder only for local sessions without."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        folder = context.getCheckpointDir()
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(cuts: list[tuple], keys: list[str], df: DataFrame) -> Column:
    """How many of the sorted ``cuts`` are not above the row's keys, by binary search."""
    if not cuts:
        return F.lit(0)
    kinds = [df.schema[k].dataType for k in keys]
    table = F.array(
        *(
            F.struct(*(F.lit(v).cast(t).alias(k) for v, t, k in zip(cut, kinds, keys)))
            for cut in cuts
        )
    )
    key = F.struct(*(F.col(k) for k in keys))

    def halve(at: Column, _: Column) -> Column:
        low, high = at["low"], at["high"]
        middle = F.shiftright(low + high, 1)
        right = (low < high) & (F.get(table, middle) <= key)
        return F.when(right, F.struct((middle + 1).alias("low"), high.alias("high"))).otherwise(
            F.struct(low.alias("low"), middle.alias("high"))
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(steps, start, halve, lambda at: at["low"])


def range_buckets(df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` dealt out to ranges of ``keys``, with their number as ``_bucket``.

    The splitters are quantiles of a bounded sample (``SAMPLED`` rows a bucket). Keys
    that end in an identifier part hot values too. The rows of a bucket are in one
    task, and Spark knows: a window by ``_bucket`` needs no further shuffle.
    """
    n = buckets or width(df.sparkSession)
    rows = df.count()
    share = min(1.0, SAMPLED * n / max(rows, 1))
    sampled = df.select(*keys).sample(share, seed=17).repartition(1).sortWithinPartitions(*keys)
    sample = [tuple(r) for r in sampled.collect()]
    at = sorted({len(sample) * i // n for i in range(1, n)}) if sample else []
    cuts = list(dict.fromkeys(sample[i] for i in at))
    return df.withColumn("_bucket", bucket_of(cuts, keys, df)).repartitionById(n, F.col("_bucket"))


def prefix_sums(
    df: DataFrame, keys: list[str], name: str, weight: str | None = None, label: str = "sums"
) -> DataFrame:
    """``df`` with ``name``: the exact sum of ``weight`` (rows, if None) before each row.

    Order: ``keys``, nulls first. Sums inside range buckets, then one offset a bucket;
    the offsets are as many rows as there are buckets, so they are broadcast.
    """
    value = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    before = (
        Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = staged(
        range_buckets(df, keys)
        .withColumn("_w", value)
        .withColumn("_in", F.coalesce(F.sum("_w").over(before), F.lit(0).cast("long"))),
        label,
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        local.groupBy("_bucket")
        .agg(F.sum("_w").alias("_w"))
        .select("_bucket", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_offset"))
    )
    return local.join(F.broadcast(offsets), "_bucket").select(
        *df.columns, (F.col("_in") + F.col("_offset")).alias(name)
    )
