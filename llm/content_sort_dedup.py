"""Exact duplicates by an external sort of the normalised content."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import pick, range_buckets, staged

LEAD = 32  # leading characters that the sampled splitters compare


def normalised(text: Column) -> Column:
    """``text`` with A-Z in lower case, nothing else changed; null becomes empty.

    ``lower`` does the same to texts of ASCII only, faster.
    """
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def content_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs``.

    Rows are range-partitioned by sampled splitters over the content's leading
    characters, its hash and the identifier, sorted by (lead, hash, content,
    identifier) inside each range, and every row is compared in full with its
    predecessor. The identifier is part of the order, so the copies of a hot text run
    through several ranges; the full texts at the range ends are then compared across
    the boundary, and groups chained. Of equal texts the largest ``doc_id`` is
    ``keep_id``; null ids count as smallest, and of rows that repeat that id all stay.
    Null text is empty text; an empty table gives no rows.
    """
    content = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text")
    )
    keyed = content.withColumns(
        {"lead": F.substring("text", 1, LEAD), "hash": F.xxhash64("text")}
    )
    order = ["lead", "hash", "text", "doc_id"]
    ranged = range_buckets(keyed, ["lead", "hash", "doc_id"])
    sort = Window.partitionBy("_bucket").orderBy(*order)
    up_to = sort.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (
        ranged.withColumn("_place", F.row_number().over(sort))
        .withColumn("_new", F.coalesce(F.lag("text").over(sort) != F.col("text"), F.lit(True)))
        .withColumn("_last", F.lead("text").over(sort).isNull())
        .withColumn("_group", F.sum(F.col("_new").cast("int")).over(up_to))
        .select(
            "doc_id",
            "_bucket",
            "_group",
            F.sha2("text", 256).alias("text_sha256"),
            # Full texts only at the ends of a range.
            F.when(F.col("_place") == 1, F.col("text")).alias("_first_text"),
            F.when(F.col("_last"), F.col("text")).alias("_last_text"),
        )
    )
    rows = staged(marked, "content-sorted")

    groups = rows.groupBy("_bucket", "_group").agg(
        F.max("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size")
    )
    groups = staged(groups.withColumn("_size", F.col("_size").cast("long")), "content-groups")
    chained = _chained(rows, groups)
    sizes = groups.join(chained, ["_bucket", "_group"], "left").select(
        "_bucket",
        "_group",
        F.when(F.col("_chain").isNull(), F.col("_keep")).otherwise(F.col("_chain_keep")).alias("keep_id"),
        F.coalesce("_chain_size", "_size").alias("group_size"),
    )
    return rows.join(sizes, ["_bucket", "_group"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _chained(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups that reach over range boundaries, with the id and size of their chain.

    A few rows a range, whatever the data: two ends each.
    """
    ends = groups.groupBy("_bucket").agg(F.max("_group").alias("_groups"))
    firsts = rows.filter(F.col("_first_text").isNotNull()).select(
        "_bucket", F.col("_first_text").alias("_text")
    )
    lasts = rows.filter(F.col("_last_text").isNotNull()).select(
        F.col("_bucket").alias("_before"), F.col("_last_text").alias("_text_before")
    )
    by_bucket = Window.orderBy("_bucket")
    ends = ends.withColumn("_before", F.lag("_bucket").over(by_bucket))  # empty ranges are passed
    touching = (
        ends.join(firsts, "_bucket")
        .join(lasts, "_before", "left")
        .select(
            "_bucket",
            "_groups",
            F.coalesce(F.col("_text") == F.col("_text_before"), F.lit(False)).alias("_goes_on"),
        )
    )
    # The chain of a range's last group starts where its text did: in this range, unless
    # one group fills it and goes on.
    starts = F.when(~(F.col("_goes_on") & (F.col("_groups") == 1)), F.col("_bucket"))
    last = F.last(starts, ignorenulls=True).over(
        by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    chains = touching.withColumn("_last_chain", last).withColumn(
        "_first_chain", F.when(F.col("_goes_on"), F.lag("_last_chain").over(by_bucket))
    )
    chains = staged(chains, "content-chains")
    members = (
        chains.select("_bucket", F.col("_groups").alias("_group"), F.col("_last_chain").alias("_chain"))
        .union(
            chains.filter("_goes_on").select("_bucket", F.lit(1).alias("_group"), "_first_chain")
        )
        .distinct()
        .join(groups, ["_bucket", "_group"])
    )
    whole = members.groupBy("_chain").agg(
        F.max("_keep").alias("_chain_keep"), F.sum("_size").alias("_chain_size")
    )
    return members.join(whole, "_chain").select(
        "_bucket", "_group", "_chain", "_chain_keep", "_chain_size"
    )


def op4_content_sort_dedup(spark, sf_dir: str) -> DataFrame:
    return content_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = """
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
           sha256(norm) AS text_sha256
    FROM t WINDOW g AS (PARTITION BY norm)
"""
