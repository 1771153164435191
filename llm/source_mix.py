"""Sources mixed to target weights by random keys, prefix sums and exact cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import pick, prefix_sums, staged

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3  # times a source may be repeated
SEED = "mix"


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target, earlier`` of a table ``source, source_size``.

    Sources by code point, null last, weigh 1, 2, 3, repeating. Shares beyond ``most``
    times the size are given to the others by weight until none is above. Only sums
    over the sources come to the driver. ``earlier`` is the size of all sources before.
    """
    keyed = sizes.withColumns(
        {"_null": F.col("source").isNull(), "source_size": F.col("source_size").cast("long")}
    )
    keyed = prefix_sums(staged(keyed, "sources"), ["_null", "source"], "_at", None, "ordered")
    keyed = prefix_sums(keyed, ["_null", "source"], "earlier", "source_size", "sized")
    keyed = keyed.withColumn("_weight", (F.col("_at") % 3 + 1).cast("double"))
    total = keyed.agg(F.sum("source_size")).first()[0] or 0
    room, level = F.col("source_size") * most, 0.0
    while True:  # the level only rises, and each round fills another source
        full = room <= F.col("_weight") * level
        filled, weight = keyed.agg(
            F.sum(F.when(full, room)), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        raised = (total - (filled or 0)) / weight if weight else level
        if raised <= level:
            break
        level = raised
    target = F.least(room.cast("double"), F.col("_weight") * F.lit(level))
    return keyed.select("source", "source_size", target.alias("target"), "earlier")


def mix(
    docs: DataFrame, most: int = MOST, seed: str = SEED, also: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of ``docs``.

    ``also`` names further columns to pass on.

    Rows are ordered by source and a random key hashed from ``seed`` and ``doc_id``;
    exact prefix sums of the sizes place every row in its source. The budget, the
    target to the nearest word, takes whole epochs of the source and then a last one up
    to the exact word, within one document. A hot source runs through many ranges.
    Null text has no words, a null source is a source, an empty table gives no rows;
    repeated ids are ordered by size, and equal rows are interchangeable.
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    passed = {f"_also{i}": name for i, name in enumerate(also)}
    sized = pick(docs, doc_id="doc_id", text="text", source="source", **passed).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        words.alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")).alias("_key"),
        F.col("source").isNull().alias("_null"),
        *passed,
    )
    sized = staged(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(totals, most), "targets")
    placed = prefix_sums(sized, ["_null", "source", "_key", "doc_id", "size"], "_before", "size", "placed")
    targets = targets.withColumnRenamed("source", "_source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_budget", F.floor(F.col("target") + 0.5).cast("long")
    )
    epochs = F.expr("if(source_size > 0, _budget div source_size, 0L)")
    rest = F.expr("if(source_size > 0, _budget % source_size, 0L)")
    last = F.least(F.greatest(rest - (F.col("_before") - F.col("earlier")), F.lit(0).cast("long")), F.col("size"))
    return joined.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).alias("taken"),
        *(F.col(own).alias(name) for own, name in passed.items()),
    )


ORACLE = f"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
               md5(concat_ws(':', '{SEED}', CAST(doc_id AS VARCHAR))) AS key
        FROM documents
    ), sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
        FROM sized GROUP BY source
    ), levels AS (
        SELECT CAST(0 AS DOUBLE) AS level
        UNION ALL
        SELECT raised FROM (
            SELECT level, (sum(source_size) - coalesce(sum(source_size * {MOST}) FILTER (full_up), 0))
                          / CAST(sum(weight) FILTER (NOT full_up) AS DOUBLE) AS raised
            FROM (SELECT *, source_size * {MOST} <= weight * level AS full_up FROM levels, sources)
            GROUP BY level
        ) WHERE raised > level
    ), targets AS (
        SELECT source, source_size,
               least(CAST(source_size * {MOST} AS DOUBLE), weight * (SELECT max(level) FROM levels)) AS target
        FROM sources
    ), placed AS (
        SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
               CAST(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS earlier
        FROM sized JOIN targets USING (source)
        UNION ALL
        SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT),
               CAST(sum(size) OVER (ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size
        FROM sized JOIN targets ON sized.source IS NULL AND targets.source IS NULL
    )
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
                + least(greatest(budget % source_size - earlier, 0), size) END AS taken
    FROM placed
"""


def op7_source_mix(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
