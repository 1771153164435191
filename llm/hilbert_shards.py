"""Shards along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import pick, prefix_sums, staged

BITS = 8  # of each dimension


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of a cell along the Hilbert curve, by Skilling's transposition of the axes.

    ``cells`` are whole numbers below ``2**bits``. One expression of fixed size: the
    steps (bit, axis) are folded over the array of coordinates.
    """
    n = len(cells)
    axes = F.array(*(c.cast("long") for c in cells))

    def undo(x: Column, step: Column) -> Column:
        bit, axis = step["bit"], step["axis"]
        mask, first, here = bit - 1, F.get(x, F.lit(0)), F.get(x, axis)
        swap = first.bitwiseXOR(here).bitwiseAND(mask)
        flip = here.bitwiseAND(bit) != 0
        return F.transform(
            x,
            lambda v, j: F.when((j == 0) & flip, v.bitwiseXOR(mask))
            .when(~flip & ((j == 0) | (j == axis)) & (axis != 0), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    steps = F.array(
        *(
            F.struct(F.lit(1 << b).cast("long").alias("bit"), F.lit(a).alias("axis"))
            for b in range(bits - 1, 0, -1)
            for a in range(n)
        )
    )
    x = F.aggregate(axes, F.array().cast("array<long>"), lambda done, v: F.concat(done, F.array(v)))
    x = F.aggregate(steps, x, undo)
    gray = F.aggregate(
        x,
        F.array().cast("array<long>"),
        lambda done, v: F.concat(
            done, F.array(v.bitwiseXOR(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0))))
        ),
    )

    def twist(g: Column) -> Column:
        last = F.element_at(g, -1)
        masks = F.array(*(F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)))
        turn = F.aggregate(
            masks,
            F.lit(0).cast("long"),
            lambda t, bit: F.when(last.bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t),
        )
        return F.transform(g, lambda v: v.bitwiseXOR(turn))

    def interleave(t: Column) -> Column:
        places = F.array(
            *(
                F.struct(F.lit(b).alias("bit"), F.lit(a).alias("axis"))
                for b in range(bits - 1, -1, -1)
                for a in range(n)
            )
        )
        one = F.lit(1).cast("long")
        return F.aggregate(
            places,
            F.lit(0).cast("long"),
            lambda h, p: F.shiftleft(h, 1).bitwiseOR(
                F.call_function("shiftright", F.get(t, p["axis"]), p["bit"]).bitwiseAND(one)
            ),
        )

    # One-element arrays bind an intermediate result, which is thus computed once.
    turned = F.transform(F.array(gray), twist)
    return F.element_at(F.transform(turned, interleave), 1)


def share_bins(df: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with the bin of a text: its place among all rows by code point, ``2**bits`` bins.

    Null comes first. The bins follow the rows, so a frequent value takes many of them.
    """
    total = max(df.count(), 1)
    values = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(staged(values, "values"), ["_value"], "_before", "_n", "bins")
    bins = placed.select(
        "_value", F.expr(f"cast((_before << {bits}) div {total}L as int)").alias(name)
    )
    return df.join(bins, F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def shard(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the curve's ``hilbert``.

    Source and language (by their place among all rows in code point order) and size (by
    its logarithm) are quantised, the rows sorted along the curve and cut into runs under
    the law ``rows``: counts differ by one at most. ``slot`` is the place in the run. Ties
    go by checksum, then size and ``doc_id``, so equal texts of a cell lie together; of
    another source or language they lie where those do. A null text has size 1 and the checksum of no bytes; null
    sources and languages are a value of their own; an empty table gives no rows.
    Texts are read once, only the metadata is sorted.
    """
    text = F.coalesce("text", F.lit(""))
    meta = pick(docs, doc_id="doc_id", text="text", lang="lang", source="source").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "lang",
        "source",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    meta = staged(meta, "metadata")
    rows = meta.count()
    cells = share_bins(share_bins(meta, "source", "_source"), "lang", "_lang")
    log = F.floor(F.log2(F.col("size").cast("double")) * (1 << bits) / 64).cast("int")
    curve = cells.withColumn(
        "hilbert",
        hilbert_index([F.col("_source"), F.col("_lang"), F.least(log, F.lit((1 << bits) - 1))], bits),
    ).select("doc_id", "size", "text_crc32", "hilbert")
    ranked = prefix_sums(
        staged(curve, "curve"), ["hilbert", "text_crc32", "size", "doc_id"], "_rank", None, "ranked"
    )
    at = F.expr(f"cast(_rank * {shards} div {max(rows, 1)}L as int)")
    return ranked.select("doc_id", "size", "text_crc32", "hilbert", "_rank", at.alias("shard")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"_rank - (shard * {rows}L + {shards - 1}) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """All columns of ``docs`` (one row per ``doc_id``) as one folder a shard, in curve order.

    Each run is rebalanced into files of Spark's advisory size, each a stretch of the
    curve, so the minima and maxima of all dimensions in their footers prune files. Names
    that differ by case only get their place as a suffix (``text``, ``Text_1``), the four
    that ``shard`` reads never.
    """
    placed = shard(docs, shards).select(
        F.col("doc_id").alias("_doc"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")
    )
    names = docs.columns
    plain = docs.toDF(*(f"_c{i}" for i in range(len(names))))
    key = F.col(f"_c{names.index('doc_id')}").cast("long")
    joined = plain.join(placed, key.eqNullSafe(F.col("_doc"))).drop("_doc")
    ordered = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").drop("_slot")
    met = {"_shard", "doc_id", "text", "lang", "source"}
    for i, name in enumerate(names):
        if name.lower() in met and name not in ("doc_id", "text", "lang", "source"):
            name = f"{name}_{i}"
        met.add(name.lower())
        ordered = ordered.withColumnRenamed(f"_c{i}", name)
    ordered.write.partitionBy("_shard").parquet(path)


def hilbert_sql(rows: str, cells: list[str], bits: int = BITS) -> str:
    """CTEs ``s0, s1 ... curve``: ``rows`` with the Hilbert index of its columns ``cells``, step by step."""
    n, x = len(cells), [f"x{a}" for a in range(len(cells))]
    steps = [f"s0 AS (SELECT *, {', '.join(f'CAST({c} AS BIGINT) AS {v}' for c, v in zip(cells, x))} FROM {rows})"]

    def step(values: dict[str, str]) -> None:
        replaced = ", ".join(f"{value} AS {name}" for name, value in values.items())
        steps.append(f"s{len(steps)} AS (SELECT * REPLACE ({replaced}) FROM s{len(steps) - 1})")

    for b in range(bits - 1, 0, -1):
        for a in range(n):
            bit, mask, swap = 1 << b, (1 << b) - 1, f"(xor(x0, x{a}) & {(1 << b) - 1})"
            if a:
                step({
                    "x0": f"CASE WHEN x{a} & {bit} <> 0 THEN xor(x0, {mask}) ELSE xor(x0, {swap}) END",
                    x[a]: f"CASE WHEN x{a} & {bit} <> 0 THEN x{a} ELSE xor(x{a}, {swap}) END",
                })
            else:
                step({"x0": f"CASE WHEN x0 & {bit} <> 0 THEN xor(x0, {mask}) ELSE x0 END"})
    for a in range(1, n):
        step({x[a]: f"xor(x{a}, x{a - 1})"})
    turn = "0"
    for b in range(bits - 1, 0, -1):
        turn = f"xor({turn}, CASE WHEN {x[-1]} & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    step({v: f"xor({v}, {turn})" for v in x})
    places = [f"(((x{a} >> {b}) & 1) << {b * n + n - 1 - a})" for b in range(bits) for a in range(n)]
    steps.append(f"curve AS (SELECT *, CAST({' + '.join(places)} AS BIGINT) AS hilbert FROM s{len(steps) - 1})")
    return ", ".join(steps)


def bins_sql(column: str) -> str:
    return f"(SELECT {column}, (sum(count(*)) OVER (ORDER BY {column} NULLS FIRST) - count(*)) * {1 << BITS} // (SELECT count(*) FROM documents) AS bin FROM documents GROUP BY {column})"


_bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_byte = f"list_reduce([xor(a, b)] || range(8), lambda x, y: {_bit})"
_bytes = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))"
ORACLE = f"""
    WITH texts AS (
        SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents
    ), metadata AS (
        SELECT doc_id, lang, source, CAST(strlen(text) + 1 AS BIGINT) AS size,
               xor(list_reduce([CAST(4294967295 AS BIGINT)] || {_bytes}, lambda a, b: {_byte}), 4294967295) AS text_crc32
        FROM texts
    ), cells AS (
        SELECT metadata.*, s.bin AS of_source, l.bin AS of_lang,
               least(floor(ln(size) / ln(2) * {1 << BITS} / 64), {(1 << BITS) - 1}) AS of_size
        FROM metadata JOIN {bins_sql("source")} s ON metadata.source IS NOT DISTINCT FROM s.source
             JOIN {bins_sql("lang")} l ON metadata.lang IS NOT DISTINCT FROM l.lang
    ), {hilbert_sql("cells", ["of_source", "of_lang", "of_size"])}, ranked AS (
        SELECT *, count(*) OVER () AS n,
               row_number() OVER (ORDER BY hilbert, text_crc32, size, doc_id NULLS FIRST) - 1 AS place
        FROM curve
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 16 // n AS INTEGER) AS shard,
           CAST(place - (place * 16 // n * n + 15) // 16 AS BIGINT) AS slot,
           CAST(NULL AS INTEGER) AS grown_shard, hilbert
    FROM ranked
"""


def op3_hilbert_shards(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
