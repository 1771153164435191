"""Exact rank over all rows."""

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DRAWS = 16  # values drawn for each range


def with_rank(
    df: DataFrame, by: str, name: str, *, ranges: int | None = None, once: bool = True
) -> DataFrame:
    """``df`` with the SQL ``rank()`` of the column ``by``, highest first, NULL last.

    Any type that can be ordered, NaN above all numbers; a column ``name`` is replaced.
    The rows are dealt out to ``ranges`` ranges of values (the session's shuffle partitions
    by default), sorted and ranked inside, and shifted by the rows of higher ranges: one
    shuffle and no join by value. A value with so many rows that it would fill a range is
    a range of its own; its rows all have one rank and stay anywhere. All of it is one plan:
    no job runs and no file is written before the result is asked for.

    The ranges come from drawn values. ``once`` draws them from whole rows, so that what an
    aggregate or a join has shuffled is shared, and read and computed once. Turn it off for
    the scan of a stored table: the draw then reads the column ``by`` alone.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [f"c{i}" for i in range(len(df.columns))]
    flat = df.withColumn(f"_{uuid4().hex}", F.col(by)).toDF(*columns, "value")
    # As far as Catalyst knows the row may be missing, so none of its columns is pruned and all
    # readers have the same plan below.
    whole = f"if(rand(1) >= 0, struct({', '.join(columns)}, value), NULL) AS row"
    rows = flat.selectExpr(whole, "rand(2) AS draw")
    drawn = rows if once else flat.selectExpr("struct(value) AS row", "rand(2) AS draw")

    found = rows.withColumn("cuts", _cuts(drawn, n).scalar()).selectExpr(
        "row", "draw", "cuts", f"{_range(n)} AS place"
    )
    crowded = "get(cuts, place - 1).crowded AND get(cuts, place - 1).value = row.value"
    found = found.selectExpr(
        "row", "draw", "place", f"row.value IS NULL OR coalesce({crowded}, false) AS own"
    )
    found = found.selectExpr(
        "row",
        "own",
        f"if(own, CAST(floor(draw * {n}) AS int), place) AS part",
        "2 * place + if(own, 0, 1) AS height",
    )
    # As many rows as there are ranges: one task and a broadcast are enough.
    higher = "sum(n) OVER (ORDER BY height DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = found.groupBy("height").agg(F.count("row").alias("n"))
    offsets = counts.selectExpr("height", f"coalesce({higher}, 0L) AS above")
    dealt = found.repartitionById(n + 1, F.col("part"))
    inside = dealt.selectExpr(
        "row", "own", "height", "rank() OVER (PARTITION BY part ORDER BY own, row.value DESC) AS inside"
    )
    ranked = inside.join(F.broadcast(offsets), "height").selectExpr(
        *(f"row.{c}" for c in columns), "above + if(own, 1, inside) AS rank"
    )
    rank = f"_{uuid4().hex}"
    return ranked.toDF(*df.columns, rank).withColumn(name, F.col(rank)).drop(rank)


def _cuts(rows: DataFrame, ranges: int) -> DataFrame:
    """One row: a sorted array of at most ``ranges`` values that part the rows about evenly.

    Each has a mark ``crowded`` if its rows would fill a range. The number of draws is
    bounded, and partial aggregates carry no more than that.
    """
    drawn = rows.selectExpr("row.value AS value", "draw").filter("value IS NOT NULL")
    drawn = drawn.groupBy(F.expr(f"floor(draw * {ranges * DRAWS}) AS bin")).agg(
        F.min_by("value", "draw").alias("value")
    )
    ordered = drawn.selectExpr(
        f"filter(array_sort(collect_list(value)), (x, i) -> i % {DRAWS} = {DRAWS // 2}) AS value"
    )
    marked = "(x, i) -> struct(x AS value, get(value, i + 1) <=> x AS crowded, get(value, i - 1) <=> x AS again)"
    return ordered.selectExpr(f"filter(transform(value, {marked}), cut -> NOT cut.again) AS cuts")


def _range(ranges: int) -> str:
    """How many of the ``cuts`` are not above ``row.value``, by binary search; 0 for NULL."""
    middle = "shiftright(at.low + at.high, 1)"
    halve = f"""
        if(at.low < at.high AND get(cuts, {middle}).value <= row.value,
           named_struct('low', {middle} + 1, 'high', at.high),
           named_struct('low', at.low, 'high', {middle}))"""
    steps = f"sequence(1, {ranges.bit_length() + 1})"
    found = f"aggregate({steps}, named_struct('low', 0, 'high', size(cuts)), (at, _) -> {halve}, at -> at.low)"
    return f"if(row.value IS NULL, 0, {found})"
