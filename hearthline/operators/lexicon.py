"""Scores of texts by a table of words."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import words


def lexicon_score_table(
    df: DataFrame,
    lexicon: DataFrame,
    key: str,
    text: str,
    *,
    word: str = "word",
    weight: str = "weight",
    width: int | None = None,
) -> DataFrame:
    """``key``, ``words`` (those of the lexicon, with repeats) and ``score`` for each row of ``df``.

    For lists too long for ``lexicon_score``: the score adds up the ``weight`` of every word
    of the ``lexicon``, a table of any size; a word that stands there twice counts with
    the sum of its weights, a NULL weight is 0. Words end as for ``lexicon_score``; the
    lexicon's must be lower-case. NULL and empty texts have no words and the score 0.

    Rows are dealt out by number to ``width`` tasks (the session's shuffle partitions by
    default), so that neither hot keys nor copies gather, and cut into words there. Each
    row's words are counted before the join, without another shuffle, and its hits added
    up after it. Spark broadcasts the lexicon if it knows it to be small; else both sides
    are shuffled by word, where adaptive execution splits frequent ones.
    """
    n = width or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartition(n, "row")
    tokens = rows.select("row", "key", F.explode_outer(words(F.col("text"))).alias("word"))
    counts = tokens.groupBy("row", "key", "word").agg(F.count(F.lit(1)).alias("n"))
    listed = lexicon.select(F.col(word).alias("_word"), F.col(weight).alias("weight"))
    weights = (
        listed.filter("_word <> ''")
        .groupBy("_word")
        .agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("weight"))
    )
    hits = counts.join(weights, F.col("word") == F.col("_word"), "left")
    scores = hits.groupBy("row", "key").agg(
        F.coalesce(F.sum(F.when(F.col("_word").isNotNull(), F.col("n"))), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.col("n") * F.col("weight")), F.lit(0)).alias("score"),
    )
    return scores.select(F.col("key").alias(key), "words", "score")
