"""Rows that every operator must take."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("Text", StringType()),  # extra columns with clashing names
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("_bucket", StringType()),
        StructField("size", StringType()),
        StructField("_c0", StringType()),
        StructField("node", StringType()),
    ]
)


def words(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnoprstuvwz", k=draw.randint(2, 8))) for _ in range(n))


def rows() -> list[tuple]:
    """(doc_id, text, lang, source)"""
    long = words(30_000, 1)
    passage = words(30, 2)
    edited = words(300, 3).split()
    again = [*edited]
    again[100] = "another"
    out = [
        (1, "Hello World, Ünï 𝒳!", "en", "a"),
        (2, "hELLO wORLD, Ünï 𝒳!", "en", "a"),
        (3, "hello world, ünï 𝒳!", "en", None),
        (4, None, None, None),
        (5, "", None, "b"),
        (None, "no id here at all", "de", "b"),
        (None, "no id here at all", "de", "b"),
        (6, long, "en", "c"),
        (7, long, "en", "c"),
        (8, "x " + passage + " y", None, "c"),
        (9, "other text " + passage, "de", "ä"),
        (10, " ".join(edited), "de", "ä"),
        (11, " ".join(again), "de", "ä"),
        (12, "1234 !!!", "en", "𝒵"),
        (12, "1234 !!!", "en", "𝒵"),
        (12, "one id, another text", "en", "￿"),
        (13, "a", "en", "b"),
    ]
    return out + [(100 + i, "a text that very many rows repeat " * 4, "en", "hot") for i in range(60)]


def frame(spark, found=None):
    found = rows() if found is None else found
    full = [("extra", d, t, lang, s, None if t is None else len(t), "x", "y", "z", "n") for d, t, lang, s in found]
    return spark.createDataFrame(full, SCHEMA)
