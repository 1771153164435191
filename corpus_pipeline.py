"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import content_sort_dedup, grouped_packing, language_id, source_mix, weighted_minhash
from llm.common import pick, staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NULL_ID = -(2**63)


def documents(docs: DataFrame) -> DataFrame:
    return pick(docs, **{c: c for c in COLUMNS}).withColumn("doc_id", F.col("doc_id").cast("long"))


def keyed(docs: DataFrame, sha) -> DataFrame:
    """Documents with ``_id`` and ``_sha``, one of rows that repeat both."""
    rows = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(NULL_ID)), "_sha": sha})
    return rows.dropDuplicates(["_id", "_sha"])


def kept(docs: DataFrame, chosen: DataFrame, sha) -> DataFrame:
    """The documents that ``chosen`` (``doc_id``, ``sha``) names."""
    names = chosen.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.col("sha").alias("_sha"))
    return keyed(docs, sha).join(names.distinct(), ["_id", "_sha"], "left_semi").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model learns from their own labels."""
    return language_id.known_language(documents(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the document with the largest id stays."""
    docs = documents(docs)
    groups = content_sort_dedup.content_groups(docs).filter("kept")
    sha = F.sha2(content_sort_dedup.normalised(F.col("text")), 256)
    return kept(docs, groups.withColumnRenamed("text_sha256", "sha"), sha)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    docs = documents(docs)
    classes = weighted_minhash.near_classes(docs).filter("kept")
    return kept(docs, classes, F.sha2(F.coalesce("text", F.lit("")), 256))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; where a budget ends, its first words."""
    docs = documents(docs)
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    mixed = source_mix.mix(docs.withColumn("_sha", sha), also=("_sha",))
    # Rows that repeat id and text are taken together, and are one row of `keyed`.
    times = mixed.groupBy(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), "_sha", "source").agg(
        F.sum(F.expr("if(size > 0, taken div size, 0L)")).cast("int").alias("_whole"),
        F.max("size").alias("_size"),
        F.sum(F.expr("if(size > 0, taken % size, 0L)")).cast("int").alias("_words"),
    )
    times = times.groupBy("_id", "_sha").agg(
        F.sum("_whole").cast("int").alias("_whole"), F.sum("_words").cast("int").alias("_words")
    )
    joined = keyed(docs, sha).join(times, ["_id", "_sha"])
    # Parts of the text that end where a word does, for the first words only.
    parts = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", -1)
    first = F.array_join(F.slice(parts, F.lit(1), F.col("_words")), "")
    takes = F.concat(
        F.array_repeat(F.lit(True), F.col("_whole")),
        F.when(F.col("_words") > 0, F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>")),
    )
    taken = joined.withColumn("_all", F.explode(takes))
    text = F.when(F.col("_all"), F.col("text")).otherwise(first)
    return taken.select(
        "doc_id",
        text.alias("text"),
        "lang",
        "source",
        F.when(F.col("_all"), F.col("n_chars")).otherwise(F.char_length(text)).cast("long").alias("n_chars"),
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into token sequences, a row for each piece."""
    return grouped_packing.pack(documents(docs))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Language ID, weighted sampling and the tokenizer are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
