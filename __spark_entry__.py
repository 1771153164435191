"""Registered queries: every operator on the given tables, with its DuckDB oracle.

There are no listings or reviews among the given tables, so two pairs stand in:

* text pair: suppliers as listings, documents as their reviews;
* volume pair: orders as entities, their line items as children.
"""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Callable
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

sys.path.insert(0, str(Path(__file__).resolve().parent))  # loaded from anywhere

from hearthline.functions import (
    NEGATIVE,
    POSITIVE,
    band,
    currency,
    lexicon_function,
    lexicon_score,
    words,
)
from hearthline.operators import (
    SENTIMENT,
    TEXT_LENGTH,
    group_stats,
    length_by_entity,
    lexicon_score_table,
    match_profile,
    score_by_group,
    sql_over,
    top_by_matches,
    with_rank,
    within,
    without_match,
)
from hearthline.plans import build_gold
from hearthline.sinks import shared_folder, stage, write_table
from hearthline.sources import read_wide_csv, spread_rows

try:  # the operators for training data are a part that can be left out
    from llm import registry
except ImportError as missing:
    if missing.name not in ("llm", "corpus_pipeline"):
        raise
    registry = None

# The documents are invented prose without the words of the built-in lists.
TIED = (3, 4, 20)
JOB_FLOOR, JOB_TOP = 3, 5
PLUS = ("the", "and", "that")
MINUS = ("of", "to")

BANDS = [("low", 100_000.0), ("middle", 300_000.0)]
CLEANING = {
    "min_price": 10.0,
    "max_price": 9_000.0,
    "budget_ceiling": 2_000.0,
    "midrange_ceiling": 5_000.0,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for what a query writes and its result reads; a local session may have none."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def tasks(spark: SparkSession) -> int:
    """Width for the costly scans: the given tables may be a single file."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Stand-in inputs


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their total as a currency string; every 37th key has none."""
    text = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 37 == 0, "N/A").otherwise(text).alias("price"),
    )


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(spark, sf_dir).withColumn("price_num", currency(F.col("price")))


def plausible_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return within(priced_orders(spark, sf_dir), "price_num", 5_000, 450_000)


def banded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausible_orders(spark, sf_dir).withColumn(
        "band", band(F.col("price_num"), BANDS, "high")
    )


def supplier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a key ``id``: every tenth stands there twice, some have none."""
    once = table(spark, sf_dir, "supplier")
    rows = once.unionByName(once.filter("s_suppkey % 10 = 0"))
    return rows.withColumn("id", F.when(F.col("s_suppkey") % 50 != 7, F.col("s_suppkey")))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_rows(spark, sf_dir).select(
        "id", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )


PRAISE = {0: " Great, clean. LOVELY", 1: " dirty and noisy", 2: "", 3: " nice terrible."}


def supplier_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews of the supplier numbered by their square, modulo all suppliers.

    Words of the built-in lists are added by key; some comments are NULL or empty, and
    some ids and listings NULL.
    """
    in_all = table(spark, sf_dir, "supplier").count()
    doc = F.col("doc_id")
    rest = doc % in_all
    praise = F.element_at(F.array(*map(F.lit, PRAISE.values())), (doc % 4 + 1).cast("int"))
    comment = F.when(doc % 13 != 5, F.concat("text", praise)).otherwise("")
    return table(spark, sf_dir, "documents").select(
        F.when(doc % 19 != 6, (rest * rest) % in_all).alias("listing_id"),
        F.when(doc % 17 != 4, doc).alias("id"),
        F.when(doc % 11 != 3, comment).alias("comments"),
        "doc_id",
    )


def review_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_profile(
        spread_rows(supplier_reviews(spark, sf_dir), tasks(spark)),
        "listing_id",
        id="id",
        text="comments",
        score=lexicon_score(F.col("comments"), PLUS, MINUS),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        compression="gzip",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a listings export: all columns are text, in another order, with more.

    Two nations have one price, so their averages tie.
    """
    key = F.col("s_suppkey")
    amount = F.when(F.col("s_nationkey").isin(*TIED), F.lit(2_500)).otherwise(F.floor("s_acctbal"))
    price = F.concat(F.lit("$"), F.format_number(amount.cast("double"), 2))
    return supplier_rows(spark, sf_dir).select(
        F.lit("https://example.org").alias("listing_url"),
        F.when(key % 37 == 0, "N/A").otherwise(price).alias("price"),
        F.col("s_nationkey").cast("string").alias("neighbourhood_cleansed"),
        F.concat(F.lit('A "quiet", tidy\nhome of '), "s_name").alias("name"),
        "id",
        F.col("s_nationkey").alias("host_id"),
        F.lit("host").alias("host_name"),
        F.lit("Private room").alias("room_type"),
        F.lit("Private room in home").alias("property_type"),
        F.lit("1,5").alias("amenities"),
        (key % 3 + 1).alias("minimum_nights"),
        (key % 9).alias("number_of_reviews"),
        F.lit(None).cast("double").alias("reviews_per_month"),
        F.when(key % 7 != 0, key % 5 + 1).alias("review_scores_rating"),
        F.lit("none").alias("review_scores_location"),
        F.lit("2020-06-01").alias("first_review"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_reviews(spark, sf_dir).select(
        "listing_id",
        "id",
        F.lit("2021-01-01").alias("date"),
        F.col("doc_id").alias("reviewer_id"),
        F.lit("guest").alias("reviewer_name"),
        "comments",
    )


def job(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """Folder and row counts of the whole job over the text pair as gzipped CSV."""
    folder = scratch(spark, "job")
    write_csv(raw_listings(spark, sf_dir), f"{folder}/listings")
    write_csv(raw_reviews(spark, sf_dir), f"{folder}/reviews")
    rows = build_gold(
        spark,
        f"{folder}/listings",
        f"{folder}/reviews",
        f"{folder}/gold",
        spread=tasks(spark),
        min_reviews=JOB_FLOOR,
        top_n=JOB_TOP,
        **CLEANING,
    )
    return f"{folder}/gold", rows


# Queries


def csv_scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "documents-csv")
    write_csv(table(spark, sf_dir, "documents"), path)
    columns = (
        StructType()
        .add("n_chars", LongType())
        .add("text", StringType())
        .add("doc_id", LongType())
        .add("source", StringType())
        .add("lang", LongType())  # text that is no number
    )
    return read_wide_csv(spark, path, columns)


def currency_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced_orders(spark, sf_dir).select("o_orderkey", "price", "price_num")


def plausible_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plausible_orders(spark, sf_dir).select("o_orderkey", "price_num")


def value_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return banded_orders(spark, sf_dir).select("o_orderkey", "price_num", "band")


def band_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_stats(
        banded_orders(spark, sf_dir),
        "band",
        "order_count",
        avg_price=("avg", "price_num"),
    ).orderBy(F.col("order_count").desc(), "band")


def line_stats(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return group_stats(
        table(spark, sf_dir, "lineitem"),
        key,
        "line_count",
        avg_price=("avg", "l_extendedprice"),
        min_price=("min", "l_extendedprice"),
        max_price=("max", "l_extendedprice"),
        avg_discount=("avg", "l_discount"),
    )


def group_stats_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rank(line_stats(spark, sf_dir, "l_suppkey"), "avg_price", "price_rank")


def group_stats_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_stats(spark, sf_dir, "l_orderkey")


def rank_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantities = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("quantity"))
    )
    return with_rank(quantities, "quantity", "quantity_rank")


def volume_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = match_profile(table(spark, sf_dir, "lineitem"), "l_orderkey", id="l_linenumber")
    return top_by_matches(
        table(spark, sf_dir, "orders"),
        lines,
        20,
        key="o_orderkey",
        label="o_orderpriority",
        count="line_count",
    )


def volume_without_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_match(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        key="o_orderkey",
        match_key="l_orderkey",
    ).select("o_orderkey", "o_orderpriority", "o_totalprice")


def without_match_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_match(
        suppliers(spark, sf_dir),
        supplier_reviews(spark, sf_dir),
        key="id",
        match_key="listing_id",
    )


def document_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = lexicon_score(F.col("text"), PLUS, MINUS).cast("bigint")
    documents = spread_rows(table(spark, sf_dir, "documents"), tasks(spark))
    return documents.select("doc_id", score.alias("score"))


def document_score_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = lexicon_score(F.col("comments")).cast("bigint")
    return supplier_reviews(spark, sf_dir).select("doc_id", score.alias("score"))


def document_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by 5,000 weighted words, which are taken from the documents themselves."""
    documents = table(spark, sf_dir, "documents")
    lexicon = stage(word_weights(documents), "lexicon", scratch(spark, "lexicon")).table
    return lexicon_score_table(documents, lexicon, "doc_id", "text")


def word_weights(documents: DataFrame) -> DataFrame:
    """The first 5,000 words of the documents by hash, with weights from -3 to 3."""
    found = documents.select(F.explode(words(F.col("text"))).alias("word")).filter("word <> ''").distinct()
    chosen = found.orderBy(F.md5("word"), "word").limit(5_000)
    return chosen.select("word", (F.ascii(F.md5("word")) % 7 - 3).cast("bigint").alias("weight"))


def nation_score_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = suppliers(spark, sf_dir).withColumnRenamed("nation", "neighbourhood_cleansed")
    reviews = spread_rows(supplier_reviews(spark, sf_dir), tasks(spark))
    scores = sql_over(
        spark,
        SENTIMENT,
        {"listings": listings, "reviews": reviews},
        functions={"lexicon_score": lexicon_function(PLUS, MINUS)},
    )
    return scores.withColumnRenamed("neighbourhood_cleansed", "nation")


def nation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_by_group(
        suppliers(spark, sf_dir), review_profile(spark, sf_dir), group="nation"
    )


def text_length_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(
        spark,
        TEXT_LENGTH,
        {"listings": suppliers(spark, sf_dir), "reviews": supplier_reviews(spark, sf_dir)},
        {"min_reviews": 5},
    )


def text_length_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = match_profile(
        supplier_reviews(spark, sf_dir), "listing_id", id="id", text="comments"
    )
    return length_by_entity(suppliers(spark, sf_dir), lengths, 5)


def text_length_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest_first = [F.col("avg_comment_length").desc(), "listing_id", "name"]
    return text_length_df(spark, sf_dir).orderBy(*longest_first).limit(20)


def profile_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_by_matches(suppliers(spark, sf_dir), review_profile(spark, sf_dir), 20)


def profile_without_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_match(
        suppliers(spark, sf_dir),
        review_profile(spark, sf_dir),
        key="id",
        match_key="listing_id",
        distinct=True,
    )


def profile_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_by_group(
        suppliers(spark, sf_dir), review_profile(spark, sf_dir), group="nation"
    )


def profile_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_by_entity(suppliers(spark, sf_dir), review_profile(spark, sf_dir), 5)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bands")
    banded = value_band(spark, sf_dir)
    write_table(banded, path, partition_by="band")
    return spark.read.schema(banded.schema).parquet(path)


def job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = job(spark, sf_dir)
    return spark.createDataFrame(list(rows.items()), "gold_table string, row_count bigint")


def job_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
        gold, _ = job(spark, sf_dir)
        written = spark.read.parquet(f"{gold}/{name}")
        ranks = [c for c, kind in written.dtypes if c == "price_rank" and kind == "int"]
        return written.withColumns({c: F.col(c).cast("bigint") for c in ranks})

    return read_back


GOLD_TABLES = (
    "listings_clean",
    "price_by_neighbourhood",
    "top_reviewed_listings",
    "listings_without_reviews",
    "price_category_summary",
    "sentiment_by_neighbourhood",
    "top_comment_length",
)


def entry(spark: SparkSession) -> DataFrame:
    """Currency parse, range filter, bands and their summary over the orders."""
    return band_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_scan_project": csv_scan_project,
        "currency_parse": currency_parse,
        "plausible_range": plausible_range,
        "value_band": value_band,
        "group_stats_rank": group_stats_rank,
        "group_stats_small": group_stats_small,
        "rank_bucketed": rank_bucketed,
        "top_by_matches": volume_top,
        "without_match": volume_without_match,
        "without_match_text": without_match_text,
        "band_summary": band_summary,
        "lexicon_score": document_score,
        "lexicon_score_builtin": document_score_builtin,
        "lexicon_score_table": document_score_table,
        "score_by_group": nation_score,
        "sentiment_sql": nation_score_sql,
        "text_length_sql": text_length_sql,
        "text_length_df": text_length_df,
        "text_length_top": text_length_top,
        "profile_top": profile_top,
        "profile_without_match": profile_without_match,
        "profile_score": profile_score,
        "profile_length": profile_length,
        "sink_roundtrip": sink_roundtrip,
        "job_counts": job_counts,
        **{f"job_{name}": job_table(name) for name in GOLD_TABLES},
        **(registry.QUERIES if registry else {}),
    }


# Oracles


def score_sql(text: str, plus: tuple[str, ...], minus: tuple[str, ...]) -> str:
    words = f"regexp_split_to_array(lower(translate({text}, '.,', '  ')), '\\s+')"

    def hits(bank: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{word}'" for word in bank)
        return f"len(list_filter({words}, lambda w: w IN ({listed})))"

    return f"coalesce({hits(plus)} - {hits(minus)}, 0)"


def oracle_sql() -> dict[str, str]:
    prices = """
        SELECT o_orderkey, price, price_num FROM (
            SELECT *, try_cast(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE) AS price_num
            FROM (
                SELECT o_orderkey,
                       CASE WHEN o_orderkey % 37 = 0 THEN 'N/A'
                            ELSE '$' || format('{:,.2f}', o_totalprice) END AS price
                FROM orders))
    """
    plausible = f"""
        SELECT o_orderkey, price_num FROM ({prices}) WHERE price_num BETWEEN 5000 AND 450000
    """
    bands = f"""
        SELECT o_orderkey, price_num,
               CASE WHEN price_num < 100000 THEN 'low'
                    WHEN price_num < 300000 THEN 'middle' ELSE 'high' END AS band
        FROM ({plausible})
    """
    praise = " ".join(f"WHEN {rest} THEN '{words}'" for rest, words in PRAISE.items())
    reviews = f"""
        SELECT CASE WHEN doc_id % 19 <> 6 THEN ((doc_id % n) * (doc_id % n)) % n END AS listing_id,
               CASE WHEN doc_id % 17 <> 4 THEN doc_id END AS id, doc_id,
               CASE WHEN doc_id % 11 <> 3 THEN
                    CASE WHEN doc_id % 13 <> 5 THEN text || CASE doc_id % 4 {praise} END
                         ELSE '' END END AS comments
        FROM documents, (SELECT count(*) AS n FROM supplier)
    """
    supplier = """
        SELECT *, CASE WHEN s_suppkey % 50 <> 7 THEN s_suppkey END AS id
        FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey % 10 = 0)
    """
    entities = f"SELECT id, s_name AS name, s_nationkey AS nation FROM ({supplier})"

    def exact(total: str, n: str, digits: int) -> str:
        """Their quotient, rounded half away from zero in whole numbers."""
        total, n = f"CAST({total} AS HUGEINT)", f"CAST({n} AS HUGEINT)"
        return f"""CASE WHEN {n} > 0 THEN CAST(sign({total}) * ((2 * {10**digits} * abs({total}) + {n})
                   // (2 * {n})) AS DOUBLE) / {10.0**digits} END"""

    def exact_avg(column: str, unit: int = 1, digits: int = 2) -> str:
        return exact(f"sum(CAST(round({column} * {unit}) AS BIGINT))", f"({unit} * count({column}))", digits)

    joined = f"({reviews}) r JOIN ({entities}) l ON r.listing_id = l.id"
    score = score_sql("comments", PLUS, MINUS)
    builtin_score = score_sql("comments", POSITIVE, NEGATIVE)
    scores = f"""
        SELECT nation, count(*) AS review_count, {exact_avg(score, 1, 3)} AS avg_sentiment
        FROM {joined} GROUP BY nation
    """
    lengths = f"""
        SELECT r.listing_id, l.name, {exact_avg("length(r.comments)", 1, 1)} AS avg_comment_length,
               count(r.id) AS reviews_count
        FROM {joined} GROUP BY r.listing_id, l.name HAVING count(r.id) >= 5
    """

    def line_stats_sql(key: str) -> str:
        return f"""
            SELECT {key}, count(*) AS line_count,
                   {exact_avg("l_extendedprice", 100)} AS avg_price,
                   round(min(l_extendedprice), 2) AS min_price,
                   round(max(l_extendedprice), 2) AS max_price,
                   {exact_avg("l_discount", 100)} AS avg_discount
            FROM lineitem GROUP BY {key}
        """

    unmatched = f"""
        SELECT * FROM ({entities}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({reviews}) r WHERE r.listing_id = l.id)
    """

    # The job's tables.
    listings = f"""
        SELECT *, CASE WHEN price_num < 2000 THEN 'Budget'
                       WHEN price_num < 5000 THEN 'Mid-range' ELSE 'Luxury' END AS price_category
        FROM (
            SELECT id, 'A "quiet", tidy' || chr(10) || 'home of ' || s_name AS name,
                   CAST(s_nationkey AS BIGINT) AS host_id, 'host' AS host_name,
                   CAST(s_nationkey AS VARCHAR) AS neighbourhood_cleansed,
                   'Private room' AS room_type, 'Private room in home' AS property_type,
                   '$' || format('{{:,.2f}}', amount) AS price,
                   CAST(s_suppkey % 3 + 1 AS INTEGER) AS minimum_nights,
                   CAST(s_suppkey % 9 AS INTEGER) AS number_of_reviews,
                   CAST(NULL AS DOUBLE) AS reviews_per_month,
                   CAST(CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 5 + 1 END AS DOUBLE)
                       AS review_scores_rating,
                   CAST(NULL AS DOUBLE) AS review_scores_location,
                   DATE '2020-06-01' AS first_review,
                   amount AS price_num
            FROM (SELECT *, CASE WHEN s_nationkey IN {TIED} THEN CAST(2500 AS DOUBLE)
                                 ELSE floor(s_acctbal) END AS amount FROM ({supplier}))
            WHERE s_suppkey % 37 <> 0)
        WHERE price_num BETWEEN 10 AND 9000
    """

    by_neighbourhood = f"""
        SELECT *, rank() OVER (ORDER BY avg_price DESC NULLS LAST) AS price_rank FROM (
            SELECT neighbourhood_cleansed, count(*) AS listing_count,
                   {exact_avg("price_num")} AS avg_price, min(price_num) AS min_price,
                   max(price_num) AS max_price, {exact_avg("review_scores_rating")} AS avg_rating
            FROM ({listings}) GROUP BY neighbourhood_cleansed)
    """
    job_joined = f"({reviews}) r JOIN ({listings}) l ON r.listing_id = l.id"
    top_reviewed = f"""
        SELECT l.id, l.name, count(r.id) AS num_reviews FROM {job_joined}
        GROUP BY l.id, l.name ORDER BY num_reviews DESC, l.id LIMIT {JOB_TOP}
    """
    without_reviews = f"""
        SELECT id, name, neighbourhood_cleansed, price_num FROM ({listings}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({reviews}) r WHERE r.listing_id = l.id)
    """
    by_band = f"""
        SELECT price_category, count(*) AS listing_count, {exact_avg("price_num")} AS avg_price,
               {exact_avg("review_scores_rating")} AS avg_rating
        FROM ({listings}) GROUP BY price_category
    """
    sentiment = f"""
        SELECT neighbourhood_cleansed, count(*) AS review_count,
               {exact_avg(builtin_score, 1, 3)} AS avg_sentiment
        FROM {job_joined} GROUP BY neighbourhood_cleansed
    """
    comment_length = f"""
        SELECT r.listing_id, l.name,
               {exact_avg("length(nullif(r.comments, ''))", 1, 1)} AS avg_comment_length,
               count(r.id) AS reviews_count
        FROM {job_joined} GROUP BY r.listing_id, l.name HAVING count(r.id) >= {JOB_FLOOR}
        ORDER BY avg_comment_length DESC NULLS LAST, r.listing_id LIMIT {JOB_TOP}
    """
    gold = dict(
        zip(
            GOLD_TABLES,
            (
                listings,
                by_neighbourhood,
                top_reviewed,
                without_reviews,
                by_band,
                sentiment,
                comment_length,
            ),
        )
    )

    return {
        "csv_scan_project": """
            SELECT n_chars, text, doc_id, source, CAST(NULL AS BIGINT) AS lang FROM documents
        """,
        "currency_parse": prices,
        "plausible_range": plausible,
        "value_band": bands,
        "group_stats_rank": f"""
            SELECT *, rank() OVER (ORDER BY avg_price DESC NULLS LAST) AS price_rank
            FROM ({line_stats_sql("l_suppkey")})
        """,
        "group_stats_small": line_stats_sql("l_orderkey"),
        "rank_bucketed": """
            SELECT *, rank() OVER (ORDER BY quantity DESC NULLS LAST) AS quantity_rank FROM (
                SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS quantity
                FROM lineitem GROUP BY l_orderkey)
        """,
        "top_by_matches": """
            SELECT o_orderkey, o_orderpriority, count(l_linenumber) AS line_count
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            GROUP BY o_orderkey, o_orderpriority ORDER BY line_count DESC, o_orderkey LIMIT 20
        """,
        "without_match": """
            SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
        """,
        "without_match_text": unmatched,
        "band_summary": f"""
            SELECT band, count(*) AS order_count, {exact_avg("price_num", 100)} AS avg_price
            FROM ({bands}) GROUP BY band
        """,
        "lexicon_score": f"""
            SELECT doc_id, {score_sql("text", PLUS, MINUS)} AS score FROM documents
        """,
        "lexicon_score_builtin": f"""
            SELECT doc_id, {builtin_score} AS score FROM ({reviews})
        """,
        "lexicon_score_table": """
            WITH found AS (
                SELECT doc_id, unnest(regexp_split_to_array(lower(translate(text, '.,', '  ')), '\\s+')) AS word
                FROM documents
            ), weights AS (
                SELECT word, ascii(md5(word)) % 7 - 3 AS weight
                FROM (SELECT DISTINCT word FROM found WHERE word <> '') ORDER BY md5(word), word LIMIT 5000
            ), hits AS (
                SELECT doc_id, count(*) AS words, CAST(sum(weight) AS BIGINT) AS score
                FROM found JOIN weights USING (word) GROUP BY doc_id
            )
            SELECT doc_id, coalesce(words, 0) AS words, coalesce(score, 0) AS score
            FROM documents LEFT JOIN hits USING (doc_id)
        """,
        "score_by_group": scores,
        "sentiment_sql": scores,
        "text_length_sql": lengths,
        "text_length_df": lengths,
        "text_length_top": f"""
            {lengths} ORDER BY avg_comment_length DESC NULLS LAST, r.listing_id LIMIT 20
        """,
        "profile_top": f"""
            SELECT l.id, l.name, count(r.id) AS num_reviews FROM {joined}
            GROUP BY l.id, l.name ORDER BY num_reviews DESC, l.id LIMIT 20
        """,
        "profile_without_match": unmatched,
        "profile_score": scores,
        "profile_length": lengths,
        "sink_roundtrip": bands,
        "job_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS gold_table, count(*) AS row_count FROM ({sql})"
            for name, sql in gold.items()
        ),
        **{f"job_{name}": sql for name, sql in gold.items()},
        **(registry.ORACLES if registry else {}),
    }
