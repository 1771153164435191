"""SQL over DataFrames."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# The SQL form of ``length_by_entity`` over listings and reviews. The groups are structs, which
# the join's shuffle does not cover: the partial sums are shuffled, and hot listings split.
TEXT_LENGTH = """
    WITH lengths AS (
        SELECT listing_id, count(id) AS ids, count(comments) AS texts,
               sum(length(comments)) AS chars
        FROM {reviews}
        WHERE listing_id IS NOT NULL
        GROUP BY listing_id, pmod(xxhash64(listing_id), 2)
    ), sums AS (
        SELECT struct(listing_id, name) AS entity, max(chars) AS chars, max(texts) AS texts,
               sum(ids) AS reviews_count
        FROM {listings} JOIN lengths ON id = listing_id
        GROUP BY struct(listing_id, name)
    )
    SELECT entity.listing_id AS listing_id, entity.name AS name,
           round(try_divide(chars, texts), 1) AS avg_comment_length, reviews_count
    FROM sums
    WHERE reviews_count >= :min_reviews
    ORDER BY avg_comment_length DESC, listing_id, name
"""


# The SQL form of ``score_by_group``, with the score as a SQL function.
SENTIMENT = """
    WITH scores AS (
        SELECT listing_id, count(*) AS reviews, sum({lexicon_score}(comments)) AS score
        FROM {reviews}
        WHERE listing_id IS NOT NULL
        GROUP BY listing_id, pmod(xxhash64(listing_id), 2)
    ), sums AS (
        SELECT struct(neighbourhood_cleansed) AS area, sum(reviews) AS review_count,
               sum(score) AS score
        FROM {listings} JOIN scores ON id = listing_id
        GROUP BY struct(neighbourhood_cleansed)
    )
    SELECT area.neighbourhood_cleansed AS neighbourhood_cleansed, review_count,
           round(score / review_count, 3) AS avg_sentiment
    FROM sums
    ORDER BY avg_sentiment DESC, neighbourhood_cleansed
"""


def sql_over(
    spark: SparkSession,
    text: str,
    frames: dict[str, DataFrame],
    parameters: dict[str, object] | None = None,
    functions: dict[str, str] | None = None,
) -> DataFrame:
    """Run a query that names its frames as ``{frame}`` and its parameters as ``:name``.

    ``functions`` are SQL functions that the query calls as ``{name}(...)``, each with its
    definition from the arguments on (``(x INT) RETURNS INT RETURN x + 1``). Spark puts
    their bodies into the plan, so no Python worker runs; they exist under names of their
    own until the query is analysed, also if that fails. No session view or function is
    left or replaced, and no value is pasted into the text.
    """
    made: list[str] = []
    try:
        for name, definition in (functions or {}).items():
            made.append(f"{name}_{uuid4().hex}")
            spark.sql(f"CREATE TEMPORARY FUNCTION {made[-1]}{definition}")
            text = text.replace(f"{{{name}}}", made[-1])
        return spark.sql(text, args=parameters or {}, **frames)
    finally:
        for name in made:
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
