"""The operators bound to listings and reviews, one function per table.

``ordered=False`` leaves out the final sort, for writers that do not keep it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions import band, currency, lexicon_score
from hearthline.operators import (
    TEXT_LENGTH,
    group_stats,
    length_of,
    match_profile,
    matched,
    score_of,
    sql_over,
    top_of,
    with_rank,
    within,
    without_match,
)


def listings_clean(
    listings: DataFrame,
    *,
    min_price: float = 10.0,
    max_price: float = 10_000.0,
    budget_ceiling: float = 50.0,
    midrange_ceiling: float = 150.0,
) -> DataFrame:
    """Listings with a plausible price, its number and its band."""
    priced = listings.withColumn("price_num", currency(F.col("price")))
    bands = [("Budget", budget_ceiling), ("Mid-range", midrange_ceiling)]
    return within(priced, "price_num", min_price, max_price).withColumn(
        "price_category", band(F.col("price_num"), bands, "Luxury")
    )


def price_by_neighbourhood(listings: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Price statistics per neighbourhood, ranked by the average in cents."""
    stats = group_stats(
        listings,
        "neighbourhood_cleansed",
        "listing_count",
        avg_price=("avg", "price_num"),
        min_price=("min", "price_num"),
        max_price=("max", "price_num"),
        avg_rating=("avg", "review_scores_rating"),
    )
    ranked = with_rank(stats, "avg_price", "price_rank").withColumn(
        "price_rank", F.col("price_rank").cast("int")
    )
    return ranked.orderBy("price_rank", "neighbourhood_cleansed") if ordered else ranked


def price_category_summary(listings: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Listings, average price and average rating per band."""
    summary = group_stats(
        listings,
        "price_category",
        "listing_count",
        avg_price=("avg", "price_num"),
        avg_rating=("avg", "review_scores_rating"),
    )
    if not ordered:
        return summary
    return summary.orderBy(F.col("listing_count").desc(), "price_category")


def review_profile(reviews: DataFrame) -> DataFrame:
    """Per listing what the four review tables need of its reviews."""
    return match_profile(
        reviews,
        "listing_id",
        id="id",
        text="comments",
        score=lexicon_score(F.col("comments")),
    )


def reviewed(listings: DataFrame, profile: DataFrame) -> DataFrame:
    """Every listing row with the profile of its reviews: the join that four tables share."""
    shown = ["id", "name", "neighbourhood_cleansed", "price_num"]
    return matched(listings, profile, "id", shown, how="left")


def top_reviewed(joined: DataFrame, *, top_n: int = 20) -> DataFrame:
    return top_of(joined, top_n, key="id", label="name", count="num_reviews")


def top_reviewed_listings(
    listings: DataFrame, profile: DataFrame, *, top_n: int = 20
) -> DataFrame:
    return top_reviewed(reviewed(listings, profile), top_n=top_n)


def never_reviewed(joined: DataFrame) -> DataFrame:
    return joined.filter(F.col("rows").isNull()).select(
        "id", "name", "neighbourhood_cleansed", "price_num"
    )


def listings_without_reviews(
    listings: DataFrame, reviews: DataFrame, *, profile: bool = False
) -> DataFrame:
    """Listings without reviews; ``profile`` tells that ``reviews`` are their profile."""
    return without_match(
        listings, reviews, key="id", match_key="listing_id", distinct=profile
    ).select("id", "name", "neighbourhood_cleansed", "price_num")


def sentiment(joined: DataFrame) -> DataFrame:
    return score_of(
        joined,
        group="neighbourhood_cleansed",
        count="review_count",
        average="avg_sentiment",
        digits=3,
    )


def sentiment_by_neighbourhood(
    listings: DataFrame, profile: DataFrame, *, ordered: bool = True
) -> DataFrame:
    scores = sentiment(reviewed(listings, profile))
    if not ordered:
        return scores
    return scores.orderBy(F.col("avg_sentiment").desc(), "neighbourhood_cleansed")


def comment_length(
    joined: DataFrame, *, min_reviews: int = 5, top_n: int | None = None
) -> DataFrame:
    ranked = length_of(
        joined,
        min_reviews,
        key="id",
        label="name",
        match_key="listing_id",
        average="avg_comment_length",
        count="reviews_count",
        digits=1,
    ).orderBy(F.col("avg_comment_length").desc(), "listing_id", "name")
    return ranked if top_n is None else ranked.limit(top_n)


def top_comment_length(
    listings: DataFrame, profile: DataFrame, *, min_reviews: int = 5, top_n: int | None = None
) -> DataFrame:
    """Listings with enough reviews, longest average comment first; all or ``top_n``."""
    return comment_length(reviewed(listings, profile), min_reviews=min_reviews, top_n=top_n)


def top_comment_length_sql(
    listings: DataFrame, reviews: DataFrame, *, min_reviews: int = 5
) -> DataFrame:
    """``top_comment_length`` without a limit, as SQL over the reviews themselves."""
    return sql_over(
        listings.sparkSession,
        TEXT_LENGTH,
        {"listings": listings, "reviews": reviews},
        {"min_reviews": min_reviews},
    )
