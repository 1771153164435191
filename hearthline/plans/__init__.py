"""The listings-and-reviews tables and the job that writes them."""

from hearthline.plans.gold import build_gold
from hearthline.plans.marketplace import (
    listings_clean,
    listings_without_reviews,
    price_by_neighbourhood,
    price_category_summary,
    review_profile,
    sentiment_by_neighbourhood,
    top_comment_length,
    top_comment_length_sql,
    top_reviewed_listings,
)

__all__ = [
    "build_gold",
    "listings_clean",
    "listings_without_reviews",
    "price_by_neighbourhood",
    "price_category_summary",
    "review_profile",
    "sentiment_by_neighbourhood",
    "top_comment_length",
    "top_comment_length_sql",
    "top_reviewed_listings",
]
