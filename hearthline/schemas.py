"""Columns and types of the two raw tables.

Fixed values: the names are those of the public listings and reviews exports,
and output tables keep them in this order. ``price`` stays text until it is
cleaned, because it arrives as ``$1,200.00``.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

LISTINGS = (
    StructType()
    .add("id", LongType())
    .add("name", StringType())
    .add("host_id", LongType())
    .add("host_name", StringType())
    .add("neighbourhood_cleansed", StringType())
    .add("room_type", StringType())
    .add("property_type", StringType())
    .add("price", StringType())
    .add("minimum_nights", IntegerType())
    .add("number_of_reviews", IntegerType())
    .add("reviews_per_month", DoubleType())
    .add("review_scores_rating", DoubleType())
    .add("review_scores_location", DoubleType())
    .add("first_review", DateType())
)

REVIEWS = (
    StructType()
    .add("listing_id", LongType())
    .add("id", LongType())
    .add("date", DateType())
    .add("reviewer_id", LongType())
    .add("reviewer_name", StringType())
    .add("comments", StringType())
)
