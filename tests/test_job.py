"""The listings-and-reviews tables: the known small case, and the whole job on it."""

import csv
import gzip
import re
import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hearthline import schemas
from hearthline.plans import (
    build_gold,
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
from hearthline.plans.gold import _together
from hearthline.plans.marketplace import reviewed
from hearthline.sinks import shared_folder
from hearthline.sources import read_listings, read_reviews, spread_rows

# The known small case.
LISTINGS = [
    (1, "Budget room in Camden", 1001, "Sam", "Camden", "Private room",
     "Private room in home", "$40.00", 2, 12, 1.5, 4.6, 4.7, date(2019, 3, 1)),
    (2, "Mid flat in Hackney", 1002, "Alex", "Hackney", "Entire home/apt",
     "Entire rental unit", "$120.00", 3, 8, 1.1, 4.4, 4.5, date(2020, 6, 1)),
    (3, "Luxury loft in Westminster", 1003, "Priya", "Westminster", "Entire home/apt",
     "Entire condo", "$1,250.00", 5, 3, 0.4, 4.9, 5.0, date(2018, 1, 1)),
    (4, "Central room in Islington", 1004, "Marco", "Islington", "Private room",
     "Private room in home", "$75.00", 1, 0, None, None, None, None),
    (5, "Broken price listing", 1005, "Ola", "Brent", "Shared room",
     "Shared room", "N/A", 1, 1, 0.2, 4.0, 4.0, date(2021, 1, 1)),
]
REVIEWS = [
    (1, 100, date(2021, 1, 1), 5001, "Jamie", "The place was great and clean."),
    (1, 101, date(2021, 2, 1), 5002, "Noor", "Lovely and spotless, would return."),
    (2, 102, date(2021, 3, 1), 5003, "Diego", "It felt a little noisy and dirty."),
]
TABLES = {
    "listings_clean": {
        (1, 40.0, "Budget"),
        (2, 120.0, "Mid-range"),
        (3, 1250.0, "Luxury"),
        (4, 75.0, "Mid-range"),
    },
    "price_by_neighbourhood": {
        ("Westminster", 1, 1250.0, 1250.0, 1250.0, 4.9, 1),
        ("Hackney", 1, 120.0, 120.0, 120.0, 4.4, 2),
        ("Islington", 1, 75.0, 75.0, 75.0, None, 3),
        ("Camden", 1, 40.0, 40.0, 40.0, 4.6, 4),
    },
    "top_reviewed_listings": {
        (1, "Budget room in Camden", 2),
        (2, "Mid flat in Hackney", 1),
    },
    "listings_without_reviews": {
        (3, "Luxury loft in Westminster", "Westminster", 1250.0),
        (4, "Central room in Islington", "Islington", 75.0),
    },
    "price_category_summary": {
        ("Mid-range", 2, 97.5, 4.4),
        ("Budget", 1, 40.0, 4.6),
        ("Luxury", 1, 1250.0, 4.9),
    },
    "sentiment_by_neighbourhood": {("Camden", 2, 2.0), ("Hackney", 1, -2.0)},
    "top_comment_length": {
        (2, "Mid flat in Hackney", 33.0, 1),
        (1, "Budget room in Camden", 32.0, 2),
    },
}
DTYPES = {
    "listings_clean": [(f.name, f.dataType.simpleString()) for f in schemas.LISTINGS]
    + [("price_num", "double"), ("price_category", "string")],
    "price_by_neighbourhood": [
        ("neighbourhood_cleansed", "string"),
        ("listing_count", "bigint"),
        ("avg_price", "double"),
        ("min_price", "double"),
        ("max_price", "double"),
        ("avg_rating", "double"),
        ("price_rank", "int"),
    ],
    "top_reviewed_listings": [("id", "bigint"), ("name", "string"), ("num_reviews", "bigint")],
    "listings_without_reviews": [
        ("id", "bigint"),
        ("name", "string"),
        ("neighbourhood_cleansed", "string"),
        ("price_num", "double"),
    ],
    "price_category_summary": [
        ("price_category", "string"),
        ("listing_count", "bigint"),
        ("avg_price", "double"),
        ("avg_rating", "double"),
    ],
    "sentiment_by_neighbourhood": [
        ("neighbourhood_cleansed", "string"),
        ("review_count", "bigint"),
        ("avg_sentiment", "double"),
    ],
    "top_comment_length": [
        ("listing_id", "bigint"),
        ("name", "string"),
        ("avg_comment_length", "double"),
        ("reviews_count", "bigint"),
    ],
}


@pytest.fixture
def listings(spark):
    return listings_clean(spark.createDataFrame(LISTINGS, schemas.LISTINGS))


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(REVIEWS, schemas.REVIEWS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_prices_and_bands(listings):
    assert set(rows(listings.select("id", "price_num", "price_category"))) == TABLES[
        "listings_clean"
    ]
    assert listings.filter("id = 3").first().price == "$1,250.00"
    assert listings.dtypes == DTYPES["listings_clean"]


def test_orders_of_the_tables(listings, reviews):
    profile = review_profile(reviews)
    in_order = {
        "price_by_neighbourhood": price_by_neighbourhood(listings),
        "top_reviewed_listings": top_reviewed_listings(listings, profile),
        "price_category_summary": price_category_summary(listings),
        "sentiment_by_neighbourhood": sentiment_by_neighbourhood(listings, profile),
        "top_comment_length": top_comment_length(listings, profile, min_reviews=1),
    }
    first = {name: rows(df)[0][0] for name, df in in_order.items()}
    assert first == {
        "price_by_neighbourhood": "Westminster",
        "top_reviewed_listings": 1,
        "price_category_summary": "Mid-range",
        "sentiment_by_neighbourhood": "Camden",
        "top_comment_length": 2,
    }
    for name, df in in_order.items():
        assert set(rows(df)) == TABLES[name]
        assert df.dtypes == DTYPES[name]


def test_listings_without_reviews(listings, reviews):
    for matches, profile in ((reviews, False), (review_profile(reviews), True)):
        unmatched = listings_without_reviews(listings, matches, profile=profile)
        assert set(rows(unmatched)) == TABLES["listings_without_reviews"]


def test_comment_length_in_sql(listings, reviews):
    by_sql = top_comment_length_sql(listings, reviews, min_reviews=1)
    by_frames = top_comment_length(listings, review_profile(reviews), min_reviews=1)
    assert rows(by_sql) == rows(by_frames) and by_sql.dtypes == by_frames.dtypes
    assert rows(top_comment_length_sql(listings, reviews)) == []
    cut = top_comment_length(listings, review_profile(reviews), min_reviews=1, top_n=1)
    assert rows(cut) == rows(by_sql)[:1]


def test_thresholds_are_arguments(spark):
    raw = spark.createDataFrame(LISTINGS, schemas.LISTINGS)
    clean = listings_clean(
        raw, min_price=75.0, max_price=120.0, budget_ceiling=75.0, midrange_ceiling=120.0
    )
    assert set(rows(clean.select("id", "price_category"))) == {(2, "Luxury"), (4, "Mid-range")}


def write_csv(path, names, records):
    """A gzipped export with its columns in reverse order and one column more."""
    with gzip.open(path, "wt", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(["extra", *reversed(names)])
        for record in records:
            writer.writerow(['a "b",\nc', *reversed(record)])
    return str(path)


@pytest.fixture
def exports(folder):
    return (
        write_csv(Path(folder) / "listings.csv.gz", schemas.LISTINGS.names, LISTINGS),
        write_csv(Path(folder) / "reviews.csv.gz", schemas.REVIEWS.names, REVIEWS),
    )


def gold(spark, path, name):
    back = spark.read.parquet(f"{path}/{name}")
    if name == "listings_clean":
        assert back.columns[-1] == "price_category"
        assert back.dtypes == DTYPES[name]
        back = back.select("id", "price_num", "price_category")
    else:
        assert back.dtypes == DTYPES[name]
    return back


@pytest.mark.parametrize(
    "layout", [{}, {"output_partitions": 4}, {"rebalance": False}, {"spread": 3}]
)
def test_job_twice(spark, folder, exports, layout):
    path = f"{folder}/gold"
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir()) if shared.exists() else set()
    for _ in range(2):
        counts = build_gold(spark, *exports, path, min_reviews=1, **layout)
        assert counts == {name: len(table) for name, table in TABLES.items()}
        assert list(counts) == list(TABLES)
        for name, table in TABLES.items():
            back = rows(gold(spark, path, name))
            assert len(back) == len(table) and set(back) == table
    assert (set(shared.iterdir()) if shared.exists() else set()) == before
    assert not spark.sparkContext._jsc.sc().isStopped()
    assert spark.catalog.listTables() == []


def test_job_options(spark, folder, exports):
    counts = build_gold(spark, *exports, f"{folder}/gold", top_n=1, max_price=1_000.0)
    assert counts["listings_clean"] == 3
    assert counts["top_reviewed_listings"] == 1
    assert counts["top_comment_length"] == 0
    assert spark.read.parquet(f"{folder}/gold/top_comment_length").count() == 0


def test_exports_without_rows(spark, folder, exports):
    nothing = write_csv(Path(folder) / "no_reviews.csv.gz", schemas.REVIEWS.names, [])
    counts = build_gold(spark, exports[0], nothing, f"{folder}/gold")
    assert counts["listings_without_reviews"] == counts["listings_clean"] == 4
    assert counts["top_reviewed_listings"] == counts["sentiment_by_neighbourhood"] == 0

    nothing = write_csv(Path(folder) / "no_listings.csv.gz", schemas.LISTINGS.names, [])
    counts = build_gold(spark, nothing, exports[1], f"{folder}/none")
    assert set(counts.values()) == {0}
    assert gold(spark, f"{folder}/none", "price_by_neighbourhood").count() == 0


def test_a_failing_table_fails_the_job(spark, folder, exports):
    with pytest.raises(Exception, match="(?i)path"):
        build_gold(spark, exports[0], f"{folder}/missing.csv.gz", f"{folder}/gold")
    with pytest.raises(Exception, match="(?i)n must be|limit|negative"):
        build_gold(spark, *exports, f"{folder}/gold", top_n=-1)
    assert build_gold(spark, *exports, f"{folder}/gold")["listings_clean"] == 4


def test_a_failing_job_leaves_no_staged_folder(spark, folder, exports):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir()) if shared.exists() else set()
    (Path(folder) / "file").write_text("in the way")
    with pytest.raises(Exception):
        build_gold(spark, *exports, f"{folder}/file")  # the fact can't be written
    with pytest.raises(Exception):
        build_gold(spark, *exports, f"{folder}/gold", top_n=-1)  # a table fails
    assert (set(shared.iterdir()) if shared.exists() else set()) == before


def test_an_error_stops_the_other_actions(spark):
    def endless():
        spark.range(0, 10**15, 1, 8).selectExpr("max(xxhash64(id))").collect()

    def fails():
        time.sleep(3)
        raise ValueError("first")

    start = time.time()
    with pytest.raises(ValueError, match="first"):
        _together(spark, endless, fails)
    assert time.time() - start < 60


def test_the_job_joins_once(spark, exports):
    fact = listings_clean(read_listings(spark, exports[0]))
    joined = reviewed(fact, review_profile(read_reviews(spark, exports[1])))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Join", plan)) == 1


def test_profile_reads_three_columns_of_the_reviews(spark, exports):
    profile = review_profile(spread_rows(read_reviews(spark, exports[1]), 4))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    read = re.search("ReadSchema: struct<(.*?)>", plan).group(1)
    assert sorted(read.split(",")) == ["comments:string", "id:string", "listing_id:string"]


def test_written_fact_prunes_bands(spark, folder, exports):
    build_gold(spark, *exports, f"{folder}/gold")
    fact = spark.read.parquet(f"{folder}/gold/listings_clean")
    budget = fact.filter(F.col("price_category") == "Budget")
    plan = budget._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(price_category" in plan and budget.count() == 1
