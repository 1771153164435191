"""The job: two raw tables in, seven gold tables and their row counts out."""

from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from hearthline.plans import marketplace as m
from hearthline.sinks import staging, write_table
from hearthline.sources import read_listings, read_reviews, spread_rows


def build_gold(
    spark: SparkSession,
    listings_path: str | list[str],
    reviews_path: str | list[str],
    gold_path: str,
    *,
    output_partitions: int | None = None,
    rebalance: bool | None = None,
    spread: int | None = None,
    top_n: int = 20,
    min_reviews: int = 5,
    **cleaning: float,
) -> dict[str, int]:
    """Write the gold tables under ``gold_path`` and return the rows of each.

    Each raw table is read once. The cleaned listings are written first and read back
    as the fact of all other tables; the reviews are reduced to their profile. Fact and
    profile are joined once, for four tables. Profile and join are staged, and deleted at
    the end. What does not depend on each other runs at the same time; the first error
    stops the rest. ``cleaning`` goes to ``listings_clean``; the session stays the caller's.

    ``spread`` deals the reviews out to that many tasks: for few, unsplittable files.
    ``output_partitions`` and ``rebalance`` go to ``write_table``.
    """
    clean = m.listings_clean(read_listings(spark, listings_path), **cleaning)
    reviews = read_reviews(spark, reviews_path)
    if spread is not None:
        reviews = spread_rows(reviews, spread)
    fact_path = f"{gold_path}/listings_clean"

    def write_fact() -> int:
        return write_table(
            clean,
            fact_path,
            partition_by="price_category",
            partitions=output_partitions,
            rebalance=rebalance,
        )

    with staging(spark) as stage:
        fact_rows, profile = _together(
            spark, write_fact, lambda: stage(m.review_profile(reviews), "review-profile")
        )
        fact = spark.read.schema(clean.schema).parquet(fact_path)
        joined = stage(m.reviewed(fact, profile.table), "reviewed").table
        tables = {
            "price_by_neighbourhood": m.price_by_neighbourhood(fact, ordered=False),
            "top_reviewed_listings": m.top_reviewed(joined, top_n=top_n),
            "listings_without_reviews": m.never_reviewed(joined),
            "price_category_summary": m.price_category_summary(fact, ordered=False),
            "sentiment_by_neighbourhood": m.sentiment(joined),
            "top_comment_length": m.comment_length(joined, min_reviews=min_reviews, top_n=top_n),
        }
        rows = _together(
            spark,
            *(
                lambda name=name, table=table: write_table(
                    table, f"{gold_path}/{name}", partitions=output_partitions
                )
                for name, table in tables.items()
            ),
        )
    return {"listings_clean": fact_rows, **dict(zip(tables, rows))}


def _together(spark: SparkSession, *actions: Callable) -> list:
    """Results of independent Spark actions, one thread each; an error stops the others."""
    group = f"together-{uuid4().hex}"

    def grouped(action: Callable) -> Callable:
        def run():
            spark.sparkContext.setJobGroup(group, "gold tables", interruptOnCancel=True)
            return action()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(grouped(action)) for action in actions]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        failed = [action for action in running if action in done and action.exception()]
        if failed:
            while not all(action.cancel() or action.done() for action in running):
                spark.sparkContext.cancelJobGroup(group)  # again, for jobs that start late
                wait(running, timeout=1)
            raise failed[0].exception()
        return [action.result() for action in running]
