"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
import os
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_of_the_library_has_an_oracle():
    queries = set(registered.queries())
    assert set(ORACLES) <= queries
    assert all(re.match(r"op\d+_|pipeline$", name) for name in queries - set(ORACLES))


def test_inputs_can_fail_a_query(spark):
    reviews = registered.supplier_reviews(spark, SF_DIR)
    nothing = reviews.agg(*(F.count_if(F.col(c).isNull()) for c in ("listing_id", "id", "comments")))
    assert all(nothing.first()) and reviews.filter("comments = ''").count()
    keys = registered.suppliers(spark, SF_DIR).groupBy("id").count().collect()
    assert {r["count"] > 1 for r in keys} == {True, False} and None in {r["id"] for r in keys}
    for name, column in (
        ("lexicon_score_builtin", "score"),
        ("job_sentiment_by_neighbourhood", "avg_sentiment"),
    ):
        signs = {(r[column] > 0) - (r[column] < 0) for r in registered.queries()[name](spark, SF_DIR).collect()}
        assert signs >= ({-1, 0, 1} if name == "lexicon_score_builtin" else {1})
    ranks = registered.queries()["job_price_by_neighbourhood"](spark, SF_DIR).collect()
    assert len({r["price_rank"] for r in ranks}) < len(ranks)
    for name in ("top_reviewed_listings", "top_comment_length"):
        assert registered.queries()[f"job_{name}"](spark, SF_DIR).count() == registered.JOB_TOP


SAME_TYPE = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "DOUBLE": "double",
    "INTEGER": "int",
    "VARCHAR": "string",
}


def test_entry(spark):
    bands = registered.entry(spark).collect()
    assert {row["band"] for row in bands} == {"low", "middle", "high"}
    counts = [row["order_count"] for row in bands]
    assert counts == sorted(counts, reverse=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    ours = registered.queries()[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    columns = [column[0] for column in theirs.description]
    types = {column[0]: SAME_TYPE[str(column[1])] for column in theirs.description}
    assert dict(ours.dtypes) == types
    expected = sorted_rows(columns, theirs.fetchall())
    assert expected, "an oracle without rows shows nothing"
    assert sorted_rows(ours.columns, ours.collect()) == expected
