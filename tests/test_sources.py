import csv
import gzip
import io
import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from hearthline import schemas
from hearthline.sources import read_listings, read_reviews, read_wide_csv, spread_rows

WANTED = (
    StructType()
    .add("id", LongType())
    .add("name", StringType())
    .add("nights", IntegerType())
    .add("score", DoubleType())
    .add("first", DateType())
)

ID_NAME = StructType().add("id", LongType()).add("name", StringType())


def write(folder, text, name="table.csv.gz"):
    path = Path(folder) / name
    data = text.encode()
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(path)


@pytest.mark.parametrize("name", ["table.csv.gz", "table.csv"])
def test_dirty_rows(spark, folder, name):
    path = write(
        folder,
        "name,extra,first,score,id,nights\n"
        '"says ""hi"", twice",x,2019-03-01,4.5,1,2\n'
        '"two\nlines",x,2019-3-1,NaN,2,3\n'
        ",x,,,3,\n"
        '"",x,junk,junk,4,junk\n'
        "short,x,2019\n"
        "long,x,2019-03-01T10:00,1,6,1,surplus,more\n"
        "plain,x,2020-02-30,1e2,not a number,99999999999\n",
        name,
    )
    rows = [tuple(r) for r in read_wide_csv(spark, path, WANTED).collect()]
    assert rows[0] == (1, 'says "hi", twice', 2, 4.5, date(2019, 3, 1))
    assert rows[1][:3] == (2, "two\nlines", 3) and rows[1][4] == date(2019, 3, 1)
    assert rows[1][3] != rows[1][3]
    assert rows[2] == (3, None, None, None, None)
    assert rows[3] == (4, None, None, None, None)
    assert rows[4] == (None, "short", None, None, date(2019, 1, 1))
    assert rows[5] == (6, "long", 1, 1.0, date(2019, 3, 1))
    assert rows[6] == (None, "plain", None, 100.0, None)
    assert len(rows) == 7


def test_whole_numbers_drop_a_fraction(spark, folder):
    texts = ["3.0", "3.9", "-3.9", " 7 ", "+8", ".5", "5.", "1e3", "1.2.3", "1.x", "2147483648.0"]
    path = write(folder, "id,nights\n" + "".join(f"{t},{t}\n" for t in texts))
    wanted = StructType().add("id", LongType()).add("nights", IntegerType())
    rows = [tuple(r) for r in read_wide_csv(spark, path, wanted).collect()]
    small = [3, 3, -3, 7, 8, 0, 5, None, None, None]
    assert rows == [(v, v) for v in small] + [(2147483648, None)]


def test_columns_come_in_schema_order_and_type(spark, folder):
    path = write(folder, "nights,first,unused,score,name,id\n1,2020-01-01,u,2,n,3\n")
    df = read_wide_csv(spark, path, WANTED)
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in WANTED]
    assert tuple(df.first()) == (3, "n", 1, 2.0, date(2020, 1, 1))


def test_missing_column_is_an_error(spark, folder):
    with pytest.raises(AnalysisException):
        read_wide_csv(spark, write(folder, "id,name\n1,a\n"), WANTED)


def test_many_files(spark, folder):
    wanted = StructType().add("name", StringType()).add("id", LongType())
    write(folder, 'id,skip,name\n1,x,"a\nb"\n', "one.csv.gz")
    write(folder, "id,skip,name\n2,x,c\n", "two.csv.gz")
    both = read_wide_csv(spark, folder, wanted)
    assert {tuple(r) for r in both.collect()} == {("a\nb", 1), ("c", 2)}
    listed = read_wide_csv(spark, [f"{folder}/one.csv.gz", f"{folder}/two.csv.gz"], wanted)
    assert listed.count() == 2


def test_files_with_other_column_places_are_read_by_name(spark, folder):
    wanted = StructType().add("name", StringType()).add("id", LongType())
    write(folder, "id,skip,name\n1,x,a\n", "one.csv.gz")
    write(folder, "name,skip,id\nb,x,2\n", "two.csv.gz")
    write(folder, 'more,"na\nme",NAME,Id,more\nm,n,"c\nd",3,m\n', "three [1] %20.csv")
    write(folder, "", "empty.csv")
    rows = read_wide_csv(spark, folder, wanted).collect()
    assert {tuple(r) for r in rows} == {("a", 1), ("b", 2), ("c\nd", 3)}


def test_unnamed_and_repeated_columns_nobody_asks_for(spark, folder):
    wanted = StructType().add("name", StringType()).add("id", LongType())
    assert [tuple(r) for r in read_wide_csv(spark, write(folder, ",id,name,\nx,1,a,y\n", "0.csv"), wanted).collect()] == [("a", 1)]
    repeated = "id,skip,name,skip,\n{0},x,a,y,z\n"
    one = write(folder, repeated.format(1))
    two = [one, write(folder, repeated.format(2), "two.csv.gz")]
    for path, ids in ((one, [1]), (two, [1, 2])):
        for checked in (True, False):
            rows = read_wide_csv(spark, path, wanted, check_headers=checked).collect()
            assert sorted(r.id for r in rows) == ids


def test_a_wanted_column_that_is_missing_or_repeated_is_the_only_error(spark, folder):
    wanted = StructType().add("id", LongType()).add("_0", StringType())
    good = write(folder, "_0,id\na,1\n", "good.csv")
    for header in ("id,_0,id", "id,name", "ID,Id,_0"):
        bad = write(folder, f"{header}\n1,2,3\n", "bad.csv")
        with pytest.raises(AnalysisException, match="header of .*bad.csv"):
            read_wide_csv(spark, [good, bad], wanted)
    assert tuple(read_wide_csv(spark, good, wanted).first()) == (1, "a")
    exact = write(folder, "ID,_0,id\n1,a,2\n", "exact.csv")
    assert tuple(read_wide_csv(spark, exact, wanted).first()) == (2, "a")
    with pytest.raises(AnalysisException):
        read_wide_csv(spark, write(folder, "", "none.csv"), wanted)


def test_listings_and_reviews(spark, folder):
    listings = write(
        folder, ",".join(schemas.LISTINGS.names) + "\n1" + ",x" * 13 + "\n", "listings.csv.gz"
    )
    reviews = write(
        folder,
        ",".join(schemas.REVIEWS.names) + "\n1,100,2021-01-01,5001,Jamie,Nice.\n",
        "reviews.csv.gz",
    )
    assert read_listings(spark, listings).schema == schemas.LISTINGS
    assert read_reviews(spark, reviews).schema == schemas.REVIEWS
    assert tuple(read_listings(spark, listings).first())[:4] == (1, "x", None, "x")
    assert tuple(read_reviews(spark, reviews).first())[:3] == (1, 100, date(2021, 1, 1))


def test_random_texts_survive(spark, folder):
    rng = random.Random(3)
    parts = ['"', '""', ",", "\n", "\r\n", "\\", "'", " ", "\t", ";", "\u2028", "é", "😀", "a"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(2000)]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "name"])
    writer.writerows(enumerate(texts))
    rows = read_wide_csv(spark, write(folder, out.getvalue()), ID_NAME).collect()
    assert sorted((r.id, r.name) for r in rows) == list(enumerate(texts))


def test_only_wanted_columns_are_parsed(spark, folder):
    path = write(folder, "id,skip,name\n1,x,a\n")
    df = read_wide_csv(spark, path, StructType().add("id", LongType()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string>" in plan


def test_rows_are_spread_over_the_given_width(spark, folder):
    rows = "".join(f"{n},same\n" for n in range(500))
    one = read_wide_csv(spark, write(folder, "id,name\n" + rows, "one.csv.gz"), ID_NAME)
    spread = spread_rows(one, 5)
    assert sorted(spread.collect()) == sorted(one.collect())
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 150
