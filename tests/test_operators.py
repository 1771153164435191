"""The general operators against plain joins and against brute force."""

import random
import re
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthline.functions import lexicon_function, lexicon_score
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
from hearthline.sinks import stage


def random_pair(spark, seed):
    """Entities and children with NULL and repeated keys, and one hot key on each side."""
    rng = random.Random(seed)

    def key(hot):
        draw = rng.random()
        return None if draw < 0.05 else hot if draw < 0.4 else rng.randint(1, 60)

    entities = [
        (key(7), rng.choice(["a", "b", None]), rng.choice(["x", "y", "z", None]), rng.random())
        for _ in range(120)
    ]
    comments = [None, "", "great", "dirty, noisy!", "Lovely. clean", "bad"]
    children = [
        (key(3), None if rng.random() < 0.1 else n, rng.choice(comments)) for n in range(900)
    ]
    return (
        spark.createDataFrame(entities, "id long, name string, area string, price double"),
        spark.createDataFrame(children, "listing_id long, id long, comments string"),
    )


@pytest.fixture(params=[1, 2, 3])
def pair(spark, request):
    return random_pair(spark, request.param)


def full_profile(children):
    return match_profile(
        children,
        "listing_id",
        id="id",
        text="comments",
        score=lexicon_score(F.col("comments")),
    )


def same(left, right):
    assert left.columns == right.columns
    rows = Counter(map(tuple, left.collect()))
    assert rows == Counter(map(tuple, right.collect()))
    assert rows


def plain(spark, text, entities, children):
    return spark.sql(text, l=entities, r=children)


@pytest.mark.parametrize("staged", [False, True])
def test_profile_form_equals_plain_joins(spark, pair, staged):
    entities, children = pair
    profile = full_profile(children)
    if staged:
        profile, rows, _ = stage(profile, "profile")
        assert rows == profile.count()

    top = """SELECT l.id, l.name, count(r.id) AS num_reviews FROM {l} l JOIN {r} r
             ON l.id = r.listing_id GROUP BY l.id, l.name"""
    same(top_by_matches(entities, profile, 10_000), plain(spark, top, entities, children))

    cut = top_by_matches(entities, profile, 5).collect()
    ordered = plain(spark, top + " ORDER BY num_reviews DESC, l.id, l.name", entities, children)
    assert cut == ordered.limit(5).collect()

    scores = """SELECT l.area, count(*) AS review_count, round(avg(s), 3) AS avg_sentiment
                FROM {l} l JOIN {r} r ON l.id = r.listing_id GROUP BY l.area"""
    scored = children.withColumn("s", lexicon_score(F.col("comments")))
    same(
        score_by_group(entities, profile, group="area"),
        plain(spark, scores, entities, scored),
    )

    unmatched = "SELECT * FROM {l} l LEFT ANTI JOIN {r} r ON l.id = r.listing_id"
    expected = plain(spark, unmatched, entities, children)
    assert expected.filter("id IS NULL").count() > 0
    for matches, distinct in ((children, False), (profile, False), (profile, True)):
        found = without_match(entities, matches, key="id", match_key="listing_id", distinct=distinct)
        same(found, expected)

    for floor in (0, 1, 30):
        lengths = f"""SELECT r.listing_id, l.name,
                             round(avg(length(r.comments)), 1) AS avg_comment_length,
                             count(r.id) AS reviews_count
                      FROM {{l}} l JOIN {{r}} r ON l.id = r.listing_id
                      GROUP BY r.listing_id, l.name HAVING count(r.id) >= {floor}"""
        expected = plain(spark, lengths, entities, children)
        same(length_by_entity(entities, profile, floor), expected)
        frames = {"listings": entities, "reviews": children}
        same(sql_over(spark, TEXT_LENGTH, frames, {"min_reviews": floor}), expected)


def test_entity_with_null_texts_only_has_null_average_and_sorts_last(spark):
    entities = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    children = spark.createDataFrame(
        [(1, 1, None), (1, 2, None), (2, 3, "xy")], "listing_id long, id long, comments string"
    )
    ranked = sql_over(
        spark, TEXT_LENGTH, {"listings": entities, "reviews": children}, {"min_reviews": 1}
    )
    assert [tuple(r) for r in ranked.collect()] == [(2, "b", 2.0, 1), (1, "a", None, 2)]


def test_matches_of_empty_tables(spark, pair):
    entities, children = pair
    nothing = full_profile(children.limit(0))
    assert top_by_matches(entities, nothing, 5).count() == 0
    assert score_by_group(entities, nothing, group="area").count() == 0
    assert length_by_entity(entities, nothing, 0).count() == 0
    left = without_match(entities, children.limit(0), key="id", match_key="listing_id")
    assert left.count() == entities.count()


def test_sql_over_leaves_no_views(spark, pair):
    entities, children = pair
    text = "SELECT count(*) FROM {a} JOIN {b} ON {a}.id = {b}.listing_id WHERE price > :p"
    assert sql_over(spark, text, {"a": entities, "b": children}, {"p": 2.0}).first()[0] == 0
    assert spark.catalog.listTables() == []


def test_group_stats(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", 2.005, None), (None, 5.0, 1.0), (None, 7.0, None)],
        "g string, v double, w double",
    )
    stats = group_stats(
        df, "g", "n", avg_v=("avg", "v"), min_v=("min", "v"), max_v=("max", "v"), avg_w=("avg", "w")
    )
    assert stats.columns == ["g", "n", "avg_v", "min_v", "max_v", "avg_w"]
    assert set(map(tuple, stats.collect())) == {
        ("a", 2, 1.5, 1.0, 2.01, None),
        (None, 2, 6.0, 5.0, 7.0, 1.0),
    }


NAN = float("nan")


@pytest.mark.parametrize(
    "values",
    [
        [3.0, 1.0, 3.0, 2.0, None, None, 2.0, 3.0],
        [NAN, 1.0, None, NAN, float("inf"), float("-inf"), -0.0, 0.0],
        [5.0] * 40,
        [None] * 5,
        [NAN] * 5,
        [],
        [round(random.Random(5).lognormvariate(4, 1), 1) for _ in range(3)] * 30,
        [round(v, 1) for v in map(random.Random(6).gauss, [0] * 3000, [20] * 3000)] + [1.5] * 1500,
    ],
)
@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(12,2)", "string", "date", "timestamp"])
def test_rank_equals_window_rank(spark, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    finite = F.when(~F.isnan("v") & (F.abs("v") < 1e9), F.col("v"))
    if kind in ("date", "timestamp"):
        df = df.withColumn("v", F.timestamp_seconds(finite.cast("int") * 40_000).cast(kind))
    elif kind != "double":
        df = df.withColumn("v", finite.cast(kind))
    highest_first = Window.orderBy(F.col("v").desc())
    window = df.withColumn("r", F.rank().over(highest_first).cast("bigint"))
    expected = sorted((r.i, r.r) for r in window.collect())
    for ranges in (None, 1, 2, 50):
        ranked = with_rank(df, "v", "r", ranges=ranges)
        assert sorted((r.i, r.r) for r in ranked.collect()) == expected
        assert ranked.dtypes == [("i", "int"), ("v", dict(df.dtypes)["v"]), ("r", "bigint")]


def test_rank_replaces_a_column_of_its_name(spark):
    df = spark.createDataFrame([(5, "a"), (7, "b")], "r int, x string")
    assert sorted(map(tuple, with_rank(df, "x", "r").collect())) == [(1, "b"), (2, "a")]
    assert sorted(map(tuple, with_rank(df, "r", "r").collect())) == [(1, "b"), (2, "a")]


def test_rank_of_many_values(spark):
    rows = spark.range(0, 200_000, 1, 8).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(150_000)))
    window = rows.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())).cast("bigint"))
    assert with_rank(rows, "v", "r", ranges=200).exceptAll(window).isEmpty()


def test_averages_do_not_depend_on_the_partitioning(spark):
    rng = random.Random(8)
    rows = [(n % 500, rng.choice([-1, 1]) * rng.randint(0, 10**7) / 100) for n in range(20_000)]
    df = spark.createDataFrame(rows, "g int, v double")
    results = [
        sorted(map(tuple, group_stats(df.repartition(n), "g", "n", a=("avg", "v")).collect()))
        for n in (1, 3, 7)
    ]
    assert results[0] == results[1] == results[2]
    for group, n, average in results[0]:
        total = sum(round(v * 100) for g, v in rows if g == group)
        assert round(average * 100) == (abs(total) * 2 + n) // (2 * n) * (-1 if total < 0 else 1)


def test_averages_of_unusual_values(spark):
    rows = [("a", NAN), ("a", 1.0), ("b", float("inf")), ("c", 1e300), ("c", 0.0), ("d", None), ("e", 1.0), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.a for r in group_stats(df, "g", "n", a=("avg", "v")).collect()}
    assert str(got.pop("a")) == "nan"
    assert got == {"b": float("inf"), "c": 5e299, "d": None, "e": 1.0}


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(30,6)", "float"])
@pytest.mark.parametrize("digits", [0, 2, 8])
def test_averages_of_any_size(spark, kind, digits):
    rng = random.Random(digits)

    def value(g):
        if kind == "bigint":
            return rng.randint(-(10 ** (g % 19)), 10 ** (g % 19))
        if kind.startswith("decimal"):
            return Decimal(rng.randint(-(10 ** (g % 28)), 10 ** (g % 28))).scaleb(-6)
        return float(np.float32(rng.uniform(-1, 1) * 10 ** (g % 25 - 6))) if kind == "float" else rng.uniform(-1, 1) * 10 ** (g % 25 - 6)

    rows = [(i % 40, value(i % 40)) for i in range(2000)]
    df = spark.createDataFrame(rows, f"g int, v {kind}")
    results = [
        sorted(map(tuple, group_stats(df.repartition(n), "g", "n", digits, a=("avg", "v")).collect()))
        for n in (3, 7)
    ]
    assert results[0] == results[1]
    places = max(6, min(15, digits + 4))
    for group, n, average in results[0]:
        found = [Fraction(v) for g, v in rows if g == group]
        if kind in ("double", "float"):
            found = [Fraction(round(v * 10**places), 10**places) for v in found]
        exact = abs(sum(found)) / n * 10**digits
        rounded = (2 * exact.numerator + exact.denominator) // (2 * exact.denominator)
        assert average == float(rounded) / 10.0**digits * (-1 if sum(found) < 0 else 1)


def test_small_and_large_averages(spark):
    df = spark.createDataFrame([(1.2e-7, 1e15 + 0.25), (1.4e-7, 3.0), (None, None)], "a double, b double")
    row = group_stats(df.withColumn("g", F.lit(1)), "g", "n", 8, a=("avg", "a"), b=("avg", "b")).first()
    assert (row.a, row.b) == (1.3e-7, 500000000000001.625)
    none = group_stats(df.filter("a IS NULL").withColumn("g", F.lit(1)), "g", "n", a=("avg", "a")).first()
    assert none.a is None


def test_lexicon_table_adds_up_weights(spark):
    texts = [("a", "Good, good.bad"), ("a", None), ("b", ""), (None, "GOOD nothing"), ("b", "twice good twice")]
    df = spark.createDataFrame(texts, "k string, t string")
    lexicon = spark.createDataFrame(
        [("good", 2), ("bad", -5), ("twice", 1), ("twice", 2), ("nothing", None), ("", 9), (None, 9)], "word string, weight int"
    )
    got = lexicon_score_table(df, lexicon, "k", "t").collect()
    assert Counter(map(tuple, got)) == Counter(
        [("a", 3, -1), ("a", 0, 0), ("b", 0, 0), (None, 2, 2), ("b", 3, 8)]
    )
    assert lexicon_score_table(df.limit(0), lexicon, "k", "t").count() == 0
    empty = lexicon_score_table(df, lexicon.limit(0), "k", "t")
    assert {tuple(r)[1:] for r in empty.collect()} == {(0, 0)}


def test_lexicon_table_equals_the_list(spark, pair):
    _, children = pair
    rows = [(w, 1) for w in ("great", "lovely", "clean")] + [(w, -1) for w in ("dirty", "noisy!", "bad")]
    lexicon = spark.createDataFrame(rows, "word string, weight int")
    numbered = children.withColumn("id", F.monotonically_increasing_id())
    score = lexicon_score(F.col("comments"), [w for w, s in rows if s > 0], [w for w, s in rows if s < 0])
    expected = numbered.select("id", score.cast("bigint").alias("score"))
    same(lexicon_score_table(numbered, lexicon, "id", "comments").select("id", "score"), expected)


def test_a_frequent_word_is_split_and_the_texts_are_read_once(spark, folder):
    texts = spark.range(0, 20_000, 1, 8).select("id", F.concat(F.lit("the w"), F.col("id")).alias("t"))
    texts.write.parquet(f"{folder}/t")
    lexicon = spark.range(0, 40_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.lit(1).alias("weight"))
    lexicon = lexicon.union(spark.createDataFrame([("the", 3)], "word string, weight int"))
    scored = lexicon_score_table(spark.read.parquet(f"{folder}/t"), lexicon, "id", "t")
    assert scored.agg(F.sum("score"), F.min("words"), F.max("words")).first() == (80_000, 2, 2)
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall("Scan parquet", plan)) == 1 and "Python" not in plan


def test_sql_function_scores_like_the_column(spark, pair):
    entities, children = pair
    odd = [("it's",), ("back\\\\slash",), ("a\x85great\u3000bad",), (None,), ("",)]
    texts = children.select("comments").union(spark.createDataFrame(odd, "comments string"))
    plus, minus = ["great", "it's", "back\\\\slash"], ["bad", "dirty"]
    scored = sql_over(
        spark, "SELECT comments, {f}(comments) AS s FROM {t}", {"t": texts}, functions={"f": lexicon_function(plus, minus)}
    )
    same(scored, texts.select("comments", lexicon_score(F.col("comments"), plus, minus).alias("s")))
    areas = entities.withColumnRenamed("area", "neighbourhood_cleansed")
    result = sql_over(
        spark, SENTIMENT, {"listings": areas, "reviews": children}, functions={"lexicon_score": lexicon_function()}
    )
    same(result, score_by_group(areas, full_profile(children)))
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    for text in ("SELECT {f}(1) FROM {t}", "SELECT nothing FROM {t}"):
        with pytest.raises(Exception):
            sql_over(spark, text, {"t": texts}, functions={"f": "(x INT, y INT) RETURNS INT RETURN x + y"})
    assert not [f for f in spark.catalog.listFunctions() if f.name.startswith(("f_", "lexicon_score_"))]


def test_rank_leaves_gaps_after_ties(spark):
    df = spark.createDataFrame([(v,) for v in (9.0, 9.0, 8.0, None)], "v double")
    assert sorted(r.r for r in with_rank(df, "v", "r").collect()) == [1, 1, 3, 4]


def test_range_filter_is_pushed_into_stored_numbers(spark, folder):
    spark.range(10).select(F.col("id").cast("double").alias("v")).write.parquet(f"{folder}/v")
    kept = within(spark.read.parquet(f"{folder}/v"), "v", 2.0, 4.0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(v,2.0)" in plan and "LessThanOrEqual(v,4.0)" in plan
    assert [r.v for r in kept.orderBy("v").collect()] == [2.0, 3.0, 4.0]
