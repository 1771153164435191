import math
import random

import pytest
from pyspark.sql import functions as F

from hearthline.functions import NEGATIVE, POSITIVE, band, currency, lexicon_score
from hearthline.operators import within


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


CURRENCY = {
    "$1,200.00": 1200.0,
    "$40.00": 40.0,
    "N/A": None,
    "": None,
    "€50": None,
    "-$5.00": -5.0,
    "1e3": 1000.0,
    "10d": 10.0,
    " 42 ": 42.0,
    "10,00": 1000.0,
    "$$1,,0": 10.0,
    "Infinity": math.inf,
    None: None,
}


def test_currency_with_ansi_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = one_column(spark, CURRENCY).select("x", currency(F.col("x")).alias("y"))
    assert {r.x: r.y for r in df.collect()} == CURRENCY


def test_currency_keeps_nan_and_range_drops_it(spark):
    df = one_column(spark, ["NaN", "Infinity", "$10.00", "10,000", "9.99", "10000.01", None])
    priced = df.withColumn("y", currency(F.col("x")))
    assert math.isnan(priced.filter("x = 'NaN'").first().y)
    assert {r.x for r in within(priced, "y", 10.0, 10_000.0).collect()} == {"$10.00", "10,000"}


@pytest.mark.parametrize(
    "value, label",
    [
        (49.99, "Budget"),
        (50.0, "Mid-range"),
        (149.99, "Mid-range"),
        (150.0, "Luxury"),
        (None, "Luxury"),
        (math.nan, "Luxury"),
    ],
)
def test_band_ceilings_are_exclusive(spark, value, label):
    bands = band(F.col("x"), [("Budget", 50.0), ("Mid-range", 150.0)], "Luxury")
    assert one_column(spark, [value], "double").select(bands.alias("b")).first().b == label


# Known words, what they count, and what parts words; the score follows from how a text is built.
WORDS = [(w, 1) for w in POSITIVE] + [(w, -1) for w in NEGATIVE]
CASES = [(w.upper(), s) for w, s in WORDS] + [(w.title(), s) for w, s in WORDS]
OTHERS = [(w, 0) for w in ("great!", "clean<br/>", "good-bad", "not", "goodness", "gÖÖd", "ba\u0345d", "bad\u200bgood")]
SPACES = [chr(c) for c in range(0x3100) if chr(c).isspace()]
SEPARATORS = [*SPACES, ".", ",", "..", ", ", " . "]


def built(rng, length):
    """A text of drawn words and separators, and its score."""
    drawn = rng.choices(WORDS + CASES + OTHERS, k=length)
    parts = [rng.choice(["", *SEPARATORS])]
    for word, _ in drawn:
        parts += [word, rng.choice(SEPARATORS)]
    return "".join(parts), sum(score for _, score in drawn)


EDGES = [
    (None, 0),
    ("", 0),
    (" ", 0),
    ("great", 1),
    ("GREAT great Great", 3),
    ("great!", 0),
    ("clean<br/>", 0),
    ("clean,dirty.noisy", -1),
    ("not good", 1),
    ("..good,,", 1),
    ("\u0130 nice", 1),
]


def test_score_edges(spark):
    texts = [text for text, _ in EDGES]
    df = one_column(spark, texts).select("x", lexicon_score(F.col("x")).alias("s"))
    assert [(r.x, r.s) for r in df.collect()] == EDGES
    assert df.schema["s"].dataType.typeName() == "integer"


def test_score_of_built_texts(spark):
    rng = random.Random(7)
    made = [built(rng, rng.randint(0, 40)) for _ in range(4000)]
    df = one_column(spark, [text for text, _ in made])
    got = [r.s for r in df.select(lexicon_score(F.col("x")).alias("s")).collect()]
    assert got == [score for _, score in made]


def test_each_character_parts_words_or_not(spark):
    parting = {*SPACES, ".", ","}
    characters = [chr(c) for c in range(1, 0x3100)]
    df = one_column(spark, [f"good{c}nice" for c in characters])
    got = [r.s for r in df.select(lexicon_score(F.col("x")).alias("s")).collect()]
    assert got == [2 if c in parting else 0 for c in characters]


def test_score_takes_other_words(spark):
    df = one_column(spark, ["the cat and the dog of"])
    cases = ((["the"], ["of"], 1), (["the"], ["the"], 2), ([], ["and"], -1), (["", "cat"], [], 1))
    for plus, minus, expected in cases:
        assert df.select(lexicon_score(F.col("x"), plus, minus).alias("s")).first().s == expected


def test_long_text_is_scored_whole(spark):
    text = "word " * 200_000 + "great"
    assert one_column(spark, [text]).select(lexicon_score(F.col("x")).alias("s")).first().s == 1
