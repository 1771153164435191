"""Columns over free text."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two word lists of the built-in sentiment score.
POSITIVE = (
    "good",
    "great",
    "excellent",
    "amazing",
    "fantastic",
    "wonderful",
    "pleasant",
    "lovely",
    "nice",
    "clean",
    "comfortable",
    "spotless",
    "spacious",
)
NEGATIVE = (
    "bad",
    "terrible",
    "awful",
    "horrible",
    "disappointing",
    "poor",
    "hate",
    "unpleasant",
    "dirty",
    "noisy",
    "cramped",
)

# Words end at a full stop, a comma or Unicode white space, and at
# nothing else ("great!" and "clean<br/>" are other words than "great", "clean").
SEPARATORS = r"[.,\x1c\x1d\x1e\x1f\p{IsWhite_Space}]+"


def words(text: Column) -> Column:
    """Lower-case words of ``text``; the first and last may be empty."""
    return F.split(F.lower(text), SEPARATORS)


def lexicon_score(
    text: Column,
    positive: Iterable[str] = POSITIVE,
    negative: Iterable[str] = NEGATIVE,
) -> Column:
    """Number of positive minus number of negative words; 0 for NULL or empty text.

    A word on both lists counts as positive. The text is split once, one set look-up
    per word keeps the hits, and only they are added up.
    """
    plus, minus = ([w for w in bank if w] for bank in (positive, negative))
    hits = F.filter(words(text), lambda word: word.isin(plus + minus))
    score = F.aggregate(
        hits, F.lit(0), lambda total, word: total + F.when(word.isin(plus), 1).otherwise(-1)
    )
    return F.coalesce(score, F.lit(0))


def lexicon_function(
    positive: Iterable[str] = POSITIVE, negative: Iterable[str] = NEGATIVE
) -> str:
    """``lexicon_score`` as the definition of a SQL function, for ``sql_over``."""

    def listed(bank: list[str]) -> str:
        quoted = ("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in bank)
        return f"word IN ({', '.join(quoted)})" if bank else "false"

    plus, minus = ([w for w in bank if w] for bank in (positive, negative))
    hits = f"filter(split(lower(text), r'{SEPARATORS}'), word -> {listed(plus + minus)})"
    total = f"aggregate({hits}, 0, (total, word) -> total + if({listed(plus)}, 1, -1))"
    return f"(text STRING) RETURNS INT RETURN coalesce({total}, 0)"
