"""Entities and their matching child rows, such as listings and reviews.

The child table is reduced to one row per key before it meets the entities
(``match_profile``): one scan, one shuffle of partial sums, and a key that holds a
third of all child rows weighs no more than any other. All measures are whole-number
sums, so quotients do not depend on the order of addition, and Catalyst drops those
that a query does not use.

Entities meet the profile in one join (``matched``) and are reduced after it. Both sides
of the join have a shuffle of their own, so adaptive execution can split an entity key
with very many rows; the last aggregates group by a struct, which the join's shuffle
does not cover, so that they shuffle their partial sums by themselves. Stage the join
when several operators read it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("rows", "ids", "texts", "chars", "score")


def match_profile(
    children: DataFrame,
    key: str,
    *,
    id: str | None = None,
    text: str | None = None,
    score: Column | None = None,
) -> DataFrame:
    """One row per non-NULL ``key``: ``key`` and the sums the operators below divide.

    ``rows`` counts the child rows; ``ids`` those with an ``id``; ``texts`` and
    ``chars`` the non-NULL texts and their characters; ``score`` adds up the scores.
    The grouping has a second column, so that a join shuffles the profile itself.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    if id is not None:
        measures.append(F.count(id).alias("ids"))
    if text is not None:
        measures.append(F.count(text).alias("texts"))
        measures.append(F.sum(F.length(text)).alias("chars"))
    if score is not None:
        measures.append(F.sum(score).alias("score"))
    part = F.pmod(F.xxhash64(key), F.lit(2)).alias("_part")
    return children.filter(F.col(key).isNotNull()).groupBy(key, part).agg(*measures).drop("_part")


def matched(
    entities: DataFrame, profile: DataFrame, key: str, shown: list[str], *, how: str = "inner"
) -> DataFrame:
    """The columns ``key`` and ``shown`` of the entity rows, with the measures of their key.

    ``how="left"`` keeps entities without children, whose measures are NULL.
    """
    match_key = profile.columns[0]
    measures = [F.col(c) for c in profile.columns if c in MEASURES]
    child = profile.select(F.col(match_key).alias("_match"), *measures)
    own = entities.select(*dict.fromkeys([key, *shown]))
    return own.join(child, F.col(key) == F.col("_match"), how).drop("_match")


def top_of(joined: DataFrame, n: int, *, key: str, label: str, count: str) -> DataFrame:
    """``top_by_matches`` of a join."""
    entity = F.struct(F.col(key).alias("key"), F.col(label).alias("label"))
    return (
        joined.filter(F.col("rows").isNotNull())
        .groupBy(entity.alias("_entity"))
        .agg(F.sum("ids").alias(count))
        .select(
            F.col("_entity.key").alias(key), F.col("_entity.label").alias(label), F.col(count)
        )
        .orderBy(F.col(count).desc(), key, label)
        .limit(n)
    )


def top_by_matches(
    entities: DataFrame,
    profile: DataFrame,
    n: int,
    *,
    key: str = "id",
    label: str = "name",
    count: str = "num_reviews",
) -> DataFrame:
    """The ``n`` entities with most child ids; ties go to the lower key, then label."""
    joined = matched(entities, profile, key, [label])
    return top_of(joined, n, key=key, label=label, count=count)


def without_match(
    entities: DataFrame, children: DataFrame, *, key: str, match_key: str, distinct: bool = False
) -> DataFrame:
    """Entity rows that no child row refers to; a NULL key has no match.

    Child keys are made distinct before the join, unless ``distinct`` says that they are,
    as those of a profile. Their grouping has a second column so that the join shuffles
    them itself: only then can adaptive execution split an entity key with very many rows.
    """
    keys = children.filter(F.col(match_key).isNotNull()).select(F.col(match_key).alias("_match"))
    if not distinct:
        part = F.pmod(F.xxhash64("_match"), F.lit(2)).alias("_part")
        keys = keys.select("_match", part).distinct().select("_match")
    return entities.join(keys, F.col(key) == F.col("_match"), "left_anti")


def score_of(joined: DataFrame, *, group: str, count: str, average: str, digits: int) -> DataFrame:
    """``score_by_group`` of a join."""
    rows, score = F.sum("rows"), F.sum("score")
    return (
        joined.filter(F.col("rows").isNotNull())
        .groupBy(F.struct(F.col(group).alias("group")).alias("_group"))
        .agg(rows.alias(count), F.round(score / rows, digits).alias(average))
        .select(F.col("_group.group").alias(group), count, average)
    )


def score_by_group(
    entities: DataFrame,
    profile: DataFrame,
    *,
    key: str = "id",
    group: str = "neighbourhood_cleansed",
    count: str = "review_count",
    average: str = "avg_sentiment",
    digits: int = 3,
) -> DataFrame:
    """Child rows and their average score per entity group, averaged over child rows."""
    joined = matched(entities, profile, key, [group])
    return score_of(joined, group=group, count=count, average=average, digits=digits)


def length_of(
    joined: DataFrame,
    floor: int,
    *,
    key: str,
    label: str,
    match_key: str,
    average: str,
    count: str,
    digits: int,
) -> DataFrame:
    """``length_by_entity`` of a join."""
    entity = F.struct(F.col(key).alias("key"), F.col(label).alias("label"))
    return (
        joined.filter(F.col("rows").isNotNull())
        .groupBy(entity.alias("_entity"))
        .agg(
            F.round(F.try_divide(F.max("chars"), F.max("texts")), digits).alias(average),
            F.sum("ids").alias(count),
        )
        .filter(F.col(count) >= floor)
        .select(
            F.col("_entity.key").alias(match_key),
            F.col("_entity.label").alias(label),
            average,
            count,
        )
    )


def length_by_entity(
    entities: DataFrame,
    profile: DataFrame,
    floor: int,
    *,
    key: str = "id",
    label: str = "name",
    average: str = "avg_comment_length",
    count: str = "reviews_count",
    digits: int = 1,
) -> DataFrame:
    """Average text length of every entity with at least ``floor`` child ids.

    The key keeps its child name. NULL texts count as child rows but not in the
    average, which is NULL where there is no text at all.
    """
    return length_of(
        matched(entities, profile, key, [label]),
        floor,
        key=key,
        label=label,
        match_key=profile.columns[0],
        average=average,
        count=count,
        digits=digits,
    )
