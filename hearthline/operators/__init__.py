"""General table operators; columns, thresholds and word lists are arguments."""

from hearthline.operators.groups import ExactAverage, group_stats, within
from hearthline.operators.lexicon import lexicon_score_table
from hearthline.operators.matches import (
    length_by_entity,
    length_of,
    match_profile,
    matched,
    score_by_group,
    score_of,
    top_by_matches,
    top_of,
    without_match,
)
from hearthline.operators.ranks import with_rank
from hearthline.operators.sql import SENTIMENT, TEXT_LENGTH, sql_over

__all__ = [
    "SENTIMENT",
    "TEXT_LENGTH",
    "ExactAverage",
    "group_stats",
    "length_by_entity",
    "length_of",
    "lexicon_score_table",
    "match_profile",
    "matched",
    "score_by_group",
    "score_of",
    "sql_over",
    "top_by_matches",
    "top_of",
    "with_rank",
    "within",
    "without_match",
]
