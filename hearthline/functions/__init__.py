"""Column builders: native expressions only, no Python workers."""

from hearthline.functions.money import band, currency
from hearthline.functions.text import NEGATIVE, POSITIVE, lexicon_function, lexicon_score, words

__all__ = [
    "NEGATIVE",
    "POSITIVE",
    "band",
    "currency",
    "lexicon_function",
    "lexicon_score",
    "words",
]
