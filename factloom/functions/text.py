"""Sentence, keyword and prompt expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the sentence that describes a row, parts joined by one blank --
PLAYER_SENTENCE = (
    "The player is",
    "{player_name}",
    ". Represents team",
    "{team}",
    ". Plays as",
    "{position}",
    ". During the tournament scored",
    "{total_goals_tournament}",
    "goals and played",
    "{total_minutes_tournament}",
    "minutes.",
)


def sentence(parts: Sequence[str] = PLAYER_SENTENCE, skip_nulls: bool = False) -> Column:
    """Join literal parts and ``{column}`` parts by one blank.

    A NULL part makes the whole sentence NULL; with ``skip_nulls`` it is left out.
    """
    pieces = [F.col(p[1:-1]).cast("string") if p.startswith("{") else F.lit(p) for p in parts]
    text = F.concat_ws(" ", *pieces)
    if skip_nulls:
        return text
    columns = [piece for p, piece in zip(parts, pieces) if p.startswith("{")]
    any_null = reduce(or_, [c.isNull() for c in columns], F.lit(False))
    return F.when(~any_null, text)


def render(template: str, **values: Column) -> Column:
    """Fill the ``{name}`` places of ``template`` with columns."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(values[name])
    return F.concat(*pieces)


def plain_keyword(keyword: str, literal: bool = False) -> str:
    """A keyword as it is searched for: without apostrophes unless ``literal``."""
    return keyword if literal else keyword.replace("'", "")


def has_wildcard(keyword: str) -> bool:
    return "%" in keyword or "_" in keyword


def like_pattern(keyword: str) -> str:
    return "%" + keyword.replace("\\", "\\\\") + "%"


def contains_keyword(text: Column, keyword: str, literal: bool = False) -> Column:
    """Case-insensitive substring test. ``%`` and ``_`` in the keyword act as
    wildcards unless ``literal``; a backslash is an ordinary character."""
    word = plain_keyword(keyword, literal)
    if literal or not has_wildcard(word):
        return F.lower(text).contains(F.lower(F.lit(word)))
    return text.ilike(like_pattern(word))


def contains_all(text: Column, keywords: Sequence[str], literal: bool = False) -> Column:
    """True if the text holds every keyword; true for no keywords."""
    tests = [contains_keyword(text, k, literal) for k in keywords]
    return reduce(and_, tests, text.isNotNull())
