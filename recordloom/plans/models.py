"""The standard models as plain functions from frames to frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import trimmed_equals
from ..operators.linkage import STANDARD_RULES, best_links, link, match_frame
from ..operators.merge import Sources, merge
from ..operators.shape import standardize
from . import presets as P


def standard_flat(raw: DataFrame) -> DataFrame:
    return standardize(raw, P.FLAT_STANDARD)


def standard_nested(raw: DataFrame) -> DataFrame:
    return standardize(raw, P.NESTED_STANDARD)


def linked(
    left: DataFrame, right: DataFrame, assume_non_null: bool = False, decisions: DataFrame | None = None
) -> DataFrame:
    """Both rules over the rows of one country, under review decisions if there are any."""
    domestic = trimmed_equals("country", P.COUNTRY)
    return link(
        match_frame(left, P.LEFT_ID, P.MATCH_KEYS, domestic),
        match_frame(right, P.RIGHT_ID, P.MATCH_KEYS, domestic),
        P.LEFT_ID,
        P.RIGHT_ID,
        STANDARD_RULES,
        assume_non_null,
        decisions,
    )


def best_linked(left: DataFrame, right: DataFrame, assume_non_null: bool = False) -> DataFrame:
    """The best of each left id's links under ``linked``, which is all that a mapping takes."""
    domestic = trimmed_equals("country", P.COUNTRY)
    return best_links(
        match_frame(left, P.LEFT_ID, P.MATCH_KEYS, domestic),
        match_frame(right, P.RIGHT_ID, P.MATCH_KEYS, domestic),
        P.LEFT_ID,
        P.RIGHT_ID,
        STANDARD_RULES,
        assume_non_null,
    )


def merged(
    left: DataFrame,
    right: DataFrame,
    links: DataFrame,
    sources: Sources,
    assume_non_null: bool = False,
) -> DataFrame:
    return merge(
        left,
        right,
        links,
        P.LEFT_ID,
        P.RIGHT_ID,
        P.ATTRIBUTES,
        P.FILLED,
        sources,
        assume_non_null,
    )
