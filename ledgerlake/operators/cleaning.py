"""Typing, validation and normalisation of the clean (silver) layer."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import extract_text_fields
from ..functions.money import AMOUNT_LIMIT
from ..functions.text import trim_spaces

NULL_REQUIRED = "null_required"
INVALID_VALUE = "invalid_value"
DUPLICATE = "duplicate"


def extract_fields(df: DataFrame, payload: str, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """JSON payload -> one text column per field (plus ``keep`` columns), one parse per row.

    The parsed object comes out of a generator over a one-element array. A
    filter on the extracted fields then stays above the parse; over a plain
    projection the optimizer would push it below and repeat the parse once
    per field the predicate references.
    """
    parsed = F.explode(F.array(extract_text_fields(payload, fields))).alias("__p")
    return df.select(*(keep or []), parsed).select(*(keep or []), *[F.col(f"__p.{f}").alias(f) for f in fields])


def cast_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text -> DOUBLE; text that is not a number becomes NULL instead of failing."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in cols})


def trim_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Strip surrounding spaces from the given text columns in one projection."""
    return df.withColumns({c: trim_spaces(c) for c in cols})


def required_present(cols: list[str]) -> Column:
    """All ``cols`` non-NULL (an empty string counts as present)."""
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def values_valid(positive: list[str], non_negative: list[str]) -> Column:
    """``p > 0`` for each positive column and ``n >= 0`` for each non-negative one, all below what
    money can hold (so NaN and infinities, which compare greater than any number, are invalid too).

    NULL in any of them makes the predicate NULL, which a filter drops.
    """
    conds = [F.col(c) > 0 for c in positive] + [F.col(c) >= 0 for c in non_negative]
    return reduce(and_, conds + [F.col(c) < AMOUNT_LIMIT for c in positive + non_negative])


def values_invalid(positive: list[str], non_negative: list[str]) -> Column:
    """The negation the quality gate counts: a NULL amount is *not* flagged here."""
    conds = [F.col(c) <= 0 for c in positive] + [F.col(c) < 0 for c in non_negative]
    return reduce(or_, conds + [F.col(c) >= AMOUNT_LIMIT for c in positive + non_negative])


def any_null(cols: list[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols])


def filter_required(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.filter(required_present(cols))


def filter_values(df: DataFrame, positive: list[str], non_negative: list[str]) -> DataFrame:
    return df.filter(values_valid(positive, non_negative))


def reject_reason(required: list[str], positive: list[str], non_negative: list[str]) -> Column:
    """First rule a row breaks (required fields, then amounts), NULL when it passes both."""
    return (
        F.when(~required_present(required), F.lit(NULL_REQUIRED))
        .when(F.coalesce(values_valid(positive, non_negative), F.lit(False)) == F.lit(False), F.lit(INVALID_VALUE))
    )
