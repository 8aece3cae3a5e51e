"""Text and number expressions, in SQL."""

from __future__ import annotations


def is_empty(text: str) -> str:
    return f"({text} is null or {text} = '')"


def is_not_empty(text: str) -> str:
    return f"({text} is not null and {text} <> '')"


def trim_comma(text: str) -> str:
    """One comma taken off each end."""
    return f"regexp_replace({text}, '^,|,$', '')"


def two_digits(text: str) -> str:
    """A zero in front unless the text already has two characters."""
    return f"if(length({text}) = 2, {text}, concat('0', {text}))"


def half_up(number: str, places: int) -> str:
    """Round half up on the decimal form, which is what Spark's ``round`` does."""
    return f"round({number}, {places})"


def ratio(part: str, whole: str) -> str:
    """``part / whole`` to two places; 0 when there is nothing to divide by."""
    return half_up(f"{part} / greatest({whole}, 1)", 2)
