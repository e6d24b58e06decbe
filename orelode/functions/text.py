"""Parsing of text fields and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names of the flower data and their codes; any other name
# gets OTHER_CLASS_CODE.
CLASS_CODES = {"Iris-setosa": 1.0, "Iris-versicolor": 2.0}
OTHER_CLASS_CODE = 3.0

# Fixed value: number of hash buckets when none is asked for.
DEFAULT_BUCKETS = 2**20


def number(text: Column, what: str = "number") -> Column:
    """Text to double; anything that is not a number raises, ANSI mode or not."""
    return F.coalesce(
        text.try_cast("double"),
        F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(text, F.lit("NULL")))).cast("double"),
    )


def number_or_zero(text: Column, what: str = "number") -> Column:
    """An empty field is 0.0; other text must be a number."""
    return F.when(text == "", F.lit(0.0)).otherwise(number(text, what))


def class_code(name: Column) -> Column:
    """Flower class name to its code."""
    code = F.lit(OTHER_CLASS_CODE)
    for label, value in CLASS_CODES.items():
        code = F.when(name == label, F.lit(value)).otherwise(code)
    return code


def split_tokens(text: Column, strip_trailing: bool = False) -> Column:
    """Split on single blanks. Inner empty tokens are kept and count as terms.

    With ``strip_trailing`` trailing empty tokens go, and a text of blanks only
    has no tokens (an empty text still has one, the empty token).
    """
    if not strip_trailing:
        return F.split(text, " ", -1)
    kept = F.split(F.rtrim(text), " ", -1)
    only_blanks = (F.rtrim(text) == "") & (text != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(kept)


def term_bucket(term: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """Hash bucket of a term, 0 <= bucket < buckets (``0`` means the default)."""
    return F.pmod(F.hash(term), F.lit(check_buckets(buckets)))


def check_buckets(buckets: int) -> int:
    if buckets < 0:
        raise ValueError(f"number of buckets must not be negative but got {buckets}")
    return buckets or DEFAULT_BUCKETS
