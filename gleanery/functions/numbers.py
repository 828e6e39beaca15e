"""Number parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_col, strip


def abbreviated_number(value: Column | str) -> Column:
    """``1K`` to 1000, ``2M`` to 2000000, plain integers as they are, anything else to 0.

    ``1,234`` is not a plain integer and gives 0.
    """
    text = F.upper(strip(as_col(value)))

    def scaled(letter: str, factor: int) -> Column:
        number = F.replace(text, F.lit(letter), F.lit("")).try_cast("double")
        return (number * F.lit(float(factor))).try_cast("bigint")

    number = (
        F.when(F.contains(text, F.lit("K")), scaled("K", 1_000))
        .when(F.contains(text, F.lit("M")), scaled("M", 1_000_000))
        .when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    )
    return F.coalesce(number, F.lit(0).cast("bigint"))
