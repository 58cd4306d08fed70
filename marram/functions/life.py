"""Column rules of the retirement projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marram.functions import fixed
from marram.functions.columns import ColumnLike, as_column, map_get
from marram.functions.numbers import idiv


def death_age(gender: ColumnLike, birth_year: ColumnLike) -> Column:
    """Expected age at death; anything but ``male`` uses the other rule."""
    lived = F.lit(fixed.REFERENCE_YEAR) - as_column(birth_year)
    male = F.lit(fixed.MALE_AGE) + idiv(lived, fixed.MALE_YEARS_PER_EXTRA)
    other = F.lit(fixed.FEMALE_AGE) + idiv(lived, fixed.FEMALE_YEARS_PER_EXTRA)
    return F.when(as_column(gender) == fixed.MALE, male).otherwise(other).cast("int")


def strategy_rate(strategy: ColumnLike) -> Column:
    """The yearly rate of a strategy, case ignored; an unknown one is an error."""
    entries = [F.lit(part) for pair in fixed.STRATEGY_RATES.items() for part in pair]
    rate = map_get(F.create_map(*entries), F.lower(as_column(strategy)))
    return F.coalesce(rate, unknown_strategy(strategy))


def unknown_strategy(strategy: ColumnLike) -> Column:
    message = F.concat(F.lit("unknown strategy: "), F.coalesce(as_column(strategy), F.lit("NULL")))
    return F.raise_error(message).cast("double")


def spending_ratio(balance: ColumnLike, years: ColumnLike) -> Column:
    """Balance per year of retirement, with IEEE results for zero years."""
    total, span = as_column(balance), as_column(years)
    by_zero = (
        F.when(total > 0, F.lit(float("inf")))
        .when(total < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(span == 0, by_zero).otherwise(F.try_divide(total, span.cast("double")))


def lifestyle_band(ratio: ColumnLike) -> Column:
    poor, modest, comfortable = fixed.BANDS
    return (
        F.when(as_column(ratio) < fixed.MODEST_FROM, poor)
        .when(as_column(ratio) < fixed.COMFORTABLE_FROM, modest)
        .otherwise(comfortable)
    )


def drawn(name: ColumnLike, what: str, seed: int, count: int) -> Column:
    """A number from 0 to ``count - 1`` that depends on name and seed alone."""
    digest = F.md5(F.concat(as_column(name), F.lit(f"|{what}|{seed}")))
    whole = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(whole, F.lit(count)).cast("int")
