"""A lookup join that stays even when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than one part in so many of all rows is split.
SHARES = 1000


def hot_keys(facts: DataFrame, key: str, shares: int = SHARES) -> DataFrame:
    """Keys with more than a ``shares``-th of all rows, and in how many ``_parts`` to split them.

    There can be no more than ``shares`` of them.
    """
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    return counts.where(F.col("_rows") * shares > total).select(
        key, F.ceil(F.col("_rows") * F.lit(float(shares)) / total).alias("_parts")
    )


def with_parts(facts: DataFrame, key: str, number: Column, shares: int = SHARES) -> DataFrame:
    """``facts`` with ``part``: rows of a frequent key are dealt out to parts by ``number``.

    Placed or grouped by key and part, rows of one key stay in few places, and
    none of these holds much more than a ``shares``-th of all rows.
    """
    hot = F.broadcast(hot_keys(facts, key, shares))
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    return facts.join(hot, key, "left").select(
        *facts.columns, F.pmod(number, parts).alias("part")
    )


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner", shares: int = SHARES, hot: DataFrame | None = None
) -> DataFrame:
    """``facts`` joined with ``lookup``, which has one row per key at most.

    Meant for a lookup side that is itself an aggregate, where adaptive skew
    handling cannot split the join. A key with more than a ``shares``-th of all
    fact rows is split into parts of about that size, and only its lookup row
    is repeated. There can be no more than ``shares`` such keys, so their table
    is small whatever the facts, and no other key holds more than that share.
    Every row still meets its partner, so the result is that of the plain join.
    Parts depend on a row's values alone, so a lost task can be run again; a
    part that is large because its rows are copies of one another is left to
    the adaptive skew join, which can split this join's left side.

    Where the frequent keys are known, ``hot`` is their table, ``key`` and ``_parts``, as ``hot_keys`` gives it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    hot = hot_keys(facts, key, shares) if hot is None else hot
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    # Rows without a key meet no partner and may go anywhere.
    fact_parts = F.when(F.col(key).isNull(), F.lit(shares).cast("bigint")).otherwise(parts)
    spread = F.pmod(F.xxhash64(*[F.col(name) for name in facts.columns]), fact_parts)
    left = facts.join(F.broadcast(hot), key, "left").select(
        *facts.columns, spread.alias("_part")
    )
    right = lookup.join(F.broadcast(hot), key, "left").select(
        *lookup.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("_part")
    )
    return left.join(right, [key, "_part"], how).drop("_part")
