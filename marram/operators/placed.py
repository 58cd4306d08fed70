"""Revisions stored by contributor, so that lookups read one bucket and cogroups move nothing.

This is the one part of the library that writes tables of its own accord.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.operators import articles
from marram.operators.skew import SHARES, hot_keys

BUCKETS = 64


@dataclass(frozen=True)
class Placed:
    """Stored revisions: ``rest`` in buckets by contributor, ``busy`` those of contributors too frequent for one."""

    rest: DataFrame
    busy: DataFrame

    def rows(self) -> DataFrame:
        return self.rest.unionByName(self.busy)


def place(folder: str, *sides: DataFrame, buckets: int = BUCKETS, shares: int = SHARES) -> list[Placed]:
    """Stores each dataset under ``folder`` for lookups and cogroups by contributor.

    Contributors with more than a ``shares``-th of the rows of all sides
    together are stored apart on every side, spread over files, so that no
    bucket holds more than its keys' fair share. Revisions without a
    contributor are among them. Tables get names of their own in the catalog.
    """
    everyone = sides[0].select("contributor")
    for side in sides[1:]:
        everyone = everyone.unionAll(side.select("contributor"))
    hot = F.broadcast(hot_keys(everyone, "contributor", shares).select(F.col("contributor").alias("hot")))
    name = f"revisions_{uuid.uuid4().hex}"
    out = []
    for at, side in enumerate(sides):
        marked = side.join(hot, F.col("contributor") == F.col("hot"), "left")
        apart = F.col("hot").isNotNull() | F.col("contributor").isNull()
        rest, busy = (marked.where(kind).drop("hot") for kind in (~apart, apart))
        # Dealt out as the buckets are, each task writes one file.
        dealt = rest.repartition(buckets, "contributor").sortWithinPartitions("contributor")
        tables = [f"{name}_{at}_{part}" for part in ("rest", "busy")]
        dealt.write.bucketBy(buckets, "contributor").sortBy("contributor").option(
            "path", f"{folder}/{tables[0]}"
        ).saveAsTable(tables[0])
        busy.sortWithinPartitions("contributor").write.option("path", f"{folder}/{tables[1]}").saveAsTable(tables[1])
        out.append(Placed(*(side.sparkSession.table(table) for table in tables)))
    return out


def lookup(placed: Placed, contributor: str) -> DataFrame:
    """All revisions of one contributor: one bucket of the rest, and row groups of the busy by their bounds."""
    wanted = F.col("contributor") == contributor
    return placed.rest.where(wanted).unionByName(placed.busy.where(wanted))


def cogroup(left: Placed, right: Placed, aggregates: Mapping[str, Column]) -> DataFrame:
    """As ``articles.cogroup``; sides stored together meet bucket by bucket, without a shuffle.

    Only the aggregates of the busy contributors, reduced where they are read, are moved.
    """
    rest = articles.cogroup(left.rest, right.rest, aggregates)
    return rest.unionByName(articles.cogroup(left.busy, right.busy, aggregates))


def cogroup_sizes(left: Placed, right: Placed) -> DataFrame:
    rest = articles.cogroup_sizes(left.rest, right.rest)
    return rest.unionByName(articles.cogroup_sizes(left.busy, right.busy))
