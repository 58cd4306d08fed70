"""Mixing sources to target weights by hash-random order and prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.common import stored, whole_row

# Bits of the hash-random key that buckets use, and of one level of buckets.
KEY_BITS = 60
LEVEL_BITS = 10
RESULTS = ("source_size", "target", "taken")


def draw(doc_id: Column) -> Column:
    """The hash-random key of a document, as 32 hexadecimal digits."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def _place(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def _ranks(sources: DataFrame) -> DataFrame:
    """``rank`` of each source from 0 by code point, the missing source last."""
    order = [F.col("_s") == "", F.col("_s")]
    ranged = stored(
        sources.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), "sources"
    )
    before = (
        ranged.groupBy("_pid")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
        .drop("_n")
    )
    inside = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    return ranged.withColumn("_in", inside).join(before, "_pid").select(
        *sources.columns, (F.col("_before") + F.col("_in")).alias("rank")
    )


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Target size of each source: columns ``_s``, ``source_size``, ``n_rows``, ``target``.

    ``sizes`` has ``_s`` and ``size``. ``share`` of all sizes is dealt out by
    weight; no source gets more than ``most`` times its size, and what is over
    goes to the others by weight until none is above. Each round is an
    aggregate over the sources; only its sums reach the driver.
    """
    totals = stored(
        sizes.groupBy("_s").agg(
            F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
        ),
        "totals",
    )
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    weighed = stored(
        _ranks(totals).withColumn(
            "weight", F.element_at(cycle, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
        ),
        "weights",
    )
    full_size = F.col("source_size") * F.lit(float(most))
    level, full = 0.0, -1
    while True:
        over = full_size <= F.col("weight") * F.lit(level)
        sums = weighed.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("filled"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("free"),
            F.count(F.when(over, 1)).alias("full"),
        ).first()
        if sums.full == full or not sums.free:
            break
        full = sums.full
        level = (share * sums.total - most * sums.filled) / sums.free
    target = F.least(full_size, F.col("weight") * F.lit(level))
    return weighed.select(
        "_s", "source_size", "n_rows", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def _starts(rows: DataFrame, sources: DataFrame, rows_per_bucket: int) -> DataFrame:
    """``rows`` with ``start``: the sum of ``mass`` before each, in its source's order.

    The order is that of ``_h`` and ``size``. Buckets are ranges of the uniform
    key, so they hold about ``rows_per_bucket`` rows of a source whatever its
    size. Sums of buckets are added up over levels of 1,024 buckets to one, so
    no window sees more than that many rows.
    """
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n_rows") / F.lit(float(rows_per_bucket)))))
    sources = sources.withColumn("_bits", F.least(F.lit(KEY_BITS), bits).cast("int"))
    deepest = sources.agg(F.max("_bits")).first()[0] or 0
    key = F.conv(F.substring("_h", 1, KEY_BITS // 4), 16, 10).cast("bigint")
    placed = rows.join(sources.select("_s", "_bits"), "_s").withColumn("_k", key)
    placed = placed.withColumn("_b0", F.expr(f"shiftright(_k, {KEY_BITS} - _bits)")).drop("_k")
    levels = [placed.groupBy("_s", "_b0").agg(F.sum("mass").alias("mass"))]
    for level in range(deepest // LEVEL_BITS + 1):
        below = stored(
            levels[-1].withColumn(
                f"_b{level + 1}", F.expr(f"shiftright(_b{level}, {LEVEL_BITS})")
            ),
            "buckets",
        )
        levels[-1] = below
        levels.append(below.groupBy("_s", f"_b{level + 1}").agg(F.sum("mass").alias("mass")))
    start = levels[-1].select("_s", f"_b{len(levels) - 1}", F.lit(0).cast("bigint").alias("_at"))
    for level in range(len(levels) - 2, -1, -1):
        within = Window.partitionBy("_s", f"_b{level + 1}").orderBy(f"_b{level}")
        before = F.sum("mass").over(within) - F.col("mass")
        start = (
            levels[level]
            .withColumn("_before", before)
            .join(start, ["_s", f"_b{level + 1}"])
            .select("_s", f"_b{level}", (F.col("_at") + F.col("_before")).alias("_at"))
        )
    within = Window.partitionBy("_s", "_b0").orderBy("_h", "size")
    before = F.sum("mass").over(within) - F.col("mass")
    return placed.withColumn("_before", before).join(start, ["_s", "_b0"]).select(
        *rows.columns, (F.col("_at") + F.col("_before")).alias("start")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    rows_per_bucket: int = 64,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``taken``, the part of each in the mix.

    Every source's documents are put in hash-random order; its budget is the
    whole part of its target. Whole passes over a source are taken by all its
    documents; the rest of the budget by the first ones in that order, and the
    document at the cut gives only the part that is missing. So a source's
    taken sizes add up to its budget exactly, and reruns agree.

    Results in unusual cases: a null source is a source of its own, ranked
    last; a null or negative size is 0 and takes 0; a null id is drawn as an
    empty one; rows of one id, source and size share what falls to them
    evenly, rounded down; an empty table gives no rows. Columns of ``docs``
    named like a result are replaced; all others stay, whatever their names.
    """
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    plain = docs.select(
        whole_row(docs, *RESULTS).alias("row"), _place(F.col(source_col)).alias("_s"), draw(F.col(id_col)).alias("_h"),
        size.alias("_z"),
    )
    slim = stored(
        plain.groupBy("_s", "_h", F.col("_z").alias("size")).agg(F.count(F.lit(1)).alias("_m")),
        "sizes",
    )
    massed = slim.withColumn("mass", F.col("size") * F.col("_m"))
    sources = stored(
        source_targets(massed.select("_s", F.col("mass").alias("size")), weights, share, most)
        .withColumn("_budget", F.floor("target"))
        .withColumn("_epochs", F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(0))
        .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("source_size")),
        "targets",
    )
    starts = _starts(massed, sources, rows_per_bucket)
    cuts = (
        starts.join(sources.select("_s", "_rest"), "_s")
        .where("start < _rest and _rest <= start + mass")
        .select(
            "_s",
            F.struct("_h", "size").alias("_cut"),
            F.expr("(_rest - start) div _m").alias("_part"),
        )
    )
    plan = stored(sources.join(cuts, "_s", "left").drop("n_rows", "_budget", "_rest"), "cuts")
    place = F.struct("_h", F.col("_z").alias("size"))
    extra = (
        F.when(place < F.col("_cut"), F.col("_z"))
        .when(place == F.col("_cut"), F.col("_part"))
        .otherwise(0)
    )
    return plain.join(plan, "_s").select(
        "row.*",
        "source_size",
        "target",
        (F.col("_epochs") * F.col("_z") + extra).cast("bigint").alias("taken"),
    )
