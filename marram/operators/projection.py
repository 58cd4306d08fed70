"""Retirement projection over tables of persons and plans.

Persons have ``name, gender, birth_year``; plans have ``name, start_age,
strategy, contribution, retirement_age``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.functions import fixed, life
from marram.operators.skew import lookup_join


def first_by_name(persons: DataFrame, order: str = "source_order") -> DataFrame:
    """One person per name, the first by ``order``."""
    details = F.struct("gender", "birth_year")
    return (
        persons.groupBy("name")
        .agg(F.min_by(details, F.col(order)).alias("person"))
        .select("name", "person.gender", "person.birth_year")
    )


def find_person(persons: DataFrame, name: str, order: str = "source_order") -> DataFrame:
    """The first person of exactly that name; no row if there is none."""
    found = persons.where(F.col("name") == name).orderBy(order).limit(1)
    return found.select("name", "gender", "birth_year")


def rates_table(spark: SparkSession) -> DataFrame:
    """``strategy, rate``: the four known strategies."""
    entries = [F.lit(part) for pair in fixed.STRATEGY_RATES.items() for part in pair]
    return spark.range(1).select(F.explode(F.create_map(*entries)).alias("strategy", "rate"))


def with_rates(plans: DataFrame, rates: DataFrame) -> DataFrame:
    """Plans with the ``rate`` of their strategy, from a table of one row per strategy.

    Names are compared without case; a plan whose strategy the table lacks
    fails the job. Spark broadcasts the table if its size permits.
    """
    known = rates.select(F.lower("strategy").alias("_strategy"), "rate")
    joined = plans.join(known, F.lower(plans["strategy"]) == F.col("_strategy"), "left")
    return joined.withColumn(
        "rate", F.coalesce("rate", life.unknown_strategy("strategy"))
    ).drop("_strategy")


def project(people_with_plans: DataFrame) -> DataFrame:
    """Adds the projection to rows that have a person's and a plan's columns.

    The balance is years worked times the strategy's rate plus the
    contribution as a fraction; it is not compounded. A ``rate`` column is
    used if there is one, else the four known strategies' rates.
    """
    rate = (
        F.col("rate")
        if "rate" in people_with_plans.columns
        else life.strategy_rate("strategy")
    )
    return (
        people_with_plans.withColumn("death_age", life.death_age("gender", "birth_year"))
        .withColumn("working_years", F.col("retirement_age") - F.col("start_age"))
        .withColumn("retirement_years", F.col("death_age") - F.col("retirement_age"))
        .withColumn(
            "balance", F.col("working_years") * rate + F.col("contribution") / F.lit(100.0)
        )
        .withColumn("ratio", life.spending_ratio("balance", "retirement_years"))
        .withColumn("band", life.lifestyle_band("ratio"))
    )


def retirement_projection(
    persons: DataFrame, plans: DataFrame, order: str = "source_order"
) -> DataFrame:
    """The projection of every plan whose person is known."""
    return project(lookup_join(plans, first_by_name(persons, order), "name"))


def plans_without_person(persons: DataFrame, plans: DataFrame) -> DataFrame:
    """Plans that name nobody in the persons table."""
    known = persons.select("name").distinct().withColumn("_known", F.lit(True))
    return lookup_join(plans, known, "name", "left").where(F.col("_known").isNull()).drop("_known")


def lifestyle_bands(projection: DataFrame) -> DataFrame:
    """``band, n_persons``."""
    return projection.groupBy("band").agg(F.count(F.lit(1)).alias("n_persons"))


def draw_plans(persons: DataFrame, seed: int = 0) -> DataFrame:
    """One plan per person with values drawn from the usual ranges.

    The draw depends on name and seed alone, so runs repeat.
    """

    def between(what: str, bounds: tuple[int, int]) -> Column:
        lowest, count = bounds
        return (life.drawn("name", what, seed, count) + lowest).alias(what)

    strategies = F.array(*[F.lit(name) for name in fixed.STRATEGY_RATES])
    place = life.drawn("name", "strategy", seed, len(fixed.STRATEGY_RATES))
    return persons.select(
        "name",
        between("start_age", fixed.START_AGE),
        F.get(strategies, place).alias("strategy"),
        between("contribution", fixed.CONTRIBUTION),
        between("retirement_age", fixed.RETIREMENT_AGE),
    )
