import math

import pytest
from conftest import plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marram.functions import life
from marram.operators import elementwise, projection
from marram.operators.skew import lookup_join
from marram.sources.people import read_persons

PERSON = "name string, gender string, birth_year int, source_order bigint"
PLAN = "name string, start_age int, strategy string, contribution int, retirement_age int"


def persons(spark, *rows):
    return spark.createDataFrame(list(rows), PERSON)


def plans(spark, *rows):
    return spark.createDataFrame(list(rows), PLAN)


def test_death_age_truncates(spark):
    frame = spark.createDataFrame(
        [("male", 1999), ("male", 1998), ("female", 1989), ("female", 1988), (None, 1988), ("Male", 1988), ("male", 2030)],
        "gender string, birth_year int",
    )
    found = [r.a for r in frame.select(life.death_age("gender", "birth_year").alias("a")).collect()]
    assert found == [79, 80, 83, 84, 84, 84, 79]


def test_projection_values(spark):
    frame = projection.retirement_projection(
        persons(spark, ("Mia", "female", 1990, 1)), plans(spark, ("Mia", 30, "Growth", 10, 65))
    )
    row = frame.first()
    assert (row.death_age, row.working_years, row.retirement_years) == (83, 35, 18)
    assert row.balance == 35 * 1.045 + 10 / 100.0
    assert row.ratio == row.balance / 18
    assert row.band == "comfortable"


def test_ratio_follows_floating_point_rules(spark):
    frame = spark.createDataFrame(
        [(1.0, 0), (-1.0, 0), (0.0, 0), (1.0, -2), (0.56, 1), (0.55, 1), (1.0, 1)],
        "balance double, years int",
    ).withColumn("ratio", life.spending_ratio("balance", "years"))
    found = frame.withColumn("band", life.lifestyle_band("ratio")).collect()
    assert found[0].ratio == math.inf and found[1].ratio == -math.inf and math.isnan(found[2].ratio)
    assert [r.band for r in found] == [
        "comfortable",
        "miserable",
        "comfortable",
        "miserable",
        "modest",
        "miserable",
        "comfortable",
    ]


def test_unknown_strategies_fail(spark):
    made = plans(spark, ("Mia", 30, "lottery", 10, 65))
    someone = persons(spark, ("Mia", "female", 1990, 1))
    with pytest.raises(PySparkException, match="unknown strategy"):
        projection.retirement_projection(someone, made).collect()
    with pytest.raises(PySparkException, match="unknown strategy"):
        projection.with_rates(made, projection.rates_table(spark)).collect()


def test_rates_may_come_from_a_table(spark):
    rates = spark.createDataFrame([("Lottery", 2.0)], "strategy string, rate double")
    made = projection.with_rates(plans(spark, ("Mia", 30, "LOTTERY", 10, 65)), rates)
    assert made.first().rate == 2.0
    row = projection.retirement_projection(persons(spark, ("Mia", "male", 1990, 1)), made).first()
    assert row.balance == 70.1


def test_first_person_of_a_name_counts(spark):
    people = persons(
        spark, ("Mia", "male", 1950, 2), ("Mia", "female", 1990, 1), ("Bo", "male", 1960, 3)
    )
    assert tuple(projection.find_person(people, "Mia").first()) == ("Mia", "female", 1990)
    assert projection.find_person(people, "mia").collect() == []
    found = sorted(map(tuple, projection.first_by_name(people).collect()))
    assert found == [("Bo", "male", 1960), ("Mia", "female", 1990)]
    made = plans(spark, ("Mia", 30, "cash", 10, 65), ("Zoe", 30, "cash", 10, 65))
    assert projection.retirement_projection(people, made).count() == 1
    assert [r.name for r in projection.plans_without_person(people, made).collect()] == ["Zoe"]


def test_persons_file(spark, tmp_path):
    (tmp_path / "people").write_text("Mia,female,1990\nBo,male,1960,extra,1\nMia,male,1950\n")
    people = read_persons(spark, str(tmp_path / "people"))
    assert projection.find_person(people, "Mia").first().birth_year == 1990
    assert people.count() == 3
    assert dict(people.dtypes)["birth_year"] == "int"
    (tmp_path / "bad").write_text("Mia,female,soon\n")
    with pytest.raises(PySparkException):
        read_persons(spark, str(tmp_path / "bad")).collect()


def test_file_order_holds_across_splits(spark, tmp_path):
    body = "".join(f"Mia,female,{1900 + i % 100}\nP{i},male,1950\n" for i in range(500))
    (tmp_path / "people").write_text("Mia,male,1888\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
        people = read_persons(spark, str(tmp_path / "people"))
        assert people.rdd.getNumPartitions() > 8
        assert projection.find_person(people, "Mia").first().birth_year == 1888
        first = projection.first_by_name(people).where("name = 'Mia'").first()
        assert first.birth_year == 1888
        ordered = [r.birth_year for r in people.where("name = 'Mia'").orderBy("source_order").collect()]
        assert ordered == [1888] + [1900 + i % 100 for i in range(500)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_drawn_plans_repeat_and_stay_in_range(spark):
    people = spark.range(2000).select(F.concat(F.lit("P"), "id").alias("name"))
    one = projection.draw_plans(people, seed=3)
    assert one.exceptAll(projection.draw_plans(people, seed=3)).count() == 0
    assert one.exceptAll(projection.draw_plans(people, seed=4)).count() > 1000
    row = one.agg(
        *[f(c) for c in ("start_age", "contribution", "retirement_age") for f in (F.min, F.max)],
        F.count_distinct("strategy"),
    ).first()
    assert tuple(row) == (25, 40, 5, 20, 60, 70, 4)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("shares", [300, 30, 1])
def test_lookup_join_gives_the_plain_join(spark, how, shares):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        (F.col("id") % 40).cast("string")
    )
    facts = spark.range(3000).select(key.alias("k"), "id")
    lookup = spark.createDataFrame(
        [("hot", 1), ("1", 2), ("2", 3), ("unused", 4)], "k string, v int"
    )
    found = lookup_join(facts, lookup, "k", how, shares)
    expected = facts.join(lookup, "k", how).select(*found.columns)
    assert found.exceptAll(expected).count() == 0
    assert expected.exceptAll(found).count() == 0
    assert found.count() == expected.count()


def test_lookup_join_splits_the_hot_key(spark):
    facts = spark.range(3000).select(F.lit("hot").alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = lookup_join(facts, lookup, "k", shares=30)
        parts = found.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4
        assert max(r["count"] for r in parts) < 2000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, "k", "outer")


def test_lookup_join_splits_every_hot_key(spark):
    """More than a thousand keys hold more than the share that one task should have."""
    facts = spark.range(60_000).select((F.col("id") % 1500).cast("string").alias("k"), "id")
    lookup = facts.groupBy("k").agg(F.max("id").alias("v"))
    found = lookup_join(facts, lookup, "k", shares=3000)
    assert "Limit" not in plan_of(found)
    assert found.agg(F.count(F.lit(1)), F.sum("v")).first() == facts.join(lookup, "k").agg(
        F.count(F.lit(1)), F.sum("v")
    ).first()


def test_elementwise_chain(spark):
    found = elementwise.chain(spark.range(5).withColumnRenamed("id", "value")).orderBy("value")
    assert [r.result for r in found.collect()] == [1, 5, 17, 37, 65]


def test_elementwise_chain_wraps_or_fails(spark):
    frame = spark.createDataFrame([(70_000,), (2**31 - 1,), (-(2**31),)], "value bigint")
    found = {r.value: r.result for r in elementwise.chain(frame, int32=True).collect()}

    def wrapped(value):
        for step in (lambda v: v + v, lambda v: v * v, lambda v: v + 1):
            value = (step(value) + 2**31) % 2**32 - 2**31
        return value

    assert found == {value: wrapped(value) for value in found}
    assert elementwise.chain(frame).where("value = 70000").first().result == 140_000**2 + 1
    with pytest.raises(PySparkException):
        elementwise.chain(spark.createDataFrame([(2**40,)], "value bigint")).collect()
