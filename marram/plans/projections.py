"""Retirement projection and element-wise queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marram.operators import elementwise, projection
from marram.plans.tables import (
    elements,
    person_lines,
    persons,
    plans,
    plans_by_order,
    shared_names,
    with_tables,
)
from marram.sources.people import persons_from_lines

_SHOWN = (
    "name",
    "death_age",
    "working_years",
    "retirement_years",
    "balance",
    "ratio",
    "band",
)


def _projection(spark, sf):
    return projection.retirement_projection(persons(spark, sf), plans(spark, sf))


def _projection_by_order(spark, sf):
    """Many plans per person, strategies in mixed case."""
    made = projection.retirement_projection(persons(spark, sf), plans_by_order(spark, sf))
    return made.select("plan_id", *_SHOWN)


def _with_rates(spark, sf):
    plan_rates = projection.with_rates(plans_by_order(spark, sf), projection.rates_table(spark))
    return plan_rates.select("plan_id", "strategy", "rate")


QUERIES = {
    "retirement_projection": lambda s, d: _projection(s, d).select(*_SHOWN),
    "retirement_projection_by_order": _projection_by_order,
    "lifestyle_bands": lambda s, d: projection.lifestyle_bands(_projection(s, d)),
    "plan_rates": _with_rates,
    "plans_without_person": lambda s, d: projection.plans_without_person(
        persons(s, d), plans_by_order(s, d)
    ).select("plan_id", "name"),
    "person_lookup": lambda s, d: projection.find_person(persons(s, d), "Customer#000000042"),
    "person_lookup_shared": lambda s, d: projection.find_person(shared_names(s, d), "BUILDING"),
    "persons_first_by_name": lambda s, d: projection.first_by_name(shared_names(s, d)),
    "persons_parsed": lambda s, d: persons_from_lines(person_lines(s, d)),
    "drawn_plans": lambda s, d: projection.draw_plans(persons(s, d), seed=7),
    "elementwise_chain": lambda s, d: elementwise.chain(elements(s, d)),
    "elementwise_chain_int32": lambda s, d: elementwise.chain(
        elements(s, d).select((F.col("value") * 2654435).alias("value")), int32=True
    ),
}

_RATE = """CASE lower(strategy) WHEN 'growth' THEN CAST(1.045 AS DOUBLE)
    WHEN 'balanced' THEN CAST(1.035 AS DOUBLE) WHEN 'conservative' THEN CAST(1.025 AS DOUBLE)
    WHEN 'cash' THEN CAST(1.01 AS DOUBLE) END"""

_BY_ORDER = """by_order AS (SELECT o_orderkey AS plan_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Nobody#' ELSE 'Customer#' END
      || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS name,
    CAST(25 + o_orderkey % 16 AS INTEGER) AS start_age,
    ['Growth', 'BALANCED', 'conservative', 'cash'][o_orderkey % 4 + 1] AS strategy,
    CAST(5 + o_orderkey % 16 AS INTEGER) AS contribution,
    CAST(60 + o_orderkey % 11 AS INTEGER) AS retirement_age FROM orders)"""


def _projected(source: str) -> str:
    return f"""aged AS (SELECT *, CAST(CASE WHEN gender = 'male' THEN 79 + (2018 - birth_year) // 20
      ELSE 83 + (2018 - birth_year) // 30 END AS INTEGER) AS death_age, {_RATE} AS rate
    FROM {source} JOIN persons USING (name)),
  spans AS (SELECT *, retirement_age - start_age AS working_years,
    death_age - retirement_age AS retirement_years FROM aged),
  balances AS (SELECT *, working_years * rate + contribution / CAST(100 AS DOUBLE) AS balance FROM spans),
  ratios AS (SELECT *, balance / retirement_years AS ratio FROM balances),
  projected AS (SELECT *, CASE WHEN ratio < 0.56 THEN 'miserable' WHEN ratio < 1.0 THEN 'modest'
    ELSE 'comfortable' END AS band FROM ratios)"""


_COLUMNS = ", ".join(_SHOWN)
_SHARED = """shared AS (SELECT c_mktsegment AS name,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
    CAST(1928 + c_custkey % 91 AS INTEGER) AS birth_year, 1000000000 - c_custkey AS source_order
    FROM customer)"""


def _draw(what: str, count: int) -> str:
    digest = f"substr(md5(c_name || '|{what}|7'), 1, 8)"
    return f"CAST(CAST('0x' || {digest} AS BIGINT) % {count} AS INTEGER)"


def _wrapped(value: str) -> str:
    return f"((({value}) + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648"


ORACLE = {
    "persons_parsed": with_tables(
        "persons",
        then="""SELECT name, gender, birth_year, CAST(c_custkey AS BIGINT) AS source_order
  FROM persons JOIN customer ON name = c_name""",
    ),
    "retirement_projection": with_tables("persons", "plans", then="")
    + ", "
    + _projected("plans")
    + f"\nSELECT {_COLUMNS} FROM projected",
    "retirement_projection_by_order": with_tables("persons", then="")
    + ", "
    + _BY_ORDER
    + ", "
    + _projected("by_order")
    + f"\nSELECT plan_id, {_COLUMNS} FROM projected",
    "lifestyle_bands": with_tables("persons", "plans", then="")
    + ", "
    + _projected("plans")
    + "\nSELECT band, count(*) AS n_persons FROM projected GROUP BY band",
    "plan_rates": f"WITH {_BY_ORDER}\nSELECT plan_id, strategy, {_RATE} AS rate FROM by_order",
    "plans_without_person": f"""WITH {_BY_ORDER}
SELECT plan_id, name FROM by_order WHERE name NOT IN (SELECT c_name FROM customer)""",
    "person_lookup": with_tables(
        "persons", then="SELECT name, gender, birth_year FROM persons WHERE name = 'Customer#000000042'"
    ),
    "person_lookup_shared": f"""WITH {_SHARED}
SELECT name, gender, birth_year FROM shared WHERE name = 'BUILDING' ORDER BY source_order LIMIT 1""",
    "persons_first_by_name": f"""WITH {_SHARED}
SELECT name, gender, birth_year FROM shared
QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_order) = 1""",
    "drawn_plans": f"""SELECT c_name AS name, 25 + {_draw("start_age", 16)} AS start_age,
  ['growth', 'balanced', 'conservative', 'cash'][{_draw("strategy", 4)} + 1] AS strategy,
  5 + {_draw("contribution", 16)} AS contribution,
  60 + {_draw("retirement_age", 11)} AS retirement_age FROM customer""",
    "elementwise_chain": """SELECT o_orderkey AS value, CAST((o_orderkey + o_orderkey) * (o_orderkey + o_orderkey) + 1
  AS BIGINT) AS result FROM orders""",
    "elementwise_chain_int32": f"""WITH doubled AS (SELECT value, {_wrapped("value + value")} AS twice
  FROM (SELECT o_orderkey * 2654435 AS value FROM orders))
SELECT value, CAST({_wrapped(_wrapped("twice * twice") + " + 1")} AS BIGINT) AS result FROM doubled""",
}
