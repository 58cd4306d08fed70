"""Functions over a group's rows in order, where the order matters and a group may be of any size.

A group is never brought together. Rows are dealt out by ranges of key and
order and cut into blocks, each block becomes a state, and states are merged
in the order of their blocks, so many at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A block has so many rows, and a merge so many states, as a power of two.
BITS = 13
# Row numbers are numbers of partition and place, in so many bits.
_NUMBER_BITS = 63


@dataclass(frozen=True)
class Fold:
    """What to do with a group's rows, as column functions.

    ``start`` is the state before any row, ``step`` takes a state and a row (a
    struct) to the next state, ``merge`` joins the states of two stretches of
    rows that follow one another, and ``finish`` makes the result of the last
    state. ``merge`` must be associative, and merging with ``start`` must
    change nothing. States are of one type that can be ordered: no maps.
    """

    start: Column
    step: Callable[[Column, Column], Column]
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column]


def fold_groups(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold, name: str = "result", bits: int = BITS
) -> DataFrame:
    """One row per group of ``keys``: the keys and the fold's result over its rows in ``order``.

    ``order`` should leave no ties; rows equal in it may come in any order. A
    null key is a group, nulls in ``order`` come first. No rows, no groups.
    """
    if not 1 <= bits <= 20:
        raise ValueError("bits must be from 1 to 20")
    others = [column for column in rows.columns if column not in keys]
    by = [F.col(column) for column in (*keys, *order)]
    # Ranges cut a large group by its order; what is equal in key and order stays together.
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = placed.select(
        *keys, F.monotonically_increasing_id().alias("_at"), F.struct(*others).alias("_row")
    )
    listed = numbered.groupBy(*keys, F.shiftright("_at", bits).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_row"))).alias("_rows")
    )
    states = listed.select(
        *keys, "_block", F.aggregate("_rows", fold.start, lambda s, r: fold.step(s, r["_row"])).alias("_state")
    )
    left = _NUMBER_BITS - bits
    while left > 0:
        left -= bits
        merged = states.groupBy(*keys, F.shiftright("_block", bits).alias("_block")).agg(
            F.array_sort(F.collect_list(F.struct("_block", "_state"))).alias("_states")
        )
        rest = F.slice("_states", F.lit(2), F.size("_states"))
        first = F.element_at("_states", 1)["_state"]
        states = merged.select(
            *keys, "_block", F.aggregate(rest, first, lambda s, b: fold.merge(s, b["_state"])).alias("_state")
        )
    return states.select(*keys, fold.finish(F.col("_state")).alias(name))


def longest_run(column: str) -> Fold:
    """Length of the longest run of rows with one value; nulls are equal to each other."""
    long = F.lit(0).cast("bigint")

    def state(n: Column, first: Column, lead: Column, last: Column, tail: Column, best: Column) -> Column:
        values = {"n": n, "first": first, "lead": lead, "last": last, "tail": tail, "best": best}
        return F.struct(*[value.alias(field) for field, value in values.items()])

    def merge(a: Column, b: Column) -> Column:
        met = a["last"].eqNullSafe(b["first"])
        joined = state(
            a["n"] + b["n"],
            a["first"],
            F.when(met & (a["lead"] == a["n"]), a["n"] + b["lead"]).otherwise(a["lead"]),
            b["last"],
            F.when(met & (b["tail"] == b["n"]), b["n"] + a["tail"]).otherwise(b["tail"]),
            F.greatest(a["best"], b["best"], F.when(met, a["tail"] + b["lead"]).otherwise(long)),
        )
        return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(joined)

    def step(a: Column, row: Column) -> Column:
        one = F.lit(1).cast("bigint")
        value = row[column].cast("string")
        return merge(a, state(one, value, one, value, one, one))

    nothing = F.lit(None).cast("string")
    return Fold(state(long, nothing, long, nothing, long, long), step, merge, lambda s: s["best"])


@dataclass(frozen=True)
class Automaton:
    """A predicate on rows in order, as a finite automaton that starts in state 0.

    ``kinds`` tell a row's kind: the first that holds, else the one behind
    them. ``moves[kind][state]`` is the next state; the predicate holds if the
    last state is one of ``accepting``.
    """

    kinds: Sequence[Callable[[Column], Column]]
    moves: Sequence[Sequence[int]]
    accepting: Sequence[int]

    def __post_init__(self) -> None:
        n = len(self.moves[0])
        if len(self.moves) != len(self.kinds) + 1:
            raise ValueError("one row of moves per kind, and one for all other rows")
        if any(len(row) != n or not all(0 <= state < n for state in row) for row in self.moves):
            raise ValueError("every kind needs a next state for every state")

    def fold(self) -> Fold:
        """A stretch of rows as the table of states it leads to; tables of stretches are composed."""

        def table(states: Sequence[int]) -> Column:
            return F.array(*[F.lit(state) for state in states])

        def step(so_far: Column, row: Column) -> Column:
            moves = table(self.moves[-1])
            for kind, states in reversed(list(zip(self.kinds, self.moves, strict=False))):
                moves = F.when(kind(row), table(states)).otherwise(moves)
            return compose(so_far, moves)

        def compose(first: Column, then: Column) -> Column:
            return F.transform(first, lambda state: F.element_at(then, state + 1))

        return Fold(
            table(range(len(self.moves[0]))),
            step,
            compose,
            lambda s: F.array_contains(table(self.accepting), F.element_at(s, 1)) if self.accepting else F.lit(False),
        )


def filter_cogroup_in_order(
    left: DataFrame, right: DataFrame, automaton: Automaton, order: Sequence[str] = ("ts", "rid"), bits: int = BITS
) -> DataFrame:
    """Contributors whose revisions, in order, fulfil the predicate on both sides.

    A side without the contributor is a sequence of no rows.
    """

    def side(revisions: DataFrame, name: str) -> DataFrame:
        return fold_groups(revisions, ["contributor"], order, automaton.fold(), name, bits)

    empty = F.lit(0 in automaton.accepting)
    both = side(left, "in_left").join(side(right, "in_right"), "contributor", "full_outer")
    return both.where(F.coalesce("in_left", empty) & F.coalesce("in_right", empty)).select("contributor")
