"""Near-duplicate vectors found with spherical-cap filters of a random product code."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.llm.common import by_runs, components, in_blocks, local_links, stored

LEAST = 0.93
# A random vector is expected in so many caps; a vector in fewer than the least
# is given its best directions up to that. Caps per vector of the largest label.
CAPS_OF_A_VECTOR = 20
LEAST_CAPS = 40
CAPS_PER_VECTOR = 4
PARTS = 3
BLOCK = 1024
SEED = 11
_ROWS_AT_ONCE = 64
_TOP = 12


def code(dimension: int, size: int, seed: int = SEED) -> list[np.ndarray]:
    """The product code: ``size`` random unit vectors for each of up to three stretches of the dimensions."""
    random = np.random.default_rng([seed, dimension, size])
    out = []
    for stretch in np.array_split(np.arange(dimension), min(PARTS, dimension)):
        part = random.normal(size=(size, len(stretch)))
        out.append(part / np.linalg.norm(part, axis=1, keepdims=True))
    return out


def rotation(dimension: int, seed: int = SEED) -> np.ndarray:
    """A random rotation, so that no stretch of the given dimensions is special."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dimension]).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def decode(
    vectors: np.ndarray, size: int, caps: float = CAPS_OF_A_VECTOR, fewest: int = LEAST_CAPS
) -> tuple[np.ndarray, np.ndarray]:
    """All filter directions whose cap holds each unit vector: (row, filter).

    A direction takes one code vector per stretch, and its inner product is
    the sum of theirs. Stretch by stretch, sums that the rest cannot lift over
    the threshold are dropped, so all of the code need not be tried. The
    threshold is that of ``caps`` expected directions for a random vector, or,
    for a vector with fewer than ``fewest`` directions over it, its own: that of
    about its ``fewest`` best, found among its best code vectors of each
    stretch. Near vectors have near thresholds, so their lists overlap.
    """
    dimension = vectors.shape[1]
    parts = code(dimension, size)
    spread = (sum(1.0 for _ in parts) / dimension) ** 0.5
    share = min(0.5, caps / size ** len(parts))
    level = NormalDist().inv_cdf(1 - share) * spread
    rows, filters = [], []
    turned = vectors @ rotation(dimension)
    bounds = np.cumsum([0, *(part.shape[1] for part in parts)])
    for start in range(0, len(turned), _ROWS_AT_ONCE):
        chunk = turned[start : start + _ROWS_AT_ONCE]
        sums = [chunk[:, a:b] @ part.T for a, b, part in zip(bounds[:-1], bounds[1:], parts, strict=True)]
        best = [s.max(axis=1) for s in sums]
        tops = [-np.partition(-s, min(_TOP, size) - 1, axis=1)[:, :_TOP] for s in sums]
        totals = tops[0]
        for top in tops[1:]:
            totals = (totals[:, :, None] + top[:, None, :]).reshape(len(chunk), -1)
        at = min(fewest, totals.shape[1]) - 1
        need = np.minimum(level, -np.partition(-totals, at, axis=1)[:, at] - 1e-12)
        row, total, name = np.arange(len(chunk)), np.zeros(len(chunk)), np.zeros(len(chunk), np.int64)
        for at, own in enumerate(sums):
            rest = sum((best[k] for k in range(at + 1, len(sums))), np.zeros(len(chunk)))
            grown = total[:, None] + own[row]
            keep, letter = (grown >= (need - rest)[row][:, None]).nonzero()
            row, total, name = row[keep], grown[keep, letter], name[keep] * size + letter
        rows.append(row + start)
        filters.append(name)
    return np.concatenate(rows), np.concatenate(filters)


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _name(label: Column, vector: Column) -> Column:
    """Name of a label and a vector's content."""
    numbers = F.transform(vector, lambda x: (x + F.lit(0.0)).cast("string"))
    return F.md5(F.concat_ws(",", label.cast("string"), numbers))


def _unit(vectors) -> np.ndarray:
    stacked = np.stack(list(vectors)).astype(np.float64)
    stacked /= np.abs(stacked).max(axis=1, keepdims=True)
    return stacked / np.sqrt((stacked**2).sum(axis=1, keepdims=True))


def code_size(n: int) -> int:
    """Code vectors per stretch, so that caps grow in number as the largest group does."""
    return max(12, int(np.ceil((CAPS_PER_VECTOR * n) ** (1 / PARTS))))


def links(nodes: DataFrame, least: float = LEAST, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Links between different vectors of ``nodes`` (``node``, ``group``, ``vector``, ``copies``).

    Two tables: edges ``a``, ``b`` that connect all that is linked, and
    ``node``, ``n``: how many vectors, copies included, each is linked with.
    Every pair that shares a cap is compared in double precision, and counted
    in the first cap that it shares.
    """
    largest = nodes.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    size = code_size(largest)
    number = "int" if size**PARTS < 1 << 31 else "long"
    kind = nodes.schema["vector"].dataType.simpleString()

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, same in batch.groupby(batch["vector"].map(len)):
                for start in range(0, len(same), 1000):
                    part = same.iloc[start : start + 1000]
                    row, name = decode(_unit(part["vector"]), size)
                    cuts = np.searchsorted(row, np.arange(len(part) + 1))
                    name = name.astype(np.int32 if number == "int" else np.int64)
                    own = [name[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    out = part.iloc[row].reset_index(drop=True)
                    out["cap"] = name
                    out["caps"] = [own[r] for r in row]
                    yield out

    keyed = nodes.mapInPandas(
        expand,
        f"node string, group string, vector {kind}, copies long, cap {number}, caps array<{number}>",
    ).withColumn("key", F.concat_ws(":", "group", "cap"))

    def compare(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
        unit = _unit(rows["vector"])
        near = unit @ unit.T >= least
        np.fill_diagonal(near, False)
        mine, other = rows["_c"] == rows["_i"][0], rows["_c"] == rows["_j"][0]
        near &= (mine[:, None] & other[None, :]) | (other[:, None] & mine[None, :])
        at = near.any(axis=1).nonzero()[0]
        if not len(at):
            return None
        near = near[np.ix_(at, at)]
        first = local_links(near)
        cap = rows["cap"][0]
        before = [caps[caps < cap] for caps in rows["caps"][at]]
        names, inverse = np.unique(np.concatenate(before), return_inverse=True)
        if len(names):
            held = np.zeros((len(at), len(names)), np.float32)
            held[np.repeat(np.arange(len(at)), [len(b) for b in before]), inverse] = 1
            near &= held @ held.T < 0.5
        found = near @ rows["copies"][at].astype(np.float64)
        return {
            "a": rows["node"][at],
            "b": rows["node"][at][first],
            "n": found.astype(np.int64),
        }

    dealt = in_blocks(keyed, "key", F.col("node"), block)
    met = stored(by_runs(dealt, ["key", "_i", "_j"], compare, "a string, b string, n long"), "met")
    edges = met.select("a", "b").where("a <> b").distinct()
    return edges, met.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = LEAST,
) -> DataFrame:
    """One row for every row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``.

    Vectors of one label are linked if their cosine is ``least`` or more.
    ``component_id`` is the smallest id reachable over links, the own included;
    ``kept`` marks the rows that have it. Equal vectors are compared once, with
    the number of their copies. All pairs that share a cap are compared; the
    share of links found is measured against brute force in the tests.

    A null label, and a vector that is null, empty, all zero or has a null or
    non-finite component, links with nothing: 0 links, its own id. Vectors of
    different length are never linked. Rows of one id are vectors of their own;
    null ids come last when the smallest is sought.
    """
    kind = vectors.schema[vector_col].dataType
    given = F.col(vector_col)
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).cast("string").alias("label"),
        (given if kind.simpleString() == "array<float>" else given.cast("array<double>")).alias("vector"),
    )
    fit = usable(F.col("vector")) & F.col("label").isNotNull()
    named = stored(
        rows.withColumn("node", F.when(fit, _name(F.col("label"), F.col("vector")))), "vectors"
    )
    group = F.concat_ws("/", F.size("vector").cast("string"), F.col("label"))
    nodes = stored(
        named.where("node IS NOT NULL")
        .groupBy("node", group.alias("group"), "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id")),
        "nodes",
    )
    edges, counts = links(nodes.select("node", "group", "vector", "copies"), least)
    found = components(edges).withColumnRenamed("node", "_node")
    rooted = stored(
        nodes.join(found, F.col("node") == F.col("_node"), "left")
        .join(counts, "node", "left")
        .select(
            "node",
            "id",
            F.coalesce("component", "node").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "roots",
    )
    firsts = stored(rooted.groupBy("root").agg(F.min("id").alias("first_id")), "firsts")
    linked = stored(rooted.join(firsts, "root").select("node", "n_links", "first_id"), "linked")
    loose = named.where("node IS NULL").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    met = named.where("node IS NOT NULL").join(linked, "node").select(
        "id", "n_links", F.col("first_id").alias("component_id")
    )
    out = met.unionByName(loose)
    return out.select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
