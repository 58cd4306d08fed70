"""Documents whose sets of word shingles are alike: sketches, candidate links, exact verification.

A text's set holds the hashes of its shingles of five words (fewer words: the
whole sequence; none: nothing). Two texts are linked if the sets' Jaccard
similarity is 0.8 or more.

Links are found in two steps. Sketches bring near copies together quickly, and
their cheapest links are verified. Then every pair of sets that is not yet in
one group and could be similar enough is verified as well: similar sets share
one of the first members in any order, so none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.llm.common import by_runs, in_blocks, small_batches, stored, work_tables

SEED = 42
WORDS = 5
LEAST = 0.8
# A sketch has one bit for each of 128 random orders of the hashes; sets of Jaccard
# 0.8 differ in 12.8 of them, give or take 3.4, so pairs over 26 are not verified.
ORDERS = 128
MOST_BITS = 26
# Two sets of Jaccard 0.8 have no band in common in 0.488 ** 12 = 0.02 % of cases.
BANDS, BAND_ROWS = 12, 3
BLOCK = 1024
# A key of the exact step with more sets than this moves to the end of the order, if
# there are not more such keys than a broadcast can hold.
MOST_OF_KEY, MOST_KEYS = 128, 1 << 20
# Parities a set has at least; larger sets have more, a power of two.
_PARITIES = 512
# Texts are fetched through a table of so many bits.
_FETCH_BITS = 1 << 22
# So many members of a set are taken at once, times so many factors: their products stay in a core's cache.
_AT_ONCE, _FACTORS_AT_ONCE = 1024, 16
# What the exact step has of each set.
_FACTS = ("node", "root", "size", "n_keys")
# A block is compared in strips of so many of its rows, whose matrices take a few MB.
STRIP = 256
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Distinct hashes of a text's shingles, in order. A-Z are lowered, words split at ASCII white space."""
    tokens = (text or b"").lower().split()
    words = np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(SEED)), np.uint64, len(tokens))
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    # A shingle's hash is made of its words' hashes, so that each word is hashed once.
    found = words[:n].copy()
    for at in range(1, size):
        found *= _MIX
        found += words[at : at + n]
    for shift in (32, 29):
        found ^= found >> np.uint64(shift)
        found *= _FINAL
    found ^= found >> np.uint64(32)
    found.sort()
    return found[np.append(True, found[1:] != found[:-1])]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets; that of two empty sets is 1."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def name_of(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def sketch(hashes: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Name of a set, its 64-bit majority fingerprint, the words of its bit sketch and its band keys."""
    ones = np.zeros(64, np.int64)
    least = np.full(ORDERS, np.iinfo(np.uint64).max, np.uint64)
    products = np.empty((_FACTORS_AT_ONCE, min(len(hashes), _AT_ONCE)), np.uint64)
    for start in range(0, len(hashes), _AT_ONCE):
        part = hashes[start : start + _AT_ONCE]
        ones += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.uint16)
        for at in range(0, ORDERS, _FACTORS_AT_ONCE):
            some = slice(at, at + _FACTORS_AT_ONCE)
            found = np.multiply(part, _FACTORS[some, None], out=products[:, : len(part)]).min(axis=1)
            np.minimum(least[some], found, out=least[some])
    print_ = int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")
    bits = np.packbits(np.bitwise_count(least) & 1).view(np.uint64)
    rows = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in rows.T:
        keys = (keys ^ column) * _MIX
        keys ^= keys >> np.uint64(29)
    return name_of(hashes), print_, bits, keys | np.uint64(1 << 63)


def first_members(hashes: np.ndarray, least: float = LEAST, late: np.ndarray | None = None) -> np.ndarray:
    """Keys (32 bits) of a set's first members: sets of similarity ``least`` or more share one.

    Similar sets share ``least`` of each one's members, so not all that they
    share can stand behind the first ``n - ceil(least * n) + 1``. The order is
    that of the hashes, with keys in ``late`` (sorted) behind all others.
    """
    keys = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
    if late is not None and len(late):
        at = np.minimum(np.searchsorted(late, keys), len(late) - 1)
        keys = keys[np.argsort(late[at] == keys, kind="stable")]
    n = len(keys)
    return np.unique(keys[: n - int(np.ceil(least * n - 1e-9)) + 1])


def parities(hashes: np.ndarray) -> bytes:
    """For each remainder of the hashes whether the set has an odd number of them.

    Two sets differ in at least as many members as these bits differ. There are
    about as many bits as members, so that they differ in far more of them where sets are unlike.
    """
    n = max(_PARITIES, 1 << (len(hashes) - 1).bit_length()) if len(hashes) else _PARITIES
    odd = np.bincount((hashes & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def differing(odd: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many bits the parities ``odd[a]`` and ``odd[b]`` differ, the longer ones folded."""
    lengths = np.array([len(each) for each in odd])
    shorter = np.minimum(lengths[a], lengths[b])
    far = np.zeros(len(a), np.int64)
    for length in np.unique(shorter):
        pairs = (shorter == length).nonzero()[0]
        ends, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        told = [np.bitwise_xor.reduce(np.frombuffer(odd[i], np.uint64).reshape(-1, length // 8)) for i in ends]
        left, right = at[: len(pairs)], at[len(pairs) :]
        for word in np.array(told).T:
            far[pairs] += np.bitwise_count(word[left] ^ word[right])
    return far


def with_sketches(docs: DataFrame, text_col: str, least: float = LEAST) -> DataFrame:
    """``docs`` with, instead of the text, what its set has for both steps.

    ``node`` (name of the set), ``fp``, ``b0``, ``b1`` and ``bands``; ``size``,
    ``firsts`` (keys of the first members) and ``odd`` (parities).
    """

    @F.pandas_udf("node long, fp long, b0 long, b1 long, bands array<long>, size long, firsts array<int>, odd binary")
    def told(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            sets = [shingles(text) for text in batch]
            found = [sketch(hashes) for hashes in sets]
            names = np.array([[f[0], f[1], *f[2]] for f in found], np.uint64).reshape(-1, 4).view(np.int64)
            out = pd.DataFrame(names, columns=["node", "fp", "b0", "b1"])
            out["bands"] = [f[3].view(np.int64) for f in found]
            out["size"] = np.array([len(hashes) for hashes in sets], np.int64)
            out["firsts"] = [first_members(hashes, least) for hashes in sets]
            out["odd"] = [parities(hashes) for hashes in sets]
            yield out

    sketched = docs.withColumn("sketch", told(F.col(text_col).cast("binary")))
    return sketched.drop(text_col).select("*", "sketch.*").drop("sketch")


def forest(cost: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a cheapest spanning forest over pairs that cost ``most`` or less."""
    n = len(cost)
    best, parent, left = cost[0].copy(), np.zeros(n, np.int64), np.ones(n, bool)
    a, b, at = [], [], 0
    for _ in range(n - 1):
        left[at] = False
        closer = cost[at] < best
        best[closer], parent[closer] = cost[at][closer], at
        rest = left.nonzero()[0]
        at = rest[best[rest].argmin()]
        if best[at] <= most:
            a.append(parent[at])
            b.append(at)
    return np.array(a, np.int64), np.array(b, np.int64)


def cheapest_edges(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
    """Edges of a cheapest forest over a block of ``node``, ``b0`` and ``b1``; of two chunks only those between them."""
    order = rows["node"].argsort()
    node, b0, b1, chunk = (rows[name][order] for name in ("node", "b0", "b1", "_c"))
    cost = np.zeros((len(node), len(node)), np.int16)
    cross = rows["_i"][0] != rows["_j"][0]
    for start in range(0, len(node), STRIP):
        one = slice(start, start + STRIP)
        for bits in (b0.view(np.uint64), b1.view(np.uint64)):
            cost[one] += np.bitwise_count(bits[one, None] ^ bits[None, :])
        if cross:
            cost[one][(chunk[one, None] == chunk[None, :]) & (cost[one] <= MOST_BITS)] = -1
    a, b = forest(cost, MOST_BITS)
    keep = chunk[a] != chunk[b] if cross else np.ones(len(a), bool)
    if not keep.any():
        return None
    a, b = node[a[keep]], node[b[keep]]
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def candidates(
    nodes: DataFrame, more_keys: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], block: int = BLOCK
) -> DataFrame:
    """Edges ``a``, ``b`` to verify between ``nodes`` (``node``, ``fp``, ``b0``, ``b1``, ``bands``).

    Nodes meet by their bands and by the keys that ``more_keys`` gives for
    fingerprints. Every pair of a key is compared by sketch, in blocks; of each
    block the edges of a cheapest forest are given, and of a block of two chunks
    only those between the chunks, as others come from each chunk's own block.
    """

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, keys = more_keys(batch["fp"].to_numpy(np.int64))
            bands = np.concatenate([*batch["bands"], np.zeros(0, np.int64)]).astype(np.int64)
            at = np.concatenate([places, np.repeat(np.arange(len(batch)), BANDS)])
            out = batch[["node", "b0", "b1"]].iloc[at].reset_index(drop=True)
            out["key"] = np.concatenate([keys, bands])
            yield out

    keyed = nodes.mapInPandas(expand, "node long, b0 long, b1 long, key long").select("key", "node", "b0", "b1")
    dealt = in_blocks(keyed, "key", F.col("node"), block)
    return by_runs(dealt, ["key", "_i", "_j"], cheapest_edges, "a long, b long").where("a <> b").distinct()


def verified(edges: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """Those ``edges`` whose texts (``node``, ``text``) have sets of similarity ``least`` or more."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(shingles(x), shingles(y)) >= least for x, y in zip(a, b, strict=True)], dtype=bool)

    def side(node: str, text: str) -> DataFrame:
        return texts.select(F.col("node").alias(node), F.col("text").cast("binary").alias(text))

    met = edges.join(side("a", "text_a"), "a").join(side("b", "text_b"), "b")
    return met.where(alike(F.col("text_a"), F.col("text_b"))).select("a", "b")


def links(nodes: DataFrame, texts: DataFrame, more_keys, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """Verified edges that connect ``nodes`` of similarity ``least`` or more.

    ``texts`` has ``key`` and ``text``, ``nodes`` the ``key`` of one text of each
    set. Only texts that are in an edge are moved. These edges settle most groups;
    links between two of them can be missing, see ``missed``.
    """
    edges = stored(candidates(nodes.select("node", "fp", "b0", "b1", "bands"), more_keys, block), "candidates")
    return checked(edges, nodes, texts, least)


def checked(edges: DataFrame, nodes: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """``verified`` edges, stored; texts of their ends are fetched."""
    with work_tables(edges.sparkSession):
        ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
        held = fetched(ends, nodes, texts)
        with small_batches(edges.sparkSession):
            return stored(verified(edges, held, least), "verified", lasts=True)


def fetched(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """One ``text`` for each ``node`` of ``wanted``, stored; ``nodes`` has the ``key`` of its text.

    A table of bits of fixed size tells which texts need not move to the join.
    """
    keys = stored(nodes.select("node", "key").join(wanted, "node"), "wanted")
    some = texts.where(possible(keys))
    return stored(some.join(keys, "key").select("node", "text").dropDuplicates(["node"]), "held")


def possible(keys: DataFrame) -> Column:
    """False only where ``key`` is not in ``keys``, by a table of bits of fixed size."""

    table = bits_of(keys)

    @F.pandas_udf("boolean")
    def in_table(places: pd.Series) -> pd.Series:
        return pd.Series(is_set(table, places))

    return in_table(place("key"))


def place(key: str) -> Column:
    """Place of a key in the table of bits."""
    return F.pmod(F.xxhash64(key), F.lit(_FETCH_BITS)).cast("int")


def bits_of(keys: DataFrame) -> np.ndarray:
    """The table of bits of each ``key`` in ``keys``, packed."""
    bits = np.zeros(_FETCH_BITS, bool)
    bits[keys.select(place("key").alias("place")).distinct().toPandas()["place"].to_numpy(np.int64)] = True
    return np.packbits(bits)


def is_set(table: np.ndarray, places: pd.Series) -> np.ndarray:
    at = places.to_numpy(np.int64)
    return (table[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def open_in_block(rows: dict[str, np.ndarray], least: float = LEAST) -> dict[str, np.ndarray] | None:
    """The pairs of ``open_pairs`` in one block; of two chunks only those between them."""
    node, root, size, chunk = (rows[name] for name in ("node", "root", "size", "_c"))
    cross = rows["_i"][0] != rows["_j"][0]
    found = []
    for start in range(0, len(node), STRIP):
        one = slice(start, start + STRIP)
        both = size[one, None] + size[None, :]
        most = both - 2 * np.ceil(least / (1 + least) * both - 1e-9).astype(np.int64)
        near = (root[one, None] != root[None, :]) & (node[one, None] < node[None, :])
        near &= np.minimum(size[one, None], size[None, :]) >= least * np.maximum(size[one, None], size[None, :]) - 1e-9
        if cross:
            near &= chunk[one, None] != chunk[None, :]
        a, b = near.nonzero()
        keep = differing(rows["odd"], a + start, b) <= most[a, b]
        found.append((node[a[keep] + start], node[b[keep]]))
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return {"a": a, "b": b} if len(a) else None


def open_pairs(rows: DataFrame, sets: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """Pairs ``a``, ``b`` of different ``root`` that share a ``key`` and may have similarity ``least`` or more.

    ``rows`` has ``key``, ``node`` and ``root``, ``sets`` a node's ``size`` and
    ``odd``. What is left out is certainly below: sizes too different, or more
    bits of the parities differ than members of similar sets can.
    """

    def compare(block: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
        return open_in_block(block, least)

    dealt = in_blocks(rows, "key", F.col("node"), block).join(sets, "node")
    return by_runs(dealt, ["key", "_i", "_j"], compare, "a long, b long").distinct()


def common_pairs(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs ``a``, ``b`` of different ``root`` that share so many keys that they may have similarity ``least`` or more.

    ``rows`` has ``key``, ``node``, ``root``, ``size`` and ``n_keys``, how many of the
    keys of the node's first members are among ``key`` if another set has them. Of two sets one has
    its last first member no later than the other. What both share up to there are
    first members of both, and what they share behind it is not more than the rest of this set.
    """
    low, high = (rows.select("key", *[F.col(name).alias(f"{name}_{side}") for name in _FACTS]) for side in "ab")
    both = F.col("size_a") + F.col("size_b")
    needed = F.ceil(F.lit(least / (1 + least)) * both - F.lit(1e-9))
    rest = F.greatest(F.col("size_a") - F.col("n_keys_a"), F.col("size_b") - F.col("n_keys_b"))
    alike = F.least("size_a", "size_b") >= F.lit(least) * F.greatest("size_a", "size_b") - F.lit(1e-9)
    met = low.join(high, "key").where("node_a < node_b and root_a <> root_b").where(alike)
    counted = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min(needed - rest).alias("needed")
    )
    return counted.where("n >= needed").select("a", "b")


def by_parities(pairs: DataFrame, prints: DataFrame, least: float = LEAST) -> DataFrame:
    """The ``pairs`` whose parities do not differ in more bits than those of similar sets can."""

    @F.pandas_udf("boolean")
    def near(size_a: pd.Series, odd_a: pd.Series, size_b: pd.Series, odd_b: pd.Series) -> pd.Series:
        both, places = (size_a + size_b).to_numpy(), np.arange(len(odd_a))
        most = both - 2 * np.ceil(least / (1 + least) * both - 1e-9).astype(np.int64)
        odd = np.concatenate([odd_a.to_numpy(), odd_b.to_numpy()])
        return pd.Series(differing(odd, places, places + len(places)) <= most)

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = prints.join(ends, "node", "left_semi").select("node", "size", "odd").dropDuplicates(["node"])
    sides = [sets.toDF(side, f"size_{side}", f"odd_{side}") for side in "ab"]
    met = pairs.join(sides[0], "a").join(sides[1], "b")
    return met.where(near("size_a", "odd_a", "size_b", "odd_b")).select("a", "b")


def shared_keys(keyed: DataFrame, facts: DataFrame) -> DataFrame:
    """Stored rows ``key``, ``n`` and those of ``facts``, of those keys that sets of two roots have; ``n`` sets have the key."""
    with work_tables(keyed.sparkSession):
        # Dealt out by key once, for the aggregate and for the join.
        dealt = keyed.where("key is not null").repartition("key")
        met = dealt.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low <> _high")
        rows = stored(dealt.join(met.select("key"), "key").distinct().join(facts, "node"), "met")
        held = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("_low"), F.max("root").alias("_high"))
        return stored(rows.join(held.where("_low <> _high").select("key", "n"), "key"), "shared", lasts=True)


def missed(
    prints: DataFrame, nodes: DataFrame, roots: DataFrame, texts: DataFrame, least: float = LEAST, block: int = BLOCK,
    most_of_key: int = MOST_OF_KEY,
) -> DataFrame:
    """All links between sets of different groups, stored: edges ``a``, ``b`` of similarity ``least`` or more.

    ``prints`` has ``node``, ``size``, ``firsts`` and ``odd`` of ``with_sketches``, once for each set if possible, ``roots`` the group
    (``root``) of each ``node`` so far. A pair of similar sets shares the key of
    a first member, whatever the order of members, so none is missed. Members of
    a passage that many texts have would bring all of these together; so frequent
    keys move to the end of the order, and the texts that had them among
    their first members take others instead. Where a text has no others, the
    key's pairs are compared in blocks all the same.
    """
    with work_tables(prints.sparkSession):
        firsts = prints.select("node", "size", "firsts")
        late = frequent_keys(firsts, most_of_key)
        if len(late):
            firsts = moved(prints, nodes, texts, late, least)
        shared = shared_keys(*keys_and_facts(firsts, roots))
        # A node's keys that too many have are compared by parities; they count as not compared otherwise.
        many = shared.where(F.col("n") > most_of_key)
        told = many.groupBy("node").agg(F.count(F.lit(1)).alias("n_many"))
        few = shared.where(F.col("n") <= most_of_key).join(told, "node", "left")
        few = few.withColumn("n_keys", F.col("n_keys") - F.coalesce("n_many", F.lit(0)))
        sets = prints.join(many.select("node").distinct(), "node", "left_semi").select("node", "size", "odd")
        blocks = open_pairs(many.select("key", "node", "root"), sets.dropDuplicates(["node"]), least, block)
        common = by_parities(stored(common_pairs(few, least), "common"), prints, least)
        pairs = stored(common.union(blocks).distinct(), "open")
        return stored(checked(pairs, nodes, texts, least), "missed", lasts=True)


def frequent_keys(firsts: DataFrame, most_of_key: int = MOST_OF_KEY) -> np.ndarray:
    """Keys of ``firsts`` with more than ``most_of_key`` sets, sorted; the ``MOST_KEYS`` most frequent ones.

    Which keys move decides only how much is compared, so no more is asked about them.
    """
    held = firsts.select(F.explode("firsts").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    often = held.where(F.col("n") > most_of_key).orderBy(F.desc("n"), "key").limit(MOST_KEYS)
    return np.sort(often.toPandas()["key"].to_numpy(np.int32))


def keys_and_facts(firsts: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``node``, ``size`` and ``firsts``: a row per ``node`` and ``key``, and a row per node with ``root``, ``size``, ``n_keys``."""
    keyed = firsts.select("node", F.explode("firsts").alias("key"))
    each = firsts.select("node", "size", F.size("firsts").alias("n_keys")).dropDuplicates(["node"])
    return keyed, stored(each.join(roots.select("node", "root"), "node").select(*_FACTS), "facts")


def moved(prints: DataFrame, nodes: DataFrame, texts: DataFrame, late: np.ndarray, least: float) -> DataFrame:
    """``node``, ``size`` and ``firsts`` in the order that has the keys ``late`` at its end, from a stored table.

    One text of each set that had such keys is read again where it stands; a few others
    that the table of bits lets through give what they had.
    """

    @F.pandas_udf("boolean")
    def affected(lists: pd.Series) -> pd.Series:
        return pd.Series(has_some(lists, late))

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(text) for text in batch["text"][is_set(table, batch["place"])]]
            names = np.array([name_of(hashes) for hashes in sets], np.uint64).view(np.int64)
            lists = [first_members(hashes, least, late) for hashes in sets]
            sizes = np.array([len(hashes) for hashes in sets], np.int64)
            yield pd.DataFrame({"node": names, "size": sizes, "firsts": lists})

    # Told once, as the lists go to Python for it.
    told = stored(prints.select("node", "size", "firsts", affected("firsts").alias("_late")), "told")
    wanted = nodes.select("node", "key").join(told.where("_late").select("node").distinct(), "node", "left_semi")
    table = bits_of(stored(wanted.select("key"), "wanted"))
    with small_batches(prints.sparkSession):
        # The table is read where the sets are made: two steps in Python need two workers for each task.
        placed = texts.select(place("key").alias("place"), F.col("text").cast("binary").alias("text"))
        new = stored(placed.mapInPandas(others, "node long, size long, firsts array<int>"), "moved")
    return told.where("not _late").select("node", "size", "firsts").union(new)


def has_some(lists: pd.Series, late: np.ndarray) -> np.ndarray:
    """For each of the ``lists`` whether it has a key of ``late`` (sorted); all are looked up at once."""
    lengths = np.array([len(keys) for keys in lists], np.int64)
    keys = np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int32)
    found = late[np.minimum(np.searchsorted(late, keys), len(late) - 1)] == keys
    return np.bincount(np.repeat(np.arange(len(lengths)), lengths), found, len(lengths)) > 0
