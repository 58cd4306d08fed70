"""SimHash near-duplicates found with Golay-code fuzzy hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm import similar
from marram.llm.common import by_runs, components, in_blocks, local_links, small_batches, stored, whole_row, work_tables

SEED = 42
SHINGLE = 3
MOST_BITS = 2
BLOCK = 1024
# Segments of a fingerprint, as (shift, bits).
SEGMENTS = ((42, 22), (21, 21), (0, 21))
# Fixed: generator polynomial of the binary Golay code of length 23.
GENERATOR, LENGTH, CHECK_BITS = 0xC75, 23, 11
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text in UTF-8; 0 if it has no words.

    Bytes are lowered in A-Z only, and split at ASCII white space.
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    shifted = [tokens[i:] for i in range(size)] if len(tokens) >= size else [[t] for t in tokens]
    ones = np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*shifted, strict=False))
    total = len(shifted[-1])
    for _ in range(0, total, _HASHES_AT_ONCE):
        part = [xxhash.xxh64_intdigest(s, SEED) for s in islice(shingles, _HASHES_AT_ONCE)]
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the fingerprint of each text as a bigint."""

    @F.pandas_udf("bigint")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.fromiter((fingerprint(text) for text in batch), np.uint64, len(batch))
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(name, prints(F.col(text_col).cast("binary")))


def _syndrome(value: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - CHECK_BITS)
    return value


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of single bits, and for each syndrome the error patterns of weight up to 4 (-1: none).

    Words at distance 2 have a word between them, and every word has a codeword
    within 3; so their lists of codewords within 4 have one in common.
    """
    single = np.array([_syndrome(1 << bit) for bit in range(LENGTH)])
    lists: list[list[int]] = [[] for _ in range(1 << CHECK_BITS)]
    for weight in range(5):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= int(single[bit])
            lists[syndrome].append(sum(1 << bit for bit in bits))
    patterns = np.full((len(lists), max(map(len, lists))), -1, np.int64)
    for row, found in zip(patterns, lists, strict=True):
        row[: len(found)] = found
    return single, patterns


def codeword_indices(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each 23-bit word the indices of the codewords within distance 4; -1 fills rows up."""
    single, patterns = tables
    syndromes = np.zeros(len(words), np.int64)
    for bit in range(LENGTH):
        syndromes ^= np.where(words >> bit & 1, single[bit], 0)
    errors = patterns[syndromes]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> CHECK_BITS)


def keys_of(prints: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints: (place of the fingerprint, key).

    With at most two errors, one of three segments has none, and the next one
    has at most two: a key is the first as it is and a codeword near the second.
    """
    values = prints.view(np.uint64)
    parts = [(values >> np.uint64(s)).astype(np.int64) & ((1 << bits) - 1) for s, bits in SEGMENTS]
    places, keys = [], []
    for at, exact in enumerate(parts):
        near = codeword_indices(parts[(at + 1) % len(parts)], tables)
        place, column = (near >= 0).nonzero()
        places.append(place)
        keys.append(at << 34 | exact[place] << 12 | near[place, column])
    return np.concatenate(places), np.concatenate(keys)


def links(prints: DataFrame, most_bits: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints ``fp`` that connect all that differ in at most two bits.

    Within a block of a key's fingerprints every pair is compared, and a tree
    over each of the block's connected parts is given instead of all its pairs.
    """
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"at most {MOST_BITS} differing bits are found")

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = golay_tables()
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            places, keys = keys_of(values, tables)
            yield pd.DataFrame({"key": keys, "fp": values[places]})

    def compare(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray] | None:
        values = rows["fp"].view(np.uint64)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= most_bits
        first = local_links(near)
        linked = (first != np.arange(len(first))).nonzero()[0]
        return {"a": rows["fp"][linked], "b": rows["fp"][first[linked]]} if len(linked) else None

    keyed = prints.mapInPandas(expand, "key long, fp long")
    dealt = in_blocks(keyed, "key", F.col("fp"), block)
    return by_runs(dealt, ["key", "_i", "_j"], compare, "a long, b long").distinct()


def groups(docs: DataFrame, id_col: str = "doc_id", name: str = "fp") -> DataFrame:
    """Groups of fingerprints, stored: ``fp``, ``root`` (one per group) and ``first_id``, the group's smallest id."""
    prints = docs.select(F.col(id_col).alias("id"), F.col(name).alias("fp"))
    each = stored(prints.groupBy("fp").agg(F.min("id").alias("id")), "prints")
    found = components(links(each.select("fp")))
    rooted = stored(
        each.join(found, F.col("fp") == F.col("node"), "left").select(
            "fp", "id", F.coalesce("component", "fp").alias("root")
        ),
        "roots",
    )
    firsts = rooted.groupBy("root").agg(F.min("id").alias("first_id"))
    return stored(rooted.select("fp", "root").join(stored(firsts, "firsts"), "root"), "groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: id, ``fp`` and ``component_id``.

    ``component_id`` is the smallest id of the documents reachable over links,
    its own included; a link joins documents whose fingerprints differ in at
    most two bits. All links count: none is lost, however many fingerprints
    share a key and however many documents a fingerprint.

    Null and empty texts have fingerprint 0 and are linked like others. A null
    id is never the smallest unless a group has no other. Rows of one id are
    judged each by its own text. An empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = stored(with_fingerprints(slim, "text", "fp").drop("text"), "fingerprints")
    found = groups(prints, "id").select("fp", F.col("first_id").alias("component_id"))
    return prints.join(found, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex_digits(print_col: str) -> Column:
    return F.lower(F.lpad(F.hex(print_col), 16, "0"))


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``keys_of`` with tables of its own."""
    return keys_of(prints, golay_tables())


def rooted_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node``, ``id`` and ``root`` (one per connected part) of ``nodes``, stored."""
    with work_tables(nodes.sparkSession):
        found = components(edges).withColumnRenamed("node", "linked")
        root = F.coalesce("component", "node").alias("root")
        rooted = nodes.join(found, F.col("node") == F.col("linked"), "left").select("node", "id", root)
        return stored(rooted, "roots", lasts=True)


def stays(texts: DataFrame, least: float = similar.LEAST) -> DataFrame:
    """Of ``texts`` (``key`` of ``id`` and ``same``, ``text``) the keys to keep, as ``kept``, and how many rows have each, ``n``.

    One of each group of similar texts, of those with its smallest id; read from stored tables.
    """
    with small_batches(texts.sparkSession):
        prints = stored(similar.with_sketches(texts, "text", least).withColumn("id", F.col("key.id")), "prints")
    # What a set has is the same in each of its rows; equal texts are one row from here on.
    told = [F.first(name).alias(name) for name in ("fp", "b0", "b1", "bands", "size", "firsts", "odd")]
    nodes = stored(prints.groupBy("node").agg(F.min("id").alias("id"), F.min("key").alias("key"), *told), "nodes")
    near = similar.links(nodes, texts, golay_keys, least)
    missed = similar.missed(nodes, nodes, rooted_nodes(nodes, near), texts, least)
    rooted = rooted_nodes(nodes, near.union(missed))
    firsts = stored(rooted.groupBy("root").agg(F.min("id").alias("first_id")), "firsts")
    grouped = rooted.select("node", "root").join(firsts, "root")
    first = prints.select("key", "id", "node").join(grouped, "node").where(F.col("id").eqNullSafe(F.col("first_id")))
    stay = first.groupBy("root").agg(F.min("key").alias("key")).select("key", F.lit(True).alias("stays"))
    times = prints.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return times.join(stay, "key").select(F.col("key").alias("kept"), "n")


def first_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = similar.LEAST
) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest id, of equal rows one.

    Documents are linked if their sets of shingles of five words have a Jaccard
    similarity of ``least`` or more. Candidates meet by the Golay keys of their
    fingerprints, which find those at most two bits apart, and by bands of
    ordered hashes, which find those further apart; links are verified over
    whole texts. Then all pairs of different groups that may be similar enough are verified
    too, so no link is lost. Groups are settled over names of sets; texts move only
    where they are in a candidate.

    Null and empty texts have no shingles and are one group. A null id is
    kept only where a group has no other. All columns stay as they are, whatever
    their names; an empty table gives no rows.
    """
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"))
    keyed = docs.select(whole_row(docs).alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    # One row per key that stays; rows move once, joined without a broadcast, as this table grows with the documents.
    with work_tables(docs.sparkSession):
        told = stored(stays(keyed.select("key", "text"), least), "stay", lasts=True).hint("merge")
    met = keyed.select("row", "key").join(told, F.col("key").eqNullSafe(F.col("kept")))
    one = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    single = met.where("n = 1").select("row.*")
    return single.union(met.where("n > 1").withColumn("at", one).where("at = 1").select("row.*"))
