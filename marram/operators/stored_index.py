"""The inverted index in stored form: a front-coded dictionary of words and blocks of postings.

A word is a number in the blocks and stands in the dictionary once, as the part
that it does not share with the word before. A block has the postings of one
word in a stretch of documents and lines, with its first and last place beside
it, so that a lookup reads one block of the dictionary and only the blocks of
its word and range.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.operators.packed import COLUMNS, in_order, pack, starts_of, together, unpack
from marram.operators.skew import SHARES, lookup_join

# Tasks get these functions with the job, so the package need not be installed on the executors.
for _module in (__name__, pack.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

# About so many postings a block, lines a block at most (two to the power), words in a block of the dictionary.
POSTINGS_PER_BLOCK = 128
LINE_BITS = 16
# Postings in a row of the work table at most.
POSTINGS_PER_ROW = 4_096
WORDS_PER_BLOCK = 64
# A word's number is its part of the order, shifted by this, and its place there.
PART_BITS = 40
# No more of a word than this is left to the word before it.
LONGEST_SHARED = 32

# Version 2 pages store ascending numbers as their differences.
_WRITE = {"compression": "zstd", "parquet.writer.version": "v2"}


@dataclass(frozen=True)
class StoredIndex:
    """``dictionary`` of blocks of words and ``blocks`` of postings."""

    dictionary: DataFrame
    blocks: DataFrame


@contextmanager
def _shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """While it lasts, Spark deletes the shuffle files of a table when it has been written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written to ``path`` and read back."""
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _deleted(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _gathered(rows: DataFrame) -> DataFrame:
    """Postings of a word that a task reads together, as a row of bytes: ``word, holes, n_lines, n, first_doc, last_doc, coded``."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The more there are together, the fewer rows a word has.
        for table in together(batches, times=2):
            words = table.column("word").combine_chunks().dictionary_encode("encode")
            columns = [table.column(name).combine_chunks() for name in COLUMNS]
            missing = [each.is_null().to_numpy(zero_copy_only=False) for each in columns]
            values = [each.fill_null(0).to_numpy() for each in columns]
            del table, columns
            holes = sum(each.astype(np.int64) << at for at, each in enumerate(missing))
            group = words.indices.to_numpy().astype(np.int64) << len(values) | holes
            order = in_order(group, values)
            group, values = group[order], [each[order] for each in values]
            starts = starts_of(group)
            # A word's postings are not more than so many in a row, so that rows can be dealt out evenly.
            within = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
            starts = (within % POSTINGS_PER_ROW == 0).nonzero()[0]
            sizes = np.diff(np.append(starts, len(group)))
            own = group[starts]
            n = pa.array(_sums(values[3], starts), mask=own >> 3 & 1 == 1)
            first, last = values[0][starts], values[0][starts + sizes - 1]
            found = [words.dictionary.take(pa.array(own >> len(values))), pa.array(own & 15), pa.array(sizes), n]
            found += [pa.array(each, mask=own & 1 == 1) for each in (first, last)]
            yield pa.RecordBatch.from_arrays([*found, pack(values, starts)], names)

    names = ["word", "holes", "n_lines", "n", "first_doc", "last_doc", "coded"]
    schema = "word string, holes bigint, n_lines bigint, n bigint, first_doc bigint, last_doc bigint, coded binary"
    wide = rows.select("word", *[F.col(name).cast("bigint").alias(name) for name in COLUMNS])
    return wide.mapInArrow(gathered, schema)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if np.abs(values.astype(float)).sum() >= 2.0**62:
        raise OverflowError("the counts of a task's postings add up to more than 64 bits")
    return np.add.reduceat(values, starts)


def _shared(word: str | None, before: str | None) -> int:
    """How many first characters two words share, up to ``LONGEST_SHARED``."""
    if word is None or before is None:
        return 0
    most = min(len(word), len(before), LONGEST_SHARED)
    if word[:most] == before[:most]:
        return most
    return next(at for at in range(most) if word[at] != before[at])


def _text(word: bytes | None) -> str | None:
    """A word as text; one that is no UTF-8 shares nothing with others."""
    try:
        return None if word is None else word.decode()
    except UnicodeDecodeError:
        return None


def _dictionary(rows: DataFrame) -> DataFrame:
    """Blocks of words in order: ``first_word, last_word, word_id`` of the first, ``shared``, ``rest``, ``n_lines``, ``n``.

    ``rows`` are ``_gathered``. Words are dealt out to parts by ranges, and are numbered within their part.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            whole = held.num_rows // WORDS_PER_BLOCK * WORDS_PER_BLOCK
            if whole:
                yield blocks(held.slice(0, whole), place)
                place, held = place + whole, held.slice(whole)
        if held is not None and held.num_rows:
            yield blocks(held, place)

    def blocks(table: pa.Table, place: int) -> pa.RecordBatch:
        word = table.column("word").combine_chunks()
        said = [_text(each) for each in word.cast(pa.binary()).to_pylist()]
        shared = [_shared(one, before) if at % WORDS_PER_BLOCK else 0 for at, (one, before) in enumerate(zip(said, [None, *said]))]
        raw = word.cast(pa.binary()).to_pylist()
        rest = [each if not n else one[n:].encode() for each, one, n in zip(raw, said, shared, strict=False)]
        starts = np.arange(0, len(said), WORDS_PER_BLOCK)
        offsets = pa.array(np.append(starts, len(said)).astype(np.int32))
        part = table.column("part")[0].as_py()
        lists = [pa.array(shared, pa.int32()), pa.array(rest, pa.binary()).view(pa.string())]
        lists += [table.column(name).combine_chunks() for name in ("n_lines", "n")]
        found = [word.take(pa.array(starts)), word.take(pa.array(np.append(starts[1:], len(said)) - 1))]
        found += [pa.array((part << PART_BITS) + place + starts)]
        found += [pa.ListArray.from_arrays(offsets, each) for each in lists]
        return pa.RecordBatch.from_arrays(found, names)

    names = ["first_word", "last_word", "word_id", "shared", "rest", "n_lines", "n"]
    schema = "first_word string, last_word string, word_id bigint, shared array<int>, rest array<string>, n_lines array<bigint>, n array<bigint>"
    totals = rows.groupBy("word").agg(F.sum("n_lines").alias("n_lines"), F.sum("n").alias("n"))
    ranged = totals.repartitionByRange("word").sortWithinPartitions("word")
    return ranged.withColumn("part", F.spark_partition_id()).mapInArrow(coded, schema)


def _often(dictionary: DataFrame, key: str) -> DataFrame:
    """Words with more than a thousandth of all postings, in the form that ``lookup_join`` wants; only their blocks are decoded."""
    total = dictionary.select(F.explode("n_lines").alias("n")).agg(F.sum("n").cast("double")).scalar()
    share = F.lit(float(SHARES)) / total
    words = words_of(dictionary.where(F.array_max("n_lines") * share > 1)).where(F.col("n_lines") * share > 1)
    return words.select(key, F.ceil(F.col("n_lines") * share).alias("_parts"))


_STRETCH = ["word_id", "stretch", "lines", "holes"]


def _cut(rows: DataFrame) -> DataFrame:
    """``_gathered`` rows with ``word_id`` and ``bits``, cut into stretches: ``word_id, stretch, lines, holes, n_lines, first_doc, coded``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in together(batches, "n_lines"):
            word_id, bits, holes, values = _unpacked(table, "word_id", "bits", "holes")
            stretch = np.where(holes & 1, 0, values[0] >> bits)
            lines = np.where(holes & 2, 0, values[1] >> LINE_BITS)
            keys = [word_id, stretch, lines, holes]
            group = np.unique(word_id << 4 | holes, return_inverse=True)[1]
            # Documents are in the order of their stretches.
            order = in_order(group, values, *([stretch, lines] if lines.any() else []))
            keys, values = [each[order] for each in keys], [each[order] for each in values]
            starts = starts_of(*keys)
            found = [pa.array(each[starts]) for each in keys]
            found += [pa.array(np.diff(np.append(starts, len(order)))), pa.array(values[0][starts])]
            yield pa.RecordBatch.from_arrays([*found, pack(values, starts)], [*_STRETCH, "n_lines", "first_doc", "coded"])

    schema = "word_id bigint, stretch bigint, lines bigint, holes bigint, n_lines bigint, first_doc bigint, coded binary"
    wide = rows.select("word_id", F.col("bits").cast("bigint"), "holes", "n_lines", F.coalesce("first_doc", F.lit(0)).alias("first_doc"), "coded")
    return wide.mapInArrow(cut, schema)


def _unpacked(table: pa.Table, *names: str) -> list:
    """The columns ``names``, repeated for each posting, and the postings' columns."""
    sizes, first = (table.column(name).to_numpy() for name in ("n_lines", "first_doc"))
    values = unpack(table.column("coded").combine_chunks(), sizes, first)
    return [*[np.repeat(table.column(name).to_numpy(), sizes) for name in names], values]


def _blocks(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Blocks of postings from ``_cut`` rows in order; ``types`` are those of ``doc_id`` and ``pos``."""

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for table in together(batches, "n_lines"):
            table = table if rest is None else pa.concat_tables([rest, table])
            # The last block may go on in the next batch.
            start = int(starts_of(*[table.column(name).to_numpy() for name in _STRETCH])[-1])
            rest = table.slice(start)
            if start:
                yield blocks(table.slice(0, start))
        if rest is not None:
            yield blocks(rest)

    def blocks(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(name).to_numpy() for name in _STRETCH]
        at = np.zeros(table.num_rows, np.int64)
        at[starts_of(*keys)] = 1
        sizes = table.column("n_lines").to_numpy()
        group = np.repeat(at.cumsum(), sizes)
        *_, holes, values = _unpacked(table, "holes")
        order = in_order(group, values)
        group, holes, values = group[order], holes[order], [each[order] for each in values]
        starts = starts_of(group)
        ends = np.append(starts[1:], len(group))
        first = [np.repeat(each[starts], ends - starts) for each in values[:2]]
        offsets = pa.array(np.append(starts, len(group)).astype(np.int32))
        found = [pa.array(np.repeat(keys[0], sizes)[starts])]
        for place in (starts, ends - 1):
            found += [pa.array(each[place], mask=holes[place] >> k & 1 == 1) for k, each in enumerate(values[:2])]
        for k, each in enumerate([values[0] - first[0], values[1] - first[1], *values[2:]]):
            found.append(pa.ListArray.from_arrays(offsets, pa.array(each, mask=holes >> k & 1 == 1)))
        return pa.RecordBatch.from_arrays(found, names)

    names = ["word_id", "first_doc", "first_line", "last_doc", "last_line", "docs", "lines", "pos", "n"]
    schema = ", ".join(f"{name} {'array<bigint>' if at > 4 else 'bigint'}" for at, name in enumerate(names))
    found = rows.repartitionByRange(*_STRETCH).sortWithinPartitions(*_STRETCH).mapInArrow(finished, schema)
    own = {"first_doc": types["doc_id"], "last_doc": types["doc_id"], "docs": f"array<{types['doc_id']}>", "pos": f"array<{types['pos']}>"}
    return found.select(*[F.col(name).cast(own[name]).alias(name) if name in own else name for name in names])


def store(folder: str, rows: DataFrame, postings_per_block: int = POSTINGS_PER_BLOCK) -> StoredIndex:
    """Writes postings ``word, doc_id, line_id, pos, n`` to ``folder``, which must be new.

    There is one posting per word, document and line, as ``postings`` and
    ``merge_postings`` give them; ``n_lines`` and ``n`` of the dictionary are sums over them.
    A block's stretch of documents is a power of two wide, so that it has about
    ``postings_per_block`` postings if the word is spread evenly, and a stretch
    of lines is 65,536 wide. Of ``p`` postings in documents numbered over a span ``s``, none has
    more than ``min(p, s * postings_per_block / p)`` documents, whatever their places, so a
    frequent word is many blocks. An empty table gives an empty index.

    Numbers are integers. Postings are moved and kept as bytes (``packed``); tables that are needed on
    the way are deleted when the next one is written, and so are the files of shuffles.
    """
    spark = rows.sparkSession
    types = {name: rows.schema[name].dataType.simpleString() for name in ("doc_id", "pos")}
    with _shuffles_cleared(spark):
        # Postings are needed several times; they are made once.
        kept = _kept(_gathered(rows), f"{folder}/postings")
        # The parts are settled by storing them, so that a task that is run again finds the same ones.
        _dictionary(kept).write.options(**_WRITE).parquet(f"{folder}/dictionary")
        dictionary = spark.read.parquet(f"{folder}/dictionary")
        span = kept.agg((F.max("last_doc") - F.min("first_doc") + 1).cast("double")).scalar()
        width = F.log2(span * F.lit(float(postings_per_block)) / F.col("n_lines"))
        known = words_of(dictionary).select(
            "word", "word_id", F.least(F.lit(62), F.greatest(F.lit(0), F.floor(width))).cast("int").alias("bits")
        )
        moved = kept.select("word", "holes", "n_lines", "first_doc", "coded")
        cut = _kept(_cut(lookup_join(moved, known, "word", hot=_often(dictionary, "word"))), f"{folder}/cut")
        _deleted(spark, f"{folder}/postings")
        # Stored before they are dealt out, as ranges are told from a first pass.
        _blocks(cut, types).write.options(**_WRITE).parquet(f"{folder}/blocks")
        _deleted(spark, f"{folder}/cut")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> StoredIndex:
    return StoredIndex(*(spark.read.parquet(f"{folder}/{name}") for name in ("dictionary", "blocks")))


def words_of(dictionary: DataFrame) -> DataFrame:
    """``word, word_id, n_lines, n`` of blocks of the dictionary."""
    parts = F.arrays_zip("shared", "rest")
    word = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.array_append(
            done,
            F.concat(
                F.substr(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), F.lit(1), part["shared"]),
                part["rest"],
            ),
        ),
    )
    listed = dictionary.select("word_id", F.arrays_zip(word.alias("word"), "n_lines", "n").alias("w"))
    each = listed.select("word_id", F.posexplode("w").alias("at", "w"))
    return each.select("w.word", (F.col("word_id") + F.col("at")).alias("word_id"), "w.n_lines", "w.n")


def postings_of(blocks: DataFrame, *more: str) -> DataFrame:
    """``word_id, doc_id, line_id, pos, n`` of blocks of postings, and their columns ``more``."""
    each = blocks.select(
        *more, "word_id", "first_doc", "first_line", F.inline(F.arrays_zip("docs", "lines", "pos", "n"))
    )
    return each.select(
        *more,
        "word_id",
        (F.col("first_doc") + F.col("docs")).alias("doc_id"),
        (F.col("first_line") + F.col("lines")).alias("line_id"),
        "pos",
        "n",
    )


def all_postings(index: StoredIndex) -> DataFrame:
    """The postings that were stored."""
    words = words_of(index.dictionary).select("word", "word_id")
    # Blocks meet their word before they become postings; a frequent word's are many and are split.
    blocks = index.blocks.drop("last_doc", "last_line")
    met = lookup_join(blocks, words, "word_id", hot=_often(index.dictionary, "word_id"))
    found = postings_of(met, "word")
    return found.select("word", "doc_id", "line_id", "pos", "n")


def lookup(
    index: StoredIndex, word: str, first_doc: int | None = None, last_doc: int | None = None
) -> DataFrame:
    """Postings of one word, of documents from ``first_doc`` to ``last_doc`` if given.

    One row of the dictionary is read for the word's number, so that the number
    reaches the scan of the blocks, whose row groups are in its order.
    """
    held = index.dictionary.where((F.col("first_word") <= word) & (F.col("last_word") >= word))
    found = words_of(held).where(F.col("word") == word).first()
    blocks = index.blocks.where(F.col("word_id") == (found.word_id if found else -1))
    if first_doc is not None:
        blocks = blocks.where(F.col("last_doc") >= first_doc)
    if last_doc is not None:
        blocks = blocks.where(F.col("first_doc") <= last_doc)
    rows = postings_of(blocks).select(F.lit(word).alias("word"), "doc_id", "line_id", "pos", "n")
    least = F.lit(True) if first_doc is None else F.col("doc_id") >= first_doc
    most = F.lit(True) if last_doc is None else F.col("doc_id") <= last_doc
    return rows.where(least & most)
