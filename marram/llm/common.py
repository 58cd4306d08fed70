"""What several operators share: stored tables, graph components, bounded buckets."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tasks get this package's functions with the job, so it need not be installed
# on the executors. What is broadcast must be plain data.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Fixed patterns: white space separates tokens; words are letters, digits and
# everything beyond ASCII, after A-Z have been lowered.
TOKEN = "[^\\x20\\x09-\\x0D]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    That of ``spark.checkpoint.dir``. Where it is unset, a local session gets a
    temporary folder and a cluster a folder in the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        local = context.master.startswith("local") and not context.master.startswith("local-")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(
            tempfile.mkdtemp(prefix="marram-") if local else f"{warehouse}/_work"
        )
    return context.getCheckpointDir()


# Paths of the tables stored within each ``work_tables`` that is open, the innermost last.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def stored(frame: DataFrame, name: str, lasts: bool = False) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    Cuts lineage in a way that outlives executors, and lets later joins deal
    its rows out themselves, so that adaptive execution can split hot keys.
    Within ``work_tables`` a table that ``lasts`` outlives the innermost one.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN.get()[: -1 if lasts else None][-1:]:
        paths.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored while it lasts are deleted at its end, but for those that are to last longer.

    What goes on from within must be read from tables that last.
    """
    paths: list[str] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While it lasts, at most ``rows`` rows go to Python at once.

    For steps that hand over whole texts and are stored within; Spark's 10,000
    rows take memory of tasks and of Python workers by the size of the texts.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    now = 0 if before is None else int(before)
    spark.conf.set(key, min(now, rows) if now > 0 else rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def whole_row(frame: DataFrame, *without: str) -> Column:
    """All columns of ``frame`` but those named, as one struct, so that no working column can clash with them."""
    names = frame.drop(*without).columns
    return F.struct(*[F.col("`" + name.replace("`", "``") + "`") for name in names])


def lower_ascii(text: Column) -> Column:
    """A-Z lowered, all else as it is; a text of ASCII alone takes the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Words of a text in order; null has none."""
    lowered = lower_ascii(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def count_tokens(text: Column) -> Column:
    """Number of tokens between white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5: the fold of a document. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: columns ``node``, ``component``.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Labels spread
    over edges and then jump to their label's label, so the number of rounds
    grows with the logarithm of the longest path. Both tables are stored in
    every round; a hub's edges are left to the adaptive skew join.
    """
    both = stored(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
        "labels",
    )
    while True:
        offers = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("offer"))
        )
        spread = stored(
            labels.join(offers, "node").select(
                "node", F.least("label", "offer").alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        roots = spread.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = stored(spread.join(roots, "label").select("node", "root", "old"), "labels")
        changed = jumped.where("root <> old").limit(1).count()
        labels = jumped.select("node", F.col("root").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")


def in_blocks(rows: DataFrame, key: str, salt: Column, block: int) -> DataFrame:
    """Rows of every key with two rows or more, dealt into blocks of bounded size.

    A key of ``n`` rows is cut into ``ceil(n / block)`` chunks by ``salt``, and
    each row goes to every pair of chunks that has its own: columns ``_i`` and
    ``_j``, its own in ``_c``. Any two rows of a key meet in at least one
    block, those of different chunks in exactly one.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    busy = stored(
        counts.select(key, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_parts")), "busy"
    )
    chunk = F.pmod(F.xxhash64(salt), F.col("_parts")).cast("int")
    dealt = rows.join(busy, key).withColumn("_c", chunk)
    others = F.sequence(F.lit(0), F.col("_parts") - 1)
    dealt = dealt.withColumn("_o", F.explode(others)).drop("_parts")
    return dealt.withColumns({"_i": F.least("_c", "_o"), "_j": F.greatest("_c", "_o")}).drop("_o")


def by_runs(
    rows: DataFrame,
    keys: list[str],
    function: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray] | None],
    schema: str,
) -> DataFrame:
    """``function`` over the columns of each key's rows, for very many small groups.

    Rows are dealt out and sorted by key; groups are runs in a task's batches,
    the last of a batch waits for the next. A group must be bounded; groups of
    one row are left out.
    """

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            if len(batch):
                starts = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
                yield from done(batch, starts)
                rest = batch.iloc[starts[-1] :]
        if rest is not None:
            yield from done(rest, [0, len(rest)])

    def done(batch: pd.DataFrame, starts) -> Iterator[pd.DataFrame]:
        arrays = {name: batch[name].to_numpy() for name in batch.columns}
        out = []
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            if end - start > 1:
                found = function({name: values[start:end] for name, values in arrays.items()})
                if found is not None:
                    out.append(pd.DataFrame(found))
        if out:
            yield pd.concat(out, ignore_index=True)

    dealt = rows.repartition(*[F.col(key) for key in keys]).sortWithinPartitions(*keys)
    return dealt.mapInPandas(runs, schema)


def local_links(near: np.ndarray) -> np.ndarray:
    """First member of each row's connected part, by a symmetric matrix of links."""
    first = np.full(len(near), -1)
    for start in range(len(near)):
        if first[start] < 0:
            part = new = near[start].copy()
            part[start] = True
            while new.any():
                new = near[new.nonzero()[0]].any(axis=0) & ~part
                part |= new
            first[part] = start
    return first
