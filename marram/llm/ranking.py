"""Ranked lexical search: item vocabulary tiles times document impact tiles, as dense matrix products."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.common import stored

TOP = 20
# Rows, inner columns and columns of a product at most.
ITEM_TILE, TERM_TILE, DOC_TILE = 256, 2048, 512
# Bytes of item texts that tasks hold at once, about; more items take more passes.
BLOCK_BYTES = 1 << 24
# Fixed: an impact is a whole number below this, and so is a sum of impacts
# times factors below 2^53 if the factors of an item add up to no more than LIMIT.
IMPACT = 10**6
LIMIT = (1 << 53) // IMPACT - 1
# Top lists of one item meet in so many parts before they meet in one.
PARTS = 64
# Digits, letters and all beyond ASCII are kept, A-Z lowered; anything else separates.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order, with repeats; null has none."""
    return (text or b"").translate(_KEPT).split()


@dataclass
class Block:
    """A bounded part of the items: ids, and per entry the item's place, the term's place and its repeats."""

    ids: pa.Array
    item: np.ndarray
    term: np.ndarray
    repeats: np.ndarray


def blocks(items: DataFrame, most_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Block, dict[bytes, int]]]:
    """Items (columns ``item``, ``text``) in parts of about so many bytes, each with its vocabulary."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-total // most_bytes))
    for part in range(parts):
        chosen = F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part
        found = items.where(chosen).select("item", F.col("text").cast("binary")).toArrow()
        place: dict[bytes, int] = {}
        entries = []
        for at, text in enumerate(found["text"].to_pylist()):
            for term, n in Counter(terms(text)).items():
                entries.append((at, place.setdefault(term, len(place)), n))
        item, term, repeats = np.array(entries, np.int64).reshape(-1, 3).T
        yield Block(found["item"].combine_chunks(), item, term, repeats), place


def matched_terms(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """Every row of ``docs`` (``doc``, ``text``), stored: ``doc``, ``n`` terms, and ``ids`` and ``tf`` of known ones."""
    known = docs.sparkSession.sparkContext.broadcast(place)
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, n long, ids array<int>, tf array<int>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for batch in batches:
            sizes, ids, tfs, ends = [], [], [], [0]
            for value in batch["text"]:
                found = terms(value.as_py())
                sizes.append(len(found))
                for term, n in Counter(found).items():
                    at = find(term)
                    if at is not None:
                        ids.append(at)
                        tfs.append(n)
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(sizes, pa.int64()), *lists], ["doc", "n", "ids", "tf"]
            )

    return stored(docs.select("doc", F.col("text").cast("binary")).mapInArrow(count, schema), "matched")


def term_tiles(
    item: np.ndarray, term: np.ndarray, factor: np.ndarray, limit: int = LIMIT
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Entries cut into tiles of columns: ``columns`` (terms), item, column and factor of each entry.

    No item's factors in a tile add up to more than ``limit``. A larger factor
    is the sum of those of several tiles.
    """
    while len(item):
        yield from _halved(item, term, np.minimum(factor, limit), limit)
        left = factor > limit
        item, term, factor = item[left], term[left], factor[left] - limit


def _halved(item, term, factor, limit):
    columns = np.unique(term)
    heavy = np.bincount(item, factor).max() > limit
    if len(columns) > TERM_TILE or (heavy and len(columns) > 1):
        low = term < columns[len(columns) // 2]
        for side in (low, ~low):
            yield from _halved(item[side], term[side], factor[side], limit)
    else:
        yield columns, item, np.searchsorted(columns, term), factor


class _Best:
    """The best documents of each item so far."""

    def __init__(self, n_items: int, kind: pa.DataType, top: int) -> None:
        self.top = top
        self.item, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.doc = pa.array([], kind)
        # What a score must reach to matter: ties can still win by their id.
        self.least = np.ones(n_items, np.int64)

    def add(self, items: np.ndarray, scores: np.ndarray, docs: pa.Array) -> None:
        """Rows of ``scores`` are the given items, columns the documents."""
        least = self.least[items]
        if scores.shape[1] > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=1)[:, -self.top])
        row, column = (scores >= least[:, None]).nonzero()
        if not len(row):
            return
        item = np.concatenate([self.item, items[row]])
        score = np.concatenate([self.score, scores[row, column]])
        doc = pa.concat_arrays([self.doc, docs.take(pa.array(column))])
        by_id = pc.rank(doc, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
        order = np.lexsort((by_id, -score, item))
        starts = np.searchsorted(item[order], item[order])
        nth = np.arange(len(order)) - starts
        kept = order[nth < self.top]
        self.item, self.score, self.doc = item[kept], score[kept], doc.take(pa.array(kept))
        full = order[nth == self.top - 1]
        self.least[item[full]] = score[full]


def best_of_block(
    matched: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int
) -> DataFrame:
    """Per task the best documents of each item: ``at``, ``item``, ``doc``, ``score``."""
    held = matched.sparkSession.sparkContext.broadcast((vars(block), weights))
    kind = matched.schema["doc"].dataType.simpleString()
    item_kind = {pa.int64(): "long", pa.int32(): "int"}.get(block.ids.type, "string")
    schema = f"at long, item {item_kind}, doc {kind}, score long"

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = Block(**held.value[0]), held.value[1]
        factor = block.repeats * weights[block.term]
        firsts = np.arange(0, len(block.ids), ITEM_TILE)
        local = np.zeros(len(weights), np.int64)
        best = None
        for batch in batches:
            for start in range(0, batch.num_rows, DOC_TILE):
                tile = batch.slice(start, DOC_TILE)
                if best is None:
                    best = _Best(len(block.ids), tile["doc"].type, top)
                term, doc, impact = _impacts(tile, n_docs, n_terms)
                for first in firsts:
                    mine = (block.item >= first) & (block.item < first + ITEM_TILE)
                    items = np.arange(first, min(first + ITEM_TILE, len(block.ids)))
                    scores = np.zeros((len(items), tile.num_rows), np.int64)
                    cut = term_tiles(block.item[mine] - first, block.term[mine], factor[mine])
                    for columns, row, column, value in cut:
                        local[:] = -1
                        local[columns] = np.arange(len(columns))
                        left = np.zeros((len(items), len(columns)))
                        left[row, column] = value
                        at = local[term]
                        met = at >= 0
                        right = np.zeros((len(columns), tile.num_rows))
                        right[at[met], doc[met]] = impact[met]
                        # Whole numbers below 2^53 at every step: the product is exact.
                        scores += (left @ right).astype(np.int64)
                    best.add(items, scores, tile["doc"])
        if best is not None:
            columns = [pa.array(best.item), block.ids.take(pa.array(best.item)), best.doc, pa.array(best.score)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "item", "doc", "score"])

    return matched.mapInArrow(rank, schema)


def _impacts(tile: pa.RecordBatch, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, document and impact of every entry of a tile of documents."""
    counts = np.diff(tile["ids"].offsets.to_numpy())
    doc = np.repeat(np.arange(tile.num_rows), counts)
    term = tile["ids"].flatten().to_numpy().astype(np.int64)
    tf = tile["tf"].flatten().to_numpy().astype(np.int64)
    # In Python's integers: the product may pass 64 bits.
    m = np.array([100 - 25 + 25 * n * n_docs // n_terms for n in tile["n"].to_pylist()], np.int64)
    return term, doc, (1000 * IMPACT * tf) // (1000 * tf + 12 * m[doc])


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` documents of each item: item id, ``rank`` from 1, document id, ``score``.

    Documents' terms are counted against the items' vocabulary where they are
    read; a task multiplies tiles of items with tiles of its documents and
    keeps the best of each item, ties settled by the smaller document id.
    Every score is exact. Items are held in blocks of bounded size, each of
    which takes one pass over all documents.

    Only scores above 0 are listed: an item without a term that some document
    has gives no rows, nor does a null or empty text on either side, nor an
    empty table. Every row of ``docs`` is a document, rows of one id and equal
    rows too; a null id comes last among equal scores. Items equal in id and
    text count once, others of one id each have their list. Other columns are
    not looked at. Item ids are whole numbers or strings.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text")).distinct()
    found, totals = [], None
    for number, (block, place) in enumerate(blocks(stored(asked, "items"), block_bytes)):
        if not place:
            continue
        matched = matched_terms(rows, place)
        if totals is None:
            totals = matched.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
        # One row per term of the block: bounded by its texts.
        df = matched.select(F.explode("ids").alias("id")).groupBy("id").count().toArrow()
        have = np.zeros(len(place), np.int64)
        have[df["id"].to_numpy()] = df["count"].to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * totals.docs + 2) / (2 * n + 1))) for n in have.tolist()])
        best = best_of_block(matched, block, weights, totals.docs, totals.terms, top)
        found.append(best.withColumn("block", F.lit(number)))
    if not found:
        empty = items.select(F.col(item_id_col).alias("item")).where(F.lit(False))
        return empty.select(
            F.col("item").alias(item_id_col), F.lit(0).alias("rank"),
            F.lit(None).cast(kind).alias(id_col), F.lit(0).cast("bigint").alias("score"),
        )
    lists = found[0]
    for more in found[1:]:
        lists = lists.unionByName(more)
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc"), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("block", "at", "part").orderBy(*order))
    fewer = lists.withColumn("part", part).withColumn("rank", first).where(F.col("rank") <= top)
    last = F.row_number().over(Window.partitionBy("block", "at").orderBy(*order))
    return fewer.withColumn("rank", last).where(F.col("rank") <= top).select(
        F.col("item").alias(item_id_col), "rank", F.col("doc").alias(id_col), "score"
    )
