"""Removal of long repeats by a prefix-free parse of the corpus.

A rolling hash says where phrases start. Phrases overlap, so that each string
of ``length`` bytes lies in exactly one; the distinct phrases are the
dictionary, and the corpus is a list of them for each document. Suffixes of
the corpus are equal in their first ``length`` bytes if those of the
dictionary are, however often the parse repeats a phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.common import stored

# Bytes of a repeat at least.
LENGTH = 400
# The rolling hash is over so many bytes; a phrase starts ahead of a local
# minimum, the least among so many places on either side.
ROLL, RADIUS = 8, 32
# Strings that start more than so many bytes ahead of a phrase start are phrases of their own.
AHEAD = 160
# Bytes parsed in one go; longer texts are parsed in pieces that overlap by a string.
AT_ONCE = 1 << 20
# Phrases with one middle that a task compares; those of larger groups meet by their strings' hashes.
BLOCK = 2048
# Fixed: odd numbers that hashes are made of.
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
# What is known of a phrase of a document.
REPEATED, OPEN, OPEN_SHOWN, REPEATED_SHOWN = range(4)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(_ODD[3])
    return (x ^ x >> np.uint64(29)) * np.uint64(_ODD[0])


class Hashes:
    """Hashes of any stretch of some bytes: sums of a byte's value times a power, brought to one place."""

    def __init__(self, data: np.ndarray, seed: int) -> None:
        base = _ODD[seed]
        values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[seed + 1]))
        n = len(data) + 1
        with np.errstate(over="ignore"):
            powers = np.full(n, np.uint64(base))
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            self.back = np.full(n, np.uint64(pow(base, -1, 1 << 64)))
            self.back[0] = 1
            self.back = np.multiply.accumulate(self.back)
            self.sums = np.zeros(n, np.uint64)
            np.cumsum(values[data] * powers[:-1], out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of bytes from ``first`` up to, but without, ``last``."""
        found = (self.sums[last] - self.sums[first]) * self.back[first]
        return _mixed(found + (last - first).astype(np.uint64) * np.uint64(_ODD[2])).view(np.int64)


def phrase_starts(data: np.ndarray, roll: int, radius: int) -> np.ndarray:
    """Where phrases start: places ``q`` such that the bytes from ``q`` on, ``2 * radius + roll`` of them, say so.

    The rolling hash at the middle is smaller than at all places before it
    there, and not larger than at those behind.
    """
    n = len(data) - roll + 1
    if n <= 2 * radius:
        return np.zeros(0, np.int64)
    rolled = np.zeros(n, np.uint64)
    values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[1]))[data]
    for at in range(roll):
        rolled = rolled * np.uint64(_ODD[0]) + values[at : at + n]
    rolled = (_mixed(rolled) >> np.uint64(32)).astype(np.uint32)
    least, wide = rolled, 1
    while wide < radius:  # least of ``radius`` places in a row, by doubling
        step = min(wide, radius - wide)
        least = np.minimum(least[:-step], least[step:])
        wide += step
    middle = rolled[radius : n - radius]
    ok = (middle < least[: len(middle)]) & (middle <= least[radius + 1 : radius + 1 + len(middle)])
    return ok.nonzero()[0]


def phrases(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The parse of some bytes: per phrase ``k0``, ``k1``, ``first``, ``last``, ``n``.

    A phrase holds the strings that start from ``first`` up to, but without,
    ``last``. ``k0`` is the hash of what all of them and all strings like them
    have in common, ``k1`` that of the phrase. Strings without a phrase start
    near are phrases of one string each; those repeated in these bytes are
    given once with ``n`` = 2 and, where they stand, as rows with ``n`` = 0.
    """
    roll, radius, ahead = _shape(length)
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    starts = phrase_starts(data, roll, radius)
    first = np.maximum(np.maximum(np.append(-1, starts[:-1])[: len(starts)] + 1, starts - ahead), 0)
    last = np.minimum(starts, n - 1) + 1
    ok = first < last
    starts, first, last = starts[ok], first[ok], last[ok]
    middle, whole = Hashes(data, 0), Hashes(data, 1)
    parts = [
        (middle.of(starts, starts + length - ahead), whole.of(first, last - 1 + length), first, last, np.ones(len(first), np.int64))
    ]
    alone = np.ones(n + 1, np.int64)
    np.add.at(alone, first, -1)
    np.add.at(alone, last, 1)
    alone = (np.cumsum(alone - np.append(0, np.ones(n, np.int64)))[:n] > 0).nonzero()[0]
    if len(alone):
        k0, k1 = middle.of(alone, alone + length), whole.of(alone, alone + length)
        order = np.lexsort((k1, k0))
        k0, k1, alone = k0[order], k1[order], alone[order]
        new = np.append(True, (k0[1:] != k0[:-1]) | (k1[1:] != k1[:-1]))
        at = new.nonzero()[0]
        times = np.diff(at, append=len(k0))
        parts.append((k0[at], k1[at], alone[at], alone[at] + 1, np.minimum(times, 2)))
        here = np.sort(alone[np.repeat(times > 1, times)])
        a, b = ranges(here)
        parts.append((np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), a, b, np.zeros(len(a), np.int64)))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _shape(length: int) -> tuple[int, int, int]:
    """Roll, radius and reach for strings of this length: those of LENGTH, or less for short ones."""
    ahead = min(AHEAD, 2 * length // 5)
    roll = min(ROLL, max(1, length // 8))
    return roll, min(RADIUS, (length - ahead - roll) // 2), ahead


def ranges(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of sorted, distinct places: first and behind the last."""
    gap = (np.diff(places) > 1).nonzero()[0]
    starts = np.append(0, gap + 1)[: len(places)]
    return places[starts], places[np.append(gap, len(places) - 1)[: len(starts)]] + 1


def parse(docs: DataFrame, length: int = LENGTH, at_once: int = AT_ONCE) -> DataFrame:
    """The parse of all documents (``doc``, ``same``, ``text``), stored, with the columns of ``phrases``."""
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, same long, k0 long, k1 long, first int, last int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for row, value in enumerate(batch["text"]):
                data = np.frombuffer(value.as_py() or b"", np.uint8)
                for start in range(0, max(1, len(data) - length + 1), at_once):
                    k0, k1, first, last, n = phrases(data[start : start + at_once + length - 1], length)
                    at.append(np.full(len(k0), row))
                    found.append((k0, k1, first + start, last + start, n))
                if sum(map(len, at[-64:])) > 1 << 18:
                    yield made(batch, at, found)
                    at, found = [], []
            if at:
                yield made(batch, at, found)

    def made(batch, at, found) -> pa.RecordBatch:
        place = pa.array(np.concatenate(at), pa.int64())
        columns = [np.concatenate(column) for column in zip(*found, strict=True)]
        kinds = [pa.int64()] * 2 + [pa.int32()] * 3
        return pa.RecordBatch.from_arrays(
            [batch["doc"].take(place), batch["same"].take(place)]
            + [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)],
            ["doc", "same", "k0", "k1", "first", "last", "n"],
        )

    return stored(docs.mapInArrow(run, schema), "parse")


def known_of_documents(parsed: DataFrame) -> DataFrame:
    """Per document (``doc``, ``same``) its phrases that repeat or may: ``known``, an array of structs.

    A middle that occurs once tells that its phrase has no string that occurs
    again. If all phrases with a middle are equal, they repeat. Of other
    phrases, those that occur again repeat, and the rest is open; one of each
    is shown, to be compared with the others of its middle.
    """
    middles = parsed.where("n > 0").groupBy("k0").agg(
        F.sum("n").alias("times"), (F.min("k1") == F.max("k1")).alias("alike")
    )
    middles = stored(middles.where("times > 1").select("k0", "alike"), "middles")
    met = stored(parsed.where("n > 0").join(middles, "k0"), "met")
    place = F.struct("doc", "same", "first")
    others = met.where("not alike")
    variants = stored(others.groupBy("k0", "k1").agg(F.sum("n").alias("times"), F.min(place).alias("shown")), "variants")
    none = F.lit(None).cast("bigint")

    def listed(rows: DataFrame, state, k0=none, k1=none) -> DataFrame:
        return rows.select("doc", "same", F.struct("first", "last", k0.alias("k0"), k1.alias("k1"), state.alias("state")).alias("p"))

    shown = place == F.col("shown")
    state = F.when(F.col("times") > 1, F.when(shown, REPEATED_SHOWN).otherwise(REPEATED)).otherwise(
        F.when(shown, OPEN_SHOWN).otherwise(OPEN)
    )
    keyed = others.join(variants, ["k0", "k1"]).withColumn("state", state)
    key = [F.when(F.col("state") != REPEATED, F.col(name)) for name in ("k0", "k1")]
    rows = listed(parsed.where("n = 0"), F.lit(REPEATED)).unionByName(listed(met.where("alike"), F.lit(REPEATED)))
    rows = rows.unionByName(listed(keyed, F.col("state"), *key))
    return rows.groupBy("doc", "same").agg(F.collect_set("p").alias("known"))


def window_hashes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every string of every text: number of the text, place, and two hashes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(text) for text in texts], np.int64)
    n = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(texts)), n)
    place = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
    first = place + (sizes.cumsum() - sizes)[text]
    return text, place, Hashes(data, 0).of(first, first + length), Hashes(data, 1).of(first, first + length)


def _again(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which of these occur again: ordered, equal ones are neighbours."""
    order = np.lexsort((g, h))
    equal = (h[order][1:] == h[order][:-1]) & (g[order][1:] == g[order][:-1])
    out = np.zeros(len(h), bool)
    out[order[1:]] |= equal
    out[order[:-1]] |= equal
    return out


def repeated_strings(shown: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Of distinct phrases (``k0``, ``k1``, ``bytes``) the strings that others of the same middle have too.

    Columns ``k0``, ``k1`` and ``found``, runs of places as ``[first, behind, ...]``.
    """
    sizes = shown.groupBy("k0").count()
    busy = stored(sizes.where(F.col("count") > block).select("k0"), "busy")
    schema = "k0 long, k1 long, found array<int>"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch[name].to_pylist() for name in ("k0", "k1", "bytes")), strict=True):
                if rows and rows[-1][:2] == row[:2]:
                    continue
                if size > AT_ONCE and rows[-1][0] != row[0]:
                    yield answers(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield answers(rows)

    def answers(rows) -> pa.RecordBatch:
        k0, k1, texts = (list(column) for column in zip(*rows, strict=True))
        text, place, h, g = window_hashes(texts, length)
        again = _again(h, g)
        text, place = text[again], place[again]
        # Places of texts one behind the other, a gap between texts.
        wide = max(map(len, texts)) + 1
        a, b = ranges(text * wide + place)
        mine = a // wide
        found = np.stack([a - mine * wide, b - mine * wide], axis=1).ravel()
        ends = np.append(0, 2 * np.bincount(mine, minlength=len(texts)).cumsum())
        return pa.RecordBatch.from_arrays(
            [pa.array(k0, pa.int64()), pa.array(k1, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.int32()))],
            ["k0", "k1", "found"],
        )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                text, place, h, g = window_hashes(part["bytes"].to_pylist(), length)
                at = pa.array(text, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["k0"].take(at), part["k1"].take(at), pa.array(place, pa.int32()), pa.array(h), pa.array(g)],
                    ["k0", "k1", "place", "h", "g"],
                )

    few = shown.join(busy, "k0", "left_anti").repartition("k0").sortWithinPartitions("k0", "k1")
    many = shown.join(busy, "k0", "left_semi").dropDuplicates(["k0", "k1"])
    each = stored(many.mapInArrow(windows, "k0 long, k1 long, place int, h long, g long"), "strings")
    twice = stored(each.groupBy("h", "g").count().where("count > 1").select("h", "g"), "twice")
    # A phrase has no more strings than its bytes.
    placed = each.join(twice, ["h", "g"]).groupBy("k0", "k1").agg(
        F.flatten(F.collect_list(F.array("place", F.col("place") + 1))).alias("found")
    )
    return few.mapInArrow(compare, schema).unionByName(placed)


def _finished(text: bytes, first: np.ndarray, last: np.ndarray, length: int) -> tuple[int, int, int, str, str, bytes]:
    """Sizes, digest, spans and kept bytes of a text, by the places where repeated strings start."""
    spans: list[list[int]] = []
    order = np.lexsort((last, first))
    for a, b in zip(first[order].tolist(), (last[order] - 1 + length).tolist(), strict=True):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    bounds = [0, *(x for span in spans for x in span), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
    removed = ",".join(f"{a}:{b}" for a, b in spans)
    return len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), removed, kept


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep_text: bool = False,
    at_once: int = AT_ONCE,
    block: int = BLOCK,
) -> DataFrame:
    """Every row of ``docs`` without the bytes of strings of ``length`` bytes that start anywhere else too.

    Columns: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``,
    ``removed`` (spans of bytes as ``start:end``) and, if wished, ``kept``, the
    bytes that stay, which may begin or end inside a character. No occurrence
    of a repeated string stays, the first neither; a string may overlap its
    own repeat, and none crosses documents.

    A null text counts as empty. Every row is a document: rows of one id are
    judged each by its own text, and rows equal in both are repeats of each
    other, as texts under different ids are. An empty table gives no rows;
    other columns are not looked at.
    """
    if length < 5:
        raise ValueError("strings of 5 bytes at least")
    rows = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("same"), F.col(text_col).cast("binary").alias("text")
    )
    known = known_of_documents(parse(rows, length, at_once)).toDF("_doc", "_same", "known")
    met = rows.join(known, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("same") == F.col("_same")), "left")
    met = met.select(F.monotonically_increasing_id().alias("row"), "doc", "text", "known")
    kind = rows.schema["doc"].dataType.simpleString()
    result = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed string, kept binary"
    key = "array<struct<k0:bigint,k1:bigint,{}>>"
    schema = (
        f"row long, doc {kind}, {result}, text binary, spans array<int>, "
        f"open {key.format('first:int')}, shown {key.format('bytes:binary')}"
    )
    results = [field.split()[0] for field in result.split(", ")]
    into = _arrow(schema)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = {name: [] for name in (*results, "text", "spans", "open", "shown")}
                for text, found in zip(part["text"].to_pylist(), part["known"].to_pylist(), strict=True):
                    text, found = text or b"", found or []
                    spans = [x for p in found if p["state"] in (REPEATED, REPEATED_SHOWN) for x in (p["first"], p["last"])]
                    left = [p for p in found if p["state"] in (OPEN, OPEN_SHOWN)]
                    seen = [p for p in found if p["state"] in (OPEN_SHOWN, REPEATED_SHOWN)]
                    done = (None,) * 6
                    if not left:
                        done = _finished(text, *np.array(spans, np.int64).reshape(-1, 2).T, length)[: 6 if keep_text else 5]
                    for name, value in zip(results, (*done, None), strict=False):
                        out[name].append(value)
                    out["text"].append(text if left else None)
                    out["spans"].append(spans if left else None)
                    out["open"].append([{"k0": p["k0"], "k1": p["k1"], "first": p["first"]} for p in left])
                    out["shown"].append(
                        [{"k0": p["k0"], "k1": p["k1"], "bytes": text[p["first"] : p["last"] - 1 + length]} for p in seen]
                    )
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc"], *[pa.array(out[name], into[name]) for name in out]],
                    ["row", "doc", *out],
                )

    first = stored(met.mapInArrow(first_pass, schema), "first_pass")
    shown = first.select(F.explode("shown").alias("s")).select("s.k0", "s.k1", "s.bytes")
    answers = stored(repeated_strings(stored(shown, "shown"), length, block), "answers")
    opened = first.select("row", F.explode("open").alias("o")).select("row", "o.k0", "o.k1", "o.first")
    told = opened.join(answers, ["k0", "k1"]).groupBy("row").agg(
        F.flatten(F.collect_list(F.transform("found", lambda x: x + F.col("first")))).alias("more")
    )
    left = first.where("text IS NOT NULL").select("row", "doc", "text", "spans").join(told, "row", "left")

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                out = []
                for text, spans, more in zip(*(part[n].to_pylist() for n in ("text", "spans", "more")), strict=True):
                    found = np.array(spans + (more or []), np.int64).reshape(-1, 2).T
                    out.append((*_finished(text, *found, length)[: 6 if keep_text else 5], None)[:6])
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], *[pa.array(x, into[n]) for n, x in zip(results, zip(*out, strict=True), strict=True)]],
                    ["doc", *results],
                )

    names = results if keep_text else results[:-1]
    finished = first.where("text IS NULL").select("doc", *names)
    later = left.mapInArrow(second_pass, f"doc {kind}, {result}").select("doc", *names)
    return finished.unionByName(later).withColumnRenamed("doc", id_col)


def _arrow(schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return {field.name: field.type for field in to_arrow_schema(StructType.fromDDL(schema))}
