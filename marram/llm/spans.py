"""Substring deduplication over sliding runs of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.common import stored

# A run has so many sentences and so many words at least.
SENTENCES, WORDS = 3, 20
# Of so many words in a row inside a sentence, one at least starts a piece.
WINDOW = 8
# Bits of the table that tells which runs may be repeated, and how many an aggregate holds.
SLOTS, PAGE = 1 << 26, 1 << 15
# Sentences, in the wide sense, end at one of these marks before white space, or with the line.
_MARK = re.compile(r"[.!?;:,](?=\s|\Z)\s*|\n+")
# White space by code point; there is none beyond the last.
_WHITE = np.array([chr(code).isspace() for code in range(0x3001)] + [False])
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class _Hashes(dict):
    """Hashes of words, kept for so many words at once."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _Hashes()


def _starts(own: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Words, by place, that have the smallest hash of some ``WINDOW`` words in a row of one sentence.

    ``own`` are the words' hashes. A hash is made of that of the word and the
    next one of its sentence; of equal ones the last counts. So only the words
    nearby decide, wherever a sentence starts, and no piece is longer than a
    window.
    """
    if len(own) < WINDOW:
        return np.zeros(0, np.int64)
    after = np.append(np.where(sentence[1:] == sentence[:-1], own[1:], np.uint64(0)), np.uint64(0))
    value = _mixed(own * _MIX[0] + after * _MIX[1])
    back = np.lib.stride_tricks.sliding_window_view(value, WINDOW)[:, ::-1].argmin(axis=1)
    whole = (sentence[: len(back)] == sentence[WINDOW - 1 :]).nonzero()[0]
    return np.unique(whole + WINDOW - 1 - back[whole])


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ value >> np.uint64(29)) * _MIX[2]
    return value ^ value >> np.uint64(32)


def _parsed(text: str) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Bounds of sentences and pieces, words before each bound, lowered words and their hashes."""
    ends = [0, *(m.end() for m in _MARK.finditer(text)), len(text)]
    starts = np.unique(np.array(ends, np.int64))[:-1]
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    word = ~_WHITE[np.minimum(codes, len(_WHITE) - 1)]
    places = (word & ~np.append(False, word[:-1])).nonzero()[0]
    words = text.lower().split()
    own = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    sentence = np.searchsorted(starts, places, "right")
    cut = _starts(own, sentence)
    inside = cut[(cut > 0) & (sentence[cut] == sentence[cut - 1])]
    bounds = np.union1d(starts, places[inside])
    at = np.append(np.searchsorted(places, bounds), len(words))
    return np.append(bounds, len(text)), at, words, own


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Sentences of a text and pieces of longer ones in order: start, end, lowered words.

    They cover the text without gaps.
    """
    bounds, at, words, _ = _parsed(text)
    bounds, at = bounds.tolist(), at.tolist()
    return [(a, b, words[i:j]) for a, b, i, j in zip(bounds, bounds[1:], at, at[1:], strict=False)]


def runs(at: np.ndarray, least: int = SENTENCES, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """From each sentence the shortest run of enough sentences and words: first, and the one behind the last.

    ``at`` counts the words before each sentence, and all words.
    """
    first = np.arange(len(at) - 1)
    behind = np.maximum(first + least, np.searchsorted(at, at[:-1] + words))
    whole = behind < len(at)
    return first[whole], behind[whole]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, base)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def run_hashes(own: np.ndarray, first: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the words from ``first`` up to, but without, ``behind``: sums of hashes times powers."""
    out = []
    for base, mark in zip(_MIX[:2], _MIX[1:], strict=True):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        sums = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_mixed(own * mark) * _powers(base, len(own) + 1)[:-1], out=sums[1:])
        value = (sums[behind] - sums[first]) * _powers(inverse, len(own) + 1)[first]
        out.append(_mixed(value + (behind - first).astype(np.uint64) * mark).view(np.int64))
    return tuple(out)


def run_table(docs: DataFrame, id_col: str, text_col: str, least: int, words: int) -> DataFrame:
    """Runs of every text, stored: ``doc``, ``same``, ``n`` sentences, and arrays ``h`` and ``g``, 96 bits of hash.

    Runs start one from each sentence, so the place in the arrays is the first sentence.
    """
    rows = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("same"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                counts, found, ends = [], [], [0]
                for text in part["text"].to_pylist():
                    bounds, at, _, own = _parsed(text or "")
                    first, behind = runs(at, least, words)
                    found.append(run_hashes(own, at[first], at[behind]))
                    counts.append(len(bounds) - 1 if text else 0)
                    ends.append(ends[-1] + len(first))
                h, g = (np.concatenate(column) for column in zip(*found, strict=True))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["doc"], part["same"], pa.array(counts, pa.int32()),
                     pa.ListArray.from_arrays(offsets, pa.array(h)),
                     pa.ListArray.from_arrays(offsets, pa.array((g >> 32).astype(np.int32)))],
                    ["doc", "same", "n", "h", "g"],
                )

    schema = f"doc {kind}, same long, n int, h array<long>, g array<int>"
    return stored(rows.mapInArrow(hashed, schema), "runs")


def repeating_slots(table: DataFrame, slots: int = SLOTS) -> np.ndarray:
    """A bit for each remainder of hashes modulo ``slots``: set if some run that repeats has it.

    All repeated runs have theirs set, and a few others share one. The bits
    have a fixed size, whatever the runs.
    """
    if slots % PAGE:
        raise ValueError(f"slots must be a multiple of {PAGE}")
    again = table.select(F.explode("h").alias("h")).groupBy("h").count().where("count > 1")
    pages = again.groupBy(F.expr(f"pmod(h, {slots}) div {PAGE}").alias("page")).agg(
        F.bitmap_construct_agg(F.pmod("h", F.lit(slots)) % PAGE).alias("bits")
    )
    bits = np.zeros((slots // PAGE, PAGE // 8), np.uint8)
    for row in pages.collect():
        bits[row.page] = np.frombuffer(row.bits, np.uint8)
    return bits.ravel()


def repeated_runs(table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per document ``doc``, ``same`` its ``n`` sentences and ``runs``, the first sentences of runs that stand elsewhere before.

    The first of equal runs is that of the smallest document id, then text
    hash, then place. Counting shuffles one part of a hash and a count per
    run. Runs that cannot be repeated are left out where they are stored; of
    the rest, each that is not the first of its kind goes.
    """
    bits = table.sparkSession.sparkContext.broadcast(repeating_slots(table, slots))
    kind = table.schema["doc"].dataType.simpleString()

    def maybe(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Which runs may be repeated, and the document of each run."""
        at = batch["h"].flatten().to_numpy() % slots
        sizes = np.diff(batch["h"].offsets.to_numpy())
        return bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1, np.repeat(np.arange(len(sizes)), sizes)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, doc = maybe(batch)
            starts = batch["h"].offsets.to_numpy()
            first = np.arange(len(doc)) - (starts[:-1] - starts[0])[doc]
            at, kept = pa.array(doc[chosen]), pa.array(chosen)
            yield pa.RecordBatch.from_arrays(
                [batch["h"].flatten().filter(kept), batch["g"].flatten().filter(kept), batch["doc"].take(at),
                 batch["same"].take(at), pa.array(first[chosen].astype(np.int32))],
                ["h", "g", "doc", "same", "first"],
            )

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen, doc = maybe(batch)
            starts = batch["h"].offsets.to_numpy()
            first = np.arange(len(doc)) - (starts[:-1] - starts[0])[doc]
            ends = np.append(0, np.bincount(doc[chosen], minlength=batch.num_rows).cumsum())
            kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(first[chosen].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["same"], batch["n"], kept], ["doc", "same", "n", "kept"])

    rows = table.select("doc", "same", "h", "g").mapInArrow(places, f"h long, g int, doc {kind}, same long, first int")
    origins = rows.groupBy("h", "g").agg(F.min(F.struct("doc", "same", "first")).alias("o")).select("o.*")
    origins = stored(origins.groupBy("doc", "same").agg(F.collect_set("first").alias("own")), "origins")
    # Rows of one id and text have equal lists.
    kept = table.select("doc", "same", "n", "h").mapInArrow(lists, f"doc {kind}, same long, n int, kept array<int>")
    kept = kept.groupBy("doc", "same").agg(F.first("n").alias("n"), F.first("kept").alias("kept"))
    of = origins.toDF("_doc", "_same", "own")
    met = kept.join(of, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("same") == F.col("_same")), "left")
    none = F.array().cast("array<int>")
    return met.select("doc", "same", "n", F.array_except("kept", F.coalesce("own", none)).alias("runs"))


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = SENTENCES,
    words: int = WORDS,
) -> DataFrame:
    """``docs`` with repeated passages cut out: the text, and ``n_sentences``, ``n_removed``, ``removed``.

    Every run of ``least`` consecutive sentences or more with ``words`` words
    or more is compared with all others, in upper or lower case and with any
    white space; pieces of long sentences count as sentences. As no piece has
    more than eight words, 20 words always are three pieces, and a passage of
    50 words repeated within other sentences, with marks or without, shares a
    run at least; up to 15 words at either of its ends can stay. Sentences covered by a run that is not the first of its kind
    go; ``removed`` lists what went as ``start:end`` in code points of the old
    text. The first occurrence of a run stays unless another run takes it.

    A null text stays null, an empty one empty; a text of too few sentences or
    words is never changed. Rows that share an id are told apart by their
    texts; rows equal in both are one document, changed alike. Other columns
    stay; those named like a result are replaced.
    """
    results = ["n_sentences", "n_removed", "removed"]
    names = [name for name in docs.columns if name not in results]
    table = run_table(docs, id_col, text_col, least, words)
    listed = stored(repeated_runs(table).toDF("_doc", "_same", "n", "runs"), "repeated")
    # The caller's row is one column, so that its names meet no others.
    rows = docs.select(
        F.struct(*[F.col(name) for name in names]).alias("row"), F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("same")
    )
    met = rows.join(listed, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("same") == F.col("_same")), "left")

    @F.pandas_udf("text string, n_removed long, removed string")
    def cut(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lists in columns:
            yield pd.DataFrame(
                [_cut(t, firsts, least, words) for t, firsts in zip(texts, lists, strict=True)],
                columns=["text", "n_removed", "removed"],
            )

    text, busy = F.col("row")[text_col], F.size("runs") > 0
    # Texts without a repeated run are not sent to the function.
    done = met.withColumn("cut", cut(F.when(busy, text), F.col("runs")))
    shown = {text_col: F.when(busy, F.col("cut.text")).otherwise(text)}
    return done.select(
        *[shown.get(name, F.col("row")[name]).alias(name) for name in names],
        F.col("n").cast("bigint").alias("n_sentences"),
        *[F.col(f"cut.{name}").alias(name) for name in results[1:]],
    )


def _cut(text: str | None, firsts, least: int, words: int) -> tuple[str | None, int, str]:
    if text is None:
        return None, 0, ""
    bounds, at, _, _ = _parsed(text)
    bounds, behind = bounds.tolist(), runs(at, least, words)[1].tolist()
    gone = [0] * len(bounds)
    for first in firsts:
        gone[first] += 1
        gone[behind[first]] -= 1
    kept, spans, depth, n = [], [], 0, 0
    for start, end, step in zip(bounds, bounds[1:], gone, strict=False):
        depth += step
        if not depth:
            kept.append(text[start:end])
            continue
        n += 1
        if spans and spans[-1][1] == start:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    return "".join(kept), n, ",".join(f"{a}:{b}" for a, b in spans)
