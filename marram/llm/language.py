"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marram.llm.common import stored

ORDERS = (2, 3, 4)
UNKNOWN = "und"
# Bound of the training sample: so many documents of a language at most.
DOCS_PER_LANGUAGE = 2_000
# Bound of a filter: so many n-grams of a language at most, the most frequent.
CAPACITY = 100_000
# An n-gram is a language's if its share there is this part of its largest share in any.
BELONGS = 0.3
POSITION_BITS, HASHES = 21, 3
_AT_ONCE = 1 << 18
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _scrambled(values: np.ndarray) -> np.ndarray:
    values = (values ^ values >> np.uint64(32)) * _MIX[1]
    return (values ^ values >> np.uint64(29)) * _MIX[2]


def grams(text: str | None, orders: tuple[int, ...] = ORDERS) -> Iterator[np.ndarray]:
    """Hashes of the n-grams of a text's lowered words, piece by piece; none if it has no letter."""
    found = _LETTERS.findall((text or "").lower())
    if not found:
        return
    codes = np.frombuffer(f" {' '.join(found)} ".encode("utf-32-le", "replace"), np.uint32)
    longest = max(orders)
    for start in range(0, len(codes), _AT_ONCE):
        piece = codes[start : start + _AT_ONCE + longest - 1].astype(np.uint64)
        own = min(_AT_ONCE, len(codes) - start)
        value = np.zeros(len(piece), np.uint64)
        for order in range(1, longest + 1):
            if len(piece) < order:
                break
            value = value[: len(piece) - order + 1] * _MIX[0] + piece[order - 1 :] + np.uint64(1)
            if order in orders:
                yield _scrambled(value[:own] + np.uint64(order))


@dataclass(frozen=True)
class Filters:
    """``masks`` has a bit per language at each of 2**POSITION_BITS positions, 64 languages to a column."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray
    orders: tuple[int, ...]

    def containing(self, hashes: np.ndarray, column: int) -> np.ndarray:
        """Bitmask of all languages whose filter has each n-gram."""
        found = None
        for at in range(HASHES):
            positions = (hashes >> np.uint64(at * POSITION_BITS)) & np.uint64((1 << POSITION_BITS) - 1)
            bits = self.masks[positions.astype(np.int64), column]
            found = bits if found is None else found & bits
        return found

    def shares(self, text: str | None) -> np.ndarray | None:
        """Each language's share of a text's n-grams, less what false positives give; None without letters."""
        counts, total = np.zeros(len(self.languages)), 0
        for hashes in grams(text, self.orders):
            total += len(hashes)
            for column in range(self.masks.shape[1]):
                found = self.containing(hashes, column)
                for at in range(column * 64, min(len(self.languages), column * 64 + 64)):
                    counts[at] += np.count_nonzero(found & np.uint64(1 << at % 64))
        if not total:
            return None
        return np.clip((counts - total * self.false_rate) / (1 - self.false_rate) / total, 0, 1)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and the language's own share."""
        shares = self.shares(text) if self.languages else None
        if shares is None:
            return UNKNOWN, 0.0, 0.0
        best = int(shares.argmax())
        share = float(shares[best])
        return self.languages[best], float(shares[best] ** 2 / shares.sum()) if share else 0.0, share


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> DataFrame:
    """At most ``most`` documents of each language, those drawn first by hash: ``text``, ``lang``.

    The draw is made over ids alone; its cut per language then filters the texts.
    """
    draw = F.xxhash64(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), draw.alias("draw")
    )
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    # About twice as many as wanted pass a first cut, so that only these are ranked.
    place = F.col("draw") / 2.0**64 + 0.5
    few = known.select("lang", "draw").join(sizes, "lang").where(place * F.col("n") < 2 * most + 100)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    ranked = few.withColumn("rank", first).where(F.col("rank") <= most)
    cuts = ranked.groupBy("lang").agg(F.max("draw").alias("cut"))
    # Stored, its size is known, and texts need not move to meet it.
    return known.join(stored(cuts, "cuts"), "lang").where("draw <= cut").select("text", "lang")


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = DOCS_PER_LANGUAGE,
    capacity: int = CAPACITY,
    orders: tuple[int, ...] = ORDERS,
) -> Filters:
    """Filters of the languages named in ``docs``.

    Fitted on at most ``most`` documents and ``capacity`` n-grams of each
    language; only those n-grams reach the driver. Rows without a language are
    not used; filters of no language at all give ``und`` to every text.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for text in texts:
                    pieces = list(grams(text, orders))
                    if pieces:
                        gram, n = np.unique(np.concatenate(pieces), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})

    counted = (
        sample(docs, id_col, text_col, lang_col, most)
        .mapInPandas(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    held = counted.withColumn("share", share).withColumn(
        "largest", F.max("share").over(Window.partitionBy("gram"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = (
        held.where(F.col("share") >= BELONGS * F.col("largest"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= capacity)
        .select("lang", "gram")
        .toArrow()
    )
    found = chosen.to_pandas()
    languages = sorted(found["lang"].unique())
    masks = np.zeros((1 << POSITION_BITS, -(-len(languages) // 64)), np.uint64)
    rates = []
    for at, lang in enumerate(languages):
        hashes = found.loc[found["lang"] == lang, "gram"].to_numpy(np.int64).view(np.uint64)
        bit, column = np.uint64(1 << at % 64), at // 64
        for turn in range(HASHES):
            positions = (hashes >> np.uint64(turn * POSITION_BITS)) & np.uint64((1 << POSITION_BITS) - 1)
            masks[np.unique(positions).astype(np.int64), column] |= bit
        rates.append((np.count_nonzero(masks[:, column] & bit) / len(masks)) ** HASHES)
    return Filters(languages, masks, np.array(rates), orders)


def with_language(docs: DataFrame, filters: Filters, text_col: str = "text", name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name`` of ``lang``, ``score`` and ``share`` for each whole text.

    ``lang`` is one of the learned languages, or ``und`` if the text is null or
    has no letter. ``score``, from 0 to 1, is the share of the text's n-grams
    that the language has, times its part among the shares of all languages;
    ``share`` is that first share alone, which does not fall with the number of
    languages learned. A tie goes to the first language by name; other columns
    have no influence and stay, but for one called ``name``, which is replaced.
    An empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(filters))

    @F.pandas_udf("lang string, score double, share double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        filters = Filters(**held.value)
        for batch in texts:
            found = [filters.predict(text) for text in batch]
            yield pd.DataFrame(found, columns=["lang", "score", "share"])

    return docs.withColumn(name, predict(F.col(text_col).cast("string")))


def accepted(language: Column, least: float) -> Column:
    """Whether a prediction names a language that has a share of ``least`` or more of the text's n-grams."""
    return (language["lang"] != UNKNOWN) & (language["share"] >= least)
