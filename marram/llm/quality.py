"""Quality classification with a factorisation machine."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of the training sample, in labelled documents.
SAMPLE_ROWS = 8_000
WORD_BITS = 14
BINS = 24
RANK = 8
_REMEMBERED = 300_000
_PUNCTUATION = [b for b in range(33, 127) if not chr(b).isalnum()]
# Structure statistics are one-hot in BINS bins each, behind the words' slots.
_STATISTICS = (
    "bytes words lines word_bytes line_words distinct_words distinct_lines top_word upper digits "
    "spaces other most_punctuation punctuation short_words metadata"
).split()
_SHARES = 1 << WORD_BITS
SLOTS = _SHARES + (len(_STATISTICS) + len(_PUNCTUATION)) * BINS


def _log_bin(value: float) -> int:
    return min(BINS - 1, int(math.log2(1 + value)))


def _share_bin(part: float, whole: float) -> int:
    return min(BINS - 1, int(math.sqrt(part / whole) * BINS)) if whole else 0


def features(text: str | None, n_chars: float | None, slots: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a document: hashed words, statistics of its form, and its stated length."""
    data = (text or "").encode()
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256).tolist()
    tokens = data.lower().split()
    lines = data.split(b"\n")
    counts = Counter(tokens)
    size, n_tokens, n_lines = len(data), len(tokens), len(lines)
    upper = sum(kinds[65:91])
    signs = [kinds[b] for b in _PUNCTUATION]
    missing = n_chars is None or n_chars != n_chars
    bins = [
        _log_bin(size),
        _log_bin(n_tokens),
        _log_bin(n_lines),
        min(BINS - 1, int(size / n_tokens)) if n_tokens else 0,
        _log_bin(n_tokens / n_lines),
        _share_bin(len(counts), n_tokens),
        _share_bin(len(set(lines)), n_lines),
        _share_bin(max(counts.values(), default=0), n_tokens),
        _share_bin(upper, upper + sum(kinds[97:123])),
        _share_bin(sum(kinds[48:58]), size),
        _share_bin(kinds[32], size),
        _share_bin(sum(kinds[128:]), size),
        _share_bin(max(signs), size),
        _share_bin(sum(signs), size),
        _share_bin(sum(n for t, n in counts.items() if len(t) < 4), n_tokens),
        BINS - 1 if missing else min(BINS - 2, _log_bin(max(0.0, float(n_chars)))),
    ]
    bins += [_share_bin(n, size) for n in signs]
    form = _SHARES + np.arange(len(bins)) * BINS + bins
    if len(slots) > _REMEMBERED:
        slots.clear()
    for token in counts:
        if token not in slots:
            slots[token] = zlib.crc32(token) & (_SHARES - 1)
    hashed = np.fromiter((slots[token] for token in counts), np.int64, len(counts))
    weights = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    words, inverse = np.unique(hashed, return_inverse=True)
    values = np.bincount(inverse, weights, len(words)) if len(words) else np.zeros(0)
    values /= max(1e-9, np.sqrt((values**2).sum()))
    return (
        np.concatenate([words, form]).astype(np.int32),
        np.concatenate([values, np.full(len(bins), 3 / np.sqrt(len(bins)))]).astype(np.float32),
    )


@dataclass
class Machine:
    """score = sigmoid(bias + sum w_i x_i + pairwise terms of rank RANK)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def terms(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray):
        """Raw scores of rows laid end to end, and the factor sums they need.

        The sum over pairs of <v_i, v_j> x_i x_j is half of the square of the
        sum less the sum of squares, so it takes time linear in the features.
        """
        factor = self.factors[index] * value[:, None]
        sums = np.add.reduceat(factor, starts)
        squares = np.add.reduceat(factor**2, starts)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        index, value, starts = laid_out(rows)
        raw, _ = self.terms(index, value, starts)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def laid_out(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(index) for index, _ in rows]
    starts = np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64)
    return np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    epochs: int = 6,
    batch: int = 128,
    rate: float = 0.08,
    shrink: float = 1e-5,
    seed: int = 7,
) -> Machine:
    """Logistic loss, adaptive gradient steps over shuffled batches; fixed seed."""
    random = np.random.default_rng(seed)
    prior = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        float(np.log(prior / (1 - prior))),
        np.zeros(SLOTS),
        random.normal(0, 0.02, (SLOTS, RANK)),
    )
    seen_w, seen_v, seen_b = np.full(SLOTS, 1e-6), np.full((SLOTS, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for start in range(0, len(order), batch):
            part = order[start : start + batch]
            index, value, starts = laid_out([rows[i] for i in part])
            raw, sums = machine.terms(index, value, starts)
            error = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[part]
            sizes = np.diff(np.append(starts, len(index)))
            step = np.repeat(error, sizes) * value
            grad_v = step[:, None] * (np.repeat(sums, sizes, axis=0) - machine.factors[index] * value[:, None])
            touched, inverse = np.unique(index, return_inverse=True)
            total_w = np.bincount(inverse, step) + shrink * machine.weights[touched]
            total_v = np.stack([np.bincount(inverse, grad_v[:, k]) for k in range(RANK)], axis=1)
            total_v += shrink * machine.factors[touched]
            seen_w[touched] += total_w**2
            seen_v[touched] += total_v**2
            machine.weights[touched] -= rate * total_w / np.sqrt(seen_w[touched])
            machine.factors[touched] -= rate * total_v / np.sqrt(seen_v[touched])
            seen_b += error.sum() ** 2
            machine.bias -= rate * error.sum() / np.sqrt(seen_b)
    return machine


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
    label_col: str = "quality",
    most: int = SAMPLE_ROWS,
) -> Machine:
    """A machine fitted on at most ``most`` labelled documents, those drawn first by hash.

    Labels other than 0 and 1 and null ids are not used; of several labels of a
    document the lowest counts. The sample's ids are broadcast, which its bound
    allows, and only hashed features come to the driver. With no labelled
    document the machine gives every text a half.
    """
    draw = F.xxhash64(F.md5(F.col("_id").cast("string")))
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).alias("label"))
        .orderBy(draw, "_id")
        .limit(most)
    )
    texts = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("text"),
        F.col(chars_col).cast("double").alias("n"),
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots: dict[bytes, int] = {}
        for batch in batches:
            rows = [features(t, n, slots) for t, n in zip(batch["text"], batch["n"], strict=True)]
            yield pd.DataFrame(
                {
                    "id": batch["_id"].astype(str),
                    "label": batch["label"].astype(float),
                    "slots": [index for index, _ in rows],
                    "weights": [value for _, value in rows],
                }
            )

    found = texts.join(F.broadcast(known), "_id").mapInPandas(
        extract, "id string, label double, slots array<int>, weights array<float>"
    )
    table = found.toArrow().sort_by("id")
    if not table.num_rows:
        return Machine(0.0, np.zeros(SLOTS), np.zeros((SLOTS, RANK)))
    rows = [
        (i.values.to_numpy(), v.values.to_numpy())
        for i, v in zip(table["slots"], table["weights"], strict=True)
    ]
    return fit(rows, table["label"].to_numpy())


def with_score(
    docs: DataFrame, machine: Machine, text_col: str = "text", chars_col: str = "n_chars", name: str = "score"
) -> DataFrame:
    """``docs`` with the probability that a text is good.

    Whole texts are read. A null text counts as empty, and an empty one is
    scored by its form; a null length is a value of its own. Equal rows have
    equal scores; no other column has influence.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(machine))

    @F.pandas_udf("double")
    def score(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        machine, slots = Machine(**held.value), {}
        for texts, lengths in columns:
            out = [
                machine.scores([features(text, n, slots)])[0]
                for text, n in zip(texts, lengths, strict=True)
            ]
            yield pd.Series(out, dtype="float64")

    return docs.withColumn(name, score(F.col(text_col), F.col(chars_col).cast("double")))
