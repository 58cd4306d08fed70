"""Language-model scoring with Brown class bigrams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.llm.common import stored

# The most frequent words, clustered by exchange; so many at most.
CLUSTERED = 1_000
# Words whose class and count every task holds, so many at most; all other
# words are looked up by a join. The most frequent are held as they are, the
# others by 64 bits of hash.
HELD, NAMED = 1 << 22, 100_000
# Entries that a task counts before it passes them on.
COUNTED = 200_000
# A word seen less often is never held: such words show how new ones behave.
HELD_FROM = 3
CLASSES = 32
# Weight of the class's own share in the smoothing of transitions.
PRIOR = 5.0
# The end of a text as a word: no token is empty.
END = b""
_PAIRS_AT_ONCE = 2_000_000
# Documents whose rows are made in one go.
_ROWS_AT_ONCE = 128


def tokens(text: bytes | None) -> list[bytes]:
    """Tokens of a text in UTF-8, lowered in A-Z; the end is not among them."""
    return (text or b"").lower().split()


def ids_of(words: list[bytes], place: dict[bytes, int], further: np.ndarray) -> np.ndarray:
    """Ids of words: places in ``place``, then those of their hashes in the sorted ``further``; -1 for others."""
    find = place.get
    ids = np.array([find(word, -1) for word in words], np.int64)
    if len(further):
        missed = (ids < 0).nonzero()[0]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(words[at]) for at in missed.tolist()), np.uint64, len(missed))
        at = np.minimum(np.searchsorted(further, hashes), len(further) - 1)
        ids[missed] = np.where(further[at] == hashes, len(place) + at, -1)
    return ids


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and count ``c`` over ``text``, ends included, stored."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens(text))
                seen[END] += 1
                if len(seen) > COUNTED:
                    yield frame(seen)
                    seen.clear()
        yield frame(seen)

    def frame(seen: Counter[bytes]) -> pd.DataFrame:
        return pd.DataFrame({"word": list(seen.keys()), "c": list(seen.values())})

    counted = texts.mapInPandas(count, "word binary, c long")
    return stored(counted.groupBy("word").agg(F.sum("c").alias("c")), "word_counts")


def _counted_pairs(codes: list[np.ndarray]) -> pd.DataFrame:
    code, n = np.unique(np.concatenate(codes), return_counts=True)
    return pd.DataFrame({"code": code, "n": n})


def exchange(pairs: np.ndarray, movable: int, classes: int, rounds: int | None = None) -> np.ndarray:
    """Class of each word by the exchange algorithm.

    ``pairs[i, j]`` counts word j after word i. The first ``movable`` words,
    most frequent first, start in classes in turn and are each moved to the
    class that raises the likelihood of class bigrams most, until no word
    moves; the words behind them have classes of their own, which stay.
    """
    n_words = len(pairs)
    total = classes + n_words - movable
    member = np.concatenate([np.arange(movable) % classes, np.arange(classes, total)])
    one = np.eye(total)[member]
    right = pairs @ one  # word to following class
    left = pairs.T @ one  # preceding class to word, by word
    table = one.T @ right
    own = np.diag(pairs)

    def gain(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0)

    # Sums of this size are rounded; a gain below that is none.
    least = 1e-9 + 1e-12 * np.abs(gain(table)).sum()
    for _ in count() if rounds is None else range(rounds):
        moved = 0
        for word in range(movable):
            old = member[word]
            after, before, twice = right[word].copy(), left[word].copy(), own[word]
            # The word's own pairs are counted apart, as both their ends move.
            after[old] -= twice
            before[old] -= twice
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= twice
            # Wherever the word goes, the pairs with it return to its neighbours' classes.
            rows, columns = table.sum(axis=1) + before, table.sum(axis=0) + after
            size_out, size_in = after.sum() + twice, before.sum() + twice
            span = np.arange(classes)
            base = gain(table)
            with_row = gain(table[:classes] + after) - base[:classes]
            with_column = gain(table[:, :classes] + before[:, None]) - base[:, :classes]
            corner = table[span, span]
            score = with_row.sum(axis=1) + with_column.sum(axis=0)
            score -= with_row[span, span] + with_column[span, span]
            score += gain(corner + after[span] + before[span] + twice) - gain(corner)
            score -= gain(rows[:classes] + size_out) - gain(rows[:classes])
            score -= gain(columns[:classes] + size_in) - gain(columns[:classes])
            new = int(score.argmax())
            if score[new] <= score[old] + least:
                new = old
            table[new] += after
            table[:, new] += before
            table[new, new] += twice
            if new != old:
                moved += 1
                member[word] = new
                right[:, old] -= pairs[:, word]
                right[:, new] += pairs[:, word]
                left[:, old] -= pairs[word]
                left[:, new] += pairs[word]
        if not moved:
            break
    return member


@dataclass
class Model:
    """What tasks hold: classes and counts of the most frequent words, and the class bigrams."""

    place: dict[bytes, int]
    further: np.ndarray
    counts: np.ndarray
    member: np.ndarray
    transitions: np.ndarray
    class_counts: np.ndarray
    n_tokens: int
    n_words: int
    rest_tokens: int
    rest_words: int
    # Whether tasks hold every word that has a class.
    whole: bool

    @property
    def rest(self) -> int:
        return len(self.class_counts) - 2

    @property
    def base_log(self) -> np.ndarray:
        return np.log10((self.counts + 0.5) / (self.n_tokens + 0.5 * (self.n_words + 1)))

    @property
    def emission_log(self) -> np.ndarray:
        return np.log10(self.counts / self.class_counts[self.member])

    @property
    def transition_log(self) -> np.ndarray:
        share = (self.class_counts + 0.5) / (self.class_counts + 0.5).sum()
        before = self.transitions.sum(axis=1, keepdims=True)
        return np.log10((self.transitions + PRIOR * share) / (before + PRIOR))

    def base_of(self, c: Column) -> Column:
        """Base term of a word outside the held ones, by its count."""
        return F.log10((c + 0.5) / F.lit(self.n_tokens + 0.5 * (self.n_words + 1)))

    def emission_of(self, c: Column) -> Column:
        return F.log10((c + 0.5) / F.lit(self.rest_tokens + 0.5 * (self.rest_words + 1)))


def _most_frequent(counts: DataFrame, most: int) -> pa.Table:
    """Words with counts from some level on, at most ``most``, the most frequent first.

    Words of fewer than ``HELD_FROM`` occurrences are left out.

    Levels are an eighth of a power of two apart. How many words each has tells
    the lowest one that fits, so no task sorts the vocabulary.
    """
    counts = counts.where(F.col("c") >= HELD_FROM)
    level = F.floor(F.log2("c") * 8)
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    least, total = None, 0
    for at, n in sorted(zip(sizes["level"].to_pylist(), sizes["n"].to_pylist(), strict=True), reverse=True):
        total += n
        if total > most:
            break
        least = at
    chosen = counts.where(F.lit(False) if least is None else level >= least)
    return chosen.select("word", "c").toArrow().sort_by([("c", "descending"), ("word", "ascending")])


def train(
    docs: DataFrame,
    text_col: str = "text",
    clustered: int = CLUSTERED,
    held: int = HELD,
    classes: int = CLASSES,
) -> tuple[Model, DataFrame]:
    """The model and the counts of all words of ``docs``.

    Counts are taken over all texts and grow with them. The ``clustered`` most
    frequent words are put in classes by exchange, on the counts of their
    pairs; each of the other ``held`` ones joins the class that its neighbours
    fit best; words beyond and rare ones have one class of their own, as has the end. Both
    numbers bound what the driver and the tasks hold.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    counts = word_counts(texts)
    is_end = F.octet_length("word") == 0
    classed = ~is_end & (F.col("c") >= HELD_FROM)
    sums = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("v"),
        F.coalesce(F.sum(F.when(is_end, F.col("c"))), F.lit(0)).alias("ends"),
        F.coalesce(F.sum(F.when(classed, F.col("c"))), F.lit(0)).alias("classed_tokens"),
        F.count(F.when(classed, 1)).alias("classed_words"),
    ).first()
    top = _most_frequent(counts.where(~is_end), held)
    if top.num_rows < min(clustered, sums.classed_words):
        top = counts.where(classed).orderBy(F.desc("c"), "word").limit(clustered).toArrow()
    c = top["c"].to_numpy().astype(np.int64)
    n_words, movable = len(c), min(clustered, len(c))
    named = max(NAMED, movable)
    place = {word: at for at, word in enumerate(top["word"].slice(0, named).to_pylist())}
    hashes = (xxhash.xxh3_64_intdigest(word.as_buffer()) for word in top["word"].slice(named))
    further = np.fromiter(hashes, np.uint64, max(0, n_words - named))
    order = further.argsort()
    further, c[named:] = further[order], c[named:][order]
    del top
    rest, end = movable, movable + 1
    known = spark.sparkContext.broadcast(dict(list(place.items())[:movable]))

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, codes, n = known.value.get, [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = np.array([end, *(find(t, rest) for t in tokens(text)), end], np.int64)
                codes.append(ids[:-1] * (end + 1) + ids[1:])
                n += len(ids)
                if n > _PAIRS_AT_ONCE:
                    yield _counted_pairs(codes)
                    codes, n = [], 0
        if codes:
            yield _counted_pairs(codes)

    summed = texts.mapInPandas(pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    table = summed.toArrow()
    matrix = np.zeros((end + 1) ** 2)
    matrix[table["code"].to_numpy()] = table["n"].to_numpy()
    first = exchange(matrix.reshape(end + 1, end + 1), movable, classes)
    member = np.full(n_words, classes, np.int16)
    member[:movable] = first[:movable]
    if n_words > movable:
        member[movable:] = _fitted(texts, place, further, member, matrix, first, movable, classes)
    rest_tokens = sums.n - sums.ends - sums.classed_tokens
    rest_words = sums.v - sums.classed_words - bool(sums.ends)
    class_counts = np.append(np.bincount(member, c, classes)[:classes], [rest_tokens, sums.ends])
    whole = n_words == sums.classed_words
    none = F.lit(None).cast("long")
    if whole:
        counts = counts.withColumn("class", none)
    else:
        others = _fitted_others(texts, place, further, matrix, first, movable, classes)
        counts = stored(counts.join(others, "word", "left"), "word_classes")
        for at, n in counts.where("class IS NOT NULL").groupBy("class").agg(F.sum("c")).collect():
            class_counts[at] += n
    model = Model(
        place, further, c, member, np.zeros((classes + 2,) * 2), class_counts, sums.n, sums.v, rest_tokens, rest_words, whole
    )
    model.transitions = _transitions(texts, model, counts)
    return model, counts


def _class_counter(
    texts: DataFrame, place: dict[bytes, int], further: np.ndarray, member: np.ndarray, rest: int, end: int, code
) -> DataFrame:
    """Counts of ``code(words, classes)`` over all texts, words by place (-1: none), ends around."""
    held = texts.sparkSession.sparkContext.broadcast((place, further, np.append(member, np.int16(rest))))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (place, further, of), codes, n = held.value, [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = ids_of(tokens(text), place, further)
                found = code(ids, np.concatenate([[end], of[ids], [end]]))
                codes.append(found)
                n += len(found)
                if n > _PAIRS_AT_ONCE:
                    yield _counted_pairs(codes)
                    codes, n = [], 0
        if codes:
            yield _counted_pairs(codes)

    return texts.mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _fitted(texts, place, further, member, matrix, first, movable: int, classes: int) -> np.ndarray:
    """Classes of the words behind the clustered ones, by the classes before and after them.

    A word goes to the class under which its neighbours are likeliest: the sum
    of its counts times the log of the class table, with a prior of the
    class's size.
    """
    wide = classes + 2

    def sides(ids: np.ndarray, around: np.ndarray) -> np.ndarray:
        at = (ids >= movable).nonzero()[0]
        word = (ids[at] - movable) * (2 * wide)
        return np.concatenate([word + around[at], word + wide + around[at + 2]])

    counted = _class_counter(texts, place, further, member, classes, classes + 1, sides)
    sided = counted.select(
        F.expr(f"code div {2 * wide}").alias("word"), (F.col("code") % (2 * wide)).alias("side"), "n"
    )
    chosen = _chosen(sided, "long", matrix, first, movable, classes).toArrow()
    out = np.full(len(member) - movable, 0, np.int16)
    out[chosen["word"].to_numpy()] = chosen["class"].to_numpy()
    return out


def _fitted_others(texts, place, further, matrix, first, movable: int, classes: int) -> DataFrame:
    """``word`` and ``class`` of the words with a class that tasks do not hold, fitted alike."""
    wide = classes + 2
    around = np.append(first[:movable], np.full(len(place) + len(further) - movable + 1, classes)).astype(np.int16)
    held = texts.sparkSession.sparkContext.broadcast((place, further, around))

    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (place, further, of), seen = held.value, Counter()
        for batch in batches:
            for text in batch["text"]:
                found = tokens(text)
                ids = ids_of(found, place, further)
                path = np.concatenate([[classes + 1], of[ids], [classes + 1]])
                for i in (ids < 0).nonzero()[0].tolist():
                    seen[found[i], int(path[i])] += 1
                    seen[found[i], wide + int(path[i + 2])] += 1
                if len(seen) > COUNTED:
                    yield _frame(seen, ["word", "side"])
                    seen.clear()
        yield _frame(seen, ["word", "side"])

    counted = texts.mapInPandas(sides, "word binary, side long, n long")
    sided = counted.groupBy("word", "side").agg(F.sum("n").alias("n"))
    # Each occurrence has two sides.
    return _chosen(sided, "binary", matrix, first, movable, classes, 2 * HELD_FROM)


def _frame(seen: Counter, names: list[str]) -> pd.DataFrame:
    columns = zip(*seen, strict=True) if seen else [()] * len(names)
    return pd.DataFrame(dict(zip(names, columns, strict=True)) | {"n": list(seen.values())})


def _chosen(sided: DataFrame, kind: str, matrix, first, movable: int, classes: int, least: int = 0) -> DataFrame:
    """``word`` and its best ``class``, by counts ``n`` of its sides, of words with a sum of ``least`` or more."""
    wide = classes + 2
    one = np.eye(wide)[np.append(first[:movable], [classes, classes + 1])]
    table = one.T @ matrix.reshape(movable + 2, movable + 2) @ one + 0.1
    before = np.log(table / table.sum(axis=0))[:, :classes]  # given the class, what stands before
    after = np.log(table / table.sum(axis=1, keepdims=True))[:classes].T  # and what after
    seen = np.log(table.sum(axis=0)[:classes] / table.sum())

    both = sided.sparkSession.sparkContext.broadcast((np.concatenate([before, after]), seen))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logs, prior = both.value
        for batch in batches:
            best = [
                (np.asarray(n, float) @ logs[np.asarray(side, np.int64)] + prior).argmax()
                for side, n in zip(batch["side"], batch["n"], strict=True)
            ]
            yield pd.DataFrame({"word": batch["word"], "class": best})

    # A word has one row per side at most, so its list is bounded by twice the classes.
    listed = sided.groupBy("word").agg(F.collect_list(F.struct("side", "n")).alias("s"), F.sum("n").alias("all"))
    listed = listed.where(F.col("all") >= least)
    return listed.select("word", "s.side", "s.n").mapInPandas(choose, f"word {kind}, class long")


def _transitions(texts: DataFrame, model: Model, counts: DataFrame) -> np.ndarray:
    wide = len(model.class_counts)

    def bigrams(_: np.ndarray, around: np.ndarray) -> np.ndarray:
        return around[:-1].astype(np.int64) * wide + around[1:]

    found = _class_counter(texts, model.place, model.further, model.member, wide - 2, wide - 1, bigrams).toArrow()
    table = np.zeros(wide * wide)
    table[found["code"].to_numpy()] = found["n"].to_numpy()
    table = table.reshape(wide, wide)
    if not model.whole:
        keys = ["l", "r", "lc", "rc"]
        moved = _moved_pairs(texts, model, counts, []).groupBy(*keys).agg(F.sum("n").alias("n")).toArrow().to_pandas()
        left, right, lc, rc, n = (moved[name].to_numpy(np.int64) for name in [*keys, "n"])
        np.add.at(table, (left, right), -n)
        np.add.at(table, (lc, rc), n)
    return table


def _moved_pairs(rows: DataFrame, model: Model, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of words whose classes tasks do not know: ``keys``, ``l``, ``r``, ``lc``, ``rc``, ``n``.

    ``l`` and ``r`` are the classes that tasks take, those of unknown words
    being the rest; ``lc`` and ``rc`` those of the table of all words. Pairs
    of three kinds are joined apart, so that no join has a null key.
    """
    wide, rest = len(model.class_counts), model.rest
    held = rows.sparkSession.sparkContext.broadcast((model.place, model.further, np.append(model.member, np.int16(rest))))
    kinds = {name: rows.schema[name].dataType.simpleString() for name in keys}
    types = {"l": pa.int64(), "r": pa.int64(), "lw": pa.binary(), "rw": pa.binary(), "n": pa.int64()}
    names = list(types)[:-1]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, further, of = held.value
        seen: Counter[tuple] = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part, at, out = batch.slice(start, _ROWS_AT_ONCE), [], []
                for row, text in enumerate(part["text"].to_pylist()):
                    found = tokens(text)
                    ids = np.concatenate([[0], ids_of(found, place, further), [0]])
                    path = np.concatenate([[wide - 1], of[ids[1:-1]], [wide - 1]]).tolist()
                    for i in ((ids[:-1] < 0) | (ids[1:] < 0)).nonzero()[0].tolist():
                        left = found[i - 1] if ids[i] < 0 else None
                        right = found[i] if ids[i + 1] < 0 else None
                        seen[path[i], path[i + 1], left, right] += 1
                    if keys or len(seen) > COUNTED:
                        at += [row] * len(seen)
                        out += [(*pair, n) for pair, n in seen.items()]
                        seen.clear()
                if out:
                    yield made(part, at, out)
        if seen:
            yield made(part, [0] * len(seen), [(*pair, n) for pair, n in seen.items()])

    def made(part: pa.RecordBatch, at: list[int], out: list[tuple]) -> pa.RecordBatch:
        place = pa.array(at, pa.int64())
        columns = [part[name].take(place) for name in keys]
        values = zip(*out, strict=True)
        columns += [pa.array(column, kind) for column, kind in zip(values, types.values(), strict=True)]
        return pa.RecordBatch.from_arrays(columns, [*keys, *types])

    fields = kinds | {"l": "long", "r": "long", "lw": "binary", "rw": "binary", "n": "long"}
    schema = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    all_pairs = rows.select(*keys, "text").mapInArrow(pairs, schema)
    if not keys:
        all_pairs = all_pairs.groupBy(*names).agg(F.sum("n").alias("n"))
    all_pairs = stored(all_pairs, "pairs")
    known = counts.where("class IS NOT NULL")
    of_left = known.select(F.col("word").alias("lw"), F.col("class").alias("lk"))
    of_right = known.select(F.col("word").alias("rw"), F.col("class").alias("rk"))
    nothing = F.lit(None).cast("long")
    columns = [*keys, "l", "r", F.coalesce("lk", "l").alias("lc"), F.coalesce("rk", "r").alias("rc"), "n"]
    one = all_pairs.where("rw IS NULL").join(of_left, "lw").withColumn("rk", nothing)
    other = all_pairs.where("lw IS NULL").join(of_right, "rw").withColumn("lk", nothing)
    both = all_pairs.where("lw IS NOT NULL AND rw IS NOT NULL")
    both = both.join(of_left, "lw", "left").join(of_right, "rw", "left")
    return one.select(*columns).unionByName(other.select(*columns)).unionByName(both.select(*columns))


def score(
    docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for every row of ``docs``: id, ``n_tokens``, ``n_known``, ``base_score``, ``score``.

    ``score`` is the log10 probability of the tokens and the end under the
    model: of each class after the class before it, and of each word within its
    class. ``base_score`` is that of smoothed single words. Words that tasks
    hold are scored where the text is read; the others leave it as counts per
    document and meet the table of all counts in a join.

    Null and empty texts have one token, the end. Equal rows have equal
    results; a null id is an id like others.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(
        F.col(id_col).alias("doc"),
        F.xxhash64(text_col).alias("same"),
        F.col(text_col).cast("binary").alias("text"),
    )
    kind = rows.schema["doc"].dataType.simpleString()
    names = ["doc", "same", "word", "n", "n_tokens", "n_known", "base", "score"]
    kinds = [kind, "long", "binary", "long", "long", "long", "double", "double"]
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds, strict=True))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**held.value)
        rest, end = model.rest, model.rest + 1
        base_log = np.append(model.base_log, 0.0)
        emission_log = np.append(model.emission_log, 0.0)
        of, transition_log = np.append(model.member, np.int16(rest)), model.transition_log
        end_count = model.class_counts[end]
        end_base = np.log10((end_count + 0.5) / (model.n_tokens + 0.5 * (model.n_words + 1)))
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(start, _ROWS_AT_ONCE)
                at, word, n, length, known, base, value = [], [], [], [], [], [], []
                for row, text in enumerate(batch["text"].to_pylist()):
                    found = tokens(text)
                    ids = ids_of(found, model.place, model.further)
                    path = np.concatenate([[end], of[ids], [end]])
                    rare = Counter([found[i] for i in (ids < 0).nonzero()[0].tolist()])
                    at += [row] * (1 + len(rare))
                    word += [None, *rare.keys()]
                    n += [0, *rare.values()]
                    blank = [0] * len(rare)
                    length += [len(found) + 1, *blank]
                    known += [int((ids >= 0).sum()) + bool(end_count), *blank]
                    base += [base_log[ids].sum() + end_base, *blank]
                    value += [emission_log[ids].sum() + transition_log[path[:-1], path[1:]].sum(), *blank]
                place = pa.array(at, pa.int64())
                columns = [batch["doc"].take(place), batch["same"].take(place), pa.array(word, pa.binary())]
                columns += [pa.array(x, pa.int64()) for x in (n, length, known)]
                columns += [pa.array(x, pa.float64()) for x in (base, value)]
                yield pa.RecordBatch.from_arrays(columns, names)

    each = stored(rows.mapInArrow(parts, schema), "scored")
    c = F.coalesce("c", F.lit(0))
    # Asked with a null for a place, the lookup would give the last class.
    place = F.coalesce("class", F.lit(0)) + 1
    within = F.element_at(F.lit([float(n) for n in model.class_counts]), place.cast("int"))
    emission = F.when(F.col("class").isNotNull(), F.log10(c / within)).otherwise(model.emission_of(c))
    rare = each.where("word IS NOT NULL").join(counts, "word", "left").select(
        "doc",
        "same",
        F.lit(0).alias("copies"),
        "n_tokens",
        F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * model.base_of(c)).alias("base"),
        (F.col("n") * emission).alias("score"),
    )
    local = each.where("word IS NULL").select(
        "doc", "same", F.lit(1).alias("copies"), "n_tokens", "n_known", "base", "score"
    )
    parts_of = ["copies", *names[4:]]
    parts_all = local.unionByName(rare)
    if not model.whole:
        logs = F.lit(model.transition_log.ravel().tolist())
        wide = len(model.class_counts)
        new, old = (F.element_at(logs, (F.col(a) * wide + F.col(b) + 1).cast("int")) for a, b in ("lc rc".split(), "lr"))
        parts_all = parts_all.unionByName(
            _moved_pairs(rows, model, counts, ["doc", "same"]).select(
                "doc",
                "same",
                *[F.lit(0).alias(x) for x in ("copies", "n_tokens", "n_known")],
                F.lit(0.0).alias("base"),
                (F.col("n") * (new - old)).alias("score"),
            )
        )
    summed = parts_all.groupBy("doc", "same").agg(*[F.sum(x).alias(x) for x in parts_of])
    each_row = summed.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each_row.select(
        F.col("doc").alias(id_col),
        *[F.expr(f"{x} div copies").alias(x) for x in ("n_tokens", "n_known")],
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
