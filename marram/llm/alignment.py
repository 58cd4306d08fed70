"""Cross-tokenizer alignment by whitespace-token anchors and memoised token-id windows."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.llm.common import stored

# Characters encoded in one call; longer texts are cut where no token of either side crosses.
AT_ONCE = 1 << 18
# Token ids that the memo of a task holds at most before it starts anew.
REMEMBERED = 1_000_000
# The most frequent id pairs, which every task holds; all others meet the counts in a join.
HELD = 1 << 20
# A group of more links is counted, not listed.
LISTED = 256
# Fixed: how byte-level tokenizers split a text before they merge.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SAFE_CUT = re.compile(r"(?<=\w) (?=\w)")

# Encodes texts without special tokens; bytes of each token by id.
Encoder = tuple[Callable[[list[str]], list[list[int]]], list[bytes]]


def byte_alphabet() -> dict[str, int]:
    """Fixed: the characters by which byte-level vocabularies write bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(0x100) if byte not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + at): b for at, b in enumerate(others)}


def byte_level(content: bytes) -> Encoder:
    """Encoder of a byte-level tokenizer's JSON file.

    Where its merges are numbered in their order behind the 256 bytes, as is
    usual, the faster library encodes by the same merges; ids are the same.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    alphabet, plan = byte_alphabet(), json.loads(content)
    vocabulary, merges = plan["model"]["vocab"], plan["model"]["merges"]
    special = {token["content"]: token["id"] for token in plan["added_tokens"]}
    table = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, at in {**special, **vocabulary}.items():
        table[at] = bytes(alphabet[c] for c in token)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    in_order = all(vocabulary["".join(pair)] == 0x100 + at for at, pair in enumerate(pairs))
    split = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if in_order and plan["normalizer"] is None and split.items() <= plan["pre_tokenizer"].items():
        from tiktoken import Encoding

        ranks = {table[at]: at for at in range(0x100 + len(merges))}
        encode_one = Encoding("merges", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: list(map(encode_one, texts)), table
    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.encode_special_tokens = True

    def encode(texts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode, table


def pieces(content: bytes) -> Encoder:
    """Encoder of a sentencepiece model, which sets a space before the text by itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=content)
    table = []
    for at in range(model.get_piece_size()):
        piece = model.id_to_piece(at)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(at) else piece.replace("▁", " ").encode())
    if any(b" " in token.lstrip(b" ") for token in table):
        raise ValueError("a token with a space inside: texts could not be cut at spaces")
    return lambda texts: model.encode(texts, num_threads=1), table


def cut(text: str, most: int = AT_ONCE) -> list[str]:
    """A text in pieces of about ``most`` characters, without the single spaces between them.

    Both encoders start a token at a space between two letters or digits, and
    no token goes on behind one, so pieces encode as the whole does. A text
    without such a place stays whole.
    """
    out, start = [], 0
    while len(text) - start > most:
        found = _SAFE_CUT.search(text, start + most)
        if found is None:
            break
        out.append(text[start : found.start()])
        start = found.end()
    return [*out, text[start:]]


class Aligner:
    """Aligns the token ids of both sides window by window and remembers windows by their ids."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes], remembered: int = REMEMBERED) -> None:
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in table], np.int64) for table in (a_bytes, b_bytes))
        names = [str(at) for table in (a_bytes, b_bytes) for at in range(len(table))]
        self.inner, self.last_a, self.last_b = (np.array([x + mark for x in names], object) for mark in ",|;")
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        # By a window's ids, first those of a, then those of b behind them: its place in what follows.
        self.memo: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.groups = np.zeros(0, np.int64)
        # Where its links begin, and of all links id pair and times.
        self.starts = np.zeros(1, np.int64)
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.size = 0

    def gives_back(self, whole: bytes, a: list[int], b: list[int]) -> bool:
        return all(
            b"".join([table[x] for x in ids]) == whole for table, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )

    def windows(self, wholes: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[np.ndarray]:
        """Windows of pieces that both sides give back, in order, by their place in the memo.

        Every piece starts with a space, so pieces one behind the other are
        cut at their ends like one piece.
        """
        if not wholes:
            return []
        whole = np.frombuffer(b"".join(wholes), np.uint8)
        left, right = (np.fromiter(chain.from_iterable(ids), np.int32) for ids in (a, b))
        a_ends, b_ends = self.a_sizes[left].cumsum(), self.b_sizes[right].cumsum()
        # Offsets where both sides end a token before one that starts with a space.
        space = np.append(whole == 0x20, True)
        a_cuts, b_cuts = _shared(a_ends, b_ends, space)
        row = _interleaved(left, right + np.int32(len(self.a_bytes)), a_cuts, b_cuts)
        ids, ends = row.tobytes(), ((a_cuts + b_cuts) * row.itemsize).tolist()
        keys = [ids[start:end] for start, end in zip([0, *ends], ends, strict=False)]
        new = [key for key in dict.fromkeys(keys) if key not in self.memo]
        if new:
            self._learn(new)
        places = np.array(list(map(self.memo.__getitem__, keys)), np.int64)
        behind = np.cumsum([len(each) for each in wholes])
        return np.split(places, np.searchsorted(a_ends[a_cuts - 1], behind, "right")[:-1])

    def _learn(self, keys: list[bytes]) -> None:
        """Aligns windows one behind the other: both sides of each have the same bytes."""
        ids = np.frombuffer(b"".join(keys), np.int32)
        left, right = ids[ids < len(self.a_bytes)], ids[ids >= len(self.a_bytes)]
        a, b = left.astype(np.int64), right.astype(np.int64) - len(self.a_bytes)
        a_ends, b_ends = _shared(self.a_sizes[a].cumsum(), self.b_sizes[b].cumsum())
        first, second = self.inner[left], self.inner[right]
        first[a_ends - 1], second[b_ends - 1] = self.last_a[left[a_ends - 1]], self.last_b[right[b_ends - 1]]
        texts = _interleaved(first, second, a_ends, b_ends).tolist()
        ends = np.cumsum([len(key) // ids.itemsize for key in keys])
        spans = list(zip([0, *ends.tolist()], ends.tolist(), strict=False))
        n = len(self.texts)
        self.memo.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.texts += ["".join(texts[start:end])[:-1] for start, end in spans]
        # A window ends with a group.
        behind = np.searchsorted(a_ends + b_ends, ends, "right")
        self.groups = np.append(self.groups, np.diff(behind, prepend=0))
        codes, times, group = self._links(a, b, a_ends, b_ends)
        self.starts = np.append(self.starts, self.starts[-1] + np.searchsorted(group, behind))
        self.codes, self.times = np.append(self.codes, codes), np.append(self.times, times)
        self.size += len(ids)

    def _links(self, a, b, a_ends, b_ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id pairs of all links, times and group, by group; those of large groups counted first."""
        wide = len(self.b_bytes)
        a_first, b_first = np.append(0, a_ends[:-1]), np.append(0, b_ends[:-1])
        n_a, n_b = a_ends - a_first, b_ends - b_first
        listed = np.where(n_a * n_b <= LISTED, n_a * n_b, 0)
        group = np.repeat(np.arange(len(listed)), listed)
        nth = np.arange(len(group)) - np.repeat(listed.cumsum() - listed, listed)
        x, y = a[a_first[group] + nth // n_b[group]], b[b_first[group] + nth % n_b[group]]
        parts = [(x * wide + y, np.ones(len(group), np.int64), group)]
        for at in (listed == 0).nonzero()[0].tolist():
            x, n = np.unique(a[a_first[at] : a_ends[at]], return_counts=True)
            y, m = np.unique(b[b_first[at] : b_ends[at]], return_counts=True)
            codes = (x[:, None] * wide + y).ravel()
            parts.append((codes, np.outer(n, m).ravel(), np.full(len(codes), at)))
        if len(parts) == 1:
            return parts[0]
        codes, times, group = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = group.argsort(kind="stable")
        return codes[order], times[order], group[order]

    def counted(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs of the windows, as ``a * (size of b) + b``, and how often each is linked."""
        sizes = self.starts[windows + 1] - self.starts[windows]
        at = np.arange(sizes.sum()) + np.repeat(self.starts[windows] - sizes.cumsum() + sizes, sizes)
        codes, times = self.codes[at], self.times[at]
        order = codes.argsort(kind="stable")
        codes = codes[order]
        starts = np.append(True, codes[1:] != codes[:-1])[: len(codes)].nonzero()[0]
        return codes[starts], np.add.reduceat(times[order], starts) if len(starts) else times


def _shared(a_ends: np.ndarray, b_ends: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of tokens of either side before each offset where both end one.

    Of tokens that end at one offset the last counts: a token may have no bytes.
    """
    mark = np.zeros(int(a_ends[-1]) + 1, np.int8)
    mark[a_ends] += 1
    mark[b_ends] += 2
    both = mark == 3 if wanted is None else (mark == 3) & wanted
    return tuple((both[ends] & np.append(ends[1:] != ends[:-1], True)).nonzero()[0] + 1 for ends in (a_ends, b_ends))


def _interleaved(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Both sides in one row: part by part, first that of ``a``, then that of ``b``."""
    row = np.empty(len(a) + len(b), a.dtype)
    row[np.arange(len(a)) + np.repeat(np.append(0, b_ends[:-1]), np.diff(a_ends, prepend=0))] = a
    row[np.arange(len(b)) + np.repeat(a_ends, np.diff(b_ends, prepend=0))] = b
    return row


def align(
    docs: DataFrame,
    a_content: bytes,
    b_content: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
    at_once: int = AT_ONCE,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row for every row of ``docs``, stored, from the contents of a byte-level and a piece vocabulary.

    Columns ``row`` (a number of its own), ``doc`` (the id), ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups_sha256``, and arrays ``pair`` (distinct
    linked id pairs as ``a * (size of b) + b``) and ``times``; with
    ``keep_groups`` also ``groups``, the text that was hashed. A space stands
    before each text. Vocabularies travel to the tasks, whose size they bound.
    """
    context = docs.sparkSession.sparkContext
    contents = context.broadcast((a_content, b_content))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), F.col(text_col).cast("binary").alias("text")
    )
    small = len(byte_level(a_content)[1]) * len(pieces(b_content)[1]) < 1 << 31
    kind, pair_type = ("int", pa.int32()) if small else ("long", pa.int64())
    schema = (
        f"row long, doc {rows.schema['doc'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        f"groups_sha256 string, pair array<{kind}>, times array<int>"
    ) + (", groups string" if keep_groups else "")
    names = ["row", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a_encode, a_bytes), (b_encode, b_bytes) = byte_level(contents.value[0]), pieces(contents.value[1])
        aligner = Aligner(a_bytes, b_bytes, remembered)
        for batch in batches:
            waiting, size = [], 0
            for at, value in enumerate(batch["text"]):
                text = (value.as_py() or b"").decode("utf-8", "replace")
                parts = cut(text, at_once) if text else []
                waiting.append((at, value.as_py() or b"", parts))
                size += len(text)
                if size > at_once:
                    yield made(aligner, a_encode, b_encode, batch, waiting)
                    waiting, size = [], 0
            if waiting:
                yield made(aligner, a_encode, b_encode, batch, waiting)

    def made(aligner, a_encode, b_encode, batch, waiting) -> pa.RecordBatch:
        if aligner.size > aligner.remembered:
            aligner.forget()
        parts = [part for *_, parts in waiting for part in parts]
        found = []
        for some, a, b in _encoded(a_encode, b_encode, parts, at_once):
            wholes = [b" " + part.encode() for part in some]
            good = [aligner.gives_back(*each) for each in zip(wholes, a, b, strict=True)]
            windows = iter(aligner.windows(*([x for x, ok in zip(of, good, strict=True) if ok] for of in (wholes, a, b))))
            found += [(len(x), len(y), next(windows) if ok else None) for x, y, ok in zip(a, b, good, strict=True)]
        out, pairs, times, ends, found = [], [], [], [0], iter(found)
        for _, raw, parts in waiting:
            mine = [next(found) for _ in parts]
            # Bytes that are no text were replaced: they do not come back.
            whole = bool(parts) and all(w is not None for *_, w in mine) and " ".join(parts).encode() == raw
            n_a, n_b = (sum(each[side] for each in mine) if whole else 0 for side in (0, 1))
            windows = np.concatenate([w for *_, w in mine]) if whole else np.zeros(0, np.int64)
            text = ";".join([aligner.texts[at] for at in windows.tolist()])
            code, n = aligner.counted(windows)
            digest = hashlib.sha256(text.encode()).hexdigest() if whole else ""
            out.append((n_a, n_b, int(aligner.groups[windows].sum()), int(n.sum()), digest, text))
            pairs.append(code)
            times.append(n)
            ends.append(ends[-1] + len(code))
        place = pa.array([at for at, *_ in waiting], pa.int64())
        offsets = pa.array(ends, pa.int32())
        lists = [
            pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(each), kind))
            for each, kind in ((pairs, pair_type), (times, pa.int32()))
        ]
        n_a, n_b, n_groups, n_links, digest, text = (list(column) for column in zip(*out, strict=True))
        columns = [batch["row"].take(place), batch["doc"].take(place)]
        columns += [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)]
        columns += [pa.array(digest, pa.string()), *lists]
        columns += [pa.array(text, pa.string())] if keep_groups else []
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return stored(rows.mapInArrow(run, schema), "aligned")


def _encoded(
    a_encode, b_encode, parts: list[str], at_once: int
) -> Iterator[tuple[list[str], list[list[int]], list[list[int]]]]:
    """Parts with the ids of both sides, encoded so many characters at once."""
    start, size = 0, 0
    for at, part in enumerate(parts):
        size += len(part)
        if size > at_once or at == len(parts) - 1:
            some = parts[start : at + 1]
            yield some, a_encode([" " + part for part in some]), b_encode(some)
            start, size = at + 1, 0


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``pair``, ``n_docs`` and ``best``, stored: in how many documents a pair is linked, and if no pair of its first id is in more."""
    counts = aligned.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = stored(counts.withColumn("a", F.expr(f"cast(pair div {b_size} as int)")), "pair_counts")
    # One row per id of the first vocabulary.
    most = F.broadcast(counts.groupBy("a").agg(F.max("n_docs").alias("most")))
    return stored(
        counts.join(most, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")), "pairs"
    )


def _frequent(counts: DataFrame, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, counts and best marks from some count level on, ``held`` at most, by pair."""
    level = F.floor(F.log2("n_docs") * 8)
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for row in sorted(sizes, reverse=True):
        total += row.n
        if total > held:
            break
        least = row.level
    chosen = counts.where(F.lit(False) if least is None else level >= least).toArrow()
    pair = chosen["pair"].to_numpy().astype(np.int64)
    order = pair.argsort()
    return pair[order], chosen["n_docs"].to_numpy()[order], chosen["best"].to_numpy()[order]


def with_pair_sums(aligned: DataFrame, counts: DataFrame, held: int = HELD) -> DataFrame:
    """``aligned`` without its arrays, with ``n_best`` and ``count_sum``.

    ``n_best`` counts the links of a document whose pair is ``best``,
    ``count_sum`` sums the ``n_docs`` of all its links. The ``held`` most
    frequent pairs are looked up where the row stands; the rest leaves it as
    rows of document, pair and times and meets the counts in a join, with
    equal results.
    """
    table = aligned.sparkSession.sparkContext.broadcast(_frequent(counts, held))
    kept = [name for name in aligned.columns if name not in ("pair", "times")]
    types = ", ".join(f"{name} {aligned.schema[name].dataType.simpleString()}" for name in kept)
    pair_kind = aligned.schema["pair"].dataType.simpleString()
    schema = f"{types}, n_best long, count_sum long, pair {pair_kind}, times array<int>"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n_docs, best = table.value
        for batch in batches:
            sizes = np.diff(batch["pair"].offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            code = batch["pair"].flatten().to_numpy().astype(np.int64)
            times = batch["times"].flatten().to_numpy().astype(np.int64)
            known = np.zeros(len(code), bool)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            if len(pair):
                at = np.minimum(np.searchsorted(pair, code), len(pair) - 1)
                known = pair[at] == code
                at, mine, n = at[known], row[known], times[known]
                np.add.at(sums[0], mine[best[at]], n[best[at]])
                np.add.at(sums[1], mine, n * n_docs[at])
            ends = np.append(0, np.bincount(row[~known], minlength=batch.num_rows).cumsum())
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch[name].flatten().filter(pa.array(~known)))
                for name in ("pair", "times")
            ]
            columns = [batch[name] for name in kept] + [pa.array(x, pa.int64()) for x in sums] + lists
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_best", "count_sum", "pair", "times"])

    looked = stored(aligned.mapInArrow(look_up, schema), "looked_up")
    rest = looked.where(F.size("pair") > 0).select("row", F.explode(F.arrays_zip("pair", "times")).alias("p"))
    summed = (
        rest.select("row", "p.pair", F.col("p.times").alias("n"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("best_more"),
            F.sum(F.col("n") * F.col("n_docs")).alias("sum_more"),
        )
    )
    return looked.join(summed, "row", "left").select(
        *kept,
        (F.col("n_best") + F.coalesce("best_more", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("sum_more", F.lit(0))).alias("count_sum"),
    )


def alignment(
    docs: DataFrame,
    a_content: bytes,
    b_content: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
    held: int = HELD,
) -> DataFrame:
    """Alignment of both tokenizers over every row of ``docs``, with its links' counts over all documents.

    One row for every row: the id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups_sha256`` and, if wished, ``groups``.
    Offsets where tokens of both sides end cut the tokens into groups; tokens
    of one group are linked, all with all.

    Texts that are null, empty or no UTF-8, and those that either side's
    tokens do not give back, have no tokens: zeros and an empty hash. Every
    row is a document, rows of one id and equal rows too. An empty table gives
    no rows; other columns are not looked at.
    """
    aligned = align(docs, a_content, b_content, id_col, text_col, keep_groups)
    summed = with_pair_sums(aligned, pair_counts(aligned, len(pieces(b_content)[1])), held)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return summed.select(F.col("doc").alias(id_col), *columns, *(["groups"] if keep_groups else []))
