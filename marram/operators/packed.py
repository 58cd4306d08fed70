"""Postings of a word as bytes: differences and counts as numbers of variable length.

Work tables of the stored index hold them in this form, so that they take a few
bytes a posting on disk and in a shuffle. Postings are four columns, ``doc_id,
line_id, pos, n``; which of them are null is told apart from the bytes by
``holes``, a bit for each column, and is the same for all postings of a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

COLUMNS = ("doc_id", "line_id", "pos", "n")
# A task takes so many postings at once, or so many bytes.
POSTINGS_AT_ONCE, BYTES_AT_ONCE = 1 << 18, 1 << 25
# Bytes are made of and read to so many postings at once, which takes some 200 bytes each.
_AT_ONCE = 1 << 16


def together(batches: Iterator[pa.RecordBatch], weight: str | None = None, times: int = 1) -> Iterator[pa.Table]:
    """Batches gathered to tables of ``times`` ``POSTINGS_AT_ONCE`` rows, or of that sum of ``weight``, and some more."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows if weight is None else int(batch.column(weight).to_numpy().sum())
        size += batch.nbytes
        if n >= times * POSTINGS_AT_ONCE or size >= BYTES_AT_ONCE:
            table, held, n, size = pa.Table.from_batches(held), [], 0, 0
            yield table
    if n:
        yield pa.Table.from_batches(held)


def _folded(values: np.ndarray) -> np.ndarray:
    return (values << 1 ^ values >> 63).view(np.uint64)


def _unfolded(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)


def starts_of(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new.nonzero()[0]


def in_order(group: np.ndarray, values: Sequence[np.ndarray], *before: np.ndarray) -> np.ndarray:
    """The order by ``group``, the keys ``before`` and the four columns."""
    doc, line, pos, n = values
    if not before and len(group):
        key = None
        spans = [int(each.max()) - int(each.min()) + 1 for each in (group, doc, line)]
        if spans[0] * spans[1] * spans[2] < 1 << 62:
            key = ((group - group.min()) * spans[1] + (doc - doc.min())) * spans[2] + (line - line.min())
            order = np.arange(len(key)) if (key[1:] > key[:-1]).all() else key.argsort()
            if (key[order[1:]] != key[order[:-1]]).all():
                return order
    return np.lexsort((n, pos, line, doc, *before[::-1], group))


def pack(values: Sequence[np.ndarray], starts: np.ndarray) -> pa.Array:
    """Postings in order as one value of bytes for each run of them; a run's first document is not in it."""
    doc, line, pos, n = values
    new = np.zeros(len(doc), bool)
    new[starts] = True
    step = np.diff(doc, prepend=doc[:1]).view(np.uint64)
    step[starts] = 0
    same = (step == 0) & ~new
    lines = np.where(same, np.diff(line, prepend=line[:1]).view(np.uint64), _folded(line))
    sizes, parts = np.empty(len(doc), np.int64), []
    for start in range(0, len(doc), _AT_ONCE):
        part = slice(start, start + _AT_ONCE)
        out, lengths = _encoded(np.column_stack([step[part], lines[part], _folded(pos[part]), _folded(n[part])]).ravel())
        sizes[part] = lengths.reshape(-1, 4).sum(axis=1)
        parts.append(out)
    offsets = np.zeros(len(starts) + 1, np.int64)
    if len(starts):
        np.add.reduceat(sizes, starts).cumsum(out=offsets[1:])
    data = np.concatenate([*parts, np.zeros(0, np.uint8)])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _encoded(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits each, the last without the eighth; and how many bytes each takes."""
    lengths, rest = np.ones(len(flat), np.int64), flat >> np.uint64(7)
    while rest.any():
        lengths += rest > 0
        rest >>= np.uint64(7)
    ends = lengths.cumsum()
    at = ends - lengths
    out = np.empty(ends[-1], np.uint8)
    some, k = slice(None), 0
    while len(at[some]):
        more = lengths[some] > k + 1
        out[at[some] + k] = (flat[some] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8) << 7
        some, k = (lengths > k + 1).nonzero()[0], k + 1
    return out, lengths


def _decoded(data: np.ndarray) -> np.ndarray:
    ends = (data < 128).nonzero()[0]
    at = np.append(0, ends[:-1] + 1)[: len(ends)]
    flat, lengths = (data[at] & 127).astype(np.uint64), ends - at + 1
    some, k = (lengths > 1).nonzero()[0], 1
    while len(some):
        flat[some] |= (data[at[some] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
        k += 1
        some = some[lengths[some] > k]
    return flat


def unpack(coded: pa.Array, sizes: np.ndarray, first_doc: np.ndarray) -> list[np.ndarray]:
    """The four columns of all runs, one behind the other; ``sizes`` has how many postings each run has."""
    offsets = np.frombuffer(coded.buffers()[1], np.int32)[coded.offset : coded.offset + len(coded) + 1]
    data = np.frombuffer(coded.buffers()[2], np.uint8)
    begin = sizes.cumsum() - sizes
    step, lines, pos, n = found = [np.empty(sizes.sum(), np.uint64) for _ in COLUMNS]
    # Runs of about so many postings at once.
    cuts = np.unique(np.searchsorted(begin, np.arange(0, sizes.sum() + _AT_ONCE, _AT_ONCE)))
    for one, next_ in zip(cuts[:-1], cuts[1:], strict=True):
        flat = _decoded(data[offsets[one] : offsets[next_]]).reshape(-1, 4)
        for column, values in zip(found, flat.T, strict=True):
            column[begin[one] : begin[one] + len(flat)] = values
    new = np.zeros(len(step), bool)
    new[begin] = True
    steps = step.view(np.int64).cumsum()
    doc = steps + np.repeat(first_doc - steps[begin], sizes)
    again = (new | (step != 0)).nonzero()[0]
    moves = lines.view(np.int64).copy()
    moves[again] = _unfolded(lines[again])
    so_far = moves.cumsum()
    line = so_far + np.repeat(moves[again] - so_far[again], np.diff(np.append(again, len(step))))
    return [doc, line, _unfolded(pos), _unfolded(n)]
