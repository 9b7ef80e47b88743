"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``width`` bytes that covers it also starts earlier: in a smaller document, or earlier in
the same one. Strings are judged on the input and never cross documents.

1. Anchors. Each window of ``width`` bytes has one anchor, its smallest ``gram``-byte hash (the leftmost of ties), so
   equal windows have equal anchors at equal places. Consecutive windows with one anchor are a segment. Segments are
   met by their anchor's hash after the copies within a block of documents have been told off, so a common passage
   costs a row for each block and not for each copy.
2. Segments that share an anchor but differ elsewhere are fetched with their bytes from their blocks, one of each class
   of segments that are equal as a whole.
3. Suffix sort. The anchors' suffixes are sorted by a mergesort whose comparisons find the common extension by binary
   search over prefix polynomial hashes, in logarithmic steps. Neighbours' extensions and the hashes of what stands
   left of the anchor tell which windows are equal; the bytes of each pair so found are compared, and a hash that
   lied is settled by the bytes themselves.
4. The other members of such a class go with it, and so do the windows of anchors that very many different segments
   share (a line or the edges of a passage that a large part of the documents has), which are not met or sorted in one
   task but dealt out by 128 bits of hash, copies within a block told off first. A block that finds LOCAL of them sends
   the anchor's mark only, which makes all other blocks do the same.
5. Proof. What 4 says by hash alone is a claim until the bytes have been compared: within a block at once; across blocks
   each member is claimed equal to the one before it in its class, whose block sends the bytes to the member's. So every
   removal rests on bytes, and no block has to answer for a whole class. If a single claim fails, everything is done
   again with other hash functions. LOCAL and WIDE choose the way only.

Null and empty texts have no bytes. Texts under ``width`` bytes lose nothing. Rows that repeat a doc_id are told apart
by place only: of two rows with the same doc_id neither is earlier, except where a string starts earlier in the text.
Null doc_ids come first.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from meridian.llm.common import blocks, discard, pack, partitions, prepare, ragged, sole, unpack, written

WIDTH, GRAM = 100, 32
#: Segments under one anchor from which on their windows are dealt out by hash instead.
WIDE = 512
#: The same within one block: such segments do not even meet by anchor.
LOCAL = 32
#: Bytes that are hashed at once.
PIECE = 1 << 18
#: Text bytes for which there is a bucket at least.
BUCKET_BYTES = 64 << 20
#: Times that it is tried with other hash functions.
ATTEMPTS = 6
#: Text bytes of a block of documents.
BLOCK = 8 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_NONE = -(1 << 63)
U = np.uint64


@functools.cache
def _letters(which: int) -> np.ndarray:
    return np.random.default_rng(1234 + which).integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)


@functools.cache
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which] if which < 2 else int(np.random.default_rng(99 + which).integers(1 << 62, 1 << 63, dtype=U)) | 1
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        one = np.ones(1, U)
        return tuple(np.concatenate([one, np.cumprod(np.full(size, x, U))]) for x in (base, inverse))


class Prefix:
    """Prefix polynomial hashes of bytes; any substring's hash follows from two of them.

    local: every byte's place in its segment, where only substrings of segments are asked for; the tables of powers are
    then as long as a segment and not as the data.
    """

    def __init__(self, data: np.ndarray, which: int = 0, local: np.ndarray | None = None):
        size = 1 << max(19, len(data).bit_length()) if local is None else 1 << 8
        power, self.inverse = _powers(which, size)
        self.local = local
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(_letters(which)[data] * (power[: len(data)] if local is None else power[local]), out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if self.local is None:
            return (self.sums[end] - self.sums[start]) * self.inverse[start]
        # an empty substring may stand at a segment's end, which is the next one's start: any power will do for zero
        return (self.sums[end] - self.sums[start]) * self.inverse[self.local[np.minimum(start, len(self.local) - 1)]]

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.inverse[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@dataclass(frozen=True)
class Hashes:
    """Which hash functions, and how many of their bits count (fewer make them lie, which costs another attempt)."""

    seed: int = 0
    bits: int = 64

    def kept(self, x: np.ndarray) -> np.ndarray:
        return x & U((1 << self.bits) - 1)


def segments(data: np.ndarray, bounds: np.ndarray, width: int, gram: int, hashes: Hashes = Hashes()) -> tuple[np.ndarray, ...]:
    """Of the documents data[bounds[i]:bounds[i + 1]]: each segment's first window, number of windows, anchor place,
    anchor hash and hash of all its bytes. Long data is taken in overlapping pieces, which may cut a segment in two."""
    parts = []
    for at in range(0, max(1, len(data) - width + 1), PIECE):
        piece = data[at : at + PIECE + width - 1]
        n = len(piece) - width + 1
        if n <= 0:
            continue
        key = Prefix(piece, 2 * hashes.seed).grams(gram)
        low = (mix(key) & U(0xFFFFFFFF00000000)) | np.arange(len(key), dtype=U)
        span, have = width - gram + 1, 1
        while have * 2 <= span:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < span:
            low = np.minimum(low[: len(low) - (span - have)], low[span - have :])
        anchor = (low & U(0xFFFFFFFF)).astype(np.int64)[:n]
        change = np.zeros(n + 1, np.int32)
        a, b = bounds[:-1] - at, bounds[1:] - at - width + 1
        a, b = np.clip(a, 0, n), np.clip(b, 0, n)
        fits = b > a
        np.add.at(change, a[fits], 1)
        np.add.at(change, b[fits], -1)
        ok = np.cumsum(change[:-1]) > 0
        fresh = ok.copy()
        fresh[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
        starts = bounds[:-1] - at
        starts = starts[(starts >= 0) & (starts < n)]
        fresh[starts] &= ok[starts]
        fresh[starts[ok[starts]]] = True
        s = np.flatnonzero(fresh)
        if not len(s):
            continue
        stop = ok.copy()
        stop[:-1] &= ~ok[1:] | fresh[1:]
        count = np.flatnonzero(stop) - s + 1
        p = anchor[s]
        whole = mix(Prefix(piece, 2 * hashes.seed + 1)(s, s + count + width - 1) + (p - s).astype(U) * U(0x100000001B3) + count.astype(U))
        parts.append((s + at, count, p + at, hashes.kept(mix(key[p])), hashes.kept(whole)))
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(U), empty.astype(U)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _buffer(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes, the documents' bounds in them and the documents' ids."""
    parts = [x.encode() if x else b"" for x in rows.column("text").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    ids = np.array([_NONE if x is None else x for x in rows.column("doc_id").to_pylist()], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), bounds, ids


def _low6(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from6(x: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), 8), np.uint8)
    out[:, :6] = x
    return out.reshape(-1).view("<u8").astype(U)


def _firsts(keys: tuple[np.ndarray, ...], doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ordered by key, doc and pos; which of them begin a key; which come strictly after their key's first."""
    order = np.lexsort((pos, doc, *keys[::-1]))
    begin = np.ones(len(order), bool)
    if len(order):
        begin[1:] = False
        for k in keys:
            begin[1:] |= k[order[1:]] != k[order[:-1]]
    head = np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0)) if len(order) else order
    lead = order[head] if len(order) else order
    later = (doc[order] != doc[lead]) | (pos[order] != pos[lead])
    return order, begin, later


def _row(block: list, kind: list, bucket: list, blob: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array(block, pa.string()), "kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "blob": pa.array(blob, pa.binary())})


ROWS = "block string, kind int, bucket int, blob binary"
SEGMENTS, WHOLE, FETCH, SPREAD, BYTES, WINDOWS, PARTIAL, MARK, CLAIM, PROOF, LIE = range(11)


def equal(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray, other: np.ndarray | None = None) -> bool:
    """Whether data[x:x + length] are the bytes of other (data itself) at y, for all."""
    other = data if other is None else other
    step = max(1, (4 << 20) // int(length.max())) if len(length) else 1
    return all(np.array_equal(data[ragged(x[a : a + step], length[a : a + step])], other[ragged(y[a : a + step], length[a : a + step])]) for a in range(0, len(x), step))


def _joined_runs(at: np.ndarray, lead: np.ndarray, count: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of windows (``at`` ascends) that are claimed equal to those at ``lead``, neighbours joined: which rows begin
    a range, and the ranges' places, leads and windows."""
    at, lead, count = at.astype(np.int64), lead.astype(np.int64), count.astype(np.int64)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + count[:-1]) | (lead[1:] != lead[:-1] + count[:-1])
    if apart is not None:
        fresh[1:] |= apart[1:] != apart[:-1]
    first = np.flatnonzero(fresh)
    return first, at[first], lead[first], np.add.reduceat(count, first) if len(first) else count[:0]


def _claims(names: list[str], block: np.ndarray, at: np.ndarray, count: np.ndarray, member: np.ndarray, before: np.ndarray) -> list[tuple]:
    """Rows that claim ``member``'s windows equal to those of ``before``, for the blocks of the latter."""
    out = []
    order = np.lexsort((at[member], block[member], block[before]))
    member, before = member[order], before[order]
    leads, firsts = np.unique(block[before], return_index=True)
    for lead, a, b in zip(leads.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(member)]):
        m, p = member[a:b], before[a:b]
        own, number = np.unique(block[m], return_inverse=True)
        out.append((names[lead], CLAIM, 0, pack([names[i] for i in own.tolist()], number.astype(np.uint32), at[m].astype(np.uint32), at[p].astype(np.uint32), count[m].astype(np.uint8))))
    return out


def _anchors(width: int, gram: int, buckets: int, local: int, size: int, hashes: Hashes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches, size):
            passing = zlib.crc32(block.encode()) % buckets  # what only passes through is spread over the buckets
            data, bounds, ids = _buffer(rows)
            s, count, p, g, whole = segments(data, bounds, width, gram, hashes)
            where = np.searchsorted(bounds, s, side="right") - 1
            order, begin, later = _firsts((_low48(g), _low48(whole)), ids[where], s - bounds[where])
            lead = order[np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))[later]] if len(order) else order
            gone = np.sort(order[later])
            out = [(block, WHOLE, passing, pack(s[gone].astype(np.uint32), count[gone].astype(np.uint8)))] if len(gone) else []
            if not (np.array_equal(count[order[later]], count[lead]) and equal(data, s[order[later]], s[lead], count[lead] + width - 1)):
                out.append((block, LIE, passing, b""))
            left = np.sort(order[~later])
            _, place, many = np.unique(g[left], return_inverse=True, return_counts=True)
            hot = many[place] >= local
            if hot.any():
                out.append((block, SPREAD, passing, pack(s[left[hot]].astype(np.uint32), count[left[hot]].astype(np.uint8))))
                marks = np.unique(g[left[hot]])
                for b in np.unique((marks >> U(16)) % U(buckets)).tolist():
                    out.append((block, MARK, int(b), pack(_low6(marks[(marks >> U(16)) % U(buckets) == U(b)]))))
                left = left[~hot]
            to = (g[left] >> U(16)) % U(buckets)
            by = np.argsort(to, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(to.astype(np.int64), minlength=buckets))])
            for b in range(buckets):
                pick = left[by[cuts[b] : cuts[b + 1]]]
                if len(pick):
                    out.append((block, SEGMENTS, b, pack(*_delta(s[pick]), count[pick].astype(np.uint8), _low6(g[pick]), _low6(whole[pick]), *_documents(where[pick], ids, bounds))))
            yield _row(*map(list, zip(*out))) if out else _row([], [], [], [])

    return run


def _low48(x: np.ndarray) -> np.ndarray:
    return x & U(0xFFFFFFFFFFFF)


def _delta(x: np.ndarray) -> tuple[np.ndarray]:
    return (np.diff(x, prepend=0).astype(np.uint32),)


def _documents(where: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """The documents that rows lie in (where ascends): ids, starts and rows of each."""
    doc, rows = np.unique(where, return_counts=True)
    return np.diff(ids[doc], prepend=0), np.diff(bounds[doc], prepend=0).astype(np.uint32), rows.astype(np.uint32)


def _open_documents(ids: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.cumsum(ids), rows), np.repeat(np.cumsum(starts.astype(np.int64)), rows)


def _meet(wide: int):
    def run(rows: pa.Table) -> pa.Table:
        out = []
        parts, names, marks = [], [], [np.zeros(0, U)]
        for block, kind, blob in zip(rows.column("block").to_pylist(), rows.column("kind").to_pylist(), rows.column("blob").to_pylist()):
            if kind == MARK:
                marks.append(_from6(unpack(blob)[0]))
                continue
            if kind != SEGMENTS:
                out.append((block, kind, 0, blob))
                continue
            s, count, g, whole, *documents = unpack(blob)
            s = np.cumsum(s.astype(np.int64))
            doc, start = _open_documents(*documents)
            parts.append((s, count, _from6(g), _from6(whole), doc, s - start, np.full(len(s), len(names), np.int32)))
            names.append(block)
        if parts:
            s, count, g, whole, doc, pos, block = (np.concatenate(x) for x in zip(*parts))
            order, begin, later = _firsts((g, whole), doc, pos)
            reps = order[begin]
            fresh = np.concatenate([[True], g[reps][1:] != g[reps][:-1]])
            size = np.diff(np.append(np.flatnonzero(fresh), len(reps)))
            shared = np.repeat(size, size)
            kinds = np.full(len(s), -1, np.int8)
            at = np.flatnonzero(later)
            member, before = order[at], order[at - 1]
            alike = count[member] == count[before]
            if not alike.all():
                out.append((names[0], LIE, 0, b""))
            out += _claims(names, block, s, count, member[alike], before[alike])
            # rows that repeat a lead's doc and place go the lead's way
            leads, group = order[~later], (np.cumsum(begin) - 1)[~later]
            kinds[leads[shared[group] > 1]] = FETCH
            kinds[leads[((shared > wide) | np.isin(g[reps], np.concatenate(marks)))[group]]] = SPREAD
            for i in np.unique(block):
                for kind in (FETCH, SPREAD):
                    pick = np.flatnonzero((block == i) & (kinds == kind))
                    if len(pick):
                        pick = pick[np.argsort(s[pick])]
                        out.append((names[i], kind, 0, pack(s[pick].astype(np.uint32), count[pick].astype(np.uint8))))
        return pa.Table.from_batches([_row(*map(list, zip(*out))) if out else _row([], [], [], [])])

    return run


def _texts(keep: bool, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in blocks(batches, size):
            data, bounds, ids = _buffer(rows)
            carried = b""
            if keep:
                sink = pa.BufferOutputStream()
                others = rows.drop_columns(["doc_id", "text"])
                with pa.ipc.new_stream(sink, others.schema) as writer:
                    writer.write_table(others)
                carried = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_pydict({"block": pa.array([block]), "data": pa.array([pack(data.tobytes(), bounds, ids, carried)], pa.binary())})

    return run


def _open(texts: pa.Table, key) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    data, bounds, ids, carried = unpack(sole(texts.column("data").to_pylist(), str(key[0])))
    return np.frombuffer(data, np.uint8), bounds, ids, carried


def _fetch(width: int, gram: int, buckets: int, hashes: Hashes):
    def run(key, text: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.Table.from_batches([_row([], [], [], [])])
        data, bounds, ids, _ = _open(text, key)
        s, count, p, g, whole = segments(data, bounds, width, gram, hashes)
        out, block = [], str(key[0])
        for wanted in (FETCH, SPREAD):
            blobs = [unpack(b)[0] for k, b in zip(asked.column("kind").to_pylist(), asked.column("blob").to_pylist()) if k == wanted]
            if not blobs:
                continue
            pick = np.searchsorted(s, np.sort(np.concatenate(blobs)).astype(np.int64))
            where = np.searchsorted(bounds, s[pick], side="right") - 1
            if wanted == FETCH:
                to = ((g[pick] >> U(16)) % U(buckets)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                cuts = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=buckets))])
                for b in range(buckets):
                    rows = by[cuts[b] : cuts[b + 1]]
                    if len(rows):
                        x = pick[rows]
                        length = count[x] + width - 1
                        out.append((block, BYTES, b, pack(*_delta(s[x]), count[x].astype(np.uint8), (p[x] - s[x]).astype(np.uint8), _low6(g[x]), data[ragged(s[x], length)], *_documents(where[rows], ids, bounds))))
            else:
                at = ragged(s[pick], count[pick])
                one, two = (hashes.kept(_windows(data, at, width, 2 * hashes.seed + k)) for k in (0, 1))
                doc = np.searchsorted(bounds, at, side="right") - 1
                order, begin, later = _firsts((one, two), ids[doc], at - bounds[doc])
                if later.any():
                    lead = at[order[np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))[later]]]
                    gone = at[order[later]]
                    by = np.argsort(gone)
                    _, x, y, n = _joined_runs(gone[by], lead[by], np.ones(len(by), np.int64))
                    out.append((block, PARTIAL, 0, pack(*_runs(gone[by]))))
                    if not equal(data, x, y, n + width - 1):
                        out.append((block, LIE, 0, b""))
                left = np.sort(order[~later])
                to = (one[left] % U(buckets)).astype(np.int64)
                by = np.argsort(to, kind="stable")
                cuts = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=buckets))])
                for b in range(buckets):
                    x = left[by[cuts[b] : cuts[b + 1]]]
                    if len(x):
                        out.append((block, WINDOWS, b, pack(*_delta(at[x]), one[x], two[x], *_documents(doc[x], ids, bounds))))
        return pa.Table.from_batches([_row(*map(list, zip(*out))) if out else _row([], [], [], [])])

    return run


def _windows(data: np.ndarray, at: np.ndarray, width: int, which: int) -> np.ndarray:
    """The hashes of the windows that start at the ascending places ``at``."""
    out = np.zeros(len(at), U)
    for first in range(0, len(data), PIECE):
        a, b = np.searchsorted(at, [first, first + PIECE])
        if b > a:
            local = at[a:b] - first
            out[a:b] = mix(Prefix(data[first : first + PIECE + width], which)(local, local + width))
    return out


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending places as runs: starts and lengths."""
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
    return at[first].astype(np.uint32), np.diff(np.append(first, len(at))).astype(np.uint32)


def common(x: np.ndarray, y: np.ndarray, cap: np.ndarray, prefix: Prefix) -> np.ndarray:
    """The common extension of the suffixes at x and y, up to cap, by binary search over prefix hashes."""
    low, high = np.zeros(len(x), np.int64), cap.astype(np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = prefix(x, x + middle) == prefix(y, y + middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


def suffix_sort(data: np.ndarray, at: np.ndarray, room: np.ndarray, group: np.ndarray, local: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes data[at:at + room] in order within their groups, and each one's common extension with the one before.

    A bottom-up mergesort; all runs of a level merge at once. An element's place in the merged run is its own place
    plus the number of the other run's elements before it, found by binary search.
    """
    prefix = Prefix(data, 0, local)
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]])) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(order)))
    head, total = np.repeat(first, size), np.repeat(size, size)

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether x sorts before y; ties says what holds of equals."""
        cap = np.minimum(room[x], room[y])
        ext = common(at[x], at[y], cap, prefix)
        ended = ext == cap
        last = len(data) - 1
        a, b = data[np.minimum(at[x] + ext, last)], data[np.minimum(at[y] + ext, last)]
        return np.where(ended, np.where(room[x] == room[y], ties, room[x] < room[y]), a < b)

    run = 1
    while len(order) and run < size.max():
        live = np.flatnonzero(total > run)
        local = live - head[live]
        left = (local // run) % 2 == 0
        other = np.where(left, (local // run + 1) * run, (local // run - 1) * run)
        low = head[live] + np.minimum(other, total[live])
        high = head[live] + np.minimum(other + run, total[live])
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            # of the right run those strictly before it come first; of the left run equals do too
            goes = before(order[middle], order[live[open_]], ~left[open_])
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        place = head[live] + (local // (2 * run)) * (2 * run) + local % run + (low - base)
        merged = order.copy()
        merged[place] = order[live]
        order = merged
        run *= 2
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        x, y = order[:-1], order[1:]
        same = group[x] == group[y]
        ext = common(at[x], at[y], np.minimum(room[x], room[y]), prefix)
        true = _extension(data, at[x], at[y], np.minimum(room[x], room[y]), ext)
        ended = true == np.minimum(room[x], room[y])
        last = len(data) - 1
        sorted_ = np.where(ended, room[x] <= room[y], data[np.minimum(at[x] + true, last)] < data[np.minimum(at[y] + true, last)])
        wrong = np.unique(group[x][same & (~sorted_ | (true != ext))])
        lcp[1:] = np.where(same, true, 0)
        for k in wrong.tolist():  # a hash lied: this group by its bytes
            rows = np.flatnonzero(group[order] == k)
            raw = {i: data[at[i] : at[i] + room[i]].tobytes() for i in order[rows].tolist()}
            order[rows] = sorted(raw, key=raw.__getitem__)
            for r in rows[1:].tolist():
                a, b = raw[int(order[r - 1])], raw[int(order[r])]
                lcp[r] = next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
            lcp[rows[0]] = 0
    return order, lcp


def _extension(data: np.ndarray, x: np.ndarray, y: np.ndarray, cap: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """What is truly common: guess where the bytes agree that far, else counted from the bytes."""
    out = guess.copy()
    for a in range(0, len(x), 50_000):
        b = min(a + 50_000, len(x))
        at = ragged(x[a:b], guess[a:b])
        differ = data[at] != data[ragged(y[a:b], guess[a:b])]
        if differ.any():
            for i in np.unique(np.repeat(np.arange(a, b), guess[a:b])[differ]).tolist():
                n = int(cap[i])
                unequal = np.flatnonzero(data[x[i] : x[i] + n] != data[y[i] : y[i] + n])
                out[i] = unequal[0] if len(unequal) else n
    return out


def equal_windows(data: np.ndarray, base: np.ndarray, count: np.ndarray, off: np.ndarray, group: np.ndarray, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of segments data[base:base + count + width - 1] with an anchor ``off`` bytes in: the (segment, window) pairs whose
    string stands in a segment of the same anchor and a lower rank."""
    at, room = base + off, count + width - 1 - off
    length = count + width - 1
    fits = not len(length) or length.max() <= 256  # longer segments take tables as long as the data
    local = (np.arange(len(data), dtype=np.int32) - np.repeat(base.astype(np.int32), length)).astype(np.uint8) if fits else None
    order, lcp = suffix_sort(data, at, room, group, local)
    prefix = Prefix(data, 1, local)
    found_s, found_w = [], []
    fresh = np.concatenate([[True], group[order][1:] != group[order][:-1]]) if len(order) else np.zeros(0, bool)
    for o in range(int(off.max()) + 1 if len(off) else 0):
        has = (off[order] >= o) & (off[order] - o < count[order])
        rows = np.flatnonzero(has)
        if len(rows) < 2:
            continue
        run = np.cumsum(fresh | (lcp < width - o))[rows]
        seg = order[rows]
        left = prefix(at[seg] - o, at[seg])
        by = np.lexsort((rank[seg], left, run))
        begin = np.ones(len(by), bool)
        begin[1:] = (run[by][1:] != run[by][:-1]) | (left[by][1:] != left[by][:-1])
        lead = seg[by[np.maximum.accumulate(np.where(begin, np.arange(len(by)), 0))]]
        mine = seg[by]
        later = np.flatnonzero(rank[mine] > rank[lead])
        mine, lead = mine[later], lead[later]
        ok = np.ones(len(mine), bool)
        for a in range(0, len(mine), 20_000):
            m, l = mine[a : a + 20_000], lead[a : a + 20_000]
            span = np.arange(width)
            ok[a : a + 20_000] = (data[(at[m] - o)[:, None] + span] == data[(at[l] - o)[:, None] + span]).all(1)
        found_s.append(mine[ok])
        found_w.append(off[mine[ok]] - o)
        for i in mine[~ok].tolist():  # a hash lied: by the bytes
            w = data[at[i] - o : at[i] - o + width]
            if any(rank[j] < rank[i] and (data[at[j] - o : at[j] - o + width] == w).all() for j in seg[group[seg] == group[i]].tolist()):
                found_s.append(np.array([i]))
                found_w.append(np.array([off[i] - o]))
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_s), np.concatenate(found_w)) if found_s else (none, none)


def _rank(doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Dense ranks of (doc, pos)."""
    order = np.lexsort((pos, doc))
    step = np.ones(len(order), bool)
    step[1:] = (doc[order][1:] != doc[order][:-1]) | (pos[order][1:] != pos[order][:-1])
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def _compare(width: int):
    def run(rows: pa.Table) -> pa.Table:
        out, names, parts, wide = [], [], [], []
        for block, kind, blob in zip(rows.column("block").to_pylist(), rows.column("kind").to_pylist(), rows.column("blob").to_pylist()):
            if kind in (PARTIAL, LIE):
                out.append((block, kind, 0, blob))
            elif kind == BYTES:
                s, count, off, g, data, *documents = unpack(blob)
                s = np.cumsum(s.astype(np.int64))
                doc, start = _open_documents(*documents)
                parts.append((s, count.astype(np.int64), off.astype(np.int64), _from6(g), doc, s - start, np.full(len(s), len(names), np.int32), data))
                names.append(block)
            else:
                at, one, two, *documents = unpack(blob)
                at = np.cumsum(at.astype(np.int64))
                doc, start = _open_documents(*documents)
                wide.append((at, one, two, doc, at - start, np.full(len(at), len(names), np.int32)))
                names.append(block)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if parts:
            s, count, off, g, doc, pos, block, data = (np.concatenate(x) for x in zip(*parts))
            length = count + width - 1
            base = np.cumsum(length) - length
            seg, window = equal_windows(data, base, count, off, g, _rank(doc, pos + off), width)
            found.append((block[seg], s[seg] + window))
        if wide:
            at, one, two, doc, pos, block = (np.concatenate(x) for x in zip(*wide))
            order, _, later = _firsts((one, two), doc, pos)
            here = np.flatnonzero(later)
            out += _claims(names, block, at, np.ones(len(at), np.uint8), order[here], order[here - 1])
        if found:
            block, at = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((at, block))
            block, at = block[order], at[order]
            cuts = np.searchsorted(block, np.arange(len(names) + 1))
            for i, name in enumerate(names):
                if cuts[i + 1] > cuts[i]:
                    out.append((name, PARTIAL, 0, pack(*_runs(at[cuts[i] : cuts[i + 1]]))))
        return pa.Table.from_batches([_row(*map(list, zip(*out))) if out else _row([], [], [], [])])

    return run


def _prove(width: int):
    """Claims on a block's windows: their bytes, for the blocks that claim to have the same."""

    def run(key, text: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.Table.from_batches([_row([], [], [], [])])
        data, *_ = _open(text, key)
        names: dict[str, int] = {}
        parts = []
        for blob in asked.column("blob").to_pylist():
            own, number, at, lead, count = unpack(blob)
            parts.append((np.array([names.setdefault(n, len(names)) for n in own], np.int64)[number], at, lead, count))
        block, at, lead, count = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((at, block))
        block = block[order]
        first, at, lead, count = _joined_runs(at[order], lead[order], count[order], block)
        cuts = np.searchsorted(block[first], np.arange(len(names) + 1))
        out = []
        for i, name in enumerate(names):
            a, b = cuts[i], cuts[i + 1]
            out.append((name, PROOF, 0, pack(at[a:b].astype(np.uint32), count[a:b].astype(np.uint32), data[ragged(lead[a:b], count[a:b] + width - 1)])))
        return pa.Table.from_batches([_row(*map(list, zip(*out)))])

    return run


def _check(width: int):
    """Holds the bytes of proofs against a block's own."""

    def run(key, text: pa.Table, proofs: pa.Table) -> pa.Table:
        if not proofs.num_rows:
            return pa.Table.from_batches([_row([], [], [], [])])
        data, *_ = _open(text, key)
        out, block = [], str(key[0])
        for blob in proofs.column("blob").to_pylist():
            at, count, claimed = unpack(blob)
            at, length = at.astype(np.int64), count.astype(np.int64) + width - 1
            same = equal(data, at, np.cumsum(length) - length, length, claimed)
            out.append((block, PARTIAL, 0, pack(at.astype(np.uint32), count)) if same else (block, LIE, 0, b""))
        return pa.Table.from_batches([_row(*map(list, zip(*out)))])

    return run


KEPT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())])


def _cut(width: int, schema: pa.Schema, as_text: bool):
    def run(key, text: pa.Table, found: pa.Table) -> pa.Table:
        data, bounds, ids, carried = _open(text, key)
        change = np.zeros(len(data) + 1, np.int32)
        for blob in found.column("blob").to_pylist():
            at, count = unpack(blob)
            np.add.at(change, at, 1)
            np.add.at(change, at.astype(np.int64) + count + width - 1, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        del change

        def before(flags: np.ndarray) -> np.ndarray:
            """How many are set before each document's start and the end."""
            sums = np.cumsum(flags, dtype=np.int32)
            return np.where(bounds > 0, sums[np.maximum(bounds, 1) - 1], 0) if len(sums) else np.zeros(len(bounds), np.int64)

        total = before(gone).astype(np.int64)
        begin = gone.copy()
        begin[1:] &= ~gone[:-1]
        inner = bounds[:-1][bounds[:-1] < len(data)]
        begin[inner] = gone[inner]
        spans = before(begin).astype(np.int64)
        left = data[~gone].tobytes()
        ends = bounds - total
        kept = [left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        others = pa.ipc.open_stream(carried).read_all().columns if carried else []
        return pa.Table.from_arrays([*others, pa.array([None if x == _NONE else x for x in ids.tolist()], pa.int64()), pa.array(np.diff(bounds)), pa.array(np.diff(total)), pa.array(np.diff(spans)), pa.array([k.decode("utf-8", "ignore") for k in kept] if as_text else kept, schema.field("kept").type)], schema=schema)

    return run


def repeats(rows: DataFrame, width: int, gram: int, wide: int, local: int, block_bytes: int, hashes: Hashes) -> DataFrame | None:
    """The windows to remove of each block of rows (..., doc_id, text), a written table; None if a hash lied."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, 2 * partitions(spark), -(-size // BUCKET_BYTES))
    text = rows.mapInArrow(_texts(False, block_bytes), "block string, data binary")
    met = rows.mapInArrow(_anchors(width, gram, buckets, local, block_bytes, hashes), ROWS).groupBy("bucket").applyInArrow(_meet(wide), ROWS)
    met = written(met, "suffix-met")
    fetched = text.groupBy("block").cogroup(met.filter(F.col("kind").isin(FETCH, SPREAD)).groupBy("block")).applyInArrow(_fetch(width, gram, buckets, hashes), ROWS)
    # what is told off already only passes through; it is dealt out by block
    through = F.col("kind").isin(PARTIAL, LIE)
    compared = fetched.withColumn("bucket", F.when(through, F.pmod(F.hash("block"), F.lit(buckets))).otherwise(F.col("bucket"))).groupBy("bucket").applyInArrow(_compare(width), ROWS)
    compared = written(compared, "suffix-compared")
    told = met.filter(F.col("kind").isin(WHOLE, CLAIM, LIE)).unionByName(compared)
    proofs = text.groupBy("block").cogroup(told.filter(F.col("kind") == CLAIM).groupBy("block")).applyInArrow(_prove(width), ROWS)
    checked = text.groupBy("block").cogroup(proofs.groupBy("block")).applyInArrow(_check(width), ROWS)
    found = written(checked.unionByName(told.filter(F.col("kind") != CLAIM)), "suffix-found")
    discard(met, compared)
    return None if found.filter(F.col("kind") == LIE).limit(1).count() else found


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, wide: int = WIDE, local: int = LOCAL, keep: tuple[str, ...] = (), as_text: bool = False, block_bytes: int = BLOCK, bits: int = 64) -> DataFrame:
    """``keep`` columns, doc_id, n_bytes, n_removed, n_spans and the kept bytes of each row of docs; others are not read.

    as_text: ``kept`` is a string of the whole characters that are left; of a character cut in two nothing stays.
    bits: of the first attempt's hashes.

    docs must give the same rows in the same order each time it is read; otherwise the query fails.
    """
    if not 8 <= gram <= width <= 255:
        raise ValueError("8 <= gram <= width <= 255")
    prepare(docs.sparkSession)
    rows = docs.select(*keep, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if {"doc_id", "text", *KEPT.names} & {c.lower() for c in keep}:
        raise ValueError("keep names a column that is made here")
    last = T.StructField("kept", T.StringType() if as_text else T.BinaryType())
    schema = T.StructType([*rows.schema.fields[: len(keep)], *KEPT.fields[:-1], last])
    for attempt in range(ATTEMPTS):
        gone = repeats(rows, width, gram, wide, local, block_bytes, Hashes(attempt, bits if not attempt else 64))
        if gone is not None:
            break
    else:
        raise RuntimeError(f"hashes lied {ATTEMPTS} times")
    carried = rows.mapInArrow(_texts(bool(keep), block_bytes), "block string, data binary")
    return carried.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(_cut(width, to_arrow_schema(schema), as_text), schema)
