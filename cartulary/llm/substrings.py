"""Exact substring dedup: two-stage suffix sorting of the places that can repeat.

Every string of ``LENGTH`` bytes owns the least hash of the ``GRAM``-byte grams in
it (its anchor), so that equal strings have equal anchors at equal offsets.  Strings
next to each other with one anchor form a context.

1. Documents are scanned for contexts; (anchor, digest of the context, place) go, packed
   by anchor range, to one task a range, which finds the anchors of several contexts.
   Contexts whose digest an earlier one has are taken to be its copies; neighbours
   that copy neighbours are joined to runs.
2. Contexts that share an anchor but differ, and the runs with what they copy, are cut
   from their documents.  The former are suffix-sorted together: directly only the
   suffixes smaller than their successors, the rest induced by bucket scans.  Adjacent
   suffixes with a common prefix of ``LENGTH`` bytes or more are equal strings, of which
   all but the earliest repeat.  A run repeats if its bytes are those of what it copies;
   one whose digests clashed is cut into its contexts again, which are sorted like others.
   Contexts of an anchor with more than ``CROWD`` different contexts are cut into
   their single strings, which go by their own digest to the sort.
3. The spans found are joined by document, united and cut out.

Defined cases: a null text is empty; documents of less than ``LENGTH`` bytes keep all;
rows with one doc_id but different texts are ordered by text hash; rows repeated whole
are one document, so that each gets the result of one; a null doc_id comes first; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cartulary.llm.shared import bounded_batches, drop_stash, stash, utf8_column

LENGTH, GRAM, CROWD = 100, 32, 2000
SCAN, SORT = 1 << 20, 1 << 19
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on, by doubling."""
    a, s, i = b.astype(np.uint64) + np.uint64(1), 1, 0
    while s < GRAM:
        a = a[:-s] * _ODD[i] + a[s:]
        a ^= a >> np.uint64(29)
        s, i = 2 * s, i + 1
    a *= np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(31)
    return a


def window_least(a: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` consecutive values, by doubling."""
    s = 1
    while 2 * s <= w:
        a, s = np.minimum(a[:-s], a[s:]), 2 * s
    return np.minimum(a[: len(a) - (w - s)], a[w - s :]) if s < w else a


def contexts(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, first starts and numbers of starts of the contexts of one document.

    The anchor of a string is its least gram, the last one among equals, so that one
    context has one anchor and no string twice.
    """
    if len(b) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    places, values = [], []
    low = np.uint64((1 << 21) - 1)
    for i in range(0, len(b) - LENGTH + 1, SCAN):
        a = gram_hashes(b[i : i + SCAN + LENGTH - 1])
        packed = (a & ~low) | (low - np.arange(len(a), dtype=np.uint64))
        at = (low - (window_least(packed, LENGTH - GRAM + 1) & low)).astype(np.int64)
        places.append(at + i)
        values.append(a[at])
    place, value = np.concatenate(places), np.concatenate(values)
    lo = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    return value[lo], lo, np.diff(np.append(lo, len(place)))


def suffix_order(t: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Positions of ``t``, or the ``wanted`` ones of them (a mask), in the order of their suffixes, right to ``depth`` bytes.

    Two-stage sorting: suffixes smaller than their successor are sorted directly.  A
    suffix that is not smaller stands in the bucket of its first byte before those
    that are, in the order of its successor, so that a scan of the buckets in
    ascending order induces it.  Of the others only those take part that a wanted one
    is induced from, through however many successors.
    """
    n = len(t)
    if n == 0:
        return np.zeros(0, np.int64)
    differ = np.flatnonzero(t[1:] != t[:-1])
    nxt = np.searchsorted(differ, np.arange(n - 1))
    small = np.zeros(n, bool)  # the last is greater than the empty rest
    has = nxt < len(differ)
    at = differ[nxt[has]]
    small[:-1][has] = t[at] < t[at + 1]
    part = np.ones(n, bool)
    if wanted is not None:  # from each wanted suffix on to the first that is sorted directly
        direct = np.append(np.flatnonzero(small), n - 1)
        i = np.flatnonzero(wanted)
        ends = np.where(small[i], i, direct[np.minimum(np.searchsorted(direct, i), len(direct) - 1)])
        steps = np.bincount(i, minlength=n + 1) - np.bincount(ends + 1, minlength=n + 1)
        part = np.cumsum(steps[:n]) > 0
    raw = t.tobytes()
    direct = np.array(sorted(np.flatnonzero(small & part).tolist(), key=lambda i: raw[i : i + depth]), np.int64)
    bounds = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if part[-1]:
        waiting[t[-1]].append(np.array([n - 1]))  # its successor is the empty suffix, the least of all
    out = []
    for c in range(256):
        wave, mine = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64), []
        while len(wave):  # runs of the byte c induce within the bucket
            mine.append(wave)
            j = wave - 1
            wave = j[(j >= 0) & (t[j] == c) & part[j]]
        bucket = np.concatenate([*mine, direct[bounds[c] : bounds[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        j = bucket - 1
        j = j[j >= 0]
        j = j[(t[j] > c) & part[j]]
        if len(j):
            first = t[j]
            order = np.argsort(first, kind="stable")
            j, first = j[order], first[order]
            heads = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for a, b in zip(heads, np.append(heads[1:], len(j))):
                waiting[first[a]].append(j[a:b])
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return found if wanted is None else found[wanted[found]]


def adjacent_equal(t: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix of ``order`` but the first shares ``length`` bytes with the one before it."""
    words = np.zeros(len(t) + 8, np.uint64)
    padded = np.concatenate([t, np.zeros(16, np.uint8)])
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + len(t) + 8]
    same = np.arange(1, len(order))
    for at in [*range(0, length - 8, 8), length - 8]:
        same = same[words[order[same] + at] == words[order[same - 1] + at]]
    out = np.zeros(max(len(order) - 1, 0), bool)
    out[same - 1] = True
    return out


def repeats(pieces: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int]]:
    """Runs (doc, start, end of starts) of the strings in ``pieces`` (doc, first start, number of starts, bytes)
    of which an equal string stands earlier (smaller doc, or smaller start) in the pieces."""
    if not pieces:
        return []
    t = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
    begin = np.cumsum([0, *(len(p[3]) for p in pieces)])[:-1]
    counts = np.array([p[2] for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), counts)
    own = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    slot = np.full(len(t), -1, np.int64)
    slot[begin[owner] + own] = np.arange(len(owner))
    order = suffix_order(t, LENGTH, slot >= 0)
    equal = adjacent_equal(t, order, LENGTH)
    kind = np.concatenate(([0], np.cumsum(~equal)))
    which = slot[order]
    doc = np.array([p[0] for p in pieces], np.int64)[owner[which]]
    start = np.array([p[1] for p in pieces], np.int64)[owner[which]] + own[which]
    by = np.lexsort((start, doc, kind))
    kind, doc, start = kind[by], doc[by], start[by]
    first = np.searchsorted(kind, kind)  # a place may be in several pieces
    again = (doc != doc[first]) | (start != start[first])
    d, s = doc[again], start[again]
    by = np.lexsort((s, d))
    return runs(d[by], s[by], s[by] + 1)


def runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int]]:
    """Unite touching ranges that are sorted by doc and lo."""
    if not len(doc):
        return []
    fresh = np.concatenate(([True], doc[1:] != doc[:-1]))
    apart = np.cumsum(fresh) * (int(hi.max()) + 2)  # each document on a stretch of its own
    far = np.maximum.accumulate(hi + apart)
    new = np.flatnonzero(fresh | np.concatenate(([True], (lo + apart)[1:] > far[:-1])))
    return list(zip(doc[new].tolist(), lo[new].tolist(), np.maximum.reduceat(hi, new).tolist()))


# ---- stage 1: contexts of all documents, packed by anchor range ----

ENTRY = np.dtype([("anchor", "<u8"), ("digest", "<u8"), ("doc", "<i4"), ("lo", "<i4"), ("n", "u1")])
RUN = np.dtype([("doc", "<i4"), ("lo", "<i4"), ("n", "<i4"), ("odoc", "<i4"), ("olo", "<i4")])  # n starts from lo on copy those from olo on
FLUSH = 1 << 21


def _earliest(e: np.ndarray, ids: np.ndarray, hs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ordered by anchor, digest and place; a mask of the first of each (anchor, digest); and its index for each."""
    order = np.lexsort((e["lo"], hs[e["doc"]], ids[e["doc"]], e["digest"], e["anchor"]))
    e = e[order]
    i, h = ids[e["doc"]], hs[e["doc"]]
    first = np.ones(len(e), bool)
    first[1:] = (e["anchor"][1:] != e["anchor"][:-1]) | (e["digest"][1:] != e["digest"][:-1])
    row = np.ones(len(e), bool)  # False: the same place of a repeated row
    row[1:] = first[1:] | (i[1:] != i[:-1]) | (h[1:] != h[:-1]) | (e["lo"][1:] != e["lo"][:-1])
    e, first = e[row], first[row]
    return e, first, np.maximum.accumulate(np.where(first, np.arange(len(e)), 0))


def _copies(e: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Runs of the entries that aren't the first of their digest."""
    again = np.flatnonzero(~first)
    x, o = e[again], e[owner[again]]
    out = np.empty(len(again), RUN)
    out["doc"], out["lo"], out["n"], out["odoc"], out["olo"] = x["doc"], x["lo"], x["n"], o["doc"], o["lo"]
    out = out[np.lexsort((out["lo"], out["doc"]))]
    return joined(out, (out["doc"], out["odoc"]))


def joined(x: np.ndarray, same: tuple[np.ndarray, ...]) -> np.ndarray:
    """Unite consecutive runs that continue each other, and what they copy too."""
    if not len(x):
        return x
    new = np.ones(len(x), bool)
    new[1:] = (x["lo"][1:] != x["lo"][:-1] + x["n"][:-1]) | (x["olo"][1:] != x["olo"][:-1] + x["n"][:-1])
    for column in same:
        new[1:] |= column[1:] != column[:-1]
    at = np.flatnonzero(new)
    out = x[at].copy()
    out["n"] = np.add.reduceat(x["n"].astype(np.int64), at)
    return out


def _pack(ids: np.ndarray, hs: np.ndarray, e: np.ndarray, copies: np.ndarray) -> bytes:
    used, doc = np.unique(np.concatenate([e["doc"], copies["doc"], copies["odoc"]]), return_inverse=True)
    e, copies = e.copy(), copies.copy()
    e["doc"], copies["doc"], copies["odoc"] = np.split(doc, [len(e), len(e) + len(copies)])
    parts = [np.array([len(used), len(e), len(copies)], "<i8").tobytes(), ids[used].tobytes(), hs[used].tobytes()]
    for x in (e, copies):  # columns: the values of one compress together
        parts += [x[name].tobytes() for name in x.dtype.names]
    return b"".join(parts)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n_docs, *counts = np.frombuffer(blob, "<i8", 3).tolist()
    at = 24
    out = []
    for _ in range(2):
        out.append(np.frombuffer(blob, "<i8", n_docs, at))
        at += 8 * n_docs
    for kind, n in zip((ENTRY, RUN), counts):
        x = np.empty(n, kind)
        for name in kind.names:
            x[name] = np.frombuffer(blob, kind[name], n, at)
            at += kind[name].itemsize * n
        out.append(x)
    return tuple(out)


def xxh3(piece) -> int:
    return xxhash.xxh3_64_intdigest(piece)


def _scan(buckets: int, digest: Callable):
    def flush(ids: list, hs: list, parts: list) -> pa.RecordBatch:
        i, h = np.array(ids, np.int64), np.array(hs, np.int64)
        e, first, owner = _earliest(np.concatenate(parts), i, h)
        copies, e = _copies(e, first, owner), e[first]
        key = (e["anchor"] >> np.uint64(20)) % np.uint64(buckets)
        copy_key = copies["doc"] % buckets
        rows = []
        order, copy_order = np.argsort(key, kind="stable"), np.argsort(copy_key, kind="stable")
        ends = np.searchsorted(key[order], np.arange(buckets + 1))
        copy_ends = np.searchsorted(copy_key[copy_order], np.arange(buckets + 1))
        for k in range(buckets):
            own, own_copies = e[order[ends[k] : ends[k + 1]]], copies[copy_order[copy_ends[k] : copy_ends[k + 1]]]
            if len(own) or len(own_copies):
                rows.append((k, _pack(i, h, own, own_copies)))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hs, parts, held = [], [], [], 0
        for b in batches:
            offsets, raw = utf8_column(b, "text")
            i, h = b.column("i").to_numpy(), b.column("h").to_numpy()
            for r in range(b.num_rows):
                t = raw[offsets[r] : offsets[r + 1]]
                anchor, lo, n = contexts(t)
                if not len(lo):
                    continue
                view, hi = memoryview(t), lo + n + (LENGTH - 1)
                e = np.empty(len(lo), ENTRY)
                e["anchor"], e["lo"], e["n"], e["doc"] = anchor, lo, n, len(ids)
                e["digest"] = [digest(view[x:y]) for x, y in zip(lo.tolist(), hi.tolist())]
                parts.append(e)
                ids.append(i[r])
                hs.append(h[r])
                held += len(e)
                if held >= FLUSH:
                    yield flush(ids, hs, parts)
                    ids, hs, parts, held = [], [], [], 0
        if parts:
            yield flush(ids, hs, parts)

    return run


COPY, SHARED, CROWDED = 0, 1, 2
ACTIONS = "i long, h long, lo int, n int, kind int, anchor long, oi long, oh long, olo int"


def _meet(crowd: int):
    """What becomes of the contexts of each bucket; a task's buckets come one after the other."""

    def out(i, h, x, kind, anchor, oi, oh, olo) -> Iterator[pa.RecordBatch]:
        columns = [i, h, x["lo"], x["n"].astype(np.int32), kind.astype(np.int32), anchor, oi, oh, olo]
        for a in range(0, len(x), 1 << 16):
            part = [pa.array(np.ascontiguousarray(c[a : a + (1 << 16)])) for c in columns]
            yield pa.RecordBatch.from_arrays(part, [f.split()[0] for f in ACTIONS.split(", ")])

    def solve(ids: list, hs: list, parts: list) -> Iterator[pa.RecordBatch]:
        i, h = np.concatenate(ids), np.concatenate(hs)
        e, first, owner = _earliest(np.concatenate(parts), i, h)
        if not len(e):
            return
        starts = np.flatnonzero(np.concatenate(([True], e["anchor"][1:] != e["anchor"][:-1])))
        kinds = np.add.reduceat(first.astype(np.int64), starts)
        kinds = np.repeat(kinds, np.diff(np.append(starts, len(e))))
        kind = np.where(~first, COPY, np.where(kinds > crowd, CROWDED, SHARED))
        keep = ~first | (kinds > 1)
        x, o = e[keep], e[owner][keep]
        yield from out(i[x["doc"]], h[x["doc"]], x, kind[keep], x["anchor"].view(np.int64), i[o["doc"]], h[o["doc"]], o["lo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hs, parts, base, bucket = [], [], [], 0, None
        for b in batches:
            for k, blob in zip(b.column("bucket").to_pylist(), b.column("blob")):
                if k != bucket and parts:
                    yield from solve(ids, hs, parts)
                    ids, hs, parts, base = [], [], [], 0
                bucket = k
                i, h, e, copies = _unpack(blob.as_buffer())
                none = np.zeros(len(copies), np.int64)
                yield from out(i[copies["doc"]], h[copies["doc"]], copies, none, none, i[copies["odoc"]], h[copies["odoc"]], copies["olo"])
                e["doc"] += base
                base += len(i)
                ids.append(i)
                hs.append(h)
                parts.append(e)
        if parts:
            yield from solve(ids, hs, parts)

    return run


# ---- stage 2: what shares an anchor is cut from the documents and sorted, what copies is compared ----

LONGEST = 1 << 15  # starts of a run that is compared at once
PIECES_HELD = 1 << 22  # bytes of pieces that a task gathers before it hands them on
NEEDS = "array<struct<lo:int,n:int,kind:int,anchor:long>>"
RUNS = "array<struct<lo:int,n:int,oi:long,oh:long,olo:int>>"


def _plan(longest: int):
    """Per document the contexts that are to be sorted, and its copies joined to runs of at most ``longest`` starts."""
    return lambda batches: map(functools.partial(_planned, longest), batches)


def _lists(counts: list[int], kinds: dict[str, pa.DataType], columns: list[np.ndarray]) -> pa.Array:
    """An array of lists of structs, of ``counts`` elements each."""
    values = pa.StructArray.from_arrays([pa.array(c).cast(k) for c, k in zip(columns, kinds.values())], list(kinds))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts, dtype=np.int64))), pa.int32()), values)


def _planned(longest: int, b: pa.RecordBatch) -> pa.RecordBatch:
    acts = b.column("acts")
    cuts = acts.offsets.to_numpy()
    x = {name: acts.values.field(name).to_numpy(zero_copy_only=False) for name in ("lo", "n", "kind", "anchor", "oi", "oh", "olo")}
    owner = np.repeat(np.arange(len(acts)), np.diff(cuts))
    x = {name: v[cuts[0] : cuts[-1]] for name, v in x.items()}
    some = x["kind"] != COPY
    need = _lists(np.bincount(owner[some], minlength=len(acts)), {"lo": pa.int32(), "n": pa.int32(), "kind": pa.int32(), "anchor": pa.int64()}, [x[c][some] for c in ("lo", "n", "kind", "anchor")])
    some = np.flatnonzero(~some)
    some = some[np.lexsort((x["lo"][some], x["oh"][some], x["oi"][some], x["lo"][some] - x["olo"][some], owner[some]))]
    run = np.zeros(len(some), RUN)
    run["lo"], run["n"], run["olo"], run["doc"] = x["lo"][some], x["n"][some], x["olo"][some], np.arange(len(some))
    oi, oh, of = x["oi"][some], x["oh"][some], owner[some]
    run = joined(run, (oi, oh, of))
    parts = -(-run["n"] // longest)  # a long run is compared in parts
    at, step = np.repeat(np.arange(len(run)), parts), (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * longest
    first = run["doc"][at]
    columns = [run["lo"][at] + step, np.minimum(longest, run["n"][at] - step), oi[first], oh[first], run["olo"][at] + step]
    runs_ = _lists(np.bincount(of[first], minlength=len(acts)), {"lo": pa.int32(), "n": pa.int32(), "oi": pa.int64(), "oh": pa.int64(), "olo": pa.int32()}, columns)
    return pa.RecordBatch.from_arrays([b.column("i"), b.column("h"), need, runs_], ["i", "h", "needs", "runs"])


SORTED, COPIED, ASKED = 0, 1, 2
PIECES = "side int, route long, i long, h long, lo int, n int, oi long, oh long, olo int, piece binary"


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in PIECES.split(", ")])


class _Strings:
    """Single strings of the documents of a batch: the earliest of each, and the others, which repeat."""

    def __init__(self) -> None:
        self.seen: dict[bytes, tuple] = {}
        self.again: list[tuple] = []

    def add(self, t: np.ndarray, i: int, h: int, lo: int, n: int) -> None:
        for x in range(lo, lo + n):
            piece = t[x : x + LENGTH].tobytes()
            before = self.seen.get(piece)
            if before is None or (i, h, x) < before:
                self.seen[piece] = (i, h, x)
            if before is not None and before != (i, h, x):
                self.again.append((SORTED, 0, *max(before, (i, h, x)), 1, None, None, None, None))

    def rows(self) -> list[tuple]:
        return self.again + [(SORTED, xxh3(p) - (1 << 63), *at, 1, None, None, None, p) for p, at in self.seen.items()]


def _listed(column: pa.ListArray, *names: str) -> tuple[list[int], list[tuple]]:
    """Where the elements of each row begin, and the elements as tuples; a null row has none."""
    cuts = column.offsets.to_numpy()
    fields = (column.values.field(n).to_numpy(zero_copy_only=False)[cuts[0] : cuts[-1]].tolist() for n in names)
    return (cuts - cuts[0]).tolist(), list(zip(*fields))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of three sides: to be sorted by their route (without bytes: strings that an earlier piece of this task
    equals), copies, and what is asked for to compare them with."""
    for b in batches:
        offsets, raw = utf8_column(b, "text")
        rows, strings, held = [], _Strings(), 0
        ids, hs, view, more = b.column("i").to_pylist(), b.column("h").to_pylist(), memoryview(raw), LENGTH - 1
        need_at, needs = _listed(b.column("needs"), "lo", "n", "kind", "anchor")
        run_at, runs_ = _listed(b.column("runs"), "lo", "n", "oi", "oh", "olo")
        ask_at, asked = _listed(b.column("asked"), "lo", "n")
        for r, at in enumerate(offsets[:-1].tolist()):
            i, h = ids[r], hs[r]
            for lo, n, kind, anchor in needs[need_at[r] : need_at[r + 1]]:
                if kind == SHARED:
                    rows.append((SORTED, anchor, i, h, lo, n, None, None, None, bytes(view[at + lo : at + lo + n + more])))
                    held += n + more
                else:
                    strings.add(raw[at : offsets[r + 1]], i, h, lo, n)
            for lo, n, oi, oh, olo in runs_[run_at[r] : run_at[r + 1]]:
                rows.append((COPIED, None, i, h, lo, n, oi, oh, olo, bytes(view[at + lo : at + lo + n + more])))
                held += n + more
            for lo, n in asked[ask_at[r] : ask_at[r + 1]]:
                end = min(at + lo + n + more, int(offsets[r + 1]))
                rows.append((ASKED, None, i, h, lo, n, None, None, None, bytes(view[at + lo : end])))
                held += n + more
                if held > PIECES_HELD:
                    yield _pieces(rows)
                    rows, held = [], 0
            if held > PIECES_HELD:
                yield _pieces(rows)
                rows, held = [], 0
        yield _pieces(rows + strings.rows())


def _cut_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts and single strings of the ranges of documents whose digests clashed, to be sorted."""
    for b in batches:
        offsets, raw = utf8_column(b, "text")
        for r in range(b.num_rows):
            t, strings, rows = raw[offsets[r] : offsets[r + 1]], _Strings(), []
            i, h = b.column("i")[r].as_py(), b.column("h")[r].as_py()
            anchor, lo, n = contexts(t)
            wanted = np.zeros(len(t) + 1, bool)
            for x in b.column("ranges")[r].as_py():
                wanted[x["lo"] : x["lo"] + x["n"]] = True
            for k in np.flatnonzero(wanted[lo]).tolist():
                x, m = int(lo[k]), int(n[k])
                rows.append((SORTED, int(anchor[k : k + 1].view(np.int64)[0]), i, h, x, m, None, None, None, t[x : x + m + LENGTH - 1].tobytes()))
                strings.add(t, i, h, x, m)
            yield _pieces(rows + strings.rows())


SPANS = "i long, h long, lo int, hi int"


def _sorted_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of bytes that repeat among the pieces of a route; the pieces come in the order of their routes."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        held = list({row[:5]: row for row in rows}.values())  # a place once, however often its row occurs
        docs = sorted({(i, h) for _, i, h, *_ in held})
        rank = {d: k for k, d in enumerate(docs)}
        found = repeats([(rank[i, h], lo, n, piece) for _, i, h, lo, n, piece in held])
        columns = [[docs[d][0] for d, _, _ in found], [docs[d][1] for d, _, _ in found], [a for _, a, _ in found], [b + LENGTH - 1 for _, _, b in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["i", "h", "lo", "hi"])

    held, size = [], 0
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if size >= SORT and row[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield solve(held)


# ---- stage 3 ----


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        offsets, raw = utf8_column(b, "text")
        kept, removed, spans, digest = [], [], [], []
        for r, cut in enumerate(b.column("cut")):
            t = raw[offsets[r] : offsets[r + 1]]
            one = []
            if cut.is_valid and len(cut.values):
                lo, hi = (cut.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                order = np.argsort(lo, kind="stable")
                one = runs(np.zeros(len(lo), np.int64), lo[order], hi[order])
            parts, at = [], 0
            for _, lo, hi in one:
                parts.append(t[at:lo])
                at = hi
            parts.append(t[at:])
            rest = b"".join(p.tobytes() for p in parts)
            kept.append(rest)
            removed.append(len(t) - len(rest))
            spans.append(len(one))
            digest.append(hashlib.sha256(rest).hexdigest())
        size = pa.array(np.diff(offsets))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), size, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _tasks(docs: DataFrame) -> int:
    """Tasks that contexts are dealt to: the session's partitions, or more where the files are large."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size >> 27 if size < 1 << 60 else 0)


def remove_repeats(docs: DataFrame, crowd: int = CROWD, digest: Callable = xxh3, longest: int = LONGEST) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    bounded_batches(docs)
    n = _tasks(docs)
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = mine.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), F.xxhash64("text").alias("h"), "text")
    texts = keyed.select("i", "h", "text")
    packed = texts.mapInArrow(_scan(4 * n, digest), "bucket int, blob binary")
    actions = stash(packed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet(crowd), ACTIONS), "actions")
    acts = actions.groupBy("i", "h").agg(F.collect_list(F.struct("lo", "n", "kind", "anchor", "oi", "oh", "olo")).alias("acts"))
    plans = stash(acts.mapInArrow(_plan(longest), f"i long, h long, needs {NEEDS}, runs {RUNS}"), "plans")
    drop_stash(actions)
    wanted = plans.select(F.explode("runs").alias("r")).select(F.col("r.oi").alias("i"), F.col("r.oh").alias("h"), F.col("r.olo").alias("lo"), "r.n").distinct()
    asked = wanted.groupBy("i", "h").agg(F.collect_list(F.struct("lo", "n")).alias("asked"))
    work = stash(plans.join(asked, ["i", "h"], "full"), "work")
    cut = stash(texts.join(work, ["i", "h"]).mapInArrow(_cut, PIECES), "pieces")
    drop_stash(plans, work)

    # one row per copied run: what it copies is joined to it and compared; a row that occurs several times gives several
    place = ["oi", "oh", "olo", "n"]
    asked = cut.where(F.col("side") == ASKED).select(F.col("i").alias("oi"), F.col("h").alias("oh"), F.col("lo").alias("olo"), "n", F.col("piece").alias("other"))
    asked = stash(asked.dropDuplicates(place), "asked")  # bare sides, so that a place of very many copies can be split
    copied = cut.where(F.col("side") == COPIED).join(asked, place, "left")
    compared = stash(copied.select("i", "h", "lo", *place, (F.col("piece") == F.col("other")).alias("same")), "compared")
    to_sort = cut.where((F.col("side") == SORTED) & F.col("piece").isNotNull()).select("route", "i", "h", "lo", "n", "piece")
    lone = cut.where((F.col("side") == SORTED) & F.col("piece").isNull())
    differ = compared.where("not coalesce(same, false)")
    if not differ.isEmpty():
        both = differ.select("i", "h", "lo", "n").unionByName(differ.select(F.col("oi").alias("i"), F.col("oh").alias("h"), F.col("olo").alias("lo"), "n")).distinct()
        again = stash(both.groupBy("i", "h").agg(F.collect_list(F.struct("lo", "n")).alias("ranges")), "clashes")
        more = stash(texts.join(again, ["i", "h"]).mapInArrow(_cut_again, PIECES), "pieces-again")
        to_sort = to_sort.unionByName(more.where("piece is not null").select(*to_sort.columns))
        lone = lone.unionByName(more.where("piece is null"))
    spans = (
        to_sort.repartition(n, "route").sortWithinPartitions("route").mapInArrow(_sorted_repeats, SPANS)
        .unionByName(lone.select("i", "h", "lo", (F.col("lo") + LENGTH).alias("hi")))
        .unionByName(compared.where("same").select("i", "h", "lo", (F.col("lo") + F.col("n") + (LENGTH - 1)).alias("hi")))
    )
    cuts = stash(spans.groupBy("i", "h").agg(F.collect_list(F.struct("lo", "hi")).alias("cut")), "cuts")
    return keyed.join(cuts, ["i", "h"], "left").select("doc_id", "text", "cut").mapInArrow(
        _remaining, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
