"""Suffix-array dedup: the collection's Burrows-Wheeler order and common prefixes, built column by column.

Substrings of ``span`` bytes that start in two places are found in the order of all suffixes.
The order is not built over the corpus as one string but over a collection of short
documents, inserting one symbol of each a round, from the last to the first: a new suffix goes
where its symbol and the place of the suffix behind it tell, and the common prefixes with
its neighbours are one more than the least on the way between theirs.

Texts are cut into blocks first, so that collections are independent of each other: a block is
a run of windows of ``span`` bytes with one minimiser, equal windows have equal minimisers, and so
all places of a window come to one collection. A block whose minimiser no other block has can
hold a repeated window only if its minimiser stands in it twice, as in a line of dashes; the others
of these stay behind. A collection's order and common prefixes are kept in files, which every round
reads and writes from end to end.
"""

from __future__ import annotations

import os
import struct
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from quarry.llm.tables import table, utf8
from quarry.operators.state import cut

SPAN, GRAM = 200, 48
RUN = 256  # windows in a block at most
_SEGMENT = 1 << 20
_COLLECTION = 1 << 19  # bytes of blocks that are ordered together, unless one minimiser has more
_HELD = 1 << 22  # bytes of one minimiser's blocks that are held in memory
_LEVELS = 64  # rounds of dealing by a further minimiser; by then blocks are single windows, and different ones have parted


class _Grams:
    """Hashes of all substrings of ``gram`` bytes, as differences of running sums of powers of an odd number."""

    def __init__(self, gram: int, seed: int):
        self.gram, self.base = gram, (0x9E3779B97F4A7C15 * (2 * seed + 1)) & (1 << 64) - 1 | 1
        self.mix = np.uint64((0xD6E8FEB86659FD93 * (2 * seed + 3)) & (1 << 64) - 1 | 1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def of(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.power) < n + 1:
            for name, base in (("power", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                p = np.full(n + 1 + n // 4, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        h = (total[self.gram :] - total[: n + 1 - self.gram]) * self.inverse[: n + 1 - self.gram]
        h ^= h >> np.uint64(29)
        h *= self.mix
        h ^= h >> np.uint64(32)
        return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: least of a tail of one stretch and a head of the next."""
    n = len(values)
    full = -(-n // width) * width
    rows = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def _twice(h: np.ndarray, least: np.ndarray, start: np.ndarray, n_windows: np.ndarray) -> np.ndarray:
    """Whether a block's minimiser stands at two or more places in it, as it does if two of its windows are equal."""
    width = len(h) - len(least) + 1
    n = np.zeros(len(start), np.int64)
    half = h.astype(np.uint32)  # half of the hash will do: a block that is kept for nothing is ordered for nothing
    rows, value = np.lib.stride_tricks.sliding_window_view(half, width), least.astype(np.uint32)
    for a in range(0, len(start), 1 << 12):  # places in the first window
        at = start[a : a + (1 << 12)]
        n[a : a + len(at)] = np.count_nonzero(rows[at] == value[at, None], axis=1)
    ends = np.r_[0, np.cumsum(h[width - 1 :] == least)]  # and those that a later window ends with
    return n + ends[start + n_windows] - ends[start + 1] > 1


def blocks_of(texts: list[bytes], grams: _Grams, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, minimiser, minimiser there twice) of the blocks of some texts, each window of a text in one block."""
    found: list[tuple[np.ndarray, ...]] = []
    part: list[bytes] = []
    whose: list[tuple[int, int]] = []
    size = 0

    def flush():
        data = np.frombuffer(b"".join(part), np.uint8)
        lengths = np.array([len(p) for p in part])
        ends = np.cumsum(lengths)
        n = len(data) - span + 1
        h = grams.of(data)
        least = _least(h, span - grams.gram + 1)
        piece = np.repeat(np.arange(len(part)), lengths)[:n]
        inside = np.arange(n) + span <= ends[piece]
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        at = np.flatnonzero(new)
        stop = np.flatnonzero(inside & np.r_[~inside[1:] | new[1:], True]) + 1
        n_windows = stop - at
        times = -(-n_windows // RUN)  # a run over RUN windows, as in a text of one byte, makes several blocks
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        rep = np.repeat(np.arange(len(at)), times)
        start = at[rep] + nth * RUN
        p = piece[start]
        text, base = np.array(whose).T
        held = np.minimum(n_windows[rep] - nth * RUN, RUN)
        found.append((text[p], start - (ends - lengths)[p] + base[p], held, least[start].view(np.int64), _twice(h, least, start, held)))

    for i, t in enumerate(texts):
        for s in range(0, len(t) - span + 1, _SEGMENT):
            part.append(t[s : s + _SEGMENT + span - 1])
            whose.append((i, s))
            size += len(part[-1])
            if size >= _SEGMENT:
                flush()
                part, whose, size = [], [], 0
    if part:
        flush()
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found))


def _least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low..high], both ends included, for many ranges."""
    out = np.empty(len(low), values.dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    now, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(now[low[at]], now[high[at] - width + 1])
        now = np.minimum(now[:-width], now[width:]) if len(now) > width else now
        width *= 2
    return out


def local_folder() -> str | None:
    """A folder for a task's own files: one of those that Spark itself spills to (None: the system's, outside of a task)."""
    return next(filter(os.path.isdir, os.environ.get("SPARK_LOCAL_DIRS", "").split(",")), None)


class Scratch:
    """The order of a growing collection of suffixes, in files that are read and written from end to end each round.

    For each suffix, in order, ``key`` has its first symbol << 32 | the place of the rest of it, which is the transform as
    a list of where each suffix's rest is; ``where`` the byte at which it starts; ``common`` the symbols
    that it shares with the suffix before it. Every round reads the old files in chunks and writes new ones, so memory is
    a chunk's, and what the collection's documents need. The files have no names, and go with the task.
    """

    TYPES = {"key": np.dtype("<i8"), "where": np.dtype("<i4"), "common": np.dtype("u1")}

    def __init__(self, chunk: int = 1 << 20):
        self.chunk = chunk
        self.files = {c: [tempfile.TemporaryFile(dir=local_folder(), buffering=0) for _ in range(2)] for c in self.TYPES}
        self.now = 0

    def _chunks(self, column: str) -> Iterator[np.ndarray]:
        f, kind = self.files[column][self.now], self.TYPES[column]
        f.seek(0)
        while raw := f.read(self.chunk * kind.itemsize):
            yield np.frombuffer(raw, kind)

    def _write(self, column: str, values: np.ndarray) -> None:
        self.files[column][1 - self.now].write(memoryview(np.ascontiguousarray(values, self.TYPES[column])))

    def _turn(self) -> None:
        """What was written is read from now on."""
        self.now = 1 - self.now
        for pair in self.files.values():
            pair[1 - self.now].seek(0)
            pair[1 - self.now].truncate()

    def start(self, empty: int) -> None:
        """No suffix but ``empty`` ones of no symbol, which come first: they have the places below ``empty`` and stand in no file."""
        self._turn()
        self._turn()
        self.empty, self.size, self.moved = empty, 0, None

    def insert(self, new: np.ndarray, at: np.ndarray, need: int) -> np.ndarray:
        """Insert sorted keys (first symbol << 32 | place of the rest), which start at bytes ``at``; their places in the new order.

        A suffix and the one before it share one symbol more than their rests do, if they begin alike: the
        least of ``common`` on the way between the rests.
        """
        low = np.int64((1 << 32) - 1)
        to, n_old, done = np.empty(len(new), np.int64), 0, 0
        previous, after_new = np.int64(-1), False
        near, left, right, parts = [], [], [], []
        for old in self._chunks("key") if self.size else (np.zeros(0, np.int64),):
            if self.moved is not None:  # the last round's insertions moved the rests
                old = old + self.moved[old & low]
            end = len(new) if n_old + len(old) == self.size else int(np.searchsorted(new, old[-1]))
            here = np.searchsorted(old, new[done:end]) + np.arange(end - done)
            is_old = np.ones(len(old) + end - done, bool)
            is_old[here] = False
            merged = np.empty(len(is_old), np.int64)
            merged[here], merged[is_old] = new[done:end], old
            self._write("key", merged)
            mark = np.zeros(len(merged) + 1, bool)  # new suffixes, and those right behind one
            mark[here] = mark[here + 1] = True
            mark[0] |= after_new
            beside = np.flatnonzero(mark[:-1])
            near.append(beside + n_old + done)
            left.append(np.where(beside > 0, merged[beside - 1], previous))
            right.append(merged[beside])
            to[done:end] = here + n_old + done
            if len(merged):
                previous, after_new = merged[-1], not is_old[-1]
            parts.append((done, end))
            n_old, done = n_old + len(old), end
        near, a, b = np.concatenate(near), np.concatenate(left), np.concatenate(right)
        alike = (a >> 32 == b >> 32) & (a >= 0)
        shared = alike.astype(np.int64)  # an empty rest shares nothing more
        longer = np.flatnonzero(alike & ((a & low) >= self.empty))
        shared[longer] = np.minimum(need, self._least((a[longer] & low) + 1 - self.empty, (b[longer] & low) - self.empty) + 1)
        self._merge(parts, to, at, near, shared)
        ins = to - np.arange(len(to))  # old places that the new ones stand before
        self.moved = np.zeros(self.empty + n_old, np.int32)
        np.cumsum(np.bincount(ins, minlength=n_old + 1)[:n_old], out=self.moved[self.empty :])
        self.size = n_old + len(new)
        return to + self.empty

    def _least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of ``common`` from first to last, both included, for many ranges; empty ranges have 255."""
        out, begin = np.full(len(first), 255, np.int64), 0
        for chunk in self._chunks("common"):
            here = np.flatnonzero((first < begin + len(chunk)) & (last >= begin) & (first <= last))
            if len(here):
                out[here] = np.minimum(out[here], _least_between(chunk, np.maximum(first[here] - begin, 0), np.minimum(last[here] - begin, len(chunk) - 1)))
            begin += len(chunk)
        return out

    def _merge(self, parts: list[tuple[int, int]], to: np.ndarray, at: np.ndarray, near: np.ndarray, shared: np.ndarray) -> None:
        """Write where and common with the new suffixes at ``to``, those of ``parts`` in each chunk, and ``shared`` at the places ``near``."""
        begin = 0
        chunks = zip(self._chunks("where"), self._chunks("common")) if self.size else ((np.zeros(0, np.int32), np.zeros(0, np.uint8)),)
        for (a, z), (where, common) in zip(parts, chunks):
            n = len(where) + z - a
            is_old = np.ones(n, bool)
            here = to[a:z] - begin
            is_old[here] = False
            w, c = np.empty(n, np.int32), np.empty(n, np.uint8)
            w[here], w[is_old], c[is_old] = at[a:z], where, common
            k = slice(*np.searchsorted(near, (begin, begin + n)))
            c[near[k] - begin] = shared[k]
            self._write("where", w)
            self._write("common", c)
            begin += n
        self._turn()

    def finished(self) -> tuple[np.ndarray, np.ndarray]:
        """(where, common) of all suffixes in order."""
        return tuple(np.concatenate([np.zeros(0, self.TYPES[c]), *self._chunks(c)]) for c in ("where", "common"))


def symbol_bytes(span: int) -> int:
    """Bytes of a symbol: the largest part of a window that goes into it four times or more."""
    return max(d for d in range(1, span // 4 + 1) if span % d == 0)


def symbols(data: np.ndarray, wide: int) -> np.ndarray:
    """A number for the ``wide`` bytes at each place, equal for equal bytes and in one order; past the last whole symbol, 0.

    Hashes give the order, and the bytes of equal ones are compared: a hash that two different symbols share is left for another.
    """
    n = len(data) - wide + 1
    out = np.zeros(len(data), np.int64)
    if n < 1:
        return out
    eight = np.zeros(len(data) + 8, np.uint64)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    for t in range(8):
        eight[: len(data)] |= padded[t : t + len(data)].astype(np.uint64) << np.uint64(8 * t)
    steps = [*range(0, wide - 7, 8)] + ([wide - 8] if wide > 8 and wide % 8 else [])
    for seed in range(1, 64):
        h = _grams(wide, seed).of(data)
        order = np.argsort(h)
        a, b = order[:-1], order[1:]
        new = h[b] != h[a]
        same = np.flatnonzero(~new)
        a, b = a[same], b[same]
        if wide < 8:
            ok = all((data[a + t] == data[b + t]).all() for t in range(wide))
        else:
            ok = all((eight[a + t] == eight[b + t]).all() for t in steps)
        if ok:
            out[order] = np.r_[0, np.cumsum(new)]
            return out
    raise ValueError("no hash tells the symbols apart")


_known_grams: dict[tuple[int, int], _Grams] = {}


def _grams(wide: int, seed: int) -> _Grams:
    return _known_grams.setdefault((wide, seed), _Grams(wide, seed))


def repeated_windows(blocks: list[bytes], weights: list[int], span: int = SPAN, scratch: Scratch | None = None) -> list[np.ndarray]:
    """For each block, runs (first, last) of windows of ``span`` bytes that weigh 2 or more in the collection.

    A symbol is ``symbol_bytes(span)`` bytes, and each block gives as many documents, one for each phase, so that every
    window is the first few symbols of one suffix. A round inserts one symbol of each document, and
    transform and common prefixes pass through the files of ``scratch``.
    """
    data = np.frombuffer(b"".join(blocks), np.uint8)
    lengths = np.array([len(b) for b in blocks])
    starts = np.cumsum(lengths) - lengths
    wide = symbol_bytes(span)
    symbol = symbols(data, wide) << 32
    phase = (starts[:, None] + np.arange(wide)).ravel()
    rounds = (np.repeat(starts + lengths, wide) - phase) // wide
    order = np.argsort(-rounds, kind="stable")
    phase, rounds = phase[order], rounds[order]
    last = phase + wide * (rounds - 1)
    m, low, need = len(phase), np.int64((1 << 32) - 1), span // wide

    files = scratch or Scratch()
    files.start(m)
    place = np.arange(m)
    for r in range(int(rounds[0])):
        live = int(np.searchsorted(-rounds, -r, side="left"))  # documents of over r symbols stand first
        at = last[:live] - wide * r
        new = symbol[at] | place[:live]
        by = np.argsort(new)
        place[by] = files.insert(new[by], at[by], need)
        # each document's suffix is where the next one's rest is

    where, common = files.finished()
    owner = np.repeat(np.arange(len(blocks)), lengths)
    group = np.cumsum(common < need)
    weight = np.bincount(group, weights=np.array(weights, np.float64)[owner[where]])
    many = where[(weight[group] >= 2) & ((starts + lengths)[owner[where]] - where >= span)]
    flag = np.zeros(len(data) + 1, np.int8)
    flag[many] = 1
    step = np.diff(np.r_[np.int8(0), flag])
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
    b = owner[first]
    runs = np.stack([first - starts[b], end - starts[b]], 1).astype("<i4")
    return np.split(runs, np.searchsorted(b, np.arange(1, len(blocks))))


def _ordered(rows: list[tuple[bytes, int, bytes, int]], span: int, scratch: Scratch | None) -> Iterator[tuple[bytes, int, np.ndarray]]:
    """(id, first byte in the block, runs) for blocks (bytes, weight, id, first byte); equal blocks are ordered once."""
    number: dict[bytes, int] = {}
    weights: list[int] = []
    for data, weight, _, _ in rows:
        i = number.setdefault(data, len(number))
        if i == len(weights):
            weights.append(0)
        weights[i] += weight
    runs = repeated_windows(list(number), weights, span, scratch)
    for data, _, name, base in rows:
        found = runs[number[data]]
        if len(found):
            yield name, base, found


def _collections(rows: Iterator[tuple[int, bytes, int, bytes, int]], span: int, level: int = 0, held: int = _HELD, scratch: Scratch | None = None) -> Iterator[tuple[bytes, int, np.ndarray]]:
    """Order blocks (minimiser, bytes, weight, id, first byte), which come sorted by minimiser, in collections.

    Several minimisers make one collection. One that has over ``held`` bytes of different
    blocks goes on in files: its windows are dealt by a further minimiser of other hashes,
    and the files are ordered one after another.
    """
    ready: list[tuple[bytes, int, bytes, int]] = []  # of whole minimisers
    group: dict[bytes, list[tuple[int, bytes, int]]] = {}
    size = mine = 0
    now, spool = None, None

    def spill():
        nonlocal mine, spool
        spool = spool or _Spool(level + 1, span, held, scratch)
        for data, all_of in group.items():
            for w, name, base in all_of:
                spool.add(data, w, name, base)
        group.clear()
        mine = 0

    def close():
        nonlocal size, mine
        if spool:
            spill()
            yield from spool.run()
        else:
            ready.extend((data, w, name, base) for data, all_of in group.items() for w, name, base in all_of)
            size += mine
        group.clear()
        mine = 0

    for minimiser, data, weight, name, base in rows:
        if minimiser != now:
            yield from close()
            now, spool = minimiser, None
            if size >= _COLLECTION:
                yield from _ordered(ready, span, scratch)
                ready, size = [], 0
        if data not in group:
            mine += len(data)
        group.setdefault(data, []).append((weight, name, base))
        if mine > held and level < _LEVELS:
            spill()
    yield from close()
    if ready:
        yield from _ordered(ready, span, scratch)


class _Spool:
    """Files of blocks, without names, where Spark itself spills; gone when they are read, or with the task."""

    FILES = 64

    def __init__(self, level: int, span: int, held: int, scratch: Scratch | None):
        self.level, self.span, self.held, self.scratch = level, span, held, scratch
        self.grams = _Grams(16, level)
        self.files = [tempfile.TemporaryFile(dir=local_folder()) for _ in range(self.FILES)]

    def add(self, data: bytes, weight: int, name: bytes, base: int) -> None:
        _, start, n, key, _ = blocks_of([data], self.grams, self.span)
        for s, k, w in zip(start.tolist(), key.tolist(), n.tolist()):
            piece = data[s : s + w + self.span - 1]
            self.files[k % self.FILES].write(struct.pack("<qqi16si", k, weight, base + s, name, len(piece)) + piece)

    def run(self) -> Iterator[tuple[bytes, int, np.ndarray]]:
        try:
            for f in self.files:
                f.seek(0)
                rows = []
                while head := f.read(40):
                    k, weight, base, name, n = struct.unpack("<qqi16si", head)
                    rows.append((k, f.tell(), n, weight, name, base))
                    f.seek(n, 1)
                rows.sort()

                def read(rows=rows, f=f):
                    for k, at, n, weight, name, base in rows:
                        f.seek(at)
                        yield k, f.read(n), weight, name, base

                yield from _collections(read(), self.span, self.level, self.held, self.scratch)
                f.close()
        finally:
            for f in self.files:
                f.close()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("document"), F.col("text"), F.col("doc_id")).alias("k2"), "doc_id", "text")


def _find_blocks(span: int):
    def run(batches):
        grams = _Grams(min(GRAM, span - 8), 0)
        for b in batches:
            for s in range(0, b.num_rows, 500):
                p = b.slice(s, 500)
                text, start, n, key, twice = blocks_of([utf8(t.as_py()) for t in p.column(2)], grams, span)
                if not len(text):
                    continue
                _, group, many = np.unique(key, return_inverse=True, return_counts=True)
                sure = (many[group] > 1) | twice
                one = np.full(len(many), -1)
                one[group[sure]] = np.flatnonzero(sure)
                one = one[one >= 0]
                at = pa.array(np.r_[text, text[one]])
                state = np.r_[np.where(sure, _SURE, _OPEN), np.full(len(one), _WITNESS)].astype(np.int8)
                columns = [np.r_[key, key[one]], p.column(0).take(at), p.column(1).take(at), np.r_[start, start[one]], np.r_[n, n[one]], state]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=["key", "k1", "k2", "start", "n", "state"])

    return run


BLOCK = "key long, k1 long, k2 long, start long, n long, state byte"
#: A block whose minimiser may be its own alone; one that surely shares it; and a word to the others that such a one is there.
_OPEN, _SURE, _WITNESS = 0, 1, 2


def _keep_shared(batches):
    """Of rows sorted by minimiser, those that have a neighbour with the same one, and those that are sure; witnesses stay behind."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            first = shared  # noqa: F821 whether the held row stays already
        else:
            first = False
        key = b.column(0).to_numpy()
        equal = key[1:] == key[:-1]
        state = b.column(5).to_numpy()
        near = np.r_[equal, False] | np.r_[first, equal]
        if b.num_rows > 1:
            keep = (near | (state == _SURE)) & (state != _WITNESS)
            yield b.filter(pa.array(np.r_[keep[:-1], False]))
        held, shared = b.slice(b.num_rows - 1, 1), bool(near[-1])
    if held is not None and (shared or state[-1] == _SURE) and state[-1] != _WITNESS:
        yield held


def _pieces(batch: pa.RecordBatch, span: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(row, minimiser, start, bytes) of the blocks of rows (text, blocks)."""
    lists = batch.column(1)
    rows = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    key, start, n = (x.to_numpy().tolist() for x in lists.flatten().flatten())
    now, text = -1, b""
    for row, k, a, w in zip(rows.tolist(), key, start, n):
        if row != now:
            now, text = row, utf8(batch.column(0)[row].as_py())
        yield row, k, a, text[a : a + w + span - 1]


def _blocks_with_bytes(span: int):
    """(key, data, weight): the bytes of documents' blocks, equal ones of a part of a batch once."""

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 500):
                found: dict[tuple[int, bytes], int] = defaultdict(int)
                for _, k, _, data in _pieces(b.slice(s, 500), span):
                    found[k, data] += 1
                if found:
                    keys, data = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary()), pa.array(list(found.values()), pa.int64())], names=["key", "data", "weight"])

    return run


def _places(span: int):
    """(name, k1, k2, start): where the blocks stand, by a 128-bit hash of their bytes."""

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 500):
                p = b.slice(s, 500)
                found = [(row, a, xxh3_128_digest(data)) for row, _, a, data in _pieces(p, span)]
                if found:
                    rows, start, names = zip(*found)
                    at = pa.array(rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), p.column(2).take(at), p.column(3).take(at), pa.array(start, pa.int64())], names=["name", "k1", "k2", "start"])

    return run


def _order_blocks(span: int, held: int):
    """Rows (key, data, weight), sorted by key, to (name, runs)."""

    def rows(batches):
        for b in batches:
            for k, d, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                yield k, d, w, xxh3_128_digest(d), 0

    def run(batches):
        out: dict[bytes, list[np.ndarray]] = {}
        for name, base, runs in _collections(rows(batches), span, held=held, scratch=Scratch()):
            out.setdefault(name, []).append(runs + np.int32(base))
            if len(out) >= 20_000:
                yield pack(out)
                out = {}
        if out:
            yield pack(out)

    def pack(out):
        return pa.RecordBatch.from_arrays([pa.array(list(out), pa.binary()), pa.array([np.unique(np.concatenate(x), axis=0).astype("<i4").tobytes() for x in out.values()], pa.binary())], names=["name", "runs"])

    return run


def _cut_text(span: int):
    """(doc_id, n_bytes, n_removed, spans, kept) of rows (doc_id, text, places with the runs of windows found there)."""
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 500):
                b = whole.slice(s, 500)
                texts = [utf8(t.as_py()) for t in b.column(1)]
                n = np.array([len(t) for t in texts], np.int64)
                base = np.cumsum(n + 1) - n - 1  # texts end to end, a byte between, so that no span crosses them
                lists = b.column(2)
                offsets = lists.offsets.to_numpy()
                doc = np.repeat(np.arange(b.num_rows), np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0))
                start, runs = lists.flatten().flatten()
                runs = [r.as_py() for r in runs]
                windows = np.frombuffer(b"".join(runs), "<i4").reshape(-1, 2).astype(np.int64)
                windows += np.repeat(start.to_numpy() + base[doc], [len(r) // 8 for r in runs])[:, None]
                step = np.zeros(int(n.sum()) + len(texts) + 1, np.int32)
                np.add.at(step, windows[:, 0], 1)
                np.add.at(step, windows[:, 1] + span, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False])).reshape(-1, 2)
                at = np.searchsorted(base, edge[:, 0], side="right") - 1
                ends = np.searchsorted(at, np.arange(len(texts) + 1))
                removed = np.bincount(at, weights=edge[:, 1] - edge[:, 0], minlength=len(texts)).astype(np.int64)
                kept = [t if not r else np.frombuffer(t, np.uint8)[~gone[a : a + len(t)]].tobytes() for t, r, a in zip(texts, removed.tolist(), base.tolist())]
                edge -= base[at][:, None]
                spans = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(edge[:, i])) for i in (0, 1)], ["start", "end"]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(removed), spans, pa.array(kept, pa.binary())], names=names)

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, held: int = _HELD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): each text as UTF-8 bytes without the bytes that a repeated string covers.

    A string of ``span`` bytes (a multiple of 8, at least 40) is repeated if it starts in two
    places of all texts, the same one included; places may overlap, none crosses documents, and all
    are judged on the input. ``spans`` are the maximal runs of bytes removed, ``kept`` the rest
    joined. Null and empty texts have no bytes; those under ``span`` bytes keep all. Repeated
    rows repeat each other's strings; a null doc_id is one like any other. An empty table gives an empty one. Extra columns are left out,
    whatever their names.

    Equal blocks are merged in each batch before they are dealt by minimiser; a minimiser
    with over ``held`` bytes of different blocks is dealt again, through files, by further minimisers. Only the blocks and
    runs of one document are gathered, with its text.
    """
    keyed = _keyed(docs.select("doc_id", "text"))
    found = keyed.select("k1", "k2", "text").mapInArrow(_find_blocks(span), BLOCK)
    # a hot minimiser's blocks are sure of it in their own batch: they are spread, and a witness a batch goes to its task
    to = F.when(F.col("state") == _SURE, F.xxhash64("k1", "k2", "start")).otherwise(F.col("key"))
    shared = cut(found.repartition(to).sortWithinPartitions("key").mapInArrow(_keep_shared, BLOCK))
    own = shared.groupBy("k1", "k2").agg(F.collect_set(F.struct("key", "start", "n")).alias("blocks")).select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), "blocks")
    rows = keyed.join(own, (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")))
    # both select doc_id, so that texts are shuffled once for this join and the last
    blocks = rows.select("text", "blocks", "doc_id").mapInArrow(_blocks_with_bytes(span), "key long, data binary, weight long")
    runs = blocks.repartition("key").sortWithinPartitions("key").mapInArrow(_order_blocks(span, held), "name binary, runs binary")
    places = rows.select("text", "blocks", "k1", "k2", "doc_id").mapInArrow(_places(span), "name binary, k1 long, k2 long, start long")
    covered = places.join(runs, "name").groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "runs")).alias("places"))  # equal rows have equal places
    covered = covered.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "places")
    whole = keyed.join(covered, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left").select("doc_id", "text", "places")
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return whole.mapInArrow(_cut_text(span), kind)


def query(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
