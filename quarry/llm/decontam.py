"""Benchmark decontamination: Wu-Manber search of the items' word windows in whole documents."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.tables import give_back, named, numbered, table, unused, utf8
from quarry.operators.state import cut

#: Bytes of a word stay, A-Z are lower-cased, every other ASCII byte parts words.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(_FOLD).split()


class Patterns:
    """The items of one block as word numbers, end to end: what a search engine is built from.

    ``number`` numbers the block's distinct words from 1; ``ids`` are the items' words, ``item`` says whose each word is,
    and ``first`` holds for each pattern length the places where a window starts.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], width: int):
        self.names = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        parts, at, first = [], 0, defaultdict(list)
        for _, text in items:
            seq = words(text)
            number = self.number
            parts.append(np.fromiter((number.setdefault(w, len(number) + 1) for w in seq), np.int32, len(seq)))
            if seq:
                m = min(width, len(seq))
                first[m].append(np.arange(at, at + len(seq) - m + 1, dtype=np.int32))
            at += len(seq)
        self.ids = np.concatenate([np.zeros(0, np.int32), *parts])
        self.item = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        self.engines = [WuManber(self.ids, self.item, np.concatenate(x), m) for m, x in sorted(first.items())]


class WuManber:
    """Many patterns of one length over sequences of word numbers.

    A block is the last two words of a window, known by a hash. ``shift`` tells for each hash how far the window may move
    when a block stands at its end: as far as the block's nearest place before a pattern's end, and past the
    block altogether if no pattern has it. Blocks that share a hash share the lesser shift, which is never too far.
    Where the shift is 0, the bucket of that suffix hash has the patterns that end so; they are compared word by word.
    Equal patterns are one, with the items that have it. All tables are arrays of fixed width.
    """

    def __init__(self, ids: np.ndarray, item: np.ndarray, first: np.ndarray, length: int):
        self.length, self.block, self.ids = length, min(2, length), ids
        self.bits = max(8, min(24, (4 * len(first)).bit_length()))
        self.shift = np.full(1 << self.bits, length - self.block + 1, np.uint8 if length < 256 else np.int64)
        for end in range(self.block, length + 1):
            np.minimum.at(self.shift, self._hash(ids, first + end), length - end)
        code = self._hash(ids, first + length)
        full = np.zeros(len(first), np.uint64)
        for t in range(length):
            full = (full ^ ids[first + t].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            full ^= full >> np.uint64(32)
        order = np.lexsort((item[first], full, code))
        first, code, full = first[order], code[order], full[order]
        same = np.r_[False, (full[1:] == full[:-1]) & (code[1:] == code[:-1])]
        at = np.flatnonzero(same)
        for t in range(length):  # equal hashes may be of different words
            same[at] &= ids[first[at] + t] == ids[first[at - 1] + t]
        group = np.cumsum(~same) - 1
        pairs = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (item[first[1:]] != item[first[:-1]])])
        self.first = first[~same]  # one place of each pattern, in the order of their buckets
        self.items = item[first[pairs]]
        self.items_of = np.searchsorted(group[pairs], np.arange(len(self.first) + 1)).astype(np.int32)
        self.bucket = np.searchsorted(code[~same], np.arange((1 << self.bits) + 1)).astype(np.int32)

    def _hash(self, seq: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the blocks that end before the places ``end``."""
        x = seq[end - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if self.block == 2:
            x = (x ^ x >> np.uint64(31)) + seq[end - 2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, seq: np.ndarray, stretch: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(start in ``seq``, number of the pattern) of every occurrence, overlaps included.

        Window ends are walked from many places at once, a stretch of ``stretch`` ends each, so that one step moves many windows.
        """
        m, n = self.length, len(seq)
        end = np.arange(m, n + 1, stretch)
        last = np.minimum(end + stretch, n + 1)
        starts, patterns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(end):
            code = self._hash(seq, end)
            move = self.shift[code].astype(np.int64)
            hit = np.flatnonzero(move == 0)
            if len(hit):
                which, pattern = _spread(self.bucket, code[hit])
                start = end[hit][which] - m
                for t in range(m - 1, -1, -1):  # word by word, as long as all agree
                    same = seq[start + t] == self.ids[self.first[pattern] + t]
                    start, pattern = start[same], pattern[same]
                starts.append(start)
                patterns.append(pattern)
            end = end + np.maximum(move, 1)
            live = end < last
            end, last = end[live], last[live]
        return np.concatenate(starts), np.concatenate(patterns)


def _spread(ends: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``groups``, member) for every member of each of ``groups``; group g has the numbers ends[g] to ends[g + 1]."""
    low = ends[groups].astype(np.int64)
    size = ends[groups + 1] - low
    return np.repeat(np.arange(len(groups)), size), np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())


def scan(texts: list[str | None], patterns: Patterns) -> list[tuple[int, list[tuple[int, int]], set[int]]]:
    """For each document its number of words, the spans (from, to) of words hit, merged, and the items found.

    Documents are laid end to end with a number between that no word has, so that no occurrence crosses them.
    """
    get = patterns.number.get
    seqs = [words(t) for t in texts]
    size = np.array([len(x) for x in seqs], np.int64)
    base = np.cumsum(size + 1) - size - 1
    seq = np.zeros(int(size.sum()) + len(seqs), np.int32)
    for x, at in zip(seqs, base.tolist()):
        seq[at : at + len(x)] = np.fromiter((get(w, 0) for w in x), np.int32, len(x))
    found: list[tuple[int, list[tuple[int, int]], set[int]]] = [(n, [], set()) for n in size.tolist()]
    step = np.zeros(len(seq) + 1, np.int64)
    for e in patterns.engines:
        start, pattern = e.find(seq)
        np.add.at(step, start, 1)
        np.add.at(step, start + e.length, -1)
        doc = np.searchsorted(base, start, side="right") - 1
        if len(doc):
            once = np.unique(doc << 32 | pattern)
            which, member = _spread(e.items_of, once & 0xFFFFFFFF)
            for d, i in zip((once >> 32)[which].tolist(), e.items[member].tolist()):
                found[d][2].add(patterns.names[i])
    edge = np.flatnonzero(np.diff(np.r_[False, np.cumsum(step) > 0, False])).reshape(-1, 2)
    doc = np.searchsorted(base, edge[:, 0], side="right") - 1
    for d, a, z in zip(doc.tolist(), (edge[:, 0] - base[doc]).tolist(), (edge[:, 1] - base[doc]).tolist()):
        found[d][1].append((a, z))
    return found


REPORT = "n_words long, spans array<struct<start:long,end:long>>, items array<long>, n_items long"
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.int64())), ("n_items", pa.int64())])


def item_blocks(benchmark: DataFrame, max_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The stated query set, in blocks of at most ``max_bytes`` of text (an item above that is a block of its own).

    Items with a null item_id are searched like any other. Rows come to the driver a partition
    at a time, and no more than one block is held there.
    """
    block: list[tuple[int | None, str | None]] = []
    size = 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        n = len(utf8(r["text"]))
        if block and size + n > max_bytes:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += n
    yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 16_000_000, report: str = "contamination") -> DataFrame:
    """Return ``docs`` and a struct ``report`` (n_words, spans of words hit, items found, sorted, n_items).

    Words are runs of bytes that are ASCII digits, ASCII letters (A-Z lower-cased) or not
    ASCII. A pattern is ``width`` consecutive words of an item, or all words of an item that
    has fewer but some. Whole documents are searched, in one narrow pass without a shuffle for
    each block of at most ``block_bytes`` of benchmark text; blocks after the first are searched
    one after another, with a checkpoint between. A block's tables are built once, on the driver, and a
    Python worker loads them once for all its tasks.

    Items with a null item_id hit like others and are together one of ``n_items``, but none of ``items``.
    Null and wordless texts have no words and no hits; equal items are each reported;
    repeated rows are searched each. Empty tables give what they hold: no rows, or no hits.
    Extra columns pass through; one that has the name of ``report`` is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(report)
    out_schema = T.StructType([*docs.schema.fields, T.StructField(report, T.StructType.fromDDL(REPORT))])
    found, at, last = docs, docs.columns.index("text"), len(docs.columns)  # the report comes last
    for k, block in enumerate(item_blocks(benchmark, block_bytes)):
        shared = spark.sparkContext.broadcast(Patterns(block, width))
        if k:  # one block at a time in a worker's memory
            found = cut(found)

        def search(batches, shared=shared, first=k == 0):
            patterns = shared.value
            for whole in batches:
                for s in range(0, whole.num_rows, 200):
                    batch = whole.slice(s, 200)
                    old = [None] * batch.num_rows if first else batch.column(last).to_pylist()
                    rows = []
                    for (n, spans, items), was in zip(scan(batch.column(at).to_pylist(), patterns), old):
                        if was:
                            spans = _union(spans, [(s["start"], s["end"]) for s in was["spans"]])
                            items |= {*was["items"], *([None] if was["n_items"] > len(was["items"]) else [])}
                        rows.append({"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(x for x in items if x is not None), "n_items": len(items)})
                    yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(rows, _ARROW)], names=out_schema.names)
            give_back()

        found = numbered(found).mapInArrow(search, out_schema)
    return found


def _union(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted([*a, *b]):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The pipeline's stage: documents that hold no passage of an item.

    Null and wordless texts stay; repeated rows share their fate; an empty benchmark drops nothing, and an empty table stays
    empty; extra columns pass through, whatever their names.
    """
    report = unused(docs.columns, "contamination")
    found = find_contamination(docs, benchmark, report=report)
    return found.where(F.size(named(report)["spans"]) == 0).select(*map(named, docs.columns))


def query(spark, sf_dir):
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))

    def digest(batches):
        for batch in batches:
            r = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_words": pa.array([x["n_words"] for x in r], pa.int64()),
                "n_hit": pa.array([sum(s["end"] - s["start"] for s in x["spans"]) for x in r], pa.int64()),
                "n_items": pa.array([x["n_items"] for x in r], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(sorted(map(str, x["items"]))).encode()).hexdigest() for x in r], pa.string()),
                "contaminated": pa.array([bool(x["spans"]) for x in r], pa.bool_()),
            })

    kind = T.StructType([found.schema["doc_id"], *T.StructType.fromDDL("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")])
    return found.select("doc_id", "contamination").mapInArrow(digest, kind)


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS pat
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, least(10, len(w)) AS m FROM bw WHERE len(w) > 0))
), g AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS pat
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)
), h AS (
  SELECT g.doc_id, g.i, g.m, p.item_id FROM g JOIN p ON g.m = p.m AND g.pat = p.pat
), n AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT dw.doc_id, len(dw.w) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n ON dw.doc_id = n.doc_id LEFT JOIN t ON dw.doc_id = t.doc_id
"""
