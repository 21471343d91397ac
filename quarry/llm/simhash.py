"""SimHash near-dedup: blocks of fingerprints by the pigeonhole principle, join on blocks, verify the distance."""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from quarry.llm.tables import give_back, named, table, utf8
from quarry.operators.components import connected_components
from quarry.operators.state import cut

_hash = partial(xxh64_intdigest, seed=42)
_CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's ``width``-word shingles."""
    words = utf8(text).lower().split()  # on bytes: A-Z, and the ASCII blanks
    if not words:
        return 0
    if len(words) < width:
        return _hash(b" ".join(words))
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for a in range(0, n, _CHUNK):
        part = words[a : min(a + _CHUNK, n) + width - 1]
        h = np.fromiter(map(_hash, map(b" ".join, zip(*(part[i:] for i in range(width))))), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keys, fp): the fingerprint's bits as a signed long."""

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), width) for t in b.column(0)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fp.view(np.int64))], names=["doc_id", *keys, "fp"])
        give_back()

    schema = T.StructType([*(docs.schema[c] for c in ("doc_id", *keys)), T.StructField("fp", T.LongType(), False)])
    return docs.select("text", "doc_id", *keys).mapInArrow(run, schema)


def masks(bits: tuple[int, ...], blocks: int, agree: int) -> list[int]:
    """Every choice of ``agree`` of ``blocks`` nearly equal blocks of the given bits, as a mask."""
    parts = [sum(1 << b for b in p) for p in map(list, np.array_split(np.array(bits, dtype=object), blocks))]
    return [sum(c) for c in combinations(parts, agree)]


def _star(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that span each cluster of one bucket, from its first member; no pair is written twice."""
    out, left = [], fps
    while left.size > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and left.size:
            near = np.bitwise_count(left ^ queue.pop()) <= distance
            if near.any():
                found = left[near]
                out += [(root, x) for x in found]
                queue += list(found)
                left = left[~near]
    return out


def _buckets(level: int, blocks: int, distance: int, most: int):
    """Turn rows (part, key, fp), sorted by bucket, into links; a bucket over ``most`` goes on to the next level."""
    agree = blocks - distance

    def rows(kind, part, key, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(np.asarray(part, np.int64)), pa.array(np.asarray(key, np.int64)), pa.array(np.asarray(a, np.int64)), pa.array(np.asarray(b, np.int64))], names=["kind", "part", "key", "a", "b"])

    def onward(part, key, fps):
        free = tuple(i for i in range(64) if not FIRST[part] >> i & 1)
        for j, m in enumerate(masks(free, blocks, agree)):
            n = len(fps)
            yield rows(1, np.full(n, part * 1000 + j), (fps & np.uint64(m | FIRST[part])).view(np.int64), fps.view(np.int64), fps.view(np.int64))

    FIRST = masks(tuple(range(64)), blocks, agree)

    def run(batches):
        held: list[np.ndarray] = []
        at = None
        size, over = 0, False

        def close():
            fps = np.concatenate(held)
            if over:
                yield from onward(*at, fps)
            elif fps.size > 1 and (links := _star(fps, distance)):
                a, b = np.array(links, np.uint64).T
                n = len(a)
                yield rows(0, np.zeros(n), np.zeros(n), np.ascontiguousarray(a).view(np.int64), np.ascontiguousarray(b).view(np.int64))

        for batch in batches:
            if not batch.num_rows:
                continue
            part, key = (batch.column(i).to_numpy() for i in (0, 1))
            fp = batch.column(2).to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
            ends = np.r_[starts[1:], len(fp)]
            single = (ends - starts == 1) & (starts > 0) & (ends < len(fp))  # whole buckets of one: nothing to link
            for s, e in zip(starts[~single].tolist(), ends[~single].tolist()):
                now = (int(part[s]), int(key[s]))
                if now != at:
                    if at is not None:
                        yield from close()
                    at, held, size, over = now, [], 0, False
                held.append(fp[s:e])
                size += e - s
                if level == 1 and size > most:  # bounded memory: hand on what is held, and the rest as it comes
                    over = True
                    yield from onward(*at, np.concatenate(held))
                    held = [fp[:0]]
                    size = most
        if at is not None:
            yield from close()

    return run


BUCKET = "kind int, part long, key long, a long, b long"


def near_links(fps: DataFrame, distance: int = 3, blocks: int = 6, most: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all within ``distance`` bits.

    Two fingerprints that differ in at most ``distance`` bits agree on at least
    ``blocks - distance`` of ``blocks`` blocks, so they share a bucket for some choice of
    blocks. Within a bucket the distance is checked and only links that span its clusters
    are written, never all pairs. A bucket of more than ``most`` fingerprints is not cut: its
    rows are dealt again by agreeing blocks of the bits that may still differ. With 6 blocks
    and 3 bits a bucket then has 48 fixed bits, so it can't hold over 2^16 fingerprints.
    """
    first = masks(tuple(range(64)), blocks, blocks - distance)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in first])).alias("part", "key"))
    keyed = keyed.select(F.col("part").cast("long").alias("part"), "key", "fp")
    one = keyed.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_buckets(1, blocks, distance, most), BUCKET)
    one = cut(one)
    rest = one.where("kind = 1").select("part", "key", F.col("a").alias("fp"))
    two = rest.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_buckets(2, blocks, distance, most), BUCKET)
    return one.where("kind = 0").select("a", "b").unionByName(two.select("a", "b")).distinct()


def _grouped(docs: DataFrame, width: int, distance: int, keys: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, keys, fp), the groups' fingerprints (fp, least, root), and the groups (root, component_id)."""
    rows = cut(fingerprints(docs, width, keys))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    member = connected_components(near_links(distinct.select("fp"), distance), "a", "b")
    names = distinct.join(member, distinct.fp == member.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    return rows, names, names.groupBy("root").agg(F.min("least").alias("component_id"))


def near_groups(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Words are runs of anything but ASCII blanks, A-Z lower-cased; a text of fewer than
    ``width`` words is one shingle, and one without words (null, empty) has fingerprint zero,
    which links like any other. Fingerprints link at ``distance`` or fewer differing bits;
    component_id is the smallest doc_id reachable over links, the row's own included.

    Copies collapse to one fingerprint before any link is sought, by a partial aggregate.
    Rows with a null doc_id belong to a group but never name it, unless it has no other.
    Repeated rows share their group. An empty table gives an empty one. Extra columns are left out.
    """
    rows, names, named = _grouped(docs, width, distance)
    return rows.join(names.join(named, "root").select("fp", "component_id"), "fp")


def stage(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: of each group the document with the smallest doc_id.

    A document is a doc_id and a text, known by two 64-bit hashes of both: repeated rows are one,
    and texts that share a doc_id are judged each. Of documents with the smallest doc_id in a
    group, or of a group whose doc_ids are all null, the one with the smallest hashes stays. Null and wordless texts are
    one group; an empty table stays empty; extra columns pass through, whatever their names.
    """
    # the caller's columns travel in one struct, so that no name of theirs meets a name used here
    key = [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("document"), F.col("text"), F.col("doc_id")).alias("k2")]
    keyed = docs.select(F.struct(*[named(c) for c in docs.columns if c != "text"]).alias("row"), named("doc_id").alias("doc_id"), named("text").alias("text"), *key)
    rows, names, groups = _grouped(keyed.drop("row"), 3, 3, ("k1", "k2"))
    grouped = rows.join(names.join(groups, "root").select("fp", "root", "component_id"), "fp")
    first = grouped.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("k1", "k2")).alias("k"))
    first = first.select(F.col("k.k1").alias("f1"), F.col("k.k2").alias("f2"))
    kept = keyed.join(first, (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")), "left_semi")
    return kept.dropDuplicates(["k1", "k2", "doc_id", "text"]).select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
