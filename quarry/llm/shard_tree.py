"""Sharding by a hierarchical weighted hash tree, in DataFrame functions alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarry.operators.state import cut

SEED = 1729


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. ``name`` salts its draws; a leaf has a ``shard`` and its own weight."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    weight: float = 1.0

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def tree(shards: int, racks: int = 2, per_rack: int = 4) -> Node:
    """Equal weights: regions of ``racks`` racks of ``per_rack`` shards, filled in the order of shard numbers."""
    leaves = [Node(f"s{i}", shard=i) for i in range(shards)]
    rack = [Node(f"k{i // per_rack}", tuple(leaves[i : i + per_rack])) for i in range(0, shards, per_rack)]
    region = [Node(f"r{i // racks}", tuple(rack[i : i + racks])) for i in range(0, len(rack), racks)]
    return Node("root", tuple(region))


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own.

    A new branch changes the weight of no older subtree below the root, so a document that
    moves can only come to the new branch, whose one leaf is the new shard.
    """

    def leaves(n: Node) -> list[int]:
        return [n.shard] if n.shard is not None else [s for c in n.children for s in leaves(c)]

    new = max(leaves(root), default=-1) + 1
    return Node(root.name, (*root.children, Node(f"r+{new}", (Node(f"k+{new}", (Node(f"s{new}", shard=new, weight=weight),)),))))


def place(root: Node, key: Column) -> Column:
    """The shard of ``key``: at each level the child of least weighted draw, down to a leaf.

    A draw is exponential with the child's whole weight as its rate, so the least of a row of siblings wins in proportion
    to weight. The tree is one literal, children by node; a leaf is its own only child, so uneven
    branches end early. Children without weight hold nothing.
    """
    nodes: list[Node] = [root]
    rows: list[list[tuple[str, float, int]]] = []
    for n in nodes:  # breadth first; grows as it goes
        live = [c for c in n.children if c.total > 0]
        if n.children and not live:
            raise ValueError(f"{n.name} has no weight below it")
        at = len(nodes)
        rows.append([(c.name, c.total, at + i) for i, c in enumerate(live)] or [(n.name, 1.0, len(rows))])
        nodes.extend(live)

    def depth(n: Node) -> int:
        return 1 + max(map(depth, n.children)) if n.children else 0

    children = F.array(*[F.array(*[F.struct(F.lit(a).alias("name"), F.lit(w).alias("weight"), F.lit(k).alias("node")) for a, w, k in row]) for row in rows])

    def draw(c: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), c["name"], key), 11)
        return F.struct((-F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / c["weight"]).alias("draw"), c["node"].alias("node"))

    node = F.lit(0)
    for _ in range(depth(root)):
        node = F.array_min(F.transform(F.get(children, node), draw))["node"]
    return F.get(F.array(*[F.lit(n.shard).cast("int") for n in nodes]), node)


def shard_rows(docs: DataFrame, root: Node, grown: Node, slot_buckets: int = 256) -> DataFrame:
    """Return doc_id, size, text_crc32, law, shard, slot and grown_shard for every row of ``docs``.

    The law is ``key``: the doc_id and the tree decide, nothing else. ``size`` is the text's
    UTF-8 bytes (null: 0) plus 1; ``text_crc32`` of a null text is that of no bytes. Rows with
    the same doc_id, null included, share a shard and have slots of their own; equal rows may
    swap slots. An empty table gives an empty one; extra columns are left out.

    Slots are gapless from 0 in each shard without sorting a shard in one task: rows are
    numbered in ``slot_buckets`` hash buckets, after the counts of the buckets before them.
    The counts are at most shards x slot_buckets rows, which bounds the broadcast.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    base = base.withColumns({
        "shard": place(root, F.col("doc_id")).cast("int"),
        "grown_shard": place(grown, F.col("doc_id")).cast("int"),
        "__bucket": F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slot_buckets)),
    })
    base = cut(base)
    counts = base.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "text_crc32", "size")
    rows = base.join(F.broadcast(starts), ["shard", "__bucket"]).withColumn("slot", F.col("__start") + F.row_number().over(within) - 1)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def query(spark, sf_dir):
    from quarry.llm.tables import table

    root = tree(16)
    return shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), root, grow(root))
