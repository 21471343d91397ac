"""Finding the same thing twice: clusters by keys, candidate matches, cohorts, titles that collide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.keys import title_fingerprint
from quarry.operators.components import connected_components


def key_edges(records: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """(src, dst): each record with the least id that has the same key, for any of several keys; null keys match nothing.

    Keys are unpivoted and grouped, so a key of many records gives a star and not all pairs.
    """
    made = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("key")) for k, v in keys.items()])
    long = records.select("id", F.inline(made)).where("key IS NOT NULL")
    least = long.groupBy("kind", "key").agg(F.min("id").alias("dst"), F.count("*").alias("n")).where("n > 1").drop("n")
    return long.join(least, ["kind", "key"]).where("id != dst").select(F.col("id").alias("src"), "dst").distinct()


def cluster(records: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """(id, cluster): records that keys connect, over any number of steps, named by their least id; singles name themselves."""
    found = connected_components(key_edges(records, keys)).withColumnRenamed("node", "id")
    return records.select("id").distinct().join(found, "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))


def title_collisions(records: DataFrame, title: Column) -> DataFrame:
    """(fingerprint, id): records of different sources whose titles have the same words. They are flagged, never merged."""
    named = records.select("id", "source", title_fingerprint(title).alias("fingerprint")).where("fingerprint IS NOT NULL")
    shared = named.groupBy("fingerprint").agg(F.min("source").alias("a"), F.max("source").alias("b")).where("a != b").select("fingerprint")
    return named.join(shared, "fingerprint", "left_semi").select("fingerprint", "id")


def remap_links(related: DataFrame, merged: DataFrame, known: DataFrame) -> DataFrame:
    """(id, pos, other, relation): links redirected to what their target was merged into.

    ``related`` has id, pos, other, relation; ``merged`` alias and target; ``known`` the ids that still are.
    Links to nothing or to the record itself go; of links to the same record the first stays.
    """
    moved = related.join(merged, F.col("other") == F.col("alias"), "left").select("id", "pos", F.coalesce("target", "other").alias("other"), "relation")
    alive = moved.where("other != id").join(known.select(F.col("id").alias("k")).distinct(), F.col("other") == F.col("k"), "left_semi")
    return alive.groupBy("id", "other").agg(F.min(F.struct("pos", "relation")).alias("f")).select("id", F.col("f.pos").alias("pos"), "other", F.col("f.relation").alias("relation"))


def same_cohort(left: DataFrame, right: DataFrame, on: Sequence[str] = ("family", "cohort")) -> DataFrame:
    """(id, other): records of two sources with the same lower-cased keys, in both directions, each once."""
    a = left.select(F.col("id").alias("a"), *[F.lower(c).alias(c) for c in on])
    b = right.select(F.col("id").alias("b"), *[F.lower(c).alias(c) for c in on])
    pairs = a.join(b, list(on)).where("a != b").select("a", "b").distinct()
    return pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other")))).alias("p")).select("p.*").distinct()


def candidates(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]) -> DataFrame:
    """(left_id, right_id): rows that agree on any of several pairs of keys: one equi-join for each, never a join on OR."""
    out = None
    for lk, rk in zip(left_keys, right_keys):
        one = left.select(F.col("id").alias("left_id"), F.col(lk).alias("k")).join(right.select(F.col("id").alias("right_id"), F.col(rk).alias("k")), "k").select("left_id", "right_id")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def best_candidates(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], *order: Column) -> DataFrame:
    """(left_id, right_id, and the right's other columns): for each left id the first row by ``order`` that agrees on any of several pairs of keys.

    The first of all matches is the first of each key's firsts, so a key keeps one right row before it is joined, and pairs
    (see ``candidates``) are never made. ``order`` names the right's columns, its id as right_id.
    """
    kept = [c for c in right.columns if c not in ("id", *right_keys)]
    out = None
    for lk, rk in zip(left_keys, right_keys):
        firsts = best_match(right.where(F.col(rk).isNotNull()).select(F.col(rk).alias("k"), F.col("id").alias("right_id"), *kept), "k", *order)
        one = left.select(F.col("id").alias("left_id"), F.col(lk).alias("k")).join(firsts, "k").drop("k")
        out = one if out is None else out.unionByName(one)
    return best_match(out, "left_id", *order)


def best_match(pairs: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key by ``order``, which must end in something unique."""
    return pairs.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__k = 1").drop("__k")


def shared_winners(best: DataFrame, key: str, winner: str) -> DataFrame:
    """(winner, n): winners of more than one key, which the caller must treat as an error."""
    return best.groupBy(winner).agg(F.countDistinct(key).alias("n")).where("n > 1")


def gated(listing: DataFrame, key: str, *taken: tuple[DataFrame, str]) -> DataFrame:
    """Rows of a listing that no taken table has, by its column: anti-joins one after another."""
    for other, column in taken:
        listing = listing.join(other.select(F.col(column).alias("__taken")).where("__taken IS NOT NULL").distinct(), F.col(key) == F.col("__taken"), "left_anti")
    return listing
