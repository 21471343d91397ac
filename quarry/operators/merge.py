"""Merging clusters of records into one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.keys import doi_key
from quarry.functions.text import rank, ranked

#: Array columns, the field of their items that names them (items may be bare strings), and what makes two names equal.
UNIONS = {
    "conditions": ("label", F.lower),
    "keywords": ("", lambda k: k),
    "countries": ("", lambda c: c),
    "institutions": ("name", lambda n: n),
    "authors": ("name", lambda n: n),
    "papers": ("doi", lambda d: F.coalesce(doi_key(d), d)),
    "related": ("id", lambda i: i),
}
FIRST_GIVEN = ("name", "url", "population", "sample_size", "sample_unit", "size_bytes", "license", "summary", "published", "version")


def ordered_union(items: Column, key) -> Column:
    """Items of an array, the first of each key, in the array's order: sorted by key, each beside the one before, then back in order."""
    keyed = F.array_sort(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))))
    beside = F.arrays_zip(keyed.alias("a"), F.concat(F.array(F.lit(None)), F.transform(keyed, lambda z: z["k"])).alias("b"))
    first = F.filter(beside, lambda z, i: z["a"].isNotNull() & ((i == 0) | ~z["a"]["k"].eqNullSafe(z["b"])))
    return F.transform(F.array_sort(F.transform(first, lambda z: F.struct(z["a"]["i"].alias("i"), z["a"]["x"].alias("x")))), lambda z: z["x"])


def _key(records: DataFrame, column: str):
    field, norm = UNIONS[column]
    bare = isinstance(records.schema[column].dataType.elementType, T.StringType)
    return lambda x: norm(x if bare else x[field])


def _says(value: Column) -> Column:
    """Not null, not empty, not zero."""
    return value.isNotNull() & ~value.cast("string").isin("", "0")


def merge_clusters(records: DataFrame, priority: Sequence[str], domains: Sequence[str], modalities: Sequence[str], access: Sequence[str]) -> DataFrame:
    """One record for each value of column ``cluster``, with ``members`` (ids, the primary first).

    The primary is of the source of best priority, by id of equals; others follow by id. Vocabulary
    fields are united in vocabulary order; other lists keep the primary's order and append
    what is new, without links into the cluster; a secondary's own DOI becomes a paper. Access is the strictest;
    if that is a secondary's, its notes come along where it has any. Status is needs_review if any
    member's is. Species and each end of the years are the first known ones, other scalars the first that
    say something. Scalars are minima, which combine before they are shuffled, so a cluster may be of any size;
    only lists and ids are gathered, and not at all if none is asked for. Singles pass through unchanged.

    Columns that are absent are left out; those without a rule are the primary's.
    """
    cols = [c for c in records.columns if c != "cluster"]
    lists = [c for c in cols if isinstance(records.schema[c].dataType, T.ArrayType)]
    scalars = [c for c in cols if c not in lists]
    place = F.when(rank(F.col("source"), priority) > 0, rank(F.col("source"), priority)).otherwise(len(priority) + 1)
    order = F.struct(place.alias("__p"), F.col("id").alias("__i"))
    held = F.struct(*[c for c in cols if c in lists or c in ("id", "dataset_doi")])
    says = {c: _says for c in FIRST_GIVEN} | {"species": lambda v: v != "unknown"} | {c: lambda v: v.isNotNull() for c in ("year_start", "year_end")}
    says = {c: f for c, f in says.items() if c in scalars}
    notes = [c for c in ("access", "access_notes", "access_howto") if c in cols]

    made = [F.count("*").alias("__n"), F.min(F.struct("__order", F.struct(*scalars).alias("r"))).alias("__first"), F.array_sort(F.collect_list(F.struct("__order", held.alias("r")))).alias("__all")]
    made += [F.min(F.when(f(F.col(c)), F.struct("id", "source", F.col(c).alias("v")))).alias(f"__said_{c}") for c, f in says.items()]
    if "access" in cols:
        made.append(F.min(F.when(F.col("access").isNotNull(), F.struct((-rank(F.col("access"), access)).alias("k"), "id", "source", F.struct(*notes).alias("r")))).alias("__strict"))
    if "record_status" in cols:
        made.append(F.max(F.col("record_status") == "needs_review").alias("__review"))
    gathered = records.withColumn("__order", order).groupBy("cluster").agg(*made)
    first = gathered.withColumn("__head", F.get(F.transform("__all", lambda m: m["r"]), F.lit(0)))
    rest = F.sort_array(F.transform(F.slice("__all", 2, F.size("__all")), lambda m: F.struct(m["r"]["id"].alias("i"), m["r"].alias("r"))))
    m = first.withColumn("__m", F.concat(F.array("__head"), F.transform(rest, lambda x: x["r"])))
    members, ids = F.col("__m"), F.transform("__m", lambda r: r["id"])

    primary = {c: F.col("__head")[c] if c in lists else F.col("__first")["r"][c] for c in cols}
    out = dict(primary)
    both = lambda c: F.flatten(F.transform(members, lambda r: F.coalesce(r[c], F.array().cast(records.schema[c].dataType))))
    for c, vocabulary in (("domains", domains), ("modalities", modalities), ("access_tiers", access)):
        if c in cols:
            out[c] = ranked(both(c), vocabulary)
    for c in UNIONS:
        if c in cols:
            out[c] = ordered_union(both(c), _key(records, c))
    if "related" in cols:
        other = _key(records, "related")
        out["related"] = F.filter(out["related"], lambda r: ~F.array_contains(ids, other(r)))
    if {"papers", "dataset_doi"} <= {*cols}:
        kind = records.schema["papers"].dataType.elementType
        dois = F.filter(F.transform(F.slice(members, 2, F.size(members)), lambda r: r["dataset_doi"]), lambda d: d.isNotNull())
        described = F.transform(dois, lambda d: F.struct(*[(d if f.name == "doi" else F.lit("describes") if f.name == "relation" else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind]))
        out["papers"] = ordered_union(F.concat(both("papers"), described), _key(records, "papers"))
    for c, f in says.items():
        out[c] = F.when(f(primary[c]), primary[c]).otherwise(F.coalesce(F.col(f"__said_{c}")["v"], primary[c]))
    if "access" in cols:
        strictest, escalator = -F.col("__strict")["k"], F.col("__strict")["r"]
        own = rank(primary["access"], access) == strictest
        out["access"] = F.when(own | (strictest <= 0), primary["access"]).otherwise(escalator["access"])
        for c in notes[1:]:
            out[c] = F.when(own, primary[c]).otherwise(F.coalesce(F.nullif(escalator[c], F.lit("")), primary[c]))
    if "record_status" in cols:
        out["record_status"] = F.when(F.col("__review"), "needs_review").otherwise(primary["record_status"])
    single = F.col("__n") == 1
    return m.select("cluster", ids.alias("members"), *[F.when(single, primary[c]).otherwise(out[c]).alias(c) for c in cols])


def exclusions(merged: DataFrame) -> DataFrame:
    """(native_id, reason) of members that were folded away."""
    return merged.select(F.explode(F.slice("members", 2, F.size("members"))).alias("native_id"), F.concat(F.lit("merged_into:"), F.get("members", F.lit(0))).alias("reason"))


def flag_collisions(records: DataFrame, collisions: DataFrame) -> DataFrame:
    """Active records whose title collides become needs_review."""
    hit = collisions.select(F.col("id").alias("__hit")).distinct()
    flagged = records.join(hit, F.col("id") == F.col("__hit"), "left")
    return flagged.withColumn("record_status", F.when(F.col("__hit").isNotNull() & (F.col("record_status") == "active"), "needs_review").otherwise(F.col("record_status"))).drop("__hit")


def fill_species(value: Column, *others: Column) -> Column:
    return F.coalesce(*[F.when(c != "unknown", c) for c in (value, *others)], value)
