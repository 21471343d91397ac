"""Dimension look-ups with known negatives, cached answers, retained sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill(records: DataFrame, label: Column, dimension: DataFrame, into: str) -> DataFrame:
    """``into`` filled from a dimension (key, value) where it is null; ``known`` tells a known negative from an unknown label.

    Keys are trimmed and lower-cased. A dimension row with a null value is a known negative: it fills nothing and
    needs no further look-up.
    """
    dim = dimension.select(F.lower(F.trim("key")).alias("__key"), F.col("value").alias("__value"), F.lit(True).alias("__known"))
    j = records.withColumn("__label", F.lower(F.trim(label))).join(dim, F.col("__label") == F.col("__key"), "left")
    return j.withColumn(into, F.coalesce(F.col(into), F.col("__value"))).withColumn("known", F.coalesce("__known", F.lit(False))).drop("__key", "__value", "__known", "__label")


def unknown(records: DataFrame, label: Column, dimension: DataFrame) -> DataFrame:
    """(key): distinct labels that the dimension hasn't answered, each to be looked up once."""
    keys = records.select(F.lower(F.trim(label)).alias("key")).where("key IS NOT NULL AND key != ''").distinct()
    return keys.join(dimension.select(F.lower(F.trim("key")).alias("key")), "key", "left_anti")


def cache_key(version: str, schema_hash: str, *parts: Column) -> Column:
    """Content address of a call: version, schema and canonical input."""
    return F.sha2(F.concat_ws("\n", F.lit(version), F.lit(schema_hash), *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def split_cache(inputs: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their output, misses) by column ``key``; hits never count against a cap on calls."""
    return inputs.join(cache.select("key", "output"), "key"), inputs.join(cache.select("key"), "key", "left_anti")


def batches(misses: DataFrame, size: int = 8, most: int | None = None) -> DataFrame:
    """Misses numbered into batches; with a cap on calls, the first ``most`` batches by key.

    Without a cap the numbers are drawn per hash bucket and need no global order.
    """
    from pyspark.sql import Window

    if most is not None:
        top = misses.orderBy("key").limit(most * size)
        return top.withColumn("batch", F.floor((F.row_number().over(Window.orderBy("key")) - 1) / size).cast("string"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(256))
    n = F.row_number().over(Window.partitionBy("__b").orderBy("key"))
    return misses.withColumn("__b", bucket).withColumn("batch", F.concat_ws("-", "__b", F.floor((n - 1) / size))).drop("__b")


def retain(fresh: DataFrame, previous: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of this run where a source is ok, the last run's where it failed, was skipped or wasn't asked.

    ``status`` has one row for each source (source, ok); a source without a row keeps its previous rows.
    """
    ok = status.where("ok").select(F.col("source").alias("__s"))
    keep = previous.join(ok, F.col("source") == F.col("__s"), "left_anti")
    return fresh.join(ok, F.col("source") == F.col("__s"), "left_semi").unionByName(keep)


def resolve_exact_alias_prefix(labels: DataFrame, terms: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(key, value): a label's term by its exact name, else by its alias's, else by the one term that starts with it.

    ``terms`` has name and value. A label that several terms start with, or none, is a known negative: its value is null.
    """
    from quarry.functions.text import alias

    t = terms.select(F.lower("name").alias("name"), "value")
    keyed = labels.select("key", F.lower(alias(F.col("key"), aliases)).alias("other"))
    exact = keyed.join(t, F.col("key") == F.col("name"), "left").select("key", "other", F.col("value").alias("v1"))
    by_alias = exact.join(t, F.col("other") == F.col("name"), "left").select("key", "v1", F.col("value").alias("v2"))
    # prefixes as an equi-join: every prefix of a term, of which the semi-join keeps those that are labels
    every = t.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("name")), lambda n: F.substring(F.col("name"), F.lit(1), n))).alias("key"), "value")
    heads = every.join(labels.select("key").distinct(), "key", "left_semi")
    one = heads.groupBy("key").agg(F.countDistinct("value").alias("n"), F.first("value").alias("v3")).where("n = 1").select("key", "v3")
    return by_alias.join(one, "key", "left").select("key", F.coalesce("v1", "v2", "v3").alias("value"))


AFFILIATION = "items array<struct<chosen:boolean,score:double,organization:struct<id:string,name:string,locations:array<struct<geonames_details:struct<country_code:string>>>>>>"


def affiliations(answers: DataFrame, least: float = 0.9) -> DataFrame:
    """(key, resolved, ror_id, name, country) from (key, body): a registry's JSON answers to names of institutions.

    Only the first item counts, and only if the registry chose it with a score of ``least``; without one the key is a known negative.
    A null body is a request that failed: ``resolved`` is false, and nothing may be remembered of it. Bodies that are no
    such JSON say nothing, as does an answer without items.
    """
    top = F.get(F.from_json("body", f"struct<{AFFILIATION.replace(' ', ':', 1)}>")["items"], F.lit(0))
    sure = F.coalesce(top["chosen"] & (top["score"] >= least), F.lit(False))
    given = lambda c: F.when(sure, c)
    place = F.get(top["organization"]["locations"], F.lit(0))
    return answers.select("key", F.col("body").isNotNull().alias("resolved"), given(top["organization"]["id"]).alias("ror_id"), given(top["organization"]["name"]).alias("name"), given(place["geonames_details"]["country_code"]).alias("country"))
