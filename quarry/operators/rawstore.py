"""The raw store: payloads by source and native id, written only when they change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import slugify
from quarry.operators.diff import kept_columns


def canonical_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Columns as one line of JSON: keys sorted, nulls kept, no blanks."""
    names = sorted(columns or df.columns)
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def content_hash(body: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(body, 256))


def payload_hash(df: DataFrame, columns: Sequence[str], volatile: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``hash`` of its payload columns, volatile dotted paths aside."""
    kept = kept_columns(df.select(*columns).schema, volatile)
    body = F.to_json(F.struct(*[kept[c].alias(c) for c in sorted(kept)]), {"ignoreNullFields": "false"})
    return df.withColumn("hash", content_hash(body))


def store_key(native_id: Column) -> Column:
    """Where an id is kept: itself if it can name a file, else as a slug; compared without case."""
    return F.lower(F.when(native_id.rlike(r"^[A-Za-z0-9._-]+$"), native_id).otherwise(slugify(native_id)))


def collisions(ids: DataFrame) -> DataFrame:
    """(key, n): keys that several native ids would share; writing them would lose records."""
    return ids.groupBy(store_key(F.col("native_id")).alias("key")).agg(F.countDistinct("native_id").alias("n")).where("n > 1")


def upsert(stored: DataFrame, listed: DataFrame, today: Column) -> DataFrame:
    """(native_id, hash, first_seen, action): what a listing does to the store: written, unchanged, or kept though unlisted.

    Both have native_id and hash; ``stored`` also first_seen, which stays for as long as the record does.
    """
    s = stored.select("native_id", F.col("hash").alias("old"), F.col("first_seen").alias("since"))
    j = s.join(listed.select("native_id", F.col("hash").alias("new")), "native_id", "full_outer")
    action = F.when(F.col("new").isNull(), "unlisted").when(F.col("old").isNull(), "written").when(F.col("old") != F.col("new"), "rewritten").otherwise("unchanged")
    return j.select("native_id", F.coalesce("new", "old").alias("hash"), F.coalesce("since", today).alias("first_seen"), action.alias("action"))


def finalize(after: DataFrame, failed: bool, keep_share: float = 0.8) -> tuple[DataFrame, str]:
    """(rows that stay, status) at the end of a listing.

    Unlisted records are deleted, unless the listing failed, or shrank below ``keep_share`` of what was
    stored: then nothing is, and the status is 'failed'. One row of counts comes to the driver.
    """
    n = after.agg(F.count(F.when(F.col("action") != "written", 1)).alias("stored"), F.count(F.when(F.col("action") != "unlisted", 1)).alias("listed")).first()
    if failed or n["listed"] < keep_share * n["stored"]:
        return after, "failed"
    return after.where("action != 'unlisted'"), "ok"


def scan(raw: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Stored payloads that the manifest names, or all where there is none."""
    if manifest is None:
        return raw
    return raw.join(manifest.select("source", "native_id").distinct(), ["source", "native_id"], "left_semi")


def point_read(raw: DataFrame, source: str, native_id: str) -> DataFrame:
    """The one payload of an id; partition pruning by source, then a pushed filter."""
    return raw.where((F.col("source") == source) & (F.col("native_id") == native_id))
