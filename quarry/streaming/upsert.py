"""An extension: the raw store fed from a stream of payload files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import rawstore
from quarry.sources.envelopes import Snapshots

PAYLOAD = "native_id string, payload string, ts timestamp"


def upsert_batch(spark: SparkSession, root: str, batch: DataFrame, today: str) -> str | None:
    """Fold one batch into the store: the newest payload of each id; ids that aren't in the batch stay."""
    newest = batch.groupBy("native_id").agg(F.max_by("payload", F.struct("ts", "payload")).alias("payload"))
    listed = newest.withColumn("hash", rawstore.content_hash(F.col("payload")))
    store = Snapshots(spark, root)
    stored = store.read()
    if stored is None:
        stored = spark.createDataFrame([], "native_id string, payload string, hash string, first_seen string")
    after = rawstore.upsert(stored, listed, F.lit(today))
    if not after.where("action IN ('written', 'rewritten')").limit(1).count():
        return None
    bodies = stored.select("native_id", F.col("payload").alias("old")).join(listed.select("native_id", F.col("payload").alias("new")), "native_id", "full_outer")
    return store.write(after.drop("action").join(bodies.select("native_id", F.coalesce("new", "old").alias("payload")), "native_id").select("native_id", "payload", "hash", "first_seen"))


def run(spark: SparkSession, incoming: str, root: str, state: str, today: str) -> StreamingQuery:
    """Read what has come as JSON since the last run, upsert it batch by batch, and stop."""
    stream = spark.readStream.schema(PAYLOAD).json(incoming)
    return stream.writeStream.foreachBatch(lambda batch, _: upsert_batch(spark, root, batch.persist(), today)).option("checkpointLocation", state).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(start, event_type, n): events by tumbling window; the watermark bounds the state that late rows need."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n): each user's runs of events with no gap over ``gap``."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
