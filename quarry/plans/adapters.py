"""Data tables in the shape of a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import first_words

ACCESS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
DOMAINS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each order. Arrays are distinct and sorted; institutions are its first three suppliers by key.

    Lines meet their parts (a dimension, which adaptive execution broadcasts if it is small) and are
    then aggregated by order; columns that a query doesn't ask for are pruned with their aggregates.
    """
    line, part = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    lines = (
        line.join(part, line.l_partkey == part.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.sort_array(F.collect_set("p_type")).alias("modalities"),
            F.sort_array(F.collect_set("p_name")).alias("conditions"),
            F.slice(F.sort_array(F.collect_set("l_suppkey")), 1, 3).alias("suppliers"),
            F.min(F.year("l_shipdate")).alias("year_start"),
            F.max(F.year("l_shipdate")).alias("year_end"),
            F.sum("l_quantity").cast("long").alias("sample_size"),
        )
    )
    who = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    empty = F.array().cast("array<string>")
    institution = "array<struct<name:string,ror_id:string>>"
    return (
        read(spark, sf_dir, "orders")
        .join(who, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("id"),
            F.col("o_orderkey").alias("key"),
            F.col("o_custkey").alias("customer"),
            F.col("r_name").alias("source"),
            F.col("c_name").alias("name"),
            F.array("n_name").alias("countries"),
            F.array("c_mktsegment").alias("domains"),
            F.coalesce("modalities", empty).alias("modalities"),
            F.coalesce("conditions", empty).alias("conditions"),
            F.coalesce(F.transform("suppliers", lambda s: F.struct(F.concat(F.lit("Supplier "), s.cast("string")).alias("name"), F.lit(None).cast("string").alias("ror_id"))), F.array().cast(institution)).alias("institutions"),
            F.col("o_orderpriority").alias("access"),
            F.col("o_orderstatus").alias("species"),
            "year_start",
            "year_end",
            "sample_size",
            F.lit("active").alias("record_status"),
        )
    )


#: The same table for the oracle, as common table expressions named cat (one row each) and its exploded arrays.
ORDER_SQL = """
lines AS (
  SELECT l_orderkey, list_sort(list(DISTINCT p_type)) AS modalities, list_sort(list(DISTINCT p_name)) AS conditions,
    list_sort(list(DISTINCT l_suppkey))[1:3] AS suppliers, min(year(l_shipdate)) AS year_start, max(year(l_shipdate)) AS year_end,
    CAST(sum(l_quantity) AS BIGINT) AS sample_size
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey
), cat AS (
  SELECT 'order:' || o_orderkey AS id, o_orderkey AS key, o_custkey AS customer, r_name AS source, c_name AS name, n_name AS country, c_mktsegment AS domain,
    coalesce(modalities, []) AS modalities, coalesce(conditions, []) AS conditions, coalesce(suppliers, []) AS suppliers,
    o_orderpriority AS access, o_orderstatus AS species, year_start, year_end, sample_size
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lines ON o_orderkey = l_orderkey
)"""


def doc_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each document, with its labels where it has any."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        F.concat("source", F.lit(":"), F.col("doc_id").cast("string")).alias("id"),
        "doc_id",
        "source",
        first_words(F.col("text"), 10).alias("name"),
        first_words(F.col("text"), 40).alias("summary"),
        "text",
        F.col("lang").alias("species"),
        "quality",
        "toxic",
    )


DOC_SQL = r"""
docw AS (
  SELECT doc_id, source, text, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), doc AS (
  SELECT source || ':' || d.doc_id AS id, d.doc_id, source, array_to_string(w[1:10], ' ') AS name, array_to_string(w[1:40], ' ') AS summary, text, w, lang AS species, quality, toxic
  FROM docw d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""


def user_snapshot(spark: SparkSession, sf_dir: str, before: str) -> DataFrame:
    """One row for each user: the last event before a time, by time and id."""
    events = read(spark, sf_dir, "events").where(F.col("ts") < F.lit(before).cast("timestamp"))
    last = events.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value", "props"), F.struct("ts", "event_id")).alias("e"))
    return last.select(F.col("user_id").cast("string").alias("id"), "e.event_type", "e.value", F.from_json("e.props", "k int").alias("props"))


def user_snapshot_sql(before: str) -> str:
    """A select of (id, event_type, value, k) for the oracle."""
    return f"""SELECT CAST(user_id AS VARCHAR) AS id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts < TIMESTAMP '{before}') WHERE rn = 1"""
