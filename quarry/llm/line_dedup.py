"""Line dedup: explode normalised lines, hash, count documents a hash, drop, reassemble by position."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import named, table, unused

BLANKS = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, salts: int = 8, report: str = "line_report") -> DataFrame:
    """Return ``docs`` with its lines thinned, and a struct ``report`` (n_lines, n_dropped).

    A line's key is the line stripped of ASCII blanks and with A-Z lower-cased. A key of at
    least ``min_chars`` code points in at least ``min_docs`` documents stays only in the
    documents of the largest ``doc_id`` that hold it; there every copy of it stays.

    Keys are compared by two 64-bit hashes. Counting is a partial aggregate, so a line that
    a third of all documents share shrinks before it is shuffled; the join that finds its
    places is salted ``salts`` ways, and where a salt's share is still large, adaptive execution splits it.
    Only places to drop are gathered, within one document.

    Null text is one empty line and comes back as an empty string. Each row is a document: repeated
    rows count each, and lose or keep the same lines. A null ``doc_id`` is smaller than any
    other. An empty table gives an empty one. Extra columns pass through, whatever their names; one that has the
    name of ``report`` is replaced.
    """
    columns = [c for c in docs.columns if c != report]
    # the caller's columns travel in one struct, so that no name of theirs meets a name used here
    base = docs.select(F.struct(*[named(c) for c in columns if c != "text"]).alias("row"), named("doc_id").alias("id"), named("text").alias("text"))
    keys = F.transform(split_lines(F.col("text")), line_key)
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2")]

    once = base.select("id", F.explode(F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))).alias("key"))
    shared = once.select("id", *hashes).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keep")).where(F.col("n") >= min_docs)
    shared = shared.select("h1", "h2", "keep", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))

    places = base.select(F.col("id").alias("its"), F.xxhash64("text").alias("hash"), F.posexplode(keys).alias("pos", "key")).where(F.length("key") >= min_chars)
    places = places.select("its", "hash", "pos", *hashes).withColumn("salt", F.pmod(F.xxhash64("its", "hash"), F.lit(salts)).cast("int"))
    dropped = places.join(shared, ["h1", "h2", "salt"]).where(~F.col("its").eqNullSafe(F.col("keep"))).groupBy("its", "hash").agg(F.collect_set("pos").alias("gone"))

    lines = split_lines(F.col("text"))
    joined = base.join(dropped, F.col("id").eqNullSafe(F.col("its")) & (F.xxhash64("text") == F.col("hash")), "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i))
    text = F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    counts = F.struct(F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
    return joined.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns], counts.alias(report))


def stage(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: the same rows and columns, fewer lines.

    Null texts come back empty; repeated rows keep the same lines each; an empty table stays empty; a tie of the largest
    doc_id keeps the line in all rows that have it; extra columns pass through, whatever their names.
    """
    report = unused(docs.columns, "line_report")
    return drop_repeated_lines(docs, report=report).select(*map(named, docs.columns))


def query(spark, sf_dir):
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_report.n_lines", "line_report.n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
), k AS (
  SELECT doc_id, line, pos,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keep AS gone FROM k LEFT JOIN s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
