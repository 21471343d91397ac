"""Sources and sinks: raw envelopes as files, JSON lines, snapshots, and a data source for paged endpoints."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarry.operators.rawstore import canonical_json

ENVELOPE = "source string, native_id string, harvest_method string, endpoints array<string>, payload string"
MANIFEST = "source string, native_id string, hash string, first_seen date"


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines, blank ones skipped; with a schema nothing is inferred and the scan prunes columns."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes with the payload as it stands, one JSON object a line."""
    line = spark.read.text(path).where("trim(value) != ''")
    fields = F.from_json("value", "source string, native_id string, harvest_method string, endpoints array<string>, payload string")
    return line.select(F.inline(F.array(fields)))


def write_jsonl(df: DataFrame, path: str, order: Sequence[str | Column] = ("id",)) -> None:
    """One canonical line a row, in order. The range exchange of the sort keeps the parts in order too."""
    df.orderBy(*order).select(canonical_json(df).alias("value")).write.mode("overwrite").text(path)


def write_split(df: DataFrame, path: str, by: str = "source") -> None:
    """One folder for each source, so that reading one source or record opens no other."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


class Snapshots:
    """Versions of a table in folders of their own, and a pointer that names the last one whole.

    A version is written beside the others and the pointer moved last, by rename, so a reader sees the old
    version or the new one. The pointer goes through Hadoop's file system, so any store works.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[str]:
        fs, path = self._fs()
        if not fs.exists(path(self.root)):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path(self.root)) if s.isDirectory() and s.getPath().getName().startswith("v"))

    def write(self, df: DataFrame) -> str:
        fs, path = self._fs()
        name = f"v{len(self.versions()):06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.root}/.staging-{name}")
        if not fs.rename(path(f"{self.root}/.staging-{name}"), path(f"{self.root}/{name}")):
            raise OSError(f"{name} could not be published")
        return name

    def read(self, version: str | None = None) -> DataFrame | None:
        """A version, the last by default; None where there is none."""
        found = self.versions()
        if not found:
            return None
        return self.spark.read.parquet(f"{self.root}/{version or found[-1]}")

    def expire(self, keep: int) -> list[str]:
        fs, path = self._fs()
        gone = self.versions()[:-keep] if keep else []
        for v in gone:
            fs.delete(path(f"{self.root}/{v}"), True)
        return gone


class PagedSource(DataSource):
    """``spark.read.format("paged")``: one partition for each host, so that politeness is kept within it.

    Options: ``pages`` is a JSON object of host to a list of page files (JSON arrays of objects with an ``id``);
    a live harvester passes a fetch function of its own in place of the file reader.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return ENVELOPE

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(json.loads(self.options.get("pages", "{}")), self.options.get("method", "file"))


class _PagedReader(DataSourceReader):
    def __init__(self, pages: dict[str, list[str]], method: str):
        self.pages, self.method = pages, method

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(host) for host in sorted(self.pages)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        seen: set[str] = set()
        for page in self.pages[partition.value]:
            with open(page, encoding="utf-8") as f:
                for item in json.load(f):
                    if item and item.get("id") is not None and item["id"] not in seen:  # null nodes are skipped
                        seen.add(item["id"])
                        yield partition.value, str(item["id"]), self.method, [os.path.basename(page)], json.dumps(item, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def probe(urls: DataFrame, head: Callable[[str], tuple[int, str]]) -> DataFrame:
    """(url, status, final) of distinct addresses by a caller's HEAD function; 0 is unreachable. One task for each host."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)

    def run(frames):
        for frame in frames:
            found = [head(u) for u in frame["url"]]
            frame["status"], frame["final"] = [s for s, _ in found], [f for _, f in found]
            yield frame[["url", "status", "final"]]

    return urls.select("url").distinct().repartition(host).mapInPandas(run, "url string, status int, final string")


def status_histogram(probed: DataFrame) -> DataFrame:
    return probed.groupBy("status").agg(F.count("*").alias("n"))


def query_string(params: dict[str, object]) -> str:
    """Parameters of a request, those without a value left out."""
    return urlencode([(k, v) for k, v in params.items() if v is not None])


def listing_errors(listing: DataFrame, total: int, key: str = "native_id") -> DataFrame:
    """(kind, key, n): identifiers that a listing repeats, and a number of rows that isn't what the endpoint announced."""
    twice = listing.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("repeated").alias("kind"), "key", "n")
    short = listing.agg(F.count("*").alias("n")).where(F.col("n") != total).select(F.lit("total").alias("kind"), F.lit(str(total)).alias("key"), "n")
    return twice.unionByName(short)


def write_changelog(folder: str, day: str, text: str, keep: int = 12) -> list[str]:
    """Write the day's changelog and the same bytes as latest.md, each by rename; return the newest ``keep`` days' names."""
    os.makedirs(folder, exist_ok=True)
    for name in (f"{day}.md", "latest.md"):
        staged = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
        with open(staged, "w", encoding="utf-8") as f:
            f.write(text.rstrip("\n") + "\n")
        os.replace(staged, os.path.join(folder, name))
    return sorted((n for n in os.listdir(folder) if n[:1].isdigit() and n.endswith(".md")), reverse=True)[:keep]
