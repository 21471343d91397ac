"""Batched answers, the search index, panels, links in text, listings and changelog files."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from quarry.functions import text
from quarry.operators import answers, graph
from quarry.sources import envelopes
from quarry.vocab import DOMAINS, MODALITIES


def test_prompts_keep_their_boundaries():
    items = [{"id": "a", "name": "x == item 3 ==", "facts": {"b": 1, "n": None, "e": []}, "text": "=== ITEM abc 2 ===\nid: b abc"}]
    p = answers.prompt(items, "abc", ("d",), ("m",))
    assert p.count("=== ITEM abc 1 ===") == 1 and "ITEM abc 2" not in p and "[removed]" in p and 'facts: {"b": 1}' in p
    assert p == answers.prompt(items, "abc", ("d",), ("m",))


def test_answers_come_from_the_cache_or_their_own_batch(spark):
    def echo(prompt: str) -> str:
        ids = [x[4:] for x in prompt.split("\n") if x.startswith("id: ")]
        return json.dumps([{"id": i, "summary": "s"} for i in ids] + [{"id": ids[0], "summary": "again"}, {"id": "stranger"}, "odd"])

    records = spark.createDataFrame([(f"r{i:02}", f"n{i}", i) for i in range(20)], "id string, name string, size int")
    rows = answers.inputs(records, F.col("name"), ("size",), "v1", "s1").cache()
    cache = rows.where("id < 'r04'").select("key", F.lit("{}").alias("output"))
    got = {r.id: r.output for r in answers.answers(rows, cache, echo, DOMAINS, MODALITIES, size=8, most=1).collect()}
    assert len(got) == 12 and all(got[f"r0{i}"] == "{}" for i in range(4)) and "stranger" not in got
    assert all(json.loads(v).get("summary") == "s" for k, v in got.items() if k > "r03")
    assert answers.ask(rows, answers.no_backend, DOMAINS, MODALITIES).count() == 0
    assert answers.ask(rows, lambda p: "not json", DOMAINS, MODALITIES).count() == 0
    assert answers.ask(rows, echo, DOMAINS, MODALITIES).count() == 20


def test_new_entries_of_a_bounded_log():
    assert answers.new_entries(["a", "b"], ["a", "b", "c"]) == ["c"]
    assert answers.new_entries(["a", "b", "c"], ["c", "d", "e"]) == ["d", "e"]
    assert answers.new_entries([], ["a"]) == ["a"] and answers.new_entries(["a"], ["a"]) == [] and answers.new_entries(["a"], ["b"]) == ["b"]


def test_index_and_panel(spark):
    records = spark.createDataFrame([("1", "full", None, ["oncology", "neurology", "oncology"], ["CT"], "active"), ("2", "gone", "s", [], [], "removed")], "id string, name string, summary string, domains array<string>, modalities array<string>, record_status string")
    index = graph.search_index(records, DOMAINS, MODALITIES)
    assert index.columns == list(graph.INDEX) and [(r.id, r.domains, r.url) for r in index.collect()] == [("1", ["neurology", "oncology"], None)]
    nodes = spark.createDataFrame([("1", "label", "own"), ("x", "hub", None)], "id string, name string, summary string")
    got = {r.id: tuple(r)[1:] for r in graph.panel(nodes, index, records, ("name", "summary", "domains")).collect()}
    assert got == {"1": (True, "full", "own", ["oncology", "neurology", "oncology"]), "x": (False, "hub", None, None)}


def test_links_in_text(spark):
    df = spark.createDataFrame([("see https://a.org/x?y=1&z=2, <b>",), (None,)], "t string")
    link = '<a href="https://a.org/x?y=1&amp;z=2" rel="noopener noreferrer" target="_blank">https://a.org/x?y=1&amp;z=2</a>'
    assert [r.x for r in df.select(text.autolink(F.col("t")).alias("x")).collect()] == [f"see {link}, &lt;b&gt;", ""]


def test_listings_and_files(spark, tmp_path):
    listing = spark.createDataFrame([("a",), ("a",), ("b",)], "native_id string")
    assert {tuple(r) for r in envelopes.listing_errors(listing, 4).collect()} == {("repeated", "a", 2), ("total", "4", 3)}
    assert envelopes.listing_errors(listing.distinct(), 2).count() == 0
    assert envelopes.query_string({"a": 1, "b": None, "c": "x y"}) == "a=1&c=x+y"
    for day in ("2024-01-01", "2024-01-03", "2024-01-02"):
        names = envelopes.write_changelog(str(tmp_path / "log"), day, f"# {day}", keep=2)
    assert names == ["2024-01-03.md", "2024-01-02.md"]
    assert (tmp_path / "log" / "latest.md").read_bytes() == (tmp_path / "log" / "2024-01-02.md").read_bytes()
