"""Rules, term tables, look-ups by prefix, pointer diffs, changelogs and harvesters on small cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import diff, lookup, tagging
from quarry.plans import refresh
from quarry.sources import dictionaries, harvest


def test_prefixes_of_any_number_of_lengths(spark):
    terms = spark.createDataFrame([("a" * 1500 + "b", "long"), ("zebra", "z")], "name string, value string")
    labels = spark.createDataFrame([("a" * n,) for n in range(1, 1301)] + [("zeb",), ("zebra",), ("q",)], "key string")
    got = {r.key: r.value for r in lookup.resolve_exact_alias_prefix(labels, terms, {}).collect()}
    assert all(got["a" * n] == "long" for n in range(1, 1301)) and got["zeb"] == got["zebra"] == "z" and got["q"] is None


def test_rules_say_what_bore_them_out(spark):
    terms = dictionaries.Dictionaries(domains={"oncology": ("tumor*"[:-1] + "ous*",), "cardiology": ("heart",)}, conditions={"stroke": ("stroke",), "lung neoplasms": ()}, animal=("mice",), human=("people",), topics={"ecg": ("modality", "ECG")}, body_parts={"LUNG": "lung neoplasms"}, mentions=("cancer",))
    rows = [("1", "physionet", "Heart and HEART rates of mice.", [" ECG "]), ("2", "tcia", "cancer of people and mice", ["lung", None]), ("3", "tcia", "a stroke", ["lung"]), ("4", "gdc", None, None), ("5", "gdc", "cancer", ["lung", "ecg"]), ("6", "gdc", "hearts", ["stroke"])]
    df = spark.createDataFrame(rows, "id string, source string, text string, keywords array<string>")
    got = {r.id: r for r in tagging.rule_hits(df, terms, ("cardiology", "oncology"), ("ECG",)).collect()}
    assert (got["1"].domains, got["1"].modalities, got["1"].species) == (["cardiology"], ["ECG"], "animal")
    assert got["1"].evidence == {"cardiology": ["Heart"], "ECG": [" ECG "], "species": ["mice"]}
    assert (got["2"].conditions, got["2"].species, got["2"].evidence["species"]) == (["lung neoplasms"], None, ["mice", "people"])
    assert got["3"].conditions == ["stroke"] and not got["4"].evidence and not got["5"].evidence and got["6"].conditions == ["stroke"]
    assert tagging.rule_hits(df.limit(0), terms, (), ()).count() == 0
    assert {r.id for r in tagging.rule_hits(df, dictionaries.Dictionaries(), (), ()).collect()} == set("123456")


def test_term_tables_are_checked(tmp_path):
    def load(**tables):
        path = tmp_path / "terms.json"
        path.write_text(json.dumps(tables))
        return dictionaries.load(str(path))

    assert load(domains={"cardiology": ["heart"]}).domains == {"cardiology": ["heart"]}
    for wrong in ({"domains": {"nothing": ["x"]}}, {"modalities": {"MRI": ["mri*"]}}, {"topics": {"a": ["domain", "MRI"]}}, {"body_parts": {"LUNG": "stroke"}}, {"others": {}}, {"conditions": {"stroke": [""]}}):
        with pytest.raises(ValueError):
            load(**wrong)


def test_pointers_into_structs_and_lists(spark):
    kind = "id string, a struct<x:int,y:array<string>>, l array<struct<k:int,v:string>>, m map<string,int>, ` s` string"
    old = spark.createDataFrame([("1", (1, ["p", "q"]), [(1, "a"), (2, "b")], {"k": 1}, "t"), ("2", None, [], None, None), ("3", (1, None), None, None, None), ("5", (1, []), [], {}, "")], kind)
    new = spark.createDataFrame([("1", (2, ["p", "r"]), [(1, "a"), (2, None)], {"k": 2}, "t"), ("2", (1, None), [(1, "x")], None, None), ("4", None, None, None, None), ("5", (1, []), [], {}, "")], kind)
    got = sorted((r.id, r.kind, r.path, r.old, r.new) for r in diff.pointer_diff(old, new).where("path IS NOT NULL").collect())
    assert got == [
        ("1", "changed", "/a/x", "1", "2"),
        ("1", "changed", "/a/y/1", "q", "r"),
        ("1", "changed", "/l/1/v", "b", None),
        ("1", "changed", "/m", '{"k":1}', '{"k":2}'),
        ("2", "changed", "/a", None, '{"x":1,"y":null}'),
        ("2", "changed", "/l", "[]", '[{"k":1,"v":"x"}]'),
    ]
    assert {(r.id, r.kind) for r in diff.pointer_diff(old, new).where("path IS NULL").collect()} == {("3", "removed"), ("4", "added")}
    assert diff.pointer_diff(old, old).count() == 0 and diff.pointer_diff(old.limit(0), old.limit(0)).count() == 0


def test_a_changelog_of_nothing(spark):
    rows = spark.createDataFrame([("1", "n", "u")], "id string, name string, url string")
    made = diff.document(diff.pointer_diff(rows, rows), rows, {"unchanged": 1}, "2024-01-01")
    assert made.count("none") == 4 and "not run" in made and made.endswith("## Validation warnings: 0\n")
    assert diff.one_line(" a\x00`b`\n|c\x7f ") == "a'b' \\|c"


def test_dedupe_remaps_and_links(spark):
    kind = "id string, source string, source_native_id string, name string, related array<string>, record_status string, k string"
    rows = spark.createDataFrame([("gdc:TCGA-AB", "gdc", "TCGA-AB", "One thing", ["tcia:x", "tcia:tcga-ab"], "active", "1"), ("tcia:x", "tcia", "x", "Other", [], "active", "1"), ("tcia:tcga-ab", "tcia", "tcga-ab", "Third", ["tcia:x", "none:1"], "active", "2"), ("a:1", "a", "1", "One thing", None, "active", "3")], kind)
    out, gone = refresh.dedupe(rows, {"k": F.col("k")}, refresh.COHORTS, (), (), ("gdc", "tcia"), ())
    got = {r.id: r for r in out.collect()}
    assert [(r.native_id, r.reason) for r in gone.collect()] == [("tcia:x", "merged_into:gdc:TCGA-AB")]
    assert got["gdc:TCGA-AB"].related == ["tcia:tcga-ab"] and got["tcia:tcga-ab"].related == ["gdc:TCGA-AB"] and got["a:1"].related == []
    assert got["gdc:TCGA-AB"].record_status == got["a:1"].record_status == "needs_review" and got["tcia:tcga-ab"].record_status == "active"


class Pages(harvest.Harvester):
    source = "s"

    def items(self, fetch, fast):
        for x in harvest.by_cursor(fetch, "http://h/1", lambda p: p["items"], lambda p: p.get("next")):
            yield x["id"], x, ["list"]

    def probe(self, fetch):
        if "items" not in harvest.get_json(fetch, "http://h/1"):
            raise harvest.HarvestError("no items")


def test_harvesters(spark):
    pages = {"http://h/1": '{"items": [{"id": "a"}, null, {"id": "b"}], "next": "http://h/2"}', "http://h/2": '{"items": [{"id": "c"}]}', "http://h/o0": '{"n": 3, "x": [1, 2]}', "http://h/o2": '{"n": 3, "x": [3]}', "http://h/e0": '{"n": 3, "x": []}', "http://h/c": '{"items": [], "next": "http://h/c"}'}
    asked, slept, fail = [], [], {"http://h/2": 2}

    def fetch(url):
        asked.append(url)
        if fail.get(url):
            fail[url] -= 1
            return 503, ""
        return (200, pages[url]) if url in pages else (404, "")

    polite = harvest.Polite(fetch, pause=1.0, sleep=slept.append, clock=lambda: 0.0)
    one = Pages()
    one.probe(polite)
    assert [r.native_id for r in one.harvest(spark, polite).collect()] == ["a", "b", "c"]
    assert asked == ["http://h/1", "http://h/2", "http://h/2", "http://h/2"] and slept == [1.0, 1.0, 2.0]
    assert one.harvest(spark, polite, limit=2).count() == 2 and len(asked) == 4
    read = lambda letter: list(harvest.by_offset(fetch, lambda n: f"http://h/{letter}{n}", lambda p: p["x"], lambda p: p["n"]))
    assert read("o") == [1, 2, 3]
    with pytest.raises(harvest.HarvestError, match="0 of 3"):
        read("e")
    with pytest.raises(harvest.HarvestError, match="circle"):
        list(harvest.by_cursor(fetch, "http://h/c", lambda p: p["items"], lambda p: p["next"]))
    with pytest.raises(harvest.HarvestError, match="404"):
        harvest.get_json(fetch, "http://h/no")
    found, errors = harvest.discover(["no.such.module", "json"])
    assert not found and set(errors) == {"no.such.module", "json"}
