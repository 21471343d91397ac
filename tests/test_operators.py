"""Operators on small cases of their rules: merging, graph, diff, store, look-ups, validation."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.operators import diff, graph, guards, links, lookup, merge, rawstore, validate
from quarry.plans import record_queries
from quarry.vocab import ACCESS_ORDER, DOMAINS, MODALITIES, SOURCE_PRIORITY

RECORD = """cluster string, id string, source string, name string, domains array<string>, conditions array<struct<label:string,mesh_id:string>>, keywords array<string>, papers array<struct<doi:string,title:string,relation:string>>,
related array<struct<id:string,relation:string>>, dataset_doi string, access string, access_notes string, access_tiers array<string>, species string, sample_size long, year_start int, year_end int, record_status string"""


def rec(cluster, id, source, **kw):
    base = {"name": id, "domains": [], "conditions": [], "keywords": [], "papers": [], "related": [], "dataset_doi": None, "access": "open", "access_notes": None, "access_tiers": ["open"], "species": "unknown", "sample_size": None, "year_start": None, "year_end": None, "record_status": "active"}
    return (cluster, id, source, *(base | kw).values())


def merged(spark, rows):
    df = spark.createDataFrame(rows, RECORD)
    return {r.cluster: r for r in merge.merge_clusters(df, SOURCE_PRIORITY, DOMAINS, MODALITIES, ACCESS_ORDER).collect()}


def test_merge_rules(spark):
    rows = [
        rec("c", "tcia:b", "tcia", domains=["oncology"], conditions=[("Stroke", None)], keywords=["k2", "k1"], access="application", access_notes="", access_tiers=["application"], species="human", sample_size=7, year_start=1999, dataset_doi="10.1000/B.v2", papers=[("10.5555/x", None, "cites")]),
        rec("c", "openneuro:z", "openneuro", name="", domains=["neurology", "neurology"], conditions=[("stroke", "D1"), ("Pain", None)], keywords=["k1", "k1"], access_notes="mine", sample_size=0, year_end=2001, related=[("tcia:b", "part_of"), ("x:y", "part_of"), ("x:y", "derived_from")], papers=[("https://doi.org/10.5555/X", None, "describes")]),
        rec("c", "tcia:a", "tcia", access="application", access_notes="theirs", record_status="needs_review", year_start=1990),
        rec("s", "gdc:1", "gdc", domains=["oncology", "oncology"], sample_size=0),
    ]
    for shuffled in (rows, rows[::-1]):
        got = merged(spark, shuffled)
        m = got["c"]
        assert m.members == ["openneuro:z", "tcia:a", "tcia:b"] and m.id == "openneuro:z"
        assert m.name == "tcia:a" and m.domains == ["neurology", "oncology"]
        assert [c.label for c in m.conditions] == ["stroke", "Pain"] and m.keywords == ["k1", "k2"]
        assert [r.id for r in m.related] == ["x:y"] and m.related[0].relation == "part_of"
        assert [(p.doi, p.relation) for p in m.papers] == [("https://doi.org/10.5555/X", "describes"), ("10.1000/B.v2", "describes")]
        assert (m.access, m.access_notes, m.access_tiers) == ("application", "theirs", ["open", "application"])
        assert (m.species, m.sample_size, m.year_start, m.year_end, m.record_status) == ("human", 7, 1990, 2001, "needs_review")
        assert got["s"].domains == ["oncology", "oncology"] and got["s"].sample_size == 0
    df = spark.createDataFrame(rows, RECORD)
    gone = merge.exclusions(merge.merge_clusters(df, SOURCE_PRIORITY, DOMAINS, MODALITIES, ACCESS_ORDER)).collect()
    assert {(r.native_id, r.reason) for r in gone} == {("tcia:a", "merged_into:openneuro:z"), ("tcia:b", "merged_into:openneuro:z")}


def test_scalars_of_large_clusters_are_not_gathered(spark):
    k = F.col("id")
    said = {"species": F.when(k % 4 == 3, "human").otherwise("unknown"), "year_start": F.when(k > 8, k.cast("int")), "name": F.when(k > 1, F.concat(F.lit("n"), k)).otherwise(""), "access": F.when(k % 5 == 4, "closed").when(k > 0, "open"), "access_notes": F.when(k != 4, F.concat(F.lit("note "), k)), "record_status": F.when(k == 29999, "needs_review").otherwise("active")}
    rows = spark.range(30000).select(F.lit("c").alias("cluster"), F.format_string("%05d", k).alias("id"), F.lit("s").alias("source"), *[v.alias(n) for n, v in said.items()])
    out = merge.merge_clusters(rows, ("s",), (), (), ("open", "closed")).select("id", *said)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in out.collect()] == [("00000", "human", 9, "n2", "closed", "note 0", "needs_review")]
    led = merge.merge_clusters(rows.where("id != '00004'"), ("s",), (), (), ("open", "closed"))
    assert [(r.access_notes, len(r.members), r.members[:2]) for r in led.collect()] == [("note 9", 29999, ["00000", "00001"])]


def test_clusters_chain_and_null_keys_match_nothing(spark):
    df = spark.createDataFrame([("a", "1", None), ("b", "1", "x"), ("c", None, "x"), ("d", None, None), ("e", None, None)], "id string, k string, l string")
    got = {(r.id, r.cluster) for r in links.cluster(df, {"k": F.col("k"), "l": F.col("l")}).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e")}


def test_colliding_titles_are_flagged_only(spark):
    df = spark.createDataFrame([("a", "s1", "The Brain MRI", "active"), ("b", "s2", "mri brain", "removed"), ("c", "s1", "other", "active"), ("d", "s1", "other", "active")], "id string, source string, name string, record_status string")
    hits = links.title_collisions(df, F.col("name"))
    assert {r.id for r in hits.collect()} == {"a", "b"}
    assert {r.id: r.record_status for r in merge.flag_collisions(df, hits).collect()} == {"a": "needs_review", "b": "removed", "c": "active", "d": "active"}


def test_best_match_and_shared_winner(spark):
    pairs = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 5), ("b", "x", 5)], "k string, w string, s int")
    best = links.best_match(pairs, "k", F.desc("s"), F.asc("w"))
    assert {(r.k, r.w) for r in best.collect()} == {("a", "y"), ("b", "x")}
    assert links.shared_winners(best, "k", "w").count() == 0


def test_best_candidates_of_hot_keys_make_no_pairs(spark):
    k = F.col("id")
    left, right = spark.range(30000).select("id", F.lit("x").alias("a"), (k % 3).alias("b")), spark.range(30000).select("id", F.when(k < 29990, "x").alias("a"), F.when(k >= 29990, k % 2).alias("b"), (k % 1000).alias("s"))
    out = links.best_candidates(left, right, ("a", "b"), ("a", "b"), F.desc("s"), F.asc("right_id"))
    got = {(r.left_id % 3, r.right_id, r.s) for r in out.collect()}
    assert got == {(0, 999, 999), (1, 999, 999), (2, 999, 999)} and out.count() == 30000
    only = links.best_candidates(left, right.where("b IS NOT NULL"), ("a", "b"), ("a", "b"), F.desc("s"), F.asc("right_id"))
    assert {(r.left_id % 3, r.right_id) for r in only.collect()} == {(0, 29998), (1, 29999)} and only.count() == 20000


def test_best_candidate_query_on_odd_tables_is_its_sql(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    supplier = [(1, "S#001", None, 5200.0), (2, "S#002", 7, 9.5), (3, "S#003", 7, nan), (4, "S#004", 8, None), (5, "S#005", 9, -0.5), (6, "7", 1, 1e300), (None, "S#008", 2, 70.0), (9, None, 3, 4400.0), (10, "S#010", 4, inf), (10, "S#011", 5, 1.0)]
    customer = [(20, "C#101", None, 5900.0), (21, "C#002", 6, None), (22, "C#102", 7, nan), (23, "C#103", 7, 3.0), (24, "C#004", 8, None), (25, "C#104", 9, -9.0), (26, "7", 2, 1e301), (27, "C#105", 1, 2e300), (28, "C#008", 3, 12.0), (28, "C#008", 3, 12.0), (29, "C#106", 3, 4999.0), (None, "C#010", 5, 9.0), (30, "C#010", 4, 9.0), (31, "C#011", 5, 8.0), (31, "C#011", 5, 9.0)]
    for name, p, key, rows in (("supplier", "s", "suppkey", supplier), ("customer", "c", "custkey", customer)):
        spark.createDataFrame(rows, f"{p}_{key} long, {p}_name string, {p}_nationkey int, {p}_acctbal double").write.parquet(str(tmp_path / f"{name}.parquet"))
    got = sorted(repr(tuple(r)) for r in record_queries.best_candidate(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    for name in ("supplier", "customer"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == sorted(repr(r) for r in con.execute(record_queries.BEST_SQL).fetchall()) and got


RECORDS = "id string, source string, name string, domains array<string>, modalities array<string>, conditions array<string>, institutions array<struct<name:string,ror_id:string>>, access string, record_status string, related array<string>"


@pytest.fixture
def records(spark):
    rows = [
        ("s:1", "s", "one", ["oncology", "neurology", "oncology"], ["CT", "CT"], ["Lung Cancer", "lung cancer"], [("A U", "https://ror.org/01"), ("A U", "01"), ("B", None), ("C", None)], "open", "active", ["s:2", "s:1", "s:9", "s:3"]),
        ("s:2", "s", "two", ["neurology"], ["MRI"], ["LUNG cancer"], [("Other", "01")], "open", "needs_review", ["s:1"]),
        ("s:3", "t", "gone", ["oncology"], ["CT"], ["x"], [], "open", "removed", ["s:1"]),
        ("s:4", "t", "bare", [], [], [], [], "open", "active", []),
    ]
    return spark.createDataFrame(rows, RECORDS)


def test_graph(records):
    edges = {tuple(r) for r in graph.links(records, DOMAINS).collect()}
    assert ("s:1", "s:2", "related") in edges and not any("s:3" in e[:2] or "s:9" in e[:2] for e in edges)
    assert {e[1] for e in edges if e[2] == "has_institution" and e[0] == "s:1"} == {"institution:01", "institution:b"}
    nodes = {r.id: r for r in graph.nodes(records, DOMAINS).collect()}
    assert nodes["condition:lung-cancer"].label == "Lung Cancer" and nodes["condition:lung-cancer"].backbone
    assert nodes["s:1"].domains == ["neurology", "oncology"] and not nodes["s:1"].backbone
    assert nodes["source:s"].domains == ["neurology"] and nodes["source:t"].domains == []
    assert nodes["institution:b"].degree == 1 and not nodes["institution:b"].backbone and nodes["modality:CT"].backbone
    stats = {(r.metric, r.value): r.n for r in graph.stats(records).collect()}
    assert stats["records", ""] == 3 and stats["per_domain", "oncology"] == 2 and ("per_source", "t") in stats


def test_graph_does_not_depend_on_order(spark, records):
    a = sorted(map(str, graph.nodes(records, DOMAINS).collect()))
    b = sorted(map(str, graph.nodes(records.orderBy(F.desc("id")).repartition(3), DOMAINS).collect()))
    assert a == b


def test_exploration(spark):
    edges = spark.createDataFrame([("a", "h", "t"), ("b", "h", "t"), ("b", "g", "t"), ("c", "g", "t"), ("a", "a", "t")], "source string, target string, type string")
    assert {(r.id, r.other) for r in graph.adjacency(edges).collect()} >= {("h", "a"), ("a", "h")}
    top = graph.neighbours(edges, "h", graph.degrees(edges.where("source != target")), cap=1).collect()
    assert [(r.id, r.pos) for r in top] == [("b", 1)]
    assert {(r.source, r.target) for r in graph.ego(edges.where("source != target"), "g").collect()} == {("b", "g"), ("c", "g")}
    shown = spark.createDataFrame([(x,) for x in "abcgh"], "id string")
    assert {r.id for r in graph.collapse(shown, edges, "h", ["h", "g"], []).collect()} == {"b", "c", "g", "h"}
    assert {r.id for r in graph.collapse(shown, edges, "h", ["h", "g"], ["a"]).collect()} == {"a", "b", "c", "g", "h"}
    nodes = spark.createDataFrame([("d", "dataset", []), ("h", "source", []), ("x", "dataset", ["p"])], "id string, type string, domains array<string>")
    assert {r.id for r in nodes.where(graph.dimmed(["q"])).collect()} == {"d", "x"} and nodes.where(graph.dimmed([])).count() == 0


def test_diff_paths(spark):
    kind = "id string, a struct<b:int,c:array<int>>, note string, seen string"
    old = spark.createDataFrame([("1", (1, [1]), "x|y", "d1"), ("2", (1, [1]), None, "d1"), ("3", None, "z", "d1"), ("5", (None, None), None, "d1")], kind)
    new = spark.createDataFrame([("1", (2, [1, 2]), "x|y", "d2"), ("2", (1, [1]), None, "d2"), ("4", None, "z", "d2"), ("5", (None, None), "", "d1")], kind)
    got = diff.diff(old, new, ("seen", "a.none", "none.x")).collect()
    assert {tuple(r) for r in got} == {("1", "changed", "a.b", "1", "2"), ("1", "changed", "a.c", "[1]", "[1,2]"), ("3", "removed", None, None, None), ("4", "added", None, None, None), ("5", "changed", "note", None, "")}
    found = diff.diff(old, new, ("seen",))
    counts = diff.diff_counts(old, new, found).first().asDict()
    assert counts == {"added": 1, "removed": 1, "changed": 2, "unchanged": 1}
    page = diff.render(found, counts, "2024-01-01")
    assert page.startswith("# 2024-01-01\n\n+1 added, ~2 changed, -1 removed") and "| 1 | `a.b` | 1 | 2 |" in page
    assert diff.title({}) == "no changes"


def test_store(spark):
    stored = spark.createDataFrame([("a", "h1", "d0"), ("b", "h2", "d0")], "native_id string, hash string, first_seen string")
    listed = spark.createDataFrame([("a", "h1"), ("b", "h3"), ("c", "h4")], "native_id string, hash string")
    rows = rawstore.upsert(stored, listed, F.lit("d1"))
    assert {tuple(r) for r in rows.collect()} == {("a", "h1", "d0", "unchanged"), ("b", "h3", "d0", "rewritten"), ("c", "h4", "d1", "written")}
    assert rawstore.finalize(rows, failed=False)[1] == "ok" and rawstore.finalize(rows, failed=True)[1] == "failed"
    half = rawstore.upsert(stored, listed.limit(1), F.lit("d1"))
    kept, status = rawstore.finalize(half, failed=False)
    assert status == "failed" and kept.count() == 2
    ids = spark.createDataFrame([("Abc",), ("abc",), ("x y",), ("x-y",), ("z",)], "native_id string")
    assert {(r.key, r.n) for r in rawstore.collisions(ids).collect()} == {("abc", 2), ("x-y", 2)}
    raw = spark.createDataFrame([("s", "a", 1), ("s", "b", 2)], "source string, native_id string, v int")
    assert rawstore.scan(raw, raw.where("v = 1")).count() == 1 and rawstore.scan(raw, None).count() == 2
    assert rawstore.point_read(raw, "s", "b").first().v == 2


def test_volatile_paths_do_not_change_the_hash(spark):
    kind = "native_id string, body struct<x:int,stats:struct<views:int>>"
    a, b = (spark.createDataFrame([("n", (1, (v,)))], kind) for v in (5, 6))
    h = lambda df, vol: rawstore.payload_hash(df, ("body",), vol).first().hash
    assert h(a, ("body.stats.views",)) == h(b, ("body.stats.views",)) and h(a, ()) != h(b, ())


def test_lookups(spark):
    dim = spark.createDataFrame([("known", "v"), ("negative", None)], "key string, value string")
    rows = spark.createDataFrame([(1, " Known "), (2, "negative"), (3, "new"), (4, None)], "i int, label string")
    got = {r.i: (r.out, r.known) for r in lookup.fill(rows.withColumn("out", F.lit(None).cast("string")), F.col("label"), dim, "out").collect()}
    assert got == {1: ("v", True), 2: (None, True), 3: (None, False), 4: (None, False)}
    assert [r.key for r in lookup.unknown(rows, F.col("label"), dim).collect()] == ["new"]
    terms = spark.createDataFrame([("Stroke", "D1"), ("Stroke, Acute", "D2"), ("Sepsis", "D3"), ("Injury", "D4")], "name string, value string")
    labels = spark.createDataFrame([("stroke",), ("seps",), ("str",), ("tbi",), ("none",)], "key string")
    got = {r.key: r.value for r in lookup.resolve_exact_alias_prefix(labels, terms, {"tbi": "injury"}).collect()}
    assert got == {"stroke": "D1", "seps": "D3", "str": None, "tbi": "D4", "none": None}
    misses = spark.createDataFrame([(str(i),) for i in range(20)], "key string")
    assert lookup.batches(misses, 8, most=2).count() == 16 and lookup.batches(misses, 8).groupBy("batch").count().agg(F.max("count")).first()[0] <= 8


def test_answers_pass_their_guards(spark):
    rows = spark.createDataFrame([("a", "curated", "Patients with stroke had 12 MRI scans taken", "active", ["other"], [], ["Stroke"], "old", None, ["US"])], "id string, source string, text string, record_status string, domains array<string>, modalities array<string>, conditions array<string>, summary string, population string, countries array<string>")
    answer = {"in_scope": False, "domains": ["neurology", "bogus"], "modalities": [("MRI", "MRI scans taken"), ("CT", "CT scans taken")], "conditions": [("stroke", "with stroke had"), ("Pain", "with pain too")], "summary": "Patients with stroke had 13 scans", "population": "patients", "countries": ["DE", "usa"]}
    answers = spark.createDataFrame([("a", answer), ("nobody", answer)], f"id string, answer struct<{guards.ANSWER.replace(' boolean', ':boolean').replace(' array', ':array').replace(' string', ':string')}>")
    r = guards.apply_answers(rows, answers, DOMAINS, MODALITIES, {}, ("scientific_data",)).first()
    assert (r.domains, r.modalities, r.conditions, r.countries) == (["neurology", "other"], ["MRI"], ["Stroke"], ["US", "DE"])
    assert (r.summary, r.population, r.record_status, r.drops) == ("old", "patients", "active", 5)


def test_ledger_and_gates(spark):
    ledger = spark.createDataFrame([("k1", "data", "low", "fixed", "d0", "d0"), ("k2", "data", "low", "wontfix", "d0", "d0"), ("k3", "data", "low", "open", "d0", "d0")], "key string, lens string, severity string, status string, first_seen string, last_seen string")
    found = spark.createDataFrame([("k1", "data", "high"), ("k2", "data", "low"), ("k4", "code", "low")], "key string, lens string, severity string")
    out = validate.ledger_upsert(ledger, found, "d1")
    assert {r.key: (r.severity, r.status, r.first_seen, r.last_seen) for r in out.collect()} == {"k1": ("high", "open", "d0", "d1"), "k2": ("low", "wontfix", "d0", "d1"), "k3": ("low", "open", "d0", "d0"), "k4": ("low", "open", "d1", "d1")}
    assert {r.key for r in validate.age_open(out, "d1").where("status = 'stale'").collect()} == {"k3"}
    assert validate.gates({"n": 3}, {"n": (">=", 2), "m": ("<=", 1)}) == [("n", "PASS", "3 >= 2"), ("m", "FAIL", "None <= 1")]


def test_contract_reads_each_input_once(spark, tmp_path):
    tables = {
        "found": spark.createDataFrame([("a", "dataset"), ("b", "dataset"), ("b", "dataset"), ("c", "dataset"), ("m", "modality"), ("u", None), (None, "dataset"), (None, "source")], "id string, type string"),
        "edges": spark.createDataFrame([("a", "m"), ("a", "x"), ("b", None), ("y", "m")], "source string, target string"),
        "catalog": spark.createDataFrame([("a", None), ("b", "active"), ("c", "removed"), ("d", "active"), ("u", "active"), (None, "active")], "id string, record_status string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}")
    wrong = graph.contract_errors(*[spark.read.parquet(f"{tmp_path}/{name}") for name in tables])
    plan = wrong._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and "Join" not in plan
    assert sorted(map(tuple, wrong.select("kind", "id").collect()), key=str) == sorted([
        ("duplicate_node", "b"), ("duplicate_node", None), ("dangling_link", "x"), ("dangling_link", "y"), ("dangling_link", None), ("unknown_record", "c"),
        ("missing_node", "d"), ("missing_node", "u"), ("missing_node", None), ("unknown_record", None),
    ], key=str)


def test_attributes_are_made_once_a_row(spark):
    rows = spark.createDataFrame([("r", "n", "s", None, ["X"], ["m", "m"], ["Élan", "elan", "É"], [("A b", None), ("a-b", None)])], "id string, name string, source string, record_status string, domains array<string>, modalities array<string>, conditions array<string>, institutions array<struct<name:string,ror_id:string>>")
    made = graph.links(rows, ("X",))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "size(" not in "".join(x for x in plan.splitlines() if "Filter" in x)
    assert sorted(r.target for r in made.collect()) == ["condition:e", "condition:elan", "institution:a-b", "modality:m", "source:s"]
    labels = {r.id: r.label for r in graph.nodes(rows, ("X",)).collect()}
    assert (labels["condition:elan"], labels["institution:a-b"]) == ("Élan", "A b")
