"""Normalizers on synthetic payloads, the refresh end to end, sources, snapshots, streams and commands."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quarry import cli, schema
from quarry.plans import refresh
from quarry.sources import envelopes, normalizers
from quarry.streaming import upsert
from quarry.vocab import MODALITIES


def raw(spark, source, *payloads, ids=None):
    rows = [(source, ids[i] if ids else f"n{i}", "file", [], json.dumps(p, sort_keys=True)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, envelopes.ENVELOPE)


NEURO = {
    "id": "ds1", "publishDate": "2020-05-06T01:02:03Z", "metadata": {"species": "", "studyDomain": "Neurological", "dxStatus": "Parkinson's disease, TBI", "ages": [30, None, 20], "associatedPaperDOI": "10.5555/a.v1", "affirmedDefaced": True},
    "latestSnapshot": {"tag": "1.0", "readme": "TODO: write", "description": {"Name": " A\n brain study ", "Authors": ["TODO:", "First1 Last1", "Ada B", "..."], "License": "CC0", "DatasetDOI": "doi:10.18112/x.v1.2", "ReferencesAndLinks": ["see https://doi.org/10.5555/B, and 10.18112/X"]}, "summary": {"subjects": ["1", "2"], "modalities": ["MRI", "odd"], "secondaryModalities": ["MRI_Functional"], "tasks": ["rest", "odd"], "size": 9}},
}


def test_first_repository(spark):
    draft = {"id": "ds2", "metadata": None, "latestSnapshot": None}
    rows = {r.native_id: r for r in normalizers.openneuro(raw(spark, "openneuro", NEURO, draft)).collect()}
    r = rows["n0"]
    assert rows["n1"].excluded == "no_snapshot" and rows["n1"].id is None
    assert (r.id, r.name, r.version, r.published, r.dataset_doi, r.license) == ("openneuro:n0", "A brain study", "1.0", "2020-05-06", "10.18112/x", "CC0-1.0")
    assert (r.domains, r.modalities, r.keywords) == (["neurology"], ["MRI", "fMRI"], ["rest", "odd"])
    assert r.conditions == ["parkinson disease", "traumatic brain injury"] and r.species == "human"
    assert r.population == "Parkinson's disease, TBI; ages 20–30" and r.sample_size == 2
    assert r.summary == "A brain study: MRI, fMRI dataset on OpenNeuro (2 participants)."
    assert [a.name for a in r.authors] == ["Ada B"] and [p.doi for p in r.papers] == ["10.5555/a", "10.5555/b"]
    text = normalizers.openneuro_text(raw(spark, "openneuro", NEURO)).first().text
    assert text.startswith("A brain study Neurological Parkinson's disease, TBI TODO")


def test_second_repository(spark):
    base = {"slug": "mit", "version": "2", "core_doi": "10.13026/abc", "is_latest_version": True, "title": "<b>T</b>", "short_description": "", "abstract": "<p>Recordings of 18 subjects.</p>", "license": {"name": "MIT  license"}, "dua": {"name": "D"}, "access_policy": "Restricted", "resource_type": "Challenge", "topics": ["ecg"], "publish_date": "2001-01-01", "main_storage_size": 5, "source_url": "https://physionet.org/content/mit/2/"}
    rows = normalizers.physionet(raw(spark, "physionet", base, base | {"resource_type": "Software"}, base | {"access_policy": "Odd"}, base | {"short_description": "w " * 41})).orderBy("native_id").collect()
    r = rows[0]
    assert [x.excluded for x in rows] == [None, "not_a_dataset", "unmapped_access_policy:Odd", None]
    assert (r.name, r.summary, r.access, r.access_notes, r.license, r.keywords) == ("T", "Recordings of 18 subjects.", "registration", "D", "MIT", ["ecg", "challenge"])
    assert (r.sample_size, r.sample_unit, r.dataset_doi) == (18, "participants", "10.13026/abc") and rows[3].summary == r.summary
    listing = spark.createDataFrame([(json.dumps([base, base | {"slug": "old", "is_latest_version": False}, base]),)], "payload string")
    assert [x.native_id for x in normalizers.latest_versions(listing).collect()] == ["mit"]


def test_third_repository(spark):
    base = {"project_id": "TARGET-X", "name": "Lung Adenocarcinoma", "primary_site": ["Lung", ""], "disease_type": ["A", "Lung Adenocarcinoma"], "released": True, "state": "open", "program": {"name": "TARGET", "dbgap_accession_number": "phs1"}, "summary": {"case_count": 3, "data_categories": [{"data_category": "Clinical", "case_count": 1}, {"data_category": "DNA Methylation", "case_count": 5}, {"data_category": "Odd", "case_count": None}, {"data_category": "Biospecimen", "case_count": 1}], "experimental_strategies": [{"experimental_strategy": "Tissue Slide"}, {"experimental_strategy": "WXS"}]}}
    rows = normalizers.gdc(raw(spark, "gdc", base, base | {"released": False}, base | {"name": "NCI MATCH Arm S1", "summary": None, "program": None})).orderBy("native_id").collect()
    r = rows[0]
    assert [x.excluded for x in rows] == [None, "not_released", None]
    assert (r.name, r.domains, r.conditions) == ("Lung Adenocarcinoma (TARGET-X)", ["oncology", "pediatrics"], ["adenocarcinoma of lung"])
    assert r.modalities == [m for m in MODALITIES if m in ("pathology", "genomics", "clinical_tabular")]
    assert r.summary.endswith("with 3 cases; primary sites: Lung, ; data: DNA Methylation, Clinical, Biospecimen.")
    assert r.keywords == ["Lung", "TARGET", "Tissue Slide", "WXS"] and r.access_notes.endswith("dbGaP phs1.")
    assert rows[2].conditions == ["a", "adenocarcinoma of lung"] and rows[2].sample_unit is None and rows[2].access_notes.endswith("dbGaP.")


def test_fourth_repository(spark):
    cite = {"doi": "10.7937/K9", "url": "https://x/collection/a/", "titles": [{"title": "alt", "titleType": "Other"}, {"title": "Breast cancer in pediatric COVID patients"}], "descriptions": [{"description": "<p>About it.</p>"}], "rightsList": [{"rights": "odd", "rightsIdentifier": None}, {"rights": "x", "rightsIdentifier": "CC-BY-3.0"}], "creators": [{"name": "A", "affiliation": ["U", "V"], "nameIdentifiers": [{"nameIdentifier": "0-1", "nameIdentifierScheme": "orcid"}]}, {"name": " ", "affiliation": ["U"], "nameIdentifiers": None}], "relatedIdentifiers": [{"relatedIdentifier": "10.5555/Q", "relatedIdentifierType": "DOI", "relationType": "IsCitedBy"}, {"relatedIdentifier": "10.5555/q", "relatedIdentifierType": "doi", "relationType": "Other"}, {"relatedIdentifier": "u", "relatedIdentifierType": "URL", "relationType": "Other"}]}
    nbia = {"collection": "C", "modalities": ["CT", "SEG", "MR"], "body_parts": ["LUNG", "lung"], "patients": [{"Phantom": "YES", "SpeciesDescription": "Homo sapiens"}, {"Phantom": None, "SpeciesDescription": "Mus musculus"}, {"Phantom": "no", "SpeciesDescription": "Homo sapiens"}], "errors": []}
    gated = {"nbia": None, "datacite": cite | {"rightsList": [{"rights": "NIH Controlled Data", "rightsIdentifier": None}]}}
    rows = normalizers.tcia(raw(spark, "tcia", {"nbia": nbia, "datacite": cite}, {"nbia": nbia | {"patients": [{"Phantom": "YES"}]}, "datacite": None}, gated)).orderBy("native_id").collect()
    r = rows[0]
    assert (r.name, r.summary, r.license, r.access, r.record_status) == ("Breast cancer in pediatric COVID patients", "About it.", "CC-BY-3.0", "open", "active")
    assert (r.modalities, r.keywords, r.sample_size, r.species) == (["MRI", "CT"], ["seg", "lung"], 2, "mixed")
    assert (r.domains, r.conditions, r.institutions) == (["pulmonology", "pediatrics", "infectious_disease"], ["breast neoplasms"], ["U", "V"])
    assert [(a.name, a.orcid) for a in r.authors] == [("A", "0-1")] and [(p.doi, p.relation) for p in r.papers] == [("10.5555/q", "is_cited_by")]
    assert (rows[1].species, rows[1].sample_size, rows[1].record_status) == ("phantom", 0, "needs_review")
    assert rows[1].summary == "C: imaging collection on The Cancer Imaging Archive (MRI, CT; 0 subjects)."
    assert (rows[2].access, rows[2].species, rows[2].sample_size) == ("application", "unknown", None)


@pytest.fixture
def store(spark):
    other = json.loads(json.dumps(NEURO))
    other["latestSnapshot"]["description"]["DatasetDOI"] = "10.18112/y"
    other["latestSnapshot"]["description"]["Name"] = "Of a Heart"
    gdc = {"project_id": "P-1", "name": "Heart", "released": True, "state": "open", "primary_site": ["Heart"], "disease_type": [], "program": {"name": "P"}, "summary": {"case_count": 1, "data_categories": [], "experimental_strategies": []}}
    copy = json.loads(json.dumps(NEURO))
    return raw(spark, "openneuro", NEURO, other, copy, ids=["ds000001", "ds000002", "ds000003"]).unionByName(raw(spark, "gdc", gdc, ids=["P-1"]))


def test_refresh(spark, store, tmp_path):
    root = str(tmp_path / "out")
    terms = refresh.Dictionaries(domains={"cardiology": ("heart",)}, conditions={"Pain": ("brain study",)})
    first = refresh.run(spark, store, root, terms, sources=("openneuro", "gdc"), day="2024-01-01")
    assert (first.code, first.errors, first.counts["added"]) == (refresh.OK, 0, 3)
    rows = {r.id: r for r in envelopes.Snapshots(spark, f"{root}/catalog").read().collect()}
    assert set(rows) == {"openneuro:ds000001", "openneuro:ds000002", "gdc:P-1"}
    assert "cardiology" in rows["openneuro:ds000002"].domains and "Pain" in rows["openneuro:ds000001"].conditions
    excluded = {r.native_id for r in envelopes.Snapshots(spark, f"{root}/excluded").read().collect()}
    assert excluded == {"openneuro:ds000003"}
    again = refresh.run(spark, store.repartition(5), root, terms, sources=("openneuro", "gdc"), day="2024-01-02")
    assert again.counts == {"added": 0, "removed": 0, "changed": 0, "unchanged": 3} and "## Changed (0)" in again.changelog
    part = refresh.run(spark, store.where("source = 'none'"), root, terms, failed=("openneuro",), sources=("openneuro", "gdc"))
    kept = {r.id for r in envelopes.Snapshots(spark, f"{root}/catalog").read().collect()}
    assert part.code == refresh.OK and kept == {"openneuro:ds000001", "openneuro:ds000002"} and part.counts["removed"] == 1


def test_refresh_refuses(spark, store, tmp_path):
    root = str(tmp_path / "out")
    assert refresh.run(spark, store, root, sources=("nowhere",)).code == refresh.MISCONFIGURED
    assert refresh.run(spark, store, root, sources=("gdc",), failed=("gdc",)).code == refresh.ALL_FAILED
    bad = store.withColumn("native_id", F.concat("native_id", F.lit(" x")))
    out = refresh.run(spark, bad, root, sources=("openneuro",))
    assert out.code == refresh.INVALID and out.errors and envelopes.Snapshots(spark, f"{root}/catalog").read() is None


def test_commands(spark, store, tmp_path, capsys):
    src, root = str(tmp_path / "raw"), str(tmp_path / "out")
    store.select(F.to_json(F.struct(*store.columns)).alias("value")).write.text(src)
    assert cli.main(["schema"]) == 0 and json.loads(capsys.readouterr().out)["additionalProperties"] is False
    assert cli.main(["validate", root], spark) == refresh.MISCONFIGURED
    assert cli.main(["refresh", src, root, "--sources", "openneuro,gdc", "--day", "d"], spark) == 0
    for command in ("validate", "graph", "diff", "gates"):
        assert cli.main([command, root], spark) == 0
    assert cli.main(["normalize", src, str(tmp_path / "n"), "--sources", "gdc"], spark) == 0
    assert spark.read.parquet(str(tmp_path / "n" / "records")).where("source = 'gdc'").count() == 1
    assert "contract errors: 0" in capsys.readouterr().out


def test_schema_is_strict():
    assert schema.unknown_fields({"id", "extra"}) == ["extra"]
    assert "| `id` | `string` | yes |" in schema.markdown()


def test_paged_source_and_probe(spark, tmp_path):
    for name, items in (("a1", [{"id": "1", "b": None}, None, {"id": "2"}]), ("a2", [{"id": "2"}, {"id": "3"}]), ("b1", [])):
        (tmp_path / name).write_text(json.dumps(items))
    spark.dataSource.register(envelopes.PagedSource)
    pages = {"hosta": [str(tmp_path / "a1"), str(tmp_path / "a2")], "hostb": [str(tmp_path / "b1")]}
    rows = spark.read.format("paged").option("pages", json.dumps(pages)).load().collect()
    assert [(r.source, r.native_id, r.payload) for r in rows] == [("hosta", "1", '{"b":null,"id":"1"}'), ("hosta", "2", '{"id":"2"}'), ("hosta", "3", '{"id":"3"}')]
    urls = spark.createDataFrame([("https://a/1",), ("https://a/1",), ("https://b/2",)], "url string")
    probed = envelopes.probe(urls, lambda u: (200 if "a" in u else 0, u))
    assert {(r.status, r.n) for r in envelopes.status_histogram(probed).collect()} == {(200, 1), (0, 1)}


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", None)], "id string, n int")
    envelopes.write_jsonl(df, str(tmp_path / "x"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "x")).collect()]
    assert sorted(lines) == ['{"id":"a","n":null}', '{"id":"b","n":1}']
    assert envelopes.read_jsonl(spark, str(tmp_path / "x"), "id string, n int").count() == 2


def test_snapshots_expire(spark, tmp_path):
    s = envelopes.Snapshots(spark, str(tmp_path / "t"))
    assert s.read() is None and s.versions() == []
    for n in range(3):
        s.write(spark.range(n + 1))
    assert s.read().count() == 3 and s.read(s.versions()[0]).count() == 1
    assert len(s.expire(1)) == 2 and len(s.versions()) == 1


def test_stream_of_payloads(spark, tmp_path):
    src, root, state = (str(tmp_path / n) for n in ("in", "store", "state"))
    one = spark.createDataFrame([("a", "p1", "2024-01-01 00:00:00"), ("a", "p2", "2024-01-02 00:00:00"), ("b", "q", "2024-01-01 00:00:00")], "native_id string, payload string, ts string")
    one.write.mode("append").json(src)
    upsert.run(spark, src, root, state, "d1").awaitTermination()
    spark.createDataFrame([("b", "q", "2024-01-03 00:00:00"), ("c", "r", "2024-01-03 00:00:00")], "native_id string, payload string, ts string").write.mode("append").json(src)
    upsert.run(spark, src, root, state, "d2").awaitTermination()
    rows = {r.native_id: (r.payload, r.first_seen) for r in envelopes.Snapshots(spark, root).read().collect()}
    assert rows == {"a": ("p2", "d1"), "b": ("q", "d1"), "c": ("r", "d2")}


def test_windows(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    total = upsert.counts_by_window(events).agg(F.sum("n")).first()[0]
    assert total == upsert.sessions(events).agg(F.sum("n")).first()[0] == events.count()
