"""Registered queries for operators that the catalog and record queries don't reach, each with SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text
from quarry.operators import answers, diff, graph, guards, lookup, merge, rawstore, tagging, validate
from quarry.plans import refresh
from quarry.plans.record_queries import _PRINT, EARLY, LATE
from quarry.plans.adapters import DOC_SQL, DOMAINS, ORDER_SQL, doc_catalog, order_catalog, read, user_snapshot, user_snapshot_sql
from quarry.sources import envelopes, normalizers
from quarry.sources.dictionaries import Dictionaries

# -- normalizers: rows of the tables as payloads of the four repositories


def _raw(df: DataFrame, source: str, native_id, payload) -> DataFrame:
    return df.select(F.lit(source).alias("source"), native_id.alias("native_id"), F.to_json(payload).alias("payload"))


def _struct(**fields) -> F.Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def normalize_openneuro(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as datasets: draft without snapshot, placeholder readme and authors, unmapped modality, ages, own DOI among the papers."""
    s = read(spark, d, "supplier")
    k = F.col("s_suppkey")
    doi = F.concat(F.lit("doi:10.18112/OpenNeuro.ds"), k.cast("string"))
    desc = _struct(Name=F.col("s_name"), Authors=F.array(F.lit("TODO:"), F.concat(F.lit(" A. "), F.col("s_name"), F.lit(" ")), F.lit("First1 Last1")), License=F.lit("CC0"), DatasetDOI=doi, ReferencesAndLinks=F.array(F.concat(F.lit("see https://doi.org/10.1000/x"), k.cast("string"), F.lit(".")), doi))
    summ = _struct(subjects=F.transform(F.sequence(F.lit(1), k.cast("int") % 4 + 1), lambda i: i.cast("string")), modalities=F.array(F.lit("MRI"), F.lit("dance")), secondaryModalities=F.when(k % 2 == 0, F.array(F.lit("MRI_Functional"))), tasks=F.array(F.lit("rest")), size=k * 1000)
    snap = F.when(k % 5 != 0, _struct(tag=F.lit("1.0"), readme=F.when(k % 3 == 0, F.lit("TODO: write")).otherwise(F.concat(F.lit("All about "), F.col("s_name"))), description=desc, summary=summ))
    meta = _struct(species=F.when(k % 4 == 0, F.lit("Mouse")).when(k % 4 == 1, F.lit("Human")).otherwise(F.lit("")), studyDomain=F.when(k % 2 == 0, F.lit("Neurology")), dxStatus=F.when(k % 3 == 0, F.lit("healthy / control")), ages=F.array(F.lit(20).cast("int"), F.lit(None).cast("int"), k.cast("int") % 3 + 20), associatedPaperDOI=F.lit(""), affirmedDefaced=k % 4 == 2)
    raw = _raw(s, "openneuro", F.concat(F.lit("ds"), k.cast("string")), _struct(id=k.cast("string"), publishDate=F.lit("2020-05-06T07:08:09Z"), metadata=meta, latestSnapshot=snap))
    out = normalizers.openneuro(raw)
    joined = lambda c: F.array_join(c, ",")
    return out.select("native_id", "excluded", "name", "summary", "dataset_doi", "published", joined("domains").alias("domains"), joined("modalities").alias("modalities"), joined("conditions").alias("conditions"), joined("keywords").alias("keywords"), "population", "species", "sample_size", "license", joined(F.transform("authors", lambda a: a["name"])).alias("authors"), joined(F.transform("papers", lambda p: p["doi"])).alias("papers"))


OPENNEURO_SQL = """WITH s AS (SELECT s_suppkey AS k, s_name AS n, CASE WHEN s_suppkey % 2 = 0 THEN 'MRI, fMRI' ELSE 'MRI' END AS m FROM supplier), r AS (
SELECT 'ds' || k AS native_id, CASE WHEN k % 5 = 0 THEN 'no_snapshot' END AS excluded, n AS name,
  CASE WHEN k % 3 = 0 THEN n || ': ' || m || ' dataset on OpenNeuro (' || (k % 4 + 1) || ' participants).' ELSE 'All about ' || n END AS summary, '10.18112/openneuro.ds' || k AS dataset_doi, '2020-05-06' AS published,
  CASE WHEN k % 2 = 0 THEN 'neurology' ELSE 'neuroscience' END AS domains, replace(m, ', ', ',') AS modalities, CASE WHEN k % 3 = 0 THEN 'healthy controls' ELSE '' END AS conditions, 'rest,dance' AS keywords,
  concat_ws('; ', CASE k % 4 WHEN 0 THEN 'Mouse' WHEN 1 THEN 'Human' END, CASE WHEN k % 3 = 0 THEN 'healthy / control' END, 'ages 20' || CASE WHEN k % 3 = 0 THEN '' ELSE '–' || (k % 3 + 20) END) AS population,
  CASE k % 4 WHEN 0 THEN 'animal' WHEN 1 THEN 'human' WHEN 2 THEN 'human' ELSE 'unknown' END AS species, k % 4 + 1 AS sample_size, 'CC0-1.0' AS license, 'A. ' || n AS authors, '10.1000/x' || k AS papers FROM s)
SELECT native_id, excluded, CASE WHEN excluded IS NULL THEN name END AS name, CASE WHEN excluded IS NULL THEN summary END AS summary, CASE WHEN excluded IS NULL THEN dataset_doi END AS dataset_doi, CASE WHEN excluded IS NULL THEN published END AS published,
  CASE WHEN excluded IS NULL THEN domains END AS domains, CASE WHEN excluded IS NULL THEN modalities END AS modalities, CASE WHEN excluded IS NULL THEN conditions END AS conditions, CASE WHEN excluded IS NULL THEN keywords END AS keywords, CASE WHEN excluded IS NULL THEN population END AS population,
  CASE WHEN excluded IS NULL THEN species END AS species, CASE WHEN excluded IS NULL THEN sample_size END AS sample_size, CASE WHEN excluded IS NULL THEN license END AS license, CASE WHEN excluded IS NULL THEN authors END AS authors, CASE WHEN excluded IS NULL THEN papers END AS papers FROM r"""


def normalize_physionet(spark: SparkSession, d: str) -> DataFrame:
    """Parts as projects: software, an unknown policy, a challenge, HTML abstracts, counts of subjects."""
    p = read(spark, d, "part")
    k = F.col("p_partkey")
    abstract = F.concat(F.lit("<p>Signals of "), (k % 50 + 10).cast("string"), F.lit(" patients &amp; more.</p>"))
    body = _struct(
        slug=F.concat(F.lit("p"), k.cast("string")), version=F.lit("1.0.0"), core_doi=F.when(k % 2 == 0, F.concat(F.lit("10.13026/A"), k.cast("string"))).otherwise(F.lit("")), version_doi=F.concat(F.lit("https://doi.org/10.13026/V"), k.cast("string")), is_latest_version=F.lit(True),
        title=F.col("p_name"), short_description=F.when(k % 3 == 0, F.concat(F.lit("Short: "), F.col("p_name"))).otherwise(F.lit("")), abstract=abstract, license=_struct(name=F.lit("CC0")), dua=F.when(k % 4 == 0, _struct(name=F.lit("Use agreement"))),
        access_policy=F.when(k % 7 == 0, F.lit("Other")).when(k % 4 == 0, F.lit("Credentialed")).otherwise(F.lit("Open")), resource_type=F.when(k % 5 == 0, F.lit("Software")).when(k % 2 == 0, F.lit("Challenge")).otherwise(F.lit("Database")), topics=F.array(F.col("p_brand")), publish_date=F.lit("2021-02-03"), main_storage_size=k, source_url=F.lit("https://x.org/p"),
    )
    out = normalizers.physionet(_raw(p, "physionet", F.concat(F.lit("p"), k.cast("string")), body))
    return out.select("native_id", "excluded", "name", "summary", "dataset_doi", F.array_join("keywords", ",").alias("keywords"), "sample_size", "sample_unit", "access", "access_notes", "license", "size_bytes")


PHYSIONET_SQL = """WITH r AS (SELECT p_partkey AS k, p_name AS n, p_brand AS b, CASE WHEN p_partkey % 5 = 0 THEN 'not_a_dataset' WHEN p_partkey % 7 = 0 THEN 'unmapped_access_policy:Other' END AS x FROM part)
SELECT 'p' || k AS native_id, x AS excluded, CASE WHEN x IS NULL THEN n END AS name, CASE WHEN x IS NULL THEN CASE WHEN k % 3 = 0 THEN 'Short: ' || n ELSE 'Signals of ' || (k % 50 + 10) || ' patients & more.' END END AS summary,
  CASE WHEN x IS NULL THEN CASE WHEN k % 2 = 0 THEN '10.13026/a' || k ELSE '10.13026/v' || k END END AS dataset_doi, CASE WHEN x IS NULL THEN b || CASE WHEN k % 2 = 0 THEN ',challenge' ELSE '' END END AS keywords,
  CASE WHEN x IS NULL THEN k % 50 + 10 END AS sample_size, CASE WHEN x IS NULL THEN 'participants' END AS sample_unit, CASE WHEN x IS NULL THEN CASE WHEN k % 4 = 0 THEN 'credentialed' ELSE 'open' END END AS access,
  CASE WHEN x IS NULL AND k % 4 = 0 THEN 'Use agreement' END AS access_notes, CASE WHEN x IS NULL THEN 'CC0-1.0' END AS license, CASE WHEN x IS NULL THEN k END AS size_bytes FROM r"""


def normalize_gdc(spark: SparkSession, d: str) -> DataFrame:
    """Customers as projects: unreleased ones, names that are diseases or studies, slides, paediatric programs, accessions."""
    c = read(spark, d, "customer")
    k = F.col("c_custkey")
    cats = F.array(_struct(data_category=F.lit("Clinical"), case_count=F.lit(5).cast("bigint")), _struct(data_category=F.lit("Sequencing Reads"), case_count=F.lit(9).cast("bigint")), _struct(data_category=F.lit("Biospecimen"), case_count=F.lit(None).cast("bigint")), _struct(data_category=F.lit("DNA Methylation"), case_count=F.lit(5).cast("bigint")))
    body = _struct(
        project_id=F.concat(F.lit("P-"), k.cast("string")), name=F.when(k % 3 == 0, F.lit("Breast Cancer")).otherwise(F.concat(F.lit("A Study of "), F.col("c_mktsegment"))), primary_site=F.array(F.lit("Breast"), F.col("c_mktsegment")), disease_type=F.array(F.lit("Stroke"), F.col("c_mktsegment")), released=k % 5 != 0, state=F.when(k % 7 == 0, F.lit("closed")).otherwise(F.lit("open")),
        dbgap_accession_number=F.when(k % 2 == 0, F.concat(F.lit("phs"), k.cast("string"))), program=_struct(name=F.when(k % 4 == 0, F.lit("TARGET")).otherwise(F.lit("TCGA")), dbgap_accession_number=F.lit("phs0")),
        summary=_struct(case_count=F.when(k % 6 != 0, k), data_categories=cats, experimental_strategies=F.array(_struct(experimental_strategy=F.when(k % 2 == 0, F.lit("Tissue Slide")).otherwise(F.lit("WXS"))))),
    )
    out = normalizers.gdc(_raw(c, "gdc", F.concat(F.lit("P-"), k.cast("string")), body))
    j = lambda x: F.array_join(x, ",").alias(x)
    return out.select("native_id", "excluded", "name", "summary", j("domains"), j("modalities"), j("conditions"), j("keywords"), "sample_size", "sample_unit", "access_notes")


GDC_SQL = f"""WITH r AS (SELECT c_custkey AS k, c_mktsegment AS s, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN 'not_released' END AS x, CASE WHEN c_custkey % 3 = 0 THEN 'Breast Cancer' ELSE 'A Study of ' || c_mktsegment END AS n, CASE WHEN c_custkey % 4 = 0 THEN 'TARGET' ELSE 'TCGA' END AS g FROM customer)
SELECT 'P-' || k AS native_id, x AS excluded, CASE WHEN x IS NULL THEN n || ' (P-' || k || ')' END AS name,
  CASE WHEN x IS NULL THEN n || ': ' || g || ' project in the NCI Genomic Data Commons' || CASE WHEN k % 6 <> 0 THEN ' with ' || k || ' cases' ELSE '' END || '; primary sites: Breast, ' || s || '; data: Sequencing Reads, Clinical, DNA Methylation.' END AS summary,
  CASE WHEN x IS NULL THEN CASE WHEN k % 4 = 0 THEN 'oncology,pediatrics' ELSE 'oncology' END END AS domains, CASE WHEN x IS NULL THEN CASE WHEN k % 2 = 0 THEN 'pathology,' ELSE '' END || 'genomics,clinical_tabular' END AS modalities,
  CASE WHEN x IS NULL THEN CASE WHEN k % 3 = 0 THEN 'breast neoplasms' ELSE 'stroke,' || lower(s) END END AS conditions, CASE WHEN x IS NULL THEN 'Breast,' || s || ',' || g || ',' || CASE WHEN k % 2 = 0 THEN 'Tissue Slide' ELSE 'WXS' END END AS keywords,
  CASE WHEN x IS NULL AND k % 6 <> 0 THEN k END AS sample_size, CASE WHEN x IS NULL AND k % 6 <> 0 THEN 'cases' END AS sample_unit, CASE WHEN x IS NULL THEN '{normalizers.GDC_NOTE} ' || CASE WHEN k % 2 = 0 THEN 'phs' || k ELSE 'phs0' END || '.' END AS access_notes FROM r"""


def normalize_tcia(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as collections: all phantoms, mixed species, no patients, DOI records without images, wordings of restricted access."""
    s = read(spark, d, "supplier")
    k = F.col("s_suppkey")
    person = lambda phantom, kind: _struct(Phantom=F.lit(phantom), SpeciesDescription=F.lit(kind))
    patients = F.when(k % 5 == 0, F.array(person("YES", ""), person("yes", ""))).when(k % 5 == 1, F.array(person("NO", "Homo sapiens"), person("YES", ""))).when(k % 5 == 2, F.array(person("NO", "Homo sapiens"), person("NO", "Mus musculus"))).when(k % 5 == 3, F.array(person("NO", "Canis")))
    nbia = F.when(k % 6 != 0, _struct(collection=F.col("s_name"), modalities=F.array(F.lit("MR"), F.lit("PT"), F.lit("SEG"), F.lit("XX")), body_parts=F.array(F.lit("BRAIN"), F.lit("LUNG")), patients=patients, errors=F.when(k % 11 == 0, F.array(F.lit("timeout")))))
    title = F.when(k % 3 == 0, F.concat(F.lit("COVID scans of "), F.col("s_name"))).when(k % 3 == 1, F.concat(F.lit("Healthy pediatric "), F.col("s_name"))).otherwise(F.concat(F.lit("Lung cancer of "), F.col("s_name")))
    cite = _struct(
        doi=F.concat(F.lit("10.7937/K"), k.cast("string")), url=F.lit("https://x.org/c"), version=F.lit("2"), titles=F.array(_struct(title=F.lit("Other"), titleType=F.lit("Subtitle")), _struct(title=title, titleType=F.lit(None).cast("string"))), rightsList=F.array(_struct(rights=F.when(k % 4 == 0, F.lit("Limited Access")).otherwise(F.lit("Words")), rightsIdentifier=F.when(k % 2 == 0, F.lit("CC-BY-4.0")).otherwise(F.lit("own")))),
        creators=F.array(_struct(name=F.concat(F.lit(" "), F.col("s_name")), affiliation=F.array(F.lit("Inst A"), F.lit(" Inst A "), F.lit("")), nameIdentifiers=F.array(_struct(nameIdentifier=F.lit("0000-1"), nameIdentifierScheme=F.lit("orcid"))))),
        relatedIdentifiers=F.array(_struct(relatedIdentifier=F.lit("https://doi.org/10.1000/a"), relatedIdentifierType=F.lit("DOI"), relationType=F.lit("IsSupplementTo")), _struct(relatedIdentifier=F.lit("10.1000/a"), relatedIdentifierType=F.lit("doi"), relationType=F.lit("Cites")), _struct(relatedIdentifier=F.lit("x"), relatedIdentifierType=F.lit("URL"), relationType=F.lit("Cites"))),
    )
    out = normalizers.tcia(_raw(s, "tcia", F.col("s_name"), _struct(nbia=nbia, datacite=cite)))
    j = lambda x: F.array_join(x, ",").alias(x)
    return out.select("native_id", "name", j("domains"), j("modalities"), j("conditions"), j("keywords"), "species", "sample_size", "access", "license", j("institutions"), F.array_join(F.transform("authors", lambda a: F.concat_ws("|", a["name"], a["orcid"])), ",").alias("authors"), F.array_join(F.transform("papers", lambda p: F.concat_ws("|", p["doi"], p["relation"])), ",").alias("papers"), "record_status")


TCIA_SQL = """SELECT n AS native_id, CASE k % 3 WHEN 0 THEN 'COVID scans of ' WHEN 1 THEN 'Healthy pediatric ' ELSE 'Lung cancer of ' END || n AS name, CASE k % 3 WHEN 0 THEN 'pulmonology,infectious_disease' WHEN 1 THEN 'pediatrics' ELSE 'oncology' END AS domains,
  CASE WHEN k % 6 <> 0 THEN 'MRI,PET' ELSE '' END AS modalities, CASE WHEN k % 3 = 2 THEN 'lung neoplasms' ELSE '' END AS conditions, CASE WHEN k % 6 <> 0 THEN 'seg,brain,lung' ELSE '' END AS keywords,
  CASE WHEN k % 6 = 0 THEN 'unknown' ELSE CASE k % 5 WHEN 0 THEN 'phantom' WHEN 1 THEN 'human' WHEN 2 THEN 'mixed' WHEN 3 THEN 'animal' ELSE 'unknown' END END AS species,
  CASE WHEN k % 6 <> 0 THEN CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 1 END END AS sample_size, CASE WHEN k % 6 <> 0 THEN 'open' WHEN k % 4 = 0 THEN 'application' ELSE 'registration' END AS access,
  CASE WHEN k % 2 = 0 THEN 'CC-BY-4.0' ELSE 'Words' END AS license, 'Inst A' AS institutions, n || '|0000-1' AS authors, '10.1000/a|describes' AS papers, CASE WHEN k % 6 = 0 OR k % 11 = 0 THEN 'needs_review' ELSE 'active' END AS record_status
FROM (SELECT s_suppkey AS k, s_name AS n FROM supplier)"""

# -- rules, dedupe, differences

_RULES = Dictionaries(
    domains={"critical_care": ("system", "systemat*"), "public_health": ("data", "report")},
    modalities={"survey": ("question", "questions"), "EEG": ("signal",)},
    conditions={"stroke": ("time", "times"), "sepsis": ("the people",)},
    animal=("water",),
    human=("people", "man"),
    topics={"en": ("domain", "pediatrics"), "de": ("modality", "ECG")},
    body_parts={"SRC3": "stroke"},
    mentions=("world", "work"),
    topic_source="src1",
    part_source="src3",
)


def rule_hits(spark: SparkSession, d: str) -> DataFrame:
    """What rules find in documents, whose language and source stand for their keywords."""
    rows = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", "text", F.array("lang", "source").alias("keywords"))
    hits = tagging.rule_hits(rows, _RULES, ("pediatrics", "critical_care", "public_health"), ("EEG", "ECG", "survey"))
    said = lambda v: F.array_join(F.element_at("evidence", F.lit(v)), "|")
    return hits.select(F.col("id").cast("long").alias("doc_id"), *[F.array_join(c, ",").alias(c) for c in ("domains", "modalities", "conditions")], "species", F.coalesce(said("public_health"), F.lit("")).alias("public_health"), F.coalesce(said("stroke"), F.lit("")).alias("stroke"), F.coalesce(said("species"), F.lit("")).alias("said_species"))


def _has(term: str, of: str = "t") -> str:
    return f"regexp_matches({of}, '{text.term_pattern(term)}')"


def _said(term: str, of: str = "t") -> str:
    return f"nullif(regexp_extract({of}, '{text.term_pattern(term)}', 1), '')"


RULES_SQL = f"""WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') || ' ' || concat_ws(' ', lang, source) AS t FROM documents), e AS (SELECT *, source = 'src3' AND ({_has('world')} OR {_has('work')}) AS part,
  list_distinct(list_filter([{_said('water')}, {_said('people')}, {_said('man')}], lambda x: x IS NOT NULL)) AS sp FROM d)
SELECT doc_id, concat_ws(',', CASE WHEN source = 'src1' AND lang = 'en' THEN 'pediatrics' END, CASE WHEN {_has('system')} OR {_has('systemat*')} THEN 'critical_care' END, CASE WHEN {_has('data')} OR {_has('report')} THEN 'public_health' END) AS domains,
  concat_ws(',', CASE WHEN {_has('signal')} THEN 'EEG' END, CASE WHEN source = 'src1' AND lang = 'de' THEN 'ECG' END, CASE WHEN {_has('question')} OR {_has('questions')} THEN 'survey' END) AS modalities,
  concat_ws(',', CASE WHEN {_has('the people')} THEN 'sepsis' END, CASE WHEN {_has('time')} OR {_has('times')} OR part THEN 'stroke' END) AS conditions,
  CASE WHEN {_has('water')} AND NOT ({_has('people')} OR {_has('man')}) THEN 'animal' END AS species,
  concat_ws('|', {_said('data')}, {_said('report')}) AS public_health, concat_ws('|', {_said('time')}, {_said('times')}, CASE WHEN part THEN 'src3' END) AS stroke,
  concat_ws('|', {_said('water')}, CASE WHEN {_said('people')} IS DISTINCT FROM {_said('water')} THEN {_said('people')} END, {_said('man')}) AS said_species FROM e"""


def dedupe_stage(spark: SparkSession, d: str) -> DataFrame:
    """Documents with links to the three after them, through the whole stage: merged, flagged, links redirected, cohorts linked."""
    docs = doc_catalog(spark, d).withColumn("source_native_id", F.concat(F.lit("C-"), (F.col("doc_id") % 40).cast("string")))
    after = [F.concat(F.lit("src"), ((F.col("doc_id") + i) % 20).cast("string"), F.lit(":"), (F.col("doc_id") + i).cast("string")) for i in (1, 2, 3)]
    rows = docs.select("id", "source", "source_native_id", "name", F.array(*after).alias("related"), F.lit("active").alias("record_status"), F.md5("text").alias("print"))
    out, gone = refresh.dedupe(rows, {"text": F.col("print")}, {"src2": r"^(C)-(\d+)$", "src3": r"^(C)-(\d+)$"}, (), (), ("src3", "src2", "src1"), ())
    kept = out.select("id", "record_status", F.size("related").cast("long").alias("n_related"), F.array_join(F.array_sort("related"), ",").alias("related"), F.lit(None).cast("string").alias("merged"))
    return kept.unionByName(gone.select(F.col("native_id").alias("id"), F.lit("excluded").alias("record_status"), F.lit(0).cast("long").alias("n_related"), F.lit("").alias("related"), F.col("reason").alias("merged")))


def pointer_diff(spark: SparkSession, d: str) -> DataFrame:
    """Orders' lines as lists, before and after: one number of a list changed, a list that grew, a struct's field, rows that came and went."""
    line = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag")))).alias("lines"))
    o = read(spark, d, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"))
    k = F.col("o_orderkey")
    base = o.select(k.cast("string").alias("id"), "lines", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")).alias("head"), F.transform("lines", lambda x: x["part"]).alias("parts"), k.alias("k"))
    old = base.where("k % 10 != 0").drop("k")
    changed = F.transform("lines", lambda x, i: F.when((k % 7 == 0) & (i == 0), x.withField("flag", F.lit("Z"))).otherwise(x))
    new = o.select(
        k.cast("string").alias("id"), changed.alias("lines"), F.struct(F.when(k % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("status"), F.col("o_custkey").alias("customer")).alias("head"),
        F.when(k % 3 == 0, F.concat(F.transform("lines", lambda x: x["part"]), F.array(F.lit(0).cast("bigint")))).otherwise(F.transform("lines", lambda x: x["part"])).alias("parts"),
    ).where(k % 11 != 0)
    return diff.pointer_diff(old, new)


POINTER_SQL = """WITH l AS (SELECT l_orderkey AS k, list({'no': l_linenumber, 'part': l_partkey, 'flag': l_returnflag} ORDER BY l_linenumber, l_partkey, l_returnflag) AS lines FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o_orderkey AS k, o_orderstatus AS s, lines, '[' || array_to_string(list_transform(lines, lambda x: x.part), ',') || ']' AS parts, '[' || array_to_string(list_transform(lines, lambda x: x.part), ',') || ',0]' AS more FROM orders JOIN l ON o_orderkey = k),
both_ AS (SELECT * FROM o WHERE k % 10 <> 0 AND k % 11 <> 0)
SELECT CAST(k AS VARCHAR) AS id, 'added' AS kind, NULL AS path, NULL AS old, NULL AS new FROM o WHERE k % 10 = 0 AND k % 11 <> 0
UNION ALL SELECT CAST(k AS VARCHAR), 'removed', NULL, NULL, NULL FROM o WHERE k % 10 <> 0 AND k % 11 = 0
UNION ALL SELECT CAST(k AS VARCHAR), 'changed', '/lines/0/flag', lines[1].flag, 'Z' FROM both_ WHERE k % 7 = 0
UNION ALL SELECT CAST(k AS VARCHAR), 'changed', '/head/status', s, 'X' FROM both_ WHERE k % 5 = 0
UNION ALL SELECT CAST(k AS VARCHAR), 'changed', '/parts', parts, more FROM both_ WHERE k % 3 = 0"""



def changelog_document(spark: SparkSession, d: str) -> DataFrame:
    """The whole changelog between two prices of parts, line by line."""
    p = read(spark, d, "part")
    k = F.col("p_partkey")
    cells = lambda size, brand: p.select(k.cast("string").alias("id"), F.col("p_name").alias("name"), F.concat(F.lit("https://x.org/"), k.cast("string")).alias("url"), size.alias("size"), brand.alias("brand"), k.alias("k"))
    old = cells(F.col("p_size"), F.col("p_brand")).where("k % 50 != 1").drop("k")
    new = cells(F.when(k % 20 == 0, F.col("p_size") + 100).otherwise(F.col("p_size")), F.when(k % 40 == 0, F.lit("a|b`c")).otherwise(F.col("p_brand"))).where("k % 50 != 2").drop("k")
    found = diff.pointer_diff(old, new)
    counts = {c: int(v) for c, v in diff.diff_counts(old, new, found).first().asDict().items()}
    names = new.select("id", "name", "url").unionByName(old.join(new.select(F.col("id").alias("now")), F.col("id") == F.col("now"), "left_anti").select("id", "name", "url"))
    runs = [{"source": "b", "status": "ok", "listed": 7, "written": 2, "unchanged": 5, "removed": 0, "seconds": 1.5}, {"source": "a", "status": "failed", "seconds": 0, "error": "no | answer"}]
    made = diff.document(found, names, counts, "2024-05-01", runs, {"backend": "none", "calls": 3}, 4, most=3, paths=1)
    return spark.createDataFrame([(i, x) for i, x in enumerate(made.rstrip("\n").split("\n"))], "n long, line string")


DOCUMENT_SQL = """WITH p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS id, p_name AS n, p_size AS s, p_brand AS b FROM part), c AS (SELECT * FROM p WHERE k % 20 = 0 AND k % 50 NOT IN (1, 2)), a AS (SELECT * FROM p WHERE k % 50 = 1), r AS (SELECT * FROM p WHERE k % 50 = 2),
x(o, line) AS (VALUES (0, '# Refresh 2024-05-01'), (1, ''), (3, ''), (4, '## Sources'), (5, ''), (6, '| source | status | listed | written | unchanged | removed | seconds | error |'), (7, '|---|---|---|---|---|---|---|---|'), (8, '| a | failed | 0 | 0 | 0 | 0 | 0.00 | no \\| answer |'),
  (9, '| b | ok | 7 | 2 | 5 | 0 | 1.50 |  |'), (10, ''), (11, '## Failures'), (12, ''), (13, '- `a`: failed — no \\| answer'), (14, ''), (16, ''), (1000, ''), (1002, ''), (2000, ''), (2002, ''), (3000, ''), (3001, '## Enrichment'), (3002, ''), (3003, '- backend: `none`'), (3004, '- model: `none`'), (3005, '- calls: 3'), (3006, '- cache_hits: 0'), (3007, '- guard_drops: 0'), (3008, '- failures: 0'), (3009, '- record_errors: 0'), (3010, ''), (3011, '## Validation warnings: 4')),
y AS (SELECT o::DOUBLE AS o, line FROM x
UNION ALL SELECT 2, '**+' || (SELECT count(*) FROM a) || ' new, ~' || (SELECT count(*) FROM c) || ' changed, -' || (SELECT count(*) FROM r) || ' removed, ' || (SELECT count(*) - (SELECT count(*) FROM c) - (SELECT count(*) FROM a) - (SELECT count(*) FROM r) FROM p) || ' unchanged**'
UNION ALL SELECT 15, '## Added (' || (SELECT count(*) FROM a) || ')' UNION ALL SELECT 1001, '## Removed (' || (SELECT count(*) FROM r) || ')' UNION ALL SELECT 2001, '## Changed (' || (SELECT count(*) FROM c) || ')'
UNION ALL SELECT 16 + i, '- `' || id || '` — ' || n || ' — https://x.org/' || id FROM (SELECT *, row_number() OVER (ORDER BY id) AS i FROM a) WHERE i <= 3
UNION ALL SELECT 1002 + i, '- `' || id || '` — ' || n || ' — https://x.org/' || id FROM (SELECT *, row_number() OVER (ORDER BY id) AS i FROM r) WHERE i <= 3
UNION ALL SELECT 2002 + 3 * i + j, CASE j WHEN 0 THEN '- `' || id || '` — ' || n WHEN 1 THEN CASE WHEN k % 40 = 0 THEN '  - `/brand`: `' || b || '` → `a\\|b''c`' ELSE '  - `/size`: `' || s || '` → `' || (s + 100) || '`' END ELSE '  - … and 1 more' END FROM (SELECT *, row_number() OVER (ORDER BY id) AS i FROM c), range(3) t(j) WHERE i <= 3 AND (j < 2 OR k % 40 = 0)
UNION ALL SELECT 999, '- … and ' || (count(*) - 3) || ' more' FROM a HAVING count(*) > 3 UNION ALL SELECT 1999, '- … and ' || (count(*) - 3) || ' more' FROM r HAVING count(*) > 3 UNION ALL SELECT 2999, '- … and ' || (count(*) - 3) || ' more' FROM c HAVING count(*) > 3
UNION ALL SELECT 17, 'none' WHERE NOT EXISTS (SELECT 1 FROM a) UNION ALL SELECT 1003, 'none' WHERE NOT EXISTS (SELECT 1 FROM r) UNION ALL SELECT 2003, 'none' WHERE NOT EXISTS (SELECT 1 FROM c))
SELECT row_number() OVER (ORDER BY o) - 1 AS n, line FROM y"""

DEDUPE_SQL = f"""WITH {DOC_SQL}, g AS (SELECT text, min(id) AS root FROM doc WHERE text IS NOT NULL GROUP BY text), m AS (SELECT doc.*, coalesce(g.root, doc.id) AS cluster FROM doc LEFT JOIN g ON doc.text = g.text),
w AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY CASE source WHEN 'src3' THEN 1 WHEN 'src2' THEN 2 WHEN 'src1' THEN 3 ELSE 4 END, id) AS rn, first_value(id) OVER (PARTITION BY cluster ORDER BY CASE source WHEN 'src3' THEN 1 WHEN 'src2' THEN 2 WHEN 'src1' THEN 3 ELSE 4 END, id) AS prim FROM m),
kept AS (SELECT id, source, doc_id, coalesce(nullif(name, ''), (SELECT min(name) FROM doc WHERE false), '') AS name FROM w WHERE rn = 1), key AS (SELECT id, source, {_PRINT} AS fp FROM kept), hit AS (SELECT fp FROM key WHERE fp IS NOT NULL GROUP BY fp HAVING count(DISTINCT source) > 1),
rel AS (SELECT DISTINCT w.prim AS id, coalesce(t.prim, x.other) AS other FROM w, (SELECT doc_id, 'src' || ((doc_id + i) % 20) || ':' || (doc_id + i) AS other FROM documents, (VALUES (1), (2), (3)) v(i)) x LEFT JOIN w t ON t.id = x.other WHERE x.doc_id = w.doc_id),
alive AS (SELECT rel.* FROM rel JOIN kept ON rel.other = kept.id WHERE rel.id <> rel.other
  UNION SELECT a.id, b.id FROM kept a JOIN kept b ON a.doc_id % 40 = b.doc_id % 40 AND ((a.source = 'src2' AND b.source = 'src3') OR (a.source = 'src3' AND b.source = 'src2'))),
n AS (SELECT id, count(*) AS c, string_agg(other, ',' ORDER BY other) AS o FROM alive GROUP BY id)
SELECT kept.id, CASE WHEN hit.fp IS NOT NULL THEN 'needs_review' ELSE 'active' END AS record_status, coalesce(n.c, 0) AS n_related, coalesce(n.o, '') AS related, NULL AS merged FROM kept JOIN key ON kept.id = key.id LEFT JOIN hit ON key.fp = hit.fp LEFT JOIN n ON kept.id = n.id
UNION ALL SELECT id, 'excluded', 0, '', 'merged_into:' || prim FROM w WHERE rn > 1"""

# -- the raw store


def _documents_raw(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("source", F.col("doc_id").cast("string").alias("native_id"), F.col("n_chars").alias("payload"))


def raw_scan(spark: SparkSession, d: str) -> DataFrame:
    """Stored payloads that a manifest names: those of even numbers."""
    raw = _documents_raw(spark, d)
    return rawstore.scan(raw, raw.where("cast(native_id AS long) % 2 = 0"))


def raw_point_read(spark: SparkSession, d: str) -> DataFrame:
    return rawstore.point_read(_documents_raw(spark, d), "src3", "43").unionByName(rawstore.point_read(_documents_raw(spark, d), "src3", "44"))


def volatile_hash(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of payloads with a counter inside a struct left out, and one whose struct is only that counter."""
    rows = read(spark, d, "orders").select("o_orderkey", F.struct(F.col("o_custkey").alias("downloads"), F.col("o_orderstatus").alias("state")).alias("meta"), F.struct(F.col("o_custkey").alias("views")).alias("seen"), "o_orderpriority")
    return rawstore.payload_hash(rows, ["meta", "seen", "o_orderpriority"], ["meta.downloads", "seen.views", "no.such"]).select("o_orderkey", "hash")


VOLATILE_SQL = """SELECT o_orderkey, 'sha256:' || sha256('{"meta":{"state":"' || o_orderstatus || '"},"o_orderpriority":"' || o_orderpriority || '"}') AS hash FROM orders"""


def key_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Brands in upper and lower case, by the number of the part: ids that would share a file."""
    ids = read(spark, d, "part").select(F.translate(F.when(F.col("p_partkey") % 2 == 0, F.lower("p_brand")).otherwise(F.upper("p_brand")), "#", "-").alias("native_id"))
    return rawstore.collisions(ids)


COLLISIONS_SQL = "SELECT lower(replace(p_brand, '#', '-')) AS key, count(DISTINCT CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) ELSE upper(p_brand) END) AS n FROM part GROUP BY 1 HAVING count(DISTINCT CASE WHEN p_partkey % 2 = 0 THEN lower(p_brand) ELSE upper(p_brand) END) > 1"


def _some_removed(spark: SparkSession, d: str) -> DataFrame:
    return order_catalog(spark, d).withColumn("record_status", F.when(F.col("key") % 7 == 0, "removed").otherwise("active"))


def removed_filter(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a catalog of which every seventh record is removed."""
    return graph.stats(_some_removed(spark, d)).where("metric IN ('records', 'per_source', 'per_domain')")


REMOVED_SQL = f"WITH {ORDER_SQL}, live AS (SELECT * FROM cat WHERE key % 7 <> 0) SELECT 'records' AS metric, '' AS value, count(*) AS n FROM live UNION ALL SELECT 'per_source', source, count(*) FROM live GROUP BY source UNION ALL SELECT 'per_domain', domain, count(*) FROM live GROUP BY domain"


def search_index(spark: SparkSession, d: str) -> DataFrame:
    """What a search sees: live records with vocabulary fields in order."""
    out = graph.search_index(_some_removed(spark, d), DOMAINS, ("STANDARD TIN", "PROMO TIN"))
    return out.select("id", "name", "source", F.array_join("domains", ",").alias("domains"), F.size("modalities").cast("long").alias("n_modalities"), F.array_join("conditions", "|").alias("conditions"), "access", "year_start", "url", "species")


INDEX_SQL = f"WITH {ORDER_SQL} SELECT id, name, source, domain AS domains, len(list_intersect(modalities, ['STANDARD TIN', 'PROMO TIN'])) AS n_modalities, array_to_string(conditions, '|') AS conditions, access, year_start, NULL AS url, species FROM cat WHERE key % 7 <> 0"


def domain_dimming(spark: SparkSession, d: str) -> DataFrame:
    """Which parts a choice of two domains dims: records without any, records of others; hubs without any stay."""
    rows = read(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, "dataset").otherwise("condition").alias("type"), F.when(F.col("p_partkey") % 5 != 0, F.array("p_type")).otherwise(F.array().cast("array<string>")).alias("domains"))
    return rows.select("p_partkey", graph.dimmed(["STANDARD TIN", "ECONOMY TIN"]).alias("dim"), graph.dimmed([]).alias("none"))


DIMMING_SQL = "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_partkey % 3 = 0 ELSE p_type NOT IN ('STANDARD TIN', 'ECONOMY TIN') END AS dim, false AS none FROM part"


def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Statuses of all pages' addresses, from a function that stands for requests."""
    probed = envelopes.probe(read(spark, d, "pages"), lambda u: ((200, 301, 404, 0)[len(u) % 4], u))
    return envelopes.status_histogram(probed)


STATUS_SQL = "SELECT CAST([200, 301, 404, 0][1 + length(url) % 4] AS INTEGER) AS status, count(*) AS n FROM (SELECT DISTINCT url FROM pages) GROUP BY 1"


def listing_errors(spark: SparkSession, d: str) -> DataFrame:
    """Sources as a listing's ids: which repeat, and that the announced total is wrong."""
    return envelopes.listing_errors(read(spark, d, "documents").select(F.col("source").alias("native_id")), 7)


LISTING_SQL = "SELECT 'repeated' AS kind, source AS key, count(*) AS n FROM documents GROUP BY source HAVING count(*) > 1 UNION ALL SELECT 'total', '7', count(*) FROM documents HAVING count(*) <> 7"


def codes_and_years(spark: SparkSession, d: str) -> DataFrame:
    """Years, codes and labels of what orders say in words."""
    names = {"Creative Commons  Zero": "CC0-1.0", "cc-by": "CC-BY-4.0"}
    said = F.when(F.col("o_orderkey") % 3 == 0, F.lit("creative commons zero ")).when(F.col("o_orderkey") % 3 == 1, F.lit("cc-by")).otherwise(F.lit("own"))
    return read(spark, d, "orders").select(
        "o_orderkey", text.year_of(F.col("o_orderdate").cast("string")).alias("year"), text.license_code(said, names).alias("code"), text.alias(F.concat(F.lit(" "), F.col("o_orderpriority")), {"1-urgent": "now"}).alias("label"),
        F.round(text.node_size(F.col("o_custkey")), 6).alias("size"), text.rank(F.col("o_orderstatus"), ("O", "F")).cast("long").alias("place"), text.human_bytes(F.col("o_orderkey") * 1000 + 1).alias("bytes"),
    )


CODES_SQL = """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CASE o_orderkey % 3 WHEN 0 THEN 'CC0-1.0' WHEN 1 THEN 'CC-BY-4.0' END AS code, CASE WHEN o_orderpriority = '1-URGENT' THEN 'now' ELSE o_orderpriority END AS label, round(2.0 * (1 + log10(1 + o_custkey)), 6)::DOUBLE AS size,
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 0 END AS place, CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.1f KB', b / 1024.0) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576.0) ELSE printf('%.1f GB', b / 1073741824.0) END AS bytes FROM (SELECT *, o_orderkey * 1000 + 1 AS b FROM orders)"""


def html_escape(spark: SparkSession, d: str) -> DataFrame:
    """Pages escaped, and their addresses as links only if they are web addresses."""
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("javascript:"), "url")).otherwise(F.concat(F.lit(" "), F.col("url")))
    return read(spark, d, "pages").select("page_id", F.md5(text.escape_html(F.col("html"))).alias("escaped"), text.safe_href(url).alias("href"))


ESCAPE_SQL = "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped, CASE WHEN page_id % 3 <> 0 THEN url END AS href FROM pages"

# -- answers, merging, panels, validation, runs


def guarded_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of which a part passes: an unknown domain, a modality without a quote, a bad country code, a long summary."""
    docs = read(spark, d, "documents").where("text IS NOT NULL")
    none = F.array().cast("array<string>")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "source", "text", F.lit("active").alias("record_status"), F.array(F.lit("fr")).alias("domains"), none.alias("modalities"), F.array(F.lit("Stroke")).alias("conditions"), F.lit("old").alias("summary"), F.when(F.col("doc_id") % 2 == 0, "known").alias("population"), F.array(F.lit("US")).alias("countries"))
    quote = text.first_words(F.col("text"), 3)
    answer = F.struct((F.col("doc_id") % 4 != 0).alias("in_scope"), F.array("lang", F.lit("bogus")).alias("domains"), F.array(F.struct(F.lit("m1").alias("value"), F.lit("not in the text at all, never").alias("evidence")), F.struct(F.lit("m9").alias("value"), quote.alias("evidence"))).alias("modalities"), F.array(F.struct(F.lit("tbi").alias("label"), F.lit("never there, either").alias("evidence"))).alias("conditions"), F.lit(None).cast("string").alias("summary"), F.lit("told").alias("population"), F.array(F.lit("DE"), F.lit("x1"), F.lit("US")).alias("countries"))
    said = docs.where("doc_id % 3 != 0").select(F.col("doc_id").cast("string").alias("id"), answer.alias("answer"))
    out = guards.apply_answers(rows, said, ("de", "en", "es", "fr"), ("m1",), {"tbi": "injury"}, ("src1", "src2"))
    j = lambda c: F.array_join(c, ",").alias(c)
    return out.select("id", j("domains"), j("modalities"), j("conditions"), "summary", "population", j("countries"), "record_status", F.col("drops").cast("long").alias("drops"))


ANSWERS_SQL = """WITH a AS (SELECT *, doc_id % 3 <> 0 AS asked FROM documents WHERE text IS NOT NULL)
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN asked AND lang IS NOT NULL AND lang < 'fr' THEN lang || ',fr' ELSE 'fr' END AS domains, '' AS modalities, 'Stroke' AS conditions, 'old' AS summary, CASE WHEN doc_id % 2 = 0 THEN 'known' WHEN asked THEN 'told' END AS population,
  CASE WHEN asked THEN 'US,DE' ELSE 'US' END AS countries, CASE WHEN asked AND doc_id % 4 = 0 AND source IN ('src1', 'src2') THEN 'needs_review' ELSE 'active' END AS record_status, CASE WHEN asked THEN 5 + CASE WHEN lang IS NULL THEN 1 ELSE 0 END ELSE 0 END AS drops FROM a"""


def any_member_status(spark: SparkSession, d: str) -> DataFrame:
    """Customers of a segment and nation as one cluster: its status, species, first years, strictest access and its notes."""
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("cluster"), F.concat(F.lit("c"), F.lpad(k.cast("string"), 9, "0")).alias("id"), F.lit("s").alias("source"), F.when(k % 9 == 0, "needs_review").otherwise("active").alias("record_status"),
        F.when(k % 4 == 0, F.lit("human")).otherwise(F.lit("unknown")).alias("species"), F.when(k % 3 == 0, k.cast("int")).alias("year_start"), F.when(k % 5 == 0, "closed").when(k % 2 == 0, "asked").otherwise("open").alias("access"), F.concat(F.lit("note "), k.cast("string")).alias("access_notes"),
    )
    return merge.merge_clusters(rows, ("s",), (), (), ("open", "asked", "closed")).select("cluster", "id", "record_status", "species", "year_start", "access", "access_notes")


MEMBER_SQL = """WITH c AS (SELECT c_mktsegment || '-' || c_nationkey AS cluster, 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS id, c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS a FROM customer),
g AS (SELECT cluster, min(id) AS id, bool_or(k % 9 = 0) AS r, bool_or(k % 4 = 0) AS h, arg_min(k, id) FILTER (WHERE k % 3 = 0) AS y, max(a) AS a, arg_min(a, id) AS a1, min(k) AS k1 FROM c GROUP BY cluster)
SELECT g.cluster, g.id, CASE WHEN r THEN 'needs_review' ELSE 'active' END AS record_status, CASE WHEN h THEN 'human' ELSE 'unknown' END AS species, CAST(y AS INTEGER) AS year_start, ['open', 'asked', 'closed'][g.a] AS access, 'note ' || CASE WHEN a1 = g.a THEN k1 ELSE (SELECT min(k) FROM c WHERE c.cluster = g.cluster AND c.a = g.a) END AS access_notes FROM g"""


def panel_merge(spark: SparkSession, d: str) -> DataFrame:
    """What is shown of parts: from the record, else the index, else the node."""
    p = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_type", "p_partkey")
    found, index, records = p.select("id", F.lit("node").alias("label")), p.where("p_partkey % 2 = 0").select("id", F.col("p_type").alias("label")), p.where("p_partkey % 3 = 0").select("id", F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("label"))
    return graph.panel(found, index, records, ("label",))


PANEL_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey % 3 = 0 AS \"full\", CASE WHEN p_partkey % 3 = 0 AND p_partkey % 9 <> 0 THEN p_name WHEN p_partkey % 2 = 0 THEN p_type ELSE 'node' END AS label FROM part"


def _supplies(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey") % 50).alias("source"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("target")).distinct()


def hub_collapse(spark: SparkSession, d: str) -> DataFrame:
    """What stays when one of two expanded hubs folds: what the other shows, and what is pinned."""
    edges = _supplies(spark, d)
    shown = edges.select(F.col("target").alias("id")).distinct()
    return graph.collapse(shown, edges, "p1", ["p1", "p2"], ["s5"])


COLLAPSE_SQL = "WITH e AS (SELECT DISTINCT 'p' || (l_partkey % 50) AS p, 's' || l_suppkey AS s FROM lineitem) SELECT DISTINCT s AS id FROM e WHERE s = 's5' OR s NOT IN (SELECT s FROM e WHERE p = 'p1') OR s IN (SELECT s FROM e WHERE p = 'p2')"


def graph_contract(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with a graph of orders from which nodes are missing, in which one is repeated, and that has one too many."""
    cat = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 6 == 0, "removed").otherwise("active").alias("record_status"))
    own = cat.where("k % 10 != 0").select("id", F.lit("dataset").alias("type"))
    found = own.unionByName(cat.where("k % 25 = 7").select("id", F.lit("dataset").alias("type")))
    return graph.contract_errors(found, cat.select(F.col("id").alias("source"), F.col("id").alias("target")), cat)


CONTRACT_SQL = """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id FROM orders) SELECT 'duplicate_node' AS kind, id FROM o WHERE k % 25 = 7 AND k % 10 <> 0 UNION ALL SELECT 'dangling_link', id FROM o WHERE k % 10 = 0
UNION ALL SELECT 'missing_node', id FROM o WHERE k % 10 = 0 AND k % 6 <> 0 UNION ALL SELECT 'unknown_record', id FROM o WHERE k % 10 <> 0 AND k % 6 = 0"""


def source_metrics(spark: SparkSession, d: str) -> DataFrame:
    """What each source contributed, from tables of ids."""
    ids = read(spark, d, "documents").select(F.concat("source", F.lit(":"), F.col("doc_id").cast("string")).alias("id"), "doc_id", "source")
    listed = ids.groupBy("source").agg(F.count("*").alias("listed")).withColumn("status", F.when(F.col("source") == "src2", "failed").otherwise("ok"))
    pick = lambda k: ids.where(f"doc_id % 4 = {k}").select("id")
    return refresh.source_metrics(listed, pick(0), pick(1), pick(2), pick(3).where("id NOT LIKE 'src5:%'"))


METRICS_SQL = "SELECT source, CASE WHEN source = 'src2' THEN 'failed' ELSE 'ok' END AS status, count(*) AS listed, count(*) FILTER (WHERE doc_id % 4 = 0) AS records, count(*) FILTER (WHERE doc_id % 4 = 1) AS excluded, count(*) FILTER (WHERE doc_id % 4 = 2) AS record_errors, count(*) FILTER (WHERE doc_id % 4 = 3 AND source <> 'src5') AS retained FROM documents GROUP BY source"


def manifest_results(spark: SparkSession, d: str) -> DataFrame:
    """Nations' last harvests: some never ran, some without a status, some that failed."""
    n = read(spark, d, "nation")
    k = F.col("n_nationkey")
    counts = F.struct(*[(k + i).cast("long").alias(c) for i, c in enumerate(("listed", "written", "unchanged"))], F.lit(None).cast("long").alias("removed"))
    manifests = n.where(k % 3 != 0).select(F.col("n_name").alias("source"), F.when(k % 2 == 0, "failed").alias("status"), F.when(k % 2 == 0, "timeout").alias("error"), counts.alias("counts"))
    return refresh.manifest_results(n.select(F.col("n_name").alias("source")), manifests)


MANIFEST_SQL = "SELECT n_name AS source, CASE WHEN k % 3 = 0 THEN 'skipped' WHEN k % 2 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN k % 3 = 0 THEN 0 ELSE k END AS listed, CASE WHEN k % 3 = 0 THEN 0 ELSE k + 1 END AS written, CASE WHEN k % 3 = 0 THEN 0 ELSE k + 2 END AS unchanged, 0 AS removed, CASE WHEN k % 3 = 0 THEN 'no raw data' WHEN k % 2 = 0 THEN 'timeout' END AS error FROM (SELECT *, n_nationkey AS k FROM nation)"


def stale_rows(spark: SparkSession, d: str) -> DataFrame:
    """Records kept from an older catalog: those that are no longer valid go, and why."""
    rows = read(spark, d, "customer").select(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("id"), "c_custkey", F.col("c_mktsegment").alias("domain"))
    bad = validate.violations(rows, {"a: old": F.col("c_custkey") % 5 == 0, "b: odd": F.col("c_custkey") % 10 == 5}, "error").unionByName(validate.violations(rows, {"w": F.col("c_custkey") % 3 == 0}, "warning"))
    kept, gone = refresh.stale(rows, bad)
    return kept.select("id", F.lit(None).cast("string").alias("message")).unionByName(gone)


STALE_SQL = "SELECT 'c:' || c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'retained record is no longer valid: a: old' || CASE WHEN c_custkey % 10 = 5 THEN '; b: odd' ELSE '' END END AS message FROM customer"


def unknown_values(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.array(F.substring_index("p_type", " ", 1), F.lit("SMALL")).alias("domains"))
    return refresh.unknown_values(rows, {"domains": ("SMALL", "STANDARD", "PROMO")})


UNKNOWN_SQL = "SELECT CAST(p_partkey AS VARCHAR) AS id, 'error' AS severity, 'domains: unknown value ' || split_part(p_type, ' ', 1) AS message FROM part WHERE split_part(p_type, ' ', 1) NOT IN ('SMALL', 'STANDARD', 'PROMO')"


def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Findings of two runs: found again, anew, no longer, and not to be mended; then those unseen for long."""
    rows = read(spark, d, "labels").select(F.col("doc_id").cast("string").alias("key"), "doc_id", F.when(F.col("toxic") == 1, "high").otherwise("low").alias("severity"))
    ledger = rows.where("doc_id % 3 != 0").select("key", F.lit("data").alias("lens"), F.lit("low").alias("severity"), F.when(F.col("doc_id") % 5 == 0, "wontfix").when(F.col("doc_id") % 7 == 0, "fixed").otherwise("open").alias("status"), F.lit("2024-01-01").alias("first_seen"), F.lit("2024-01-02").alias("last_seen"))
    out = validate.ledger_upsert(ledger, rows.where("doc_id % 4 != 0").select("key", F.lit("code").alias("lens"), "severity"), "2024-02-01")
    return validate.age_open(out, "2024-01-15")


LEDGER_SQL = """SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN f THEN 'code' ELSE 'data' END AS lens, CASE WHEN f THEN CASE WHEN toxic = 1 THEN 'high' ELSE 'low' END ELSE 'low' END AS severity,
  CASE WHEN f AND NOT (l AND doc_id % 5 = 0) THEN 'open' WHEN doc_id % 5 = 0 THEN 'wontfix' WHEN doc_id % 7 = 0 THEN 'fixed' ELSE 'stale' END AS status, CASE WHEN l THEN '2024-01-01' ELSE '2024-02-01' END AS first_seen, CASE WHEN f THEN '2024-02-01' ELSE '2024-01-02' END AS last_seen
FROM (SELECT *, doc_id % 3 <> 0 AS l, doc_id % 4 <> 0 AS f FROM labels) WHERE l OR f"""


def prompt_inputs(spark: SparkSession, d: str) -> DataFrame:
    """What a call would see of each document, the address of its answer, and which calls documents without an answer make, eight each."""
    rows = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "doc_id", F.col("lang").alias("name"), "source", answers.excerpt(F.col("text"), 20).alias("text"))
    out = answers.inputs(rows, F.col("text"), ("source",), "v1", "s1")
    return out.select("id", "name", "facts", "key")


INPUTS_SQL = r"""SELECT id, name, facts, sha256(concat_ws(chr(10), 'v1', 's1', id, name, facts, t)) AS key FROM (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(lang, '') AS name, '{"source":"' || source || '"}' AS facts,
  substr(coalesce(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g')), ''), 1, 20) AS t FROM documents)"""


def call_batches(spark: SparkSession, d: str) -> DataFrame:
    """How many calls documents make, eight each, and how full they are."""
    misses = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.sha2(F.col("doc_id").cast("string"), 256).alias("key"))
    sizes = lookup.batches(misses, 8).groupBy("batch").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("records"), (F.max("n") <= 8).alias("within"))


BATCHES_SQL = "SELECT count(*) AS records, true AS within FROM documents"


def user_pointers(spark: SparkSession, d: str) -> DataFrame:
    """Users' last events of two months, by pointer."""
    return diff.pointer_diff(user_snapshot(spark, d, EARLY), user_snapshot(spark, d, LATE), ("value",)).select("id", "kind", "path")


USER_POINTERS_SQL = f"""WITH a AS ({user_snapshot_sql(EARLY)}), b AS ({user_snapshot_sql(LATE)})
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'added' ELSE 'removed' END AS kind, NULL AS path FROM a FULL JOIN b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL
UNION ALL SELECT a.id, 'changed', '/event_type' FROM a JOIN b ON a.id = b.id WHERE a.event_type IS DISTINCT FROM b.event_type UNION ALL SELECT a.id, 'changed', '/props/k' FROM a JOIN b ON a.id = b.id WHERE a.k IS DISTINCT FROM b.k"""


def affiliation_choice(spark: SparkSession, d: str) -> DataFrame:
    """A registry's answers for customers: chosen with a good score, chosen with a bad one, not chosen, nothing, no JSON, no answer."""
    k = F.col("c_custkey")
    body = F.when(k % 6 == 5, F.lit(None)).when(k % 6 == 4, "oops").when(k % 6 == 3, '{"items": []}').otherwise(F.concat(F.lit('{"items": [{"chosen": '), F.when(k % 6 == 2, "false").otherwise("true"), F.lit(', "score": '), F.when(k % 6 == 1, "0.5").otherwise("0.95"), F.lit(', "organization": {"id": "https://ror.org/'), k.cast("string"), F.lit('", "name": "'), F.col("c_name"), F.lit('", "locations": [{"geonames_details": {"country_code": "DE"}}]}}, {"chosen": true, "score": 1}]}')))
    return lookup.affiliations(read(spark, d, "customer").select(k.alias("key"), body.alias("body")))


AFFILIATION_SQL = "SELECT c_custkey AS key, c_custkey % 6 <> 5 AS resolved, CASE WHEN c_custkey % 6 = 0 THEN 'https://ror.org/' || c_custkey END AS ror_id, CASE WHEN c_custkey % 6 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 6 = 0 THEN 'DE' END AS country FROM customer"


def index_contract(spark: SparkSession, d: str) -> DataFrame:
    """An index that lacks every tenth order and has every removed one, and a count that is off by one."""
    cat = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 6 == 0, "removed").otherwise("active").alias("record_status"))
    count = cat.where("k % 6 != 0").agg((F.count("*") + 1).alias("n"))
    return graph.index_errors(cat.where("k % 10 != 0"), count, cat)


INDEX_CONTRACT_SQL = """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id FROM orders) SELECT 'not_indexed' AS kind, id FROM o WHERE k % 10 = 0 AND k % 6 <> 0 UNION ALL SELECT 'index_only', id FROM o WHERE k % 10 <> 0 AND k % 6 = 0
UNION ALL SELECT 'record_count', CAST(count(*) + 1 AS VARCHAR) FROM o WHERE k % 6 <> 0"""


def adjacency_index(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of parts and suppliers, of which every third supplier is no node, and a loop."""
    edges = _supplies(spark, d)
    ids = edges.select(F.col("source").alias("id")).unionByName(edges.select(F.col("target").alias("id")).where("cast(substring(id, 2) AS int) % 3 != 0")).distinct()
    loops = edges.select(F.col("source"), F.col("source").alias("target"))
    return graph.adjacency_index(edges.unionByName(loops), ids).groupBy("id").agg(F.count("*").alias("n"), F.min("other").alias("first"))


ADJACENCY_SQL = """WITH e AS (SELECT DISTINCT 'p' || (l_partkey % 50) AS p, 's' || l_suppkey AS s, l_suppkey AS k FROM lineitem), a AS (SELECT p AS id, s AS other FROM e WHERE k % 3 <> 0 UNION ALL SELECT s, p FROM e WHERE k % 3 <> 0)
SELECT id, count(*) AS n, min(other) AS first FROM a GROUP BY id"""


def focus_pins(spark: SparkSession, d: str) -> DataFrame:
    """A reader turns to a record, then to a hub: what is shown and what is pinned."""
    edges = _supplies(spark, d)
    start = edges.select(F.col("source").alias("id")).where("source IN ('p7', 'p8')").distinct()
    one, held = graph.focus(start, edges, "s4", "dataset")
    two, still = graph.focus(one, edges, "p9", "source", held)
    return two.select("id", F.lit("shown").alias("what")).unionByName(still.select("id", F.lit("pinned").alias("what")))


FOCUS_SQL = """WITH e AS (SELECT DISTINCT 'p' || (l_partkey % 50) AS p, 's' || l_suppkey AS s FROM lineitem), pin AS (SELECT p AS id FROM e WHERE s = 's4' UNION SELECT 's4'), sh AS (SELECT p AS id FROM e WHERE p IN ('p7', 'p8') UNION SELECT id FROM pin UNION SELECT s FROM e WHERE p = 'p9' UNION SELECT 'p9')
SELECT id, 'shown' AS what FROM sh UNION ALL SELECT id, 'pinned' FROM pin"""


def ledger_mark(spark: SparkSession, d: str) -> DataFrame:
    ledger = read(spark, d, "labels").select(F.col("doc_id").cast("string").alias("key"), F.when(F.col("toxic") == 1, "open").otherwise("fixed").alias("status"))
    keys = read(spark, d, "documents").where("doc_id % 4 = 1").select(F.col("doc_id").cast("string").alias("key"))
    return validate.mark(ledger, keys.unionByName(keys), "wontfix")


MARK_SQL = "SELECT CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 4 = 1 AND doc_id IN (SELECT doc_id FROM documents) THEN 'wontfix' WHEN toxic = 1 THEN 'open' ELSE 'fixed' END AS status FROM labels"


def display_labels(spark: SparkSession, d: str) -> DataFrame:
    """What is shown of orders: counts with units, values of vocabularies, links of DOIs."""
    k = F.col("o_orderkey")
    doi = F.when(k % 3 == 0, F.concat(F.lit(" 10.1000/a"), k.cast("string"))).when(k % 3 == 1, F.lit("10.1/x")).otherwise(F.lit("javascript:10.1000/a"))
    value = F.when(k % 2 == 0, F.lit("critical_care_unit")).otherwise(F.lit("mri"))
    return read(spark, d, "orders").select("o_orderkey", text.count_label(k * 1001, F.when(k % 2 == 0, F.lit("records"))).alias("size"), text.value_label(value, {"mri": "MRI"}).alias("label"), text.doi_url(doi).alias("link"))


LABEL_SQL = "SELECT o_orderkey, format('{:,}', o_orderkey * 1001) || CASE WHEN o_orderkey % 2 = 0 THEN ' records' ELSE '' END AS size, CASE WHEN o_orderkey % 2 = 0 THEN 'Critical care unit' ELSE 'MRI' END AS label, CASE WHEN o_orderkey % 3 = 0 THEN 'https://doi.org/10.1000/a' || o_orderkey END AS link FROM orders"


def provenance(spark: SparkSession, d: str) -> DataFrame:
    """Parts as records: first seen as the manifest says, or today; last seen today; the stored hash, or their own."""
    p = read(spark, d, "part")
    rows = p.select(F.lit("s").alias("source"), F.col("p_partkey").cast("string").alias("source_native_id"), F.lit("own").alias("raw_hash"), "p_partkey")
    manifest = p.where("p_partkey % 3 != 0").select(F.lit("s").alias("source"), F.col("p_partkey").cast("string").alias("native_id"), F.col("p_name").alias("hash"), F.lit("2023-05-06").cast("date").alias("first_seen"))
    return refresh.provenance(rows, manifest, "api", "2024-01-01").select("p_partkey", "provenance.*")


PROVENANCE_SQL = "SELECT p_partkey, 'api' AS harvested_via, CASE WHEN p_partkey % 3 <> 0 THEN '2023-05-06' ELSE '2024-01-01' END AS harvested_at, '2024-01-01' AS last_verified, CASE WHEN p_partkey % 3 <> 0 THEN p_name ELSE 'own' END AS raw_hash FROM part"


def attribution(spark: SparkSession, d: str) -> DataFrame:
    """Who is behind the fields of parts: rules, a model, both, nobody."""
    k = F.col("p_partkey")
    none = F.array().cast("array<string>")
    rows = read(spark, d, "part").select("p_partkey", F.when(k % 2 == 0, F.array(F.lit("domains"), F.lit("species"))).otherwise(none).alias("enriched"), F.when(k % 3 == 0, F.array(F.lit("domains"), F.lit("summary"))).alias("told"))
    out = refresh.attributed(rows, "enriched", "told", "m1", "v2", "2024-01-01")
    return out.select("p_partkey", *[F.col(f"enrichment.{c}").alias(c) for c in ("method", "model", "prompt_version", "at")], F.array_join(F.transform(F.array_sort(F.map_entries("enrichment.fields")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("fields"))


ATTRIBUTION_SQL = """SELECT p_partkey, CASE WHEN r AND t THEN 'mixed' WHEN t THEN 'llm' WHEN r THEN 'rules' ELSE 'none' END AS method, CASE WHEN t THEN 'm1' END AS model, CASE WHEN t THEN 'v2' END AS prompt_version, CASE WHEN r OR t THEN '2024-01-01' END AS at,
  concat_ws(',', CASE WHEN r THEN 'domains=rules' WHEN t THEN 'domains=llm' END, CASE WHEN r THEN 'species=rules' END, CASE WHEN t THEN 'summary=llm' END) AS fields FROM (SELECT p_partkey, p_partkey % 2 = 0 AS r, p_partkey % 3 = 0 AS t FROM part)"""


def text_join(spark: SparkSession, d: str) -> DataFrame:
    """Documents' texts by source and id, and how many of each source have none."""
    docs = read(spark, d, "documents")
    rows = docs.select("source", F.col("doc_id").cast("string").alias("source_native_id"))
    have, lack = refresh.with_text(rows, docs.where("doc_id % 7 != 0").select("source", F.col("doc_id").cast("string").alias("native_id"), F.col("lang").alias("text")))
    return have.groupBy("source").agg(F.count("*").alias("n"), F.count("text").alias("known")).join(lack, "source", "left").na.fill({"missing": 0})


TEXT_JOIN_SQL = "SELECT source, count(*) FILTER (WHERE doc_id % 7 <> 0) AS n, count(lang) FILTER (WHERE doc_id % 7 <> 0) AS known, count(*) FILTER (WHERE doc_id % 7 = 0) AS missing FROM documents GROUP BY source HAVING count(*) FILTER (WHERE doc_id % 7 <> 0) > 0"


def enrichment_stats(spark: SparkSession, d: str) -> DataFrame:
    """Calls, hits, drops and failures of a pass over documents."""
    rows = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key"), "doc_id")
    cache = rows.where("doc_id % 3 = 0").select("key", F.lit("x").alias("output"))
    return refresh.enrichment_stats(rows, cache, rows.where("doc_id % 3 = 1").select("key"), rows.select((F.col("doc_id") % 4).alias("drops")))


STATS_SQL = "SELECT CAST(ceil(count(*) FILTER (WHERE doc_id % 3 <> 0) / 8.0) AS BIGINT) AS calls, count(*) FILTER (WHERE doc_id % 3 = 0) AS cache_hits, CAST(sum(doc_id % 4) AS BIGINT) AS guard_drops, count(*) FILTER (WHERE doc_id % 3 = 2) AS failures FROM documents"

QUERIES = {
    "normalize_openneuro": normalize_openneuro, "normalize_physionet": normalize_physionet, "normalize_gdc": normalize_gdc, "normalize_tcia": normalize_tcia, "rule_hits": rule_hits, "dedupe_stage": dedupe_stage, "diff_lists": pointer_diff,
    "changelog_document": changelog_document, "raw_scan": raw_scan, "raw_point_read": raw_point_read, "volatile_hash": volatile_hash, "key_collisions": key_collisions, "removed_filter": removed_filter, "search_index": search_index,
    "domain_dimming": domain_dimming, "status_histogram": status_histogram, "listing_errors": listing_errors, "codes_and_years": codes_and_years, "html_escape": html_escape, "guarded_answers": guarded_answers, "any_member_status": any_member_status,
    "panel_merge": panel_merge, "hub_collapse": hub_collapse, "graph_contract_seeded": graph_contract, "source_metrics": source_metrics, "manifest_results": manifest_results, "stale_rows": stale_rows, "unknown_values": unknown_values, "ledger_upsert": ledger_upsert,
    "prompt_inputs": prompt_inputs, "call_batches": call_batches, "snapshot_diff_pointers": user_pointers,
    "affiliation_choice": affiliation_choice, "index_contract": index_contract, "adjacency_index": adjacency_index, "focus_pins": focus_pins, "ledger_mark": ledger_mark, "display_labels": display_labels, "provenance": provenance, "attribution": attribution,
    "text_join": text_join, "enrichment_stats": enrichment_stats,
}

ORACLES = {
    "normalize_openneuro": OPENNEURO_SQL, "normalize_physionet": PHYSIONET_SQL, "normalize_gdc": GDC_SQL, "normalize_tcia": TCIA_SQL, "rule_hits": RULES_SQL, "dedupe_stage": DEDUPE_SQL, "diff_lists": POINTER_SQL, "changelog_document": DOCUMENT_SQL,
    "raw_scan": "SELECT source, CAST(doc_id AS VARCHAR) AS native_id, n_chars AS payload FROM documents WHERE doc_id % 2 = 0", "raw_point_read": "SELECT source, CAST(doc_id AS VARCHAR) AS native_id, n_chars AS payload FROM documents WHERE source = 'src3' AND doc_id IN (43, 44)",
    "volatile_hash": VOLATILE_SQL, "key_collisions": COLLISIONS_SQL, "removed_filter": REMOVED_SQL, "search_index": INDEX_SQL, "domain_dimming": DIMMING_SQL, "status_histogram": STATUS_SQL, "listing_errors": LISTING_SQL, "codes_and_years": CODES_SQL,
    "html_escape": ESCAPE_SQL, "guarded_answers": ANSWERS_SQL, "any_member_status": MEMBER_SQL, "panel_merge": PANEL_SQL, "hub_collapse": COLLAPSE_SQL, "graph_contract_seeded": CONTRACT_SQL, "source_metrics": METRICS_SQL, "manifest_results": MANIFEST_SQL,
    "stale_rows": STALE_SQL, "unknown_values": UNKNOWN_SQL, "ledger_upsert": LEDGER_SQL, "prompt_inputs": INPUTS_SQL, "call_batches": BATCHES_SQL, "snapshot_diff_pointers": USER_POINTERS_SQL,
    "affiliation_choice": AFFILIATION_SQL, "index_contract": INDEX_CONTRACT_SQL, "adjacency_index": ADJACENCY_SQL, "focus_pins": FOCUS_SQL, "ledger_mark": MARK_SQL, "display_labels": LABEL_SQL, "provenance": PROVENANCE_SQL, "attribution": ATTRIBUTION_SQL,
    "text_join": TEXT_JOIN_SQL, "enrichment_stats": STATS_SQL,
}
