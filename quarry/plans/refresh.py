"""The refresh: raw envelopes to a validated catalog, its graph, and what changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import keys, text
from quarry.operators import diff, graph, guards, links, lookup, merge, tagging, validate
from quarry.operators.state import cut
from quarry.sources.dictionaries import DEFAULT, Dictionaries
from quarry.sources.envelopes import Snapshots
from quarry.sources.normalizers import REGISTRY, normalize_all, split
from quarry.vocab import ACCESS_ORDER, ACCESSION_SHAPES, CASED_ACCESSIONS, CONDITION_ALIASES, DOMAINS, JOURNAL_SOURCES, LISTING_ROOTS, MODALITIES, RECORD_STATUS, SOURCE_PRIORITY, SOURCES, SPECIES

OK, INVALID, MISCONFIGURED, ALL_FAILED = 0, 1, 2, 3


def record_keys() -> dict:
    """What makes two records the same: a DOI, an address of their own, an accession."""
    return {
        "doi": keys.doi_key(F.col("dataset_doi")),
        "url": keys.url_key(F.col("url"), LISTING_ROOTS),
        "accession": keys.accession_key(F.col("source"), F.col("source_native_id"), F.col("url"), ACCESSION_SHAPES, CASED_ACCESSIONS),
    }


def apply_rules(records: DataFrame, texts: DataFrame, terms: Dictionaries) -> DataFrame:
    """Records with what the rules find in their texts and keywords added; ``enriched`` names the fields that changed by it, ``evidence`` what bore it out.

    Additive only: lists grow, an unknown species is filled, nothing else is touched. A record without a text, or of which the rules find
    nothing, stays as it is.
    """
    none = F.array().cast("array<string>")
    said = texts.select(F.concat_ws(":", "source", "native_id").alias("told"), F.col("text"))
    asked = records.select(F.col("id"), F.col("source"), F.concat_ws(":", "source", "source_native_id").alias("address"), "keywords").join(said, F.col("address") == F.col("told"))
    hits = tagging.rule_hits(asked.select("id", "source", "text", "keywords"), terms, DOMAINS, MODALITIES)
    h = hits.select(F.col("id").alias("hit_id"), F.col("domains").alias("hit_domains"), F.col("modalities").alias("hit_modalities"), F.col("conditions").alias("hit_conditions"), F.col("species").alias("hit_species"), "evidence")
    j = records.join(h, F.col("id") == F.col("hit_id"), "left")
    given = lambda c: F.coalesce(F.col(c), none)
    domains = text.ranked(F.concat(given("domains"), given("hit_domains")), DOMAINS)
    modalities = text.ranked(F.concat(given("modalities"), given("hit_modalities")), MODALITIES)
    conditions = F.concat(given("conditions"), F.filter(given("hit_conditions"), lambda c: ~F.exists(given("conditions"), lambda x: F.lower(x) == F.lower(c))))
    species = F.when(F.col("species") == "unknown", F.coalesce("hit_species", "species")).otherwise(F.col("species"))
    marks = F.array_compact(F.array(*[F.when(F.size(F.array_except(now, given(c))) > 0, F.lit(c)) for c, now in (("domains", domains), ("modalities", modalities), ("conditions", conditions))], F.when(species != F.col("species"), F.lit("species"))))
    return j.withColumns({"enriched": marks, "domains": domains, "modalities": modalities, "conditions": conditions, "species": species}).drop("hit_id", "hit_domains", "hit_modalities", "hit_conditions", "hit_species")


def provenance(records: DataFrame, manifest: DataFrame, via: str, day: str) -> DataFrame:
    """Records with ``provenance``: how they came, when they were first seen, when last, and the payload's hash.

    ``manifest`` has source, native_id, hash and first_seen. A record that it lacks is seen first on ``day``.
    """
    m = manifest.select(F.col("source").alias("of"), F.col("native_id").alias("known"), F.col("hash").alias("was"), "first_seen")
    j = records.join(m, (F.col("source") == F.col("of")) & (F.col("source_native_id") == F.col("known")), "left")
    made = F.struct(F.lit(via).alias("harvested_via"), F.coalesce(F.col("first_seen").cast("string"), F.lit(day)).alias("harvested_at"), F.lit(day).alias("last_verified"), F.coalesce(F.col("was"), F.col("raw_hash")).alias("raw_hash"))
    return j.withColumn("provenance", made).drop("of", "known", "was", "first_seen")


def attributed(records: DataFrame, by_rules: str = "enriched", by_model: str | None = None, model: str | None = None, version: str | None = None, day: str | None = None) -> DataFrame:
    """Records with ``enrichment``: method (rules, llm, mixed or none), model, prompt version, day, and who is behind each field that changed.

    ``by_rules`` and ``by_model`` are columns that list fields; a field that both changed is the rules'.
    """
    none = F.array().cast("array<string>")
    rules = F.coalesce(F.col(by_rules), none)
    told = F.array_except(F.coalesce(F.col(by_model), none), rules) if by_model else none
    of = lambda fields, who: F.transform(fields, lambda f: F.struct(f.alias("field"), F.lit(who).alias("by")))
    some, more = F.size(rules) > 0, F.size(told) > 0
    method = F.when(some & more, "mixed").when(more, "llm").when(some, "rules").otherwise("none")
    made = F.struct(method.alias("method"), F.when(more, F.lit(model)).alias("model"), F.when(more, F.lit(version)).alias("prompt_version"), F.when(some | more, F.lit(day)).alias("at"), F.map_from_entries(F.concat(of(rules, "rules"), of(told, "llm"))).alias("fields"))
    return records.withColumn("enrichment", made)


def with_text(records: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that have a text, with it; number of those by source that have none) by source and native id."""
    t = texts.select(F.col("source").alias("of"), F.col("native_id").alias("known"), "text")
    j = records.join(t, (F.col("source") == F.col("of")) & (F.col("source_native_id") == F.col("known")), "left")
    return j.where("known IS NOT NULL").drop("of", "known"), j.where("known IS NULL").groupBy("source").agg(F.count("*").alias("missing"))


def enrichment_stats(asked: DataFrame, cache: DataFrame, answered: DataFrame, applied: DataFrame, size: int = 8) -> DataFrame:
    """(calls, cache_hits, guard_drops, failures) of a pass: calls of ``size`` records each, hits of the cache, what guards dropped, misses without an answer.

    ``asked`` and ``cache`` have key, ``answered`` the keys that calls brought, ``applied`` drops. One row, from partial aggregates.
    """
    hits, misses = lookup.split_cache(asked, cache)
    n = misses.agg(F.count("*").alias("misses"))
    lost = misses.join(answered.select("key").distinct(), "key", "left_anti").agg(F.count("*").alias("failures"))
    parts = [
        hits.agg(F.count("*").alias("n")).select(F.lit("cache_hits").alias("what"), "n"),
        n.select(F.lit("calls").alias("what"), F.ceil(F.col("misses") / size).cast("long").alias("n")),
        lost.select(F.lit("failures").alias("what"), F.col("failures").alias("n")),
        applied.agg(F.coalesce(F.sum("drops"), F.lit(0)).cast("long").alias("n")).select(F.lit("guard_drops").alias("what"), "n"),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return rows.agg(*[F.max(F.when(F.col("what") == w, F.col("n"))).alias(w) for w in ("calls", "cache_hits", "guard_drops", "failures")])


def enrich(records: DataFrame, texts: DataFrame, terms: Dictionaries, answers: DataFrame | None = None, institutions: DataFrame | None = None) -> DataFrame:
    """Rules, then cached answers under their guards, then registry ids of institutions from a dimension with known negatives."""
    out = apply_rules(records, texts, terms)
    if answers is not None:
        t = texts.select(F.concat_ws(":", "source", "native_id").alias("__id"), "text")
        out = out.join(t, F.col("id") == F.col("__id"), "left").drop("__id").withColumn("countries", F.array().cast("array<string>"))
        out = guards.apply_answers(out, answers, DOMAINS, MODALITIES, CONDITION_ALIASES, JOURNAL_SOURCES).drop("text", "countries")
    if institutions is not None:
        named = out.select("id", F.posexplode("institutions").alias("pos", "name")).withColumn("ror_id", F.lit(None).cast("string"))
        filled = lookup.fill(named, F.col("name"), institutions, "ror_id").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "name", "ror_id"))).alias("found"))
        out = out.join(filled, "id", "left").withColumn("registry", F.transform("found", lambda f: F.struct(f["name"].alias("name"), f["ror_id"].alias("ror_id")))).drop("found")
    return out


def cohort_links(records: DataFrame, cohorts: Mapping[str, str]) -> DataFrame:
    """(id, other): records of different sources whose native ids name one cohort.

    ``cohorts`` gives for each source a pattern with the groups family and cohort.
    """
    out = None
    parts = {s: records.where(F.col("source") == s).select("id", F.regexp_extract("source_native_id", p, 1).alias("family"), F.regexp_extract("source_native_id", p, 2).alias("cohort")).where("family != '' AND cohort != ''") for s, p in cohorts.items()}
    names = list(parts)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            pairs = links.same_cohort(parts[a], parts[b])
            out = pairs if out is None else out.unionByName(pairs)
    return out if out is not None else records.select("id", F.col("id").alias("other")).limit(0)


def dedupe(records: DataFrame, keys_of: Mapping | None = None, cohorts: Mapping[str, str] | None = None, domains: Sequence[str] = DOMAINS, modalities: Sequence[str] = MODALITIES, priority: Sequence[str] = SOURCE_PRIORITY, access: Sequence[str] = ACCESS_ORDER) -> tuple[DataFrame, DataFrame]:
    """(records, exclusions): clustered by keys, merged, those whose titles collide flagged, links redirected, cohorts linked.

    In that order: links can only be redirected once every cluster has its primary, and cohorts be linked once ids are final.
    Links are the column ``related`` (ids), which records need not have.
    """
    records = cut(records)
    clusters = links.cluster(records, keys_of or record_keys())
    merged = cut(merge.merge_clusters(records.join(clusters, "id"), priority, domains, modalities, access))
    kept = merged.drop("cluster", "members")
    flagged = merge.flag_collisions(kept, links.title_collisions(kept, F.col("name")))
    gone = merge.exclusions(merged)
    if "related" not in records.columns:
        return flagged, gone
    related = flagged.select("id", F.posexplode("related").alias("pos", "other")).withColumn("relation", F.lit("related"))
    folded = gone.select(F.col("native_id").alias("alias"), F.substring("reason", len("merged_into:") + 1, 1 << 30).alias("target"))
    found = links.remap_links(related, folded, flagged.select("id")).select("id", "pos", "other")
    mates = cohort_links(flagged, cohorts or {}).select("id", F.lit(1 << 30).alias("pos"), "other")
    every = found.unionByName(mates).groupBy("id", "other").agg(F.min("pos").alias("pos")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "other"))).alias("linked"))
    out = flagged.drop("related").join(every.select(F.col("id").alias("of"), "linked"), F.col("id") == F.col("of"), "left")
    return out.withColumn("related", F.coalesce(F.transform("linked", lambda x: x["other"]), F.array().cast("array<string>"))).select(*kept.columns), gone


def finalize(records: DataFrame) -> DataFrame:
    """Vocabulary fields in vocabulary order, each value once. Unknown values go; ``unknown_values`` tells of them first."""
    return records.withColumn("domains", text.ranked(F.col("domains"), DOMAINS)).withColumn("modalities", text.ranked(F.col("modalities"), MODALITIES))


def unknown_values(records: DataFrame, vocabularies: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(id, severity, message): an error for each value that its vocabulary doesn't have, which ``finalize`` would drop."""
    known = vocabularies or {"domains": DOMAINS, "modalities": MODALITIES}

    def wrong(column: str, values: Sequence[str]) -> Column:
        strange = F.array_except(F.coalesce(F.col(column), F.array().cast("array<string>")), F.array(*[F.lit(x) for x in values]))
        return F.transform(strange, lambda x: F.concat(F.lit(f"{column}: unknown value "), x))

    made = F.flatten(F.array(*[wrong(c, v) for c, v in known.items()]))
    return records.select("id", F.lit("error").alias("severity"), F.explode(made).alias("message"))


def source_metrics(listed: DataFrame, records: DataFrame, excluded: DataFrame, errors: DataFrame, retained: DataFrame) -> DataFrame:
    """(source, status, listed, records, excluded, record_errors, retained): what each source of ``listed`` contributed to a run.

    ``listed`` has source, status and listed; the other tables have ids that begin with their source. One partial aggregate over all of them.
    """
    source = F.substring_index("id", ":", 1)
    parts = [df.select(source.alias("of"), F.lit(n).alias("part")) for n, df in (("records", records), ("excluded", excluded), ("errors", errors), ("retained", retained))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    n = {k: F.count(F.when(F.col("part") == k, 1)) for k in ("records", "excluded", "errors", "retained")}
    counts = every.groupBy("of").agg(*[n[k].alias("record_errors" if k == "errors" else k) for k in n])
    j = listed.join(counts, F.col("source") == F.col("of"), "left")
    return j.select("source", "status", "listed", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("records", "excluded", "record_errors", "retained")])


def manifest_results(sources: DataFrame, manifests: DataFrame) -> DataFrame:
    """(source, status, listed, written, unchanged, removed, error): each source's last harvest, 'skipped' where there is none.

    ``manifests`` has source, status, error and counts, a struct of the four numbers.
    """
    j = sources.select("source").join(manifests.select(F.col("source").alias("of"), F.col("status").alias("was"), "error", "counts"), F.col("source") == F.col("of"), "left")
    ran = F.col("of").isNotNull()
    numbers = [F.coalesce(F.col(f"counts.{c}"), F.lit(0)).cast("long").alias(c) for c in ("listed", "written", "unchanged", "removed")]
    return j.select("source", F.when(ran, F.coalesce("was", F.lit("ok"))).otherwise("skipped").alias("status"), *numbers, F.when(ran, F.col("error")).otherwise("no raw data").alias("error"))


def stale(retained: DataFrame, bad: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that still are valid, (id, message) of those that are not) of records kept from an older catalog; one stale row stops nothing."""
    errors = bad.where("severity = 'error'").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("message")), "; ").alias("why"))
    gone = retained.select("id").join(errors, "id").select("id", F.concat(F.lit("retained record is no longer valid: "), "why").alias("message"))
    return retained.join(gone.select(F.col("id").alias("gone")), F.col("id") == F.col("gone"), "left_anti"), gone


def check(records: DataFrame) -> DataFrame:
    """(id, severity, message) of a finished catalog."""
    checks = validate.record_checks({"source": SOURCES, "access": ACCESS_ORDER, "species": SPECIES, "record_status": RECORD_STATUS}, {"domains": DOMAINS, "modalities": MODALITIES})
    rows = records if "related" in records.columns else records.withColumn("related", F.array().cast("array<string>"))
    return validate.validate(rows, checks, validate.warning_checks())


def graph_rows(records: DataFrame) -> DataFrame:
    """Records as the graph wants them."""
    return records.withColumn("institutions", F.transform("institutions", lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("ror_id"))))


#: Native ids of two sources that name a study and its cohort, as TCGA-BRCA does.
COHORTS = {"gdc": r"^([A-Za-z]+)-([A-Za-z0-9]+)$", "tcia": r"^([A-Za-z]+)-([A-Za-z0-9]+)$"}


@dataclass
class Outcome:
    code: int
    version: str | None = None
    errors: int = 0
    warnings: int = 0
    counts: Mapping[str, int] = field(default_factory=dict)
    changelog: str = ""


def run(spark: SparkSession, raw: DataFrame, root: str, terms: Dictionaries | None = None, failed: Sequence[str] = (), sources: Sequence[str] = tuple(REGISTRY), day: str | None = None, answers: DataFrame | None = None) -> Outcome:
    """Normalize, retain what failed sources had, enrich, dedupe, validate, and publish a new version.

    Nothing is written if a record is invalid. Sources that aren't known are a misconfiguration; if all that
    were asked failed, nothing is done.
    """
    if not sources or set(sources) - set(REGISTRY):
        return Outcome(MISCONFIGURED)
    good = [s for s in sources if s not in failed]
    if not good:
        return Outcome(ALL_FAILED)
    store = Snapshots(spark, f"{root}/catalog")
    previous = store.read()
    records, excluded = split(normalize_all(raw, good))
    texts = None
    for s in good:
        one = REGISTRY[s][1](raw.where(F.col("source") == s)).withColumn("source", F.lit(s))
        texts = one if texts is None else texts.unionByName(one)
    fresh, folded = dedupe(finalize(enrich(records, texts, terms or DEFAULT, answers).select(*records.columns)), cohorts=COHORTS)
    if previous is not None:
        status = spark.createDataFrame([(s, s in good) for s in REGISTRY], "source string, ok boolean")
        kept, _ = stale(previous.select(*fresh.columns), check(previous))
        fresh = lookup.retain(fresh, kept, status)
    fresh = cut(fresh)
    found = cut(check(fresh))
    n = {r["severity"]: r["count"] for r in found.groupBy("severity").count().collect()}
    if n.get("error"):
        return Outcome(INVALID, errors=n["error"], warnings=n.get("warning", 0))
    rows = graph_rows(fresh)
    nodes, edges = graph.nodes(rows, DOMAINS), graph.links(rows, DOMAINS)
    old = previous.select(*fresh.columns) if previous is not None else fresh.limit(0)
    changes = cut(diff.pointer_diff(old, fresh, ("raw_hash",)))
    counts = {k: int(v or 0) for k, v in diff.diff_counts(old, fresh, changes).first().asDict().items()}
    version = store.write(fresh)
    for name, df in (("excluded", excluded.unionByName(folded)), ("nodes", nodes), ("links", edges), ("stats", graph.stats(rows))):
        Snapshots(spark, f"{root}/{name}").write(df)
    metrics = source_metrics(spark.createDataFrame([(s, "failed" if s in failed else "ok" if s in good else "unselected", 0) for s in REGISTRY], "source string, status string, listed long"), fresh, excluded.select(F.col("native_id").alias("id")), found.where("severity = 'error'"), fresh.join(previous.select(F.col("id").alias("was")), F.col("id") == F.col("was"), "left_semi").where(~F.col("source").isin(*good)) if previous is not None else fresh.limit(0))
    results = [{"source": r["source"], "status": r["status"], "listed": r["records"] + r["excluded"], "unchanged": r["retained"]} for r in metrics.collect()]
    names = fresh.select("id", "name", "url").unionByName(old.join(fresh.select(F.col("id").alias("now")), F.col("id") == F.col("now"), "left_anti").select("id", "name", "url"))
    changelog = diff.document(changes, names, counts, day or date.today().isoformat(), results, None, n.get("warning", 0))  # noqa: DTZ011
    return Outcome(OK, version, 0, n.get("warning", 0), counts, changelog)
