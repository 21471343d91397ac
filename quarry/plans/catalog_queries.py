"""Queries over the catalogs, each with SQL that says the same: facets, search, tables, graph, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import ranked, slugify
from quarry.operators import facets, graph, search
from quarry.operators.facets import FacetQuery
from quarry.operators.merge import merge_clusters
from quarry.plans.adapters import ACCESS, DOC_SQL, DOMAINS, ORDER_SQL, REGIONS, doc_catalog, order_catalog, read

CHOICE = FacetQuery({"domain": ("BUILDING", "MACHINERY"), "access": ("1-URGENT", "2-HIGH", "5-LOW"), "species": ("O", "F")}, (1997, 1998))
_YEARS = "(year_start IS NOT NULL OR year_end IS NOT NULL) AND year_end >= 1997 AND year_start <= 1998"
_CONDS = {"domain": "domain IN ('BUILDING', 'MACHINERY')", "access": "access IN ('1-URGENT', '2-HIGH', '5-LOW')", "species": "species IN ('O', 'F')"}
_VALUES = {"domain": "domain", "modality": "unnest(modalities)", "condition": "unnest(conditions)", "access": "access", "source": "source", "country": "country", "species": "species"}


def _where(skip: str | None = None) -> str:
    return " AND ".join([c for f, c in _CONDS.items() if f != skip] + [_YEARS])


def _counts_sql(filtered: bool = True) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS facet, value, count(*) AS n FROM (SELECT {v} AS value FROM cat {'WHERE ' + _where(f) if filtered else ''}) GROUP BY value" for f, v in _VALUES.items())


def facet_filter(spark: SparkSession, d: str) -> DataFrame:
    return facets.apply(order_catalog(spark, d), CHOICE).select("id", "name", "source", "access", "year_start", "year_end")


def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    return facets.facet_counts(order_catalog(spark, d), CHOICE)


def facet_counts_access(spark: SparkSession, d: str) -> DataFrame:
    """Counts by access under the other choices, in the order of access."""
    counts = facets.facet_counts(order_catalog(spark, d), CHOICE, ("access",))
    return facets.option_order(counts, {"access": ACCESS}).select("value", "n", F.col("place").cast("long").alias("place"))


def facet_counts_stable(spark: SparkSession, d: str) -> DataFrame:
    return facets.stable_facet_counts(order_catalog(spark, d).cache(), CHOICE)


def interval_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Overlap with ranges that are open at either end, where rows may know no year, or only one."""
    rows = order_catalog(spark, d).withColumn("year_end", F.when(F.col("key") % 3 != 0, F.col("year_end"))).withColumn("year_start", F.when(F.col("key") % 5 != 0, F.col("year_start")))
    tests = {"from": (1999, None), "to": (None, 1996), "within": (1997, 1998), "any": (None, None)}
    return rows.select("id", *[facets.overlaps_years(F.col("year_start"), F.col("year_end"), y).alias(f"hit_{k}") for k, y in tests.items()])


INTERVAL_SQL = f"""WITH {ORDER_SQL}, y AS (
  SELECT id, CASE WHEN key % 5 <> 0 THEN year_start END AS s, CASE WHEN key % 3 <> 0 THEN year_end END AS e FROM cat
)
SELECT id,
  (s IS NOT NULL OR e IS NOT NULL) AND coalesce(e, 9999) >= 1999 AS hit_from,
  (s IS NOT NULL OR e IS NOT NULL) AND coalesce(s, 0) <= 1996 AS hit_to,
  (s IS NOT NULL OR e IS NOT NULL) AND coalesce(e, 9999) >= 1997 AND coalesce(s, 0) <= 1998 AS hit_within,
  true AS hit_any
FROM y"""


def text_filter(spark: SparkSession, d: str) -> DataFrame:
    return facets.apply(doc_catalog(spark, d), FacetQuery(q="THE  and src1"), arrays=()).select("id", "name")


def search_ranked(spark: SparkSession, d: str) -> DataFrame:
    rows = doc_catalog(spark, d)
    return search.search(rows, "the and", F.concat_ws(" ", "id", "summary", "source"), 20).select("id", "name", "score")


SEARCH_SQL = rf"""WITH {DOC_SQL}, t AS (
  SELECT id, name, lower(name) AS l, lower(concat_ws(' ', id, summary, source)) AS o, list_filter(regexp_split_to_array(lower(name), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS k FROM doc
), s AS (
  SELECT id, name,
    CASE WHEN len(list_filter(k, lambda x: starts_with(x, 'the and'))) > 0 OR (len(list_filter(k, lambda x: starts_with(x, 'the'))) > 0 AND len(list_filter(k, lambda x: starts_with(x, 'and'))) > 0) THEN 3000
         WHEN contains(l, 'the and') OR (contains(l, 'the') AND contains(l, 'and')) THEN 2000
         WHEN contains(o, 'the and') OR (contains(o, 'the') AND contains(o, 'and')) THEN 1000 ELSE 0 END AS tier,
    CASE WHEN l = 'the and' THEN 500 ELSE 0 END AS bonus FROM t
)
SELECT id, name, round(tier + bonus - least(length(name), 200) * 0.1, 1)::DOUBLE AS score FROM s WHERE tier > 0 ORDER BY score DESC, name, id LIMIT 20"""


def table_page(spark: SparkSession, d: str) -> DataFrame:
    """The second hundred rows by years downward: rows without years last, ties by name and id upward."""
    return facets.page(order_catalog(spark, d), FacetQuery(sort="years", descending=True), ACCESS, skip=100).select("id", "name", "year_start", F.col("pos").cast("long").alias("pos"))


def table_page_access(spark: SparkSession, d: str) -> DataFrame:
    return facets.page(order_catalog(spark, d), FacetQuery(sort="access"), ACCESS).select("id", "access", F.col("pos").cast("long").alias("pos"))


def csv_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = facets.apply(order_catalog(spark, d), CHOICE)
    text = lambda c: F.col(c).cast("string")
    return facets.csv_lines(rows, {"ID": text("id"), "Name": F.concat(F.when(F.col("key") % 2 == 0, "=").otherwise('"'), "name"), "Modalities": F.array_join("modalities", "; "), "Year start": text("year_start"), "Sample size": text("sample_size"), "Nothing": F.lit(None).cast("string")})


CSV_SQL = f"""WITH {ORDER_SQL} SELECT id, '"' || id || '","' || CASE WHEN key % 2 = 0 THEN '''=' ELSE '""' END || name || '","' || array_to_string(modalities, '; ') || '","' || year_start || '","' || sample_size || '",""' AS line FROM cat WHERE {_where()}"""


def stats_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.stats(order_catalog(spark, d))


STATS_SQL = f"""WITH {ORDER_SQL}
SELECT 'records' AS metric, '' AS value, count(*) AS n FROM cat
UNION ALL SELECT 'per_source', source, count(*) FROM cat GROUP BY source
UNION ALL SELECT 'per_access', access, count(*) FROM cat GROUP BY access
UNION ALL SELECT 'per_domain', domain, count(*) FROM cat GROUP BY domain
UNION ALL SELECT 'per_modality', m, count(*) FROM (SELECT unnest(modalities) AS m FROM cat) GROUP BY m"""


def graph_links(spark: SparkSession, d: str) -> DataFrame:
    return graph.links(order_catalog(spark, d), DOMAINS)


_LINKS = """links AS (
  SELECT id AS source, 'source:' || source AS target, 'has_source' AS type FROM cat
  UNION SELECT id, 'modality:' || m, 'has_modality' FROM (SELECT id, unnest(modalities) AS m FROM cat)
  UNION SELECT id, 'condition:' || regexp_replace(lower(c), '[^a-z0-9._-]+', '-', 'g'), 'has_condition' FROM (SELECT id, unnest(conditions) AS c FROM cat)
  UNION SELECT id, 'institution:supplier-' || s, 'has_institution' FROM (SELECT id, unnest(suppliers) AS s FROM cat)
)"""


def graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    found = graph.nodes(order_catalog(spark, d), DOMAINS)
    return found.select("id", "type", "label", F.array_join("domains", ",").alias("domains"), "degree", "backbone")


NODES_SQL = f"""WITH {ORDER_SQL}, {_LINKS}, deg AS (
  SELECT id, count(*) AS degree FROM (SELECT source AS id FROM links UNION ALL SELECT target FROM links) GROUP BY id
), hubs AS (
  SELECT target AS id, substr(type, 5) AS type FROM links GROUP BY ALL
), dom AS (
  SELECT target AS id, domain FROM (
    SELECT target, domain, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, domain) AS k FROM links JOIN cat ON links.source = cat.id GROUP BY target, domain
  ) WHERE k = 1
), lab AS (
  SELECT DISTINCT 'condition:' || regexp_replace(lower(c), '[^a-z0-9._-]+', '-', 'g') AS id, c AS label FROM (SELECT unnest(conditions) AS c FROM cat)
  UNION SELECT DISTINCT 'institution:supplier-' || s, 'Supplier ' || s FROM (SELECT unnest(suppliers) AS s FROM cat)
)
SELECT cat.id, 'dataset' AS type, name AS label, domain AS domains, degree, false AS backbone FROM cat JOIN deg ON cat.id = deg.id
UNION ALL
SELECT hubs.id, hubs.type, coalesce(lab.label, split_part(hubs.id, ':', 2)) AS label, dom.domain AS domains, degree, hubs.type IN ('source', 'modality') OR degree >= 2 AS backbone
FROM hubs JOIN deg ON hubs.id = deg.id JOIN dom ON hubs.id = dom.id LEFT JOIN lab ON hubs.id = lab.id"""


def dominant_domain(spark: SparkSession, d: str) -> DataFrame:
    return graph.dominant_domain(order_catalog(spark, d), DOMAINS)


DOMINANT_SQL = f"""WITH {ORDER_SQL}, {_LINKS}
SELECT target AS node, domain FROM (
  SELECT target, domain, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, domain) AS k FROM links JOIN cat ON links.source = cat.id GROUP BY target, domain
) WHERE k = 1"""


def backbone(spark: SparkSession, d: str) -> DataFrame:
    return graph.record_backbone(order_catalog(spark, d), DOMAINS)


BACKBONE_SQL = f"""WITH {ORDER_SQL}, {_LINKS}, e AS (
  SELECT source AS d, target AS h, substr(type, 5) AS t, CASE substr(type, 5) WHEN 'source' THEN 1 WHEN 'modality' THEN 2 WHEN 'condition' THEN 3 ELSE 4 END AS r FROM links
), w AS (
  SELECT a.h AS source, b.h AS target, a.t = 'source' AS first, count(*) AS weight FROM e a JOIN e b ON a.d = b.d AND (a.r < b.r OR (a.r = b.r AND a.h < b.h)) GROUP BY ALL
), s AS (
  SELECT source AS own, target AS other, source, target, weight FROM w WHERE NOT first AND weight >= 2
  UNION ALL SELECT target, source, source, target, weight FROM w WHERE NOT first AND weight >= 2
), k AS (
  SELECT *, row_number() OVER (PARTITION BY own ORDER BY weight DESC, other) AS rn FROM s
)
SELECT source, target, weight FROM w WHERE first UNION SELECT source, target, weight FROM k WHERE rn <= 3"""


def neighbours_topk(spark: SparkSession, d: str) -> DataFrame:
    edges = graph.links(order_catalog(spark, d), DOMAINS).cache()
    return graph.neighbours(edges, "modality:PROMO", graph.degrees(edges), 60).select("id", "degree", F.col("pos").cast("long").alias("pos"))


NEIGHBOURS_SQL = f"""WITH {ORDER_SQL}, {_LINKS}, deg AS (
  SELECT id, count(*) AS degree FROM (SELECT source AS id FROM links UNION ALL SELECT target FROM links) GROUP BY id
)
SELECT id, degree, row_number() OVER (ORDER BY degree DESC, id) AS pos FROM (SELECT DISTINCT source AS id FROM links WHERE target = 'modality:PROMO') JOIN deg USING (id) ORDER BY pos LIMIT 60"""


def ego_subgraph(spark: SparkSession, d: str) -> DataFrame:
    return graph.ego(graph.links(order_catalog(spark, d), DOMAINS).cache(), "institution:supplier-3")


EGO_SQL = f"""WITH {ORDER_SQL}, {_LINKS}, near AS (
  SELECT source AS id FROM links WHERE target = 'institution:supplier-3' UNION SELECT 'institution:supplier-3'
)
SELECT * FROM links WHERE source IN (SELECT id FROM near) AND target IN (SELECT id FROM near)"""


def label_budget(spark: SparkSession, d: str) -> DataFrame:
    found = graph.nodes(order_catalog(spark, d), DOMAINS).where("type != 'dataset'")
    return graph.label_budget(found, {"condition": 15, "institution": 6}).select("id", "degree", F.col("k").cast("long").alias("k"))


LABELS_SQL = f"""WITH {ORDER_SQL}, {_LINKS}, h AS (
  SELECT target AS id, substr(type, 5) AS type, count(*) AS degree FROM links GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY degree DESC, id) AS k FROM h)
SELECT id, degree, k FROM r WHERE (type = 'condition' AND k <= 15) OR (type = 'institution' AND k <= 6)"""


def related_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each order is related to itself, the order two keys on, and one that isn't there; every seventh order is removed."""
    rows = order_catalog(spark, d)
    name = lambda k: F.concat(F.lit("order:"), k.cast("string"))
    rows = rows.withColumn("related", F.array(F.col("id"), name(F.col("key") + 2), name(F.col("key") - 2), F.lit("order:none"))).withColumn("record_status", F.when(F.col("key") % 7 == 0, "removed").otherwise("active"))
    return graph.related_pairs(rows)


RELATED_SQL = f"""WITH {ORDER_SQL}, live AS (SELECT id, key FROM cat WHERE key % 7 <> 0)
SELECT least(a.id, b.id) AS source, greatest(a.id, b.id) AS target, 'related' AS type FROM live a JOIN live b ON b.key = a.key + 2"""


def graph_contract(spark: SparkSession, d: str) -> DataFrame:
    """Faults seeded into a sound graph: a node twice, a node gone, a link to nothing."""
    rows = order_catalog(spark, d)
    found, edges = graph.nodes(rows, DOMAINS).select("id", "type"), graph.links(rows, DOMAINS)
    twice = F.when(F.col("id") == "order:2", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    found = found.where("id != 'order:1'").select("id", "type", F.explode(twice).alias("nth")).drop("nth")
    edges = edges.unionByName(spark.createDataFrame([("order:2", "modality:none", "has_modality")], "source string, target string, type string"))
    return graph.contract_errors(found, edges, rows)


CONTRACT_SQL = "SELECT * FROM (VALUES ('duplicate_node', 'order:2'), ('dangling_link', 'order:1'), ('dangling_link', 'modality:none'), ('missing_node', 'order:1')) t(kind, id)"


def vocabulary_order(spark: SparkSession, d: str) -> DataFrame:
    """Values of an order's lines and those of its customer's region united in the order of a vocabulary; unknown ones go."""
    rows = order_catalog(spark, d)
    vocabulary = ("STANDARD", "PROMO", "SMALL", "AFRICA", "ASIA", "ECONOMY")
    return rows.select("id", F.array_join(ranked(F.concat("modalities", F.array("source"), "modalities"), vocabulary), ",").alias("united"))


VOCABULARY_SQL = f"""WITH {ORDER_SQL}
SELECT id, array_to_string(list_filter(['STANDARD', 'PROMO', 'SMALL', 'AFRICA', 'ASIA', 'ECONOMY'], lambda x: list_contains(modalities, x) OR source = x), ',') AS united FROM cat"""


def access_escalation(spark: SparkSession, d: str) -> DataFrame:
    """A customer's orders merged into one: strictest access with its own notes, any doubtful status, known years."""
    rows = order_catalog(spark, d).select(
        F.col("customer").alias("cluster"), "id", "source", "access", F.when(F.col("key") % 4 != 0, F.concat(F.lit("note "), "id")).alias("access_notes"),
        F.when(F.col("key") % 50 == 0, "needs_review").otherwise("active").alias("record_status"), F.when(F.col("key") % 2 == 0, F.col("sample_size")).otherwise(0).alias("sample_size"),
        "year_start", F.array("access").alias("access_tiers"),
    )
    merged = merge_clusters(rows, REGIONS, DOMAINS, (), ACCESS)
    return merged.select(F.col("cluster").alias("customer"), "id", "access", "access_notes", "record_status", "sample_size", "year_start", F.array_join("access_tiers", ",").alias("tiers"), F.size("members").cast("long").alias("n"))


ESCALATION_SQL = f"""WITH {ORDER_SQL}, m AS (
  SELECT customer, id, access, CASE WHEN key % 4 <> 0 THEN 'note ' || id END AS notes, key % 50 = 0 AS doubt,
    CASE WHEN key % 2 = 0 THEN sample_size ELSE 0 END AS size, year_start, row_number() OVER (PARTITION BY customer ORDER BY id) AS k FROM cat
), a AS (
  SELECT customer, min(id) AS id, max(access) AS access, bool_or(doubt) AS doubt, count(*) AS n,
    arg_min(size, k) FILTER (WHERE size <> 0) AS given, arg_min(year_start, k) FILTER (WHERE year_start IS NOT NULL) AS year_start,
    string_agg(DISTINCT access, ',' ORDER BY access) AS tiers FROM m GROUP BY customer
), p AS (SELECT * FROM m WHERE k = 1), e AS (
  SELECT m.customer, arg_min(struct_pack(notes := m.notes), m.k).notes AS notes FROM m JOIN a ON m.customer = a.customer AND m.access = a.access GROUP BY m.customer
)
SELECT a.customer, a.id, a.access, CASE WHEN p.access = a.access THEN p.notes ELSE coalesce(e.notes, p.notes) END AS access_notes,
  CASE WHEN a.doubt THEN 'needs_review' ELSE 'active' END AS record_status, CASE WHEN a.n = 1 THEN p.size ELSE coalesce(a.given, p.size) END AS sample_size,
  a.year_start, a.tiers, a.n
FROM a JOIN p ON a.customer = p.customer JOIN e ON a.customer = e.customer"""


def slugs(spark: SparkSession, d: str) -> DataFrame:
    rows = doc_catalog(spark, d).select("id", "name").unionByName(read(spark, d, "nation").select(F.col("n_name").alias("id"), F.col("n_name").alias("name")))
    return rows.select("id", slugify(F.col("name")).alias("slug"))


SLUG_SQL = rf"""WITH {DOC_SQL}, n AS (SELECT id, name FROM doc UNION ALL SELECT n_name, n_name FROM nation)
SELECT id, trim(regexp_replace(strip_accents(lower(name)), '[^a-z0-9._-]+', '-', 'g'), '-') AS slug FROM n"""

QUERIES = {
    "facet_filter": facet_filter,
    "facet_counts": facet_counts,
    "facet_counts_access": facet_counts_access,
    "facet_counts_stable": facet_counts_stable,
    "interval_overlap_open_ended": interval_overlap,
    "text_filter_all_tokens": text_filter,
    "search_ranked_topk": search_ranked,
    "table_sort_page": table_page,
    "table_sort_access": table_page_access,
    "csv_export_rows": csv_rows,
    "stats_counts": stats_counts,
    "graph_links": graph_links,
    "graph_nodes": graph_nodes,
    "dominant_domain": dominant_domain,
    "backbone_cooccurrence": backbone,
    "neighbours_topk": neighbours_topk,
    "ego_subgraph": ego_subgraph,
    "label_budget": label_budget,
    "related_pairs": related_pairs,
    "graph_contract": graph_contract,
    "vocab_order_union": vocabulary_order,
    "merge_access_escalation": access_escalation,
    "slugify": slugs,
}

ORACLES = {
    "facet_filter": f"WITH {ORDER_SQL} SELECT id, name, source, access, year_start, year_end FROM cat WHERE {_where()}",
    "facet_counts": f"WITH {ORDER_SQL} {_counts_sql()}",
    "facet_counts_access": f"WITH {ORDER_SQL} SELECT access AS value, count(*) AS n, row_number() OVER (ORDER BY access) AS place FROM cat WHERE {_where('access')} GROUP BY access",
    "facet_counts_stable": f"WITH {ORDER_SQL}, live AS ({_counts_sql()}), every AS ({_counts_sql(False)}) SELECT e.facet, e.value, coalesce(l.n, 0) AS n FROM every e LEFT JOIN live l ON e.facet = l.facet AND e.value = l.value",
    "interval_overlap_open_ended": INTERVAL_SQL,
    "text_filter_all_tokens": f"WITH {DOC_SQL}, h AS (SELECT id, name, lower(concat_ws(' ', id, nullif(name, ''), nullif(summary, ''), source)) AS t FROM doc) SELECT id, name FROM h WHERE contains(t, 'the') AND contains(t, 'and') AND contains(t, 'src1')",
    "search_ranked_topk": SEARCH_SQL,
    "table_sort_page": f"WITH {ORDER_SQL}, r AS (SELECT id, name, year_start, row_number() OVER (ORDER BY year_start DESC NULLS LAST, lower(name), id) AS pos FROM cat) SELECT * FROM r WHERE pos BETWEEN 101 AND 200",
    "table_sort_access": f"WITH {ORDER_SQL}, r AS (SELECT id, access, row_number() OVER (ORDER BY access, lower(name), id) AS pos FROM cat) SELECT * FROM r WHERE pos <= 100",
    "csv_export_rows": CSV_SQL,
    "stats_counts": STATS_SQL,
    "graph_links": f"WITH {ORDER_SQL}, {_LINKS} SELECT * FROM links",
    "graph_nodes": NODES_SQL,
    "dominant_domain": DOMINANT_SQL,
    "backbone_cooccurrence": BACKBONE_SQL,
    "neighbours_topk": NEIGHBOURS_SQL,
    "ego_subgraph": EGO_SQL,
    "label_budget": LABELS_SQL,
    "related_pairs": RELATED_SQL,
    "graph_contract": CONTRACT_SQL,
    "vocab_order_union": VOCABULARY_SQL,
    "merge_access_escalation": ESCALATION_SQL,
    "slugify": SLUG_SQL,
}
