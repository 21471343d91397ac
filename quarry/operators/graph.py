"""The property graph of a catalog: nodes, links, degrees, backbone, neighbourhoods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import rank, ranked, slugify

TYPES = ("source", "modality", "condition", "institution")
ALWAYS, BY_DEGREE = ("source", "modality"), ("condition", "institution")


def institution_key(ror: Column, name: Column) -> Column:
    """The last part of a registry address, else the name as a slug."""
    return F.coalesce(F.nullif(F.element_at(F.split(F.regexp_replace(ror, "/+$", ""), "/"), -1), F.lit("")), slugify(name))


def _own(records: DataFrame, domains: Sequence[str], institutions: int) -> DataFrame:
    """(id, name, domains, attributes): each live record with its attribute nodes, each node once with the label it has first.

    ``records`` has id, name, source, record_status, domains, modalities, conditions and
    institutions, the last two arrays of labels and of struct(name, ror_id). Only the first ``institutions``
    of a record count, before equal ones are joined. All of it is done within the row: nothing is shuffled.
    """
    live = records.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed")
    empty = F.array().cast("array<string>")
    entry = lambda kind, key, label, pos: F.struct(F.concat_ws(":", F.lit(kind), key).alias("node"), pos.cast("int").alias("pos"), F.lit(kind).alias("type"), label.alias("label"))
    modalities, conditions = F.coalesce("modalities", empty), F.coalesce("conditions", empty)
    placed = F.concat(
        F.array(entry("source", F.col("source"), F.col("source"), F.lit(0))),
        F.transform(modalities, lambda m, i: entry("modality", m, m, i + 1)),
        F.transform(conditions, lambda c, i: entry("condition", slugify(c), c, i + 1 + F.size(modalities))),
        F.transform(F.slice(F.coalesce(F.col("institutions"), F.array().cast(records.schema["institutions"].dataType)), 1, institutions), lambda n, i: entry("institution", institution_key(n["ror_id"], n["name"]), n["name"], i + 1 + F.size(modalities) + F.size(conditions))),
    )
    rows = live.select("id", "name", ranked(F.col("domains"), domains).alias("domains"), placed.alias("placed"))
    # only a row in which a node comes again is sorted, each node then beside the one before it, so that no lambda looks back into the array
    ordered = F.array_sort("placed")
    before = F.concat(F.array(F.lit("")), ordered["node"])
    pairs = F.arrays_zip(ordered.alias("placed"), before.alias("before"))
    first = F.filter(pairs, lambda z: z["placed"].isNotNull() & (z["placed"]["node"] != z["before"]))
    once = F.when(F.size(F.array_distinct(F.col("placed.node"))) == F.size("placed"), F.col("placed")).otherwise(first["placed"])
    return rows.select("id", "name", "domains", once.alias("attributes"))


def _attributes(records: DataFrame, domains: Sequence[str], institutions: int) -> DataFrame:
    """(id, domains, node, pos, type, label): one row for each record and attribute node."""
    # outer, as each record has a source: else the optimizer computes the attributes a second time, to drop rows without any
    return _own(records, domains, institutions).select("id", "domains", F.inline_outer("attributes"))


def related_pairs(records: DataFrame) -> DataFrame:
    """(source, target, type): each related pair of live records once, the smaller id first; none with itself."""
    live = records.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed")
    ids = live.select(F.col("id").alias("known"))
    pairs = live.select("id", F.explode("related").alias("other")).where("other != id")
    pairs = pairs.join(ids, F.col("other") == F.col("known"), "left_semi")
    return pairs.select(F.least("id", "other").alias("source"), F.greatest("id", "other").alias("target"), F.lit("related").alias("type")).distinct()


def links(records: DataFrame, domains: Sequence[str], institutions: int = 3) -> DataFrame:
    """(source, target, type): has_<attribute> from records to their attribute nodes, and related pairs; each once (ids being unique)."""
    own = _attributes(records, domains, institutions).select(F.col("id").alias("source"), F.col("node").alias("target"), F.concat(F.lit("has_"), "type").alias("type"))
    return own.unionByName(related_pairs(records)) if "related" in records.columns else own


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): links that touch a node, counted by a partial aggregate over both ends."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def _hubs(own: DataFrame, domains: Sequence[str]) -> DataFrame:
    """(node, type, label, domain, degree) of attribute nodes, by two aggregates of which both combine before they shuffle.

    Records are counted by node and domain, then by node: most common domain, the earlier in
    the vocabulary of equals; the label of the first record, by id and place; links counted at a record's first domain.
    """
    rows = own.select("id", F.posexplode_outer("domains").alias("nth", "domain"), "attributes").select("id", "nth", "domain", F.inline_outer("attributes"))
    n = rows.groupBy("node", "type", "domain").agg(
        F.count("*").alias("n"), F.count(F.when(F.coalesce("nth", F.lit(0)) == 0, 1)).alias("links"), F.min(F.struct("id", "pos", "label")).alias("first")
    )
    best = F.when(F.col("domain").isNotNull(), F.struct("n", -rank(F.col("domain"), domains)))
    return n.groupBy("node", "type").agg(F.min("first")["label"].alias("label"), F.max_by("domain", best).alias("domain"), F.sum("links").alias("degree"))


def dominant_domain(records: DataFrame, domains: Sequence[str], institutions: int = 3) -> DataFrame:
    """(node, domain): the domain that most of a node's records have; nodes without any are left out."""
    return _hubs(_own(records, domains, institutions), domains).where("domain IS NOT NULL").select("node", "domain")


def nodes(records: DataFrame, domains: Sequence[str], institutions: int = 3, min_degree: int = 2) -> DataFrame:
    """(id, type, label, domains, degree, backbone) of records and attributes.

    An attribute's label is the one that its first record has, by id and place. Sources and modalities
    are always backbone, conditions and institutions from ``min_degree`` links on; records never.
    Degrees count related pairs too. Ids are unique.
    """
    own = _own(records, domains, institutions)
    hubs = _hubs(own, domains).select(F.col("node").alias("id"), "type", "label", F.when(F.col("domain").isNull(), F.array().cast("array<string>")).otherwise(F.array("domain")).alias("domains"), "degree")
    mine = own.select("id", F.lit("dataset").alias("type"), F.col("name").alias("label"), "domains", F.size("attributes").cast("long").alias("degree"))
    if "related" in records.columns:
        more = degrees(related_pairs(records)).withColumnRenamed("degree", "more")
        mine = mine.join(more, "id", "left").withColumn("degree", F.col("degree") + F.coalesce("more", F.lit(0))).drop("more")
    backbone = F.col("type").isin(*ALWAYS) | (F.col("type").isin(*BY_DEGREE) & (F.col("degree") >= min_degree))
    return mine.unionByName(hubs).withColumn("backbone", backbone)


def backbone_links(edges: DataFrame, hubs: DataFrame, min_weight: int = 2, keep: int = 3) -> DataFrame:
    """(source, target, weight): hubs that share records, thinned to each hub's strongest.

    ``edges`` are record -> hub links, ``hubs`` has id and type of the hubs that count. Pairs come from a record's own few
    hubs, so their number is bounded by records and not by a hub's size; weights are
    counted by a partial aggregate. Pairs with a source stay; others need ``min_weight`` and a place among
    the ``keep`` heaviest of either end, the smaller id first of equals. The broader type is the source end.
    """
    place = rank(F.col("type"), TYPES)
    own = edges.join(hubs.select(F.col("id").alias("target"), "type", place.alias("place")), "target").select("source", F.struct("place", F.col("target").alias("hub"), F.col("type").alias("kind")).alias("h"))
    return _strongest(_weights(own.groupBy("source").agg(F.array_sort(F.collect_set("h")).alias("hs"))), min_weight, keep)


def record_backbone(records: DataFrame, domains: Sequence[str], hubs: DataFrame | None = None, institutions: int = 3, min_weight: int = 2, keep: int = 3) -> DataFrame:
    """``backbone_links`` straight from records (as ``nodes`` takes them): pairs form within a record's own row, so only weights are shuffled.

    With ``hubs`` (column id) both ends must be among them.
    """
    entry = lambda a: F.struct(rank(a["type"], TYPES).alias("place"), a["node"].alias("hub"), a["type"].alias("kind"))
    weights = _weights(_own(records, domains, institutions).select(F.array_sort(F.transform("attributes", entry)).alias("hs")))
    if hubs is not None:
        known = hubs.select(F.col("id").alias("known")).distinct()
        weights = weights.join(known, F.col("source") == F.col("known"), "left_semi").join(known, F.col("target") == F.col("known"), "left_semi")
    return _strongest(weights, min_weight, keep)


def _weights(lists: DataFrame) -> DataFrame:
    """(source, target, first, weight) of the pairs within lists ``hs`` of struct(place, hub, kind), sorted."""
    pairs = lists.select(F.explode(F.flatten(F.transform("hs", lambda a, i: F.transform(F.slice(F.col("hs"), i + 2, F.size("hs")), lambda b: F.struct(a["hub"].alias("source"), b["hub"].alias("target"), (a["kind"] == "source").alias("first")))))).alias("p")).select("p.*")
    return pairs.groupBy("source", "target", "first").agg(F.count("*").alias("weight"))


def _strongest(weights: DataFrame, min_weight: int, keep: int) -> DataFrame:
    rest = weights.where(~F.col("first") & (F.col("weight") >= min_weight))
    sides = rest.select(F.col("source").alias("own"), F.col("target").alias("other"), "source", "target", "weight").unionByName(rest.select(F.col("target").alias("own"), F.col("source").alias("other"), "source", "target", "weight"))
    best = sides.withColumn("k", F.row_number().over(Window.partitionBy("own").orderBy(F.desc("weight"), "other"))).where(F.col("k") <= keep)
    return weights.where("first").select("source", "target", "weight").unionByName(best.select("source", "target", "weight").distinct())


def adjacency(edges: DataFrame) -> DataFrame:
    """(id, other): both directions of every link that is no loop, each once."""
    real = edges.where("source != target")
    return real.select(F.col("source").alias("id"), F.col("target").alias("other")).unionByName(real.select(F.col("target").alias("id"), F.col("source").alias("other"))).distinct()


def beside(edges: DataFrame, node: str) -> DataFrame:
    """(id) of a node's neighbours; the filter reaches both sides before anything is shuffled."""
    real = edges.where("source != target")
    return real.where(F.col("source") == node).select(F.col("target").alias("id")).unionByName(real.where(F.col("target") == node).select(F.col("source").alias("id"))).distinct()


def induced(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Links with both ends among ``ids`` (column id)."""
    known = ids.select(F.col("id").alias("known")).distinct()
    return edges.join(known, F.col("source") == F.col("known"), "left_semi").join(known, F.col("target") == F.col("known"), "left_semi")


def neighbours(edges: DataFrame, node: str, degree: DataFrame, cap: int = 150, more: int = 0, kind: DataFrame | None = None) -> DataFrame:
    """(id, degree, pos): a node's neighbours, the best linked first, at most ``cap`` x (1 + ``more``)."""
    near = beside(edges, node)
    near = near.join(kind.select("id"), "id", "left_semi") if kind is not None else near
    top = near.join(degree, "id").orderBy(F.desc("degree"), "id").limit(cap * (1 + more))
    return top.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("degree"), "id")))


def ego(edges: DataFrame, node: str) -> DataFrame:
    """Links among a node and its neighbours."""
    near = beside(edges, node)
    return induced(edges, near.unionByName(near.sparkSession.createDataFrame([(node,)], "id string")))


def collapse(shown: DataFrame, edges: DataFrame, hub: str, expanded: Sequence[str], pinned: Sequence[str]) -> DataFrame:
    """Ids that stay when ``hub`` folds: all but its neighbours that no other expanded hub shows and that aren't pinned."""
    adj = adjacency(edges)
    own = adj.where(F.col("id") == hub).select(F.col("other").alias("id"))
    others = adj.where(F.col("id").isin(*[x for x in expanded if x != hub] or [""])).select(F.col("other").alias("id"))
    gone = own.join(others, "id", "left_anti").where(~F.col("id").isin(*pinned or [""]))
    return shown.join(gone, "id", "left_anti")


def label_budget(found: DataFrame, budgets: dict[str, int]) -> DataFrame:
    """Nodes that get a label: of each type with a budget its best linked, the smaller id first of equals."""
    cap = F.create_map(*[F.lit(x) for kv in budgets.items() for x in kv])
    k = F.row_number().over(Window.partitionBy("type").orderBy(F.desc("degree"), "id"))
    # the largest budget is a limit that every task applies before its rows are shuffled
    top = found.where(F.col("type").isin(*budgets)).withColumn("k", k).where(F.col("k") <= max(budgets.values(), default=0))
    return top.where(F.col("k") <= F.try_element_at(cap, F.col("type")))


def dimmed(chosen: Sequence[str]) -> Column:
    """Whether a domain filter dims a node: one without domains is dimmed if it is a record, not if it is a hub."""
    if not chosen:
        return F.lit(False)
    bare = F.coalesce(F.size("domains"), F.lit(0)) == 0
    return F.when(bare, F.col("type") == "dataset").otherwise(~F.arrays_overlap("domains", F.array(*[F.lit(c) for c in chosen])))


def stats(records: DataFrame) -> DataFrame:
    """(metric, value, n): records, and records by source, domain, modality and access; a value that a record repeats counts as often."""
    live = records.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed")
    empty = F.array().cast("array<string>")
    pair = lambda m, v: F.struct(F.lit(m).alias("metric"), v.alias("value"))
    values = F.concat(
        F.array(pair("records", F.lit(""))),
        F.array(pair("per_source", F.col("source"))),
        F.array(pair("per_access", F.col("access"))),
        F.transform(F.coalesce("domains", empty), lambda v: pair("per_domain", v)),
        F.transform(F.coalesce("modalities", empty), lambda v: pair("per_modality", v)),
    )
    return live.select(F.inline(values)).groupBy("metric", "value").agg(F.count("*").alias("n"))


def contract_errors(found: DataFrame, edges: DataFrame, catalog: DataFrame) -> DataFrame:
    """(kind, id): repeated nodes, links to no node, and live records without a node or nodes without a live record.

    Each input is read once; what is known of an id meets in one aggregate that combines before it shuffles. An id of null is no other's.
    """
    no, yes = F.lit(False), F.lit(True)
    seen = lambda rows, nodes, own, linked, live: rows.select("id", nodes.cast("long").alias("nodes"), own.alias("own"), linked.alias("linked"), live.alias("live"))
    live = catalog.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed")
    ends = edges.select(F.explode(F.array("source", "target")).alias("id"))
    rows = seen(found, F.lit(1), F.coalesce(F.col("type") == "dataset", no), no, no).unionByName(seen(ends, F.lit(0), no, yes, no)).unionByName(seen(live, F.lit(0), no, no, yes))
    known = rows.groupBy("id").agg(F.sum("nodes").alias("nodes"), *[F.max(c).alias(c) for c in ("own", "linked", "live")])
    lone = F.col("id").isNull()
    kinds = {
        "duplicate_node": F.col("nodes") > 1, "dangling_link": F.col("linked") & ((F.col("nodes") == 0) | lone),
        "missing_node": F.col("live") & (~F.col("own") | lone), "unknown_record": F.col("own") & (~F.col("live") | lone),
    }
    faults = F.filter(F.array(*[F.when(wrong, F.lit(kind)) for kind, wrong in kinds.items()]), lambda k: k.isNotNull())
    return known.select(F.explode(faults).alias("kind"), "id")


INDEX = ("id", "name", "summary", "source", "domains", "modalities", "conditions", "countries", "access", "year_start", "year_end", "sample_size", "sample_unit", "url", "species")


def search_index(records: DataFrame, domains: Sequence[str], modalities: Sequence[str]) -> DataFrame:
    """Live records as flat rows for searching, with vocabulary fields in vocabulary order; columns that aren't there are null."""
    live = records.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed")
    cells = {c: F.col(c) if c in records.columns else F.lit(None).cast("string") for c in INDEX}
    cells |= {c: ranked(F.col(c), v) for c, v in (("domains", domains), ("modalities", modalities)) if c in records.columns}
    return live.select(*[cells[c].alias(c) for c in INDEX])


def panel(found: DataFrame, index: DataFrame, records: DataFrame, fields: Sequence[str]) -> DataFrame:
    """What is shown of a node: each field from its record, else from its index row, else from the node itself."""
    j = found.alias("n").join(index.alias("i"), F.col("n.id") == F.col("i.id"), "left").join(records.alias("r"), F.col("n.id") == F.col("r.id"), "left")
    sides = (("r", records), ("i", index), ("n", found))
    cells = [F.coalesce(*[F.col(f"{a}.{f}") for a, df in sides if f in df.columns]).alias(f) for f in fields]
    return j.select(F.col("n.id").alias("id"), F.col("r.id").isNotNull().alias("full"), *cells)


def index_errors(index: DataFrame, record_count: DataFrame, catalog: DataFrame) -> DataFrame:
    """(kind, id): live records that the search index lacks, index rows of none, and a count (one row, n) that isn't theirs."""
    live = catalog.where(F.coalesce(F.col("record_status"), F.lit("active")) != "removed").select("id").distinct()
    rows = index.select("id").distinct()
    both = live.agg(F.count("*").alias("have")).withColumn("n", F.lit(None).cast("long")).unionByName(record_count.select(F.lit(None).cast("long").alias("have"), F.col("n").cast("long").alias("n")))
    wrong = both.agg(F.max("have").alias("have"), F.max("n").alias("n")).where("have != n").select(F.lit("record_count").alias("kind"), F.col("n").cast("string").alias("id"))
    return live.join(rows, "id", "left_anti").select(F.lit("not_indexed").alias("kind"), "id").unionByName(rows.join(live, "id", "left_anti").select(F.lit("index_only").alias("kind"), "id")).unionByName(wrong)


def adjacency_index(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, other): neighbours among known nodes, in both directions, each once; loops and links to no node are left out."""
    return adjacency(induced(edges, ids))


def focus(shown: DataFrame, edges: DataFrame, node: str, kind: str, pinned: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(shown ids, pinned ids) when a reader turns to a node: a record brings all its neighbours and is pinned with them, a hub unfolds."""
    near = beside(edges, node)
    own = near.sparkSession.createDataFrame([(node,)], "id string")
    now = shown.select("id").unionByName(near).unionByName(own).distinct()
    held = pinned.select("id") if pinned is not None else own.limit(0)
    return now, (held.unionByName(near).unionByName(own).distinct() if kind == "dataset" else held)
