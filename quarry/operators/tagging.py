"""Dictionary tagging of free text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import ranked, term_regex


def check_terms(terms: Mapping[str, Sequence[str]], vocabulary: Sequence[str] | None = None, min_stem: int = 6) -> None:
    """A term table is wrong if a stem is short enough to match by chance, a value is unknown, or a term is empty."""
    for value, found in terms.items():
        if vocabulary is not None and value not in vocabulary:
            raise ValueError(f"{value!r} is not in the vocabulary")
        for t in found:
            if not t.strip("* ") or "*" in t[:-1]:
                raise ValueError(f"{t!r} is no term")
            if t.endswith("*") and len(t) - 1 < min_stem:
                raise ValueError(f"the stem {t!r} is shorter than {min_stem} letters")


def evidence(text: Column, terms: Sequence[str]) -> Column:
    """The first match of each term, in the order of terms, each once. Terms are looked for one by one only where any of them is."""
    if not terms:
        return F.array().cast("array<string>")
    hits = [F.nullif(F.regexp_extract(text, term_regex(t), 1), F.lit("")) for t in terms]
    found = F.array_distinct(F.filter(F.array(*hits), lambda h: h.isNotNull()))
    return F.when(text.rlike("|".join(term_regex(t) for t in terms)), found).otherwise(F.array().cast("array<string>"))


def tag(rows: DataFrame, text: Column, terms: Mapping[str, Sequence[str]]) -> DataFrame:
    """(id, value, evidence): values any of whose terms the text has, as whole words.

    Patterns are literals that each task compiles once; one narrow pass over the text.
    """
    values = F.array(*[F.struct(F.lit(v).alias("value"), evidence(text, t).alias("evidence")) for v, t in terms.items()])
    return rows.select("id", F.inline(F.filter(values, lambda x: F.size(x["evidence"]) > 0)))


def tagged(text: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """The values that a text has, in the table's order."""
    held = F.array(*[F.when(text.rlike("|".join(term_regex(t) for t in found)), F.lit(v)) for v, found in terms.items()])
    return F.filter(held, lambda v: v.isNotNull())


def species(text: Column, animal: Sequence[str], human: Sequence[str]) -> Column:
    """'animal' if the text has animal terms and no human ones, else null."""
    has = lambda terms: text.rlike("|".join(term_regex(t) for t in terms))
    return F.when(has(animal) & ~has(human), "animal")


def _among(keywords: Column, wanted: Sequence[str], fold) -> Column:
    return F.filter(keywords, lambda k: fold(k).isin(*wanted))


def _entries(table: Mapping[str, Sequence[str]], full: Column, keywords: Column, exact: Mapping[str, Sequence[str]], fold, counts: Column) -> Column:
    """array<struct(value, evidence)> of the values of a table that the text or a keyword as it stands bears out."""
    none = F.array().cast("array<string>")
    made = []
    for value in dict.fromkeys([*table, *exact]):
        said = evidence(full, table[value]) if table.get(value) else none
        held = F.when(counts, _among(keywords, exact[value], fold)).otherwise(none) if exact.get(value) else none
        made.append(F.struct(F.lit(value).alias("value"), F.array_distinct(F.concat(said, held)).alias("evidence")))
    kind = "array<struct<value:string,evidence:array<string>>>"
    return F.filter(F.array(*made), lambda x: F.size(x["evidence"]) > 0) if made else F.array().cast(kind)


def rule_hits(rows: DataFrame, terms, domains: Sequence[str], modalities: Sequence[str]) -> DataFrame:
    """(id, domains, modalities, conditions, species, evidence) from id, source, text and keywords, by the tables ``terms``.

    Terms are looked for in the text and its keywords; topics and body parts are keywords that count as they stand, for one
    source each, body parts only where the text speaks of a tumour. Values come in vocabulary order, conditions sorted.
    Species is 'animal' if there are animal terms and no human ones, else null. ``evidence`` maps each value, and 'species', to
    what bore it out, in the order of terms, each once. Null texts and keywords say nothing; one narrow pass.
    """
    none = F.array().cast("array<string>")
    keywords = F.filter(F.coalesce(F.col("keywords"), none), lambda k: k.isNotNull())
    full = F.when(F.size(keywords) > 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.array_join(keywords, " "))).otherwise(F.coalesce("text", F.lit("")))
    exact = {kind: {v: [k for k, (t, x) in terms.topics.items() if (t, x) == (kind, v)] for _, v in terms.topics.values()} for kind in ("domain", "modality")}
    parts = {label: [p for p, x in terms.body_parts.items() if x == label] for label in terms.body_parts.values()}
    lower, upper = lambda k: F.lower(F.trim(k)), lambda k: F.upper(F.trim(k))
    topical = F.coalesce(F.col("source") == terms.topic_source, F.lit(False))
    tumour = F.coalesce(F.col("source") == terms.part_source, F.lit(False)) & (full.rlike("|".join(term_regex(t) for t in terms.mentions)) if terms.mentions else F.lit(False))
    species_terms = [*terms.animal, *terms.human]
    seen = evidence(full, species_terms) if species_terms else none
    rows = rows.select(
        "id",
        _entries(terms.domains, full, keywords, exact["domain"], lower, topical).alias("d"),
        _entries(terms.modalities, full, keywords, exact["modality"], lower, topical).alias("m"),
        _entries(terms.conditions, full, keywords, parts, upper, tumour).alias("c"),
        (species(full, terms.animal, terms.human) if terms.animal and terms.human else F.lit(None).cast("string")).alias("species"),
        F.when(F.size(seen) > 0, F.array(F.struct(F.lit("species").alias("value"), seen.alias("evidence")))).otherwise(F.array().cast("array<struct<value:string,evidence:array<string>>>")).alias("s"),
    )
    values = lambda c: F.transform(c, lambda x: x["value"])
    return rows.select(
        "id",
        ranked(values("d"), domains).alias("domains"),
        ranked(values("m"), modalities).alias("modalities"),
        F.array_sort(values("c")).alias("conditions"),
        "species",
        F.map_from_entries(F.concat("d", "m", "c", "s")).alias("evidence"),
    )
