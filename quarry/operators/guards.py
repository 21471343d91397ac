"""Guards: what a model says about a record counts only where the record's own text bears it out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import alias, collapse, ranked, word_count


def evidenced(quote: Column, text: Column, least: int = 10) -> Column:
    """The quote has ``least`` characters and a blank, and the text contains it, case and white space aside."""
    q = F.lower(collapse(quote))
    return F.coalesce((F.length(q) >= least) & q.contains(" ") & F.lower(collapse(text)).contains(q), F.lit(False))


def numbers(s: Column) -> Column:
    """Distinct numbers of a text, without separators."""
    found = F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(r"(\d[\d,.%]*)"), 1)
    return F.array_distinct(F.transform(found, lambda n: F.regexp_replace(n, "[,.%]", "")))


def numbers_grounded(claim: Column, text: Column) -> Column:
    """No number of the claim is missing in the text."""
    return F.size(F.array_except(numbers(claim), numbers(text))) == 0


def content_words(s: Column, least: int = 4) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(s, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)
    return F.array_distinct(F.filter(found, lambda w: F.length(w) >= least))


def grounded(claim: Column, text: Column, share: float = 0.6) -> Column:
    """At least ``share`` of the claim's longer words are in the text; a claim without any passes."""
    said = content_words(claim)
    return (F.size(said) == 0) | (F.size(F.array_intersect(said, content_words(text))) >= share * F.size(said))


def summary_ok(summary: Column, text: Column, most: int = 40) -> Column:
    return (word_count(summary) <= most) & numbers_grounded(summary, text) & grounded(summary, text)


ANSWER = "in_scope boolean, domains array<string>, modalities array<struct<value:string,evidence:string>>, conditions array<struct<label:string,evidence:string>>, summary string, population string, countries array<string>"


def apply_answers(records: DataFrame, answers: DataFrame, domains: Sequence[str], modalities: Sequence[str], aliases: dict[str, str], journals: Sequence[str]) -> DataFrame:
    """Records with what passed of their answers, and ``drops``, how much did not.

    ``records`` has id, source, text, record_status, domains, modalities, conditions (labels), summary, population and
    countries; ``answers`` id and ``answer``. Values outside a vocabulary, modalities and conditions without a quote from
    the text, a summary that is long or not borne out, and codes that are no countries are dropped and
    counted. Accepted values are added; a population only where there is none. Out of scope flags journals only.
    An answer for an id that isn't there is never applied.
    """
    none = F.array().cast("array<string>")
    j = records.join(answers, "id", "left")
    a, text = F.col("answer"), F.col("text")
    said = lambda name, kind: F.coalesce(a[name], F.array().cast(kind))
    pairs, labels = "array<struct<value:string,evidence:string>>", "array<struct<label:string,evidence:string>>"
    ok_domains = F.filter(said("domains", "array<string>"), lambda d: d.isin(*domains))
    ok_modalities = F.filter(said("modalities", pairs), lambda m: m["value"].isin(*modalities) & evidenced(m["evidence"], text))
    ok_conditions = F.filter(said("conditions", labels), lambda c: evidenced(c["evidence"], text) & (F.trim(c["label"]) != ""))
    ok_countries = F.filter(said("countries", "array<string>"), lambda c: c.rlike("^[A-Z]{2}$"))
    ok_summary = F.coalesce(a["summary"].isNotNull() & (a["summary"] != "") & summary_ok(a["summary"], text), F.lit(False))
    lost = lambda kept, name, kind: F.size(said(name, kind)) - F.size(kept)
    drops = lost(ok_domains, "domains", "array<string>") + lost(ok_modalities, "modalities", pairs) + lost(ok_conditions, "conditions", labels) + lost(ok_countries, "countries", "array<string>") + F.when(a["summary"].isNotNull() & ~ok_summary, 1).otherwise(0)
    new_labels = F.transform(ok_conditions, lambda c: alias(c["label"], aliases))
    have = F.transform(F.coalesce("conditions", none), lambda c: alias(c, aliases))
    added = F.filter(F.array_distinct(new_labels), lambda x: ~F.exists(have, lambda y: F.lower(y) == F.lower(x)))
    out_of_scope = F.coalesce(~a["in_scope"], F.lit(False)) & F.col("source").isin(*journals)
    return j.withColumns({
        "domains": ranked(F.concat(F.coalesce("domains", none), ok_domains), domains),
        "modalities": ranked(F.concat(F.coalesce("modalities", none), F.transform(ok_modalities, lambda m: m["value"])), modalities),
        "conditions": F.concat(F.coalesce("conditions", none), added),
        "countries": F.concat(F.coalesce("countries", none), F.array_sort(F.array_except(ok_countries, F.coalesce("countries", none)))),
        "summary": F.when(ok_summary, a["summary"]).otherwise(F.col("summary")),
        "population": F.coalesce("population", a["population"]),
        "record_status": F.when(out_of_scope, "needs_review").otherwise(F.col("record_status")),
        "drops": F.when(a.isNull(), 0).otherwise(drops),
    }).drop("answer")
