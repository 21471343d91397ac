"""Ranked search over names and other fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import tokens

PREFIX, SUBSTRING, OTHER, EXACT = 3000, 2000, 1000, 500


def _tokens(q: str) -> list[str]:
    out, word = [], ""
    for c in q.lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def score(q: str, name: Column, other: Column) -> Column:
    """0 where nothing matches; else a tier, an exact name's bonus, and a small charge for long names.

    Words of the name that start with the query, or with every word of it, beat a name that
    contains them, which beats other fields that do.
    """
    needle, words = q.strip().lower(), _tokens(q)
    if not needle:
        return F.lit(0.0)
    name_tokens, lower, rest = tokens(name), F.lower(F.coalesce(name, F.lit(""))), F.lower(F.coalesce(other, F.lit("")))
    starts = lambda w: F.exists(name_tokens, lambda t: t.startswith(w))

    def every(test):
        out = F.lit(bool(words))
        for w in words:
            out = out & test(w)
        return out

    tier = (
        F.when(starts(needle) | every(starts), PREFIX)
        .when(lower.contains(needle) | every(lower.contains), SUBSTRING)
        .when(rest.contains(needle) | every(rest.contains), OTHER)
        .otherwise(0)
    )
    bonus = F.when(lower == needle, EXACT).otherwise(0)
    return F.when(tier > 0, tier + bonus - F.least(F.length(F.coalesce(name, F.lit(""))), F.lit(200)) * 0.1).otherwise(0.0)


def search(rows: DataFrame, q: str, other: Column, limit: int = 20) -> DataFrame:
    """The best ``limit`` rows by score, then name, then id; the limit runs in every task before rows meet."""
    hits = rows.withColumn("score", F.round(score(q, F.col("name"), other), 1)).where("score > 0")
    return hits.orderBy(F.desc("score"), "name", "id").limit(limit)
