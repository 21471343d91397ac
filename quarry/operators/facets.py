"""Faceted filtering, counts, sorted pages and export over catalog rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_
from urllib.parse import parse_qs, urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import csv_cell, rank

#: Facet -> (column, whether it holds an array).
FACETS: Mapping[str, tuple[str, bool]] = {
    "domain": ("domains", True),
    "modality": ("modalities", True),
    "condition": ("conditions", True),
    "access": ("access", False),
    "source": ("source", False),
    "country": ("countries", True),
    "species": ("species", False),
}


@dataclass(frozen=True)
class FacetQuery:
    """What a reader has chosen: values by facet, an open or closed range of years, words, an order."""

    chosen: Mapping[str, Sequence[str]] = field(default_factory=dict)
    years: tuple[int | None, int | None] = (None, None)
    q: str = ""
    sort: str = "name"
    descending: bool = False

    @classmethod
    def parse(cls, text: str) -> FacetQuery:
        """From a query string; what is malformed or unknown is ignored."""
        got = parse_qs(text.lstrip("?"))
        chosen = {f: tuple(v for x in got[f] for v in x.split(",") if v) for f in FACETS if f in got}
        span = re.fullmatch(r"(\d{4})?-(\d{4})?", got.get("years", [""])[-1])
        years = tuple(int(x) if x else None for x in span.groups()) if span else (None, None)
        order = re.fullmatch(r"(\w+)(?:-(asc|desc))?", got.get("sort", ["name"])[-1])
        known = order and order[1] in SORTS
        return cls({f: v for f, v in chosen.items() if v}, years, got.get("q", [""])[-1], order[1] if known else "name", bool(known and order[2] == "desc"))

    def format(self) -> str:
        """The query string; the default order and what is empty are left out."""
        parts = [(f, ",".join(self.chosen[f])) for f in FACETS if self.chosen.get(f)]
        if self.years != (None, None):
            parts.append(("years", "-".join("" if y is None else str(y) for y in self.years)))
        if self.q:
            parts.append(("q", self.q))
        if (self.sort, self.descending) != ("name", False):
            parts.append(("sort", f"{self.sort}-{'desc' if self.descending else 'asc'}"))
        return urlencode(parts)

    def without(self, facet: str) -> FacetQuery:
        return replace(self, chosen={f: v for f, v in self.chosen.items() if f != facet})

    def active(self) -> int:
        """How many filters are on: chosen values, and one for a range of years."""
        return sum(len(v) for v in self.chosen.values()) + (self.years != (None, None))


def matches_facet(facet: str, chosen: Sequence[str]) -> Column:
    """True if nothing is chosen, or the row has any chosen value."""
    if not chosen:
        return F.lit(True)
    column, many = FACETS[facet]
    values = [F.lit(v) for v in chosen]
    return F.coalesce(F.arrays_overlap(F.col(column), F.array(*values)) if many else F.col(column).isin(*chosen), F.lit(False))


def overlaps_years(start: Column, end: Column, years: tuple[int | None, int | None]) -> Column:
    """Inclusive overlap of two spans that may be open; a row without any year fails while a range is asked for."""
    low, high = years
    if low is None and high is None:
        return F.lit(True)
    known = start.isNotNull() | end.isNotNull()
    after = F.coalesce(end >= low, F.lit(True)) if low is not None else F.lit(True)
    before = F.coalesce(start <= high, F.lit(True)) if high is not None else F.lit(True)
    return known & after & before


def matches_text(q: str, columns: Sequence[str] = ("id", "name", "summary", "source"), arrays: Sequence[str] = ("conditions",)) -> Column:
    """Every word of ``q`` is part of the row's texts, whatever its case."""
    found = q.strip().lower().split()
    if not found:
        return F.lit(True)
    text = F.lower(F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in columns], *[F.col(a) for a in arrays]))
    return reduce(and_, [text.contains(w) for w in found])


def predicate(query: FacetQuery, skip: str | None = None, text: Mapping[str, Sequence[str]] | None = None) -> Column:
    """One condition for the whole query: all facets but ``skip``, the years and the words."""
    parts = [matches_facet(f, v) for f, v in query.chosen.items() if f != skip and v]
    if query.years != (None, None):
        parts.append(overlaps_years(F.col("year_start"), F.col("year_end"), query.years))
    if query.q.strip():
        parts.append(matches_text(query.q, **(text or {})))
    return reduce(and_, parts, F.lit(True))


def apply(rows: DataFrame, query: FacetQuery, **text: Sequence[str]) -> DataFrame:
    return rows.where(predicate(query, text=text or None))


def _named(facet: str):
    return lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value"))


def facet_counts(rows: DataFrame, query: FacetQuery, facets: Sequence[str] = tuple(FACETS)) -> DataFrame:
    """(facet, value, n): rows that would match if the value were chosen, each facet's own choice aside.

    All facets come from one pass: each row gives its values for every facet whose other
    conditions it meets, and one partial aggregate counts them. A value that a row repeats
    counts as often.
    """
    pairs = []
    for f in facets:
        column, many = FACETS[f]
        values = F.coalesce(F.col(column), F.array().cast("array<string>")) if many else F.when(F.nullif(F.col(column), F.lit("")).isNotNull(), F.array(F.col(column))).otherwise(F.array().cast("array<string>"))
        made = F.transform(values, _named(f))
        pairs.append(F.when(predicate(query, skip=f), made).otherwise(F.slice(made, 1, 0)))
    return rows.select(F.inline(F.flatten(F.array(*pairs)))).groupBy("facet", "value").agg(F.count("*").alias("n"))


def stable_facet_counts(rows: DataFrame, query: FacetQuery, facets: Sequence[str] = tuple(FACETS)) -> DataFrame:
    """Like ``facet_counts``, with every value of the unfiltered rows, 0 where none matches."""
    every = facet_counts(rows, FacetQuery(), facets).select("facet", "value")
    live = facet_counts(rows, query, facets)
    return every.join(live, ["facet", "value"], "left").select("facet", "value", F.coalesce("n", F.lit(0)).alias("n"))


def option_order(counts: DataFrame, orders: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number a facet's options: by vocabulary where it has an order, else by label; never by count."""
    from pyspark.sql import Window

    place = F.lit(0)
    for facet, order in orders.items():
        place = F.when(F.col("facet") == facet, F.when(rank(F.col("value"), order) > 0, rank(F.col("value"), order)).otherwise(len(order) + 1)).otherwise(place)
    return counts.withColumn("place", F.row_number().over(Window.partitionBy("facet").orderBy(place, F.lower("value"), "value")))


#: Sort name -> column expression.
SORTS = {
    "name": lambda access: F.lower(F.col("name")),
    "source": lambda access: F.lower(F.col("source")),
    "access": lambda access: F.nullif(rank(F.col("access"), access), F.lit(0)),
    "years": lambda access: F.coalesce(F.col("year_start"), F.col("year_end")),
    "size": lambda access: F.col("sample_size"),
}


def page(rows: DataFrame, query: FacetQuery, access: Sequence[str], chunk: int = 100, chunks: int = 1, skip: int = 0) -> DataFrame:
    """The first ``chunks`` x ``chunk`` rows after ``skip``, numbered from 1 in ``pos``.

    Missing values come last in either direction; ties go by name and id, upward in either
    direction. The limit is under the sort, so each task sends only its first rows.
    """
    from pyspark.sql import Window

    by = SORTS[query.sort](access)
    order = [by.desc_nulls_last() if query.descending else by.asc_nulls_last(), F.lower("name").asc(), F.col("id").asc()]
    top = rows.orderBy(*order).limit(skip + chunk * chunks)
    return top.withColumn("pos", F.row_number().over(Window.orderBy(*order))).where(F.col("pos") > skip)


def csv_lines(rows: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(id, line): each row as quoted cells; arrays are joined with '; '. The header, BOM and CRLF belong to the sink."""
    return rows.select("id", F.concat_ws(",", *[csv_cell(c) for c in columns.values()]).alias("line"))


def csv_document(rows: DataFrame, columns: Mapping[str, Column], path: str) -> None:
    """Write the export as text parts in order of id: BOM and header first, every line ended by CRLF."""
    head = rows.sparkSession.createDataFrame([("", "﻿" + ",".join(f'"{c}"' for c in columns))], "id string, line string")
    lines = head.withColumn("k", F.lit(0)).unionByName(csv_lines(rows, columns).withColumn("k", F.lit(1)))
    lines.orderBy("k", "id").select(F.concat("line", F.lit("\r")).alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)
