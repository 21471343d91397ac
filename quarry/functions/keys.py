"""Keys by which records of different sources are known to be the same thing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.vocab import TITLE_STOPWORDS

_DOI = r"^10\.\d{4,9}/\S+$"


def clean_doi(s: Column) -> Column:
    """A bare lower-case DOI, from one with doi: or a resolver address before it; null if it isn't one."""
    bare = F.lower(F.regexp_replace(F.trim(s), r"(?i)^(?:doi:\s*|https://doi\.org/|http://(?:dx\.)?doi\.org/)", ""))
    return F.when(bare.rlike(_DOI), bare)


def collapse_version(doi: Column) -> Column:
    return F.regexp_replace(doi, r"\.v\d+(?:\.\d+)*$", "")


def doi_key(s: Column) -> Column:
    return collapse_version(clean_doi(s))


def extract_dois(s: Column) -> Column:
    """Distinct DOIs of a text, in order, without the punctuation that ends them."""
    found = F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(r"""(10\.\d{4,9}/[^\s"'<>]+)"""), 1)
    return F.array_distinct(F.transform(found, lambda d: F.lower(F.regexp_replace(d, r"[.,;:)\]}]+$", ""))))


def normalize_url(s: Column) -> Column:
    """An address without http scheme, query, fragment, www. and final slashes, the host in lower case; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(s), r"(?i)^https?://", ""), r"(?s)[?#].*$", ""), "/+$", "")
    host = F.regexp_replace(F.lower(F.substring_index(bare, "/", 1)), r"^www\.", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(bare, "^[^/]*", "")))


def url_key(s: Column, listings: Sequence[str] = ()) -> Column:
    """The normalised address if its path has two or more segments and it is no listing of many records."""
    url = normalize_url(s)
    deep = F.size(F.split(url, "/")) >= 3
    return F.when(deep & ~url.isin(*listings) if listings else deep, url)


def accession_key(source: Column, native_id: Column, url: Column, shapes: Mapping[str, str], cased: Sequence[str] = ()) -> Column:
    """'repository:accession' of a record: its own id if its source is a repository, else the first shape that its address has.

    ``shapes`` gives for each repository, in order, a pattern with the accession as its one
    group. Accessions are lower-cased but for the repositories in ``cased``.
    """
    fold = lambda kind, value: F.concat(F.lit(f"{kind}:"), value if kind in cased else F.lower(value))
    found = F.coalesce(*[F.when(F.regexp_extract(url, p, 1) != "", fold(k, F.regexp_extract(url, p, 1))) for k, p in shapes.items()])
    for kind in shapes:
        found = F.when(source == kind, fold(kind, native_id)).otherwise(found)
    return found


def title_fingerprint(s: Column, stopwords: Sequence[str] = TITLE_STOPWORDS) -> Column:
    """Distinct ASCII words of a title, without stopwords, sorted and joined; null if none is left."""
    found = F.regexp_extract_all(F.lower(F.coalesce(s, F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    return F.nullif(F.array_join(F.array_sort(F.array_except(found, F.array(*[F.lit(w) for w in stopwords]))), " "), F.lit(""))
