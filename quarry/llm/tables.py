"""Reading the corpus tables, and small helpers that the operators share."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system: a Python worker is reused, and what one stage freed would count beside what the next one needs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library can
        pass


def named(column: str) -> Column:
    """The column of just that name, whatever signs the name has."""
    return F.col(f"`{column.replace('`', '``')}`")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1 and so on: ``mapInArrow`` asks for columns by name, and fails at names with dots or backticks."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def unused(columns: list[str], name: str) -> str:
    """``name``, with as many ``_`` as make it no column's name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def latin_pattern(pattern: str, space: str) -> re.Pattern:
    """A pattern over \\p{L}, \\p{N} and white space for texts in Latin-1, with the classes spelt out, as ``re`` is faster than ``regex``.

    ``space`` is the inside of a class of what \\s is to mean.
    """

    def inside(kind: str) -> str:
        return "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(f"[{kind}]", c))

    letter, number, blank = inside(r"\p{L}"), inside(r"\p{N}"), inside(space)
    for a, b in ((r"[^\s\p{L}\p{N}]", f"[^{blank}{letter}{number}]"), (r"[\p{L}]", f"[{letter}]"), (r"[\p{N}]", f"[{number}]"), (r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\s", f"[{blank}]"), (r"\S", f"[^{blank}]")):
        pattern = pattern.replace(a, b)
    return re.compile(pattern)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
