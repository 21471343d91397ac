"""Differences of two snapshots, by path, and the changelog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import plain, truncate


def kept_columns(schema: T.StructType, paths: Sequence[str]) -> dict[str, Column]:
    """Column name -> value without dotted paths. Paths that aren't there, or run through an array, change nothing; a struct that loses all its fields goes."""

    def keep(kind: T.DataType, at: Column, gone: list[list[str]]) -> Column | None:
        if [] in gone:
            return None
        if not gone or not isinstance(kind, T.StructType) or not {g[0] for g in gone} & {*kind.names}:
            return at
        parts = {f.name: keep(f.dataType, at[f.name], [g[1:] for g in gone if g[0] == f.name]) for f in kind}
        left = [c.alias(n) for n, c in parts.items() if c is not None]
        return F.when(at.isNotNull(), F.struct(*left)) if left else None

    split = [p.split(".") for p in paths]
    out = {f.name: keep(f.dataType, F.col(f.name), [g[1:] for g in split if g[0] == f.name]) for f in schema}
    return {n: c for n, c in out.items() if c is not None}


def without(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in kept_columns(df.schema, paths).items()]) if paths else df


def leaves(schema: T.StructType, skip: Sequence[str] = ("id",)) -> dict[str, Column]:
    """Path -> value as JSON, for every leaf: structs are walked, arrays are one value."""
    out: dict[str, Column] = {}

    def walk(kind: T.StructType, at: Column | None, prefix: str):
        for f in kind:
            if not prefix and f.name in skip:
                continue
            c = F.col(f.name) if at is None else at[f.name]
            path = f"{prefix}{f.name}"
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, c, path + ".")
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                out[path] = F.to_json(c, {"ignoreNullFields": "false"})
            else:
                out[path] = c.cast("string")

    walk(schema, None, "")
    return out


def diff(old: DataFrame, new: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(id, kind, path, old, new): 'added' and 'removed' rows once, 'changed' rows once for each leaf that differs.

    Both snapshots share a schema with a unique ``id``. Nulls equal nulls. Each side is one row of
    leaves hashed together, so unchanged rows end at the join and only changed ones are unpivoted.
    """
    old, new = without(old, ignore), without(new, ignore)

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = leaves(df.schema)
        values = F.array(*[F.coalesce(F.concat(F.lit("="), v), F.lit("")) for v in cells.values()])
        return df.select("id", values.alias(name)), list(cells)

    (a, paths), (b, _) = side(old, "a"), side(new, "b")
    j = a.join(b, "id", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    show = lambda v: F.when(v != "", F.substring(v, 2, 1 << 30))
    changed = F.filter(
        F.transform(F.arrays_zip(F.array(*[F.lit(p) for p in paths]).alias("path"), F.col("a"), F.col("b")), lambda x: F.struct(x["path"].alias("path"), x["a"].alias("a"), x["b"].alias("b"))),
        lambda x: x["a"] != x["b"],
    )
    whole = F.array(F.struct(F.lit(None).cast("string").alias("path"), F.lit("").alias("a"), F.lit("").alias("b")))
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    rows = j.select("id", kind.alias("kind"), F.explode(F.when(kind == "changed", changed).otherwise(whole)).alias("x"))
    return rows.select("id", "kind", F.col("x.path").alias("path"), show(F.col("x.a")).alias("old"), show(F.col("x.b")).alias("new"))


def value_changes(kind: T.DataType, a: Column, b: Column, path: Column) -> Column:
    """array<struct(path, old, new)>: where two values of a type differ, by JSON pointer.

    Structs are walked by field, in the order of names; arrays of equal length item by item; what is left, and arrays
    that grew or shrank, is one value. Numbers and texts show as they are, the rest as JSON. Nulls equal nulls.
    """
    shown = lambda v: F.to_json(v, {"ignoreNullFields": "false"}) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else v.cast("string")
    none = F.array().cast("array<struct<path:string,old:string,new:string>>")
    equal = shown(a).eqNullSafe(shown(b)) if isinstance(kind, T.MapType) else a.eqNullSafe(b)
    whole = F.array(F.struct(path.alias("path"), shown(a).alias("old"), shown(b).alias("new")))
    if isinstance(kind, T.StructType):
        parts = F.concat(*[value_changes(kind[n].dataType, a[n], b[n], F.concat(path, F.lit(f"/{n}"))) for n in sorted(kind.names)])
        deep = F.when(a.isNotNull() & b.isNotNull(), parts).otherwise(whole)
    elif isinstance(kind, T.ArrayType):
        items = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda z, i: value_changes(kind.elementType, z["a"], z["b"], F.concat(path, F.lit("/"), i.cast("string"))))
        deep = F.when(F.size(a) == F.size(b), F.flatten(items)).otherwise(whole)
    else:
        deep = whole
    return F.when(equal, none).otherwise(deep)


def pointer_diff(old: DataFrame, new: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """(id, kind, path, old, new) like ``diff``, with JSON pointers into structs and into lists of equal length.

    Both snapshots share a schema with a unique ``id``. Rows whose hash is equal end at the join's filter.
    """
    old, new = without(old, ignore), without(new, ignore)
    names = sorted(c for c in new.columns if c != "id")

    def side(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*names)
        return df.select("id", row.alias(name), F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256).alias(f"{name}_hash"))

    j = side(old, "a").join(side(new, "b"), "id", "full_outer").where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))
    kind = F.when(F.col("a_hash").isNull(), "added").when(F.col("b_hash").isNull(), "removed").otherwise("changed")
    changed = F.concat(F.array().cast("array<struct<path:string,old:string,new:string>>"), *[value_changes(new.schema[n].dataType, F.col("a")[n], F.col("b")[n], F.lit(f"/{n}")) for n in names])
    nothing = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("path", "old", "new")]))
    return j.select("id", kind.alias("kind"), F.inline(F.when(kind == "changed", changed).otherwise(nothing)))


def diff_counts(old: DataFrame, new: DataFrame, found: DataFrame) -> DataFrame:
    """One row: added, removed, changed, unchanged."""
    common = old.select("id").join(new.select("id"), "id", "left_semi").select(F.lit("common").alias("kind"))
    kinds = found.select("id", "kind").distinct().select("kind").unionByName(common)
    n = {k: F.count(F.when(F.col("kind") == k, 1)) for k in ("added", "removed", "changed", "common")}
    return kinds.agg(*[n[k].alias(k) for k in ("added", "removed", "changed")], (n["common"] - n["changed"]).alias("unchanged"))


def changelog(found: DataFrame, records: int = 200, paths: int = 10, width: int = 120) -> DataFrame:
    """(kind, id, line): Markdown lines of a difference: at most ``records`` of each kind by id, ``paths`` of each record, values cut at ``width``."""
    ids = found.select("kind", "id").distinct().withColumn("k", F.row_number().over(Window.partitionBy("kind").orderBy("id"))).where(F.col("k") <= records)
    top = found.join(ids, ["kind", "id"]).withColumn("p", F.row_number().over(Window.partitionBy("kind", "id").orderBy("path"))).where(F.col("p") <= paths)
    cell = lambda c: truncate(plain(F.coalesce(c, F.lit("null"))), width)
    line = F.when(F.col("kind") == "changed", F.concat(F.lit("| "), plain(F.col("id")), F.lit(" | `"), F.col("path"), F.lit("` | "), cell(F.col("old")), F.lit(" | "), cell(F.col("new")), F.lit(" |"))).otherwise(F.concat(F.lit("- "), plain(F.col("id"))))
    return top.select("kind", "id", "p", line.alias("line"))


def document(found: DataFrame, records: DataFrame, counts: Mapping[str, int], day: str, sources: Sequence[Mapping] = (), enrichment: Mapping | None = None, warnings: int = 0, most: int = 200, paths: int = 10, width: int = 120) -> str:
    """The whole changelog of a run as Markdown: sources, failures, added, removed and changed records, enrichment, warnings.

    ``found`` is a ``pointer_diff``, ``records`` have id, name and url of both snapshots' records, ``sources`` a run's results by source.
    Records are cut at ``most`` of each kind, paths at ``paths`` of each record, values at ``width``, and what is left out is
    counted, so what comes to the driver is bounded by the caps.
    """
    per = found.groupBy("kind", "id").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("path", "old", "new"))), 1, paths).alias("top"))
    k = F.row_number().over(Window.partitionBy("kind").orderBy("id"))
    top = per.withColumn("k", k).where(F.col("k") <= most).join(records.select(F.col("id").alias("known"), "name", "url"), F.col("id") == F.col("known"), "left")
    show = lambda c: truncated(plain(F.coalesce(c, F.lit("null"))), width)
    change = F.transform("top", lambda t: F.concat(F.lit("  - `"), t["path"], F.lit("`: `"), show(t["old"]), F.lit("` → `"), show(t["new"]), F.lit("`")))
    name, url = (plain(F.coalesce(F.col(c), F.lit(""))) for c in ("name", "url"))
    head = F.concat(F.lit("- `"), F.col("id"), F.lit("` — "), name, F.when(F.col("kind") == "changed", "").otherwise(F.concat(F.lit(" — "), url)))
    rows = top.select("kind", "id", "n", head.alias("head"), F.when(F.col("kind") == "changed", change).otherwise(F.array().cast("array<string>")).alias("changes")).orderBy("kind", "id").collect()

    def section(kind: str) -> str:
        n = counts.get(kind, 0)
        lines = [x for r in rows if r["kind"] == kind for x in (r["head"], *r["changes"], *([f"  - … and {r['n'] - paths} more"] if kind == "changed" and r["n"] > paths else []))]
        return "\n".join([f"## {kind.capitalize()} ({n})", "", *(lines or ["none"]), *([f"- … and {n - most} more"] if n > most else [])])

    cells = ("source", "status", "listed", "written", "unchanged", "removed", "seconds", "error")
    by_name = sorted(sources, key=lambda s: s["source"])
    cell = lambda s, c: f"{s.get(c) or 0:.2f}" if c == "seconds" else one_line(str(s.get(c) if s.get(c) is not None else "" if c == "error" else 0))
    table = ["| " + " | ".join(cells) + " |", "|" + "---|" * len(cells), *("| " + " | ".join(cell(s, c) for c in cells) + " |" for s in by_name)]
    failed = [f"- `{s['source']}`: {s['status']}" + (f" — {one_line(s['error'])}" if s.get("error") else "") for s in by_name if s["status"] not in ("ok", "unselected")]
    told = [f"- {c}: " + (f"`{one_line(str(enrichment.get(c) or none))}`" if none else one_line(str(enrichment.get(c, 0)))) for c, none in (("backend", "unknown"), ("model", "none"), ("calls", ""), ("cache_hits", ""), ("guard_drops", ""), ("failures", ""), ("record_errors", ""))] if enrichment is not None else ["not run"]
    line = f"**+{counts.get('added', 0)} new, ~{counts.get('changed', 0)} changed, -{counts.get('removed', 0)} removed, {counts.get('unchanged', 0)} unchanged**"
    blocks = [f"# Refresh {day}", line, "\n".join(["## Sources", "", *table]), "\n".join(["## Failures", "", *(failed or ["none"])]), section("added"), section("removed"), section("changed"), "\n".join(["## Enrichment", "", *told]), f"## Validation warnings: {warnings}"]
    return "\n\n".join(blocks) + "\n"


def one_line(text: str) -> str:
    """``plain`` of a text that is on the driver."""
    kept = "".join(c for c in text if c >= " " and c != "\x7f" or c in "\t\n\x0b\x0c\r")
    return " ".join(kept.split()).replace("`", "'").replace("|", "\\|")


def truncated(s: Column, most: int) -> Column:
    """The first ``most`` letters, and a sign that there were more."""
    return F.when(F.length(s) > most, F.concat(F.substring(s, 1, most), F.lit("…"))).otherwise(s)


def title(counts: Mapping[str, int]) -> str:
    """Changes in one line: '+1 added, ~2 changed, -3 removed'."""
    parts = [f"{sign}{counts.get(k, 0):,} {k}" for sign, k in (("+", "added"), ("~", "changed"), ("-", "removed")) if counts.get(k)]
    return ", ".join(parts) or "no changes"


def render(found: DataFrame, counts: Mapping[str, int], day: str, records: int = 200, paths: int = 10) -> str:
    """The changelog as Markdown. Its length is bounded by the caps, so it is put together on the driver."""
    rows = changelog(found, records, paths).orderBy("kind", "id", "p").collect()
    out = [f"# {day}", "", title(counts), ""]
    for kind in ("added", "changed", "removed"):
        mine = [r["line"] for r in rows if r["kind"] == kind]
        if mine:
            out += [f"## {kind.capitalize()} ({counts.get(kind, len(mine)):,})", ""]
            out += ["| id | field | old | new |", "| --- | --- | --- | --- |"] if kind == "changed" else []
            out += [*mine, ""]
    return "\n".join(out)
