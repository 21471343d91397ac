"""Validation of records, of references between them, and of quality findings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import word_count


def record_checks(vocabularies: Mapping[str, Sequence[str]], arrays: Mapping[str, Sequence[str]], required: Sequence[str] = ("id", "source", "name", "summary", "url")) -> dict[str, Column]:
    """Message -> condition that is true where a record is wrong."""
    checks: dict[str, Column] = {f"{c}: missing": F.coalesce(F.col(c), F.lit("")) == "" for c in required}
    checks["id: malformed"] = ~F.coalesce(F.col("id").rlike(r"^[a-z_]+:[A-Za-z0-9._-]+$"), F.lit(True))
    checks["id: not of its source"] = ~F.coalesce(F.startswith("id", F.concat("source", F.lit(":"))), F.lit(True))
    checks["summary: over 40 words"] = word_count(F.col("summary")) > 40
    checks["url: no http address"] = ~F.coalesce(F.col("url").rlike("^https?://"), F.lit(True))
    for c, values in vocabularies.items():
        checks[f"{c}: unknown value"] = ~F.coalesce(F.col(c).isin(*values), F.lit(True))
    for c, values in arrays.items():
        checks[f"{c}: unknown value"] = F.coalesce(F.size(F.array_except(c, F.array(*[F.lit(v) for v in values]))) > 0, F.lit(False))
    return checks


def warning_checks(open_access: str = "open") -> dict[str, Column]:
    return {
        "no domains assigned": F.coalesce(F.size("domains"), F.lit(0)) == 0,
        "no modalities assigned": F.coalesce(F.size("modalities"), F.lit(0)) == 0,
        "access without notes": (F.col("access") != open_access) & (F.coalesce(F.col("access_notes"), F.lit("")) == ""),
        "sample_size without sample_unit": F.col("sample_size").isNotNull() & F.col("sample_unit").isNull(),
    }


def violations(records: DataFrame, checks: Mapping[str, Column], severity: str) -> DataFrame:
    """(id, severity, message): one row for each check that a record fails, in one pass over the records."""
    made = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for m, c in checks.items()])
    return records.select("id", F.lit(severity).alias("severity"), F.explode(F.filter(made, lambda m: m.isNotNull())).alias("message"))


def duplicate_ids(records: DataFrame) -> DataFrame:
    return records.groupBy("id").count().where("count > 1").select("id", F.lit("error").alias("severity"), F.lit("duplicate id").alias("message"))


def dangling(records: DataFrame, valid: DataFrame) -> DataFrame:
    """Links whose target is no valid record, however it reads in the input."""
    refs = records.select("id", F.explode("related").alias("other")).distinct()
    known = valid.select(F.col("id").alias("known")).distinct()
    return refs.join(known, F.col("other") == F.col("known"), "left_anti").select("id", F.lit("error").alias("severity"), F.concat(F.lit("related id does not match any record: "), "other").alias("message"))


def validate(records: DataFrame, checks: Mapping[str, Column], warnings: Mapping[str, Column]) -> DataFrame:
    """(id, severity, message) of a batch: failed checks, repeated ids, dangling links; warnings of valid records only."""
    errors = violations(records, checks, "error")
    bad = errors.select(F.col("id").alias("__bad")).distinct()
    valid = records.join(bad, F.col("id").eqNullSafe(F.col("__bad")), "left_anti")
    return errors.unionByName(duplicate_ids(valid)).unionByName(dangling(valid, valid)).unionByName(violations(valid, warnings, "warning"))


def quality_score(findings: DataFrame, penalties: Mapping[str, int], weights: Mapping[str, float], caps: Mapping[str, float], passed: bool = True) -> DataFrame:
    """(lens scores, overall): each lens 100 less its open penalties, at least 0; a weighted mean under the caps of open severities.

    ``findings`` has lens, severity, status. The lens ``dod`` is 100 if the acceptance gates passed, else 0.
    """
    cost = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in penalties.items() for x in kv]), F.col("severity")), F.lit(1))
    is_open = F.col("status") == "open"
    lenses = [w for w in weights if w != "dod"]
    sums = [F.coalesce(F.sum(F.when(is_open & (F.col("lens") == x), cost)), F.lit(0)).alias(x) for x in lenses]
    counts = [F.coalesce(F.sum(F.when(is_open & (F.col("severity") == s), 1)), F.lit(0)).alias(f"open_{s}") for s in penalties]
    row = findings.agg(*sums, *counts)
    row = row.withColumns({x: F.greatest(F.lit(0), 100 - F.col(x)) for x in lenses}).withColumn("dod", F.lit(100 if passed else 0))
    overall = reduce(add, [F.col(x) * w for x, w in weights.items()]) / sum(weights.values())
    for s, most in caps.items():
        overall = F.when(F.col(f"open_{s}") > 0, F.least(overall, F.lit(float(most)))).otherwise(overall)
    return row.withColumn("overall", F.round(overall, 1))


def ledger_upsert(ledger: DataFrame, found: DataFrame, today: str) -> DataFrame:
    """A ledger (key, lens, severity, status, first_seen, last_seen) after a run: what is found again stays open or opens anew."""
    j = ledger.alias("l").join(found.alias("f"), "key", "full_outer")
    hit = F.col("f.lens").isNotNull()
    return j.select(
        "key",
        F.coalesce("f.lens", "l.lens").alias("lens"),
        F.coalesce("f.severity", "l.severity").alias("severity"),
        F.when(hit & F.coalesce(F.col("l.status") != "wontfix", F.lit(True)), "open").otherwise(F.col("l.status")).alias("status"),
        F.coalesce("l.first_seen", F.lit(today)).alias("first_seen"),
        F.when(hit, F.lit(today)).otherwise(F.col("l.last_seen")).alias("last_seen"),
    )


def age_open(ledger: DataFrame, before: str) -> DataFrame:
    """Open entries not seen since ``before`` are stale."""
    return ledger.withColumn("status", F.when((F.col("status") == "open") & (F.col("last_seen") < before), "stale").otherwise(F.col("status")))


def mark(ledger: DataFrame, keys: DataFrame, status: str, known: Sequence[str] = ("open", "fixed", "wontfix", "stale")) -> DataFrame:
    """The ledger with the status of the entries in ``keys`` (column key) set; keys that it lacks change nothing."""
    if status not in known:
        raise ValueError(f"{status!r} is no status")
    chosen = keys.select(F.col("key").alias("chosen")).distinct()
    j = ledger.join(chosen, F.col("key") == F.col("chosen"), "left")
    return j.withColumn("status", F.when(F.col("chosen").isNotNull(), F.lit(status)).otherwise(F.col("status"))).drop("chosen")


def gates(counts: Mapping[str, float], required: Mapping[str, tuple[str, float]]) -> list[tuple[str, str, str]]:
    """(name, PASS or FAIL, detail) of acceptance gates; each compares one figure by <= or >=."""
    out = []
    for name, (sign, limit) in required.items():
        have = counts.get(name)
        ok = have is not None and (have <= limit if sign == "<=" else have >= limit)
        out.append((name, "PASS" if ok else "FAIL", f"{have} {sign} {limit}"))
    return out
