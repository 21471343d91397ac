"""Quality rules: failures by host, rates shrunk with an empirical beta prior, verdicts joined back."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.tables import named, table, utf8
from quarry.operators.state import cut

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules whose failures are counted by host, as SQL over the counts and n_lines (lines with a word). The first two are the base.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words",
}


def _codes(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of each window; equal windows have equal ones."""
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    code = np.zeros(len(ids) - width + 1, np.uint64)
    for i in range(width):
        code = (code ^ mixed[i : i + len(code)]) * np.uint64(0xD6E8FEB86659FD93) + (code >> np.uint64(29))
    return code


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words covered by a window of ``width`` words that is found twice or more, first finds included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    code = _codes(ids, width)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():  # equal windows have equal codes
        return 0
    suspects = np.unique(np.r_[order[1:][same], order[:-1][same]]).tolist()
    seen: dict[tuple[int, ...], list[int]] = {}
    for i in suspects:  # codes may collide: the words decide
        seen.setdefault(tuple(ids[i : i + width].tolist()), []).append(i)
    step = np.zeros(len(words) + 1, np.int64)
    for at in seen.values():
        if len(at) > 1:
            step[at] += 1
            step[[i + width for i in at]] -= 1
    return int((np.cumsum(step) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text (null: none)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = utf8(text)
    words = raw.split()
    blanks = sum(text.count(c) for c in _BLANKS)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), len(text) - blanks, sum(text.count(c) for c in _SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines)


def measures(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, host, the five counts, n_lines) for each row."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("host", docs.schema[host].dataType), *(T.StructField(c, T.LongType()) for c in (*COUNTS, "n_lines"))])

    def run(batches):
        for b in batches:
            counts = np.array([measure(t.as_py()) for t in b.column(2)], np.int64).reshape(-1, len(COUNTS) + 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(c)) for c in counts.T)], names=schema.names)

    return docs.select(named("doc_id").alias("doc_id"), named(host).alias("host"), named("text").alias("text")).mapInArrow(run, schema)


def prior(mean: float, var: float, noise: float) -> tuple[float, float]:
    """(mean, strength) of the beta prior by moments of the hosts' raw rates, each host once.

    ``var`` holds the rates' own spread and the binomial noise of hosts with few documents; ``noise`` is the
    hosts' mean of 1 / documents, so the noise of rates that don't differ is mean (1 - mean) noise. The strength is held
    between 1 and 1e6; a corpus of one host, or of rates that differ by no more than noise, has 1e6.
    """
    own = (var - mean * (1 - mean) * noise) / (1 - noise) if noise < 1 else 0.0
    return mean, min(max(mean * (1 - mean) / own - 1, 1.0), 1e6) if own > 0 else 1e6


def host_verdicts(rows: DataFrame, most: float = 0.5, times: float = 3.0, least: float = 0.1, sure: float = 3.0) -> DataFrame:
    """(host, n_docs, failed, rates, failed_rules): each host's failures by rule, shrunk to the corpus, and the rules it fails.

    The host's rate of a rule has a beta posterior: the prior's mean and strength and the host's own failures. A host fails a
    rule if that rate is over the bar with ``sure`` standard deviations of the posterior to spare. The bar is ``times`` the
    prior's mean, but ``least`` at the least and ``most`` at the most: a host is out if it is far worse than
    the corpus, or bad whatever the corpus is. Three numbers a rule, the moments, come to the driver; hosts themselves
    are never collected.
    """
    n = F.col("n_docs")
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), *(F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()))
    moments = hosts.agg(F.avg(1 / n).alias("noise"), *(f(F.col(r) / n).alias(f"{r}_{f.__name__}") for r in RULES for f in (F.avg, F.var_pop))).first()
    rates, failed = [], []
    for r in RULES:
        mean, strength = prior(moments[f"{r}_avg"] or 0.0, moments[f"{r}_var_pop"] or 0.0, moments["noise"] or 0.0)
        rate = (F.col(r) + mean * strength) / (n + strength)
        spread = F.sqrt(rate * (1 - rate) / (n + strength + 1))
        rates.append(rate.alias(r))
        failed.append(F.when(rate - sure * spread > min(most, max(least, times * mean)), F.lit(r)))
    return hosts.select("host", "n_docs", F.struct(*RULES).alias("failed"), F.struct(*rates).alias("rates"), F.filter(F.array(*failed), lambda x: x.isNotNull()).alias("failed_rules"))


def judge(docs: DataFrame, host: str = "source", salts: int = 16, **bars: float) -> DataFrame:
    """(doc_id, host, counts, n_lines, base_failed, host_rates, host_failed, kept) for every row of ``docs``.

    The rules run over whole texts; base_failed is n_words < 20 or 100 * n_repeat_words >
    30 * n_words. Hosts are judged by all of RULES, with the ``bars`` of ``host_verdicts``; host_failed lists the rules that the host
    fails. A document is kept if it isn't base_failed and its host fails no rule. Null and empty texts
    have no words and fail. Rows with a null host form one host of their own; repeated rows
    count each. An empty table gives an empty one. Extra columns are left out.

    Host counts are partial aggregates, and the join back is salted ``salts`` ways, so a host that
    has a third of all rows meets in no single task.
    """
    rows = cut(measures(docs, host))
    verdicts = host_verdicts(rows, **bars).select(F.col("host").alias("judged"), F.col("rates").alias("host_rates"), F.col("failed_rules").alias("host_failed"))
    verdicts = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = rows.withColumn("own", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    joined = salted.join(verdicts, F.col("host").eqNullSafe(F.col("judged")) & (F.col("own") == F.col("salt")))
    base = F.expr(f"({RULES['short']}) OR ({RULES['repeats']})")
    return joined.select("doc_id", "host", *COUNTS, "n_lines", base.alias("base_failed"), "host_rates", "host_failed", (~base & (F.size("host_failed") == 0)).alias("kept"))


def query(spark, sf_dir):
    found = judge(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "host", F.array_join("host_failed", ",").alias("host_failed"))
