"""Language ID: scripts narrow the candidates, then Viterbi over word scores labels spans."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.tables import give_back, named, numbered, table, unused

#: Scripts by ranges of code points, both ends included; letters elsewhere are one further script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
BUCKETS = 1 << 16
_BLOCK = 1 << 19
_IMPOSSIBLE = np.float32(-50.0)


class _Chars:
    """For each code point: whether it is a letter, and its script."""

    def __init__(self):
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.script = np.full(0x110000, len(SCRIPTS), np.uint8)
        for k, ranges in enumerate(SCRIPTS.values()):
            for a, b in ranges:
                self.script[a : b + 1] = k


_chars: list[_Chars] = []


def chars() -> _Chars:
    if not _chars:
        _chars.append(_Chars())
    return _chars[0]


@dataclass(frozen=True)
class Words:
    """Words of several texts laid end to end: places in code points, and trigrams of their letters."""

    gram: np.ndarray  # bucket of the trigram around each letter
    first: np.ndarray  # index in gram of each word's first letter
    script: np.ndarray  # of each word's first letter
    start: np.ndarray  # code point where each word starts
    letters: np.ndarray  # of each word


def words_of(text: str) -> Words:
    """Words are maximal runs of letters. A trigram is a letter with both neighbours, a word's end being a blank."""
    low = text.lower()
    if len(low) != len(text):  # a few letters lower to two: keep the places of the text itself
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = chars().letter[c]
    x = np.zeros(len(c) + 2, np.uint32)
    x[1:-1] = np.where(is_letter, c, 0)
    at = np.flatnonzero(is_letter)
    gram = x[at] * np.uint32(2654435761) + x[at + 1] * np.uint32(2246822519) + x[at + 2] * np.uint32(3266489917)
    gram = ((gram ^ (gram >> np.uint32(15))) * np.uint32(668265263)) >> np.uint32(16)
    first = np.flatnonzero(x[at] == 0)
    return Words(gram, first, chars().script[c[at[first]]], at[first], np.diff(np.r_[first, len(at)]))


@dataclass(frozen=True)
class Model:
    """What the labelled sample gave: languages, log probabilities of trigrams, and the scripts each language uses."""

    langs: tuple[str, ...]
    log_p: np.ndarray  # buckets x languages
    uses: np.ndarray  # scripts x languages, boolean


def fit(docs: DataFrame, most_rows: int = 4000, smooth: float = 0.5, script_share: float = 0.01) -> Model:
    """Learn from a bounded sample: at most ``most_rows`` labelled rows, those of least hash of doc_id.

    Learned are only rows with a language and a text; equal rows are one, so the bound holds however often a row is repeated (only
    different texts under the very last doc_id may exceed it). The sample is found by ids
    alone; its texts are counted on the executors, and what comes to the driver is
    one count for each language, script and trigram bucket. Without any labelled row the model
    has no languages.
    """
    labelled = docs.select("text", "lang", F.xxhash64("doc_id").alias("h")).where("lang IS NOT NULL AND text IS NOT NULL")
    last = labelled.select("h").orderBy("h").limit(most_rows).agg(F.max("h").alias("h")).first().h
    if last is None:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 1, 0), bool))

    def count(batches):
        grams: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + len(SCRIPTS) + 1, np.int64))
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text)
                grams[lang][:BUCKETS] += np.bincount(w.gram, minlength=BUCKETS)
                grams[lang][BUCKETS:] += np.bincount(w.script, weights=w.letters, minlength=len(SCRIPTS) + 1).astype(np.int64)
        for lang, n in grams.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])

    sample = labelled.where(F.col("h") <= last).dropDuplicates(["h", "text"]).select("text", "lang")
    counts = sample.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = tuple(sorted(counts["lang"].unique()))
    n = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(langs)))
    n[counts["bucket"].to_numpy(), [langs.index(x) for x in counts["lang"]]] = counts["n"].to_numpy()
    grams, scripts = n[:BUCKETS], n[BUCKETS:]
    log_p = np.log((grams + smooth) / (grams.sum(0) + smooth * BUCKETS))
    return Model(langs, log_p.astype(np.float32), scripts >= np.maximum(script_share * scripts.sum(0), 1))


def word_scores(w: Words, model: Model) -> np.ndarray:
    """Log probability of each word in each language, against the word's best; a language that doesn't use
    the word's script is no candidate, and a script that no language uses tells nothing."""
    s = np.add.reduceat(model.log_p[w.gram], w.first, axis=0)
    uses = model.uses[w.script]
    known = uses.any(1)
    s -= np.where(known, np.where(uses, s, -np.inf).max(1, initial=-np.inf), 0)[:, None]
    s[known] = np.where(uses[known], s[known], _IMPOSSIBLE * 2)
    s[~known] = 0
    return np.maximum(s, _IMPOSSIBLE * 2)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best labels of a row of words, each switch of language costing ``penalty``.

    The language of the best sum is best throughout if no other gains over half of ``penalty``
    on any stretch of words: k stretches then gain at most k/2 penalties, and take at least k
    switches, or k - 1 where they cover all words, which for k = 1 gain nothing. That is
    tested first, on running sums; only texts that fail it are walked word by word.
    """
    n, k = scores.shape
    main = int(scores.sum(0).argmax())
    gain = np.cumsum(scores.astype(np.float64) - scores[:, main : main + 1], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain[:-1]]), axis=0)
    if (gain - low).max() <= penalty / 2:
        return np.full(n, main, np.int64)
    value, back, rows = scores[0].astype(float).tolist(), [], scores.tolist()
    for row in rows[1:]:
        best = max(value)
        top, floor = value.index(best), best - penalty
        back.append([i if v >= floor else top for i, v in enumerate(value)])
        value = [(v if v >= floor else floor) + r for v, r in zip(value, row)]
    label = value.index(max(value))
    path = [label]
    for step in reversed(back):
        label = step[label]
        path.append(label)
    return np.array(path[::-1], np.int64)


def label_text(w: Words, scores: np.ndarray, model: Model, penalty: float) -> tuple[str, float, list[tuple[int, int, str]]]:
    """The language of most letters, the share of letters it has (letters of an unknown script belong to none), and the spans."""
    path = viterbi(scores, penalty)
    known = model.uses[w.script].any(1)
    mass = np.bincount(path, weights=w.letters * known, minlength=len(model.langs))
    lang = int(mass.argmax())
    cut = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
    last = np.r_[cut[1:], len(path)] - 1
    spans = [(int(w.start[a]), int(w.start[b] + w.letters[b]), model.langs[path[a]]) for a, b in zip(cut, last)]
    return model.langs[lang], float(min(1.0, mass[lang] / w.letters.sum())), spans


def _texts(texts: list[str | None], model: Model, penalty: float):
    """Predictions for texts, several short ones at a time."""
    out: list[tuple[str, float, list]] = [("und", 0.0, [])] * len(texts)
    if not model.langs:
        return out
    block: list[int] = []
    size = 0

    def flush():
        joined = "\n".join(texts[i] for i in block)
        w = words_of(joined)
        if not len(w.first):
            return
        scores = word_scores(w, model)
        ends = np.cumsum([len(texts[i]) + 1 for i in block])
        upto = np.searchsorted(w.start, ends)
        a = 0
        for i, end, b in zip(block, ends.tolist(), upto.tolist()):
            if b > a:
                one = Words(w.gram, w.first[a:b], w.script[a:b], w.start[a:b] - (end - len(texts[i]) - 1), w.letters[a:b])
                out[i] = label_text(one, scores[a:b], model, penalty)
            a = b

    for i, t in enumerate(texts):
        if t:
            block.append(i)
            size += len(t)
            if size >= _BLOCK:
                flush()
                block, size = [], 0
    if block:
        flush()
    return out


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(docs: DataFrame, model: Model, penalty: float = 12.0, column: str = "language") -> DataFrame:
    """Return ``docs`` with a struct ``column`` (lang, score, spans), predicted from the text alone.

    Spans are places in code points of the text, each from the first to the last word of a
    run of one label. ``lang`` has most letters, and ``score`` is its share of them. A text
    that is null or has no letters is ``und`` with score 0 and no spans, and so is every text
    if the model has no languages; letters of a script that no learned language uses keep the
    neighbouring label and lower the score. Ties go to the language first in order. Repeated
    rows are labelled alike; an empty table gives an empty one. Extra columns pass through;
    one named ``column`` is replaced. One narrow pass; the model's size is fixed by the number
    of languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(column)
    at = docs.columns.index("text")
    kind = T.StructType.fromDDL(f"lang string, score double, spans {SPANS}")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, kind)])
    arrow = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))])

    def run(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                b = whole.slice(a, 1000)
                found = _texts(b.column(at).to_pylist(), shared.value, penalty)
                rows = [{"lang": x, "score": s, "spans": [{"start": p, "end": q, "lang": y} for p, q, y in spans]} for x, s, spans in found]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, arrow)], names=schema.names)
        give_back()

    return numbered(docs).mapInArrow(run, schema)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def stage(docs: DataFrame, min_score: float = 0.25) -> DataFrame:
    """The pipeline's stage: documents whose language is known and has ``min_score`` of their letters.

    Null texts and texts without letters go; repeated rows share their fate; an empty table stays empty; extra columns pass through,
    whatever their names. The model is learned from the rows outside the held-out quarter that have a language.
    """
    column = unused(docs.columns, "language")
    found = identify(docs, fit(docs.where(~F.coalesce(held_out(), F.lit(False)))), column=column)
    language = named(column)
    return found.where((language["lang"] != "und") & (language["score"] >= min_score)).select(*map(named, docs.columns))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~F.coalesce(held_out(), F.lit(False))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"), F.size("language.spans").cast("long").alias("n_spans"))
