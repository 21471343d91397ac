"""Texts beyond what any operator treats at once, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from test_brute_force import Brute

from quarry.llm import decontam, langid, licenses, line_dedup, quality, simhash


@pytest.fixture(scope="module")
def words():
    pick = random.Random(4)
    vocabulary = ["".join(pick.choice("abcdefghijklmnop") for _ in range(pick.randint(2, 8))) for _ in range(3000)]
    return [pick.choice(vocabulary) for _ in range(150_000)]


def test_fingerprint(words):
    text = " ".join(words)
    h = np.array([xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(len(words) - 2)], np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))
    assert len(h) > simhash._CHUNK and simhash.fingerprint(text) == want


def test_language(spark):
    rows = [("the dog and the cat ran over the old bridge to the sea", "en"), ("der hund und die katze liefen über die alte brücke an das meer", "de")]
    model = langid.fit(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string"))
    text = "the cat and the bridge " * 15_000 + "die katze und die brücke " * 12_000
    assert len(text) > langid._BLOCK
    lang, score, spans = langid._texts([text, "die katze", text], model, 12.0)[2]
    want = Brute(rows).predict(text)
    assert (lang, [s[2] for s in spans]) == (want[0], ["en", "de"]) and abs(score - want[1]) < 1e-6


def test_quality(words):
    text = "\n".join(" ".join(words[i : i + 11]) for i in range(0, len(words), 11)) + "\n" + " ".join(words[:300]) + " ##"
    n, chars, symbols, dup, repeats, lines = quality.measure(text)
    assert (n, symbols, dup, lines) == (len(words) + 301, 2, 0, -(-len(words) // 11) + 1)
    assert chars == sum(map(len, words)) + sum(map(len, words[:300])) + 2 and repeats == 600


def test_contamination(words):
    item = " ".join(words[140_000:140_025])
    patterns = decontam.Patterns([(1, item), (2, "no such words here")], 10)
    (n, spans, items), (_, none, _) = decontam.scan([" ".join(words), "x"], patterns)
    assert n == len(words) and (140_000, 140_025) in spans and items == {1} and not none


def test_license(words):
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    found = licenses.scan_text(" ".join(words) + "\n" + mit.replace(" ", "\n", 40) + " " + " ".join(words[:50]), licenses.Templates(licenses.TEMPLATES, 0.8))
    assert (found["license"], found["dice"]) == ("MIT", 1.0) and found["windows"][-1]["word"] == len(words)


def test_lines(spark, words):
    lines = [" ".join(words[i : i + 5]) + f" is line {i} of the text" for i in range(0, len(words), 5)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, lines[3] + "\n" + lines[-1]), (3, lines[-1] + "\n" + lines[3])], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got[1].text == "\n".join(x for x in lines if x not in (lines[3], lines[-1])) and got[1].line_report.n_dropped == 2
    assert got[2].text == "" and got[3].text == lines[-1] + "\n" + lines[3]
