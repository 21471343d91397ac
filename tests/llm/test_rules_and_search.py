"""Shards, licenses, languages, quality rules and decontamination against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import decontam, langid, licenses, quality, shard_tree


def test_shards(spark, docs, texts, tables):
    rows = shard_tree.query(spark, tables(documents=docs)).collect()
    ids = [*range(len(texts)), 20, 20]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((i, len((texts[i] or "").encode()) + 1, zlib.crc32((texts[i] or "").encode())) for i in ids)
    slots, place = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert place.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_and_confined_moves(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    root = shard_tree.tree(16)
    heavy = shard_tree.Node("root", (*root.children[:1], shard_tree.Node("r1", (root.children[1].children[0], shard_tree.Node("k3", tuple(shard_tree.Node(c.name, shard=c.shard, weight=3.0) for c in root.children[1].children[1].children))))))
    rows = ids.select(shard_tree.place(root, ids.doc_id).alias("a"), shard_tree.place(heavy, ids.doc_id).alias("b"), shard_tree.place(shard_tree.grow(root), ids.doc_id).alias("c")).collect()
    n = Counter(r.a for r in rows)
    assert all(1000 < n[s] < 1500 for s in range(16))
    assert all(r.b >= 8 for r in rows if r.a >= 8)  # region 1 grew: nothing leaves it
    assert all(r.b >= 12 for r in rows if r.a >= 12)  # rack 3 grew: nothing leaves it
    n = Counter(r.b for r in rows)
    assert 2.4 < sum(n[s] for s in range(12, 16)) / sum(n[s] for s in range(8, 12)) < 3.6
    assert 1000 < Counter(r.c for r in rows)[16] < 1360


def test_shards_of_odd_tables(odd, none):
    root = shard_tree.tree(16)
    assert shard_tree.shard_rows(none, root, shard_tree.grow(root)).count() == 0
    rows = shard_tree.shard_rows(odd.union(odd), root, shard_tree.grow(root)).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4


def brute_license(text, templates, least):
    def grams(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t))
        return set(zip(w, w[1:]))

    def best(t):
        g, found = grams(t), []
        for name, x in templates:
            x = grams(x)
            if g and x and 2 * len(g & x) / (len(g) + len(x)) >= least:
                found.append((-2 * len(g & x) / (len(g) + len(x)), name))
        return min(found, default=(0.0, None))

    lines = (text or "").split("\n")
    found = [(i, *best(x)) for i, x in enumerate(lines)]
    found = [x for x in found if x[2]]
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    windows = []
    for name, x in templates:
        n, x, top = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower())), grams(x), (0.0, None)
        for i in range(len(words) - n + 1):
            g = set(zip(words[i : i + n], words[i + 1 : i + n]))
            if len(g & x) and (dice := 2 * len(g & x) / (len(g) + len(x))) >= least and dice > top[0]:
                top = (dice, i)
        if top[0]:
            windows.append((top[1], name, top[0]))
    every = [(d, n) for _, d, n in found] + [(-d, n) for _, n, d in windows]
    d, name = min(every + ([best(text)] if len(lines) > 1 and best(text)[1] else []), default=(0.0, None))
    return [(i, n, -d) for i, d, n in found], windows, name, -d + 0.0


def test_licenses(spark, texts):
    more = ["Released under the MIT License.", "licensed under THE apache license version 2.0", "This work\nis licensed under the GNU General Public\nLicense, version 3.", "x\n Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.", "under the MIT License Released"]
    mit = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
    more += [f"{texts[20]}\n\nCopyright (c) 2020 Some One\n\n{mit}\n{texts[20]}", mit.replace(" ", "\n"), mit.lower().replace("software", "program", 3), "Please note: this was released under the MIT License. More follows on this line.", "It is licensed under CC BY 4.0. So it may be used by all who name us."]
    every = [*texts, *more]
    df = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    found = 0
    for r in licenses.scan_licenses(df).collect():
        lines, windows, name, dice = brute_license(every[r.doc_id], licenses.TEMPLATES, 0.8)
        assert ([(x.line, x.license, x.dice) for x in r.licenses.lines], r.licenses.license, r.licenses.dice) == (lines, name, dice)
        assert [(x.word, x.license, x.dice) for x in r.licenses.windows] == windows
        found += bool(name)
        if r.doc_id >= len(every) - 5:
            assert name in ("MIT", "CC-BY-4.0")
    assert found >= 9


def test_licenses_of_odd_tables(odd, none):
    assert licenses.scan_licenses(none).count() == 0
    assert licenses.scan_licenses(odd.withColumnRenamed("n", "licenses")).count() == 2


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.query(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id for r in rows} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


@pytest.fixture(scope="module")
def model(spark):
    rows = [("der hund und die katze", "de"), ("the dog and the cat", "en"), ("собака и кошка", "ru"), (None, "xx"), ("text without a language", None)]
    return langid.fit(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string"), most_rows=100)


def test_scripts_narrow_and_spans_switch(spark, model):
    assert model.langs == ("de", "en", "ru")
    assert not model.uses[0, 2] and model.uses[2].tolist() == [False, False, True]
    texts = ["кошка и собака", "der hund und die katze der hund und die katze", "the dog and the cat " * 5 + "собака и кошка " * 5, "中文", "", None, "12 !?"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.language for r in langid.identify(df, model, penalty=3.0).collect()}
    assert [got[i].lang for i in range(3)] == ["ru", "de", "en"]
    assert [s.lang for s in got[2].spans] == ["en", "ru"] and got[2].spans[0].start == 0
    assert got[3].score == 0.0 and got[3].lang in model.langs
    assert all((got[i].lang, got[i].score, got[i].spans) == ("und", 0.0, []) for i in (4, 5, 6))


def test_viterbi_finds_the_best_path():
    pick = np.random.default_rng(1)
    for _ in range(200):
        n, k, penalty = pick.integers(1, 7), pick.integers(1, 4), 2.0
        s = np.round(pick.normal(0, 2, (n, k)), 3)
        value = lambda p: sum(s[i, p[i]] for i in range(n)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
        best = max(value([int(x // k**i % k) for i in range(n)]) for x in range(k**n))
        assert abs(value(langid.viterbi(s, penalty).tolist()) - best) < 1e-9


def test_batches_label_as_single_texts(model, texts):
    together = langid._texts(texts, model, 12.0)
    assert together == [langid._texts([t], model, 12.0)[0] for t in texts]


def test_languages_of_odd_tables(spark, odd, none, model):
    assert langid.identify(none, model).count() == 0
    empty = langid.fit(none)
    assert [r.language.lang for r in langid.identify(odd, empty).collect()] == ["und", "und"]


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit |= set(range(i, i + 8))
    n, r = len(words), len(hit)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def brute_hosts(docs: list[tuple[str | None, str | None]]) -> dict:
    """The rules that each host fails, from (host, text), in plain Python."""
    hits = defaultdict(lambda: defaultdict(int))
    n = Counter(h for h, _ in docs)
    for host, text in docs:
        words, chars, symbols, dup, repeats, _ = brute_quality(text)
        lines = len([x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
        for rule, hit in (("short", words < 20), ("repeats", 100 * repeats > 30 * words), ("symbols", 10 * symbols > words), ("dup_lines", 100 * dup > 30 * lines), ("word_length", chars < 3 * words)):
            hits[rule][host] += hit
    failed = {h: [] for h in n}
    for rule, by in hits.items():
        raw = [by[h] / n[h] for h in n]
        mean, noise = sum(raw) / len(raw), sum(1 / x for x in n.values()) / len(n)
        own = sum((x - mean) ** 2 for x in raw) / len(raw) - mean * (1 - mean) * noise
        strength = min(max(mean * (1 - mean) / (own / (1 - noise)) - 1, 1), 1e6) if own > 0 and noise < 1 else 1e6
        for h in n:
            a, z = by[h] + mean * strength, n[h] - by[h] + (1 - mean) * strength
            rate = a / (a + z)
            if rate - 3 * (a * z / (a + z) ** 2 / (a + z + 1)) ** 0.5 > min(0.5, max(0.1, 3 * mean)):
                failed[h].append(rule)
    return failed


def test_quality(spark, docs, texts, tables):
    rows = quality.query(spark, tables(documents=docs)).collect()
    hosts = brute_hosts([(r.host, texts[r.doc_id]) for r in rows])
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert tuple(r)[1:7] == brute_quality(texts[r.doc_id])
        assert r.host_failed == ",".join(hosts[r.host])
        assert r.kept == (not r.base_failed and not hosts[r.host])


def test_a_bad_host_takes_its_documents_along(spark):
    prose = lambda k: " ".join(f"word{k}x{i}" for i in range(30))
    bad = {"short": "few words", "symbols": prose(1) + " ####", "lines": "\n".join(["the very same line of text"] * 9 + [prose(2)]), "repeats": " ".join(["one two three four five six seven eight"] * 4), "letters": " ".join("abcdefghijklmnopqrstuvwxyz")}
    rows = [(h, prose(i)) for h in ("a", "b", "c", "d", "e", "f", None) for i in range(100)]
    rows += [(h, t if i % 3 else prose(i)) for h, t in bad.items() for i in range(60)] + [("single", "short")]
    got = quality.judge(spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")).collect()
    hosts = brute_hosts(rows)
    assert [hosts[h] for h in bad] == [["short"], ["symbols"], ["repeats", "dup_lines"], ["repeats"], ["word_length"]] and not hosts["a"] and not hosts[None] and not hosts["single"]
    for r in got:
        assert r.host_failed == hosts[r.host] and r.kept == (not r.base_failed and not hosts[r.host])
    assert any(not r.base_failed and not r.kept for r in got)


def test_rates_that_differ_by_noise_only_fail_no_host(spark):
    assert quality.prior(0.1, 0.1 * 0.9 / 20, 1 / 20)[1] == 1e6
    assert abs(quality.prior(0.2, 0.02, 0.0)[1] - 7) < 1e-9
    assert quality.prior(0.0, 0.0, 1.0) == (0.0, 1e6)


def test_repeated_words_when_codes_collide(monkeypatch):
    words = [b"a", b"b", b"c", b"d", b"e", b"f", b"g", b"h"] * 3 + [b"x"]
    other = [bytes([i]) for i in range(65, 91)]
    assert quality.repeated_words(words) == 24 and quality.repeated_words(other) == 0
    monkeypatch.setattr(quality, "_codes", lambda ids, width: np.zeros(len(ids) - width + 1, np.uint64))
    assert quality.repeated_words(words) == 24 and quality.repeated_words(other) == 0
    assert quality.repeated_words(words[:8]) == quality.repeated_words([]) == 0


def test_quality_of_odd_tables(odd, none):
    assert quality.judge(none).count() == 0
    assert quality.judge(odd.withColumnRenamed("fp", "source")).count() == 2


def brute_contamination(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        p = words(t)
        m = min(10, len(p))
        windows = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)} if m else ()
        for i in range(len(w) - m + 1) if m else ():
            if tuple(w[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                found.add(item)
    names = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [32_000_000, 200])
def test_contamination(spark, docs, texts, tables, block_bytes):
    long = [t for t in texts if t and len(t.split()) > 60]
    items = [(1, " ".join(long[0].split()[20:45])), (2, " ".join(long[3].split()[:10]).upper()), (10, "niño"), (11, None), (12, "..."), (13, "Two words!"), (14, " ".join(long[0].split()[20:45])), (15, "nothing like this is anywhere at all in here you see now"), (16, "was in")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    d = tables(documents=docs, benchmark=benchmark)
    want = {i: brute_contamination(t, items) for i, t in enumerate(texts)}
    if block_bytes > 1000:
        rows = decontam.query(spark, d).collect()
        assert len(rows) == len(texts) + 2
        for r in rows:
            assert tuple(r)[1:] == want[r.doc_id]
        assert any(r.contaminated for r in rows) and not all(r.contaminated for r in rows)
    else:
        for r in decontam.find_contamination(docs, benchmark, block_bytes=block_bytes).collect():
            c = r.contamination
            assert (c.n_words, sum(s.end - s.start for s in c.spans), len(c["items"])) == want[r.doc_id][:3]


@pytest.mark.parametrize("block_bytes", [32_000_000, 20])
def test_items_without_an_id_hit_too(spark, tables, block_bytes):
    duckdb = pytest.importorskip("duckdb")
    docs = spark.createDataFrame([(1, "x Some text here y"), (2, "other words, some text here"), (3, "clean"), (4, "Other words")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, "some text here"), (5, "other words"), (None, "text here")], "item_id long, text string").coalesce(1)
    found = {r.doc_id: r.contamination for r in decontam.find_contamination(docs, benchmark, block_bytes=block_bytes).collect()}
    assert {i: (sum(s.end - s.start for s in c.spans), c["items"], c.n_items) for i, c in found.items()} == {1: (3, [], 1), 2: (5, [5], 2), 3: (0, [], 0), 4: (2, [5], 1)}
    assert [r.doc_id for r in decontam.stage(docs, benchmark).collect()] == [3]
    d = tables(documents=docs, benchmark=benchmark)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet/*.parquet'")
    assert sorted(map(tuple, decontam.query(spark, d).collect())) == sorted(con.execute(decontam.SQL).fetchall())


def test_contamination_of_odd_tables(spark, odd, none):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.stage(none, nothing).count() == 0
    assert decontam.stage(odd, nothing).count() == 2
    item = spark.createDataFrame([(1, "some text here")], "item_id long, text string")
    assert [r.doc_id for r in decontam.stage(odd, item).collect()] == [7]
