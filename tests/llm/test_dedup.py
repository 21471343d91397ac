"""Repeated strings, lines and near copies against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from quarry.llm import line_dedup, simhash, suffix_dedup
from quarry.operators.components import connected_components


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def brute_windows(texts: list[bytes], span: int) -> list[np.ndarray]:
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = True
        out.append(gone)
    return out


def as_row(doc_id, text: bytes, gone: np.ndarray):
    edges = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
    return doc_id, len(text), int(gone.sum()), edges, sha(np.frombuffer(text, np.uint8)[~gone].tobytes())


def test_repeats_of_200_bytes(spark, docs, texts, tables):
    rows = suffix_dedup.query(spark, tables(documents=docs)).collect()
    ids = [*range(len(texts)), 20, 20]
    raw = [(texts[i] or "").encode() for i in ids]
    want = Counter(as_row(i, t, g) for i, t, g in zip(ids, raw, brute_windows(raw, 200)))
    assert Counter(tuple(r) for r in rows) == want
    assert any(r.n_removed for r in rows) and any(not r.n_removed for r in rows)


@pytest.mark.parametrize("held", [300, 1 << 25])
def test_few_letters_and_files(spark, held):
    pick = random.Random(5)
    base = bytes(pick.choice(b"ab") for _ in range(300))
    texts = [base[a : a + pick.randint(1, 200)] + bytes(pick.choice(b"abc") for _ in range(pick.randint(0, 50))) for a in (pick.randrange(250) for _ in range(40))]
    texts += [b"a" * 700, b"b" * 39, b"b" * 40]
    df = spark.createDataFrame(list(enumerate(t.decode() for t in texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_removed, sha(bytes(r.kept))) for r in suffix_dedup.remove_repeats(df, span=40, held=held).collect()}
    for i, (t, g) in enumerate(zip(texts, brute_windows(texts, 40))):
        assert got[i] == (int(g.sum()), as_row(i, t, g)[-1]), i


def test_repeats_within_one_stretch(spark):
    pick = random.Random(9)
    noise = lambda n: bytes(pick.choice(b"abcdefghijklmnop ") for _ in range(n))
    sentence = noise(100)
    texts = [b"a" * 200, b"b" * 201, b"c" * 300, b"d" * 455, noise(500) + b"-" * 300 + noise(500), sentence * 4, noise(90) + noise(153) * 3, noise(40) * 9 + noise(700), noise(3000)]
    df = spark.createDataFrame(list(enumerate(t.decode() for t in texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_removed, len(r.spans), sha(bytes(r.kept))) for r in suffix_dedup.remove_repeats(df).collect()}
    want = {i: as_row(i, t, g)[2:] for i, (t, g) in enumerate(zip(texts, brute_windows(texts, 200)))}
    assert got == want and [got[i][0] for i in (0, 1, 2, 5)] == [0, 201, 300, 400]


def test_spans_and_kept_bytes_make_up_the_text(docs, texts):
    for r in suffix_dedup.remove_repeats(docs).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert sum(s.end - s.start for s in r.spans) == r.n_removed == len(raw) - len(r.kept)


def brute_lines(rows):
    blanks = " \t\n\x0b\x0c\r"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(blanks))
    found = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                found[k].append(i)
    drop = {k: max(v) for k, v in found.items() if len(v) >= 3}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if drop.get(key(x), i) == i]
        out[i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())] += 1
    return out


def test_lines(spark, docs, texts, tables):
    rows = line_dedup.query(spark, tables(documents=docs)).collect()
    want = brute_lines([(i, texts[i]) for i in [*range(len(texts)), 20, 20]])
    assert Counter(tuple(r) for r in rows) == want
    assert sum(r.n_dropped for r in rows)


def test_line_operator_keeps_columns_and_order(docs, odd, none):
    assert line_dedup.stage(docs).columns == docs.columns
    assert line_dedup.stage(none).count() == 0
    rows = {r.doc_id: r for r in line_dedup.stage(odd).collect()}
    assert rows[None].key == 1 and rows[7].text == ""


def brute_groups(rows):
    def fp(t):
        w = [x.lower() for x in (t or "").encode().split()]
        s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return Counter((d, f"{fps[i]:016x}", min(least[root(i)])) for i, (d, _) in enumerate(rows))


def test_near_copies(spark, docs, texts, tables):
    rows = simhash.query(spark, tables(documents=docs)).collect()
    assert Counter(tuple(r) for r in rows) == brute_groups([(i, texts[i]) for i in [*range(len(texts)), 20, 20]])
    assert sum(r.doc_id != r.component_id for r in rows) > 4


@pytest.mark.parametrize("most", [3, 4096])
def test_links_connect_all_within_three_bits(spark, most):
    pick = random.Random(2)
    fps = {0}
    for _ in range(12):
        x = pick.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in pick.sample(range(64), pick.randint(1, 4)):
                x ^= 1 << b
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), most=most).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() >= 1 for r in links)

    def classes(pairs):
        parent = {x: x for x in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = defaultdict(set)
        for x in signed:
            groups[root(x)].add(x)
        return sorted(map(sorted, groups.values()))

    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if (fps[i] ^ (b & (1 << 64) - 1)).bit_count() <= 3]
    assert classes([(r.a, r.b) for r in links]) == classes(near)


def test_one_of_each_group_stays(docs, odd, none):
    groups = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    kept = [r.doc_id for r in simhash.stage(docs).collect()]
    assert sorted(kept) == sorted({g for _, _, g in groups})
    assert simhash.stage(docs).columns == docs.columns
    assert simhash.stage(none).count() == 0
    assert simhash.stage(odd).count() == 2


def test_documents_are_told_apart_by_their_text_too(spark):
    pick = random.Random(4)
    prose = lambda: " ".join("".join(pick.choice("abcdefghij") for _ in range(5)) for _ in range(80))
    a, b, c, d, e = (prose() for _ in range(5))
    rows = [(1, a), (5, a), (5, b), (None, b), (None, c), (None, c), (7, d), (7, d + " "), (8, d), (None, e), (None, e + " ")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long").repartition(3)
    kept = [(r.doc_id, r.text.strip()) for r in simhash.stage(df).collect()]
    assert Counter(kept) == Counter([(1, a), (5, b), (None, c), (7, d), (None, e)])


def test_components(spark, none):
    pairs = [(5, 4), (4, 3), (3, 2), (9, 8), (8, 9), (7, 7), (None, 1), (20, 3), (21, 20), (22, 21), (23, 22), (24, 23)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    assert got == {(n, 2) for n in (2, 3, 4, 5, 20, 21, 22, 23, 24)} | {(8, 8), (9, 8)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_empty_tables(none):
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert simhash.near_groups(none).count() == 0


def test_words_part_at_ascii_blanks_only():
    text = "a\x0bb\x1cc\x85d e f"
    assert text.encode().split() == [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", text)]


def test_stages_leave_columns_of_any_name_alone(clashing):
    def others(rows):
        return {tuple(v for c, v in r.asDict().items() if c != "text") for r in rows}

    before = clashing.collect()
    lines = line_dedup.stage(clashing)
    assert lines.columns == clashing.columns and others(lines.collect()) == others(before)
    assert sorted(len(r.text.split("\n")) for r in lines.collect()) == [1, 1, 2]
    near = simhash.stage(clashing)
    assert near.columns == clashing.columns and others(near.collect()) == others([before[0], before[2]])


def brute_weighted(blocks, weights, span):
    seen = Counter()
    for b, w in zip(blocks, weights):
        for i in range(len(b) - span + 1):
            seen[b[i : i + span]] += w
    return [[i for i in range(len(b) - span + 1) if seen[b[i : i + span]] > 1] for b in blocks]


@pytest.mark.parametrize("chunk", [3, 50, 1 << 18])
def test_the_order_passes_through_files_in_chunks(chunk):
    pick = random.Random(5)
    blocks = list({bytes(pick.choice(b"ab") for _ in range(pick.randint(40, 90))) for _ in range(12)})
    blocks += [blocks[0][:45] + blocks[1][3:50], b"a" * 70, blocks[2][10:] + b"c"]
    weights = [1] * len(blocks)
    weights[4] = 2
    for span in (40, 10):
        runs = suffix_dedup.repeated_windows(blocks, weights, span, suffix_dedup.Scratch(chunk))
        got = [[i for a, z in r.tolist() for i in range(a, z + 1)] for r in runs]
        assert got == brute_weighted(blocks, weights, span)


def test_symbols_are_equal_where_the_bytes_are(monkeypatch):
    data = np.frombuffer(b"abcabcabdabcabcabd" * 3, np.uint8)
    for wide in (1, 2, 7, 8, 10, 16, 40):
        got = suffix_dedup.symbols(data, wide)
        text = data.tobytes()
        names = [text[i : i + wide] for i in range(len(text) - wide + 1)]
        assert [got[i] == got[j] for i in range(len(names)) for j in range(len(names))] == [a == b for a in names for b in names]


def test_repeats_in_texts_over_a_segment(spark):
    """A text of 3 MiB, a passage that crosses the edge of a segment, and one that only another document has."""
    pick = random.Random(9)
    noise = lambda n: "".join(pick.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage, other = noise(500), noise(300)
    long = noise((1 << 20) - 250) + passage + noise((1 << 20) + 77) + passage + noise(1 << 20) + other
    texts = [long, noise(400) + other + noise(50), noise(1000)]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert bytes(got[0].kept).decode() == long.replace(passage, "").replace(other, "")
    assert bytes(got[1].kept).decode() == texts[1].replace(other, "") and bytes(got[2].kept).decode() == texts[2]
    assert [s.end - s.start for s in got[0].spans] == [500, 500, 300]


def test_many_equal_rows_are_no_slower_than_copies(spark):
    pick = random.Random(2)
    text = "".join(pick.choice("abcdefgh ") for _ in range(2100))
    took = []
    for ids in (range(3000), [7] * 3000):
        start = time.perf_counter()
        rows = suffix_dedup.remove_repeats(spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")).select("n_removed").collect()
        took.append(time.perf_counter() - start)
        assert {r.n_removed for r in rows} == {2100} and len(rows) == 3000
    assert took[1] < 3 * took[0] + 5


def test_repeats_of_odd_tables(odd, none, clashing):
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert {(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(odd.union(odd)).collect()} == {(None, 31, 0), (7, 0, 0)}
    got = {r.doc_id: (r.n_removed, r.n_bytes) for r in suffix_dedup.remove_repeats(clashing, span=40).collect()}
    assert got[0][0] == got[0][1] == got[1][0] and got[2][0] == 46
