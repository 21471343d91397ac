"""Encoding, decoding and token counts against the libraries themselves."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import byte_bpe, token_counts

PATH = public_tokenizers.path(byte_bpe.RANK_FILE)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def test_encoding_is_the_librarys_and_decoding_gives_the_text_back(spark, docs, texts, tables, library):
    rows = byte_bpe.query(spark, tables(documents=docs)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))


def test_a_small_memory_changes_nothing(docs):
    a, b = (sorted((r.doc_id, bytes(r.tokens)) for r in byte_bpe.encode(docs, PATH, remembered=n).collect()) for n in (1, 10**6))
    assert a == b


def test_the_long_fold_is_the_short_one(library):
    ranks = byte_bpe.read_ranks(PATH)
    for word in (b"abab" * 40, b"a" * 3000, "straße".encode() * 30, bytes(range(256))):
        assert byte_bpe._fold_long(word, ranks) == byte_bpe.fold(word, ranks)
        if word.isascii() and word.isalpha():
            assert byte_bpe.fold(word, ranks) == library.encode_ordinary(word.decode())


def test_letters_newer_than_the_librarys_tables(library):
    newer = byte_bpe.newer_letters()
    split, ranks = byte_bpe.Splitter(public_tokenizers.PATTERN, newer), byte_bpe.read_ranks(PATH)
    for c in [*newer[:50], "é", "中", " ", "\x85", "ǆ"]:
        text = f"x{c}'s {c}1{c}  {c}\n"
        assert [i for w in split.findall(text) for i in byte_bpe.fold(w.encode(), ranks)] == library.encode_ordinary(text)


def test_higher_order_functions_fold_alike(spark):
    words = [b"", b"a", b" thntblere", b" the", "niño".encode(), b"'s", bytes([255, 254, 0]), b"aaaaaaaaa", b" unhappiness", b"ab" * 127, bytes(range(255))]
    ranks = byte_bpe.read_ranks(PATH)
    df = byte_bpe.fold_words(spark.createDataFrame([(w,) for w in [*words, None]], "word binary"), PATH)
    for r in df.collect():
        assert r.ids == (None if r.word is None else byte_bpe.fold(bytes(r.word), ranks) if r.word else [])


def test_decode_keeps_nulls_and_other_columns(spark):
    df = spark.createDataFrame([(1, bytes([72, 0, 0, 0]), "x"), (2, None, "y")], "doc_id long, tokens binary, decoded string")
    rows = {r.doc_id: r.decoded for r in byte_bpe.decode(df, PATH).collect()}
    assert rows[2] is None and len(rows[1]) == 1


def test_counts_are_the_librarys(spark, docs, texts, tables):
    tok = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    got = Counter(tuple(r) for r in token_counts.query(spark, tables(documents=docs)).collect())
    want = Counter()
    for i in [*range(len(texts)), 20, 20]:
        t = texts[i] or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        want[(i, len(t.encode()), n, n > 2048)] += 1
    assert got == want


def test_posting_blocks_round_trip():
    words, ends, docs, counts = [b"a", b"", "é".encode()], np.array([2, 3, 4]), np.array([0, 2, 70_000, 0]), np.array([1, 2, 300, 4])
    w, gaps, d, c = token_counts._unpack(token_counts._pack(words, ends, docs, counts))
    assert (w, gaps.tolist(), d.tolist(), c.tolist()) == (words, [2, 1, 1], docs.tolist(), counts.tolist())


@pytest.mark.parametrize("block", [1, 500])
def test_counts_do_not_depend_on_batches(docs, block):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    want = Counter(tuple(r) for r in token_counts.count_tokens(docs, path).collect())
    assert Counter(tuple(r) for r in token_counts.count_tokens(docs.repartition(7), path, block_bytes=block).collect()) == want


def test_empty_and_odd_tables(odd, none):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    assert byte_bpe.digest(none, PATH).count() == token_counts.count_tokens(none, path).count() == 0
    assert byte_bpe.encode(odd, PATH).columns == [*odd.columns, "tokens"]
    assert {(r.doc_id, r.n_bytes) for r in token_counts.count_tokens(odd, path).collect()} == {(None, 31), (7, 0)}


def test_a_block_of_other_documents_is_an_error(spark, docs):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    definition = open(path, encoding="utf-8").read()
    blocks = token_counts.summed(token_counts.postings(docs.select("doc_id", "text"), definition, 4, 500), definition)
    assert token_counts.gathered(blocks).count() == docs.count()
    other = blocks.withColumn("digest", F.when(F.col("bucket") == 2, F.col("digest") + 1).otherwise(F.col("digest")))
    with pytest.raises(Exception, match="other documents"):
        token_counts.gathered(other).count()
    with pytest.raises(Exception, match="lacks"):
        token_counts.gathered(blocks.where("bucket != 2")).count()


def test_buckets_grow_with_the_root_of_the_input(spark, tables, docs):
    known = spark.read.parquet(tables(documents=docs) + "/documents.parquet")
    assert token_counts.dealing(known) == (8, 2_000_000)
    assert token_counts.dealing(spark.range(10).rdd.toDF("doc_id long"))[0] == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_texts_longer_than_a_batch(spark, texts, library):
    """One word of 300 thousand letters, and 400 thousand words: beyond what any step treats at once."""
    long = "x" * 300_000 + " " + " ".join(f"w{i} the é" for i in range(130_000))
    got = byte_bpe.digest(spark.createDataFrame([(1, long), (2, "x")], "doc_id long, text string"), PATH, remembered=1000).collect()
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in got}[1] == (len(library.encode_ordinary(long)), sha(long.encode()))
    tok = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    counted = token_counts.count_tokens(spark.createDataFrame([(1, long[300_000:])], "doc_id long, text string"), public_tokenizers.path(token_counts.VOCABULARY), buckets=3, block_bytes=1000).first()
    assert counted.n_tokens == len(tok.encode(long[300_000:], add_special_tokens=False).ids)


def test_rank_map_is_short_and_exact():
    """The literal stands in plans and event logs on the driver many times over; pair 0 may be none, and its cell must say so."""
    import random

    from quarry.llm import byte_bpe

    ranks = byte_bpe.read_ranks(byte_bpe.public_tokenizers.path(byte_bpe.RANK_FILE))
    first = next(p for p, r in ranks.items() if r == 0)
    for some in (ranks, {p: r for p, r in ranks.items() if p != first * 2}):
        known = byte_bpe.RankMap.of(some)
        assert len(",".join(map(str, known.cells))) < 2_000_000
        pairs = {some[p[:i]] << 16 | some[p[i:]]: r for p, r in some.items() for i in range(1, len(p)) if p[:i] in some and p[i:] in some}
        rng = random.Random(1)
        for k in [0, *pairs, *(rng.getrandbits(32) for _ in range(100_000))]:
            cell = known.cells[k * known.FACTOR % known.CELLS + known.shift[k % known.BUCKETS]]
            assert min(known.NONE, cell ^ k << 20) == pairs.get(k, known.NONE)
