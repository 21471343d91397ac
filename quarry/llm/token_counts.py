"""Token counts: pieces counted once a distinct pre-token, joined to each document's pre-token frequencies, and summed."""

from __future__ import annotations

import os
import zlib
from math import isqrt

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from quarry.llm.tables import latin_pattern, named, table, utf8

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: The split pattern of the vocabulary file; white space is listed as the library's engine has it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def load(definition: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_str(definition)


class PreTokens:
    """Cuts texts into special strings and pre-tokens, as the vocabulary's tokenizer does before it merges."""

    def __init__(self, definition: str):
        tok = load(definition)
        special = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=lambda x: (-len(x), x))
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.normalize = tok.normalizer.normalize_str if tok.normalizer else str
        self.split = latin_pattern(_SPLIT, _SPACE)
        self.library = tok.pre_tokenizer.pre_tokenize_str

    def _cut(self, text: str) -> list[str]:
        """By the pattern where all is Latin-1; elsewhere by the library, whose Unicode tables may be older or newer."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [text[a:b] for _, (a, b) in self.library(text)]
        return self.split.findall(text)

    def of(self, text: str | None) -> tuple[int, list[str]]:
        """The number of special strings, and the pre-tokens in order."""
        if not text:
            return 0, []
        parts = self.special.split(text) if self.special else [text]
        words: list[str] = []
        for p in parts:
            if p:
                words += self._cut(self.normalize(p))
        return len(parts) - 1, words


class Pieces:
    """Counts the pieces of pre-tokens, each once while it is remembered."""

    def __init__(self, definition: str, most: int = 200_000):
        from tokenizers import pre_tokenizers

        self.tok = load(definition)
        self.tok.normalizer = None  # pre-tokens are normalised already
        self.tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.most, self.seen = most, {}

    def of(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self.seen))
        if len(self.seen) + len(new) > self.most:
            self.seen.clear()
            new = list(set(words))
        for a in range(0, len(new), 4096):
            part = new[a : a + 4096]
            self.seen.update(zip(part, (len(x) for x in self.tok.encode_batch_fast(part, add_special_tokens=False))))
        return np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as they need, after that width and their number."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return np.array([width, len(values)], "<u4").tobytes() + values.astype(f"<u{width}").tobytes()


def _wide(blob: bytes, at: int) -> tuple[np.ndarray, int]:
    width, n = np.frombuffer(blob, "<u4", 2, at).tolist()
    return np.frombuffer(blob, f"<u{width}", n, at + 8).astype(np.int64), at + 8 + width * n


def _pack(words: list[bytes], ends: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> bytes:
    """A posting block: distinct pre-tokens, and for each the documents (by place in their batch) that have it and how often."""
    gaps = np.diff(ends, prepend=0)
    return b"".join([_narrow(np.array([len(w) for w in words], np.int64)), _narrow(gaps), _narrow(docs), _narrow(counts), *words])


def _unpack(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    lengths, at = _wide(blob, 0)
    gaps, at = _wide(blob, at)
    docs, at = _wide(blob, at)
    counts, at = _wide(blob, at)
    stops = np.cumsum(lengths) + at
    return [blob[a:b] for a, b in zip((stops - lengths).tolist(), stops.tolist())], gaps, docs, counts


BLOCK = "batch long, bucket int, digest long, block binary"
_NAMES = ["batch", "bucket", "digest", "block"]


def postings(docs: DataFrame, definition: str, buckets: int, block_bytes: int) -> DataFrame:
    """(batch, bucket, digest, block) from (doc_id, text): pre-token frequencies, inverted some documents at a time and dealt by pre-token.

    A block lists each pre-token once with the documents that have it, so what is shuffled
    is a few bytes for each document and distinct pre-token. Its size is bounded by the texts
    of one batch; a pre-token that every document has adds no more than one list to each.
    Bucket -1 holds a batch's documents (doc_id, whether it is null, bytes) and its number of blocks. ``digest`` is a
    hash of these documents: a block knows them by place alone, so blocks and documents must be of one and the same batch.
    """

    def run(batches):
        cut, base, nth = PreTokens(definition), TaskContext.get().partitionId() << 32, 0
        for b in batches:
            sizes, held, start, number, posts = [], 0, 0, {}, []
            for i, t in enumerate(b.column(1)):
                t = t.as_py()
                special, words = cut.of(t)
                d = len(sizes)
                found, n = np.unique(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)), return_counts=True)
                posts.append((found, np.full(len(found), d), n))
                if special:  # each special string is one token: a pre-token of no text stands for it
                    posts.append((np.array([number.setdefault("", len(number))]), np.array([d]), np.array([special])))
                sizes.append(len(utf8(t)))
                held += sizes[-1]
                if held >= block_bytes or d >= 50_000 or i == b.num_rows - 1:
                    yield invert(sizes, number, posts, b.column(0).slice(start, len(sizes)), base + nth)
                    sizes, held, start, number, posts, nth = [], 0, i + 1, {}, [], nth + 1

    def invert(sizes, number, posts, ids, batch):
        token, doc, n = (np.concatenate(x) for x in zip(*posts))
        names = [utf8(w) for w in number]
        home = np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))
        order = np.lexsort((doc, token, home[token])) if len(token) else np.zeros(0, np.int64)
        token, doc, n = token[order], doc[order], n[order]
        at = home[token] if len(token) else token
        where, blocks = [], []
        bounds = np.flatnonzero(np.r_[True, at[1:] != at[:-1], True]) if len(at) else np.zeros(1, np.int64)
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            first = np.flatnonzero(np.r_[True, token[a + 1 : z] != token[a : z - 1]])
            blocks.append(_pack([names[i] for i in token[a:z][first].tolist()], np.r_[first[1:], z - a], doc[a:z], n[a:z]))
            where.append(int(at[a]))
        key = np.array([len(sizes), len(blocks)], "<i8").tobytes() + ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + ids.is_null().to_numpy(zero_copy_only=False).tobytes() + np.array(sizes, "<i8").tobytes()
        digest, k = xxh3_64_intdigest(key) >> 1, len(blocks) + 1
        return pa.RecordBatch.from_arrays([pa.array([batch] * k, pa.int64()), pa.array([-1, *where], pa.int32()), pa.array([digest] * k, pa.int64()), pa.array([key, *blocks], pa.binary())], names=_NAMES)

    return docs.mapInArrow(run, BLOCK)


def summed(blocks: DataFrame, definition: str) -> DataFrame:
    """(batch, bucket, digest, block): each posting block as its documents and, for each, pieces times frequency, summed; bucket -1 as it is."""

    def run(batches):
        pieces = Pieces(definition)
        for b in batches:
            out = []
            for bucket, blob in zip(b.column(1).to_pylist(), b.column(3)):
                blob = blob.as_py()
                if bucket >= 0:
                    words, gaps, docs, counts = _unpack(blob)
                    size = np.where([not w for w in words], 1, pieces.of([w.decode("utf-8", "surrogatepass") for w in words]))
                    total = np.bincount(docs, weights=np.repeat(size, gaps) * counts).astype(np.int64)
                    some = np.flatnonzero(total)
                    blob = _narrow(np.diff(some, prepend=0)) + _narrow(total[some])
                out.append(blob)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(out, pa.binary())], names=_NAMES)

    return blocks.mapInArrow(run, BLOCK)


def gathered(sums: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) from rows sorted by batch and bucket; a batch that lacks a block, or has one of other documents, is an error.

    The latter happens only if the input came in another order when a lost task was run again, as rows behind a
    shuffle can; rows read from files, or from a checkpoint, don't.
    """

    def close(batch, digest, ids, nulls, n_bytes, total, left):
        if left:
            raise ValueError(f"batch {batch} lacks {left} blocks")
        return pa.RecordBatch.from_arrays([pa.array(ids, mask=nulls), pa.array(n_bytes), pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])

    def run(batches):
        now = None
        for b in batches:
            for batch, bucket, digest, blob in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3)):
                blob = blob.as_py()
                if bucket < 0:
                    if now:
                        yield close(*now)
                    n, blocks = np.frombuffer(blob, "<i8", 2).tolist()
                    now = [batch, digest, np.frombuffer(blob, "<i8", n, 16), np.frombuffer(blob, bool, n, 16 + 8 * n), np.frombuffer(blob, "<i8", n, 16 + 9 * n), np.zeros(n, np.int64), blocks]
                elif now is None or now[0] != batch:
                    raise ValueError(f"batch {batch} lacks its documents")
                elif now[1] != digest:
                    raise ValueError(f"batch {batch} has a block of other documents: the input's order changed between attempts; checkpoint the input")
                else:
                    gaps, at = _wide(blob, 0)
                    now[5][np.cumsum(gaps)] += _wide(blob, at)[0]
                    now[6] -= 1
        if now:
            yield close(*now)

    return sums.repartition("batch").sortWithinPartitions("batch", "bucket").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def dealing(docs: DataFrame) -> tuple[int, int]:
    """(buckets, bytes of a batch) for an input as large as the optimizer's estimate of it.

    Both grow with the square root of the input, at 64 buckets for half a GB: what a bucket's task reads and how many
    blocks there are then grow alike, and a batch of 1 KB a bucket keeps blocks from getting tiny. An input whose
    size the optimizer doesn't know has as many buckets as the session has shuffle partitions.
    """
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size < 1 << 60
    buckets = max(8, isqrt(size // 120_000)) if known else int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return buckets, max(2_000_000, min(buckets << 10, 32_000_000))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, buckets: int | None = None, block_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``, whose doc_id is a long.

    Tokens are those of the tokenizer file at ``path`` without begin, end or added special tokens;
    its special strings inside a text count one each, as the library's default has it. Null
    and empty texts have none. Ids are never made: pieces are counted once for each distinct
    pre-token of a bucket, and joined to the frequencies that were dealt to the same bucket; the sums go back to
    the batch that the documents came in. Repeated rows and null doc_ids are counted like any. An empty table gives an empty one.
    Extra columns are left out. Frequencies are inverted for about ``block_bytes`` of text at a time and dealt to ``buckets``;
    both follow ``dealing`` unless they are given. Rows must come in the same order if a task is run again, as from files; else the job fails.
    """
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    rows = docs.select(named("doc_id").cast("long").alias("doc_id"), named("text").alias("text"))
    many, large = dealing(rows)
    many, large = buckets or many, block_bytes or large
    blocks = postings(rows, definition, many, large)
    # the documents' own rows go to any task, pre-tokens to the one of their bucket, which no other bucket has
    dealt = blocks.repartitionById(many, F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("batch"), F.lit(many))).otherwise(F.col("bucket")).cast("int"))
    counted = gathered(summed(dealt, definition))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
