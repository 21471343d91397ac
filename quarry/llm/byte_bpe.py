"""Byte-level BPE: ranked merges folded over distinct words; decoding concatenates binary pieces.

Texts are cut into words in Python, and each distinct word of a task is handed on once, as the array
of its bytes. ``fold_sql`` is the fold: Spark's higher-order functions over those arrays, with
the rank map as a literal. Documents follow their words as places in the list of words, so that ids are put together again
behind the fold without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.tables import give_back, latin_pattern, table, utf8

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Code points with the property White_Space, which is what \s means to the library.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_NONE = 1 << 30
_BLOCK = 20_000  # new words that are handed to the fold together
_LONG = 255  # bytes of a word that the higher-order fold takes; a longer one is folded with a heap


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def newer_letters() -> str:
    """Code points that are letters or numbers to ``regex`` but not to the library, whose Unicode tables are older.

    Only what Python's own tables call unassigned can differ; the library is asked about
    those. It parts "'s" from a letter, but not from a code point that is none.
    """
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)} | {b"'s": 256}
    library = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    return "".join(c for c in regex.findall(r"[\p{L}\p{N}]", unassigned) if 256 not in library.encode_ordinary(f"{c}'s"))


class Splitter:
    """Splits texts by ``pattern``; code points in ``newer`` are taken for what the library takes them for."""

    def __init__(self, pattern: str, newer: str):
        self.pattern = _compile(pattern)
        self.latin = latin_pattern(pattern, _SPACE)
        self.newer = regex.compile(f"[{newer}]") if newer else None

    def findall(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.newer and self.newer.search(text):
                return [text[slice(*m.span())] for m in self.pattern.finditer(self.newer.sub("\uffff", text))]
            return self.pattern.findall(text)
        return self.latin.findall(text)


def _compile(pattern: str) -> regex.Pattern:
    return regex.compile(pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]"))


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, the leftmost of equals, until no pair has a rank."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 48:
        return _fold_long(word, ranks)
    get = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while pairs and (best := min(pairs)) < _NONE:
        i = pairs.index(best)
        parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + joined, _NONE)
        if i < len(pairs):
            pairs[i] = get(joined + parts[i + 1], _NONE)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same fold with a heap, for words whose length would make rescanning quadratic."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    live = [True] * n
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not live[i] or end[i] != mid or mid >= n or not live[mid] or end[mid] != stop:
            continue
        live[mid], end[i], after[i] = False, stop, after[mid]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[after[i]]))
        if before[i] >= 0:
            b = before[i]
            if (r := ranks.get(word[b:stop])) is not None:
                heapq.heappush(heap, (r, b, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = after[i]
    return out


@dataclass(frozen=True)
class RankMap:
    """The ranks as arrays, for a literal: what a pair of ids joins to is one look-up in two of them.

    A pair's key is left << 16 | right. ``shift`` parts the keys into small buckets, and moves
    each so that no two keys share a cell; a cell holds key << 20 | rank. So cell ^ key << 20 is the rank if
    the pair joins, and larger than any rank otherwise. A cell without a pair is 0, which is short as a literal, but for the
    one in which pair 0 is looked up. ``begin`` has for each byte and the byte after it (256 for none)
    what the fold starts with: the pair's rank << 25 | the byte's id.
    """

    begin: list[int]
    shift: list[int]
    cells: list[int]

    #: Two primes, of buckets and of cells, and an odd factor that spreads keys over cells.
    BUCKETS, CELLS, FACTOR = 32749, 131071, 1103515245
    #: An id that no pair has: it stands at both ends of a word.
    EDGE = 65535
    #: The rank of pairs that don't join.
    NONE = 1 << 20

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> RankMap:
        if max(ranks.values()) >= cls.EDGE:
            raise ValueError("ids of over 16 bits")
        pairs = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    pairs[a << 16 | b] = rank
        groups: dict[int, list[int]] = defaultdict(list)
        for k in pairs:
            groups[k % cls.BUCKETS].append(k)
        shift, cell = [0] * cls.BUCKETS, {}
        for g, keys in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            at, by = [k * cls.FACTOR % cls.CELLS for k in keys], 0
            while not cell.keys().isdisjoint([x + by for x in at]):
                by += 1
            shift[g] = by
            cell.update((x + by, k << 20 | pairs[k]) for x, k in zip(at, keys))
        cells = [0] * (cls.CELLS + max(shift) + 1)
        cells[shift[0]] = 1 << 62
        for x, v in cell.items():
            cells[x] = v
        ids = [ranks[bytes([b])] for b in range(256)]
        begin = [(pairs.get(a << 16 | b, cls.NONE) if b is not None else cls.NONE) << 25 | a for a in ids for b in (*ids, None)]
        return cls(begin, shift, cells)


def fold_sql(word: str) -> str:
    """The fold as one SQL expression: name of an array<long>, a word as ``_starts`` has it, to the array of ids that are left.

    ``cells`` and ``shifts`` are the rank map's arrays, which ``with_ranks`` binds.
    The array holds the word's bytes, a long each, with ``EDGE`` at both ends: rank of the pair that a part begins
    (21 bits), the part's first byte (9 bits), its id (16 bits). So its least element is the leftmost pair of lowest rank, and one step joins
    that pair and looks two new pairs up. A step in which nothing joins leaves the array as it is. An array that begins with -1 has ids that are folded already.
    """
    none = RankMap.NONE << 25
    rank = f"least({RankMap.NONE}L, cells[k * {RankMap.FACTOR}L % {RankMap.CELLS}L + shifts[k % {RankMap.BUCKETS}L]] ^ shiftleft(k, 20))"

    def part(own: str, key: str) -> str:  # first byte and id of a part, and the key of the pair it begins, which an aggregate over one element binds
        return f"aggregate(array({key}), {own}, (z, k) -> shiftleft({rank}, 25) + z)"

    joined = part("(m & 33488896L) + shiftright(m, 25)", "shiftleft(shiftright(m, 25), 16) + (u[q + 1] & 65535L)")
    before = part("u[i] & 33554431L", "shiftleft(u[i] & 65535L, 16) + shiftright(m, 25)")
    step = f"""aggregate(array(array_min(s)), s, (t, m) -> if(m >= {none}L, t, aggregate(array(int(array_position(t, m))), t, (u, q) ->
        transform(slice(u, 2, size(u)), (x, i) -> if(i >= q, x, if(i < q - 2, u[i], if(i = q - 1, {joined}, {before})))))))"""
    fold_all = f"aggregate(slice({word}, 4, size({word})), {word}, (s, x) -> {step}, s -> slice(s, 2, size(s) - 2))"
    return f"transform(if({word}[0] < 0, slice({word}, 2, size({word})), {fold_all}), x -> int(x & 65535L))"


def _starts(words: list[bytes], ranks: dict[bytes, int], begin: np.ndarray) -> pa.ListArray:
    """What the fold takes for words: their bytes, each with the rank of the pair it begins, between two edges.

    A whole piece is one id, and a word of over ``_LONG`` bytes has ids folded with a heap; such ids come after a -1.
    """
    get, edge = ranks.get, (RankMap.NONE << 25) + RankMap.EDGE
    ready = [[-1, whole] if (whole := get(w)) is not None else [-1, *_fold_long(w, ranks)] if len(w) > _LONG else None for w in words]
    size = np.fromiter((len(w) + 2 if r is None else len(r) for w, r in zip(words, ready)), np.int64, len(words))
    is_ready = np.fromiter((r is not None for r in ready), bool, len(words))
    left = np.frombuffer(b"".join(w for w, r in zip(words, ready) if r is None), np.uint8).astype(np.int64)
    ends = np.cumsum(size[~is_ready] - 2)
    right = np.append(left[1:], 256)[: len(left)]
    right[ends - 1] = 256  # no byte after the last
    place = np.arange(1, len(left) + 1) - np.repeat(np.r_[0, ends[:-1]][: len(ends)], size[~is_ready] - 2)
    inner = np.ones(int(size[~is_ready].sum()), bool)
    stops = np.cumsum(size[~is_ready])
    inner[stops - 1] = inner[stops - size[~is_ready]] = False
    plain = np.full(len(inner), edge)
    plain[inner] = begin[left * 257 + right] + (place << 16)
    out = np.empty(int(size.sum()), np.int64)
    which = np.repeat(is_ready, size)
    out[~which] = plain
    out[which] = [x for r in ready if r is not None for x in r]
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(out))


def with_ranks(body: str, known: RankMap, kind: str) -> Column:
    """``body``, of the SQL type ``kind``, with the rank map as literals.

    Aggregates over one element bind them, so that each stands in the plan once and no result is copied.
    """
    for name, values in (("cells", known.cells), ("shifts", known.shift)):
        body = f"aggregate(array(cast(split('{','.join(map(str, values))}', ',') as array<bigint>)), cast(array() as {kind}), (none, {name}) -> {body})"
    return F.expr(body)


class _Places(dict):
    """Each word's place in the list of words; one that is not there yet is put at its end, and among the ``new`` ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def _handed_on(at: int, kept: list[int], pattern: str, ranks: dict[bytes, int], begin: np.ndarray, newer: str, remembered: int):
    """Rows of the columns in ``kept``, then seq (a document's words, as places in the list of words), words (new ones, as ``_starts`` has them) and restart.

    New words go before the first document that has them. When ``remembered`` words are
    listed, the list starts again with the next document.
    """

    def run(batches):
        split = Splitter(pattern, newer)
        place = _Places()
        for b in batches:
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                new = place.new = []
                restart, a, seqs = False, 0, []
                for i, t in enumerate(part.column(at)):
                    words = split.findall(t.as_py() or "")
                    if words and len(place) >= remembered:
                        yield from flush(part, a, i, seqs, new, restart)
                        place = _Places()
                        new, seqs, a, restart = place.new, [], i, True
                    seqs.append(np.fromiter(map(place.__getitem__, words), "<u4", len(words)).tobytes())
                    if len(new) >= _BLOCK:
                        yield from flush(part, a, i + 1, seqs, new, restart)
                        new = place.new = []
                        seqs, a, restart = [], i + 1, False
                yield from flush(part, a, part.num_rows, seqs, new, restart)

    def flush(part, a, z, seqs, new, restart):
        columns = [part.column(i).slice(a, z - a) for i in kept]
        names = [*(part.schema.names[i] for i in kept), "seq", "words", "restart"]
        kind = pa.list_(pa.list_(pa.int64()))
        for k in range(0, len(new), _BLOCK):
            some = [utf8(w) for w in new[k : k + _BLOCK]]
            words = _starts(some, ranks, begin)
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, c.type) for c in columns), pa.nulls(1, pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), words), pa.array([restart and not k])], names=names
            )
        if z > a:
            yield pa.RecordBatch.from_arrays([*columns, pa.array(seqs, pa.binary()), pa.nulls(z - a, kind), pa.nulls(z - a, pa.bool_())], names=names)

    return run


class _Ids:
    """Ids of the words listed so far, laid end to end, and if ``pieces`` are given what the ids decode to, each word's pieces concatenated."""

    def __init__(self, pieces: dict[int, bytes] | None):
        self.pieces = pieces
        self.clear()

    def clear(self):
        self.decoded: list[bytes] = []
        self.flat, self.ends, self.n, self.m = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, words: pa.ListArray):
        size = np.diff(words.offsets.to_numpy())
        ids = words.flatten().to_numpy()
        while self.n + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat, np.zeros_like(self.flat)]
        while self.m + len(size) + 1 > len(self.ends):
            self.ends = np.r_[self.ends, np.zeros_like(self.ends)]
        self.flat[self.n : self.n + len(ids)] = ids
        self.ends[self.m + 1 : self.m + 1 + len(size)] = self.n + np.cumsum(size)
        self.n, self.m = self.n + len(ids), self.m + len(size)
        if self.pieces is not None:
            each, ends = list(map(self.pieces.__getitem__, ids.tolist())), np.cumsum(size).tolist()
            self.decoded += [b"".join(each[a:z]) for a, z in zip([0, *ends], ends)]

    def text(self, seq: bytes) -> bytes:
        return b"".join(map(self.decoded.__getitem__, np.frombuffer(seq, "<u4").tolist()))

    def of(self, seq: bytes) -> np.ndarray:
        at = np.frombuffer(seq, "<u4")
        start = self.ends[at]
        size = self.ends[at + np.uint32(1)] - start
        ends = np.cumsum(size)
        return self.flat[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _encoded(docs: DataFrame, kept: list[str], path: str, pattern: str, remembered: int, finish, schema: T.StructType, decoded: bool = False) -> DataFrame:
    """``finish(columns in kept, ids of each document, and what they decode to)`` of every document, ids coming from the higher-order fold over distinct words."""
    ranks, spark = read_ranks(path), docs.sparkSession
    rank_map = RankMap.of(ranks)
    shared = spark.sparkContext.broadcast((ranks, np.array(rank_map.begin), newer_letters()))
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # names that can't clash
    at, places = docs.columns.index("text"), [docs.columns.index(c) for c in kept]
    names = [f"c{i}" for i in places]
    arrow = T.StructType([*(T.StructField(c, plain.schema[c].dataType) for c in names), *T.StructType.fromDDL("seq binary, words array<array<bigint>>, restart boolean")])

    def split(batches):
        give_back()  # of what a reused worker did before
        yield from _handed_on(at, places, pattern, *shared.value, remembered)(batches)
        give_back()

    def gather(batches):
        give_back()
        ids = _Ids({i: b for b, i in shared.value[0].items()} if decoded else None)
        for b in batches:
            *columns, seqs, words, restarts = b.columns
            is_words = words.is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.r_[True, is_words[1:] != is_words[:-1], True]) if b.num_rows else []
            for a, z in zip(edges[:-1], edges[1:]):
                if not is_words[a]:
                    some = [x.as_py() for x in seqs.slice(a, z - a)]
                    yield finish([c.slice(a, z - a) for c in columns], [ids.of(x) for x in some], [ids.text(x) for x in some] if decoded else [])
                    continue
                for i in range(a, z):
                    if restarts[i].as_py():
                        ids.clear()
                    ids.add(words[i].values)
        ids.clear()
        give_back()

    rows = plain.mapInArrow(split, arrow)
    fold = with_ranks(f"transform(words, w -> {fold_sql('w')})", rank_map, "array<array<int>>")
    del rank_map
    give_back()  # of the driver's, what the rank map took
    return rows.select(*names, "seq", fold.alias("words"), "restart").mapInArrow(gather, schema)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, remembered: int = 500_000, column: str = "tokens") -> DataFrame:
    """Return ``docs`` with ``column``: the ids of each whole text, as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately and no special tokens are made. Null and
    empty texts have no ids. A task lists its distinct words, about ``remembered`` of them before the list starts
    again, and Spark's higher-order functions fold each listed word once; words of over 255 bytes, where
    a fold over arrays is quadratic, are folded with a heap. Nothing is shuffled. The rank map is a literal, of the
    vocabulary's size and not the data's. Repeated rows are encoded each; an empty table gives an empty one; extra
    columns pass through, but one named ``column`` is replaced.
    """
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.BinaryType())])
    return _encoded(docs, docs.columns, path, pattern, remembered, lambda columns, ids, _: pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in ids], pa.binary())], names=schema.names), schema)


def decode(tokens: DataFrame, path: str, column: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """Return ``tokens`` with ``decoded``: the pieces of the ids in ``column``, concatenated (null: null).

    An id without a piece is an error. Extra columns pass through, but one named ``decoded`` is replaced.
    """
    shared = tokens.sparkSession.sparkContext.broadcast({i: b for b, i in read_ranks(path).items()})
    tokens = tokens.drop(decoded)
    schema = T.StructType([*tokens.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches):
        piece = shared.value.__getitem__
        for b in batches:
            ids = (x.as_py() for x in b.column(b.schema.get_field_index(column)))
            out = pa.array((None if x is None else b"".join(map(piece, np.frombuffer(x, "<u4").tolist())) for x in ids), pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=schema.names)

    return tokens.mapInArrow(run, schema)


def fold_words(words: DataFrame, path: str, column: str = "word", ids: str = "ids") -> DataFrame:
    """Return ``words`` with ``ids``: the fold of each word (a binary column), as ``encode`` folds them.

    Null words have null ids, empty ones no ids; words of over 255 bytes are refused with an
    error. Extra columns pass through, but one named ``ids`` is replaced.
    """
    ranks = read_ranks(path)
    known = RankMap.of(ranks)
    name, edge = f"`{column.replace('`', '``')}`", (RankMap.NONE << 25) + RankMap.EDGE
    begins = f"cast(split('{','.join(map(str, known.begin))}', ',') as array<bigint>)"
    byte = lambda i: f"coalesce(cast(conv(hex(substring({name}, {i}, 1)), 16, 10) as int), 256)"  # noqa: E731 none past the end
    letters = f"transform(sequence(1, octet_length({name})), i -> begins[{byte('i')} * 257 + {byte('if(i < octet_length(' + name + '), i + 1, null)')}] + i * 65536L)"
    start = f"concat(array({edge}L), aggregate(array({begins}), cast(array() as array<bigint>), (none, begins) -> {letters}), array({edge}L))"
    whole = f"case when octet_length({name}) > {_LONG} then raise_error('a word of over {_LONG} bytes') else {start} end"
    fold = f"case when {name} is null then null when octet_length({name}) = 0 then cast(array() as array<int>) else transform(array({whole}), w -> {fold_sql('w')})[0] end"
    return words.drop(ids).withColumn(ids, with_ranks(fold, known, "array<int>"))


def digest(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, remembered: int = 500_000) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded.

    The same fold and the same pieces as ``encode`` and ``decode``, in one pass, so that ids needn't leave the task; a word's pieces are
    concatenated once, and a text from its words. Null and
    empty texts have no ids and decode to no bytes; repeated rows and rows without a doc_id have a digest each; an empty table gives an empty
    one; extra columns are left out.
    """
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string")])

    def finish(columns, ids, text):
        made = [pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in text])]
        return pa.RecordBatch.from_arrays([columns[0], *made], names=schema.names)

    return _encoded(docs.select("doc_id", "text"), ["doc_id"], path, pattern, remembered, finish, schema, decoded=True)


def stage(docs: DataFrame) -> DataFrame:
    """The pipeline's last stage: the token digest of every document, as ``digest`` gives it."""
    return digest(docs, public_tokenizers.path(RANK_FILE))


def query(spark, sf_dir):
    return digest(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE))
