"""Byte-level BPE with a rank queue.

``encode_piece`` keeps the symbols of one pre-token as a linked list over byte
positions. Every mergeable pair is filed under its merge rank; a hierarchical
bitmap (words of 256 bits, and above them one marking the words in use) finds
the lowest rank in use by find-first-set. Entries are not removed when a
neighbour changes: on the way out an entry counts only if the pair at its
position still has that rank. A pre-token of n bytes costs O(n log n).

``BatchQueue`` runs the same queue over all short pre-tokens of a slice that are
not remembered: one linked list with borders, buckets that hold positions of all
of them. A visited rank merges the leftmost position of every pre-token that has
it, together in numpy; what is left of the bucket is filed again, since a merge
can make a pair of lower rank that comes first.

Vocabulary and pattern are parameters. Results equal the reference tokeniser
of the rank files: a pre-token that is itself in the vocabulary is one token;
otherwise the pair of lowest rank merges first, leftmost on ties.

Edge cases: null and empty texts have no tokens and decode to no bytes.
Columns other than those named pass through unchanged.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from array import array
from itertools import islice
from struct import Struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType)

from medframe import ship
from medframe.llm.batches import slices, values

CACHED_PIECES = 60_000   # remembered pre-tokens of a generation; two are kept
SLICE_BYTES = 2 << 20    # text that is encoded together
SHORT_PIECE = 64         # bytes; longer pre-tokens go alone and are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


BITS = 8                 # a bitmap word has 2**BITS bits
BIT = [1 << i for i in range(1 << BITS)]
PACK = [Struct(f"<{n}I").pack for n in range(5)]


class RankQueue:
    """Positions filed by merge rank under a bitmap of two levels: ``words[w]``
    marks the ranks in use among 256, ``top`` the words in use. (Two levels
    hold 65,536 ranks; ``top`` widens for larger vocabularies.)"""

    def __init__(self, ranks: dict[bytes, int]):
        self.top = 0
        self.words = [0] * ((max(ranks.values(), default=0) >> BITS) + 1)
        self.buckets: dict[int, list[int]] = {}
        # ranks of pairs of single bytes, which every pre-token starts from
        self.two = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]


def encode_piece(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token. ``queue`` must be empty and is empty afterwards."""
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    words, buckets, top, push = queue.words, queue.buckets, queue.top, heapq.heappush
    end = list(range(1, n + 1))        # end of the symbol that starts here
    before = list(range(-1, n - 1))    # start of the symbol to the left
    two = queue.two
    pair = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]
    pair.append(-1)                    # rank of the pair that starts here, -1: none
    for i, r in enumerate(pair):
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)   # ascending, so a heap
            else:
                buckets[r] = [i]
                w = r >> BITS
                if not words[w]:
                    top |= 1 << w
                words[w] |= BIT[r & 255]
    while top:
        w = (top & -top).bit_length() - 1
        word = words[w]
        rank = (w << BITS) + (word & -word).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) == 1:
            i = bucket[0]
            del buckets[rank]
            word &= word - 1           # clears the lowest bit, that of this rank
            words[w] = word
            if not word:
                top &= top - 1
        else:
            i = heapq.heappop(bucket)
        if pair[i] != rank:
            continue                   # stale
        j = end[i]
        stop = end[i] = end[j]
        pair[i] = pair[j] = -1
        left = before[i]
        fresh = []
        if stop < n:
            before[stop] = i
            r = rank_of(piece[i:end[stop]])
            if r is not None:
                pair[i] = r
                fresh.append((r, i))
        if left >= 0:
            r = rank_of(piece[left:stop])
            if r is None:
                pair[left] = -1
            else:
                pair[left] = r
                fresh.append((r, left))
        for r, i in fresh:
            if r in buckets:
                push(buckets[r], i)
            else:
                buckets[r] = [i]
                w = r >> BITS
                if not words[w]:
                    top |= 1 << w
                words[w] |= BIT[r & 255]
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class BatchQueue:
    """One rank queue over many short pre-tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        # two symbols -> rank of both together, as sorted keys
        keys, found = array("q"), array("i")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    found.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks_of = np.array(found, dtype=np.int32)[order]
        self.words = [0] * ((max(ranks.values(), default=0) >> BITS) + 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the pairs of two symbols, -1 without one."""
        if not len(self.keys):
            return np.full(len(left), -1, dtype=np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks_of[at], -1)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has). No piece is empty."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        starts = np.cumsum(sizes) - sizes
        n = len(data)
        symbol = self.bytes[data]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        after = np.arange(1, n + 1, dtype=np.int32)          # next symbol, -1 at a border
        after[starts + sizes - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int32)
        before[starts] = -1
        pair = np.full(n, -1, dtype=np.int32)                # rank of the pair that starts here
        inner = np.flatnonzero(after >= 0)
        pair[inner] = self._rank(symbol[inner], symbol[inner + 1])
        alive = np.ones(n, dtype=bool)

        buckets: dict[int, list] = {}
        words, top = self.words, 0

        def file(ranks, places) -> None:
            """Positions into the buckets of their ranks."""
            nonlocal top
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, i, j in zip(ranks[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                if r in buckets:
                    buckets[r].append(places[i:j])
                else:
                    buckets[r] = [places[i:j]]
                    words[r >> BITS] |= BIT[r & 255]
                    top |= 1 << (r >> BITS)

        some = np.flatnonzero(pair >= 0)
        if len(some):
            file(pair[some], some)
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            rank = (w << BITS) + (word & -word).bit_length() - 1
            words[w] = word & (word - 1)
            if not words[w]:
                top &= top - 1
            held = buckets.pop(rank)
            places = held[0] if len(held) == 1 else np.sort(np.concatenate(held))
            places = places[pair[places] == rank]            # the others are stale
            if not len(places):
                continue
            own = piece[places]
            first = np.concatenate(([True], own[1:] != own[:-1]))
            if not first.all():                              # one merge of a piece at a time
                rest, places = places[~first], places[first]
                buckets[rank] = [rest]
                words[w] |= BIT[rank & 255]
                top |= 1 << w
            second = after[places]
            third, left = after[second], before[places]
            symbol[places] = rank
            after[places] = third
            alive[second] = False
            pair[second] = -1
            pair[places] = -1
            more = third >= 0
            i, k = places[more], third[more]
            before[k] = i
            pair[i] = self._rank(symbol[i], symbol[k])
            left = left[left >= 0]
            pair[left] = self._rank(symbol[left], np.full(len(left), rank))
            fresh = np.concatenate((i, left))
            fresh = fresh[pair[fresh] >= 0]
            if len(fresh):
                file(pair[fresh], fresh)
        ids = symbol[alive]
        return ids, np.add.reduceat(alive.astype(np.int64), starts) if n else np.zeros(0, np.int64)


# What a pre-token encodes to: packed ids, their decimal text, and the bytes they decode to.
Piece = tuple[bytes, str, bytes]


class Encoder:
    """Encodes the texts of a slice together. Remembers short pre-tokens in two
    generations: when a slice fills the young one it becomes the old one, and what is
    used again moves back, so frequent pre-tokens stay."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.long = RankQueue(ranks)
        self.short = BatchQueue(ranks)
        self.by_id = vocabulary(ranks)
        self.decimal = [str(i) for i in range(len(self.by_id))]
        self.decimal_sizes = np.array([len(d) + 1 for d in self.decimal], dtype=np.int32)  # with a comma
        self.sizes = np.array([len(b) for b in self.by_id], dtype=np.int32)
        self.young: dict[str, Piece] = {}
        self.old: dict[str, Piece] = {}

    def forget(self) -> None:
        """Give the memory of remembered pre-tokens back to the worker's next task."""
        self.young, self.old = {}, {}

    def _encode(self, new: list[str]) -> dict[str, Piece]:
        """Pre-tokens that are not remembered, each once."""
        short, names, ids, order = [], [], [], []
        for name in new:
            data = name.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                order.append(name)
                ids.append([whole])
            elif len(data) > SHORT_PIECE:
                order.append(name)
                ids.append(encode_piece(data, self.ranks, self.long))
            else:
                short.append(data)
                names.append(name)
        ends = np.cumsum([len(i) for i in ids]).tolist()
        flat = [np.array([x for i in ids for x in i], dtype=np.int32)]
        if short:
            found, counts = self.short.encode(short)
            ends += (np.cumsum(counts) + len(flat[0])).tolist()
            flat.append(found)
        every = np.concatenate(flat)
        packed = every.astype("<u4").tobytes()
        numbers = every.tolist()
        # texts and bytes of all pieces together, cut where each one ends
        decimal = ",".join(map(self.decimal.__getitem__, numbers))
        decoded = b"".join(map(self.by_id.__getitem__, numbers))
        at = np.array(ends, dtype=np.int64)
        letters = np.concatenate(([0], np.cumsum(self.decimal_sizes[every])))[at].tolist()
        sizes = np.concatenate(([0], np.cumsum(self.sizes[every])))[at].tolist()
        out, a, b, c = {}, 0, 0, 0
        for name, i, j, k in zip(order + names, (4 * at).tolist(), letters, sizes):
            out[name] = packed[a:i], decimal[b:j - 1], decoded[c:k]
            a, b, c = i, j, k
        return out

    def __call__(self, texts: list[str]) -> list[list[Piece]]:
        """The pieces of each text."""
        split = [self.split(t) for t in texts]
        young, old = self.young, self.old
        missing = set().union(*split).difference(young)
        again = old.keys() & missing
        for name in again:
            young[name] = old[name]
        missing -= again
        young |= self._encode(list(missing))
        out = [list(map(young.__getitem__, pieces)) for pieces in split]
        for name in missing:
            if len(name) > SHORT_PIECE:
                del young[name]
        if len(young) >= CACHED_PIECES:
            # of those of the last slice only what fits; frequent ones came first
            self.old, self.young = dict(islice(young.items(), CACHED_PIECES)), {}
        return out


def packed_ids(pieces: list[Piece]) -> np.ndarray:
    return np.frombuffer(b"".join([ids for ids, _, _ in pieces]), dtype="<u4")


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """The worker's encoder, kept between tasks (its memory is bounded)."""
    key = (id(shared.value), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def vocabulary(ranks: dict[bytes, int]) -> list[bytes]:
    """Token bytes by id."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decode(ids, by_id: list[bytes]) -> bytes:
    return b"".join(map(by_id.__getitem__, ids))


def _run(shared, pattern: str, text_col: str, make, names: list[str], types: list):
    """Batch function: appends the columns ``make(text, pieces)``."""
    def run(batches):
        encoder = _encoder(shared, pattern)
        # pieces hold no cycles; looking for some among millions of them is a fifth of the time
        collects = gc.isenabled()
        gc.disable()
        try:
            for part in slices(batches, text_col, SLICE_BYTES):
                texts = [text or "" for text in values(part, text_col)]
                rows = [make(text, pieces) for text, pieces in zip(texts, encoder(texts))]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.record_batch(list(part.columns) + cols, names=list(part.schema.names) + names)
        finally:
            encoder.forget()
            if collects:
                gc.enable()

    return run


def _with(df: DataFrame, *more: tuple) -> StructType:
    return StructType([*df.schema.fields, *(StructField(n, t) for n, t in more)])


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           out_col: str = "token_ids") -> DataFrame:
    """``df`` with ``out_col`` array<int>: the token ids of the whole text."""
    spark = df.sparkSession
    ship.ensure(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))  # a fixed vocabulary file
    schema = _with(df.drop(out_col), (out_col, ArrayType(IntegerType())))
    return df.drop(out_col).mapInArrow(
        _run(shared, pattern, text_col, lambda text, pieces: (packed_ids(pieces),), [out_col], [pa.list_(pa.int32())]), schema)


def decode_ids(df: DataFrame, ranks_path: str, ids_col: str = "token_ids",
               out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col`` binary: the bytes of ``ids_col`` (null: empty)."""
    spark = df.sparkSession
    ship.ensure(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    schema = _with(df.drop(out_col), (out_col, BinaryType()))

    def run(batches):
        by_id = vocabulary(shared.value)
        for batch in batches:
            data = [decode(ids or [], by_id) for ids in values(batch, ids_col)]
            yield pa.record_batch(list(batch.columns) + [pa.array(data, pa.binary())],
                                  names=list(batch.schema.names) + [out_col])

    return df.drop(out_col).mapInArrow(run, schema)


def _digests(text: str, pieces: list[Piece]) -> tuple[int, str, str]:
    ids, decimal, decoded = zip(*pieces) if pieces else ((), (), ())
    return (sum(map(len, ids)) // 4, hashlib.sha256(",".join(decimal).encode()).hexdigest(),
            hashlib.sha256(b"".join(decoded)).hexdigest())


def round_trip(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode every text; only counts and digests leave the task:
    ``id, n_tokens, ids_sha256, decoded_sha256``."""
    spark = df.sparkSession
    ship.ensure(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    slim = df.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    names, kinds = ["n_tokens", "ids_sha256", "decoded_sha256"], [pa.int64(), pa.string(), pa.string()]
    schema = _with(slim, ("n_tokens", LongType()), ("ids_sha256", StringType()),
                   ("decoded_sha256", StringType()))
    return slim.mapInArrow(_run(shared, pattern, "text", _digests, names, kinds), schema).drop("text")


def _checked(text: str, pieces: list[Piece]) -> tuple[np.ndarray, int, bool]:
    ids, _, decoded = zip(*pieces) if pieces else ((), (), ())
    packed = np.frombuffer(b"".join(ids), dtype="<u4")
    return packed, len(packed), b"".join(decoded) == text.encode()


def tokenise(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``df`` with ``token_ids array<int>, n_tokens long, round_trip boolean``
    (the ids decode to the text) in place of ``text_col``. Columns of these
    names are replaced."""
    spark = df.sparkSession
    ship.ensure(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    names = ["token_ids", "n_tokens", "round_trip"]
    kinds = [pa.list_(pa.int32()), pa.int64(), pa.bool_()]
    slim = df.drop(*names)
    schema = _with(slim, *zip(names, (ArrayType(IntegerType()), LongType(), BooleanType())))
    return slim.mapInArrow(_run(shared, pattern, text_col, _checked, names, kinds), schema).drop(text_col)
