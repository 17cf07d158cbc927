"""Scores of texts under an n-gram model held in a log-frequency Bloom filter.

Counting: the training texts give exact counts of every word (a table). The
different unigrams and bigrams of each slice of texts, as 50 bits of hash, go
once to their code range, with their counts in training texts. There counts
are added up and quantised to levels, ``1 + floor(log2 count)``; all unigrams
and bigrams enter the range's filter at every level up to theirs. A filter has as many blocks of ``1 << BIT_POWER``
bits (a power of two) as its items need. Ranges grow in number with the texts,
blocks with the items, so nothing is left out at any size, and no task holds
more than one range. The texts of a slice travel beside, as one row.

Scoring: the codes of each slice probe the filter of their range, and their
levels go back to the slice. The level of an n-gram is found by probing level
after level until a probe fails. The probability of a word is that of the bigram smoothed by the
unigram: (c(h w) + MU p(w)) / (c(h) + MU).

The base score takes exact counts: those of the most frequent words, a bounded
table, are broadcast; other words are joined on the word.

Edge cases: a null or empty text is the end token alone. Rows are scored one by
one, also if they share an id; a row without an id trains. Without training
texts N and V are 0. Words of any length count; only short ones are broadcast.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import U64, hash_words, mix, number_words, slices, store, text_bytes, values, words

BLOCK_POWER = 10             # bits of a code that its range tells at least
BIT_POWER = 18
PROBES = 3
BITS_PER_ITEM = 8.4          # about 3 % false positives with three probes
MU = 5.0
FREQUENT_WORDS = 150_000     # broadcast at most
FREQUENT_BYTES = 64          # longer words are joined
SLICE_BYTES = 4 << 20        # texts whose codes are sent together
WORDS_AT_ONCE = 300_000
CODES_PER_RANGE = 1 << 22    # codes in a range, at most about
WORD_BYTES = 4               # of text per token, to tell the number of ranges
END = b""                    # end of a text; also what stands before its first word

_KEY = U64((1 << 48) - 1)
_BIT = U64((1 << BIT_POWER) - 1)


def held_out(id_col) -> F.Column:
    """Fold kept out of training: crc32 of the id as text, mod 5, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    out = words(text)
    out.append(END)
    return out


def unigram_codes(h: np.ndarray) -> np.ndarray:
    """58-bit codes of words, of which the lowest 8 bits are 0; the next one
    tells words from bigrams."""
    return mix(h ^ U64(0x5851F42D4C957F2D)) >> U64(15) << U64(9) | U64(256)


def bigram_codes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * U64(0x9E3779B97F4A7C15) ^ mix(word)) >> U64(15) << U64(9)


class Chunk:
    """Tokens of some texts: ids into the list of different words."""

    def __init__(self, texts: list[bytes]):
        flat: list[bytes] = []
        sizes = []
        for t in texts:
            own = tokens(t)
            flat += own
            sizes.append(len(own))
        self.words, self.ids = number_words(flat)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])).astype(np.int64)
        self.hash = hash_words(self.words)

        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[self.starts] = self.ids[-1]  # the end token, which every text ends with

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """The different codes, sorted, and the place among them of each
        different word, then of each token's bigram."""
        bigrams = bigram_codes(self.hash[self.before], self.hash[self.ids])
        return np.unique(np.concatenate((unigram_codes(self.hash), bigrams)), return_inverse=True)


def word_counts(train: DataFrame) -> DataFrame:
    """``word binary, c`` over all tokens of ``train(text)``."""
    def run(batches):
        held: Counter = Counter()
        for part in slices(batches, "text"):
            for t in text_bytes(part, "text"):
                held.update(tokens(t))
                if len(held) > WORDS_AT_ONCE:
                    yield _word_rows(held)
                    held = Counter()
        yield _word_rows(held)

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _word_rows(held: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                           names=["word", "c"])


def _pack(codes: np.ndarray) -> bytes:
    return (codes & _KEY).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 1:6].tobytes()


def _unpack(raw: bytes, part: int, power: int) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    wide[:, 1:6] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return wide.reshape(-1).view("<u8") | U64(part >> power - BLOCK_POWER << 48)


def range_power(text_bytes_total: int) -> int:
    """Leading bits of a code that tell its range."""
    return BLOCK_POWER + (2 * text_bytes_total // WORD_BYTES // (CODES_PER_RANGE << BLOCK_POWER)).bit_length()


def _sender(power: int):
    """Per slice of texts: its different codes with their counts in training
    texts, a row for each range, and a row of its own (``part`` below 0) with
    the texts."""
    def run(batches):
        for texts in slices(batches, "text", SLICE_BYTES):
            c = Chunk(text_bytes(texts, "text"))
            codes, at = c.codes()
            train = np.repeat(np.array(values(texts, "train"), dtype=bool), c.sizes)
            counts = np.bincount(at[c.ids[train]], minlength=len(codes))
            counts += np.bincount(at[len(c.words):][train], minlength=len(codes))
            part = (codes >> U64(58 - power)).astype(np.int64)
            cut = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(texts)
            name = values(texts, "row")[0]
            yield pa.record_batch([
                pa.array([name] * len(cut), pa.int64()),
                pa.array(np.append(part[cut[:-1]], -1 - name), pa.int64()),
                pa.array([_pack(codes[a:b]) for a, b in zip(cut, cut[1:])] + [sink.getvalue().to_pybytes()],
                         pa.binary()),
                pa.array([counts[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])] + [b""], pa.binary()),
            ], names=["slice", "part", "data", "counts"])

    return run


def _range_levels(power: int, bits_per_item: float):
    """The filter of a range is built, then probed for every slice's codes. A
    slice's own row passes."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        if part < 0:
            return group[["slice", "part", "data"]].assign(part=-1)
        every = _unpack(b"".join(group["data"]), part, power)
        counts = np.frombuffer(b"".join(group["counts"]), dtype="<u4").astype(np.int64)
        order = np.argsort(every, kind="stable")
        codes = every[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        codes, counts = codes[first], np.add.reduceat(counts[order], first)
        del order
        keep = counts > 0
        bloom = _build(codes[keep], 1 + np.floor(np.log2(counts[keep])).astype(int), power, bits_per_item)
        levels = bloom.levels(every).tobytes()
        ends = (group["data"].str.len() // 5).cumsum()
        return pd.DataFrame({"slice": group["slice"], "part": part,
                             "data": [levels[i:j] for i, j in zip([0, *ends], ends)]})

    return run


def _build(codes: np.ndarray, level: np.ndarray, power: int, bits_per_item: float) -> LogFrequencyFilter:
    """The filter of a range, with each code at every level up to its own."""
    more = 0
    while int(level.sum()) * bits_per_item > 1 << BIT_POWER + more:
        more += 1
    bits = np.zeros(1 << BIT_POWER + more, dtype=np.uint8)
    highest = int(level.max(initial=0))
    for q in range(1, highest + 1):
        for p in positions(codes[level >= q], q, power + more):
            bits[p & U64(len(bits) - 1)] = 1
    return LogFrequencyFilter(np.packbits(bits, bitorder="little"), 1, highest, power + more)


def positions(codes: np.ndarray, level, power: int = BLOCK_POWER) -> list[np.ndarray]:
    """Bits probed for codes at a level, inside the block of each code; there
    are ``1 << power`` blocks."""
    step = U64(int(level) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)
    x = mix(codes * U64(0xD6E8FEB86659FD93) + step)
    base = codes >> U64(58 - power) << U64(BIT_POWER)
    return [base | x >> U64(i * BIT_POWER) & _BIT for i in range(PROBES)]


def mean_counts(levels: np.ndarray) -> np.ndarray:
    """Mean count of each level; level 0 is unseen."""
    return np.where(levels > 0, (3 * 2.0 ** (levels.astype(float) - 1) - 1) / 2, 0.0)


class LogFrequencyFilter:
    """Quantised counts by repeated membership probes. ``bits`` are all
    ``1 << power`` blocks, or those of one range of codes."""

    def __init__(self, bits: np.ndarray, lowest: int, highest: int, power: int = BLOCK_POWER):
        self.bits, self.lowest, self.highest, self.power = bits, lowest, highest, power

    def levels(self, codes: np.ndarray) -> np.ndarray:
        """Highest level in the filter, 0 if not even the lowest one is."""
        out = np.zeros(len(codes), dtype=np.uint8)
        rows = np.arange(len(codes))
        inside_range = U64(8 * len(self.bits) - 1)
        for level in range(self.lowest, self.highest + 1):
            inside = np.ones(len(rows), dtype=bool)
            for p in positions(codes[rows], level, self.power):
                p &= inside_range
                inside &= (self.bits[p >> U64(3)] >> (p & U64(7)).astype(np.uint8) & 1).astype(bool)
            rows = rows[inside]
            if len(rows) == 0:
                break
            out[rows] = level
        return out

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """Mean count of the highest level in the filter."""
        return mean_counts(self.levels(codes))


def frequent_words(counts: DataFrame, limit: int = FREQUENT_WORDS) -> dict[bytes, int]:
    """Exact counts of the words above a count that at most ``limit`` reach."""
    by_count = counts.where(F.length("word") <= FREQUENT_BYTES).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    held, least = 0, None
    for r in sorted(by_count.collect(), key=lambda r: -r["c"]):  # different counts: few, as they add up to N
        held += r["n"]
        if held > limit:
            break
        least = r["c"]
    if least is None:
        return {}
    top = counts.where((F.length("word") <= FREQUENT_BYTES) & (F.col("c") >= least))
    table = top.toArrow()
    return dict(zip(table["word"].to_pylist(), table["c"].to_pylist()))


def _scorer(exact, total: int, different: int):
    """Per text: tokens, the part of the base score and of the known tokens
    from frequent words, the model's score, and the other words with counts.
    Rows come by slice, its own row first, then the levels of its codes."""
    mass = total + 0.5 * (different + 1)

    def score(own: bytes, levels: list[bytes]) -> pa.RecordBatch:
        texts = pa.ipc.open_stream(own).read_next_batch()
        table = exact.value
        c = Chunk(text_bytes(texts, "text"))
        true = np.array([table.get(w, -1) for w in c.words], dtype=np.int64)
        base = np.where(true >= 0, np.log10((np.maximum(true, 0) + 0.5) / mass), 0.0)
        codes, at = c.codes()
        found = mean_counts(np.frombuffer(b"".join(levels), dtype=np.uint8))
        if len(found) != len(codes):
            raise ValueError(f"{len(found)} levels for {len(codes)} codes")
        one, two = found[at[:len(c.words)]], found[at[len(c.words):]]
        p = (one + 0.5) / mass
        smooth = (two + MU * p[c.ids]) / (np.maximum(one[c.before], two) + MU)
        rest = np.flatnonzero(true[c.ids] < 0)
        row = np.repeat(np.arange(len(c.sizes)), c.sizes)[rest]
        pair, times = np.unique(row * len(c.words) + c.ids[rest], return_counts=True)
        offsets = np.searchsorted(pair, np.arange(len(c.sizes) + 1) * len(c.words))
        rare = pa.StructArray.from_arrays(
            [pa.array(c.words, pa.binary()).take(pa.array(pair % len(c.words))), pa.array(times, pa.int64())],
            names=["word", "times"])
        return pa.record_batch([
            texts.column(texts.schema.get_field_index("row")), texts.column(texts.schema.get_field_index("id")),
            pa.array(c.sizes),
            pa.array(np.add.reduceat(base[c.ids], c.starts)),
            pa.array(np.add.reduceat((true > 0).astype(np.int64)[c.ids], c.starts)),
            pa.array(np.add.reduceat(np.log10(smooth), c.starts)),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare),
        ], names=["row", "id", "n_tokens", "base", "known", "score", "rare"])

    def run(batches):
        own, levels = None, []
        for batch in batches:
            for part, data in zip(values(batch, "part"), values(batch, "data")):
                if part < 0:
                    if own is not None:
                        yield score(own, levels)
                    own, levels = data, []
                else:
                    levels.append(data)
        if own is not None:
            yield score(own, levels)

    return run


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row,
    learnt from the rows outside the held-out fold."""
    spark = docs.sparkSession
    ship.ensure(spark)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    train = slim.where(~held_out(F.col("id")))
    counts, _ = store(word_counts(train), "words")
    total, different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    power = range_power(slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    exact = spark.sparkContext.broadcast(frequent_words(counts))
    sent = slim.withColumn("train", ~held_out(F.col("id"))).withColumn("row", F.monotonically_increasing_id())
    levels = sent.mapInArrow(_sender(power), "slice long, part long, data binary, counts binary").groupBy(
        "part").applyInPandas(_range_levels(power, BITS_PER_ITEM), "slice long, part long, data binary")
    kind = dict(slim.dtypes)["id"]
    part, _ = store(levels.repartition("slice").sortWithinPartitions("slice", "part").mapInArrow(
        _scorer(exact, total, different),
        f"row long, id {kind}, n_tokens long, base double, known long, score double, "
        "rare array<struct<word: binary, times: long>>"), "scored")
    mass = total + 0.5 * (different + 1)
    count = F.coalesce("c", F.lit(0))
    rest = part.select("row", F.inline("rare")).join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((count + 0.5) / mass)).alias("rest"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more"))
    return part.drop("rare").join(rest, "row", "left").select(
        "id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score")
