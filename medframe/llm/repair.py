"""Structure repair of conversations: the cheapest edits that make the roles of
a conversation an optional system turn followed by pairs of user and assistant.

Edits per row, in order: keep (K, free), re-role to user or assistant (R, 2),
delete (D, 3; required for blank rows and for those whose role and text were
seen before); an empty user or assistant turn may be inserted anywhere (I, 2). A
row that stays although it does not end in ``.``, ``!`` or ``?`` costs 1. Of the
cheapest scripts the one whose letters sort first (ASCII) is taken.

*Four-Russians block tables.* What the rest of a conversation costs from each of
the four places of the pattern (nothing yet, after system, after user, after
assistant) is a vector. Inserting bounds how far its entries lie apart, so with
the smallest taken off only some dozens of vectors exist. For every vector and
every block of ``BLOCK`` row symbols a table holds the vector before the block and
the cost added. A conversation is worked from its end, a lookup per block, keeping
the vector at each block's end. Then its blocks are expanded in order: the vectors
inside a block are computed backward from its end, and the first letter that
still meets the cost to the end is taken, so ties are decided exactly.

*Spark.* Rows are reduced to a role, a digest of the text and flags; equal rows of
a turn become one with a count (summed before the shuffle), and the first
occurrence of a role and text is found by a minimum and a join on whole keys, so no
group of copies meets in one task. Then the texts are shuffled, once: by
conversation, sorted, each conversation's slim rows before its texts. A task
reads a conversation's slim rows (held as a byte each, like the script it
returns), finds the script, and streams the texts through it. A conversation stays
in one task since its digest is a sequential hash and its script one value; its
texts are never held together.

Edge cases: null roles and texts are one space (a blank text; a role that only
Rerole mends). Rows are ordered by turn (null first), then role, then the text's
SHA-256; equal rows are interchangeable. Null conversation ids are one
conversation. Other columns are not read. A conversation without rows gives zeros,
an empty script and the hash of the empty string; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medframe import ship
from medframe.llm.batches import slices, values

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"

# Places of the pattern: nothing yet, after system, after user, after assistant.
PLACES = 4
NEXT = (2, 2, 3, 2)             # place after a user or assistant turn, whichever fits
END = (0, 4, 2, 0)              # cost of ending here: turns still to be inserted
NAMES = {2: "user", 3: "assistant"}
# Symbols of rows: 0 must go; else 1 + 2 * role + (1 if truncated).
SYSTEM, USER, ASSISTANT, OTHER = range(4)
SYMBOLS = 9
BLOCK = 4
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _kept(place: int, role: int) -> int | None:
    """Place after keeping a turn of this role."""
    if role == SYSTEM:
        return 1 if place == 0 else None
    if role == OTHER or NEXT[place] != (2 if role == USER else 3):
        return None
    return NEXT[place]


def _options(place: int, symbol: int, after: tuple) -> Iterator[tuple[str, int, int]]:
    """(letter, cost to the end, next place) of the edits of a row."""
    yield "D", DELETE + after[place], place
    if symbol:
        role, cut = divmod(symbol - 1, 2)
        kept = _kept(place, role)
        if kept is not None:
            yield "K", KEEP + cut * TRUNCATED + after[kept], kept
        yield "R", REROLE + cut * TRUNCATED + after[NEXT[place]], NEXT[place]


def _before(after: tuple, symbol: int) -> tuple:
    """Costs to the end before a row, from those after it."""
    best = [min(cost for _, cost, _ in _options(p, symbol, after)) for p in range(PLACES)]
    u, a = best[2], best[3]
    best[2], best[3] = min(u, INSERT + a), min(a, INSERT + u)
    for p in (0, 1):
        best[p] = min(best[p], INSERT + best[2])
    return tuple(best)


class Tables:
    """All normalised vectors, and the transitions of single symbols and blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[tuple] = []
        number: dict[tuple, int] = {}

        def known(vector):
            if vector not in number:
                number[vector] = len(self.vectors)
                self.vectors.append(vector)
            return number[vector]

        known(END)
        step, add = [], []
        while len(step) < len(self.vectors):
            rows = [_before(self.vectors[len(step)], s) for s in range(SYMBOLS)]
            add.append([min(r) for r in rows])
            step.append([known(tuple(x - min(r) for x in r)) for r in rows])
        self.step, self.add = step, add
        one, cost = np.array(step), np.array(add)
        to, total = one, cost
        for _ in range(block - 1):  # a symbol in front of every shorter block
            total = (total[:, None, :] + cost[to].transpose(0, 2, 1)).reshape(len(one), -1)
            to = one[to].transpose(0, 2, 1).reshape(len(one), -1)
        self.to, self.total = to.tolist(), total.tolist()

        @functools.lru_cache(maxsize=1 << 16)
        def expand(vector: int, symbols: bytes, place: int) -> tuple[str, int]:
            """The letters of a block whose end has ``vector``, entered at
            ``place``, and the place where it is left."""
            inside = [vector]
            for s in reversed(symbols):
                inside.append(step[inside[-1]][s])
            inside.reverse()
            letters = []
            for i, s in enumerate(symbols):
                place = self._inserted(inside[i], inside[i + 1], s, place, letters)
            return "".join(letters), place

        self.expand = expand

    def _inserted(self, before: int, after: int, symbol: int, place: int, letters: list) -> int:
        """Take the first letters that meet the cost, up to the row's own."""
        base = self.add[after][symbol]
        here, there = self.vectors[before], self.vectors[after]
        while True:
            options = [(letter, cost, to) for letter, cost, to in _options(place, symbol, there)
                       if cost == here[place] + base]
            if INSERT + here[NEXT[place]] == here[place]:
                options.append(("I", 0, NEXT[place]))
            letter, _, place = min(options)
            letters.append(letter)
            if letter != "I":
                return place

    def script(self, symbols: bytes) -> tuple[int, str]:
        """(cost, letters) of the cheapest edits, first in ASCII order."""
        whole = len(symbols) - len(symbols) % self.block
        vector, cost = 0, 0
        for s in reversed(symbols[whole:]):
            cost += self.add[vector][s]
            vector = self.step[vector][s]
        ends = []
        powers = SYMBOLS ** np.arange(self.block - 1, -1, -1)
        codes = np.frombuffer(symbols[:whole], dtype=np.uint8).reshape(-1, self.block) @ powers
        for code in codes[::-1].tolist():
            ends.append(vector)
            cost += self.total[vector][code]
            vector = self.to[vector][code]
        cost += self.vectors[vector][0]
        letters, place = [], 0
        for i in range(0, whole, self.block):
            part, place = self.expand(ends.pop(), symbols[i:i + self.block], place)
            letters.append(part)
        part, place = self.expand(0, symbols[whole:], place)
        letters.append(part + "I" * (END[place] // INSERT))
        return cost, "".join(letters)


@functools.cache
def tables() -> Tables:
    return Tables()


def _edited(letters: Iterator[str], place: int, role: str, text: bytes):
    """Apply the letters up to a row's own: (place, [(letter, role, text)])."""
    out = []
    for letter in letters:
        if letter == "D":
            out.append(("D", role, text))
            return place, out
        to = 1 if letter == "K" and place == 0 and role[:1] == "s" else NEXT[place]
        if letter == "I":
            out.append(("I", NAMES[to], b""))
        else:
            out.append((letter, role if letter == "K" else NAMES[to], text))
        place = to
        if letter != "I":
            break
    return place, out


class _Conversation:
    """Slim rows first, then the texts."""

    def __init__(self, conv):
        self.conv = conv
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.role = self.low = self.high = None
        self.letters = None

    def add(self, turn, role: int, first: bool, blank: bool, cut: bool, n: int) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        fresh = first and not blank
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - fresh
        self.truncated += fresh and cut
        self.illegal += n - 1 + (self.role is not None and (self.role, role) not in LEGAL)
        self.role = role
        self.symbols += bytes([1 + 2 * role + cut if fresh else 0]) + bytes(n - 1)

    def solve(self) -> None:
        self.cost, self.audit = tables().script(bytes(self.symbols))
        self.letters, self.place = iter(self.audit), 0

    def text(self, role: str, text: bytes) -> list:
        if self.letters is None:
            self.solve()
        self.place, out = _edited(self.letters, self.place, role, text)
        return out

    def rest(self) -> list:
        """Turns inserted after the last row."""
        if self.letters is None:
            self.solve()
        self.place, out = _edited(self.letters, self.place, "", b"")
        return out

    @property
    def gaps(self) -> int:
        return 0 if self.high is None else self.high - self.low + 1 - self.turns


def _stream(batches):
    """(conversation, edits) of sorted rows; ends each with (conversation, None)."""
    now = None
    for part in slices(batches, "text"):
        columns = [values(part, c) for c in ("conv", "rank", "turn", "role", "class", "first", "blank", "cut", "n", "text")]
        for conv, rank, turn, role, kind, first, blank, cut, n, text in zip(*columns):
            if rank == 0:
                if now is not None:
                    yield now, now.rest()
                    yield now, None
                now = _Conversation(conv)
            elif rank == 1:
                now.add(turn, kind, first, blank, cut, n)
            else:
                yield now, now.text(role, text)
    if now is not None:
        yield now, now.rest()
        yield now, None


def _sorted(rows: DataFrame, ids: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Conversation ids (rank 0), slim rows (1) and texts (2), by conversation."""
    def one_space(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       one_space(role_col).alias("role"), one_space(text_col).alias("text"))
    rows = rows.withColumn("hash", F.unhex(F.sha2("text", 256)))
    initial = F.substring("role", 1, 1)
    bare = F.rtrim("text", F.lit(SPACES))
    slim = rows.select("conv", "turn", "role", "hash", (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    slim = slim.groupBy("conv", "turn", "role", "hash").agg(
        F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    firsts = slim.groupBy("conv", "role", "hash").agg(F.min(F.struct("turn")).alias("at"))  # null turns first
    firsts = firsts.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h"),
                           F.col("at.turn").alias("t"), F.lit(True).alias("first"))
    same = [slim[x].eqNullSafe(firsts[y]) for x, y in (("conv", "c"), ("turn", "t"), ("role", "r"), ("hash", "h"))]
    slim = slim.join(firsts.hint("merge"), same, "left")
    no = F.lit(None)
    rank = [ids.select(F.col(conv_col).alias("conv")).distinct().select(
                "conv", F.lit(0).alias("rank"), no.cast("long").alias("turn"), no.cast("string").alias("role"),
                no.cast("binary").alias("hash"), no.cast("int").alias("class"), no.cast("boolean").alias("first"),
                no.cast("boolean").alias("blank"), no.cast("boolean").alias("cut"), no.cast("long").alias("n"),
                no.cast("binary").alias("text")),
            slim.select("conv", F.lit(1), "turn", "role", "hash",
                        F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
                        .otherwise(OTHER), F.coalesce("first", F.lit(False)), "blank", "cut", "n", no.cast("binary")),
            rows.select("conv", F.lit(2), "turn", "role", "hash", no.cast("int"), no.cast("boolean"), no.cast("boolean"),
                        no.cast("boolean"), no.cast("long"), F.col("text").cast("binary"))]
    return (rank[0].unionAll(rank[1]).unionAll(rank[2]).repartition("conv")
            .sortWithinPartitions("conv", "rank", F.col("turn").asc_nulls_first(), "role", "hash"))


def _repaired(run, schema: str, rows: DataFrame, ids: DataFrame | None, columns: tuple) -> DataFrame:
    ship.ensure(rows.sparkSession)
    ids = rows if ids is None else ids
    kind = ids.schema[columns[0]].dataType.simpleString()
    return _sorted(rows, ids, *columns).mapInArrow(run, f"conv {kind}, {schema}")


COLUMNS = ("conv_id", "turn", "role", "text")
FLUSH_BYTES, FLUSH_ROWS = 1 << 20, 4096


def turns(rows: DataFrame, ids: DataFrame | None = None, columns: tuple = COLUMNS) -> DataFrame:
    """The repaired turns and the edits that gave them: ``conv, place, edit, role,
    text`` (``place`` counts a conversation's edits; deleted rows are included, with
    their letter). ``columns``: names of conversation, turn, role and text."""
    def run(batches):
        names = ["conv", "place", "edit", "role", "text"]
        conv_type = None
        held, size, place, last = [], 0, 0, None

        def out():
            conv, at, edit, role, text = zip(*held)
            return pa.record_batch([pa.array(conv, conv_type), pa.array(at, pa.int64()), pa.array(edit, pa.string()),
                                    pa.array(role, pa.string()), pa.array([t.decode() for t in text], pa.string())],
                                   names=names)

        def typed():
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        for now, edits in _stream(typed()):
            if now is not last:
                place, last = 0, now
            for edit, role, text in edits or ():
                held.append((now.conv, place, edit, role, text))
                place += 1
                size += len(text)
            if held and (size >= FLUSH_BYTES or len(held) >= FLUSH_ROWS):
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return _repaired(run, "place long, edit string, role string, text string", rows, ids, columns)


def report(rows: DataFrame, ids: DataFrame | None = None, columns: tuple = COLUMNS) -> DataFrame:
    """Per conversation of ``ids`` (default: of ``rows``): ``gaps, blank, duplicate,
    truncated, illegal, cost, audit`` and the hash of its repaired turns."""
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches):
        conv_type = None
        held = []
        digest, some = hashlib.sha256(), False

        def out():
            conv, *rest = zip(*held)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            return pa.record_batch([pa.array(conv, conv_type), *map(pa.array, rest, kinds)], names=["conv", *names])

        def typed():
            nonlocal conv_type
            for batch in batches:
                conv_type = batch.schema.field("conv").type
                yield batch

        size = 0
        for now, edits in _stream(typed()):
            for edit, role, text in edits or ():
                if edit != "D":
                    digest.update((b"\n" if some else b"") + role.encode() + b":")
                    digest.update(text)
                    some = True
            if edits is None:
                held.append((now.conv, now.gaps, now.blank, now.duplicate, int(now.truncated), now.illegal, now.cost,
                             now.audit, digest.hexdigest()))
                digest, some = hashlib.sha256(), False
                size += len(now.audit)
                if size >= FLUSH_BYTES or len(held) >= FLUSH_ROWS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    ddl = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in names)
    return _repaired(run, ddl, rows, ids, columns)


def damage(rows: DataFrame, columns: tuple = COLUMNS) -> DataFrame:
    """Rows with the faults that a hash of conversation and turn picks: of 20
    values 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats it, 4
    makes it a user's. Nulls are one space in texts, roles and the hash."""
    conv, turn, role, text = columns

    def one_space(name) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    pick = F.crc32(F.concat(one_space(conv), F.lit(":"), one_space(turn)).cast("binary")) % 20
    times = F.when(pick == 0, 0).when(pick == 3, 2).otherwise(1)
    out = rows.select(
        conv, turn, F.when(pick == 4, "user").otherwise(one_space(role)).alias(role),
        F.when(pick == 1, "").when(pick == 2, F.translate(one_space(text), ".!?", "")).otherwise(one_space(text)).alias(text),
        F.explode(F.array_repeat(F.lit(0), times)).alias("__copy"))
    return out.drop("__copy")
