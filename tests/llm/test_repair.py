"""Conversation repair against exhaustive scripts and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from medframe.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, rank int, n long, first boolean"
LETTERS = {repair.SYSTEM: "s", repair.USER: "u", repair.ASSISTANT: "a", repair.OTHER: "x"}


def exhaustive(symbols):
    """Cheapest (cost, letters) over all scripts with up to two inserted turns in a gap."""
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    best = None
    rows = []
    for s in symbols:
        role, cut = (None, 0) if s == 0 else divmod(s - 1, 2)
        own = [("D", 3, "")]
        if s:
            own += [("K", cut, LETTERS[role]), ("R", 2 + cut, "u"), ("R", 2 + cut, "a")]
        rows.append(own)
    for fill in itertools.product(gaps, repeat=len(symbols) + 1):
        for edits in itertools.product(*rows):
            roles, letters, cost = "", "", 0
            for i, g in enumerate(fill):
                roles, letters, cost = roles + "".join(g), letters + "I" * len(g), cost + 2 * len(g)
                if i < len(edits):
                    letters, cost, roles = letters + edits[i][0], cost + edits[i][1], roles + edits[i][2]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best):
                best = cost, letters
    return best


def plain(symbols):
    """The same a row at a time: the least (cost, letters) per place, forward."""
    none = (10 ** 9, "~")

    def put(x, letters, cost):
        return x[0] + cost, x[1] + letters

    def filled(z, s, u, a):
        return [z, s, min(u, put(z, "I", 2), put(s, "I", 2), put(a, "I", 2)),
                min(a, put(u, "I", 2), put(z, "II", 4), put(s, "II", 4))]

    at = filled((0, ""), none, none, none)
    for x in symbols:
        role, cut = (None, 0) if x == 0 else divmod(x - 1, 2)
        to = [[put(p, "D", 3)] for p in at]
        if x:
            if role == repair.SYSTEM:
                to[1].append(put(at[0], "K", cut))
            for place, froms, own in ((2, (0, 1, 3), repair.USER), (3, (2,), repair.ASSISTANT)):
                for f in froms:
                    to[place].append(put(at[f], "R", 2 + cut))
                    if role == own:
                        to[place].append(put(at[f], "K", cut))
        at = filled(*map(min, to))
    return min(at[0], at[3])


@pytest.mark.parametrize("n", range(4))
def test_scripts_equal_all_scripts(n):
    cases = list(itertools.product(range(repair.SYMBOLS), repeat=n)) if n < 3 else [
        tuple(random.Random(i).choices(range(repair.SYMBOLS), k=3)) for i in range(4)]
    for symbols in cases:
        assert repair.tables().script(bytes(symbols)) == exhaustive(symbols) == plain(symbols)


@pytest.mark.parametrize("block", [1, 3, 4])
def test_blocks_equal_plain_rows(block):
    tables, rng = repair.Tables(block), random.Random(block)
    for n in [*range(20)] * 20 + [500]:
        symbols = bytes(rng.choices(range(repair.SYMBOLS), k=n))
        assert tables.script(symbols) == plain(symbols)


def key(x):
    return x is not None, 0 if x is None else x


def brute(rows, ids):
    """What ``report`` returns, by plain Python."""
    out = {}
    for conv in ids:
        mine = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (key(m[0]), m[1].encode(), hashlib.sha256(m[2].encode()).digest()))
        seen, symbols, faults = set(), [], [0, 0, 0]
        for t, r, x in mine:
            bare = x.rstrip(" \t\n\v\f\r")
            cut = bare[-1:] not in (".", "!", "?")
            fault = 0 if not bare else 1 if (r, x) in seen else 2 if cut else None
            seen.add((r, x))
            if fault is not None:
                faults[fault] += 1
            symbols.append(0 if fault in (0, 1) else 1 + 2 * {"s": 0, "u": 1, "a": 2}.get(r[:1], 3) + cut)
        known = {t for t, _, _ in mine if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = plain(symbols)
        lines, left = [], iter(mine)
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(left)[1:]
            if letter != "D":
                place = "s" if lines and lines[0].startswith("s") and len(lines) == 1 else lines[-1][0] if lines else ""
                fit = "assistant" if place == "u" else "user"
                lines.append(f"{role if letter == 'K' else fit}:{text}")
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "So?\n", "and then", "", " \t", None, "Well. ", "é…", "Ja. \x0b"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "agent"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts))
            for c in range(120) for _ in range(rng.randrange(9))]
    rows += [(None, 1, "user", "A."), (None, 2, "assistant", "B."), (500, None, None, None), (501, 3, "user", "x" * 200_000)]
    rows += [(502, t % 7, "user", "Same.") for t in range(300)]           # one turn, many copies
    rows += [(503, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(3000)]  # a long conversation
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, True) for r in rows], SCHEMA)


def test_report_equals_plain(spark):
    rows = conversations()
    got = {r[0]: tuple(r)[1:] for r in repair.report(frame(spark, rows).repartition(7)).collect()}
    assert got == brute(rows, {r[0] for r in rows})


def test_turns_are_what_the_report_hashes(spark):
    rows = conversations()
    df = frame(spark, rows)
    hashes = {r["conv"]: r["repaired_sha256"] for r in repair.report(df).collect()}
    lines = {c: [] for c in hashes}
    for r in sorted(repair.turns(df).collect(), key=lambda r: r["place"]):
        if r["edit"] != "D":
            lines[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()} == hashes


def test_damage_and_dropped_conversations(spark):
    rows = [r for r in conversations() if r[0] is None or r[0] < 60 or r[0] in (500, 502)]
    rows += [(c, 0, "user", "Hm.") for c in range(1000, 1100)]  # some lose their only row
    out = []
    for c, t, r, x in rows:
        r, x = r if r is not None else " ", x if x is not None else " "
        pick = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if pick == 1 else re.sub("[.!?]", "", x) if pick == 2 else x
        out += [(c, t, "user" if pick == 4 else r, x)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    df = frame(spark, rows)
    damaged = repair.damage(df)
    assert sorted(map(str, damaged.collect())) == sorted(map(str, frame(spark, out).select("conv_id", "turn", "role", "text").collect()))
    got = {r[0]: tuple(r)[1:] for r in repair.report(damaged, df).collect()}
    assert got == brute(out, {r[0] for r in rows})
    empty = [v for c, v in got.items() if c not in {o[0] for o in out}]
    assert empty and set(empty) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_text_ids_and_empty_tables(spark):
    df = spark.createDataFrame([("b", 1, "user", "Hi."), ("a", None, "bot", None)], "conv_id string, turn int, role string, text string")
    got = {r["conv"]: r["audit"] for r in repair.report(df).collect()}
    assert got == {"a": "D", "b": "KI"}
    assert repair.report(df.where("false")).collect() == [] and repair.turns(df.where("false")).collect() == []
