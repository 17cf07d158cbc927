"""The encoder's slices and what it remembers between them; no session needed."""

import gc
import hashlib

import pyarrow as pa

from medframe.llm import bpe

RANKS = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257, b" a": 258, b"ab": 259, "é".encode(): 260}


class Shared:
    value = RANKS


def digests(texts, monkeypatch, **bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(bpe, name, value)
    seen = []

    def make(text, pieces):
        seen.append(gc.isenabled())
        return bpe._digests(text, pieces)

    run = bpe._run(Shared, r" ?\w+|\s|[^\s\w]+", "text", make, ["n", "ids", "decoded"], [pa.int64(), pa.string(), pa.string()])
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    return [tuple(r.values()) for out in run(iter([batch])) for r in out.drop_columns(["text"]).to_pylist()], seen


def test_slices_and_forgetting_change_no_result(monkeypatch):
    texts = ["the abé ab", None, "", "the " + "ab" * 60, "the other abab", "été the ab", "ab" * 60 + "!?"] * 3
    whole, _ = digests(texts, monkeypatch)
    parts, _ = digests(texts, monkeypatch, SLICE_BYTES=16, CACHED_PIECES=2)
    assert whole == parts
    assert [w[2] for w in whole] == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
    assert whole[0][0] == 6 and whole[0][1] == hashlib.sha256(b"257,258,98,260,258,98").hexdigest()
    monkeypatch.undo()
    encoder = bpe._encoder(Shared, r" ?\w+|\s|[^\s\w]+")
    encoder(["the " + "ab" * 60])
    assert "the" in encoder.young and max(map(len, encoder.young)) <= bpe.SHORT_PIECE


def test_no_cycles_are_looked_for_while_encoding(monkeypatch):
    _, seen = digests(["the ab"], monkeypatch)
    assert seen == [False] and gc.isenabled()
