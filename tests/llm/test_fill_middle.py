"""Fill-in-the-middle against a plain version, text by text."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from nestmart.llm import fill_middle as fm

SCHEMA = "doc_id long, text string, n long, form string, h1 long"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    t = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(t)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(t), sha(t)
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(t)


def texts():
    rng = random.Random(3)
    alphabet = ["a", "Bc", " ", "\n", "é", "漢", "🙂", "9", "<", "P>", "ß", "zzzz", "\x00", "-"]
    word = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    passage = word(900)
    odd = [None, "", "a", "é", "<P>", "x<S>y", "a<M", "A" * 9000, "🙂" * 3000, ("A" * 5000 + " ") * 3, passage, passage + "q", "q" + passage * 3, "word " * 60_000, "\r\n\t"]
    return odd + [word(rng.randrange(1, 3000)) for _ in range(120)] + [passage[rng.randrange(400) :] + word(200) for _ in range(30)]


@pytest.fixture(scope="module")
def rows():
    made = [(i, t) for i, t in enumerate(texts())]
    return made + [(3, "again"), (3, "again"), (None, "no id"), (None, None), (-7, "below zero and more"), (1 << 60, "a large id here")]


def test_fill_middle_equals_a_plain_version(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in fm.op13_fill_middle(docs).collect()), key=repr)
    assert got == sorted((plain(i, t) for i, t in rows), key=repr)


def test_empty_table(spark):
    assert fm.op13_fill_middle(spark.createDataFrame([], SCHEMA)).collect() == []


def test_dropped_chunks_change_nothing(monkeypatch):
    """Summaries and cuts with a memo that forgets at every call, and with small chunks."""
    every = [t.encode() for t in texts() if t]
    data = np.frombuffer(b"".join(every), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in every])])
    want = [len(UNIT.findall(t.decode())) for t in every]
    for mean, least, most in ((256, 48, 2048), (16, 1, 40)):
        monkeypatch.setattr(fm, "MEAN", mean)
        monkeypatch.setattr(fm, "LEAST", least)
        monkeypatch.setattr(fm, "MOST", most)
        for memo in (fm.Chunks(), fm.Chunks(keep_bytes=0)):
            for _ in range(2):
                rows = fm.Rows(data, offsets, memo)
                assert rows.n.tolist() == want
        for part in (0, 1, 2, 3):  # every unit boundary of some kind
            k = rows.n * part // 3
            byte, char = rows.locate(np.arange(len(every)), k)
            for t, n, at, c in zip(every, k.tolist(), byte.tolist(), char.tolist(), strict=True):
                pre = "".join(UNIT.findall(t.decode())[:n])
                assert (at, c) == (len(pre.encode()), len(pre))


def test_shared_passages_share_chunks():
    memo = fm.Chunks()
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh ,.") for _ in range(20_000)).encode()
    for head in (b"", b"one head ", b"quite another head, longer "):
        t = head + passage
        fm.Rows(np.frombuffer(t, np.uint8), np.array([0, len(t)]), memo)
    assert sum(map(len, memo.known)) < 1.3 * len(passage)
