"""Alignment against a plain version that encodes whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from nestmart.llm import token_align as ta

SCHEMA = "doc_id long, text string, block int, pairs string, groups long"
PATH_A, PATH_B = ta.default_paths()
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
T = ta.Tokenizers(PATH_A, PATH_B)


def groups_of(text):
    if not text:
        return []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    size_a, size_b = [T.bytes_a[i] for i in a], [T.bytes_b[i] for i in b]
    if not (b"".join(size_a) == b"".join(size_b) == (" " + text).encode()):
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in size_a]), np.cumsum([len(x) for x in size_b])
    cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    out, x, y = [], 0, 0
    for c in cuts:
        i, j = int(np.searchsorted(ends_a, c)) + 1, int(np.searchsorted(ends_b, c)) + 1
        out.append((a[x:i], b[y:j]))
        x, y = i, j
    return out


def expected(rows):
    groups = [groups_of(t) for _, t in rows]
    docs = Counter(p for g in groups for p in {(x, y) for a, b in g for x in a for y in b})
    top = defaultdict(int)
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), g in zip(rows, groups, strict=True):
        links = [(x, y) for a, b in g for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sha = hashlib.sha256(text.encode()).hexdigest() if g else ""
        out.append((doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links), sum(docs[p] == top[p[0]] for p in links), sum(docs[p] for p in links), sha))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(8)
    letters = ["a", "the", "ing", " ", "  ", "\n", "é", "漢字", "🙂", "123", ".", "'s", "\t", " ", "　", " ", "ø", "-", "ß", "\x1c", "\x85", "<|endoftext|>", "</s>", "à", "<0x41>"]
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    words = ["".join(rng.choice("aeioudnrst") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) + rng.choice(["", ".", " ", "\n", "  "]) for _ in range(60)]
    odd = [None, "", " ", "  ", "\n", "a ", " a", "x▁y ok", "\x00", "=" * 700, "漢" * 500, "no" * 2000, "ab ab  ab\n\nab", "tail \n", "é é ﬁ"]
    return odd + made + prose + ["word and more " * 12_000]


@pytest.fixture(scope="module")
def rows():
    made = list(enumerate(texts()))
    return made + [(3, "same text twice"), (3, "same text twice"), (None, "no id"), (None, None)]


def test_units_do_not_change_the_ids():
    for part in (texts(), texts()[::-1]):
        for rows in ta.chunks(pa.array(["" if not t else " " + t for t in part]), 3000):
            lists = T(rows)
            for i, t in enumerate(part[rows.lo : rows.hi]):
                ok = bool(groups_of(t))
                assert lists[0][i].as_py() == (A.encode(" " + t, add_special_tokens=False).ids if ok else [])
                assert lists[1][i].as_py() == (B.encode(t) if ok else [])


def test_whole_operator(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(5)
    got = ta.op11_token_align(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_small_blocks(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(3)
    aligned = ta.stored(ta.align(docs, block_bytes=2000).withColumn("groups_sha256", ta.F.lit("")).drop("groups"), "align-test")
    assert aligned.where("pairs is not null").count() > 10
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_best, r.count_sum) for r in ta.with_scores(aligned, ta.pair_counts(aligned)).collect())
    assert got == sorted((w[0] is None, w[0] or 0, w[5], w[6]) for w in expected(rows))


def test_long_groups_cost_distinct_ids():
    """One group of 3,000 x 2,000 tokens with few distinct ids, joined in slices."""
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 40, 3000), rng.integers(0, 30, 2000)
    zero = lambda n: np.zeros(n, np.int64)
    for limit in (100, 10**6):
        got = ta.id_pairs(zero(3000), pa.array(a), zero(2000), pa.array(b), zero(1), limit)
        want = {(int(x) << 32) + int(y): int((a == x).sum() * (b == y).sum()) for x in set(a) for y in set(b)}
        assert dict(zip(got["pair"].to_pylist(), got["times"].to_pylist(), strict=True)) == want


def test_empty_table(spark):
    assert ta.op11_token_align(spark.createDataFrame([], SCHEMA)).collect() == []
