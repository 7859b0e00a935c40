"""Token files: codes against a plain coder, the whole operator against the tokenizer."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from nestmart.llm import token_store as ts
from nestmart.llm.memo import Memo
from nestmart.llm.textbytes import chunks
from nestmart.llm.word_ids import WordIds, vocabulary_path
from nestmart.session import scratch_path

SCHEMA = "doc_id long, text string, ids int, start int, shard string"
TOKENIZER = Tokenizer.from_file(vocabulary_path())


def odd_texts():
    rng = random.Random(0)
    letters = "aB'sStT1é ñ.-<|>́ Σ漢 \t²ſKŉ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    fixed = ["Don't it's we'LL they'd'nt 'S", "<|endoftext|> x<|startoftext|>y <|end", "İstanbul Straße ǅ ŉ ²³ ªº ½ «x»", "éa café ẞ ΣΑΣ", "a b c\x1cd\x85e", "漢字かな 🙂🙂", "x" * 3000, "", None, "   \n", "\x00\x01 \x7f"]
    return fixed + made


def expected(rows):
    """Rows in file order with their ids; rows of one id may come in any order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_codes_round_trip():
    rng = np.random.default_rng(1)
    for top in (1, 255, 256, 65536, 1 << 24, (1 << 32) - 1):
        for n in (0, 1, 3, 4, 5, 1001):
            v = rng.integers(0, top, n, dtype=np.uint64, endpoint=True).astype(np.uint32)
            control, data = ts.pack_codes(v)
            size = [max(1, (int(x).bit_length() + 7) // 8) for x in v]
            assert len(control) == -(-n // 4) and data == b"".join(int(x).to_bytes(s, "little") for x, s in zip(v, size, strict=True))
            got = ts.unpack_codes(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
            assert got.tolist() == v.tolist()


def test_word_ids_equal_the_tokenizer():
    texts = [t or "" for t in odd_texts()]
    encode = WordIds(vocabulary_path())
    encode.memo = Memo([np.uint32], entries=50)  # forgets all the time
    for _ in range(2):
        for run in chunks(pa.array(texts), 2000):
            ids, counts = encode(run)
            cuts = np.cumsum(counts)[:-1]
            want = [TOKENIZER.encode(t, add_special_tokens=False).ids for t in texts[run.lo : run.hi]]
            assert [x.tolist() for x in np.split(ids, cuts)] == want


def test_whole_operator(spark):
    rows = [(i * 7 - 100, t) for i, t in enumerate(odd_texts())] + [(None, "no id at all"), (5000, "word " * 30_000)]
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in ts.op12_token_store(docs).collect()), key=repr) == sorted(expected(rows), key=repr)


def test_blocks_ranks_and_repeated_ids(spark):
    rows = [(9, "same words here")] * 40 + [(9, f"other words {i}") for i in range(40)] + [(i, "the the the a") for i in range(30)]
    path = scratch_path(spark, "token-store-test")
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA).repartition(6)
    ts.write_ids(docs, path, block_ids=50, blocks_per_file=2)
    got = [tuple(r) for r in ts.read_ids(spark, path).orderBy("start").collect()]
    assert len(got) == len(rows) and [r[0] for r in got] == sorted(r[0] for r in rows)
    start = 0
    for _, at, n, ids in got:
        assert at == start and len(ids) == 4 * n
        start += n
    want = sorted((i, tuple([*TOKENIZER.encode(t).ids, 1])) for i, t in rows)
    assert sorted((i, tuple(np.frombuffer(ids, "<u4").tolist())) for i, _, _, ids in got) == want
    flat = np.concatenate([np.frombuffer(r[3], "<u4") for r in got])
    ids, n = np.unique(flat, return_counts=True)
    assert ts.read_ranks(spark, path).tolist() == ids[np.lexsort([ids, -n])].tolist()
    files = spark.read.format("binaryFile").load(f"{path}/blocks").count()
    assert files > 1


def test_empty_table(spark):
    assert ts.op12_token_store(spark.createDataFrame([], SCHEMA)).collect() == []


def test_damage_is_found():
    block = ts.make_block(0, 0, [1, None], [2, 1], np.array([5, 300, 7]))
    assert [h[4] for h in ts.heads(memoryview(block + b"\n"))] == [3]
    with pytest.raises(ValueError):
        list(ts.heads(memoryview(block)))
    with pytest.raises(ValueError):
        list(ts.heads(memoryview(b"X" + block[1:] + b"\n")))
