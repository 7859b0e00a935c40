"""The language model of the quality rules sees every byte of every text, as it is."""

import numpy as np
import pyarrow as pa
import pytest

from nestmart.llm import perplexity
from nestmart.llm.textbytes import chunks

TEXTS = ["Ab", "ab", None, "", "é1", "e2", "x", "Zürich 1848", "zurich 1849", "a" * 50, "naïve\nNAIVE"]


def test_each_byte_has_its_gram():
    for size in (4, 1 << 20):
        got = {}
        for chunk in chunks(pa.array(TEXTS), size):
            code, first = perplexity.gram_codes(chunk)
            got |= {chunk.lo + i: code[first[i] : first[i + 1]].tolist() for i in range(chunk.rows)}
        for i, text in enumerate(TEXTS):
            data = (text or "").encode()
            padded = bytes([perplexity.START]) * 3 + data
            assert got[i] == [int.from_bytes(padded[k : k + 4], "big") for k in range(len(data))], text


@pytest.mark.parametrize("bits", [5, 8])
def test_spark_model_is_the_one_in_process(spark, bits):
    rng = np.random.default_rng(bits)
    want = {}
    rows = []
    for lang, symbols in (("a", 5), ("b", 1 << bits)):
        code, n = np.unique(rng.integers(0, symbols, (3000, 4)) @ ((1 << bits) ** np.arange(3, -1, -1)), return_counts=True)
        rows += [(lang, int(c), float(k)) for c, k in zip(code, n, strict=True)]
        want[lang] = dict(zip(code.tolist(), perplexity.log_probs(perplexity.kneser_ney(code, n, bits), code, bits), strict=True))
    got = perplexity.log_p(spark.createDataFrame(rows, "lang string, code long, n double"), bits).collect()
    assert len(got) == len(rows)
    assert all(abs(r.log_p - want[r.lang][r.code]) < 1e-4 for r in got)


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint32))
    logs = -rng.random((len(code), 2), np.float32) - 1
    table = perplexity.Table(code, logs)
    assert np.array_equal(table(code), logs)
    assert not table((code + np.uint32(1))[~np.isin(code + np.uint32(1), code)]).any()
    assert not perplexity.Table(code[:0], logs[:0])(code).any()


def test_sliced_models_and_early_sums_change_no_score(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, lang string")
    whole = sorted(perplexity.score(docs).collect(), key=lambda r: r.doc_id)
    monkeypatch.setattr(perplexity, "BROADCAST_BYTES", 30 * perplexity.GRAM_BYTES)
    monkeypatch.setattr(perplexity, "HELD", 8)
    sliced = sorted(perplexity.score(docs).collect(), key=lambda r: r.doc_id)
    assert len(whole) == len(sliced) == len(TEXTS) * 2
    for a, b in zip(whole, sliced, strict=True):
        assert a[:8] == b[:8]
        assert (a.log_ppl is None) == (not (TEXTS * 2)[a.doc_id])  # texts under four bytes have one, too
        assert all(x is y is None or abs(x - y) < 1e-6 for x, y in zip(a[8:], b[8:], strict=True))


def test_case_digits_and_accents_are_told_apart(spark):
    words = "the quiet river runs past an old mill and small town of wells where seven bells ring at noon".split()
    rng = np.random.default_rng(4)
    some = lambda n: " ".join(rng.choice(words, n))
    text = some(60)
    odd = {1: text, 2: text.upper(), 3: text.replace("e", "é"), 4: text.replace("t", "7")}
    docs = spark.createDataFrame([(100 + i, some(60), "en") for i in range(60)] + [(i, t, "en") for i, t in odd.items()], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in perplexity.score(docs).where("doc_id < 100").collect()}
    assert all(got[i].log_ppl > 1.02 * got[1].log_ppl for i in (2, 3, 4)), got
    assert abs(got[1].class_log_ppl - got[2].class_log_ppl) < 1e-6  # the same text to the classes
