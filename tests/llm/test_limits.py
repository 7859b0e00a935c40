"""What operators keep, shuffle and leave behind stays small; results stay the same."""

import ctypes
import re

import numpy as np
import pyarrow as pa
import pytest

from nestmart.llm import common, warc, word_ids
from nestmart.llm.memo import Memo
from nestmart.llm.textbytes import chunks


def test_words_met_again_stay_when_the_memo_is_full():
    learnt = []

    def look(memo, names):
        hashes = np.array(names, np.uint64)

        def learn(at):
            learnt.extend(hashes[at].tolist())
            return [((hashes[at] * np.uint64(3)).astype(np.uint32), np.ones(len(at), np.int64))]

        entries = memo.entries_of(hashes, learn)
        flat, counts = memo.pools[0].take(entries)
        assert flat.tolist() == [3 * x for x in names] and counts.tolist() == [1] * len(names)

    memo = Memo([np.uint32], 100)
    for k in range(20):  # 20 words come each time, 30 others once
        look(memo, [*range(1, 21), *range(1000 + 30 * k, 1030 + 30 * k), 7])
        assert memo.n <= 100
    assert sorted(x for x in learnt if x < 1000) == list(range(1, 21))
    look(memo, list(range(1, 300)))  # more at once than the bound
    look(memo, list(range(1, 300)))


def test_a_full_memo_changes_no_ids():
    texts = [" ".join(f"Word{i * 7 % 90} don't {i} тест" for i in range(k, k + 40)) for k in range(60)]
    small, large = word_ids.WordIds(word_ids.vocabulary_path(), 60), word_ids.WordIds(word_ids.vocabulary_path(), 10_000)
    for x in texts:
        for c in chunks(pa.array([x, None, x[:50]])):
            for a, b in zip(small(c), large(c), strict=True):
                assert a.tolist() == b.tolist()


def test_pages_that_come_once_are_not_shuffled(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i % 90}</p>") for i in range(100)] + [(None, "u", "<p>3</p>"), (None, "u", "alone")], "page_id long, url string, html string")
    plan = warc.records(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    got = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to) for r in warc.op7_warc(pages).collect()}
    assert len(got) == 102
    for (i, _), what in got.items():
        if i is not None:
            assert what == (("revisit", i - 90) if i >= 90 else ("response", None))
    assert sorted(str(w) for (i, _), w in got.items() if i is None) == ["('response', None)", "('revisit', 3)"]


def test_stored_leaves_no_shuffle_setting_behind(spark):
    before = spark.conf.get(common._CLEANUP, None)
    seen = []
    with common.shuffles_removed(spark):
        seen.append(spark.conf.get(common._CLEANUP))
    assert seen == ["true"] and spark.conf.get(common._CLEANUP, None) == before
    df = common.stored(spark.range(100).repartition(5, "id").groupBy("id").count(), "t")
    assert df.count() == 100 and df.count() == 100 and spark.conf.get(common._CLEANUP, None) == before


def test_freed_memory_goes_back():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("glibc only")
    used = lambda: int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1]) >> 10  # noqa: E731  MB
    held = [bytes(2000) for _ in range(100_000)]
    held = held[::5000]  # keeps the heap from shrinking by itself
    before = used()
    common.give_back()
    assert before - used() > 100 and len(held) == 20
