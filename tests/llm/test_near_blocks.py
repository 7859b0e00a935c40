"""Members of a bucket that do not join up are aligned block by block, not as rows of pairs."""

import random

import numpy as np

from nestmart.llm import order_minhash as om
from nestmart.llm import textbytes as tb


def test_a_group_of_strays_is_not_paired_out(spark, monkeypatch):
    rng = random.Random(2)
    base = ["w%d" % i for i in range(90)]
    rows = []
    for i in range(160):  # alike, but most of them under the threshold
        ws = list(base)
        for k in rng.sample(range(30, 90), 4):
            ws[k] = "x%d" % rng.randrange(10**6)
        rows.append((i, " ".join(ws)))
    rows += [(160, rows[7][1].replace("w0 ", "y0 ")), (161, "apart from all of them"), (162, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, stored = [], om.stored

    def counted(df, tag):
        made.append((tag, (out := stored(df, tag)).count()))
        return out

    monkeypatch.setattr(om, "stored", counted)
    got = {r.doc_id: r.class_id for r in om.near_duplicates(docs, block=16).collect()}
    last = [n for tag, n in made if tag == "omh-pairs"][-1]
    blocks = next(n for tag, n in made if tag == "omh-blocks")
    assert 0 < last < 2000 < 160 * 159 / 2 and last < blocks * blocks

    items = [om._items(next(tb.chunks(docs.where(f"doc_id = {i}").toArrow()["text"].combine_chunks())))[0] for i in range(161)]
    labelled = [om._labelled(x, np.array([0, len(x)])) for x in items]
    root = list(range(161))
    for j in range(161):  # classes by brute force
        for k in range(j):
            if root[j] != root[k] and om.similar(items[j], items[k], labelled[j], labelled[k], 0.8):
                old, new = max(root[j], root[k]), min(root[j], root[k])
                root = [new if x == old else x for x in root]
    assert got == dict(enumerate(root)) | {161: 161, 162: 162}
    assert len(set(root)) > 20  # many stay apart


def test_shared_items():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3], [], [2**63, 5], [3, 9])]
    assert om.shared_items(sets, sets[::-1]).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[::-1]] for a in sets]
    assert om.shared_items(sets[1:2], sets).tolist() == [[0, 0, 0, 0]]
