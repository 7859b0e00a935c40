"""Links between lines of different token sets are all counted, also in large groups."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from nestmart.llm import line_dedup


def test_every_link_is_counted_in_a_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join([*words, f"odd{i}"])) for i in range(60)] + [(60, "a line apart from all"), (61, None), (62, " ".join([*words, "odd0"]) + "\n" + "once more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(f"SELECT doc_id, n_links FROM ({line_dedup.SQL}) x ORDER BY doc_id").fetchall()
    assert [n for _, n in want] == [59] * 60 + [0, 0, 59]  # 60 sets, each like the 59 others
    for found in (line_dedup.op6_line_dedup(docs), line_dedup.by_document(docs, *line_dedup.find_lines(docs, light=0))):
        assert sorted((r.doc_id, r.n_links) for r in found.collect()) == want


def _near_copies(n, seed=3):
    rng = random.Random(seed)
    lines = []
    for i in range(n):
        line = [f"{'ab'[i % 2]}{k}" for k in range(20)]
        for _ in range(rng.randrange(4)):
            line[rng.randrange(20)] = f"x{rng.randrange(40)}"
        lines.append(" ".join(line))
    return lines


def test_no_table_has_a_row_for_each_link(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join([*(f"w{k}" for k in range(20)), f"odd{i}"])) for i in range(400)], "doc_id long, text string")
    rows, stored = {}, line_dedup.stored

    def counted(df, tag):
        out = stored(df, tag)
        rows[tag] = max(out.count(), rows.get(tag, 0))
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    assert {r.n_links for r in line_dedup.op6_line_dedup(docs).collect()} == {399}
    assert max(rows.values()) < 400 * 399 // 2 / 4, rows


@pytest.mark.parametrize(("block", "cell", "few", "step"), [(200_000, 4096, 32, 512), (200_000, 4096, 0, 7), (40, 8, 32, 512), (40, 16, 0, 5), (200_000, 16, 8, 512)])
def test_links_of_cells_against_brute_force(spark, block, cell, few, step):
    lines = _near_copies(120)
    sets = {frozenset(x.split()): i for i, x in reversed(list(enumerate(lines)))}  # first line of each
    want = {i: sorted(j for y, j in sets.items() if i != j and 5 * len(x & y) >= 4 * len(x | y)) for x, i in sets.items()}
    counts = np.full(line_dedup.BUCKETS, 100, np.int64)
    packed = line_dedup.index(spark.createDataFrame([(x,) for x in lines], "text string").coalesce(1), counts, 0.8, block, 1).collect()
    entries = line_dedup._once(np.frombuffer(b"".join(bytes(r.entries) for r in packed), line_dedup.ENTRY))
    groups, at = np.unique(entries["group"], return_inverse=True)
    least = np.full(len(groups), np.iinfo(np.int64).max)
    np.minimum.at(least, at, entries["h1"])
    members = pa.Table.from_batches(list(line_dedup._cells(entries, least[at], 1, cell, at_once=50)))
    chunk = next(line_dedup.tb.chunks(pa.array(lines)))
    ls = line_dedup._Lines(chunk)
    h1, h2 = ls.names()
    first = sorted(sets.values())
    bodies = pa.table({"h1": h1[first], "h2": h2[first], "tokens": [ls.token[ls.first[i] : ls.first[i + 1]].tobytes() for i in first], "doc_id": pa.array(first, pa.int64()), "number": pa.array([0] * len(first), pa.int32())})
    both = pa.concat_tables([members, bodies], promote_options="default")
    got = pa.Table.from_batches(list(line_dedup._links_of_task(both.to_batches(), counts, 0.8, few, step))).to_pylist()
    doc = {h: i for h, i in zip(h1[first].tolist(), first, strict=True)}
    assert {doc[r["h1"]]: (r["n_links"], r["doc_id"]) for r in got} == {i: (len(x), x[0] if x[0] < i else None) for i, x in want.items() if x}
