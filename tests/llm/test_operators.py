"""Operators of the training-data pipeline against brute force on small tables."""

from __future__ import annotations

import base64
import gzip
import hashlib
import inspect
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from nestmart.llm import components, decontaminate, langid, line_dedup, order_minhash, packing, perplexity, pii, suffix_dedup, toxicity, warc
from nestmart.llm.common import stored

from ..conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class_id int, kept int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, 1, 1) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    a, b, passage = text(300), text(200), text(70)
    near = a.split()
    near[150] = "other"
    rows = [(1, a, "en"), (2, a, "en"), (3, " ".join(near), "en"), (4, None, None), (5, "", "en"), (6, "   \n\t ", None), (7, b + " " + passage, "de")]
    rows += [(8, text(60) + " " + passage + " " + text(60), "de"), (9, "one", "en"), (9, "one", "en"), (None, "null id", "en"), (10, "x" * 50_000 + " " + text(20_000), "en"), (11, "\n".join([b, "tail line here now ok", b]), "de"), (12, "12 34 !!", None)]
    return _docs(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _texts(df):
    return {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}


def _plain_assign(lengths, size, quadratic):
    """Descending pieces, each looked up among all open sequences."""
    pieces, rest, used, spent = [], [], {}, {}
    for d, n in enumerate(lengths):
        for start in range(0, n - n % size, size):
            pieces.append((d, start, size, len(pieces), 0))
        if n % size:
            rest.append((n % size, d, n - n % size))
    full = len(pieces)
    for s in range(full, full - (-sum(n for n, _, _ in rest) // size)):
        used[s], spent[s] = 0, 0.0
    for n, d, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        while n:
            room = [s for s in used if size - used[s] >= n] or [s for s in used if used[s] < size]
            s = min(room, key=lambda s: (spent[s], s))
            take = min(n, size - used[s])
            pieces.append((d, start, take, s, used[s]))
            used[s] += take
            spent[s] += take + take * take / quadratic
            start, n = start + take, n - take
    return pieces


def test_packing_takes_the_cheapest_sequence_with_room():
    rng = np.random.default_rng(4)
    for size, mean in ((16, 1.5), (64, 3.0), (2048, 5.0)):
        lengths = np.maximum(1, rng.lognormal(mean, 1.0, 400).astype(np.int64))
        assert packing.assign(lengths, size, 1024.0) == _plain_assign(lengths.tolist(), size, 1024.0)


def test_substring_dedup(spark, odd, empty):
    for hot in (20_000, 1):
        got = {r.doc_id: r for r in suffix_dedup.remove(odd, *suffix_dedup.find_repeats(odd, hot=hot)).collect() if r.doc_id is not None}
        first = {}
        for i, t in sorted(_texts(odd).items()):
            ws = WORD.findall(t or "")
            gone = [False] * len(ws)
            for s in range(len(ws) - 49):
                if first.setdefault(tuple(ws[s : s + 50]), i) < i:
                    gone[s : s + 50] = [True] * 50
            kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
            assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), i
    assert suffix_dedup.op2_substring_dedup(empty).count() == 0


def test_near_duplicates(spark, odd, empty):
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(odd).collect()}
    assert got[1] == got[2] == got[3] == 1
    assert all(got[i] == i for i in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert order_minhash.op1_near_dedup(empty).count() == 0


def test_edit_distance_in_a_band():
    rng = random.Random(3)
    for _ in range(150):
        x = [rng.randrange(4) for _ in range(rng.randrange(25))]
        y = list(x)
        for _ in range(rng.randrange(8)):
            k = rng.randrange(len(y) + 1)
            y[k : k + rng.randrange(2)] = [rng.randrange(4)] * rng.randrange(2)
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            old, row = row, [i]
            for j, d in enumerate(y, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (c != d)))
        most = rng.randrange(10)
        assert order_minhash.edits_within(np.array(x, np.uint64), np.array(y, np.uint64), most) == (row[-1] if row[-1] <= most else None)


def test_alignment_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(400):
        x = rng.integers(0, rng.integers(2, 50), rng.integers(2, 30)).astype(np.uint64)
        y = np.concatenate([x[k:], x[:k]]) if (k := int(rng.integers(0, 3))) else x.copy()
        y[rng.integers(0, len(y), rng.integers(1, 6))] = rng.integers(0, 50)
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            last, row = row, [i]
            for j, b in enumerate(y, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b)))
        labelled = [order_minhash._labelled(z, np.array([0, len(z)])) for z in (x, y)]
        assert order_minhash.similar(x, y, *labelled, 0.8) == (row[-1] <= int(0.2 * len(x) + 1e-9))


def test_block_screen_keeps_pairs_at_the_threshold(spark):
    rng = random.Random(11)
    texts, open_, keys = [], [], []
    for p in range(150):  # a bucket for each pair: four single-word edits in 101 to 106 words
        ws = ["w%d" % rng.randrange(10**6) for _ in range(101 + p % 6)]
        other = list(ws)
        for k in (10, 30, 50, 70):
            other[k] = "x%d" % rng.randrange(10**6)
        for i, x in ((2 * p, ws), (2 * p + 1, other)):
            texts.append((i, " ".join(x)))
            open_.append((p, i, i))
            keys.append((i, [p] + [1000 + i] * (order_minhash.SKETCHES - 1)))
    agree = inspect.signature(order_minhash.near_duplicates).parameters["agree"].default
    tables = [spark.createDataFrame(r, s) for r, s in ((open_, "key long, rep long, comp long"), (texts, "doc_id long, text string"), (keys, "rep long, keys array<long>"))]
    got = {(r.a, r.b) for r in order_minhash._across(*tables, agree, 64).collect()}
    assert got == {(2 * p, 2 * p + 1) for p in range(150)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (100, 101), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_line_dedup_against_sql(spark, odd, empty):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = sorted(map(tuple, con.execute(line_dedup.SQL).fetchall()))
    for block, light in ((200_000, 8), (3, 8), (200_000, 0)):  # 3: nearly all tokens are split into blocks; 0: every group is heavy
        found = line_dedup.by_document(docs, *line_dedup.find_lines(docs, block=block, light=light))
        assert sorted((r.doc_id, r.n_lines, r.n_removed, ",".join(map(str, r.removed_lines)), ",".join(r.first_lines), r.n_followers, r.n_links) for r in found.collect()) == want
    assert line_dedup.op6_line_dedup(odd).count() == odd.count()
    kept = line_dedup.drop_lines(odd, *line_dedup.find_lines(odd))
    assert kept.columns == odd.columns and 2 not in _texts(kept) and 4 in _texts(kept)
    assert line_dedup.op6_line_dedup(empty).count() == 0


def test_near_copies_of_a_line_are_not_paired_out(spark):
    rng = random.Random(9)
    words = ["w%d" % i for i in range(20)]
    rows = []
    for i in range(800):
        line = words.copy()
        line[rng.randrange(20)] = f"x{i}"
        rows.append((i, " ".join(line) + f"\nalone {i} b{i} c{i} d{i} e{i}", "en"))
    docs = _docs(spark, rows)
    packed = line_dedup.index(docs.select("text"), np.ones(line_dedup.BUCKETS, np.int64), 0.8, 200_000, 4)
    assert line_dedup._pairs(packed.repartition(4, "part"), 0.8, 8).distinct().count() < 40_000
    sets = {i: set(t.split("\n")[0].split()) for i, t, _ in rows}
    got = {(r.doc_id, r.number): (r.cut.doc_id, r.cut.number) for r in line_dedup.find_lines(docs)[0].collect()}
    want = {}
    for i in range(800):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                want[i, 0] = (j, 0)
                break
    assert got == want


def test_quality_counts(spark, odd, empty):
    docs = odd.where("doc_id IS NOT NULL").unionAll(_docs(spark, [(20, "a b c a b c # x\nline\nline\n \n[*$]" + " z" * 60, "en"), (21, "é ñ è", "fr")]))
    got = {r.doc_id: r for r in perplexity.op8_quality_rules(docs).collect()}
    for i, t in _texts(docs).items():
        t = t or ""
        ws = WORD.findall(t)
        wins = [tuple(ws[k : k + 3]) for k in range(len(ws) - 2)]
        rep = {k + j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(3)} if len(ws) < 2000 else None
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == want, i
        if rep is not None:
            assert r.n_repeat_words == len(rep)
            assert r.base_failed == (len(ws) < 50 or 100 * len(rep) > 50 * len(ws))
        assert not (r.kept and r.base_failed)
    assert perplexity.op8_quality_rules(empty).count() == 0


def test_quality_band_rejects_planted_junk(spark):
    rng = random.Random(6)
    words = [rng.choice("bdfgklmnprst") + rng.choice("aeiou") + rng.choice("bdfgklmnprst") + rng.choice(["", "en", "ou", "ast"]) for _ in range(2000)]
    some = lambda n: rng.choices(words, [1 / (k + 100) for k in range(2000)], k=n)
    clean = {i: " ".join(w + rng.choice(["", "", "", ",", ".\n"]) for w in some(rng.randint(250, 350))) for i in range(300)}
    noise = {1000 + i: " ".join("".join(rng.choices("qxzvjwh#4", k=5)) for _ in range(150)) for i in range(5)}
    spattered = {2000 + i: " ".join(w + rng.choice("#*$%&") * 6 for w in some(150)) for i in range(5)}
    copies = {3000 + i: clean[0] for i in range(400)}  # more than half of the rows
    got = {r.doc_id: r for r in perplexity.op8_quality_rules(_docs(spark, [(i, t, "en") for i, t in (clean | noise | spattered | copies).items()])).collect()}
    assert not any(r.base_failed for r in got.values())
    assert not any(got[i].kept for i in noise | spattered)
    assert sum(got[i].kept for i in clean) >= 0.98 * len(clean) and all(got[i].kept for i in copies)
    few = perplexity.op8_quality_rules(_docs(spark, [(i, clean[i], "en") for i in range(3)])).collect()
    assert all(r.kept for r in few)


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(2)
    code, n = np.unique(rng.integers(0, 6, (4000, 4)) @ (32 ** np.arange(3, -1, -1)), return_counts=True)
    model = perplexity.kneser_ney(code, n)
    for ctx in np.unique(code >> 5)[:20]:
        p = np.exp(perplexity.log_probs(model, (ctx << 5) + np.arange(32)))
        assert abs(p.sum() - 1) < 1e-4


def test_packing(spark, odd, empty):
    rows = packing.op5_packing(odd).toPandas()
    encode = Tokenizer.from_file(packing.vocabulary_path())
    for i, t in _texts(odd).items():
        ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        mine = rows[rows.doc_id == i].drop_duplicates(["start"]).sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.start == mine.length.cumsum() - mine.length).all()
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine.itertuples())
    for _, s in rows.sort_values("offset").groupby("sequence_id"):
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 2048
    assert packing.op5_packing(empty).count() == 0


def test_language_and_toxicity(spark, odd, empty):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    m = langid.op9_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (m.lang == m.lang_pred).mean() > 0.9
    got = {r.doc_id: r for r in langid.op9_language_id(odd).collect()}
    assert [got[i].lang_pred for i in (4, 5, 6, 12)] == ["und"] * 4
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    t = toxicity.op3_toxicity(docs, labels)
    assert t.count() == docs.count() and t.where("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    none = labels.where("false")
    assert toxicity.op3_toxicity(odd, none).where("score <> 0").count() == 0
    assert langid.op9_language_id(empty).count() == toxicity.op3_toxicity(empty, labels).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    x = (rng.random((700, 40)) * (rng.random((700, 40)) < 0.2)).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    cos, who = toxicity.BlockMaxIndex(x).search(x[:50], 5)
    want = np.sort(x[:50] @ x.T, axis=1)[:, ::-1][:, :5]
    assert np.allclose(np.maximum(cos, 0), want, atol=1e-5)


def test_decontamination(spark, empty):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(30)) + ". " + " ".join(word() for _ in range(6)) + ".") for i in range(6)]
    filler = lambda n: " ".join(word() for _ in range(n))
    para = items[2][1].split()
    for k in range(0, len(para), 5):
        para[k] = word()
    rows = [(1, filler(100) + " " + items[0][1].upper() + " " + filler(50)), (2, filler(200)), (3, filler(20) + " " + " ".join(para) + " " + filler(90)), (4, None), (5, "")]
    docs = _docs(spark, [(i, t, "en") for i, t in rows])
    bench = spark.createDataFrame([*items, (90, None), (91, "")], "item_id long, text string")
    for block in (512, 2):
        got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, block=block).collect())
        assert got == [(1, 0), (3, 2)]
    assert decontaminate.contaminated(empty, bench).count() == decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_decontamination_finds_paraphrases_of_frequent_items(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    filler = lambda n: " ".join(word() for _ in range(n))
    items = [(i, filler(30) + ". " + filler(6) + ".") for i in range(2)]
    rows = [(100 * i + k, filler(20) + " " + items[i][1] + " " + filler(30), "en") for i in range(2) for k in range(40)]
    for k in range(5):  # the first words replaced, the rest kept
        rows.append((1000 + k, filler(40) + " " + filler(12) + " " + " ".join(items[k % 2][1].split()[12:]) + " " + filler(40), "en"))
    rows += [(2000 + k, filler(150), "en") for k in range(50)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(100 * i + k, i) for i in range(2) for k in range(40)} | {(1000 + k, k % 2) for k in range(5)}


def test_pii(spark, empty):
    text = "Mr. John Smith met Mrs Jane Smith; Mr Smith +1 (017) 555-7713, +10175557713. a.b.34@mail7.example.com A.B.34@MAIL7.EXAMPLE.COM ip 97.51.17.173 card 4111 1111 1111 1111"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "x@y.org"), (4, "no entity 2019 here"), *[(i, f"mail u{i}@host{i}.org from 10.0.{i}.1") for i in range(100, 160)]]
    out = pii.replace(_docs(spark, [(i, t, "en") for i, t in rows])).collect()
    got = {r.doc_id: r.text for r in out}
    assert len(out) == len(rows) and got[2] is None and got[3] == "" and got[4] == rows[5][1]
    for secret in ("John", "Jane", "Smith", "555-7713", "mail7", "97.51", "4111"):
        assert secret not in got[1]
    names = re.match(r"Mr\. (\w+n) (\w+) met Mrs (\w+lina) (\w+); Mr (\w+) ", got[1])
    assert names and names[2] == names[4] == names[5]
    mails = re.findall(r"\S+@\S+", got[1])
    assert mails[0].lower() == mails[1].lower() and mails[1].isupper()
    assert len({got[i] for i in range(100, 160)}) == 60
    assert pii.op10_pii(empty).count() == 0


def test_warc_round_trip_and_salvage(spark, tmp_path):
    pages = spark.createDataFrame([(5, "http://a/x y", "<p>é</p>", 1), (3, None, "<p>é</p>", 1), (9, "u", None, 1), (7, "u", "", 1), (8, "u", "WARC/1.1\r\n\r\nx", 1), (8, "u", "WARC/1.1\r\n\r\nx", 1)], "page_id long, url string, html string, record_type int")
    got = sorted(tuple(r)[:5] for r in warc.op7_warc(pages).collect())
    b32 = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    odd_html = "WARC/1.1\r\n\r\nx"
    assert [r for r in got if r[0] == 3] == [(3, 9, b32("<p>é</p>"), "response", None)]
    assert [r for r in got if r[0] == 5] == [(5, 9, b32("<p>é</p>"), "revisit", 3)]
    assert [r for r in got if r[0] == 9] == [(9, 0, b32(""), "revisit", 7)]
    assert [r for r in got if r[0] == 8] == [(8, 13, b32(odd_html), "response", None)] * 2
    assert warc.op7_warc(pages.where("false")).count() == 0

    raw = [(r.value + warc.END).encode() for r in warc.records(pages.where("page_id <> 8")).collect()]
    plain = b"".join(raw)
    cuts = np.cumsum([0, *map(len, raw)])
    broken = bytearray(plain)
    broken[cuts[1] + 40 : cuts[1] + 60] = b"\0" * 20  # inside the second record
    for data, lost in ((plain, 0), (bytes(broken), 1), (b"junk" + plain[:-3], 1)):
        found = list(warc.salvage(data))
        assert sum(f[0] == "record" for f in found) == len(raw) - lost
        assert found[0][1] == 0 and found[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(found, found[1:], strict=False))
    members = [gzip.compress(r) for r in raw]
    hurt = members[0] + members[1][:30] + b"\xff" * 8 + members[1][38:] + b"".join(members[2:]) + raw[0]
    kinds = [f[0] for f in warc.salvage(hurt)]
    assert kinds.count("record") == len(raw) and kinds.count("gap") == 1

    # all records in one gzip member: a damaged body costs its own record only
    whole = gzip.compress(bytes(broken))
    found = list(warc.salvage(whole))
    assert [f[0] for f in found].count("record") == len(raw) - 1
    gaps = [f for f in found if f[0] == "gap"]
    assert [(g[1], g[2], g[4]) for g in gaps] == [(cuts[1], cuts[2], 0)]
    # a stream that breaks off gives what came before the break, then the next member
    big = raw * 50
    stream = gzip.compress(b"".join(big), 0)
    half = stream[: len(stream) // 2]
    found = list(warc.salvage(half + members[0]))
    got = sum(f[0] == "record" for f in found)
    whole_before = sum(c <= len(half) - 200 for c in np.cumsum([len(b) for b in big]))  # the rest is gzip framing
    assert got >= whole_before + 1
    assert [(f[1], f[2], f[3]) for f in found if f[0] == "gap"] in ([(0, len(half), r)] for r in ("damaged gzip member", "gzip member cut short"))


def test_quality_stage_judges_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good = [r.doc_id for r in perplexity.judge(docs).where("kept").orderBy("doc_id").limit(3).collect()]
    short = "too short to pass"
    planted = docs.where(F.col("doc_id").isin(good)).withColumn("doc_id", F.lit(None).cast("long"))
    bad = spark.createDataFrame([(None, short, "en"), (good[0], short, "en"), (None, None, None)], "doc_id long, text string, lang string")
    mixed = docs.select("doc_id", "text", "lang").unionByName(planted.select("doc_id", "text", "lang")).unionByName(bad)
    mixed = mixed.withColumn("text_hash", F.lit("clash")).withColumn("_hash", F.lit(1))
    kept = perplexity.keep_good(mixed)
    assert kept.columns == mixed.columns
    rows = kept.collect()
    assert not any(r.text in (short, None) for r in rows)
    assert sum(r.doc_id == good[0] for r in rows) == 1
    verdicts = perplexity.judge(mixed).select("doc_id", "kept").collect()
    assert len(verdicts) == mixed.count() and sum(v.kept for v in verdicts) == len(rows)


def test_samples_are_bounded_by_rows(spark, monkeypatch):
    # one doc_id repeated over many different texts, beside ordinary rows
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("insult number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    rest = spark.range(40).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("kind words "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    more = spark.range(300).select((F.col("id") + 1000).alias("doc_id"), F.lit("rare tongue").alias("text"), F.concat(F.lit("x"), F.col("id").cast("string")).alias("lang"))
    docs = hot.unionByName(rest).unionByName(rest)
    seen = []
    monkeypatch.setattr(langid, "fit", lambda samples, **_: seen.append(samples))
    langid.train(docs, per_lang=30)
    langid.train(docs.unionByName(more), per_lang=30, max_sample=600)
    assert sorted((s["lang"] for s in seen[0])) == ["de"] * 30 + ["en"] * 30  # repeated rows count once
    assert len({s["lang"] for s in seen[1]}) == 302 and len(seen[1]) <= 600  # no language is left out

    labels = spark.createDataFrame([(7, 1), *((100 + i, 0) for i in range(40))], "doc_id long, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), labels, per_label=10)
    assert len(model["names"]) <= 20


def _shingles(text: str) -> set:
    words = re.findall(r"[a-z0-9]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_pipeline_stage_by_stage(spark):
    """Each stage, on what its predecessor kept, against plain Python over planted cases."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("good_id", F.lit("clash"))
    names = docs.columns
    plain = {r.doc_id: r for r in docs.collect()}
    top = max(plain)
    by_length = sorted((r for r in plain.values() if r.lang == "en" and r.text), key=lambda r: (len(r.text.split()), r.doc_id))
    sound = perplexity.judge(docs).where("kept").select("doc_id").collect()
    sound = [r for r in by_length if r.doc_id in {s.doc_id for s in sound} and 80 <= len(r.text.split()) <= 300][:6]
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").collect()]
    words = sound[0].text.split(" ")
    near = " ".join([*words[:-1], "changed"])
    planted = [
        sound[1],  # the same row once more
        sound[0].asDict() | {"doc_id": top + 1, "text": near},
        sound[2].asDict() | {"doc_id": top + 2, "text": "too short"},
        sound[2].asDict() | {"doc_id": None, "text": "too short"},
        sound[2].asDict() | {"doc_id": top + 3, "text": None},
        sound[3].asDict() | {"doc_id": top + 4, "text": "a b c " * 60},
        sound[4].asDict() | {"text": sound[4].text + "\n" + bench[0]},  # in place of the row as it was
    ]
    planted = [r if isinstance(r, dict) else r.asDict() for r in planted]
    mixed = docs.where(F.col("doc_id") != sound[4].doc_id).unionByName(spark.createDataFrame([tuple(r[c] for c in names) for r in planted], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]

    def rows(df):
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    good = stored(stages["quality rules"](spark, mixed, SF_SMALL), "test-quality")
    assert good.columns == names
    got = rows(good)
    for _, text in got:  # base rules, by hand
        w = WORD.findall(text)
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        twice = {i + j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(3)}
        assert len(w) >= 50 and 100 * len(twice) <= 50 * len(w)
    assert {i for i, _ in got}.isdisjoint({None, top + 2, top + 3, top + 4}) and [i for i, _ in got].count(sound[1].doc_id) == 2

    lined = stored(stages["line dedup"](spark, good, SF_SMALL), "test-lines")
    assert lined.columns == names and {i for i, _ in rows(lined)} <= {i for i, _ in got}

    single = stored(stages["near dedup"](spark, lined, SF_SMALL), "test-near")
    assert single.columns == names
    left = rows(single)
    assert len({i for i, _ in left}) == len(left)  # one row per document
    sets = [(i, _shingles(t)) for i, t in left]
    inverted = defaultdict(set)
    for n, (_, s) in enumerate(sets):
        for x in s:
            inverted[x].add(n)
    pairs = {(a, b) for group in inverted.values() for a in group for b in group if a < b}
    assert not [(sets[a][0], sets[b][0]) for a, b in pairs if len(sets[a][1] & sets[b][1]) >= 0.8 * len(sets[a][1] | sets[b][1])]
    before = {i: _shingles(t) for i, t in rows(lined)}
    for gone in before.keys() - {i for i, _ in left}:  # each document that went has an earlier relative
        assert any(o < gone and len(before[gone] & s) >= 0.5 * len(before[gone] | s) for o, s in before.items())

    clean = stored(stages["decontamination"](spark, single, SF_SMALL), "test-clean")
    assert clean.columns == names and {i for i, _ in rows(clean)} <= {i for i, _ in left}
    assert not any(q in t for q in bench for _, t in rows(clean))
    packed = stages["packing"](spark, clean, SF_SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in rows(clean)}
    # clean documents stay: those that pass the base rules and have no relative
    assert len(rows(clean)) >= 0.8 * len(left)


def test_pipeline_of_nothing(spark):
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF_SMALL)
        assert out.count() == 0, name


def test_alignments_are_tried_only_with_enough_shared_words(spark, monkeypatch):
    """The count of shared words bounds every common subsequence, and spares alignments without losing one."""
    d, rng = decontaminate, np.random.default_rng(0)
    items = [rng.integers(0, 9, n).astype(np.uint64) for n in (1, 5, 11)]
    words = rng.integers(0, 11, 60).astype(np.uint64)
    a, item = rng.integers(0, 59, 50), rng.integers(0, 3, 50)
    b = np.array([rng.integers(x, 61) for x in a])
    got = d.most_shared(words, a, b, item, d._vocabulary(items), at_once=7).tolist()
    assert got == [(Counter(words[x:y].tolist()) & Counter(items[i].tolist())).total() for x, y, i in zip(a, b, item, strict=True)]
    assert all(d.lcs(items[i], words[x:y]) <= n for x, y, i, n in zip(a, b, item, got, strict=True))

    tried, lcs, steps = [], d.lcs, {}
    monkeypatch.setattr(d, "lcs", lambda x, y: tried.append(1) or lcs(x, y))
    monkeypatch.setattr(d, "map_batches", lambda docs, step, schema: steps.update(step=step))
    h = d._item_words("one two three four five six seven eight nine ten")
    z = np.ones((1, 1), np.float32)
    model = {"terms": np.sort(h), "idf": np.ones(10, np.float32), "vectors": np.ones((10, 1), np.float32), "items": z, "names": [7], "words": [h], "vocabulary": d._vocabulary([h]), "answers": [[]]}
    d._search(spark.range(1), model, 0.35, 0.8, 0.6)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three and nothing else", "x one two three four five six seven eight nine y"]})
    found = [r for out in steps["step"](batch) for r in out.to_pylist()]
    assert [(r["doc_id"], r["item_id"], r["lcs"]) for r in found] == [(2, 7, 0.9)]
    assert len(tried) == 2  # the two windows that document 2 lies in
