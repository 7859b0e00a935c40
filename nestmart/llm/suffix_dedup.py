"""Substring dedup by prefix-partitioned suffix trees.

A window of ``size`` words that also starts in a document with a smaller
doc_id is a repeat; every word such a window covers is removed.  Windows are
judged on the input.

Sparse suffixes.  Among the 41 ten-word prefixes that begin in a 50-word window
the one of least hash is the window's anchor (leftmost on ties), so equal
windows have equal anchors and only suffixes that begin at anchors, about one
word in twenty, need a tree.  Anchors whose prefix occurs in one document only
lead to no repeat and are left out.

Prefix partitions.  Suffixes are dealt out by their prefix.  Ten words are enough
for most; a prefix with more than ``hot`` suffixes is lengthened to whole
windows, where a group is one deep node and its least doc_id comes from a
map-side combined aggregate, however many suffixes share it.  Every other group lies
in a partition of about ``per_task`` suffixes, where the subtree is refined
word by word from the prefix down.

Repeats.  A node of depth r holds the suffixes that share r words from the anchor
on; split by the ``size - r`` words to their left, its leaves are the
occurrences of one window.  Those with a smaller doc_id among them are repeats, for
all depths together the maximal repeats through the anchor.

Documents whose word sequence equals that of a smaller doc_id (with at
least one window) are removed whole beforehand, so groups of copies never
reach a tree.

Cases: null and empty texts have no words and keep the hash of the empty
string; texts under ``size`` words lose nothing; rows that repeat a doc_id are taken
as repeats of one row; rows with a null doc_id lose nothing and witness nothing;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import map_batches, map_partitions, stored

SIZE, PREFIX = 50, 10
LEFT = SIZE - PREFIX
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MOST = np.uint64((1 << 64) - 1)


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def anchors(w: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """(word position, prefix hash) of every anchor of a chunk."""
    n = len(w.hashes) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, h = tb.windows(w, PREFIX)
    full = np.full(len(w.hashes) - PREFIX + 1, MOST)
    full[at] = h
    least = np.lib.stride_tricks.sliding_window_view(full, LEFT + 1).argmin(axis=1)
    whole = np.flatnonzero(w.row[:n] == w.row[SIZE - 1 :])
    picked = np.unique(whole + least[whole])
    return picked, full[picked]


def sequence_keys(w: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """128-bit name of each row's word sequence."""
    at = np.arange(len(w.hashes)) - w.first[w.row]
    weight = tb.powers(0xC2B2AE3D27D4EB4F, int(at.max()) + 1 if len(at) else 1)[at]
    out = []
    for salt in (0, 0x1234567):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(tb.mix(w.hashes + np.uint64(salt)) * weight)])
        out.append(tb.mix(sums[w.first[1:]] - sums[w.first[:-1]] + np.diff(w.first).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def scan(docs: DataFrame) -> DataFrame:
    """Per document of at least one window: sequence key and anchors."""

    def step(batch):
        for chunk in tb.chunks(batch.column("text")):
            w = tb.words(chunk)
            k1, k2 = sequence_keys(w)
            at, h = anchors(w)
            row = w.row[at]
            first = np.searchsorted(row, np.arange(chunk.rows + 1))
            ids = batch.column("doc_id").slice(chunk.lo, chunk.rows)
            out = pa.RecordBatch.from_arrays([ids, pa.array(k1), pa.array(k2), _lists((at - w.first[row]).astype(np.int32), first), _lists(h.view(np.int64), first)], ["doc_id", "k1", "k2", "at", "prefix"])
            yield out.filter(pa.array(np.diff(w.first) >= SIZE))

    return map_batches(docs, step, "doc_id long, k1 long, k2 long, at array<int>, prefix array<long>")


def _contexts(docs: DataFrame) -> DataFrame:
    """One row per flagged anchor: its prefix and the text from up to LEFT words
    before it to the end of the window that begins at it."""

    def step(batch):
        marks = batch.column("marks")
        for chunk in tb.chunks(batch.column("text")):
            w = tb.words(chunk)
            ends = np.append(w.starts[1:], len(chunk.data))
            last = w.first[1:] - 1
            ends[last[last >= 0]] = chunk.offsets[1:][last >= 0]
            rows, bodies = [], []
            for r in range(chunk.rows):
                lo, hi = w.first[r], w.first[r + 1]
                doc_id = batch.column("doc_id")[chunk.lo + r].as_py()
                for m in marks[chunk.lo + r].as_py():
                    p = lo + m["at"]
                    a, b = max(lo, p - LEFT), min(hi, p + SIZE)
                    rows.append((m["prefix"], m["hot"], doc_id, m["at"], p - a))
                    bodies.append(chunk.data[w.starts[a] : ends[b - 1]].tobytes())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types, strict=True)), pa.array(bodies, pa.binary())], ["prefix", "hot", "doc_id", "at", "left", "body"])

    return map_batches(docs, step, "prefix long, hot boolean, doc_id long, at int, left int, body binary")


def _refine(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Dense ids of the pairs (group, key)."""
    return np.unique(tb.mix(key + np.uint64(1)) + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True)[1]


def repeats(prefix: np.ndarray, doc: np.ndarray, left: np.ndarray, bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subtrees of some prefixes at once.  (suffix, first, stop): the words
    first..stop (relative to the anchor) of the repeats through each anchor."""
    n = len(prefix)
    right = np.zeros((n, SIZE), np.uint64)  # 0 past the end of the document
    before = np.zeros((n, LEFT), np.uint64)  # nearest first, 0 past its beginning
    for chunk in tb.chunks(bodies):
        w = tb.words(chunk)
        at = np.arange(len(w.hashes)) - w.first[w.row] - left[chunk.lo : chunk.hi][w.row]
        row = chunk.lo + w.row
        ahead = at >= 0
        right[row[ahead], at[ahead]] = w.hashes[ahead]
        before[row[~ahead], -1 - at[~ahead]] = w.hashes[~ahead]
    depth = np.cumsum(right != 0, axis=1)[:, -1]
    room = np.cumsum(before != 0, axis=1)[:, -1]
    node = np.unique(prefix, return_inverse=True)[1]
    nodes = [node]
    for r in range(SIZE):
        node = _refine(node, right[:, r])
        nodes.append(node)
    side = np.zeros(n, np.int64)
    most, least = np.full(n, -1), np.full(n, SIZE)
    for o in range(LEFT + 1):
        if o:
            side = _refine(side, before[:, o - 1])
        r = SIZE - o
        ok = np.flatnonzero((depth >= r) & (room >= o))
        if not len(ok):
            continue
        group = _refine(nodes[r][ok], side[ok].astype(np.uint64))
        smallest = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, group, doc[ok])
        again = ok[smallest[group] < doc[ok]]
        most[again] = o
        least[again] = np.minimum(least[again], o)
    hit = np.flatnonzero(most >= 0)
    return hit, -most[hit], SIZE - least[hit]


def _trees(suffixes: DataFrame) -> DataFrame:
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        col = lambda c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        hit, first, stop = repeats(col("prefix"), col("doc_id"), col("left"), t.column("body").combine_chunks())
        at = col("at")[hit].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(col("doc_id")[hit]), pa.array(at + first), pa.array(at + stop)], ["doc_id", "first", "stop"])

    return map_partitions(suffixes.select("prefix", "doc_id", "at", "left", "body"), run, "doc_id long, first long, stop long")


def _hot_windows(suffixes: DataFrame) -> DataFrame:
    """Suffixes of hot prefixes, lengthened to whole windows: one row per window
    through the anchor."""

    def step(batch):
        for chunk in tb.chunks(batch.column("body"), tb.CHUNK_BYTES // 4):
            w = tb.words(chunk)
            at, h = tb.windows(w, SIZE)
            take = lambda c: batch.column(c).to_numpy(zero_copy_only=False)[chunk.lo : chunk.hi][w.row[at]]
            first = take("at").astype(np.int64) - take("left") + at - w.first[w.row[at]]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(take("doc_id")), pa.array(first)], ["window", "doc_id", "first"])

    return map_batches(suffixes.select("doc_id", "at", "left", "body"), step, "window long, doc_id long, first long")


def find_repeats(docs: DataFrame, hot: int = 20_000, per_task: int = 40_000) -> tuple[DataFrame, DataFrame]:
    """(doc_id, first, stop) word ranges to remove, and (doc_id) of documents
    that repeat a smaller one word for word."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    scanned = stored(scan(docs), "suffix-anchors")
    originals = scanned.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    groups = originals.where("least < most").select("k1", "k2", "least")
    copies = scanned.select("doc_id", "k1", "k2").join(groups, ["k1", "k2"]).where("doc_id > least").select("doc_id").distinct()
    copies = stored(copies, "suffix-copies")
    kept = scanned.join(copies, "doc_id", "left_anti")
    rows = kept.select("doc_id", F.explode(F.arrays_zip("at", "prefix")).alias("x")).select("doc_id", "x.at", "x.prefix")
    shared = rows.groupBy("prefix").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).where("least < most")
    shared = stored(shared.select("prefix", "n", (F.col("n") > hot).alias("hot")), "suffix-prefixes")
    marks = rows.join(shared, "prefix").groupBy("doc_id").agg(F.collect_set(F.struct("at", "prefix", "hot")).alias("marks"))  # bounded by the document
    suffixes = stored(_contexts(docs.join(marks, "doc_id")), "suffix-texts")
    total = shared.agg(F.coalesce(F.sum(F.when(~F.col("hot"), F.col("n"))), F.lit(0)).alias("n"), F.max("hot").alias("hot")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total["n"] // per_task))
    found = _trees(suffixes.where("NOT hot").repartition(parts, "prefix"))
    if total["hot"]:
        windows = stored(_hot_windows(suffixes.where("hot")), "suffix-hot")
        least = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
        least = stored(least, "suffix-least")  # both sides of the join are plain shuffles then, so a window of many suffixes can be split
        again = windows.join(least, "window").where("doc_id > least")
        found = found.unionAll(again.select("doc_id", "first", (F.col("first") + SIZE).alias("stop")))
    return found, copies


def remove(docs: DataFrame, found: DataFrame, copies: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text."""
    ranges = found.groupBy("doc_id").agg(F.collect_set(F.struct("first", "stop")).alias("ranges"))  # bounded by the document
    ranges = ranges.unionAll(copies.select("doc_id", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.lit(1 << 62).alias("stop"))).alias("ranges")))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(ranges, "doc_id", "left")

    def step(batch):
        ids, texts, spans = (batch.column(c) for c in ("doc_id", "text", "ranges"))
        n_words, n_removed, sums, bodies = [], [], [], []
        for t, r in zip(texts, spans, strict=True):
            ws = WORD.findall(t.as_py() or "")
            n_words.append(len(ws))
            if r.is_valid:
                gone = np.zeros(len(ws), bool)
                for x in r.as_py():
                    gone[x["first"] : x["stop"]] = True
                ws = [x for x, g in zip(ws, gone.tolist(), strict=True) if not g]
            body = " ".join(ws)
            n_removed.append(n_words[-1] - len(ws))
            sums.append(hashlib.sha256(body.encode()).hexdigest())
            bodies.append(body)
        yield pa.RecordBatch.from_arrays([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sums, pa.string()), pa.array(bodies, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return map_batches(joined, step, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op2_substring_dedup(docs: DataFrame) -> DataFrame:
    return remove(docs, *find_repeats(docs)).drop("kept_text")
