"""Near-duplicate documents by Order MinHash and banded alignment.

Items of a document are its runs of five words (case folded, punctuation off),
each labelled with how often it came before in the document; a text of one to four
words is one item.  Each of ``SKETCHES`` random orders keeps the three least items,
in text order, so two documents share a sketch only if the same items
come in the same order: the chance follows edit similarity.  Documents that
share a sketch are candidates.

Verification aligns the two item sequences: similarity is 1 - edits / longer
length, and edits are found in a diagonal band of the width that ``threshold`` allows
(furthest-reaching points per diagonal, with jumps over equal runs).  It is at least
0.8 for every pair of Jaccard similarity 0.8 in the same order.

Equal item sequences are one node from the start.  In a bucket every member is
aligned with a few members that stand for it, the same ones in all buckets that
hold them; confirmed links give components.
In buckets that still hold several components the members are then compared
across components, block by block, on signatures of ``BINS`` bins, and aligned where these agree, also block by block.  So groups of near copies
do not turn into all their pairs, no pair of a group becomes a row with its texts, and links between strays and a group are found.

Cases: null, empty and wordless texts stand alone; rows that repeat a doc_id
are one document; rows without doc_id are passed over; ties take the least
doc_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import map_batches, stored
from .components import components

WORDS, LEAST, SKETCHES = 5, 3, 16
_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) | np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)  # place of an item in its document, in the low bits of its rank


def _items(chunk: tb.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(item hash without label, row offsets)."""
    w = tb.words(chunk, tb.PUNCT, fold=True)
    at, h = tb.windows(w, WORDS)
    row = w.row[at]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, r in enumerate(short):
            total = np.uint64(n[r])
            for x in w.hashes[w.first[r] : w.first[r + 1]]:
                total = tb.mix(np.array([total ^ x]))[0]
            extra[i] = total
        row, h = np.concatenate([row, short]), np.concatenate([h, extra])
        order = np.argsort(row, kind="stable")
        row, h = row[order], h[order]
    return h, np.searchsorted(row, np.arange(chunk.rows + 1))


def _labelled(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Items with their occurrence numbers mixed in."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = tb.mix(h + row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
    begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(h)))) if len(h) else np.zeros(0, np.int64)
    nth = np.zeros(len(h), np.uint64)
    nth[order] = (np.arange(len(h)) - begin).astype(np.uint64)
    return np.where(nth > 0, tb.mix(h + nth * np.uint64(0x9E3779B97F4A7C15)), h)


def sketches(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(rows with items, SKETCHES) sketch keys."""
    starts = first[:-1][np.diff(first) > 0]
    size = np.diff(first)[np.diff(first) > 0]
    place = (np.arange(len(items)) - np.repeat(starts, size)).astype(np.uint64) & _LOW
    out = np.empty((len(starts), SKETCHES), np.uint64)
    for s in range(SKETCHES):
        rank = (items ^ _SEEDS[s]) * _SEEDS[-1 - s]
        rank ^= rank >> np.uint64(29)
        rank *= np.uint64(0xBF58476D1CE4E5B9)
        rank = (rank & ~_LOW) | place
        places = np.full((len(starts), LEAST), np.iinfo(np.int64).max)
        for j in range(LEAST):
            least = np.minimum.reduceat(rank, starts)
            some = least != np.uint64((1 << 64) - 1)
            at = starts + (least & _LOW).astype(np.int64)
            places[some, j] = at[some]
            rank[at[some]] = np.uint64((1 << 64) - 1)
        places.sort(axis=1)  # text order
        key = np.full(len(starts), np.uint64(s + 1))
        for j in range(LEAST):
            some = places[:, j] < len(items)
            key = np.where(some, tb.mix(key * np.uint64(0x9E3779B97F4A7C15) + items[np.minimum(places[:, j], len(items) - 1)]), key)
        out[:, s] = key
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, name of the item sequence (k1, k2), n items, sketch keys."""

    def step(batch):
        for chunk in tb.chunks(batch.column("text"), tb.CHUNK_BYTES // 2):
            h, first = _items(chunk)
            n = np.diff(first)
            some = n > 0
            if not some.any():
                continue
            place = np.arange(len(h)) - np.repeat(first[:-1], n)
            weight = tb.powers(0xC2B2AE3D27D4EB4F, int(n.max()))[place]
            names = []
            for salt in (0, 0x51ED270B):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(tb.mix(h + np.uint64(salt)) * weight)])
                names.append(tb.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64))[some].view(np.int64))
            keys = sketches(_labelled(h, first), first).view(np.int64)
            ids = batch.column("doc_id").slice(chunk.lo, chunk.rows).filter(pa.array(some))
            at = np.arange(0, keys.size + 1, SKETCHES).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in names), pa.array(n[some].astype(np.int32)), pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel()))], ["doc_id", "k1", "k2", "n", "keys"])

    return map_batches(docs, step, "doc_id long, k1 long, k2 long, n int, keys array<long>")


class _Sequence:
    """Item sequence with hashes of all runs of 2**j items, for equal-run jumps."""

    def __init__(self, items: np.ndarray, levels: int):
        self.n = len(items)
        self.runs = [items]
        for j in range(levels):
            last, step = self.runs[-1], 1 << j
            if len(last) <= step:
                break
            self.runs.append(tb.mix(last[:-step] * np.uint64(0x9E3779B97F4A7C15) + last[step:]))


def _slide(a: _Sequence, b: _Sequence, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """i moved past the longest run a[i:] and b[j:] have in common."""
    i, j = i.copy(), j.copy()
    for level in range(min(len(a.runs), len(b.runs)) - 1, -1, -1):
        ra, rb = a.runs[level], b.runs[level]
        for _ in range(2 if level == min(len(a.runs), len(b.runs)) - 1 else 1):
            ok = (i >= 0) & (j >= 0) & (i < len(ra)) & (j < len(rb))
            eq = np.zeros(len(i), bool)
            eq[ok] = ra[i[ok]] == rb[j[ok]]
            i += eq * (1 << level)
            j += eq * (1 << level)
    return i


def edits_within(x: np.ndarray, y: np.ndarray, most: int) -> int | None:
    """Edit distance (insert, delete, replace) of two sequences if at most ``most``."""
    if abs(len(x) - len(y)) > most:
        return None
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[::-1][:n] != y[::-1][:n]) if n else differ[:0]
    tail = int(differ[0]) if len(differ) else n
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    if not len(x) or not len(y):
        return max(len(x), len(y)) if max(len(x), len(y)) <= most else None
    levels = max(1, int(np.log2(max(len(x), len(y)))))
    a, b = _Sequence(x, levels), _Sequence(y, levels)
    goal = len(x) - len(y)  # diagonal d = i - j
    reach = _slide(a, b, np.zeros(1, np.int64), np.zeros(1, np.int64))
    for e in range(1, most + 1):
        # far[d + e]: furthest i on diagonal d with e edits
        wide = np.full(2 * e + 3, -2, np.int64)
        wide[2:-2] = reach
        far = np.maximum(np.maximum(wide[1:-1] + 1, wide[:-2] + 1), wide[2:])
        d = np.arange(-e, e + 1)
        far = np.minimum(far, np.minimum(len(x), len(y) + d))
        alive = (far >= 0) & (far - d >= 0)
        far = np.where(alive, far, -2)
        far = np.where(alive, _slide(a, b, far, far - d), -2)
        reach = far
        if -e <= goal <= e and far[goal + e] >= len(x):
            return e
    return None


def _rising(values: np.ndarray) -> np.ndarray:
    """Places of a longest rising subsequence of distinct values."""
    if len(values) < 2 or (values[1:] > values[:-1]).all():
        return np.arange(len(values))
    ends, at, before = [], [], []  # least end value of a subsequence per length, its place
    for i, v in enumerate(values.tolist()):
        j = bisect_left(ends, v)
        before.append(at[j - 1] if j else -1)
        ends[j : j + 1] = [v]
        at[j : j + 1] = [i]
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def similar(x: np.ndarray, y: np.ndarray, lx: np.ndarray, ly: np.ndarray, threshold: float) -> bool:
    """Whether two item sequences (``lx`` and ``ly``: labelled, so distinct) align
    with at least ``threshold`` similarity."""
    longer = max(len(x), len(y))
    most = int((1 - threshold) * longer + 1e-9)
    if abs(len(x) - len(y)) > most:
        return False
    _, px, py = np.intersect1d(lx, ly, assume_unique=True, return_indices=True)
    if len(px) < longer - most:  # each edit spoils at most one item of the longer
        return False
    # aligning shared items that come in the same order and replacing all between
    # is an upper bound on the edits
    order = np.argsort(px)
    px, py = px[order], py[order]
    rising = _rising(py)
    gaps = [np.diff(np.concatenate([[-1], at[rising], [n]])) - 1 for at, n in ((px, len(x)), (py, len(y)))]
    if np.maximum(*gaps).sum() <= most:
        return True
    return edits_within(x, y, most) is not None


def _sequences(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(items, labelled items) of each text."""
    for chunk in tb.chunks(column):
        h, first = _items(chunk)
        labelled = _labelled(h, first)
        for r in range(chunk.rows):
            yield h[first[r] : first[r + 1]], labelled[first[r] : first[r + 1]]


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose documents align."""
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb_ = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(ta, "a").join(tb_, "b").select("a", "b", "ta", "tb")

    def step(batch):
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            ok = [similar(x, y, lx, ly, threshold) for (x, lx), (y, ly) in zip(_sequences(part.column("ta")), _sequences(part.column("tb")), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return map_batches(joined, step, "a long, b long")


BINS = 256


def signatures(texts: DataFrame) -> DataFrame:
    """doc_id, ``BINS`` bytes: eight bits of the least item hash of each bin of
    items (one random order), 0 for an empty bin."""

    def step(batch):
        for chunk in tb.chunks(batch.column("text")):
            h, first = _items(chunk)
            h = tb.mix(_labelled(h, first))
            row = np.repeat(np.arange(chunk.rows), np.diff(first))
            cell = row * BINS + (h & np.uint64(BINS - 1)).astype(np.int64)
            order = np.lexsort((h, cell))
            head = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1]])) if len(h) else np.zeros(0, np.int64)
            out = np.zeros((chunk.rows, BINS), np.uint8)
            least = order[head]
            out.ravel()[cell[least]] = 1 + ((h[least] >> np.uint64(8)) % np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.lo, chunk.rows), pa.array([x.tobytes() for x in out], pa.binary())], ["doc_id", "sig"])

    return map_batches(texts, step, "doc_id long, sig binary")


def shared_items(p: list[np.ndarray], q: list[np.ndarray]) -> np.ndarray:
    """How many items each sequence of p has in common with each of q (labelled items)."""
    names = np.intersect1d(np.concatenate(p), np.concatenate(q))
    out = np.zeros((len(p), len(q)), np.float32)
    for lo in range(0, len(names), 1 << 14):
        some, sides = names[lo : lo + (1 << 14)], []
        for side in (p, q):
            item, row = np.concatenate(side), np.repeat(np.arange(len(side)), [len(x) for x in side])
            at = np.minimum(np.searchsorted(some, item), len(some) - 1)
            hit = some[at] == item
            has = np.zeros((len(side), len(some)), np.float32)
            has[row[hit], at[hit]] = 1
            sides.append(has)
        out += sides[0] @ sides[1].T
    return out


def _align_blocks(candidates: DataFrame, blocks: DataFrame, texts: DataFrame, threshold: float | None) -> DataFrame:
    """Pairs (a, b) of the candidates whose documents align (``threshold`` None: all).  A row is a pair of blocks with
    their texts, never a pair of documents."""
    needed = candidates.select(F.col("x").alias("block")).unionAll(candidates.select("y")).distinct()
    members = blocks.join(needed, "block", "left_semi").select("block", F.posexplode("m.rep").alias("at", "doc_id"))
    bodies = members.join(texts, "doc_id").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "doc_id", "text"))).alias("m"))
    bodies = stored(bodies, "omh-bodies")
    side = lambda x, m: bodies.select(F.col("block").alias(x), F.col("m").alias(m))
    rows = candidates.join(side("x", "p"), "x").join(side("y", "q"), "y").select("pairs", "p", "q")

    def step(batch):
        for i in range(batch.num_rows):
            at = np.frombuffer(batch.column("pairs")[i].as_py(), np.uint32).reshape(-1, 2)
            p, q = (batch.column(c)[i].values for c in ("p", "q"))
            if threshold is not None:
                x, y = list(_sequences(p.field("text"))), list(_sequences(q.field("text")))
                common = shared_items([s[1] for s in x], [s[1] for s in y])[at[:, 0], at[:, 1]]
                longer = np.maximum(np.array([len(s[0]) for s in x])[at[:, 0]], np.array([len(s[0]) for s in y])[at[:, 1]])
                at = at[common >= threshold * longer - 1e-6]  # each edit spoils at most one item of the longer
                at = at[[similar(x[j][0], y[k][0], x[j][1], y[k][1], threshold) for j, k in at.tolist()]] if len(at) else at
            a, b = p.field("doc_id").to_numpy()[at[:, 0]], q.field("doc_id").to_numpy()[at[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return map_batches(rows, step, "a long, b long")


def _across(open_: DataFrame, texts: DataFrame, keys: DataFrame, agree: float, block: int, sigmas: float = 4.0, threshold: float | None = None, block_bytes: int = 1 << 19) -> DataFrame:
    """Pairs (a, b) of one bucket and different components whose signatures agree in
    ``agree`` of their bins, less ``sigmas`` standard deviations of that count, and that align (``threshold`` None: all).  Buckets are cut into blocks of about ``block`` members
    (fewer where their texts have over ``block_bytes`` bytes); each pair of blocks is one row, but for two blocks of the same component.  A pair
    that shares several buckets is compared in that of its first common key only."""
    open_ = open_.join(texts.select(F.col("doc_id").alias("rep"), F.octet_length("text").cast("long").alias("bytes")), "rep")
    sizes = open_.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    # components of a block or more get blocks of their own, the small ones of a bucket share blocks
    sizes = sizes.select("key", "comp", "n", "bytes", F.when(F.col("n") >= block, F.col("comp")).alias("own"))
    wide = sizes.groupBy(F.col("key").alias("in_key"), F.col("own").alias("in_own")).agg(F.ceil(F.greatest(F.sum("n") / block, F.sum("bytes") / block_bytes)).alias("parts"))
    sizes = sizes.join(wide, (F.col("key") == F.col("in_key")) & F.col("own").eqNullSafe(F.col("in_own"))).select("key", "comp", "own", "parts")
    part = F.pmod(F.xxhash64("rep", F.lit(7)), "parts")
    members = open_.join(sizes, ["key", "comp"]).withColumn("part", part).join(signatures(texts).withColumnRenamed("doc_id", "rep"), "rep").join(keys, "rep")
    blocks = members.groupBy("key", "own", "part").agg(F.collect_list(F.struct("rep", "comp", "sig", "keys")).alias("m"))
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "omh-blocks")
    # pairs of block numbers first, so that a hot bucket is dealt out by its blocks
    side = lambda x: blocks.select("key", F.col("own").alias(x + "own"), F.col("block").alias(x))
    twos = side("x").join(side("y"), "key").where("x <= y and not coalesce(xown = yown, false)").select("key", "x", "y")
    body = lambda x, m: blocks.select(F.col("block").alias(x), F.col("m").alias(m))
    rows = twos.join(body("x", "p"), "x").join(body("y", "q"), "y").select("key", "x", "y", "p", "q")

    def step(batch):
        for i in range(batch.num_rows):
            side = [batch.column(c)[i].values for c in ("p", "q")]
            rep, comp = ([x.field(f).to_numpy() for x in side] for f in ("rep", "comp"))
            sig = [np.frombuffer(b"".join(x.field("sig").to_pylist()), np.uint8).reshape(-1, BINS) for x in side]
            keys = [x.field("keys").flatten().to_numpy().reshape(-1, SKETCHES) for x in side]
            key = batch.column("key")[i].as_py()
            at = int(np.flatnonzero(keys[0][0] == key)[0])  # all members of a bucket hold its key at one place
            before = np.zeros((len(rep[0]), len(rep[1])), bool)
            for s in range(at):
                before |= keys[0][:, s][:, None] == keys[1][:, s][None]
            either = BINS - ((sig[0] == 0).astype(np.float32) @ (sig[1] == 0).T.astype(np.float32))
            same = np.stack([((sig[1] == row) & (row != 0)).sum(axis=1) for row in sig[0]])
            ok = (same >= agree * either - sigmas * np.sqrt(agree * (1 - agree) * either)) & (comp[0][:, None] != comp[1][None]) & ~before
            if batch.column("x")[i] == batch.column("y")[i]:
                ok = np.triu(ok)  # a block with itself has each pair twice
            j, k = np.nonzero(ok)
            if len(j):
                pairs = np.stack([j, k], axis=1).astype(np.uint32).tobytes()
                yield pa.RecordBatch.from_arrays([batch.column("x").slice(i, 1), batch.column("y").slice(i, 1), pa.array([pairs], pa.binary())], ["x", "y", "pairs"])

    candidates = stored(map_batches(rows, step, "x long, y long, pairs binary"), "omh-pairs")
    return _align_blocks(candidates, blocks, texts, threshold)


def near_duplicates(docs: DataFrame, threshold: float = 0.8, rounds: int = 1, draws: int = 2, agree: float = 2 / 3, block: int = 64) -> DataFrame:
    """(doc_id, class_id) of all documents; class_id is the least doc_id of the class.

    ``agree``: share of signature bins in which two members of a bucket are
    expected to agree when they just align: the Jaccard similarity, which is at
    least two thirds for pairs over the threshold.  They are aligned across
    components down to four standard deviations below it (0.55 with all bins
    filled), so that chance drops few pairs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    drawn = stored(sketch(docs), "omh-sketches")
    reps = drawn.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("keys", "doc_id").alias("keys"))
    bands = stored(reps.select("rep", F.explode("keys").alias("key")), "omh-bands")
    many = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = stored(bands.join(many, "key").select("key", "rep", F.col("rep").alias("comp")), "omh-buckets")
    texts = stored(docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "omh-texts")
    tried = roots = None
    open_ = shared
    for r in range(rounds + 1):
        if r < rounds:  # every member with a few that stand for its bucket
            heads = [F.min_by("rep", F.xxhash64("rep", F.lit(r * draws + i))) for i in range(draws)]
            heads = open_.groupBy("key").agg(F.array_distinct(F.array(F.min("rep"), *heads)).alias("heads"))
            pairs = open_.join(heads, "key").select("rep", "comp", F.explode("heads").alias("head"))
            if r:
                of = open_.select(F.col("rep").alias("head"), F.col("comp").alias("head_comp")).distinct()
                pairs = pairs.join(of, "head").where("comp <> head_comp")
            pairs = pairs.where("rep <> head").select(F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()
            pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "omh-pairs")
            tried = pairs if tried is None else tried.unionAll(pairs)
            found = verify(pairs, texts, threshold)
        else:  # the rest, block by block
            found = _across(open_, texts, reps.select("rep", "keys"), agree, block, threshold=threshold)
        found = stored(found, "omh-links")
        if roots is not None:  # what is known as links to roots, and the new links
            found = found.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = stored(components(found), "omh-roots")
        placed = shared.select("key", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("root", "rep").alias("comp"))
        mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        if r < rounds:
            open_ = stored(placed.join(mixed, "key"), "omh-open")
            if open_.isEmpty():
                break
    names = drawn.join(reps.select("k1", "k2", "rep"), ["k1", "k2"]).select("doc_id", "rep").distinct()
    known = names.join(roots, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("root", "rep").alias("class_id"))
    return docs.select("doc_id").distinct().join(known, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def op1_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).withColumn("is_duplicate", F.col("class_id") != F.col("doc_id"))
