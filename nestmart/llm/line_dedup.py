"""Line dedup by an exact set-similarity join.

Lines are the runs between line feeds, a line's tokens the set of its words.  A
line goes if an earlier one (by doc_id, then line number) has a token set of
Jaccard similarity ``threshold`` or more; all lines are judged on the input.

Order.  Tokens are ordered by rarity, then hash.  Rarity is read from a table of
``BUCKETS`` counters filled over all lines, whose size does not depend on the
corpus; any fixed order gives exact results, rare tokens first make them cheap.

Filters.  Sets of similarity t and sizes a <= b have a >= t * b (length), share one
of the first ``size - ceil(t * size) + 1`` tokens (prefix), still have room
for the needed overlap behind that token (positional), and differ in no more
tokens than the 128-bit parity maps of both sets do (a lower bound).  Entries are
dealt out by prefix token as packed arrays; a token with more lines than
``block`` is split into blocks that meet pair by pair.

Equal sets are one set, so copies never pair up.  Candidate pairs of *light*
groups (at most ``light`` for each entry) are verified on their token sets.  A
*heavy* group, such as many near copies, is not paired out: its token sets are
brought together in order of first occurrence, and each is held against earlier ones
until the first similar one is found.  Either way a set learns the first
line similar to it.  Where links are counted, too, no pair becomes a row: the entries that have a
candidate go, group by group, to tasks that have their token sets, all pairs of similar sets are
found there (in the group of the first token that both have, so once), and what a set
learns is added up.  The comparisons in a group of near copies stay quadratic, as the links
are; large groups are cut into cells that meet pair by pair.

Cases: lines without a word are kept and never match; null and empty texts have
no lines; rows that repeat a doc_id are taken as repeats of one row; rows with
a null doc_id keep all lines and match nothing; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import map_batches, map_partitions, ship, stored
from .memo import spread

BUCKETS = 1 << 18
FEED = np.zeros(256, bool)
FEED[0x0A] = True


RUN_BYTES = 1 << 19


def _within_lines(line: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by line, then value: one sort by the upper 44 bits where lines are few
    enough, then the rare ties by all bits."""
    if len(line) and line[-1] < 1 << 20:
        key = (line.astype(np.uint64) << np.uint64(44)) | (value >> np.uint64(20))
        order = np.argsort(key)
        key = key[order]
        tie = np.flatnonzero(key[1:] == key[:-1])
        if not (value[order[tie + 1]] != value[order[tie]]).any():
            return order
    return np.lexsort((value, line))


class _Lines:
    """Lines with a word of a chunk: row, number in the row, and their distinct
    tokens ``token`` (line l owns first[l] .. first[l + 1], ascending)."""

    def __init__(self, chunk: tb.Chunk):
        w = tb.words(chunk)
        feeds = np.concatenate([[0], np.cumsum(chunk.data == 0x0A)])
        line = feeds[w.starts]  # line feeds before, over the chunk
        key = line + w.row  # rows also part lines
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        l_of = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        self.row = w.row[at]
        self.number = line[at] - feeds[chunk.offsets[:-1]][self.row]
        order = _within_lines(l_of, w.hashes)
        h, l_of = w.hashes[order], l_of[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (l_of[1:] != l_of[:-1])
        self.token, self.line = h[keep], l_of[keep]
        self.first = np.searchsorted(self.line, np.arange(len(at) + 1))
        self.size = np.diff(self.first)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """96-bit name of each token set."""
        out = []
        for salt in (0, 0x2545F491):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(tb.mix(self.token + np.uint64(salt)))])
            out.append(tb.mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.size.astype(np.uint64)))
        return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


COLUMNS = ["kind", "doc_id", "number", "h1", "h2", "counts"]
SLICE = 1 << 12


def scan(docs: DataFrame) -> DataFrame:
    """Lines (kind 0: doc_id, number, name), token counters (kind 1: slice of ``SLICE``
    buckets in ``doc_id``, their ``counts``) and lines per document (kind 2: count in ``h1``)."""

    def rows(kind, doc_id, number, h1, h2, counts=None):
        n = len(doc_id)
        full = lambda x: x if isinstance(x, np.ndarray) else np.full(n, x)
        types = (pa.int8(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
        arrays = [pa.array(full(x), t) for x, t in zip((kind, doc_id, number, h1, h2), types, strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.nulls(n, pa.binary()) if counts is None else pa.array(counts, pa.binary())], COLUMNS)

    def run(batches):
        table = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for chunk in tb.chunks(batch.column("text"), RUN_BYTES):
                ls = _Lines(chunk)
                table += np.bincount((ls.token % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[chunk.lo : chunk.hi]
                yield rows(0, ids[ls.row], ls.number, *ls.names())
                yield rows(2, ids, 0, np.bincount(ls.row, minlength=chunk.rows), 0)
        slices = table.reshape(-1, SLICE)
        at = np.flatnonzero(slices.any(axis=1))
        yield rows(1, at, 0, 0, 0, [x.tobytes() for x in slices[at]])

    return map_partitions(docs, run, "kind byte, doc_id long, number int, h1 long, h2 int, counts binary")


def _counters(scanned: DataFrame) -> np.ndarray:
    """Token counters of all tasks; buckets without a token have 1."""

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in group["counts"].to_pylist()], axis=0)
        return pa.table({"at": group["doc_id"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    ship(scanned.sparkSession)
    table = np.zeros(BUCKETS, np.int64)
    for r in scanned.where("kind = 1").select("doc_id", "counts").groupBy("doc_id").applyInArrow(add, "at long, counts binary").collect():  # at most BUCKETS / SLICE rows
        table[r["at"] * SLICE : (r["at"] + 1) * SLICE] = np.frombuffer(r["counts"], np.int64)
    return np.maximum(table, 1)


def _ranked(token: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Names and orders prefix tokens, rare ones (in steps of an eighth) first; a tie only adds candidates."""
    rank = np.minimum(6 * np.log2(counts), 255).astype(np.uint64)
    return (rank[(token % np.uint64(BUCKETS)).astype(np.int64)] << np.uint64(56)) | (token >> np.uint64(8))


#: Prefix entry.  ``side``: 0 in a group of one block of lines, in a group of two
#: blocks 1 (the lower) or 2.
ENTRY = np.dtype([("group", "<u4"), ("h1", "<i8"), ("h2", "<i4"), ("parity", "<u8"), ("parity2", "<u8"), ("size", "<u4"), ("pos", "<u4"), ("side", "u1")])


def _once(entries: np.ndarray) -> np.ndarray:
    """One entry per group, set and place (two tokens of a set may name one group)."""
    key = tb.mix((entries["group"].astype(np.uint64) << np.uint64(32)) ^ entries["h1"].view(np.uint64)) + entries["pos"]
    order = np.argsort(key)
    key = key[order]
    return entries[order[np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]]]


def _least_overlap(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    return np.ceil(t / (1 + t) * (a + b) - 1e-9)


def index(docs: DataFrame, table: np.ndarray, threshold: float, block: int, parts: int) -> DataFrame:
    """Prefix entries as packed arrays: (part, entries).  A task holds an equal set once."""
    smallest = 1.0 / (1 - threshold)  # smaller sets are similar to no other set: n / (n + 1) < t
    sent = docs.sparkSession.sparkContext.broadcast(table)  # BUCKETS counters

    def run(batches):
        counts = sent.value
        held, count = [], 0

        def flush():
            entries = _once(np.concatenate(held))
            part = (entries["group"] % np.uint32(parts)).astype(np.min_scalar_type(parts))
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([entries[order[cuts[p] : cuts[p + 1]]].tobytes() for p in full], pa.binary())], ["part", "entries"])

        for batch in batches:
            for chunk in tb.chunks(batch.column("text"), RUN_BYTES):
                ls = _Lines(chunk)
                if not len(ls.size):
                    continue
                h1, h2 = ls.names()
                mixed = tb.mix(ls.token)
                bit, upper = np.uint64(1) << (mixed >> np.uint64(58)), (mixed >> np.uint64(57)) & np.uint64(1)
                parity, parity2 = (np.bitwise_xor.reduceat(bit * half, ls.first[:-1]) for half in (upper, upper ^ np.uint64(1)))
                ranked = _ranked(ls.token, counts)
                df = counts[(ls.token % np.uint64(BUCKETS)).astype(np.int64)]
                order = _within_lines(ls.line, ranked)
                pos = np.arange(len(ranked)) - ls.first[ls.line]
                size = ls.size[ls.line]
                ok = np.flatnonzero((pos < size - np.ceil(threshold * size - 1e-9) + 1) & (size + 1 >= smallest - 1e-9))
                line, from_ = ls.line[ok], order[ok]
                blocks = (df[from_] + block - 1) // block
                mine = (tb.mix(h1[line].view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
                at = np.repeat(np.arange(len(ok)), blocks)
                other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                lo, hi = np.minimum(mine[at], other), np.maximum(mine[at], other)
                e = np.empty(len(at), ENTRY)
                e["group"] = tb.mix(ranked[from_][at] + (lo * 1_000_003 + hi).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                owner = line[at]
                e["h1"], e["h2"], e["parity"], e["parity2"], e["size"] = h1[owner], h2[owner], parity[owner], parity2[owner], size[ok][at]
                e["pos"], e["side"] = pos[ok][at], np.where(mine[at] == other, 0, np.where(mine[at] < other, 1, 2))
                held.append(e)
                count += len(e)
                if count > 1 << 19:
                    yield from flush()
                    held, count = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield from flush()

    return map_partitions(docs.select("text"), run, "part int, entries binary")


def candidates(entries: np.ndarray, threshold: float, light: float, at_once: int = 1 << 18):
    """Pairs of entry numbers that pass all filters, in bounded runs, and in the
    end, as one array, the entries of heavy groups: those with more than ``light`` pairs
    for each entry.  Of a heavy group no pair is needed."""
    order = np.argsort((entries["group"].astype(np.uint64) << np.uint64(32)) | entries["size"])
    e = entries[order]
    group, size, place = e["group"], e["size"].astype(np.int64), e["pos"].astype(np.int64)
    parities = [np.ascontiguousarray(e[p]) for p in ("parity", "parity2")]
    run = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])) if len(e) else np.zeros(0, np.int64)
    span = int(size.max() / threshold) + 2 if len(e) else 1
    key = run * span + size
    stop = np.searchsorted(key, run * span + np.floor(size / threshold + 1e-9).astype(np.int64), "right")
    partners = stop - np.arange(len(e)) - 1
    members = np.bincount(run) if len(e) else np.zeros(0, np.int64)
    passed, heavy = np.zeros(len(members), np.int64), np.zeros(len(members), bool)
    total = np.concatenate([[0], np.cumsum(partners)])
    lo = 0
    while lo < len(e):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + at_once, "right")) - 1)
        for part in range(0, int(total[hi] - total[lo]), at_once):  # one entry may have more partners than that
            if heavy[run[lo]] and heavy[run[hi - 1]] and run[lo] == run[hi - 1]:
                break
            k = np.arange(part, min(part + at_once, int(total[hi] - total[lo]))) + total[lo]
            i = np.searchsorted(total, k, "right") - 1
            j = i + 1 + (k - total[i])
            need = _least_overlap(size[i], size[j], threshold)
            ok = np.minimum(size[i] - place[i], size[j] - place[j]) >= need
            i, j, need = i[ok], j[ok], need[ok]
            apart = sum(np.bitwise_count(p[i] ^ p[j]).astype(np.int64) for p in parities)
            ok = apart <= size[i] + size[j] - 2 * need
            ok &= (e["h1"][i] != e["h1"][j]) | (e["h2"][i] != e["h2"][j])
            i, j = i[ok], j[ok]
            passed += np.bincount(run[i], minlength=len(passed))
            heavy = passed > light * members
            keep = ~heavy[run[i]]
            yield order[i[keep]], order[j[keep]]
        lo = hi
        if lo < len(e) and heavy[run[lo]]:  # the rest of a heavy group
            lo = int(np.searchsorted(run, run[lo], "right"))
    yield (order[heavy[run]] if len(e) else np.zeros(0, np.int64)), None


PAIRS = "gid long, a1 long, a2 int, b1 long, b2 int"


def _pairs(packed: DataFrame, threshold: float, light: float) -> DataFrame:
    """Candidate pairs (a, b), and the members a of heavy groups (``gid``; b null)."""
    names = [c.split()[0] for c in PAIRS.split(", ")]

    def rows(gid, a, b):
        n = len(a)
        other = [pa.array(b["h1"]), pa.array(b["h2"])] if b is not None else [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
        gid = pa.nulls(n, pa.int64()) if gid is None else pa.array(gid, pa.int64())
        return pa.RecordBatch.from_arrays([gid, pa.array(a["h1"]), pa.array(a["h2"]), *other], names)

    def run(batches):
        blobs = [x.as_py() for b in batches for x in b.column("entries")]
        entries = _once(np.frombuffer(b"".join(blobs), ENTRY))
        del blobs
        for i, j in candidates(entries, threshold, light):
            a = entries[i]
            if j is None:
                yield rows(a["group"].astype(np.int64), a, None)
                continue
            b = entries[j]
            swap = (a["h1"] > b["h1"]) | ((a["h1"] == b["h1"]) & (a["h2"] > b["h2"]))
            yield rows(None, np.where(swap, b, a), np.where(swap, a, b))

    return map_partitions(packed.select("entries"), run, PAIRS)


FILTER = 1 << 22


def _token_sets(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """Token sets of the candidates: a pass over the texts that lets through the sets
    whose slot in a filter of ``FILTER`` slots is taken, then a join."""
    slots = np.zeros(FILTER, bool)
    for r in ends.select(F.pmod("h1", F.lit(FILTER)).alias("s")).distinct().toLocalIterator():  # at most FILTER rows
        slots[r["s"]] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(slots))

    def run(batches):
        taken, seen = np.unpackbits(sent.value).astype(bool), set()
        for batch in batches:
            for chunk in tb.chunks(batch.column("text"), RUN_BYTES):
                ls = _Lines(chunk)
                h1, h2 = ls.names()
                pick = [x for x in np.flatnonzero(taken[h1 % FILTER]).tolist() if h1[x] not in seen]
                if len(seen) < 1 << 16:  # only spares repeats
                    seen.update(h1[pick].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(h1[pick]), pa.array(h2[pick]), pa.array([ls.token[ls.first[x] : ls.first[x + 1]].tobytes() for x in pick], pa.binary())], ["h1", "h2", "tokens"])

    found = map_partitions(docs.select("text"), run, "h1 long, h2 int, tokens binary")
    return found.join(ends, ["h1", "h2"], "left_semi").dropDuplicates(["h1", "h2"])


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    side = lambda p: sets.select(F.col("h1").alias(p + "1"), F.col("h2").alias(p + "2"), F.col("tokens").alias("t" + p))
    joined = pairs.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"]).select("a1", "a2", "b1", "b2", "ta", "tb")

    def step(batch):
        for chunk_lo in range(0, batch.num_rows, 4096):
            part = batch.slice(chunk_lo, 4096)
            sizes, rows = [], []
            flat = []
            for name in ("ta", "tb"):
                bodies = part.column(name).to_pylist()
                n = np.array([len(x) // 8 for x in bodies])
                sizes.append(n)
                rows.append(np.repeat(np.arange(len(bodies)), n))
                flat.append(np.frombuffer(b"".join(bodies), np.uint64))
            row, token = np.concatenate(rows), np.concatenate(flat)
            order = np.lexsort((token, row))
            row, token = row[order], token[order]
            twice = (token[1:] == token[:-1]) & (row[1:] == row[:-1])
            overlap = np.bincount(row[1:][twice], minlength=part.num_rows)
            ok = overlap >= threshold * (sizes[0] + sizes[1] - overlap) - 1e-9
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("a1", "a2", "b1", "b2")], ["a1", "a2", "b1", "b2"]).filter(pa.array(ok))

    return map_batches(joined, step, "a1 long, a2 int, b1 long, b2 int")


MEMBERS = "part int, bundle long, cell long, side byte, h1 long, h2 int, pos int"
CELL = 4096


def _connected(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least number of the component of each of n nodes."""
    least = np.arange(n)
    while len(i):
        low = np.minimum(least[i], least[j])
        open_ = np.flatnonzero((least[i] != low) | (least[j] != low))
        if not len(open_):
            break
        for side in (i, j):
            np.minimum.at(least, least[side[open_]], low[open_])
            np.minimum.at(least, side[open_], low[open_])
        least = least[least]
    return least


def _cells(e: np.ndarray, least: np.ndarray, parts: int, cell: int = CELL, at_once: int = 1 << 20):
    """Batches of ``MEMBERS``: the entries dealt into cells.  Entries of a group that candidates connect (``least``: the least name
    among them) are one cell; over ``cell`` entries are cut into shares that meet pair by pair, as blocks of lines do (``side``).  Cells
    with the same least name are one bundle, so groups of the same near copies share a task."""
    order = np.argsort(tb.mix((e["group"].astype(np.uint64) << np.uint64(32)) ^ least.view(np.uint64)))
    e, least = e[order], least[order]
    head = np.flatnonzero(np.concatenate([[True], (e["group"][1:] != e["group"][:-1]) | (least[1:] != least[:-1])])) if len(e) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([head, [len(e)]]))
    shares = np.repeat(1 << np.ceil(np.log2(np.maximum(n / cell, 1))).astype(np.int64), n)
    total = np.concatenate([[0], np.cumsum(shares)])
    lo = 0
    while lo < len(e):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + at_once, "right")) - 1)
        at = np.repeat(np.arange(lo, hi), shares[lo:hi])
        other = np.arange(len(at)) + total[lo] - total[at]
        mine = (tb.mix(e["h1"][at].view(np.uint64) + np.uint64(1)) % shares[at].astype(np.uint64)).astype(np.int64)
        was = e["side"][at]
        first = np.where(was == 0, np.minimum(mine, other), np.where(was == 1, mine, other))
        second = np.where(was == 0, np.maximum(mine, other), np.where(was == 1, other, mine))
        side = np.where(was > 0, was, np.where(mine == other, 0, np.where(mine < other, 1, 2)))
        salt = (first * 1_000_003 + second).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bundle = tb.mix(least[at].view(np.uint64) + salt)
        columns = [(bundle % np.uint64(parts)).astype(np.int32), bundle.view(np.int64), tb.mix(tb.mix(e["group"][at].astype(np.uint64) + salt) + least[at].view(np.uint64)).view(np.int64), side.astype(np.int8), e["h1"][at], e["h2"][at], e["pos"][at].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [c.split()[0] for c in MEMBERS.split(", ")])
        lo = hi


def _members(packed: DataFrame, threshold: float, light: float, parts: int) -> DataFrame:
    """Cells of the entries that have a candidate in their group, and of all entries of heavy groups."""

    def run(batches):
        blobs = [x.as_py() for b in batches for x in b.column("entries")]
        entries = _once(np.frombuffer(b"".join(blobs), ENTRY))
        del blobs
        entries = entries[np.argsort(entries["h1"])]  # numbers go by name
        *pairs, (heavy, _) = candidates(entries, threshold, light)  # at most ``light`` pairs for each entry
        i, j = (np.concatenate([x[k].astype(np.int32) for x in pairs] or [np.zeros(0, np.int32)]) for k in (0, 1))
        del pairs
        new = np.concatenate([[True], entries["group"][heavy][1:] != entries["group"][heavy][:-1]])[: len(heavy)]
        i, j = np.concatenate([i, heavy]), np.concatenate([j, heavy[np.flatnonzero(new)][np.cumsum(new) - 1]])
        has = np.zeros(len(entries), bool)
        has[i] = has[j] = True
        least = entries["h1"][_connected(len(entries), i, j)]
        del i, j
        yield from _cells(entries[has], least[has], parts)

    return map_partitions(packed.select("entries"), run, MEMBERS)


def _in_rows(sets: list[np.ndarray], names: np.ndarray) -> np.ndarray:
    """(set, name) matrix of the names (sorted) that each set has."""
    out = np.zeros((len(sets), len(names)), np.float32)
    if len(names):
        token, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(names, token), len(names) - 1)
        hit = names[at] == token
        out[row[hit], at[hit]] = 1
    return out


def linked_pairs(sets: list[np.ndarray], cells: list[tuple[int, np.ndarray, np.ndarray]], threshold: float, step: int = 512, wide: int = 1 << 13):
    """Similar pairs of a bundle, as (i, j) number arrays with i < j, block by block of ``step`` sets.  Tokens are
    numbers in the order of rarity; ``cells``: (token, members, sides), by token.  A pair belongs to the cell of the first
    token that both sets have, so no other bundle has it."""
    size = np.array([len(x) for x in sets])
    for a in range(0, len(sets), step):
        for b in range(a, len(sets), step):
            p, q = sets[a : a + step], sets[b : b + step]
            names = np.unique(np.concatenate(p))
            if a < b:
                names = np.intersect1d(names, np.concatenate(q))
            common = np.zeros((len(p), len(q)), np.float32)
            mine = np.zeros(common.shape, bool)
            todo = []
            for token, members, side in cells:
                x, y = ((members >= c) & (members < c + step) for c in (a, b))
                if x.any() and y.any():
                    todo.append((int(np.searchsorted(names, token)), members[x] - a, side[x], members[y] - b, side[y]))
            todo.append((len(names), None, None, None, None))
            at = k = 0
            for lo in range(0, max(len(names), 1), wide):
                some = names[lo : lo + wide]
                left = _in_rows(p, some)
                right = left if a == b else _in_rows(q, some)
                while k < len(todo) and todo[k][0] <= lo + len(some):
                    stop, i, si, j, sj = todo[k]
                    if stop > at:
                        common += left[:, at - lo : stop - lo] @ right[:, at - lo : stop - lo].T
                        at = stop
                    if i is not None:
                        for u, v in ((0, 0), (1, 2), (2, 1)) if si.any() else ((0, 0),):
                            cut = np.ix_(i[si == u], j[sj == v])
                            if cut[0].size and cut[1].size:
                                mine[cut] |= common[cut] == 0
                    k += 1
                if at < lo + len(some):
                    common += left[:, at - lo :] @ right[:, at - lo :].T
                    at = lo + len(some)
            mine &= common >= threshold * (size[a : a + step, None] + size[None, b : b + step] - common) - 1e-9
            if a == b:
                mine = np.triu(mine, 1)
            i, j = np.nonzero(mine)
            yield i + a, j + b


FEW = 32


def pairs_of_few(held: np.ndarray, span: int, starts: np.ndarray, size: np.ndarray, cuts: np.ndarray, stops: np.ndarray, of: np.ndarray, first: np.ndarray, side: np.ndarray, threshold: float, at_once: int = 1 << 16):
    """As ``linked_pairs``, for many small cells at once: cell c has the sets of[cuts[c]:stops[c]] (ascending), set s
    the tokens held[starts[s] :][: size[s]] - s * span (``held``: ascending, tokens below ``span``)."""

    def common(i, j, n):
        """Whether set j has each of the first n tokens of set i."""
        ask = held[spread(starts[i], n)] + np.repeat((j - i) * span, n)
        return held[np.minimum(np.searchsorted(held, ask), len(held) - 1)] == ask

    at = spread(cuts, stops - cuts)
    after = np.repeat(stops, stops - cuts) - at - 1
    total = np.concatenate([[0], np.cumsum(after)])
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + at_once, "right")) - 1)
        x = np.repeat(at[lo:hi], after[lo:hi])
        y = spread(at[lo:hi] + 1, after[lo:hi])
        lo = hi
        i, j, cell_token = of[x], of[y], first[x]
        need = _least_overlap(size[i], size[j], threshold)
        ok = (side[x] + side[y] == 3 * (side[x] > 0)) & (np.minimum(size[i], size[j]) >= need)
        i, j, cell_token = i[ok], j[ok], cell_token[ok]
        # a pair belongs to the cell of the first token that both sets have
        before = np.searchsorted(held, i * span + cell_token) - starts[i]
        earlier = np.flatnonzero(before)
        if len(earlier):
            n = before[earlier]
            shared = np.logical_or.reduceat(common(i[earlier], j[earlier], n), np.cumsum(n) - n)
            ok = np.ones(len(i), bool)
            ok[earlier[shared]] = False
            i, j = i[ok], j[ok]
        if len(i):
            n = size[i]
            overlap = np.add.reduceat(common(i, j, n), np.cumsum(n) - n, dtype=np.int64)
            ok = overlap >= threshold * (n + size[j] - overlap) - 1e-9
            yield i[ok], j[ok]


LINKED = "h1 long, h2 int, n_links long, doc_id long, number int"


def _links_of_task(batches, counts: np.ndarray, threshold: float, few: int = FEW, step: int = 512):
    """The task of ``_count_links``; cells of up to ``few`` sets are compared many at once."""
    held = {False: [], True: []}
    for batch in batches:
        held[True].append(batch.filter(batch.column("bundle").is_null()).select(["h1", "h2", "doc_id", "number", "tokens"]))
        held[False].append(batch.filter(batch.column("bundle").is_valid()).select([c.split()[0] for c in MEMBERS.split(", ")]))
    if not sum(len(x) for x in held[False]):
        return
    m, s = (pa.Table.from_batches(held[kind]) for kind in (False, True))
    held.clear()
    s = s.sort_by([("doc_id", "ascending"), ("number", "ascending")])
    name = lambda t: tb.mix(t["h1"].to_numpy().view(np.uint64) + tb.mix(t["h2"].to_numpy().astype(np.uint64)))
    by_name = np.argsort(name(s), kind="stable")
    of = by_name[np.searchsorted(name(s)[by_name], name(m))]  # number of each member's set: earlier sets have lower ones
    bodies = s["tokens"].to_pylist()
    size = np.array([len(x) // 8 for x in bodies])
    s = s.drop_columns(["tokens"])
    vocabulary, token = np.unique(np.frombuffer(b"".join(bodies), np.uint64), return_inverse=True)
    del bodies
    place = np.empty(len(vocabulary), np.int64)
    place[np.argsort(_ranked(vocabulary, counts), kind="stable")] = np.arange(len(vocabulary))
    held = np.sort(np.repeat(np.arange(len(size)), size) * len(vocabulary) + place[token])  # set and token, rare tokens first
    token = held % len(vocabulary)
    ends = np.cumsum(size)
    first = token[ends[of] - size[of] + m["pos"].to_numpy()]
    bundle, cell, side = (m[c].to_numpy() for c in ("bundle", "cell", "side"))
    order = np.lexsort((of, cell, first, bundle))
    bundle, cell, side, first, of = (x[order] for x in (bundle, cell, side, first, of))
    n_links, other = np.zeros(len(size), np.int64), np.full(len(size), len(size))

    def count(i, j):
        np.add.at(n_links, i, 1)
        np.add.at(n_links, j, 1)
        np.minimum.at(other, j, i)

    new = np.concatenate([[True], bundle[1:] != bundle[:-1]])
    cuts = np.flatnonzero(new | np.concatenate([[True], (cell[1:] != cell[:-1]) | (first[1:] != first[:-1])]))  # one hash may name the groups of two tokens
    stops = np.append(cuts[1:], len(of))
    small = stops - cuts <= few
    for i, j in pairs_of_few(held, len(vocabulary), ends - size, size, cuts[small], stops[small], of, first, side, threshold):
        count(i, j)
    cuts, stops = cuts[~small], stops[~small]
    which = np.cumsum(new)[cuts]
    heads = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else np.zeros(0, np.int64)
    for lo, hi in zip(heads, np.append(heads, len(which))[1:], strict=True):
        numbers = np.unique(np.concatenate([of[c:d] for c, d in zip(cuts[lo:hi], stops[lo:hi], strict=True)]))
        cells = [(first[c], np.searchsorted(numbers, of[c:d]), side[c:d]) for c, d in zip(cuts[lo:hi], stops[lo:hi], strict=True)]
        for i, j in linked_pairs([token[ends[x] - size[x] : ends[x]] for x in numbers], cells, threshold, step):
            count(numbers[i], numbers[j])
    at = np.flatnonzero(n_links)
    to = pa.array(other[at], mask=other[at] == len(size))
    of, to = s.take(pa.array(at)), s.take(to)
    for batch in pa.table([of["h1"], of["h2"], pa.array(n_links[at]), to["doc_id"], to["number"]], names=[c.split()[0] for c in LINKED.split(", ")]).to_batches():
        yield batch


def _count_links(members: DataFrame, sets: DataFrame, table: np.ndarray, threshold: float, parts: int) -> DataFrame:
    """Of each set (``sets``: with tokens, doc_id and number of the first line) that is similar to others: how many, and the first
    line of the earliest before it (null: none before it), per task.  A task gets a set once, and pairs are counted where they are found: none becomes a row."""
    sent = members.sparkSession.sparkContext.broadcast(table)  # BUCKETS counters
    bodies = members.select("part", "h1", "h2").distinct().join(sets, ["h1", "h2"])
    rows = members.unionByName(bodies, allowMissingColumns=True).repartition(parts, "part")
    return map_partitions(rows, lambda batches: _links_of_task(batches, sent.value, threshold), LINKED)


def earliest_similar(sets: list[np.ndarray], threshold: float, at_once: int = 1 << 22) -> np.ndarray:
    """For each of many token sets, given by their order of first occurrence, the number of
    the first one before it that is similar (-1: none)."""
    n = len(sets)
    out = np.full(n, -1, np.int64)
    if n < 2:
        return out
    size = np.array([len(x) for x in sets])
    names, token = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    left, lo, step = np.arange(1, n), 0, 16
    while len(left):  # all sets that are left against sets lo .. lo + step
        hi = min(lo + step, n)
        mine = token[ends[lo] - size[lo] : ends[hi - 1]]
        used, column = np.unique(mine, return_inverse=True)
        slot = np.full(len(names), len(used))
        slot[used] = np.arange(len(used))
        block = np.zeros((hi - lo, len(used) + 1), bool)  # the last column: tokens of none of these sets
        block[np.repeat(np.arange(hi - lo), size[lo:hi]), column] = True
        done = np.zeros(len(left), bool)
        some_at_once = max(1, at_once // ((hi - lo) * max(1, int(size.max()))))
        for at in range(0, len(left), some_at_once):
            some = left[at : at + some_at_once]
            lengths = size[some]
            where = spread(ends[some] - lengths, lengths)
            overlap = np.add.reduceat(block[:, slot[token[where]]], np.cumsum(lengths) - lengths, axis=1, dtype=np.int64)
            similar = overlap >= threshold * (size[lo:hi, None] + lengths - overlap) - 1e-9
            similar &= np.arange(lo, hi)[:, None] < some
            hit = similar.any(0)
            out[some[hit]] = lo + similar[:, hit].argmax(0)
            done[at : at + len(some)] = hit
        left = left[~done & (left > hi)]
        lo, step = hi, min(2 * step, 512)
    return out


def _heavy_links(members: DataFrame, sets: DataFrame, firsts: DataFrame, threshold: float) -> DataFrame:
    """``h1, h2, other``: of each member of a heavy group the first similar set before it.
    A group has at most two blocks of lines."""
    ship(members.sparkSession)
    rows = members.join(sets, ["h1", "h2"]).join(firsts, ["h1", "h2"]).select("gid", "h1", "h2", "tokens", F.col("first.doc_id").alias("doc_id"), F.col("first.number").alias("number"))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("number", "ascending")])
        other = earliest_similar([np.frombuffer(x, np.uint64) for x in group["tokens"].to_pylist()], threshold)
        at = np.flatnonzero(other >= 0)
        of, to = group.take(pa.array(at)), group.take(pa.array(other[at]))
        return pa.table([of["h1"], of["h2"], to["doc_id"], to["number"]], names=["h1", "h2", "doc_id", "number"])

    found = rows.groupBy("gid").applyInArrow(run, "h1 long, h2 int, doc_id long, number int")
    return found.select("h1", "h2", F.struct("doc_id", "number").alias("other"))


def find_lines(docs: DataFrame, threshold: float = 0.8, block: int = 200_000, light: int | None = 8, links: bool = True) -> tuple[DataFrame, DataFrame]:
    """Lines that go (doc_id, number, and ``cut``, the first line that they match), and
    (doc_id, n_lines, n_links) of every document; ``n_links`` (different token sets similar
    to each of its lines) only with ``links``.  ``light`` None: no group is heavy."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    scanned = stored(scan(docs), "lines")
    lines = scanned.where("kind = 0").select("doc_id", "number", "h1", "h2")
    table = _counters(scanned)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(table.sum() // 8_000_000))
    packed = index(docs, table, threshold, block, parts)

    def linked(light: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        found = stored(_pairs(packed.repartition(parts, "part"), threshold, light).distinct(), "line-pairs")
        pairs = found.where("gid IS NULL").select("a1", "a2", "b1", "b2")
        members = found.where("gid IS NOT NULL").select("gid", F.col("a1").alias("h1"), F.col("a2").alias("h2"))
        ends = pairs.select(F.col("a1").alias("h1"), F.col("a2").alias("h2")).unionAll(pairs.select("b1", "b2")).unionAll(members.select("h1", "h2")).distinct()
        ends = stored(ends, "line-ends")
        sets = stored(_token_sets(docs, ends), "line-tokens")
        return members, ends, sets, stored(_verify(pairs, sets, threshold), "line-links")

    def known(ends: DataFrame) -> DataFrame:
        """Sets that come more than once or are in ``ends`` (``linked``), with their first line."""
        # one number for doc_id and line: its least is found by hashing, that of a struct by sorting all lines
        at = (F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("number").cast("decimal(10,0)")).cast("decimal(32,0)").alias("at")
        every = lines.select("h1", "h2", at).groupBy("h1", "h2").agg(F.min("at").alias("at"), F.count("*").alias("n"))
        every = every.join(ends.withColumn("linked", F.lit(True)), ["h1", "h2"], "left").where("n > 1 OR linked")
        number = F.pmod("at", F.lit(1 << 32).cast("decimal(10,0)"))
        doc_id = ((F.col("at") - number) / F.lit(1 << 32).cast("decimal(10,0)")).cast("long")
        return stored(every.select("h1", "h2", F.struct(doc_id.alias("doc_id"), number.cast("int").alias("number")).alias("first"), "linked"), "line-sets")

    here = F.struct("doc_id", "number")
    counts = scanned.where("kind = 2").groupBy("doc_id").agg(F.max("h1").alias("n_lines"))
    if links:
        members = stored(_members(packed.repartition(parts, "part"), threshold, np.inf if light is None else light, parts), "line-members")
        ends = stored(members.select("h1", "h2").distinct(), "line-ends")
        every = known(ends)
        sets = _token_sets(docs, ends).join(every.where("linked").select("h1", "h2", "first.*"), ["h1", "h2"])
        found = _count_links(members, sets, table, threshold, parts)
        best = stored(found, "line-links").groupBy("h1", "h2").agg(F.sum("n_links").alias("n_links"), F.min(F.when(F.col("doc_id").isNotNull(), here)).alias("other"))
        cut = every.join(best, ["h1", "h2"], "left").select("h1", "h2", F.least("first", F.coalesce("other", "first")).alias("cut"), "n_links")
        hit = stored(lines.join(cut, ["h1", "h2"]).where((here > F.col("cut")) | F.col("n_links").isNotNull()).select("doc_id", "number", "cut", "n_links"), "line-matches")
        per_line = hit.where("n_links IS NOT NULL").select("doc_id", "number", "n_links").distinct()  # rows that repeat a doc_id
        counts = counts.join(per_line.groupBy("doc_id").agg(F.sum("n_links").alias("n_links")), "doc_id", "left")
        return hit.where(here > F.col("cut")).select("doc_id", "number", "cut"), counts

    members, ends, sets, similar = linked(np.inf if light is None else light)
    every = known(ends)
    firsts = every.where("linked").select("h1", "h2", "first")
    side = lambda x: firsts.select(F.col("h1").alias(x + "1"), F.col("h2").alias(x + "2"), F.col("first").alias("f" + x))
    later_ones = similar.join(side("a"), ["a1", "a2"]).join(side("b"), ["b1", "b2"])
    a_later = F.col("fa") > F.col("fb")
    later = lambda k: F.when(a_later, F.col("a" + k)).otherwise(F.col("b" + k)).alias("h" + k)
    later_ones = later_ones.select(later("1"), later("2"), F.least("fa", "fb").alias("other"))
    later_ones = later_ones.unionAll(_heavy_links(members, sets, firsts, threshold))
    best = later_ones.groupBy("h1", "h2").agg(F.min("other").alias("other"))
    cut = every.join(best, ["h1", "h2"], "left").select("h1", "h2", F.least("first", F.coalesce("other", "first")).alias("cut"))
    gone = lines.join(cut, ["h1", "h2"]).where(here > F.col("cut")).select("doc_id", "number", "cut")
    return stored(gone, "line-matches"), counts


def by_document(docs: DataFrame, found: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (sorted numbers), first_lines (of each
    removed line the first line that it matches, ``doc_id:number``) and n_followers
    (lines anywhere whose first match is in this document) and n_links (different token
    sets similar to each of its lines, if ``counts`` has them) of every document."""
    found = found.distinct()  # rows that repeat a doc_id
    lists = F.sort_array(F.collect_list(F.struct("number", F.concat_ws(":", "cut.doc_id", "cut.number").alias("first")))).alias("gone")  # bounded by the document
    followers = found.groupBy(F.col("cut.doc_id").alias("doc_id")).agg(F.count("*").alias("n_followers"))
    per = counts.join(found.groupBy("doc_id").agg(lists), "doc_id", "left").join(followers, "doc_id", "left")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(per, "doc_id", "left")
    none = lambda kind: F.array().cast(f"array<{kind}>")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    numbers, firsts = F.coalesce(F.col("gone.number"), none("int")), F.coalesce(F.col("gone.first"), none("string"))
    return out.select("doc_id", zero(F.col("n_lines")).alias("n_lines"), F.size(numbers).cast("long").alias("n_removed"), numbers.alias("removed_lines"), firsts.alias("first_lines"), zero(F.col("n_followers")).alias("n_followers"), *[zero(F.col("n_links")).alias("n_links") for c in counts.columns if c == "n_links"])


def drop_lines(docs: DataFrame, found: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents without their removed lines; a document that loses all its lines
    goes.  ``text`` (and ``n_chars``, if there is one) change, all columns stay."""
    gone = found.groupBy("doc_id").agg(F.collect_set("number").alias("_gone")).join(counts, "doc_id")
    gone = gone.select(F.col("doc_id").alias("_id"), "_gone", (F.size("_gone") >= F.col("n_lines")).alias("_all"))
    joined = docs.join(gone, F.col("doc_id") == F.col("_id"), "left")
    joined = joined.where(~F.coalesce("_all", F.lit(False)))
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left)
    return joined.select(*(text.alias(c) if c == "text" else F.when(F.col("_gone").isNull(), F.col(c)).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def op6_line_dedup(docs: DataFrame) -> DataFrame:
    out = by_document(docs, *find_lines(docs))
    return out.withColumns({c: F.array_join(c, ",") for c in ("removed_lines", "first_lines")})


SQL = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS number, list_sort(list_distinct(regexp_extract_all(l[i], '[^\x20\x09-\x0D]+'))) AS ws
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS t(i)
), worded AS (SELECT * FROM lines WHERE len(ws) > 0),
sets AS (SELECT ws, min(row(doc_id, number)) AS first, row_number() OVER (ORDER BY min(row(doc_id, number))) AS sid FROM worded GROUP BY ws),
tokens AS (SELECT sid, unnest(ws) AS w, len(ws) AS n FROM sets),
ranked AS (SELECT sid, w, n, row_number() OVER (PARTITION BY sid ORDER BY df, w) AS pos FROM tokens JOIN (SELECT w, count(*) AS df FROM tokens GROUP BY w) USING (w)),
prefix AS (SELECT * FROM ranked WHERE pos <= n - ((4 * n + 4) // 5) + 1),
pairs AS (SELECT DISTINCT a.sid AS a, b.sid AS b FROM prefix a JOIN prefix b ON a.w = b.w AND a.sid < b.sid AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
links AS (SELECT a, b FROM (SELECT p.a, p.b, len(list_intersect(x.ws, y.ws)) AS o, len(x.ws) AS m, len(y.ws) AS n FROM pairs p JOIN sets x ON x.sid = p.a JOIN sets y ON y.sid = p.b) WHERE 5 * o >= 4 * (m + n - o)),
mirrored AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
best AS (SELECT a AS sid, min(s.first) AS other, count(*) AS n_links FROM mirrored JOIN sets s ON s.sid = mirrored.b GROUP BY a),
judged AS (
  SELECT w.doc_id, w.number, CASE WHEN other < s.first THEN other ELSE s.first END AS cut
  FROM worded w JOIN sets s USING (ws) LEFT JOIN best USING (sid)),
gone AS (SELECT doc_id, number, struct_extract(cut, 1) AS cut_doc, struct_extract(cut, 2) AS cut_number FROM judged WHERE row(doc_id, number) > cut),
lists AS (SELECT doc_id, count(*) AS n, string_agg(number, ',' ORDER BY number) AS numbers, string_agg(cut_doc || ':' || cut_number, ',' ORDER BY number) AS firsts FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(c.n, 0) AS n_lines, coalesce(l.n, 0) AS n_removed, coalesce(l.numbers, '') AS removed_lines,
  coalesce(l.firsts, '') AS first_lines, coalesce(f.n, 0) AS n_followers, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM worded GROUP BY doc_id) c ON c.doc_id = d.doc_id
LEFT JOIN lists l ON l.doc_id = d.doc_id LEFT JOIN (SELECT cut_doc, count(*) AS n FROM gone GROUP BY cut_doc) f ON f.cut_doc = d.doc_id
LEFT JOIN (SELECT w.doc_id, sum(n_links) AS n FROM worded w JOIN sets s USING (ws) JOIN best USING (sid) GROUP BY w.doc_id) k ON k.doc_id = d.doc_id
"""
