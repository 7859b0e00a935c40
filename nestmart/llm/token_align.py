"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is byte-level, B takes a space as ``U+2581`` and unknown characters as bytes;
a document is encoded as a space and its text.  Byte offsets where tokens of
both end cut them into groups; every A token of a group is linked to every B token of it.

Per run of documents, in Arrow: token lists are flattened with their parent
indices, token sizes are summed up within each document, and an Acero hash join on
(document, end) keeps the common ends.  Running counts of these number the groups.
Tokens are grouped by (group, id) and joined by group, so a long group
costs its distinct ids, not its token pairs; sums by (document, id pair) give the
links.  A block of documents keeps its distinct id pairs once, with the number
of its documents that hold each (``Table.group_by``), and its documents name
them by place.

Spark adds up the blocks' partial counts, ranks them within each A id, and
joins them back to the blocks' own lists: a pair that is everywhere moves once for
each block, not once for each document.

Ids of a unit (text from a space that follows other text up to the next such place;
no token of either tokenizer goes across one) are kept per worker by a 64-bit hash.

Cases: null and empty texts, and texts that a tokenizer does not give back byte
for byte, have no tokens: zeros, an empty group text; very long texts make a
block of their own; repeated rows, and rows with one or a null doc_id, count as documents of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_partitions, ship, stored
from .memo import Memo
from .textbytes import _BASE, _INVERSE, _WEIGHTS, Chunk, chunks, mix, plain, powers

UNIT_ENTRIES, PER_CALL = 1_000_000, 4096
RUN_BYTES = 1 << 19
BLOCK_BYTES = 4 << 20
PAIR_ROWS = 8_000_000
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
SCHEMA = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, places binary, times binary, pairs array<long>, docs array<long>"


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters stand for themselves, the others, in order, for U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def unit_starts(rows: Chunk) -> np.ndarray:
    """Row starts, and every space right after a character that is no white space."""
    data = rows.data
    before = np.concatenate([np.zeros(3, np.uint8), data])  # before[i + 3 - k] is k bytes before i
    space = np.flatnonzero(data == 0x20)
    last, two, three = before[space + 2], before[space + 1], before[space]
    # characters of more bytes may be white space: those that start with C2 or E1 to E3
    safe = (last > 0x20) & ((last < 0x80) | ((two != 0xC2) & ((three < 0xE1) | (three > 0xE3))))
    filled = rows.offsets[:-1][np.diff(rows.offsets) > 0]
    return np.union1d(filled, space[safe])


class Tokenizers:
    """Both tokenizers, their tokens' sizes, and the ids of units met before."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = byte_values()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes([value[c] for c in token]) if all(c in value for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space_b = self.b.piece_to_id("▁")
        self.size_a, self.size_b = (pa.array([len(x) for x in t], pa.int64()) for t in (self.bytes_a, self.bytes_b))
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        # decimal ids with what may follow: A's, then B's
        self.written = pa.array([f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, [",", ";", ""])) for end in ends for i in range(n)])
        self.memo = Memo([np.uint32, np.uint32, np.bool_], UNIT_ENTRIES)

    def learn(self, units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(values in a row, counts) of A's ids, B's ids and whether both give the unit back;
        a few units at a time, as encodings are large."""
        parts = [self._learn(units[i : i + PER_CALL]) for i in range(0, len(units), PER_CALL)]
        return [(np.concatenate([p[k][0] for p in parts]), np.concatenate([p[k][1] for p in parts])) for k in range(3)]

    def _learn(self, units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        texts = [u.decode() for u in units]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)  # B adds the space
        b = [[self.space_b] if u == b" " else ids for u, ids in zip(units, b, strict=True)]
        same = [b"".join([self.bytes_a[i] for i in x]) == u == b"".join([self.bytes_b[i] for i in y]) for u, x, y in zip(units, a, b, strict=True)]
        flat = lambda lists: (np.fromiter((i for x in lists for i in x), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists)))
        return [flat(a), flat(b), (np.array(same), np.ones(len(same), np.int64))]

    def __call__(self, rows: Chunk) -> tuple[pa.ListArray, pa.ListArray]:
        """A's and B's ids of each row of a chunk of spaces and texts."""
        starts = unit_starts(rows)
        if not len(starts):
            none = pa.ListArray.from_arrays(pa.array(np.zeros(rows.rows + 1, np.int32)), pa.array([], pa.uint32()))
            return none, none
        value = _WEIGHTS[rows.data]
        value *= powers(_BASE, len(value))
        hashes = mix(np.add.reduceat(value, starts) * powers(_INVERSE, len(value))[starts])
        body = rows.data.tobytes()
        stops = np.append(starts[1:], len(body))
        entries = self.memo.entries_of(hashes, lambda at: self.learn([body[x:y] for x, y in zip(starts[at].tolist(), stops[at].tolist(), strict=True)]))
        first = np.searchsorted(starts, rows.offsets)
        same, _ = self.memo.pools[2].take(entries)
        bad = np.diff(np.concatenate([[0], np.cumsum(~same)])[first]) > 0
        out = []
        for pool in self.memo.pools[:2]:
            ids, counts = pool.take(entries[~np.repeat(bad, np.diff(first))])
            units = np.where(bad, 0, np.diff(first))
            ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(units)]
            out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)))
        return out[0], out[1]


_ready: dict[tuple[str, str], Tokenizers] = {}


def tokenizers_of(paths: tuple[str, str]) -> Tokenizers:
    """The worker's tokenizers: what they have met serves later tasks, too."""
    if paths not in _ready:
        _ready[paths] = Tokenizers(*paths)
    return _ready[paths]


def ends_within(lists: pa.ListArray, sizes: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(ids, parent indices, byte offset where each token ends in its document)."""
    ids, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    running = pc.cumulative_sum(pc.take(sizes, ids))
    total = pa.concat_arrays([pa.array([0], pa.int64()), running])
    base = pc.take(total, lists.offsets.slice(0, len(lists)))
    return ids, parent, pc.subtract(running, pc.take(base, parent))


def group_numbers(n: int, cuts: np.ndarray) -> np.ndarray:
    """Group of each of n tokens, the last tokens of the groups being ``cuts``."""
    mark = np.zeros(n, np.int64)
    mark[cuts] = 1
    return np.cumsum(mark) - mark


def id_pairs(group_a, ids_a, group_b, ids_b, doc_of_group: np.ndarray, limit: int = PAIR_ROWS) -> pa.Table:
    """``doc, pair, times``: links by document and id pair (A id in the upper half).
    At most about ``limit`` rows are joined at once."""
    a = pa.table({"group": group_a, "a": pc.cast(ids_a, pa.int64())}).group_by(["group", "a"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "a", "n_a"])
    b = pa.table({"group": group_b, "b": pc.cast(ids_b, pa.int64())}).group_by(["group", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "b", "n_b"])
    rows = np.cumsum(np.bincount(b["group"].to_numpy(), minlength=len(doc_of_group))[a["group"].to_numpy()])
    cuts = [0, *np.unique(np.searchsorted(rows, np.arange(limit, rows[-1], limit), "right")).tolist(), len(rows)] if len(rows) else [0]
    parts = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if lo == hi:
            continue
        j = a.slice(lo, hi - lo).join(b, "group", join_type="inner", use_threads=False)
        doc = pc.take(pa.array(doc_of_group), j["group"])
        pair = pc.add(pc.shift_left(j["a"], pa.scalar(32, pa.int64())), j["b"])
        parts.append(pa.table({"doc": doc, "pair": pair, "times": pc.multiply(j["n_a"], j["n_b"])}).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"]))
    if not parts:
        return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
    out = pa.concat_tables(parts)
    return out if len(parts) == 1 else out.group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])


def group_texts(t: Tokenizers, lists_a, lists_b, ids_a, ids_b, group_a: np.ndarray, group_b: np.ndarray, n_groups: int) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    at_a = np.arange(len(group_a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(group_b)) + np.cumsum(in_a)[group_b]
    n_a, n_b = len(t.bytes_a), len(t.bytes_b)
    close_a, close_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
    off_a, off_b = lists_a.offsets.to_numpy(), lists_b.offsets.to_numpy()
    end_b = np.zeros(len(group_b), bool)
    end_b[off_b[1:][np.diff(off_b) > 0] - 1] = True
    codes = np.empty(len(group_a) + len(group_b), np.int64)
    codes[at_a] = ids_a.to_numpy() + n_a * close_a
    codes[at_b] = 2 * n_a + ids_b.to_numpy() + n_b * (close_b.astype(np.int64) + end_b)
    tokens = pc.take(t.written, pa.array(codes))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array((off_a + off_b).astype(np.int32)), tokens), "")


def align_run(t: Tokenizers, rows: Chunk) -> tuple[dict[str, np.ndarray], pa.Array, pa.Table]:
    """(counts of each row, group texts, links by row and id pair) of a run of rows."""
    lists_a, lists_b = t(rows)
    (ids_a, doc_a, end_a), (ids_b, doc_b, end_b) = ends_within(lists_a, t.size_a), ends_within(lists_b, t.size_b)
    key = lambda doc, end: pc.add(pc.shift_left(pc.cast(doc, pa.int64()), pa.scalar(40, pa.int64())), end)
    tokens_a = pa.table({"key": key(doc_a, end_a), "at_a": np.arange(len(ids_a))})
    tokens_b = pa.table({"key": key(doc_b, end_b), "at_b": np.arange(len(ids_b))})
    common = tokens_a.join(tokens_b, "key", join_type="inner", use_threads=False)
    cuts_a, cuts_b = np.sort(common["at_a"].to_numpy()), common["at_b"].to_numpy()
    group_a, group_b = group_numbers(len(ids_a), cuts_a), group_numbers(len(ids_b), cuts_b)
    doc_of_group = doc_a.to_numpy()[cuts_a].astype(np.int64)
    pairs = id_pairs(group_a, ids_a, group_b, ids_b, doc_of_group)
    texts = group_texts(t, lists_a, lists_b, ids_a, ids_b, group_a, group_b, len(cuts_a))
    links = np.zeros(rows.rows, np.int64)
    np.add.at(links, doc_of_group, np.bincount(group_a, minlength=len(cuts_a)) * np.bincount(group_b, minlength=len(cuts_a)))
    counts = {"n_a": np.diff(lists_a.offsets.to_numpy()).astype(np.int64), "n_b": np.diff(lists_b.offsets.to_numpy()).astype(np.int64), "n_groups": np.bincount(doc_of_group, minlength=rows.rows), "n_links": links}
    return counts, texts, pairs


def _packed(values: np.ndarray) -> bytes:
    """Size of an item, then unsigned items no wider than the largest needs."""
    wide = np.min_scalar_type(int(values.max())) if len(values) else np.dtype(np.uint8)
    return bytes([wide.itemsize]) + values.astype(wide).tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, f"<u{body[0]}", offset=1).astype(np.int64)


def align(docs: DataFrame, paths: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document (``doc_id``, the counts, ``groups``, its links as places
    in its block's list and times) and one for each block (``pairs`` with the number of
    its ``docs`` that hold them)."""
    paths = paths or default_paths()
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        t, block = tokenizers_of(paths), TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush():
            nonlocal block
            rows, pairs = 0, []
            for _, counts, _, links in held:
                pairs.append(links.set_column(0, "doc", pc.add(links["doc"], rows)))
                rows += len(counts["n_a"])
            links = pa.concat_tables(pairs).sort_by("doc")
            partial = links.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            places = pc.index_in(links["pair"], value_set=partial["pair"].combine_chunks()).to_numpy()
            times = links["times"].to_numpy()
            cut = np.searchsorted(links["doc"].to_numpy(), np.arange(rows + 1)).tolist()
            lo = 0
            for ids, counts, texts, _ in held:
                n = len(ids)
                spans = list(zip(cut[lo : lo + n], cut[lo + 1 : lo + n + 1], strict=True))
                columns = [np.full(n, block), ids, *(counts[c] for c in COUNTS), texts, pa.array([_packed(places[x:y]) for x, y in spans], pa.binary()), pa.array([_packed(times[x:y]) for x, y in spans], pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                lo += n
            lists = [pa.array([x.combine_chunks().to_numpy()], pa.list_(pa.int64())) for x in (partial["pair"], partial["count_all"])]
            yield pa.RecordBatch.from_arrays([pa.array([block]), *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()), *(pa.nulls(1, pa.binary()) for _ in range(2)), *lists], names)
            block += 1
            held.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            text = plain(batch.column("text"))
            text = pc.if_else(pc.equal(pc.binary_length(text), 0), "", pc.binary_join_element_wise(" ", text, ""))
            for rows in chunks(text, min(RUN_BYTES, block_bytes)):
                held.append((batch.column("doc_id").slice(rows.lo, rows.rows), *align_run(t, rows)))
                size += len(rows.data)
                if size >= block_bytes:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return map_partitions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, SCHEMA)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold each id pair linked, and whether no
    other pair of its A id has more (at most B's vocabulary for each A id)."""
    n = _entries(aligned).groupBy("pair").agg(F.sum("docs").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return n.select("pair", "n", (F.col("n") == top).alias("best"))


def _entries(aligned: DataFrame) -> DataFrame:
    lists = aligned.where(F.col("pairs").isNotNull())
    return lists.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "e")).select("block", "place", "e.pairs", "e.docs").withColumnRenamed("pairs", "pair")


def with_scores(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The document rows with ``n_best`` and ``count_sum``, block by block."""
    ship(aligned.sparkSession)
    told = _entries(aligned).join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    kept = ["block", "doc_id", *COUNTS, "groups_sha256", "places", "times"]
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        n, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)
        place = told["place"].to_numpy()
        n[place], best[place] = told["n"].to_numpy(), told["best"].to_numpy()
        n_best, total = [], []
        for places, times in zip(docs["places"], docs["times"], strict=True):
            at, by = _unpacked(places.as_py()), _unpacked(times.as_py())
            n_best.append(int(best[at] @ by))
            total.append(int(n[at] @ by))
        done = docs.select(["doc_id", *COUNTS])
        return done.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", docs["groups_sha256"])

    docs = aligned.where(F.col("pairs").isNull()).select(*kept)
    return docs.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(score, out)


def op11_token_align(docs: DataFrame) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = stored(align(docs).withColumn("groups_sha256", digest).drop("groups"), "token-align")
    return with_scores(aligned, pair_counts(aligned))
