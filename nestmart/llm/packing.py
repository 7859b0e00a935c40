"""Cost-balanced sequence packing.

A document's ids are its tokens and one end id.  A piece of n ids costs
``n + n * n / quadratic`` (linear layers plus attention).  Each task packs the documents
of its partition, so packing needs no shuffle: full sequences are cut off long
documents first; what remains is taken in descending cost, each piece going to
the open sequence of lowest cost that has room for it whole; if none has,
it is cut to fill the cheapest one and its rest goes on.  As many
sequences are opened as the remaining ids fill, so a task pads fewer than
``size`` ids in all.

Tokens: white space separates words for this tokenizer, so the ids of a text are
those of its words in order (``word_ids``).

Cases: a null or empty text is one id (the end id); very long texts are cut
into full sequences; repeated rows are packed one by one; a null doc_id is
carried as null; an empty table gives an empty result; other columns are
ignored.  Sequence ids join the partition number and a number
within it, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_partitions
from .textbytes import chunks
from .word_ids import vocabulary_path, word_ids

SIZE, END_ID = 2048, 1
WORDS_KEPT = 500_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


def cost(n: int, quadratic: float) -> float:
    return n + n * n / quadratic


class OpenSequences:
    """Sequences with room left: a heap by cost for every amount of room, and a
    tree over the amounts that knows the cheapest of each range."""

    def __init__(self, size: int, sequences: range):
        self.width = 1 << size.bit_length()
        self.heaps: list[list] = [[] for _ in range(size + 1)]
        self.heaps[size] = [(0.0, s) for s in sequences]
        self.best = [(float("inf"), 0, 0)] * (2 * self.width)
        self._renew(size)

    def _renew(self, room: int) -> None:
        heap, best, i = self.heaps[room], self.best, room + self.width
        best[i] = (*heap[0], room) if heap else (float("inf"), 0, 0)
        while i > 1:
            i >>= 1
            best[i] = min(best[2 * i], best[2 * i + 1])

    def take(self, room: int) -> tuple[float, int, int] | None:
        """Remove the cheapest sequence with at least so much room: (cost, sequence, room)."""
        i = room + self.width
        found = self.best[i]
        while i > 1:
            if not i & 1:
                found = min(found, self.best[i + 1])
            i >>= 1
        if not found[2]:
            return None
        heapq.heappop(self.heaps[found[2]])
        self._renew(found[2])
        return found

    def put(self, spent: float, sequence: int, room: int) -> None:
        heapq.heappush(self.heaps[room], (spent, sequence))
        self._renew(room)


def assign(lengths: np.ndarray, size: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces."""
    pieces, sequence, rest = [], 0, []
    for d, n in enumerate(lengths.tolist()):
        start = 0
        while n - start >= size:
            pieces.append((d, start, size, sequence, 0))
            sequence += 1
            start += size
        if n > start:
            rest.append((n - start, d, start))
    rest.sort(key=lambda x: (-x[0], x[1]))
    opened = -(-sum(x[0] for x in rest) // size)
    free = OpenSequences(size, range(sequence, sequence + opened))
    for n, d, start in rest:
        while n:
            spent, s, room = free.take(n) or free.take(1)  # whole if it fits anywhere, else cut
            take = min(n, room)
            pieces.append((d, start, take, s, size - room))
            if take < room:
                free.put(spent + cost(take, quadratic), s, room - take)
            start += take
            n -= take
    return pieces


def pack(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = END_ID, quadratic: float = 1024.0, group_ids: int = 8 << 20) -> DataFrame:
    """Pieces of all documents.  A task packs its partition in groups of about
    ``group_ids`` ids to bound its memory."""
    path = tokenizer_path or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, partition, sequences = word_ids(path, WORDS_KEPT), TaskContext.get().partitionId(), 0
        ids: list = []
        bodies: list[bytes] = []
        held = 0

        def flush():
            nonlocal sequences, held
            lengths = np.array([len(b) // 4 for b in bodies], np.int64)
            rows = assign(lengths, size, quadratic)
            views = [memoryview(b) for b in bodies]
            d, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            crc = np.array([zlib.crc32(views[p[0]][4 * p[1] : 4 * (p[1] + p[2])]) for p in rows], np.int64)
            seq_ids = (partition << 40) + sequences + seq
            sequences += int(seq.max()) + 1
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in d], pa.int64()), *(pa.array(x) for x in (start, length, crc, lengths[d], seq_ids, offset)), pa.array(length + length * length / quadratic)], [x.split()[0] for x in SCHEMA.split(", ")])
            ids.clear()
            bodies.clear()
            held = 0
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for rows in chunks(batch.column("text")):
                found, counts = encode(rows)
                body, at = found.tobytes(), np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
                for doc_id, x, y in zip(batch.column("doc_id").slice(rows.lo, rows.rows).to_pylist(), at, at[1:], strict=False):
                    ids.append(doc_id)
                    bodies.append(body[x:y] + end)
                    held += (y - x) // 4 + 1
                    if held >= group_ids:
                        yield from flush()
        if bodies:
            yield from flush()

    return map_partitions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, SCHEMA)


def op5_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
