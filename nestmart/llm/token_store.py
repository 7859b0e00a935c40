"""Token ids in files: frequency-ranked, byte-aligned variable-length codes.

Writing: every document is encoded (end id last) and stored; Spark counts each id
over the whole corpus; ids become ranks (0 the most frequent, ties by id), so
common ids take one byte.  Documents are range-partitioned and sorted by doc_id
and each task writes its run as blocks, through Spark's text writer: a lost
task's files are never published.

A data set is a folder with ``ranks`` (the ids in order of rank) and ``blocks``:
files of blocks, each followed by one line end.  Block, little-endian::

    FRVB, version u32, shard u64, ids before in the shard u64, documents u64,
    ids u64, control bytes u64, data bytes u64, crc32 of what follows u32
    doc_id i64 each | 1 where null u8 each | ids i64 each | control | data

A control byte holds the sizes (1 to 4 bytes, less one) of four codes, two bits
each, lowest first; the codes' bytes stand apart, so a block is decoded by
numpy: a table gives the four sizes of every control byte, their running sum
the places, another table the mask of each size.  Shards are numbered in
doc_id order; a document lies in one block.

The ranks are bounded by the tokenizer's vocabulary (collected and sent to
tasks); shard totals are one row for each write task.

Cases: a null or empty text has the end id only; very long texts make a block
larger than ``block_ids``; rows of one doc_id are ordered by a hash of their ids,
equal rows stay apart; a null doc_id comes first and is read back as null; an empty table
gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nestmart.session import scratch_path

from .common import map_partitions
from .memo import spread
from .textbytes import chunks
from .word_ids import vocabulary_path, word_ids

END_ID, VERSION = 1, 1
HEAD = struct.Struct("<4sIQQQQQQI")
TABLE = struct.Struct("<4sIQI")
#: Sizes of the four codes of every control byte; mask of every size.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_codes(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    four = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    four[: len(v)] = size - 1
    control = (four.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    kept = np.arange(4) < size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def unpack_codes(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = SIZES[control].reshape(-1)[:n]
    ends = np.cumsum(size, dtype=np.int64)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    four = np.ndarray((len(data),), "<u4", padded, 0, (1,))  # the four bytes from each place on
    return four[ends - size] & MASKS[size]


def make_block(shard: int, before: int, doc_ids: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack_codes(ranks)
    null = np.array([i is None for i in doc_ids], np.uint8)
    body = b"".join([np.array([i or 0 for i in doc_ids], "<i8").tobytes(), null.tobytes(), np.array(counts, "<i8").tobytes(), control, data])
    return HEAD.pack(b"FRVB", VERSION, shard, before, len(doc_ids), len(ranks), len(control), len(data), zlib.crc32(body)) + body


def heads(content: memoryview):
    """(place of the body, header fields) of every block of a file."""
    at = 0
    while at < len(content):
        magic, version, shard, before, docs, tokens, n_control, n_data, crc = HEAD.unpack_from(content, at)
        if magic != b"FRVB" or version != VERSION:
            raise ValueError(f"no block at byte {at}")
        yield at + HEAD.size, shard, before, docs, tokens, n_control, n_data, crc
        at += HEAD.size + 17 * docs + n_control + n_data + 1
    if at != len(content):
        raise ValueError("block cut short")


def encode_docs(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, ids`` (binary; ids in 2 bytes where the vocabulary allows it)."""
    wide = _wide(tokenizer_path, end_id)

    def run(batches):
        encode = word_ids(tokenizer_path)
        for batch in batches:
            for rows in chunks(batch.column("text")):
                ids, counts = encode(rows)
                out = np.full(len(ids) + rows.rows, end_id, wide)
                first = np.cumsum(counts + 1) - counts - 1
                out[spread(first, counts)] = ids
                offsets = np.append(first, len(out)) * out.itemsize
                body = pa.Array.from_buffers(pa.large_binary(), rows.rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(rows.lo, rows.rows), body.cast(pa.binary())], ["doc_id", "ids"])

    return map_partitions(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, ids binary")


def _wide(tokenizer_path: str, end_id: int) -> str:
    return "<u2" if max(word_ids(tokenizer_path).size, end_id + 1) <= 1 << 16 else "<u4"


def id_counts(encoded: DataFrame, wide: str) -> DataFrame:
    """``id, n`` over all documents: counted per task, added up by Spark."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for rows in chunks(batch.column("ids"), 4 << 20):
                some = np.bincount(rows.data.view(wide))
                if len(some) > len(total):
                    total = np.pad(total, (0, len(some) - len(total)))
                total[: len(some)] += some
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["id", "n"])

    return map_partitions(encoded.select("ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, block_ids: int = 1 << 20, blocks_per_file: int = 32) -> None:
    """Encode all documents and write them to ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    tokenizer_path = tokenizer_path or vocabulary_path()
    wide = _wide(tokenizer_path, end_id)
    at = scratch_path(spark, "token-ids")
    # the place of a stored row tells rows of one doc_id and equal ids apart, so that a hot doc_id can be split
    encode_docs(docs, tokenizer_path, end_id).withColumn("place", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(at)
    encoded = spark.read.schema("doc_id long, ids binary, place long").parquet(at)
    # one row for each id in use: at most the tokenizer's vocabulary
    ranked = [r["id"] for r in id_counts(encoded, wide).orderBy(F.desc("n"), "id").select("id").collect()]
    ids = np.array(ranked, "<u4").tobytes()
    table = TABLE.pack(b"FRVT", VERSION, len(ranked), zlib.crc32(ids)) + ids
    spark.createDataFrame([(bytearray(table),)], "value binary").select(F.col("value").cast("string")).coalesce(1).write.text(f"{path}/ranks")
    rank = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank[ranked] = np.arange(len(ranked), dtype=np.uint32)

    def run(batches):
        shard, before = TaskContext.get().partitionId(), 0
        doc_ids, counts, held = [], [], []

        def block():
            nonlocal before
            ranks = rank[np.concatenate(held)]
            out = make_block(shard, before, doc_ids, counts, ranks)
            before += len(ranks)
            doc_ids.clear(), counts.clear(), held.clear()
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], ["block"])

        n = 0
        for batch in batches:
            lo = 0
            for rows in chunks(batch.column("ids"), min(1 << 20, block_ids * np.dtype(wide).itemsize)):
                name = batch.column("doc_id").slice(lo, rows.rows).to_pylist()
                lo += rows.rows
                size = np.diff(rows.offsets) // np.dtype(wide).itemsize
                doc_ids += name
                counts += size.tolist()
                held.append(rows.data.view(wide).copy())
                n += int(size.sum())
                if n >= block_ids:
                    yield block()
                    n = 0
        if doc_ids:
            yield block()

    keys = ["doc_id", F.xxhash64("ids"), "place"]
    ordered = encoded.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    blocks = map_partitions(ordered, run, "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", blocks_per_file).text(f"{path}/blocks")


def read_ranks(spark: SparkSession, path: str) -> np.ndarray:
    """Ids in order of rank (at most the vocabulary)."""
    for row in spark.read.format("binaryFile").load(f"{path}/ranks").select("content").collect():
        magic, version, n, crc = TABLE.unpack_from(row["content"])
        ids = row["content"][TABLE.size : TABLE.size + 4 * n]
        if magic != b"FRVT" or version != VERSION or zlib.crc32(ids) != crc:
            raise ValueError("damaged rank table")
        return np.frombuffer(ids, "<u4")
    raise ValueError("no rank table")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/blocks").select("content")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, from the files; ids are
    little-endian unsigned 32-bit, start counts the ids of all documents before."""
    by_rank = read_ranks(spark, path)

    def bodies(batches):
        for batch in batches:
            for content in batch.column("content"):
                view = memoryview(content.as_buffer())
                for at, shard, before, docs, tokens, n_control, n_data, crc in heads(view):
                    body = view[at : at + 17 * docs + n_control + n_data]
                    if zlib.crc32(body) != crc:
                        raise ValueError(f"damaged block of shard {shard}")
                    name, null, counts = (np.frombuffer(body, t, docs, docs * o) for t, o in (("<i8", 0), ("u1", 8), ("<i8", 9)))
                    codes = np.frombuffer(body, np.uint8, offset=17 * docs)
                    ids = by_rank[unpack_codes(codes[:n_control], codes[n_control:], tokens)].astype("<u4")
                    cuts = np.concatenate([[0], np.cumsum(counts)])
                    rows = pa.Array.from_buffers(pa.large_binary(), docs, [None, pa.py_buffer(4 * cuts), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays([pa.array(name, mask=null == 1), pa.array(np.full(docs, shard)), pa.array(before + cuts[:-1]), pa.array(counts), rows.cast(pa.binary())], ["doc_id", "shard", "within", "n_tokens", "ids"])

    def totals(batches):
        for batch in batches:
            for content in batch.column("content"):
                told = [(shard, tokens) for _, shard, _, _, tokens, *_ in heads(memoryview(content.as_buffer()))]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*told, strict=True)] if told else [pa.array([], pa.int64())] * 2, ["shard", "n"])

    # one row for each write task, so small enough to send to all
    shards = map_partitions(_files(spark, path), totals, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    base = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    docs = map_partitions(_files(spark, path), bodies, "doc_id long, shard long, within long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids")


def op12_token_store(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "token-store")
    write_ids(docs, path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
