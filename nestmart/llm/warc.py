"""WARC archives of web pages, and a reader that salvages damaged ones.

Writing.  Records are plain WARC/1.1, built as string columns and written by
Spark's text writer with the record terminator as line separator, so archives
land on any store that Spark writes to.  Of pages with equal payloads the one with the
smallest page_id is a response; the others are revisits without a payload whose
stored HTTP header keeps the payload's length.

Reading.  Each archive (a few thousand records) is one task's file.  A record
is checked: version line, header without control
characters, Content-Length, terminator and block
digest.  After a failed check the reader searches for the next gzip member or
version line that passes all of them, goes on from there, and logs the bytes between as
a quarantined gap with the reason.  Plain files and files of gzip members (also
mixed) are read alike.  A member of several records is searched in the same way
inside, also what came out of it before a broken stream; its gaps count bytes of its
content and name the member (``member``), whose own place in the file is logged too
where the stream breaks.

Cases: a null html is an empty payload; a null url gets a ``urn:`` target;
control characters and blanks in a url are percent-encoded; a page without
page_id is a revisit of the smallest page_id with its payload, or a response
if there is none; repeated rows give records of equal content; an empty table gives no
archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestmart.session import scratch_path

from .common import map_batches, stored

#: Slots of the filter of payloads that come more than once (2 MB of bits).
FILTER = 1 << 24
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(text: Column) -> Column:
    """Base32 of the SHA-1 of a string's bytes: five hex digits make four base32 digits."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One WARC record per page, as column ``value`` (without terminator)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("digest", base32_sha1(F.col("html")))
    # only payloads that come more than once have anything to join; of the others, those
    # whose slot in a filter is free (most) are not shuffled
    first = pages.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first_id")
    first = stored(first, "warc-first")
    slot = 1 + F.pmod(F.xxhash64("digest"), F.lit(FILTER))
    taken = first.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    told = pages.join(F.broadcast(taken), F.bitmap_bucket_number(slot) == F.col("bucket"), "left")
    told = told.withColumn("maybe", F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))).drop("bucket", "bits")
    once = told.where(~F.col("maybe")).withColumn("first_id", F.lit(None).cast("long"))
    p = told.where("maybe").join(first, "digest", "left").unionByName(once)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("html").cast("string"), F.lit(END))
    p = p.withColumn("revisit", revisit).withColumn("block", F.when(revisit, http).otherwise(F.concat(http, "html")))
    uri = F.coalesce(F.col("url"), F.concat(F.lit("urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none"))))
    for bad, code in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        uri = F.replace(uri, F.lit(bad), F.lit(code))

    def line(name: str, value: Column) -> Column:  # no line for a null
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    refers = F.when(F.col("revisit"), _record_id(F.col("first_id"), F.col("digest")))
    profile = F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block")))),
        line("WARC-Refers-To", refers),
        line("WARC-Profile", profile),
        line("X-Page-Id", F.col("page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
    )
    return p.select(F.concat(head, "block").alias("value"))


def write_archives(pages: DataFrame, path: str, records_per_file: int = 2000) -> None:
    records(pages).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$")


def _sha1(data: bytes | memoryview) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], int, int, int] | str:
    """(headers, block start, block end, next record) of the record at a
    version line, or why it fails."""
    if not re.match(rb"WARC/\d\.\d\r\n", data[at : at + 10]):
        return "no version line"
    close = data.find(b"\r\n\r\n", at)
    if close < 0:
        return "header without end"
    head = data[at:close]
    if re.search(rb"[\x00-\x08\x0b\x0c\x0e-\x1f]", head):
        return "damaged header"
    m = _LENGTH.search(head)
    if not m:
        return "no content length"
    start = close + 4
    stop = start + int(m[1])
    if stop > len(data):
        return "block cut short"
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "no terminator"
    headers = {}
    for row in head.split(b"\r\n")[1:]:
        name, colon, value = row.decode("utf-8", "replace").partition(":")
        if colon:
            headers[name.strip().lower()] = value.strip()
    want = headers.get("warc-block-digest", "")
    if want.lower().startswith("sha1:") and want[5:] != _sha1(data[start:stop]):
        return "block digest differs"
    return headers, start, stop, stop + 4


def _member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """(content, end, damage) of the gzip member at a position; of a damaged one
    the content up to the damage, and "" as the damage of a sound one."""
    unzip, body, step = zlib.decompressobj(31), bytearray(), 1 << 16
    for lo in range(at, len(data), step):
        try:
            body += unzip.decompress(data[lo : lo + step])
        except zlib.error:
            # what comes before the damage inside the last step, byte by byte
            body += _before_damage(data[at:lo], data[lo : lo + step])
            return bytes(body), at, "damaged gzip member"
        if unzip.eof:
            return bytes(body), min(lo + step, len(data)) - len(unzip.unused_data), ""
    return bytes(body), at, "gzip member cut short"


def _before_damage(sound: bytes, last: bytes) -> bytes:
    unzip, out = zlib.decompressobj(31), bytearray()
    for lo in range(0, len(sound), 1 << 16):
        unzip.decompress(sound[lo : lo + (1 << 16)])
    try:
        for lo in range(len(last)):
            out += unzip.decompress(last[lo : lo + 1])
    except zlib.error:
        pass
    return bytes(out)


_CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")

#: ("record", start, end, (headers, block), member) or ("gap", start, end, reason, member);
#: member is None outside gzip members, else the member's position in the file.
Found = tuple[str, int, int, object, int | None]


def _inside(body: bytes, at: int, end: int) -> Iterator[Found]:
    """Records and gaps of a gzip member's content.  Records keep the member's
    place in the file, gaps count bytes of the content."""
    inner, gap, reason = 0, -1, ""
    while inner < len(body):
        rec = parse_record(body, inner)
        if isinstance(rec, str):
            if gap < 0:
                gap, reason = inner, rec
            m = _VERSION.search(body, inner + 1)
            inner = m.start() if m else len(body)
            continue
        if gap >= 0:
            yield "gap", gap, inner, reason, at
            gap = -1
        yield "record", at, end, (rec[0], body[rec[1] : rec[2]]), at
        inner = rec[3]
    if gap >= 0:
        yield "gap", gap, len(body), reason, at


def salvage(data: bytes) -> Iterator[Found]:
    """Records and gaps in order; those outside members and the members together cover all
    bytes.  Of a member whose stream breaks, the records before the damage are
    given, then the gap from the member's start to the next sound place; a record that
    a broken member stores uncompressed is found once."""
    at, gap, reason = 0, -1, ""
    given: Counter = Counter()  # records salvaged from the broken member last met
    while at < len(data):
        found: Iterator[Found] | str = "neither gzip member nor version line"
        end = at
        if data[at : at + 3] == b"\x1f\x8b\x08":
            body, end, damage = _member(data, at)
            if damage:
                found = damage
                # the search for a sound place goes on inside, so what is salvaged here is given at once
                given = Counter()
                for x in _inside(body, at, len(data)):
                    if x[0] == "record":
                        given[_sha1(x[3][1]), x[3][0].get("warc-record-id")] += 1
                        yield x
            elif body:
                found = _inside(body, at, end)
            else:
                found = iter(())
        elif data[at : at + 5] == b"WARC/":
            rec = parse_record(data, at)
            if isinstance(rec, str):
                found = rec
            else:
                end = rec[3]
                what = rec[0], data[rec[1] : rec[2]]
                name = _sha1(what[1]), rec[0].get("warc-record-id")
                found = iter([("record", at, end, what, None)])
                if gap >= 0 and given[name]:
                    given[name] -= 1
                    found = reason
        if isinstance(found, str):
            if gap < 0:
                gap, reason = at, found
            m = _CANDIDATE.search(data, at + 1)
            at = m.start() if m else len(data)
            continue
        if gap >= 0:
            yield "gap", gap, at, reason, None
            gap = -1
        yield from found
        at = end
    if gap >= 0:
        yield "gap", gap, len(data), reason, None


_SCHEMA = "file string, kind string, start long, stop long, member long, reason string, record_type string, record_id string, refers_to_id string, uri string, page_id long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of kind ``record`` and ``gap`` of every archive under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*").load(path).where(F.col("length") > 0)
    fields = [x.split() for x in _SCHEMA.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}

    def step(batch):
        for name, body in zip(batch.column("path"), batch.column("content"), strict=True):
            rows, held = [], 0
            for kind, start, stop, what, member in salvage(body.as_py()):
                row = {"file": name.as_py(), "kind": kind, "start": start, "stop": stop, "member": member}
                if kind == "gap":
                    row["reason"] = what
                else:
                    headers, block = what
                    http, _, payload = block.partition(b"\r\n\r\n") if headers.get("content-type", "").startswith("application/http") else (b"", b"", block)
                    revisit = headers.get("warc-type") == "revisit"
                    claimed = headers.get("warc-payload-digest", "").removeprefix("sha1:")
                    row |= {"record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "refers_to_id": headers.get("warc-refers-to"), "uri": headers.get("warc-target-uri")}
                    row["page_id"] = int(headers["x-page-id"]) if re.fullmatch(r"-?\d+", headers.get("x-page-id", "")) else None
                    length = _LENGTH.search(http)
                    row["payload_bytes"] = int(length[1]) if revisit and length else len(payload)
                    row["payload_digest"] = claimed if revisit else _sha1(payload)
                    row["digest_ok"] = revisit or not claimed or row["payload_digest"] == claimed
                    if with_payload and not revisit:
                        row["payload"] = payload
                        held += len(payload)
                rows.append(row)
                if len(rows) >= 5000 or held > 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))

    return map_batches(files.select("path", "content"), step, _SCHEMA)


def resolve(found: DataFrame) -> DataFrame:
    """Records with ``refers_to``: the page_id of the response that a revisit names."""
    records = found.where("kind = 'record'")
    responses = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).dropDuplicates(["refers_to_id"])
    return records.join(responses, "refers_to_id", "left")


def op7_warc(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    log = scratch_path(spark, "warc-read")
    read_archives(spark, path, with_payload=False).drop("payload").write.parquet(log)
    found = spark.read.parquet(log)  # records and quarantined gaps
    return resolve(found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")
