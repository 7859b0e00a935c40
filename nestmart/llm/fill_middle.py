"""Fill-in-the-middle rearrangement by content-defined chunk memoization.

Units are ``[A-Za-z]+|[^A-Za-z]``, matched left to right over code points.  A rolling
hash over the last ``WINDOW`` bytes cuts a text into chunks where its content
says so, so texts that share a passage share chunks.  Each chunk's *boundary
summary* (unit starts, whether its first and last characters are letters, code points) is
worked out once per worker and kept by the chunk's bytes: a later equal chunk is
found by hash and verified by content.  Summaries combine like counts: of two
neighbours the starts add up, less one if a run of letters goes across the
seam.  Running counts of a document's chunks tell its number of units and which chunk
holds a cut; only that chunk's bytes are looked at again.

The work is narrow: no shuffle, each document on its own.  ``KEEP_BYTES``
bounds the kept chunks of a worker; beyond it they are dropped and worked out
again when met, which changes no result.

Cases: a null text counts as empty; an empty text, and one that contains a marker, stays plain; very
long texts are chunked like others; repeated rows give repeated rows; a null
doc_id hashes as an empty one and is carried as null; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .textbytes import U, chunks, mix, powers

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

WINDOW, MEAN, LEAST, MOST = 24, 256, 48, 2048
KEEP_BYTES = 48 << 20
_ROLL = 0xD1342543DE82EF95
_ROLL_BACK = pow(_ROLL, -1, 1 << 64)
_WEIGHTS = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def cut_chunks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chunk starts (bytes): every non-empty row's start, and the content-defined
    places inside rows, moved on to the next code point."""
    n = len(data)
    rows = offsets[:-1][np.diff(offsets) > 0]
    if n <= WINDOW:
        return rows
    sums = np.zeros(n + 1, U)
    np.cumsum(_WEIGHTS[data] * powers(_ROLL, n), out=sums[1:])
    rolled = mix((sums[WINDOW:] - sums[:-WINDOW]) * powers(_ROLL_BACK, n - WINDOW + 1))
    at = np.flatnonzero(rolled & U(MEAN - 1) == 0) + WINDOW  # a chunk may start behind each full window
    at = at[at < n]
    row_start = rows[np.searchsorted(rows, at, "right") - 1]
    at = at[at - row_start >= WINDOW]  # the window lies within one row
    starts = np.union1d(rows, at)
    own = np.isin(starts, rows)
    starts = starts[own | (np.diff(starts, prepend=-LEAST) >= LEAST)]
    gaps = np.diff(starts, append=n)
    more = (gaps - 1) // MOST  # long stretches without a cut are dealt evenly
    if more.any():
        step = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
        starts = np.sort(np.concatenate([starts, np.repeat(starts, more) + step * MOST]))
    for _ in range(3):
        inner = (data[starts] & 0xC0) == 0x80
        if not inner.any():
            break
        starts = starts + inner
        starts = starts[starts < n]
    return np.unique(starts)


def _unit_starts(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit starts, code point starts) as masks; a run of letters starts anew at ``first``."""
    letter, lead = _LETTER[data], (data & 0xC0) != 0x80
    begin = lead.copy()
    begin[1:] &= ~(letter[1:] & letter[:-1])
    begin[first] = lead[first]
    return begin, lead


def summaries(pieces: list[bytes]) -> np.ndarray:
    """(unit starts, code points, first is a letter, last is a letter) of each piece."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.cumsum(size) - size
    begin, lead = _unit_starts(data, first)
    return np.stack([np.add.reduceat(begin, first, dtype=np.int64), np.add.reduceat(lead, first, dtype=np.int64), _LETTER[data[first]], _LETTER[data[first + size - 1]]], axis=1)


class Chunks:
    """The worker's chunks, by content."""

    def __init__(self, keep_bytes: int = KEEP_BYTES):
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((1024, 4), np.int64)
        self.held, self.keep_bytes = 0, keep_bytes

    def __call__(self, pieces: list[bytes]) -> np.ndarray:
        """Summaries of pieces, those of new ones worked out together."""
        if self.held > self.keep_bytes:
            self.known, self.held = {}, 0
        known, fresh = self.known, []
        at = np.empty(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            k = known.get(piece)
            if k is None:
                k = known[piece] = len(known)
                fresh.append(piece)
            at[i] = k
        if fresh:
            if len(known) > len(self.table):
                self.table = np.resize(self.table, (2 * len(known), 4))
            self.table[len(known) - len(fresh) : len(known)] = summaries(fresh)
            self.held += sum(map(len, fresh)) + 200 * len(fresh)
        return self.table[at]


_chunks = Chunks()


class Rows:
    """Units of a run of rows, told from their chunks' summaries."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, memo: Chunks):
        self.offsets = offsets
        self.starts = cut_chunks(data, offsets)
        stops = np.append(self.starts[1:], len(data))
        body = data.tobytes()
        self.pieces = [body[a:b] for a, b in zip(self.starts.tolist(), stops.tolist(), strict=True)]
        told = memo(self.pieces) if self.pieces else np.zeros((0, 4), np.int64)
        row_of = np.searchsorted(offsets, self.starts, "right") - 1
        self.first = np.searchsorted(row_of, np.arange(len(offsets)))
        self.across = np.zeros(len(told), bool)  # a run of letters goes on from the chunk before
        self.across[1:] = (told[:-1, 3] & told[1:, 2]).astype(bool) & (row_of[1:] == row_of[:-1])
        self.units = np.concatenate([[0], np.cumsum(told[:, 0] - self.across)])
        self.chars = np.concatenate([[0], np.cumsum(told[:, 1])])
        self.n = self.units[self.first[1:]] - self.units[self.first[:-1]]

    def locate(self, row: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code point) within the row where its first k units end."""
        byte = self.offsets[row + 1] - self.offsets[row]
        char = self.chars[self.first[row + 1]] - self.chars[self.first[row]]
        inner = np.flatnonzero(k < self.n[row])
        if len(inner):
            goal = self.units[self.first[row[inner]]] + k[inner]  # starts before the cut, in this run of rows
            c = np.searchsorted(self.units, goal, "right") - 1
            pieces = [self.pieces[i] for i in c.tolist()]
            size = np.fromiter(map(len, pieces), np.int64, len(pieces))
            base = np.cumsum(size) - size
            begin, lead = _unit_starts(np.frombuffer(b"".join(pieces), np.uint8), base)
            at = np.flatnonzero(begin)
            hit = at[np.searchsorted(at, base) + goal - self.units[c] + self.across[c]]
            points = np.concatenate([[0], np.cumsum(lead)])
            byte[inner] = self.starts[c] + hit - base - self.offsets[row[inner]]
            char[inner] = self.chars[c] + points[hit] - points[base] - self.chars[self.first[row[inner]]]
        return byte, char


def rearrange(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    The draws come from the SHA-256 of ``1:`` and the doc_id: two cuts between
    units, the form, the order.
    """
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]

    def step(batch):
        texts, ids = batch.column("text"), batch.column("doc_id")
        h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in range(1, 5))
        for run in chunks(texts):
            span = slice(run.lo, run.hi)
            rows = Rows(run.data, run.offsets, _chunks)
            every = np.arange(run.rows)
            cut = np.sort(np.stack([h1[span] % (rows.n + 1), h2[span] % (rows.n + 1)]), axis=0)
            (a, a_char), (b, b_char) = rows.locate(every, cut[0]), rows.locate(every, cut[1])
            body = run.data.tobytes()
            form, out = [], []
            for r, (lo, hi) in enumerate(zip(run.offsets[:-1].tolist(), run.offsets[1:].tolist(), strict=True)):
                text = body[lo:hi]
                if not text or h3[run.lo + r] % 100 >= PLAIN_FROM or PREFIX in text or SUFFIX in text or MIDDLE in text:
                    form.append("plain")
                    out.append(text)
                    continue
                prefix, middle, suffix = text[: a[r]], text[a[r] : b[r]], text[b[r] :]
                spm = h4[run.lo + r] % 100 < SPM_BELOW
                form.append("spm" if spm else "psm")
                out.append(b"".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle] if spm else [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]))
            plain = np.array(form) == "plain"
            yield pa.RecordBatch.from_arrays(
                [ids.slice(run.lo, run.rows), pa.array(rows.n), pa.array(form), pa.array(a_char, mask=plain), pa.array(b_char - a_char, mask=plain), pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws), step, SCHEMA)


def restored(form, output):
    """The text that a form and an output stand for (Columns): no part contains a
    marker, so the markers part an output into its three parts."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    out = rearrange(docs)
    text = restored(F.col("form"), F.col("output"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS toks,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(toks) AS BIGINT) AS n, least(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS a, greatest(h1 % (len(toks) + 1), h2 % (len(toks) + 1)) AS b FROM u),
p AS (SELECT doc_id, t, n, array_to_string(toks[1:a], '') AS pre, array_to_string(toks[a + 1:b], '') AS mid, array_to_string(toks[b + 1:n], '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                   ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
