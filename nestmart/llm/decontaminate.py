"""Benchmark decontamination by latent semantic retrieval.

Terms are the benchmark's words (case folded, punctuation off) that occur in at
most ``common`` of all passages, beyond the passages that copies of their item
account for (the lower quartile of its words' passages); every item keeps at
least its ``LEAST`` rarest different words.  Passages are tiles of ``TILE`` words of every document.
Three passes over the documents, none of them sampled:

1. passage frequencies of the terms, for the TF-IDF weights;
2. randomised SVD: each task sums ``A' (A omega)`` over its passages (A: unit
   TF-IDF rows), Spark adds the sums up, and the leading right singular vectors
   come from the Nystrom form ``Y (omega' Y)^-1 Y'``.  The benchmark's own
   rows enter with the weight of the whole corpus, so that its terms span the
   latent space;
3. search: overlapping windows with a term are folded into the latent space; those whose cosine with an item reaches ``min_cosine`` and that have
   enough of its words in any order are verified: the longest common
   subsequence covers at least ``exact`` of the item's words, or ``paraphrase`` of them
   while at least half of its answer words (the rarest terms of its last
   sentence) are there.

The benchmark is a query set: it is searched in blocks of ``block`` items, each
with its own terms and vectors, so what is sent to the executors is bounded.

Cases: null and empty texts and items match nothing; an item whose words are
all common is searched by its rarest words; equal items are all reported; repeated rows
give one result; a null doc_id is passed over; an empty table on either
side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import map_batches, map_partitions
from .memo import spread

TILE, LEAST = 48, 8


def _words(chunk: tb.Chunk) -> tb.Words:
    return tb.words(chunk, tb.PUNCT, fold=True)


def _hits(w: tb.Words, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word position, term number) of the terms in a chunk."""
    at = np.searchsorted(terms, w.hashes)
    at[at == len(terms)] = 0
    hit = np.flatnonzero(terms[at] == w.hashes)
    return hit, at[hit]


def _tiles(w: tb.Words) -> tuple[np.ndarray, int]:
    """Tile number of every word (tiles do not cross rows), and their count."""
    per = -(-np.diff(w.first) // TILE)
    before = np.concatenate([[0], np.cumsum(per)])
    return before[w.row] + (np.arange(len(w.hashes)) - w.first[w.row]) // TILE, int(before[-1])


def _item_words(text: str | None) -> np.ndarray:
    got = [_words(c).hashes for c in tb.chunks(pa.array([text or ""]))]
    return got[0] if got else np.zeros(0, np.uint64)


def _passage_counts(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and passages in all."""

    def run(batches):
        df, n = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for chunk in tb.chunks(batch.column("text")):
                w = _words(chunk)
                tile, count = _tiles(w)
                at, t = _hits(w, terms)
                df += np.bincount(np.unique(tile[at] * len(terms) + t) % len(terms), minlength=len(terms))
                n += count
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(terms))), pa.array(np.concatenate([[n], df]))], ["t", "n"])

    out = np.zeros(len(terms) + 1, np.int64)
    for r in map_partitions(docs.select("text"), run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        out[r["t"] + 1] = r["n"]
    return out[1:], int(out[0])


def _rows(tile: np.ndarray, t: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows from (tile, term) occurrences: term, weight, row starts,
    row of each entry."""
    cell, tf = np.unique(tile * len(idf) + t, return_counts=True)
    row, term = cell // len(idf), cell % len(idf)
    weight = (1 + np.log(tf)) * idf[term]
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(row))))
    norm = np.sqrt(np.add.reduceat(weight * weight, start)) if len(start) else np.zeros(0)
    return term, (weight / norm[of]).astype(np.float32), start, of


def _row_sums(term: np.ndarray, weight: np.ndarray, start: np.ndarray, matrix: np.ndarray, at_once: int = 1 << 12) -> np.ndarray:
    """Sparse rows times a matrix, about ``at_once`` entries at a time, which stay in the cache."""
    out = np.empty((len(start), matrix.shape[1]), np.result_type(weight, matrix))
    ends = np.append(start[1:], len(term))
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(ends, start[lo] + at_once, "right")))
        a, b = start[lo], ends[hi - 1]
        np.add.reduceat(weight[a:b, None] * matrix[term[a:b]], start[lo:hi] - a, axis=0, out=out[lo:hi])
        lo = hi
    return out


def _gram_times(term: np.ndarray, weight: np.ndarray, start: np.ndarray, of: np.ndarray, omega: np.ndarray, out: np.ndarray) -> None:
    """out += A' (A omega) for sparse rows."""
    if not len(start):
        return
    hidden = _row_sums(term, weight, start, omega)
    by = np.argsort(term, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], term[by][1:] != term[by][:-1]]))
    out[term[by][first]] += _row_sums(of[by], weight[by], first, hidden)


def _sketch(docs: DataFrame, terms: np.ndarray, idf: np.ndarray, omega: np.ndarray) -> tuple[np.ndarray, float]:
    """A' (A omega) over all passages, and the number of rows in A."""
    sent = docs.sparkSession.sparkContext.broadcast((terms, idf, omega))

    def run(batches):
        terms, idf, omega = sent.value
        y, n = np.zeros(omega.shape, np.float64), 0
        for batch in batches:
            for chunk in tb.chunks(batch.column("text")):
                w = _words(chunk)
                tile, _ = _tiles(w)
                at, t = _hits(w, terms)
                rows = _rows(tile[at], t, idf)
                n += len(rows[2])
                _gram_times(*rows, omega, y)
        some = np.flatnonzero(y.any(axis=1))
        body = [x.astype(np.float32).tobytes() for x in y[some]] + [np.array([n], np.float32).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(body, pa.binary())], ["t", "v"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for t, v in zip(batch.column("t").to_pylist(), batch.column("v").to_pylist(), strict=True):
                v = np.frombuffer(v, np.float32).astype(np.float64)
                sums[t] = sums[t] + v if t in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["t", "v"])

    schema = "t int, v binary"
    parts = map_partitions(docs.select("text"), run, schema).repartition("t")  # one row per term and task
    y, n = np.zeros(omega.shape), 0.0
    for r in map_partitions(parts, add, schema).collect():  # one row per term
        v = np.frombuffer(r["v"], np.float64)
        if r["t"] < 0:
            n = float(v[0])
        else:
            y[r["t"]] = v
    return y, n


def nystrom(y: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of the matrix that gave y = M omega."""
    shift = 1e-6 * np.linalg.norm(y) + 1e-12
    y = y + shift * omega
    b = omega.T @ y
    vals, vecs = np.linalg.eigh((b + b.T) / 2)
    keep = vals > 1e-9 * max(vals.max(), 1e-30)
    f = y @ (vecs[:, keep] / np.sqrt(vals[keep]))
    return np.linalg.svd(f, full_matrices=False)[0][:, :rank]


def lcs(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel over x)."""
    places: dict[int, int] = {}
    for i, v in enumerate(x.tolist()):
        places[v] = places.get(v, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for v in y.tolist():
        u = row & places.get(v, 0)
        row = ((row + u) | (row - u)) & full
    return len(x) - row.bit_count()


def _vocabulary(items: list[np.ndarray]) -> dict[str, np.ndarray]:
    """All words of the items, and per item (in a row) its distinct words and how often it has them."""
    vocab, at = np.unique(np.concatenate(items), return_inverse=True)
    of = np.repeat(np.arange(len(items)), [len(x) for x in items])
    cell, times = np.unique(of * len(vocab) + at, return_counts=True)
    return {"vocab": vocab, "cell": cell, "times": times, "size": np.array([len(x) for x in items])}


def most_shared(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, item: np.ndarray, v: dict[str, np.ndarray], at_once: int = 1 << 20) -> np.ndarray:
    """For spans a[k] .. b[k] of a chunk's words and an item each: how many words both have,
    copies counted; no common subsequence is longer."""
    out = np.zeros(len(a), np.int64)
    t = np.minimum(np.searchsorted(v["vocab"], hashes), len(v["vocab"]) - 1)
    t[v["vocab"][t] != hashes] = -1  # a word of no item
    ends = np.cumsum(b - a)
    lo = 0
    while lo < len(a):  # spans of about ``at_once`` words together
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + at_once, "right")))
        lengths = b[lo:hi] - a[lo:hi]
        span = np.repeat(np.arange(hi - lo), lengths)
        word = t[spread(a[lo:hi], lengths)]
        some = np.flatnonzero(word >= 0)
        span = span[some]
        cell = item[lo:hi][span] * len(v["vocab"]) + word[some]
        c = np.minimum(np.searchsorted(v["cell"], cell), len(v["cell"]) - 1)
        has = v["cell"][c] == cell
        key, n = np.unique(span[has] * len(v["cell"]) + c[has], return_counts=True)
        out[lo:hi] = np.bincount(key // len(v["cell"]), np.minimum(n, v["times"][key % len(v["cell"])]), minlength=hi - lo)
        lo = hi
    return out


def _answers(text: str | None, idf_of: dict[int, float], n: int = 3) -> list[int]:
    """The rarest terms of the last sentence with one."""
    for part in reversed([p for p in re.split(r"[.!?\n]+", text or "") if p.strip()]):
        ws = sorted(set(_item_words(part).tolist()), key=lambda h: (-idf_of.get(h, 0.0), h))
        if ws:
            return ws[:n]
    return []


def _search(docs: DataFrame, model: dict, min_cosine: float, exact: float, paraphrase: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, item_id long, start long, stop long, cosine double, lcs double, answer double"
    half = TILE // 2

    def step(batch):
        m = sent.value
        for chunk in tb.chunks(batch.column("text")):
            w = _words(chunk)
            at, t = _hits(w, m["terms"])
            if not len(at):
                continue
            # windows of TILE words, half overlapping: every word lies in two
            base = w.first[:-1] // half + np.arange(chunk.rows) * 2
            local = (at - w.first[w.row[at]]) // half
            window = np.concatenate([base[w.row[at]] + local, base[w.row[at]] + local + 1])
            where, term = np.concatenate([at, at]), np.concatenate([t, t])
            order = np.argsort(window, kind="stable")
            window, where, term = window[order], where[order], term[order]
            entry, weight, start, of = _rows(window, term, m["idf"])
            z = _row_sums(entry, weight, start, m["vectors"])
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            head = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
            row = w.row[where[head]]
            begin = w.first[row] + (window[head] - base[row] - 1) * half
            best: dict[tuple[int, int], tuple] = {}
            for lo in range(0, len(z), 8192):
                cos = z[lo : lo + 8192] @ m["items"].T
                near, item = np.nonzero(cos >= min_cosine)
                size, r_of = m["vocabulary"]["size"][item], row[lo + near]
                left = np.maximum(w.first[r_of], begin[lo + near] - size)
                right = np.minimum(w.first[r_of + 1], begin[lo + near] + TILE + size)
                # few share enough words, in any order, to be aligned
                may = np.zeros(0, bool) if not len(near) else most_shared(w.hashes, left, right, item, m["vocabulary"]) / size >= paraphrase
                for k, i, a, b in zip(near[may], item[may], left[may], right[may], strict=True):
                    r, words = int(row[lo + k]), m["words"][i]
                    span = w.hashes[a:b]
                    share = lcs(words, span) / len(words)
                    if share < paraphrase:
                        continue
                    want = m["answers"][i]
                    answer = float(np.isin(np.array(want, np.uint64), span).mean()) if want else 1.0
                    if share >= exact or answer >= 0.5:
                        old = best.get((r, i))
                        if old is None or share > old[3]:
                            best[r, i] = (int(a - w.first[r]), int(b - w.first[r]), float(cos[k, i]), share, answer)
            if best:
                ids = batch.column("doc_id")
                rows = [(ids[chunk.lo + r].as_py(), m["names"][i], *v) for (r, i), v in best.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return map_batches(docs, step, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = 128, common: float = 0.02, min_cosine: float = 0.35, exact: float = 0.8, paraphrase: float = 0.6, block: int = 512) -> DataFrame:
    """(doc_id, item_id, start, stop, cosine, lcs, answer): documents that hold a
    benchmark item, with the place and the evidence."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    items = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).sort("item_id", "text")
    out = None
    held: list = []

    def search(rows: list) -> DataFrame | None:
        rows = [(r["item_id"], r["text"], h) for r in rows if len(h := _item_words(r["text"]))]
        if not rows:
            return None
        terms = np.unique(np.concatenate([r[2] for r in rows]))
        df, n = _passage_counts(docs, terms)
        idf_all = np.log((1 + n) / (1 + df)) + 1
        idf_of = dict(zip(terms.tolist(), idf_all.tolist(), strict=True))
        rare = np.zeros(len(terms), bool)
        for r in rows:
            mine = np.unique(np.searchsorted(terms, r[2]))
            own = np.quantile(df[mine], 0.25, method="lower")  # its own copies do not make its words common
            rare[mine[df[mine] - own <= max(common * n, 20)]] = True
        for r in rows:  # an item of common words keeps its rarest
            mine = np.unique(np.searchsorted(terms, r[2]))
            if rare[mine].sum() < LEAST:
                rare[mine[np.argsort(df[mine], kind="stable")[:LEAST]]] = True
        terms, idf = terms[rare], idf_all[rare].astype(np.float32)
        r = min(rank, len(terms))
        omega = np.random.default_rng(4).standard_normal((len(terms), min(r + 10, len(terms)))).astype(np.float32)
        y, passages = _sketch(docs, terms, idf, omega)
        at = [np.flatnonzero(np.isin(x[2], terms)) for x in rows]
        flat = np.concatenate([np.searchsorted(terms, x[2][a]) for x, a in zip(rows, at, strict=True)])
        own = _rows(np.repeat(np.arange(len(rows)), [len(a) for a in at]), flat, idf)
        mine = np.zeros(omega.shape)
        _gram_times(*own, omega, mine)
        vectors = nystrom(y + mine * max(1.0, passages / len(rows)), omega.astype(np.float64), r).astype(np.float32)
        z = np.add.reduceat(own[1][:, None] * vectors[own[0]], own[2], axis=0)
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        model = {"terms": terms, "idf": idf, "vectors": vectors, "items": z.astype(np.float32), "names": [x[0] for x in rows], "words": [x[2] for x in rows], "vocabulary": _vocabulary([x[2] for x in rows]), "answers": [_answers(x[1], idf_of) for x in rows]}
        return _search(docs, model, min_cosine, exact, paraphrase)

    for row in items.toLocalIterator():  # the query set, block by block
        held.append(row)
        if len(held) == block:
            part, held = search(held), []
            out = part if out is None else out.unionAll(part) if part is not None else out
    part = search(held) if held else None
    if part is not None:
        out = part if out is None else out.unionAll(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start long, stop long, cosine double, lcs double, answer double")
    return out.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("start", "stop", "cosine", "lcs", "answer"), F.struct("lcs", "cosine", "start")).alias("m")).select("doc_id", "item_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: documents that hold no benchmark item."""
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("_found"), "left_anti")


def op4_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)
