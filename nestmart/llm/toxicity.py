"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

Examples are a bounded sample of the labelled rows: ``per_label`` documents of
either label with the lowest id hash, one text (the least) per doc_id and one example per
distinct text.  Their terms
(ASCII case folded, punctuation off) that go with the label beyond chance
(chi-square of at least ``min_chi2``, at most ``max_terms`` of them) are the
vocabulary; document frequencies are counted over all documents.

Search is exact.  Examples lie in blocks of ``BLOCK``; an inverted index keeps,
per term, the largest weight in each block, and per block the postings of its
terms.  A batch of documents takes the blocks in descending bound and scores a block only
for documents whose bound reaches their k-th best cosine so far.

Votes are weighted by closeness, 1 / (distance + ``soft``), and turned into
probabilities by an isotonic fit on the calibration fifth of the sample,
weighted back to the label shares of all rows learnt from.  Documents that hold no term of the
vocabulary get the toxic share of such examples.  The nearest examples' ids
are returned as evidence.

Cases: null and empty texts score as documents without terms; several labels
for one doc_id count as toxic if one is; null labels are not learnt from;
without labels every score is 0; repeated rows are scored one by one; a null
doc_id is carried and not held out; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import lowest, map_batches, map_partitions, stored

BLOCK = 128


def _terms(chunk: tb.Chunk) -> tb.Words:
    return tb.words(chunk, tb.PUNCT, fold=True)


def _counts(w: tb.Words, vocabulary: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the vocabulary terms in a chunk, by row."""
    at = np.searchsorted(vocabulary, w.hashes)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == w.hashes
    cell, n = np.unique(w.row[hit] * len(vocabulary) + at[hit], return_counts=True)
    return cell // len(vocabulary), cell % len(vocabulary), n


def vectors(w: tb.Words, vocabulary: np.ndarray, idf: np.ndarray, rows: int) -> np.ndarray:
    """Unit TF-IDF rows (zero rows for texts without terms)."""
    x = np.zeros((rows, len(vocabulary)), np.float32)
    r, t, n = _counts(w, vocabulary, rows)
    x[r, t] = (1 + np.log(n)) * idf[t]
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


class BlockMaxIndex:
    """Examples in blocks; per block its terms' postings and largest weights."""

    def __init__(self, x: np.ndarray):
        order = np.lexsort((x.max(axis=1), x.argmax(axis=1)))  # like rows together
        self.ids = order
        self.maxima = np.zeros(((len(x) + BLOCK - 1) // BLOCK, x.shape[1]), np.float32)
        self.postings = []
        for b in range(len(self.maxima)):
            block = x[order[b * BLOCK : (b + 1) * BLOCK]]
            self.maxima[b] = block.max(axis=0)
            terms = np.flatnonzero(self.maxima[b])
            self.postings.append((terms, np.ascontiguousarray(block[:, terms].T)))

    def search(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Cosines and example numbers of the k nearest of every query row,
        nearest first; -1 where there are fewer."""
        bounds = q @ self.maxima.T * np.float32(1 + 1e-5) + np.float32(1e-6)
        best = np.full((len(q), k), -1.0, np.float32)
        who = np.full((len(q), k), -1, np.int64)
        turn = np.argsort(-bounds, axis=1)
        for step in range(len(self.maxima)):
            block_of = turn[:, step]
            open_ = bounds[np.arange(len(q)), block_of] >= np.maximum(best[:, -1], 1e-6)
            if not open_.any():  # bounds only fall
                break
            for b in np.unique(block_of[open_]):
                rows = np.flatnonzero(open_ & (block_of == b))
                terms, weights = self.postings[b]
                cos = q[rows][:, terms] @ weights
                names = self.ids[b * BLOCK : (b + 1) * BLOCK]
                all_cos = np.hstack([best[rows], cos])
                all_who = np.hstack([who[rows], np.broadcast_to(names, cos.shape)])
                pick = np.lexsort((all_who, -all_cos), axis=1)[:, :k]
                best[rows] = np.take_along_axis(all_cos, pick, 1)
                who[rows] = np.take_along_axis(all_who, pick, 1)
        who[best <= 1e-6] = -1
        return best, who


def votes(cos: np.ndarray, who: np.ndarray, y: np.ndarray, soft: float) -> np.ndarray:
    weight = np.where(who >= 0, 1.0 / (1.0 - np.minimum(cos, 1.0) + soft), 0.0)
    return (weight * y[who]).sum(axis=1) / np.maximum(weight.sum(axis=1), 1e-12)


def isotonic(v: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted monotone fit of y on v: (knots, values) by pooling neighbours;
    one pseudo-row of the mean keeps the ends off 0 and 1."""
    mean = (w * y).sum() / w.sum()
    xs, where = np.unique(v, return_inverse=True)
    ws = np.bincount(where, w)
    ys = np.bincount(where, w * y) / ws
    pools: list[list[float]] = []
    for x, val, weight in zip(xs, ys, ws, strict=True):
        pools.append([x, x, val, weight])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            lo, hi = pools[-2], pools.pop()
            lo[2] = (lo[2] * lo[3] + hi[2] * hi[3]) / (lo[3] + hi[3])
            lo[1], lo[3] = hi[1], lo[3] + hi[3]
    knots = np.array([e for p in pools for e in (p[0], p[1])])
    one = w.mean()
    values = np.repeat([(p[2] * p[3] + mean * one) / (p[3] + one) for p in pools], 2)
    return knots, np.maximum.accumulate(values)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 4000, max_terms: int = 1024, min_chi2: float = 30.0, k: int = 24, soft: float = 0.05) -> dict | None:
    """Model from documents (doc_id, text) and labels (doc_id, toxic)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not total:
        return None
    ids = lowest(known.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"))), "y", "h", ["h", "doc_id"], per_label).drop("h")
    # at most 2 * per_label rows of ids, and of texts: rows that repeat a doc_id are reduced to one before they are gathered
    texts = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("y").alias("y"))
    sample = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y"))
    sample = stored(sample, "toxicity-sample")

    def term_rows(batch):
        for chunk in tb.chunks(batch.column("text")):
            w = _terms(chunk)
            y = batch.column("y").to_numpy(zero_copy_only=False)[chunk.lo : chunk.hi]
            pair = np.unique(np.stack([w.hashes, w.row.astype(np.uint64)]), axis=1) if len(w.hashes) else np.zeros((2, 0), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[0].view(np.int64)), pa.array(y[pair[1].astype(np.int64)].astype(np.int64))], ["term", "y"])

    sizes = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")).first()
    n, pos = sizes["n"], sizes["pos"]
    seen = map_batches(sample.select("text", "y"), term_rows, "term long, y long").groupBy("term").agg(F.count("*").alias("df"), F.sum("y").alias("hit"))
    a, df = F.col("hit").cast("double"), F.col("df").cast("double")
    chi2 = n * F.pow(a * (n - pos - (df - a)) - (df - a) * (pos - a), 2) / F.greatest(F.lit(1e-9), df * (n - df) * pos * (n - pos))
    terms = seen.where(F.col("df") >= 5).withColumn("chi2", chi2).where(F.col("chi2") >= min_chi2).orderBy(F.desc("chi2"), "term").limit(max_terms).collect()
    vocabulary = np.sort(np.array([r["term"] for r in terms], np.int64).view(np.uint64))
    if not len(vocabulary):
        vocabulary = np.array([0], np.uint64)
    idf = _idf(docs, vocabulary)

    def sparse(batch):
        for chunk in tb.chunks(batch.column("text")):
            x = vectors(_terms(chunk), vocabulary, idf, chunk.rows)
            hits = [np.flatnonzero(row) for row in x]
            take = lambda c: batch.column(c).slice(chunk.lo, chunk.rows)
            yield pa.RecordBatch.from_arrays([take("doc_id"), take("y"), pa.array([h.astype(np.int32) for h in hits], pa.list_(pa.int32())), pa.array([row[h] for row, h in zip(x, hits, strict=True)], pa.list_(pa.float32()))], ["doc_id", "y", "at", "w"])

    rows = sorted(map_batches(sample, sparse, "doc_id long, y int, at array<int>, w array<float>").collect(), key=lambda r: r["doc_id"])
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["w"]
    y = np.array([r["y"] for r in rows], float)
    names = np.array([r["doc_id"] for r in rows], np.int64)
    cal = (tb.mix(names.view(np.uint64)) % np.uint64(5) == 0) & (len(rows) >= 50)
    some = x.any(axis=1)
    weight = np.array([total.get(0, 0) / max((y == 0).sum(), 1), total.get(1, 0) / max((y == 1).sum(), 1)])[y.astype(int)]
    none = ~some
    prior = (weight * y).sum() / max(weight.sum(), 1e-12)
    bare = float(((weight * y)[none].sum() + prior) / (weight[none].sum() + 1))
    base = some & ~cal
    model = {"vocabulary": vocabulary, "idf": idf, "y": y[base], "names": names[base], "bare": bare, "k": k, "soft": soft, "index": None, "knots": np.array([0.0, 1.0]), "values": np.array([0.0, 1.0])}
    if base.any():
        model["index"] = BlockMaxIndex(x[base])
        test = some & cal
        if test.any():
            model["knots"], model["values"] = isotonic(votes(*model["index"].search(x[test], k), y[base], soft), y[test], weight[test])
    return model


def _idf(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency over all documents."""

    def run(batches):
        df, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for chunk in tb.chunks(batch.column("text")):
                _, t, _ = _counts(_terms(chunk), vocabulary, chunk.rows)
                df += np.bincount(t, minlength=len(vocabulary))
                n += chunk.rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(vocabulary))), pa.array(np.concatenate([[n], df]))], ["t", "n"])

    counts = np.zeros(len(vocabulary) + 1)
    for r in map_partitions(docs.select("text"), run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
        counts[r["t"] + 1] = r["n"]
    return (np.log((1 + counts[0]) / (1 + counts[1:])) + 1).astype(np.float32)


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score, evidence (ids of the nearest examples) and their cosines."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, score double, evidence array<long>, evidence_cosine array<float>"

    def step(batch):
        m = sent.value
        for chunk in tb.chunks(batch.column("text")):
            p = np.full(chunk.rows, m["bare"] if m else 0.0)
            ev, ec = [[] for _ in range(chunk.rows)], [[] for _ in range(chunk.rows)]
            if m and m["index"] is not None:
                x = vectors(_terms(chunk), m["vocabulary"], m["idf"], chunk.rows)
                some = np.flatnonzero(x.any(axis=1))
                if len(some):
                    cos, who = m["index"].search(x[some], m["k"])
                    near = who[:, 0] >= 0
                    p[some[near]] = np.interp(votes(cos, who, m["y"], m["soft"])[near], m["knots"], m["values"])
                    for r, c, w in zip(some, cos[:, :3], who[:, :3], strict=True):
                        ev[r], ec[r] = m["names"][w[w >= 0]], c[w >= 0]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.lo, chunk.rows), pa.array(np.clip(p, 0, 1)), pa.array(ev, pa.list_(pa.int64())), pa.array(ec, pa.list_(pa.float32()))], ["doc_id", "score", "evidence", "evidence_cosine"])

    return map_batches(docs.select("doc_id", "text"), step, schema)


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = train(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(~held))
    out = score(docs, model).withColumn("held_out", F.coalesce(held, F.lit(False)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "evidence_cosine")
