"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent in numpy.

Every byte 2-, 3- and 4-gram of a text (ASCII case folded, everything between words
one blank) falls into one of ``BUCKETS`` hashed buckets; a text is the mean
of its buckets' embeddings, a linear layer and a softmax give the languages.
The model is fitted on a bounded sample of at most ``per_lang`` different documents per
language (the lowest hashes of doc_id among the rows to learn from, so it does not
depend on partitioning), and fewer per language, at least one, where that would be more than
``max_sample`` in all; no language is left out.  A fifth of them are held back to fit
the softmax temperature and the rejection limit.  The fitted layers multiply
out to one vector of language scores per bucket, so prediction over all
texts is a table lookup and a sum.

Cases: a null text, an empty one and one without a letter give ``und`` with
score 0; without any row to learn from every text gives ``und``; a null
doc_id is never learnt from; repeated rows are learnt once and predicted one by one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import lowest, map_batches

BITS = 13
BUCKETS = 1 << BITS
DIM = 16
UND = "und"

#: Letters without case; all that is not a letter is a blank.
FOLD = np.where(tb.PUNCT, np.uint8(0x20), tb.LOWER).astype(np.uint32)
FOLD[[*range(48, 58)]] = 0x20


def buckets(chunk: tb.Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 2-, 3- and 4-grams: (bucket of each gram, row offsets)."""
    b = FOLD[chunk.data]
    sizes = np.diff(chunk.offsets)
    code, out = b * np.uint32(0x9E3779B1), []
    inside = np.ones(len(b), bool)
    for j in (1, 2, 3):
        n = len(b) - j
        ends = chunk.offsets[1:] - j
        inside[ends[ends >= 0]] = False
        first = np.concatenate([[0], np.cumsum(np.maximum(sizes - j, 0))])
        if n <= 0:
            out.append((np.zeros(0, np.uint32), np.zeros(chunk.rows + 1, np.int64)))
            continue
        code = (code[:n] ^ (code[:n] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + b[j:]
        mixed = (code ^ (code >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        out.append(((mixed >> np.uint32(32 - BITS))[inside[:n]], first))
    return out


def bags(rows: DataFrame) -> DataFrame:
    """(key, lang, buckets, counts) of each text: at most BUCKETS entries."""

    def step(batch):
        text = batch.column("text")
        for chunk in tb.chunks(text):
            parts = buckets(chunk)
            ids, counts = [], []
            for r in range(chunk.rows):
                total = np.bincount(np.concatenate([g[f[r] : f[r + 1]] for g, f in parts]), minlength=BUCKETS)
                at = np.flatnonzero(total)
                ids.append(at.astype(np.int32))
                counts.append(total[at].astype(np.int32))
            take = lambda c: batch.column(c).slice(chunk.lo, chunk.rows)
            yield pa.RecordBatch.from_arrays([take("k"), take("lang"), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["k", "lang", "ids", "counts"])

    return map_batches(rows, step, "k long, lang string, ids array<int>, counts array<int>")


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(samples: list, epochs: int = 8, batch: int = 16, rate: float = 6.0, seed: int = 9) -> dict | None:
    """Embeddings and softmax by SGD; temperature and rejection limit from the
    held-back fifth."""
    samples = [s for s in samples if len(s["ids"])]
    langs = sorted({s["lang"] for s in samples})
    if not langs:
        return None
    y = np.array([langs.index(s["lang"]) for s in samples])
    held = np.array([s["k"] % 5 == 0 for s in samples]) & (len(samples) >= 20)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))

    def dense(which):
        x = np.zeros((len(which), BUCKETS))
        for i, s in enumerate(which):
            c = np.asarray(samples[s]["counts"], float)
            x[i, np.asarray(samples[s]["ids"])] = c / c.sum()
        return x

    train = np.flatnonzero(~held)
    weight = len(train) / (len(langs) * np.maximum(np.bincount(y[train], minlength=len(langs)), 1))
    steps, done = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for lo in range(0, len(order), batch):
            at = order[lo : lo + batch]
            x = dense(at)
            seen = np.flatnonzero(x.any(axis=0))
            x = x[:, seen]
            h = x @ emb[seen]
            p = softmax(h @ out + bias)
            p[np.arange(len(at)), y[at]] -= 1
            p *= weight[y[at]][:, None] / len(at)
            step = rate * (1 - done / steps)
            done += 1
            dh = p @ out.T
            out -= step * h.T @ p
            bias -= 0.05 * step * p.sum(axis=0)
            emb[seen] -= step * (x.T @ dh) * 20  # mean features are small
    table = (emb @ out).astype(np.float32)
    logits = np.vstack([dense([s]) @ table for s in np.flatnonzero(held)]) + bias if held.any() else np.zeros((0, len(langs)))
    best, limit = 1.0, 0.5
    if len(logits):
        truth = y[held]
        losses = {t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.25, 16, 25)}
        best = min(losses, key=losses.get)
        top = softmax(logits / best).max(axis=1)
        right = logits.argmax(axis=1) == truth
        # smallest confidence from which 99 in 100 held-back predictions are right
        by = np.argsort(-top)
        good = np.cumsum(right[by]) >= 0.99 * np.arange(1, len(by) + 1)
        limit = float(top[by][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return {"langs": langs, "table": table, "bias": bias, "temperature": best, "limit": limit}


def train(docs: DataFrame, per_lang: int = 600, max_sample: int = 150_000) -> dict | None:
    """Model from rows (doc_id, text, lang); ``max_sample`` (or one per language) bounds the sample."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    k = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40))
    named = known.select("lang", k.alias("k"), F.xxhash64("text").alias("h"))
    per_lang = max(1, min(per_lang, max_sample // max(1, named.select("lang").distinct().count())))
    picked = lowest(named.distinct(), "lang", "h", ["k", "h"], per_lang)  # at most max_sample small rows
    rows = known.select("lang", "text", k.alias("k"), F.xxhash64("text").alias("h")).join(F.broadcast(picked), ["lang", "k", "h"], "left_semi")
    rows = rows.dropDuplicates(["lang", "k", "h"])  # a repeated row is one document
    return fit(sorted(bags(rows).collect(), key=lambda r: (r["k"], r["lang"], r["ids"], r["counts"])))


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score (calibrated), accepted, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, accepted boolean"

    def step(batch):
        m = sent.value
        text = batch.column("text")
        n_langs = len(m["langs"]) if m else 1
        for chunk in tb.chunks(text, 4 * tb.CHUNK_BYTES // max(4, n_langs)):
            letters = tb.row_sums((FOLD[chunk.data] != 0x20).astype(np.int64), chunk.offsets) > 0
            ascii_letters = tb.row_sums(((FOLD[chunk.data] >= 97) & (FOLD[chunk.data] <= 122)).astype(np.int64), chunk.offsets) > 0
            for r in np.flatnonzero(letters & ~ascii_letters):  # other scripts, or only symbols
                letters[r] = any(c.isalpha() for c in bytes(chunk.data[chunk.offsets[r] : chunk.offsets[r + 1]]).decode("utf-8", "ignore"))
            pred, score, sure = [UND] * chunk.rows, np.zeros(chunk.rows), np.zeros(chunk.rows, bool)
            if m:
                total, count = np.zeros((chunk.rows, n_langs)), np.zeros(chunk.rows)
                for grams, first in buckets(chunk):
                    for j in range(n_langs):
                        total[:, j] += tb.row_sums(m["table"][:, j][grams], first)
                    count += np.diff(first)
                p = softmax((total / np.maximum(count, 1)[:, None] + m["bias"]) / m["temperature"])
                best = p.argmax(axis=1)
                score = np.where(letters, p[np.arange(chunk.rows), best], 0.0)
                pred = [m["langs"][b] if ok else UND for b, ok in zip(best, letters, strict=True)]
                sure = letters & (score >= m["limit"])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.lo, chunk.rows).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score), pa.array(sure)], ["doc_id", "lang_pred", "score", "accepted"])

    return map_batches(docs.select("doc_id", "text"), step, schema)


def op9_language_id(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = train(docs.where(~held))
    return predict(docs, model).withColumn("held_out", F.coalesce(held, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score", "accepted")
