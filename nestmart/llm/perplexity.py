"""Quality rules: base text counts and a character n-gram perplexity band.

Two modified Kneser-Ney 4-gram models per ``lang`` value are counted by Spark over every
byte of every text after the three before it (before a text stand ``START`` bytes): one over
the bytes as they are, which grows with the corpus, and one over their 32 classes (letters
without case, space, line end, digit, classes of punctuation and of non-ASCII bytes), which
cannot learn junk by heart.  Probabilities of all orders come from grouping and
joining n-grams; every 4-gram of the corpus is kept with both of its log probabilities and
looked up by hash.  The executors get them in slices of at most ``BROADCAST_BYTES``.

A document is rejected when its log perplexity in either model lies outside its language's
band: median plus or minus ``spread`` robust standard deviations over the
different scores of documents that pass the base rules (exact copies count
once, so that a large group of them does not narrow the band).  ``slack`` over the root of
their number is the least width, for languages of a few documents.

Cases: a null or empty text counts nothing, has no perplexity (null) and fails the base rules (fewer
than ``min_words`` words); a null ``lang`` has a model of its own under the name
``und``; copies of a text are learnt as one; repeated rows and doc_ids are judged row by row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import map_batches, map_partitions, stored

ORDER, BITS, CLASS_BITS = 4, 8, 5
#: Stands for what is before a text; no byte of UTF-8.
START = 0xFF
#: A slice of the model holds so many bytes, with GRAM_BYTES for each of its 4-grams; what is over goes in further slices.
BROADCAST_BYTES, GRAM_BYTES = 256 << 20, 40
#: 4-grams a task keeps before it puts their sums out.
HELD = 1 << 21


def _alphabet() -> np.ndarray:
    """Class of each byte: 0 other control and what is before a text, 1-26 letters, 27 space, 28 line
    end, 29 digit, 30 sentence punctuation, 31 other ASCII; non-ASCII bytes
    share the letters by their low bits."""
    table = np.zeros(256, np.uint32)
    for b in range(33, 127):
        table[b] = 31
    for b in range(26):
        table[97 + b] = table[65 + b] = 1 + b
    for b in b" \t":
        table[b] = 27
    for b in b"\n\r\x0b\x0c":
        table[b] = 28
    for b in b"0123456789":
        table[b] = 29
    for b in b".,;:!?'\"-()":
        table[b] = 30
    for b in range(128, 256):
        table[b] = 1 + b % 26
    table[START] = 0
    return table


SYMBOL = _alphabet()


def gram_codes(chunk: tb.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each byte of a chunk, and the row offsets (grams do not cross rows)."""
    code = chunk.data.astype(np.uint32)
    for j in range(1, ORDER):
        code[j:] |= chunk.data[:-j].astype(np.uint32) << np.uint32(BITS * j)
    for j in range(ORDER - 1):
        at = chunk.offsets[:-1] + j
        before = sum(START << (BITS * k) for k in range(j + 1, ORDER))
        code[at[at < chunk.offsets[1:]]] |= np.uint32(before)
    return code, chunk.offsets


def _lang_ids(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    names = batch.column("lang").fill_null("und").dictionary_encode()
    return names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False)


def _copy_keys(batch: pa.RecordBatch):
    """Adds the least hash of a text's runs of eight words, which near copies share."""
    for chunk in tb.chunks(batch.column("text"), 1 << 20):
        at, h = tb.windows(w := tb.words(chunk), 8)
        h = tb.mix(h) >> np.uint64(1)
        key = np.full(chunk.rows, np.iinfo(np.int64).max)
        np.minimum.at(key, w.row[at], h.astype(np.int64))
        bare = key == np.iinfo(np.int64).max
        yield pa.RecordBatch.from_arrays([batch.column("lang").slice(chunk.lo, chunk.rows), batch.column("text").slice(chunk.lo, chunk.rows), pa.array(key, mask=bare)], ["lang", "text", "copy"])


def _sums(code: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sum of their weights (without weights: their number)."""
    if weight is None:
        code, n = np.unique(code, return_counts=True)
        return code, n.astype(float)
    by = np.argsort(code)
    code, weight = code[by], weight[by]
    first = np.flatnonzero(np.concatenate([[len(code) > 0], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(weight, first) if len(first) else weight


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, code, n) over all texts: sums per task, then one shuffle.
    Each of n (near) copies counts 1/n, so that the model does not learn a copied
    text by heart."""
    docs = map_batches(docs.select("lang", "text"), _copy_keys, "lang string, text string, copy long")
    copied = stored(docs.where("copy is not null").groupBy("lang", "copy").agg(F.count("*").alias("copies")).where("copies > 1"), "kn-copies")
    docs = docs.join(copied, ["lang", "copy"], "left").select("lang", "text", (1.0 / F.coalesce("copies", F.lit(1))).alias("share"))

    def run(batches):
        held: dict[str, list] = {}

        def merged(flush: bool):
            for lang, parts in held.items():
                held[lang] = [_sums(*map(np.concatenate, zip(*parts, strict=True)))]
            if flush or 2 * sum(len(parts[0][0]) for parts in held.values()) > HELD:
                for lang, [(code, n)] in held.items():
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n)], ["lang", "code", "n"])
                held.clear()

        for batch in batches:
            names, which = _lang_ids(batch)
            share = batch.column("share").to_numpy()
            for chunk in tb.chunks(batch.column("text"), 1 << 20):
                code, first = gram_codes(chunk)
                of = np.repeat(which[chunk.lo : chunk.hi], np.diff(first))
                part = np.repeat(share[chunk.lo : chunk.hi], np.diff(first))
                for i in np.unique(of):
                    mine = of == i
                    once = mine & (part == 1)
                    held.setdefault(names[i], []).append(_sums(code[once]))
                    if (rest := mine & ~once).any():
                        held[names[i]].append(_sums(code[rest], part[rest]))
                if sum(len(c) for parts in held.values() for c, _ in parts) > HELD:
                    yield from merged(False)
        yield from merged(True)

    parts = map_partitions(docs, run, "lang string, code long, n double")
    return parts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def with_classes(grams: DataFrame) -> DataFrame:
    """Adds ``classes``, the 4-gram of the classes of a code's bytes."""

    def step(batch):
        code = batch.column("code").to_numpy()
        classes = np.zeros(len(code), np.int64)
        for j in range(ORDER - 1, -1, -1):
            classes = (classes << CLASS_BITS) | SYMBOL[(code >> (BITS * j)) & 0xFF]
        yield batch.append_column("classes", pa.array(classes))

    return map_batches(grams, step, "lang string, code long, n double, classes long")


def gram_hash(order: int, code: np.ndarray) -> np.ndarray:
    return tb.mix(code.astype(np.uint64) + np.uint64(order << 40))


def discounts(counts: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts."""
    n1, n2, n3, n4 = (float(max((counts == k).sum(), 1e-9)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    plain = np.array([0.0, 0.5, 0.75, 0.9])  # for corpora too small for the estimate
    bad = ~np.isfinite(d) | (d <= 0) | (d >= np.arange(4))
    bad[0] = False
    return np.where(bad, plain, d)


def kneser_ney(code: np.ndarray, n: np.ndarray, bits: int = 5) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For orders 1..4: sorted gram hashes, probabilities (interpolated), sorted
    context hashes, back-off weights.  ``code`` are the distinct 4-grams of symbols of
    ``bits`` bits.  In one process; ``train`` does the same in Spark and is held to this by its test."""
    levels = {ORDER: (np.asarray(code, np.int64), np.asarray(n, np.int64))}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        above = levels[order + 1][0]
        levels[order] = np.unique(above & ((1 << (bits * order)) - 1), return_counts=True)
    model, lower = [], None
    for order in range(1, ORDER + 1):
        grams, counts = levels[order]
        d = discounts(counts)[np.minimum(counts, 3)]
        ctx, where = np.unique(grams >> bits, return_inverse=True)
        total = np.bincount(where, counts)
        gamma = np.bincount(where, d) / total
        below = 1.0 / (1 << bits) if lower is None else lower[1][np.searchsorted(lower[0], grams & ((1 << (bits * (order - 1))) - 1))]
        prob = (counts - d) / total[where] + gamma[where] * below
        by = np.argsort(grams)
        lower = grams[by], prob[by]
        key, ckey = gram_hash(order, grams), gram_hash(order + 8, ctx)
        a, b = np.argsort(key), np.argsort(ckey)
        model.append((key[a], prob[a].astype(np.float32), ckey[b], gamma[b].astype(np.float32)))
    return model


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def log_probs(model, code: np.ndarray, bits: int = 5) -> np.ndarray:
    """Natural log probability of the last symbol of each 4-gram: the highest
    order that holds the gram, times the back-off weights above it."""
    prob = np.full(len(code), 1.0 / (1 << bits))
    for order in range(1, ORDER + 1):
        keys, probs, ctx_keys, gammas = model[order - 1]
        gram = code.astype(np.int64) & ((1 << (bits * order)) - 1)
        at, seen = _find(keys, gram_hash(order, gram))
        ctx_at, ctx_seen = _find(ctx_keys, gram_hash(order + 8, gram >> bits))
        backed = np.where(ctx_seen, gammas[ctx_at], 1.0) * prob
        prob = np.where(seen, probs[at], backed)
    return np.log(prob)


def _discounted(grams: DataFrame) -> DataFrame:
    """Adds ``d``, the discount of each count (see ``discounts``), from its language's counts of counts."""
    of = grams.groupBy("lang").agg(*[F.greatest(F.count_if(F.col("n") == k).cast("double"), F.lit(1e-9)).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = [k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}") for k in (1, 2, 3)]
    plain = (0.5, 0.75, 0.9)  # for corpora too small for the estimate
    of = of.select("lang", *[F.when((d[k] > 0) & (d[k] < k + 1), d[k]).otherwise(plain[k]).alias(f"d{k + 1}") for k in range(3)])
    pick = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    return grams.join(F.broadcast(of), "lang").select("lang", "code", "n", pick.alias("d"))  # one row per language


def log_p(counts: DataFrame, bits: int) -> DataFrame:
    """``(lang, code, log_p)`` of the 4-grams ``(lang, code, n)`` of symbols of ``bits`` bits: the interpolated log
    probability of the last symbol.  A context and a suffix have at most 256 n-grams, so no key is hot."""
    levels = {ORDER: counts.select("lang", "code", F.greatest(F.lit(1), F.round("n").cast("long")).alias("n"))}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        suffix = F.col("code").bitwiseAND((1 << (bits * order)) - 1)
        levels[order] = levels[order + 1].groupBy("lang", suffix.alias("code")).agg(F.count("*").alias("n"))
    lower = None
    for order in range(1, ORDER + 1):
        context = Window.partitionBy("lang", F.shiftright("code", bits))
        total = F.sum("n").over(context)
        grams = _discounted(levels[order]).select("lang", "code", ((F.col("n") - F.col("d")) / total).alias("own"), (F.sum("d").over(context) / total).alias("gamma"))
        below = F.lit(1.0 / (1 << bits))
        if lower is not None:
            suffix = F.col("code").bitwiseAND((1 << (bits * (order - 1))) - 1)
            grams, below = grams.withColumn("suffix", suffix).join(lower, ["lang", "suffix"]), F.col("below")
        p = F.col("own") + F.col("gamma") * below
        lower = grams.select("lang", F.col("code").alias("suffix"), p.alias("below"))
    return lower.select("lang", F.col("suffix").alias("code"), F.log("below").alias("log_p"))


def train(docs: DataFrame) -> DataFrame:
    """``(lang, code, log_p, class_log_p)`` of every 4-gram of the corpus: log probabilities of its last byte
    and of that byte's class."""
    counts = stored(with_classes(count_grams(docs)), "kn-counts")
    classes = log_p(counts.groupBy("lang", F.col("classes").alias("code")).agg(F.sum("n").alias("n")), CLASS_BITS)
    classes = stored(classes.select("lang", F.col("code").alias("classes"), F.col("log_p").cast("float").alias("class_log_p")), "kn-classes")
    grams = log_p(counts, BITS).join(counts.select("lang", "code", "classes"), ["lang", "code"]).join(classes, ["lang", "classes"])
    return grams.select("lang", "code", F.col("log_p").cast("float").alias("log_p"), "class_log_p")


class Table:
    """Both log probabilities by 4-gram: open addressing, NaN where no 4-gram is."""

    def __init__(self, code: np.ndarray, logs: np.ndarray):
        self.shift = 32 - max(4, (2 * len(code)).bit_length())
        slot = self._slot(code)
        by = np.argsort(slot, kind="stable")
        n = np.arange(len(code))
        at = np.maximum.accumulate(slot[by] - n) + n  # each after the one before it
        size = max(1 << (32 - self.shift), int(at[-1]) + 1 if len(at) else 0) + 1
        self.code, self.logs = np.zeros(size, np.uint32), np.full((size, 2), np.nan, np.float32)
        self.code[at], self.logs[at] = code[by], logs[by]

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint32(0x9E3779B1)) >> np.uint32(self.shift)).astype(np.int64)

    def __call__(self, code: np.ndarray) -> np.ndarray:
        """Log probabilities of each 4-gram, 0 for those that are not in the table."""
        at = self._slot(code)
        left = np.flatnonzero(self.code[at] != code)
        while len(left):  # those that stand further on
            left = left[~np.isnan(self.logs[at[left], 0])]
            at[left] += 1
            left = left[self.code[at[left]] != code[left]]
        return np.where((self.code[at] == code)[:, None], np.nan_to_num(self.logs[at]), 0)


def _tables(model: DataFrame) -> dict[str, Table]:
    found = model.select("lang", "code", "log_p", "class_log_p").toArrow()
    lang = found.column("lang").combine_chunks().dictionary_encode()
    which = lang.indices.to_numpy(zero_copy_only=False)
    code = found.column("code").to_numpy().astype(np.uint32)
    logs = np.column_stack([found.column(c).to_numpy() for c in ("log_p", "class_log_p")])
    return {name: Table(code[which == i], logs[which == i]) for i, name in enumerate(lang.dictionary.to_pylist())}


def base_counts(chunk: tb.Chunk) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by row."""
    w = tb.words(chunk)
    data = chunk.data
    inside = ~tb.SPACE[data]
    out = {"n_words": np.diff(w.first)}
    out["word_chars"] = tb.row_sums((inside & ((data & 0xC0) != 0x80)).astype(np.int64), chunk.offsets)
    symbol = np.zeros(256, np.int64)
    symbol[list(b"[#*$%&|<>]")[1:-1]] = 1
    out["n_symbols"] = tb.row_sums(symbol[data], chunk.offsets)
    # lines: runs between line feeds, hashed whole
    feed = np.zeros(256, bool)
    feed[0x0A] = True
    lines = tb.words(chunk, feed)
    has_word = np.zeros(len(lines.starts), bool)
    if len(lines.starts):
        has_word = np.add.reduceat(inside.astype(np.int64), lines.starts) > 0
    key = tb.mix(lines.hashes + lines.row.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))[has_word]
    _, firsts = np.unique(key, return_index=True)
    rows = lines.row[has_word]
    out["n_dup_lines"] = np.bincount(rows, minlength=chunk.rows) - np.bincount(rows[firsts], minlength=chunk.rows)
    # words in 3-word windows that come twice or more in the row
    at, h = tb.windows(w, 3)
    covered = np.zeros(len(w.hashes) + 1, np.int64)
    if len(at):
        key = tb.mix(h + w.row[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            covered[at[twice] + j] = 1
    out["n_repeat_words"] = tb.row_sums(covered[:-1], w.first)
    return out


PPL = ("log_ppl", "class_log_ppl")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = "doc_id long, lang string, text_hash long, " + ", ".join(f"{c} long" for c in COUNTS) + "".join(f", {c} double" for c in PPL)


def _score(docs: DataFrame, tables: dict[str, Table], counts: bool = True) -> DataFrame:
    """Base counts (or not: the hash and the perplexities only) and the log perplexities of every document,
    as far as the 4-grams of ``tables`` go."""
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    schema = SCORED if counts else "lang string, text_hash long" + "".join(f", {c} double" for c in PPL)

    def step(batch):
        names, which = _lang_ids(batch)
        for chunk in tb.chunks(batch.column("text"), 1 << 20):
            code, first = gram_codes(chunk)
            n = np.diff(first)
            of = np.repeat(which[chunk.lo : chunk.hi], n)
            logs = np.zeros((len(code), 2))
            for i in np.unique(of):
                if names[i] in sent.value:
                    mine = of == i
                    logs[mine] = sent.value[names[i]](code[mine])
            cols = [pa.array([names[i] for i in which[chunk.lo : chunk.hi]], pa.string()), batch.column("text_hash").slice(chunk.lo, chunk.rows)]
            if counts:
                out = base_counts(chunk)
                cols = [batch.column("doc_id").slice(chunk.lo, chunk.rows).cast(pa.int64()), *cols, *(pa.array(out[c], pa.int64()) for c in COUNTS)]
            cols += [pa.array(-tb.row_sums(logs[:, k], first) / np.maximum(n, 1), pa.float64(), mask=n == 0) for k in range(2)]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

    return map_batches(docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash")), step, schema)


def score(docs: DataFrame) -> DataFrame:
    """``SCORED`` rows of all documents.  Models over ``BROADCAST_BYTES`` are sent in slices
    by a hash of the 4-gram; what each adds to a text's perplexities is summed by language and text hash."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    model = stored(train(docs), "kn-model")
    slices = max(1, math.ceil(model.count() * GRAM_BYTES / BROADCAST_BYTES))
    if slices == 1:
        return _score(docs, _tables(model))
    parts = None
    for i in range(slices):
        some = _tables(model.where(F.pmod(F.xxhash64("lang", "code"), F.lit(slices)) == i))
        part = stored(_score(docs, some, counts=False).where("log_ppl is not null").dropDuplicates(["lang", "text_hash"]), "kn-part")
        parts = part if parts is None else parts.unionAll(part)
    sums = parts.groupBy("lang", "text_hash").agg(*[F.sum(c).alias(c) for c in PPL])
    return _score(docs, {}).drop(*PPL).join(sums, ["lang", "text_hash"], "left").select(*[x.split()[0] for x in SCORED.split(", ")])


def _band(scored: DataFrame, ppl: str, spread: float, slack: float) -> DataFrame:
    """``(lang, low, high)`` of a model's log perplexities; one row per language."""
    sound = scored.where(~F.col("base_failed") & F.col(ppl).isNotNull()).select("lang", F.col(ppl).alias("ppl")).distinct()
    middle = sound.groupBy("lang").agg(F.percentile_approx("ppl", 0.5, 10000).alias("mid"))
    off = sound.join(F.broadcast(middle), "lang").groupBy("lang", "mid").agg(F.percentile_approx(F.abs(F.col("ppl") - F.col("mid")), 0.5, 10000).alias("mad"), F.count("*").alias("n"))
    reach = F.greatest(F.lit(spread * 1.4826) * F.col("mad"), F.lit(slack) / F.sqrt("n"))
    return off.select("lang", (F.col("mid") - reach).alias("low"), (F.col("mid") + reach).alias("high"))


def judge(docs: DataFrame, min_words: int = 50, repeat_percent: int = 50, spread: float = 3.5, slack: float = 0.35) -> DataFrame:
    """Base counts, ``base_failed``, the log perplexities, their bands and ``kept`` for every document."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    out = scored = stored(score(docs), "kn-scores").withColumn("base_failed", failed)
    inside = F.lit(True)
    for ppl, low, high in (("log_ppl", "band_low", "band_high"), ("class_log_ppl", "class_band_low", "class_band_high")):
        out = out.join(F.broadcast(_band(scored, ppl, spread, slack).withColumnsRenamed({"low": low, "high": high})), "lang", "left")
        inside = inside & F.col(ppl).between(F.col(low), F.col(high))
    return out.withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False)))


def keep_good(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows whose own verdict is ``kept``.  A verdict follows from
    a row's language and text, so a row is found again by its doc_id, language and
    text hash: rows that share a doc_id, or have none, are judged one by one."""
    good = judge(docs).where("kept").select(F.col("doc_id").alias("good_id"), F.col("lang").alias("good_lang"), F.col("text_hash").alias("good_hash")).distinct()
    key = F.col("doc_id").cast("long").alias("id"), F.coalesce("lang", F.lit("und")).alias("of"), F.xxhash64(F.col("text").cast("string")).alias("hash")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key)
    same = F.col("id").eqNullSafe(F.col("good_id")) & (F.col("of") == F.col("good_lang")) & (F.col("hash") == F.col("good_hash"))
    return rows.join(good, same, "left_semi").select("row.*")


def op8_quality_rules(docs: DataFrame) -> DataFrame:
    names = ["doc_id", *COUNTS, "base_failed", "kept", "log_ppl", "band_low", "band_high", "class_log_ppl", "class_band_low", "class_band_high"]
    return judge(docs).select(*names)
