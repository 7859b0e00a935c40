"""Token ids of texts by words, for a tokenizer that drops white space.

Words are found and hashed in numpy; the ids of words met before are gathered
from a ``Memo``, new ones are encoded by the tokenizer, many to a call.
"""

from __future__ import annotations

import os
import re
from itertools import chain as joined

import numpy as np

from .memo import Memo
from .textbytes import SPACE, Chunk, words

#: Fixed values of the tokenizer: how it parts words of these letters (lower case, composed), and which words these are.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-įı-ɏ]+")
PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^a-z0-9ß-öø-ɏ]+")
PER_CALL = 500


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """``entries`` bounds the words kept (parts: a fifth of it), those met again first; what is dropped is encoded anew."""

    def __init__(self, path: str, entries: int = 2_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.closing = np.zeros(self.size, bool)  # the last id of a part
        self.closing[[i for s, i in vocabulary.items() if s.endswith("</w>")]] = True
        self.memo, self.parts_kept = Memo([np.uint32], entries), entries // 5
        self.parts: dict[str, bytes] = {}

    def _learn_parts(self, parts: list[str]) -> None:
        calls = [parts[i : i + PER_CALL] for i in range(0, len(parts), PER_CALL)]
        told = self.tokenizer.encode_batch_fast([" ".join(c) for c in calls], add_special_tokens=False)
        for some, e in zip(calls, told, strict=True):
            ids = np.asarray(e.ids, np.uint32)
            cuts = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
            if len(cuts) != len(some):  # a part the tokenizer parts again: one by one
                self.parts.update((p, np.asarray(self.tokenizer.encode(p, add_special_tokens=False).ids, np.uint32).tobytes()) for p in some)
                continue
            body = ids.tobytes()
            self.parts.update(zip(some, (body[a:b] for a, b in zip([0, *cuts], cuts, strict=False)), strict=True))

    def learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, counts) of words."""
        cut: list[list[str] | None] = []
        for w in new:
            low = w.lower()
            if "<|" in w or "İ" in w or not SIMPLE.fullmatch(w):
                cut.append(None)  # names of special tokens, other scripts: whole
            else:
                cut.append([low] if w.isascii() and w.isalpha() else PART.findall(low))
        if len(self.parts) > self.parts_kept:
            self.parts = {}
        parts = self.parts
        self._learn_parts(list({p for p in joined.from_iterable(c for c in cut if c) if p not in parts}))
        whole = iter(self.tokenizer.encode_batch_fast([w for w, c in zip(new, cut, strict=True) if c is None], add_special_tokens=False))
        out = [np.asarray(next(whole).ids, np.uint32).tobytes() if c is None else b"".join([parts[p] for p in c]) for c in cut]
        counts = np.fromiter(map(len, out), np.int64, len(out)) // 4
        return np.frombuffer(b"".join(out), np.uint32), counts

    def __call__(self, rows: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each row) of a chunk of texts."""
        found = words(rows)
        if not len(found.hashes):
            return np.zeros(0, np.uint32), np.zeros(rows.rows, np.int64)
        body = rows.data.tobytes()

        def learn(at: np.ndarray) -> list:
            stop = np.append(SPACE[rows.data], True)
            stop[rows.offsets[1:]] = True
            stops = np.flatnonzero(stop)
            lo = found.starts[at]
            hi = stops[np.searchsorted(stops, lo, "right")]
            return [self.learn([body[a:b].decode() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])]

        entries = self.memo.entries_of(found.hashes, learn)
        ids, counts = self.memo.pools[0].take(entries)
        ends = np.concatenate([[0], np.cumsum(counts)])[found.first]
        return ids, np.diff(ends)


_ready: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, entries: int = 2_000_000) -> WordIds:
    """The worker's encoder: what it has met serves its later tasks, too."""
    if (path, entries) not in _ready:
        _ready[path, entries] = WordIds(path, entries)
    return _ready[path, entries]
