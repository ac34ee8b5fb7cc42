"""Subword ids of whole texts, tokenising each distinct unit once.

``word_bpe_49k.json`` lowers case and splits a text at white space and
between letters and punctuation before any merge, so the ids of a text are
the ids of its units in order, where a unit is a white-space word cut
between an ASCII letter and ASCII punctuation (not after an apostrophe,
which may open a contraction).  A batch's units are hashed with numpy, only
units not seen yet go to the tokenizer, and the ids of all texts are
gathered from the cache.  Unseen units of letters alone go through it many
at a time, since the vocabulary marks where each word ends.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import public_tokenizers

from quizlog.llm import bytetext as B

#: Default vocabulary file; every caller takes the path as a parameter.
VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 500_000
TOGETHER = 512

_CACHES: dict[str, "WordIds"] = {}

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
for _a, _b in ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)):
    _PUNCT[_a : _b + 1] = True
_OPENS = _PUNCT.copy()  # punctuation after which a letter starts a unit
_OPENS[ord("'")] = False


def default_path() -> str:
    return public_tokenizers.path(VOCABULARY)


def units(texts: pa.Array, split: bool = True) -> B.Words:
    """White-space words in lower case, cut where the tokenizer always cuts."""
    w = B.scan(texts, B.SPACE_WORDS)
    if not split or not w.start.size:
        return w
    d = w.data
    cut = np.flatnonzero((_LETTER[d[:-1]] & _PUNCT[d[1:]]) | (_OPENS[d[:-1]] & _LETTER[d[1:]])) + 1
    edge = np.zeros(d.size + 1, bool)
    edge[w.offsets] = True  # never across texts
    cut = cut[~edge[cut]]
    start = np.sort(np.concatenate([w.start, cut]))
    end = np.sort(np.concatenate([w.end, cut]))
    return B.Words(d, w.offsets, start, end, np.searchsorted(start, w.offsets))


class WordIds:
    """Ids of units by hash; emptied when it holds ``CACHE_WORDS`` units."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # strings the tokenizer finds before it splits anything
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def _put(self, hashes: list[int], ids: np.ndarray, lens: np.ndarray) -> None:
        n, total = len(self.slot), ids.size
        while self.used + total > self.flat.size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + lens.size > self.start.size:
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used : self.used + total] = ids
        self.start[n : n + lens.size] = self.used + np.cumsum(lens) - lens
        self.length[n : n + lens.size] = lens
        self.used += total
        self.slot.update(zip(hashes, range(n, n + lens.size)))

    def _one_by_one(self, hashes: list[int], words: list[str]) -> None:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        self._put(hashes, np.array([i for ids in got for i in ids], np.uint32), lens)

    def _add(self, hashes: list[int], words: list[str]) -> None:
        plain = [i for i, x in enumerate(words) if x.isalpha()]
        other = set(range(len(words))).difference(plain)
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = np.array(self.tokenizer.encode(" ".join([words[i] for i in some]), add_special_tokens=False).ids, np.int64)
            last = np.flatnonzero(self.ends[ids])
            if last.size == len(some) and last[-1] == ids.size - 1:
                self._put([hashes[i] for i in some], ids, np.diff(last, prepend=-1))
            else:  # a letter that turns into more than a letter in lower case
                other.update(some)
        if other:
            rest = sorted(other)
            self._one_by_one([hashes[i] for i in rest], [words[i] for i in rest])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets)."""
        raw, _ = B.buffers(texts)
        whole = raw.tobytes()
        w = units(texts) if not any(s in whole for s in self.special) else B.scan(texts, B.RAW_WORDS)
        hashes = B.word_hashes(w)
        order = np.argsort(hashes)
        in_order = hashes[order]
        new_run = np.concatenate([[True], in_order[1:] != in_order[:-1]]) if hashes.size else np.zeros(0, bool)
        inverse = np.empty(hashes.size, np.int64)
        inverse[order] = np.cumsum(new_run) - 1
        first = order[new_run]
        if len(self.slot) > CACHE_WORDS:
            self.clear()
        keys = in_order[new_run].tolist()
        slot = self.slot
        got = [slot.get(k, -1) for k in keys]
        new = [i for i, s in enumerate(got) if s < 0]
        if new:
            data = w.data.tobytes()
            starts, ends = w.start[first].tolist(), w.end[first].tolist()
            for at in range(0, len(new), 65_536):
                some = new[at : at + 65_536]
                self._add([keys[i] for i in some], [data[starts[i] : ends[i]].decode("utf-8", "replace") for i in some])
            for i in new:
                got[i] = slot[keys[i]]
        slots = np.array(got, np.int64)[inverse]
        lens = self.length[slots]
        to = np.cumsum(lens)
        ids = self.flat[np.repeat(self.start[slots] - (to - lens), lens) + np.arange(to[-1] if to.size else 0)]
        return ids, np.concatenate([[0], to])[w.first]


def word_ids(path: str) -> WordIds:
    """The process's cache for a vocabulary file (one per Python worker)."""
    if path not in _CACHES:
        _CACHES[path] = WordIds(path)
    return _CACHES[path]


def document_ids(texts: pa.Array, path: str, end_id: int | None = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text followed by ``end_id``: (all ids, offsets)."""
    ids, off = word_ids(path).ids(texts)
    if end_id is None:
        return ids, off
    n = len(off) - 1
    return np.insert(ids, off[1:], np.uint32(end_id)), off + np.arange(n + 1)
