"""Token ids of whole texts with a fixed public tokenizer, word by word.

The tokenizer splits at white space in any case, so the ids of a text are those of its pieces
between the ASCII white-space characters, put one after the other. Each distinct piece of a block
is encoded once, and the first `KEEP` distinct pieces that a Python worker meets stay known to
it for later blocks, as hashes in flat arrays of about 25 MB in all.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from sightline.llm.text import words_of

KEEP = 600_000
JOINED = 64
BLOCK_CHARS = 2_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def spans_to_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every span, one span after the other."""
    total = int(lengths.sum())
    shift = starts - np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.repeat(shift, lengths) + np.arange(total)


class Memo:
    """Ids of words met before, under 128-bit hashes of the words, in arrays of some 40 bytes a word.

    A word is first held in the newer of two sorted levels, which joins the older one when it has
    grown to a quarter of it.
    """

    def __init__(self):
        self.levels = [self._level() for _ in range(2)]
        self.ids = np.zeros(0, np.uint32)
        self.size = 0

    @staticmethod
    def _level(keys=None, starts=(), counts=()):
        keys = np.zeros((0, 2), np.uint64) if keys is None else keys
        order = np.argsort(keys[:, 0], kind="stable")
        return keys[order], np.asarray(starts, np.int64)[order], np.asarray(counts, np.int32)[order]

    @staticmethod
    def keys(words: Iterable[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in `ids` (-1: unknown) and number of ids of each key."""
        starts, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for held, at, n in self.levels:
            if len(held):
                place = np.minimum(np.searchsorted(held[:, 0], keys[:, 0]), len(held) - 1)
                hit = (held[place] == keys).all(axis=1)
                starts[hit], counts[hit] = at[place[hit]], n[place[hit]]
        return starts, counts

    def add(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        starts = len(self.ids) + np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.ids = np.concatenate([self.ids, ids])
        self.size += len(keys)
        old, new = self.levels
        new = self._join(new, (keys, starts, counts))
        if len(new[0]) * 4 > len(old[0]):
            old, new = self._join(old, new), self._level()
        self.levels = [old, new]

    def _join(self, a, b):
        return self._level(*(np.concatenate([x, y]) for x, y in zip(a, b)))


class Encoder:
    """Encodes blocks of texts to flat arrays of ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = Memo()

    def _fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each word. Words go to the tokenizer joined by blanks; the
        places of the tokens tell them apart again."""
        chunks = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        encoded = self.tokenizer.encode_batch(list(map(" ".join, chunks)), add_special_tokens=False)
        for chunk, e in zip(chunks, encoded):
            starts = np.zeros(len(chunk), np.int64)
            np.cumsum([len(w) + 1 for w in chunk[:-1]], out=starts[1:])
            at = np.fromiter((a for a, _ in e.offsets), np.int64, len(e))
            place = np.searchsorted(starts, at, "right") - 1
            counts.append(np.bincount(place, minlength=len(chunk)))
            ids.append(np.array(e.ids, np.uint32))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: none), and the places at which each text begins and ends."""
        # The tokenizer lower-cases all but its special tokens, so letters may be lower-cased first;
        # that leaves fewer distinct pieces.
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        codes, offsets, distinct = words_of(texts)
        words = distinct.to_numpy(zero_copy_only=False)
        keys = self.memo.keys(words)
        firsts, counts = self.memo.find(keys)
        new = np.flatnonzero(firsts < 0)
        ids, own = self._fresh(words[new].tolist())
        old = len(self.memo.ids)
        ends = np.cumsum(own)
        firsts[new], counts[new] = old + ends - own, own
        known = np.concatenate([self.memo.ids, ids])
        keep = min(len(new), max(0, KEEP - self.memo.size))
        if keep:
            self.memo.add(keys[new[:keep]], own[:keep], ids[: ends[keep - 1]])

        lengths = counts[codes]
        out = known[spans_to_index(firsts[codes], lengths)]
        return out, np.concatenate([[0], np.cumsum(lengths)])[offsets]


_encoder = lru_cache(1)(Encoder)


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """The worker's encoder, for one task. What the task leaves free goes back to the system at its
    end, since workers live on idle; the memo stays, at some 40 bytes a word."""
    try:
        yield _encoder(path)
    finally:
        give_back_memory()


def give_back_memory() -> None:
    """Return what Arrow's and the C library's allocators hold free to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def with_end(ids: np.ndarray, cuts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with `end_id` after each text, and the moved places."""
    return np.insert(ids, cuts[1:], np.uint32(end_id)), cuts + np.arange(len(cuts))
