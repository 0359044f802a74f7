"""Byte-level BPE ids of whole texts, computed once for each distinct piece of a task.

The vocabulary is a ``tokenizers`` JSON file. Its pre-tokeniser always starts a new
token at a space that stands between two characters other than white space, and
between an ASCII letter and ASCII punctuation, so a text cut there gives the same ids piece by
piece. Pieces are found and hashed on the Arrow buffer; only pieces that a
worker has not met yet are encoded, the rest is a table look-up.
"""

from __future__ import annotations

import ctypes
import functools
import json

import numpy as np
import pyarrow as pa

from newsframe.llm import textops as T

#: Distinct pieces a worker remembers before it starts anew (bounds memory, never results).
CACHE_PIECES = 1_500_000
# Fixed value: the pre-tokeniser's pattern, as published with the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = b"<|endoftext|>"

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[list(b".,;:!?#$%&*")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of one string. Where the merges are in the order of the ids (as in
    byte-level BPE by rank) the rank encoder gives the same ids faster; strings that
    hold a special token, and other vocabularies, go through ``tokenizers``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.fast = None
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        if made == sorted(made):
            import tiktoken

            visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
            byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
            special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, piece: bytes) -> list[int]:
        text = piece.decode("utf-8")
        if self.fast is None or SPECIAL in piece:
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class IdTable:
    """Ids by the 64-bit hash of a piece."""

    def __init__(self, path: str):
        self.encode = Encoder(path)
        self._clear()

    def _clear(self):
        self.keys, self.slot = np.zeros(0, T.U64), np.zeros(0, np.int64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def look(self, hashes: np.ndarray, fetch) -> np.ndarray:
        """Slots of the pieces with these hashes; ``fetch(i)`` gives the i-th one's bytes."""
        if len(self.keys) > CACHE_PIECES:
            self._clear()
        uniq, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        new = np.flatnonzero(~known)
        if len(new):
            got = [self.encode(fetch(i)) for i in first[new].tolist()]
            n = np.fromiter(map(len, got), np.int64, len(got))
            total = int(n.sum())
            while self.used + total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used: self.used + total] = np.fromiter((i for g in got for i in g), np.uint32, total)
            base = len(self.start)
            self.start = np.concatenate([self.start, self.used + np.cumsum(n) - n])
            self.length = np.concatenate([self.length, n])
            self.used += total
            self.keys = np.insert(self.keys, at[new], uniq[new])
            self.slot = np.insert(self.slot, at[new], np.arange(base, base + len(new)))
            at = np.searchsorted(self.keys, uniq)
        return self.slot[at][back]

    def expand(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in a row, and how many each has."""
        n = self.length[slots]
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[slots] - (ends - n), n)
        return self.ids[at], n


@functools.lru_cache(maxsize=4)
def id_table(path: str) -> IdTable:
    """The table of this worker process for a vocabulary file."""
    return IdTable(path)


def forget_ids() -> None:
    """Return the memory of this worker's tables. Spark uses a worker for the tasks of later stages too, which
    do not read them but have the same memory."""
    id_table.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc keeps what is freed
    if trim is not None:
        trim(0)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Positions inside the bytes where a new piece starts whatever stands around."""
    d = data
    if len(d) < 5:
        return np.zeros(0, np.int64)
    p = np.flatnonzero(d == 32)
    p = p[(p > 0) & (p < len(d) - 1)]
    before, after = d[p - 1], d[p + 1]
    wide = (before >= 128) & (_WIDE[d[np.maximum(p - 2, 0)]] | _WIDE[d[np.maximum(p - 3, 0)]])
    spaces = p[~(_BLANK[before] | _BLANK[after] | wide | _WIDE[after])]
    points = np.flatnonzero(_PUNCT[d[1:]] & _LETTER[d[:-1]]) + 1
    return np.concatenate([spaces, points])


def text_ids(col: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column in a row, and how many each text has (null: empty)."""
    data, off = T.buffers(col)
    lengths = np.zeros(len(off) - 1, dtype=np.int64)
    if not len(data):
        return np.zeros(0, np.uint32), lengths
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[_cuts(data)] = True
    cut[off] = True
    if b"<|" in (raw := data.tobytes()):  # no cut inside a special token
        i = raw.find(SPECIAL)
        while i >= 0:
            cut[i + 1: i + len(SPECIAL)] = False
            i = raw.find(SPECIAL, i + 1)
    edge = np.flatnonzero(cut)
    s, e = edge[:-1], edge[1:]
    table = id_table(path)
    slots = table.look(T._hash_words(data, s, e, False), lambda i: raw[s[i]:e[i]])
    ids, n = table.expand(slots)
    total = np.concatenate([[0], np.cumsum(n)])
    at = np.searchsorted(edge, off)
    return ids, np.diff(total[at])
