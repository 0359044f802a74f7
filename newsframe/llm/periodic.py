"""Periodic runs inside documents (operator 13).

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 q)``
words long, that no neighbouring word extends. The words of a slice of documents are
numbered by an exact dictionary, and their suffixes sorted by prefix doubling, which
goes on only inside groups that are still equal; the ranks of each doubling give the common
prefix of neighbours. A bottom-up walk of the LCP-interval tree keeps, for every open
interval, its positions in sorted lists by the word on their left. Where two children of an interval with
common prefix l meet, positions x < y with different left words form a maximal pair: the words
from x to y + l have period y - x and neither end can be extended. With
``y - x <= l`` and ``y - x + l >= least`` the stretch is a run already, so nothing is
extended; of pairs with the same stretch the smallest distance is its period. The lists are
searched only within distance l, and the smaller child's positions are put
into the larger one's, so pairs that are no runs cost nothing and the rest is
bounded by the sum of the runs' exponents.

All work on a document is done where its text lies: there is no shuffle, and working memory
is that of ``textops.SLICE_BYTES`` of text, or of one longer text.

Defined results: null, empty and blank texts have no words and no runs; rows with a null ``doc_id``
and repeated rows are judged each; an empty table gives an empty result; other
columns are ignored. Of several longest runs the first one is reported.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm import textops as T

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long")
#: Up to so many lists of left words are searched one by one; beyond, one list of all positions.
FEW_LISTS = 8


class Sequence:
    """Words of a slice of texts: an exact number for each, and its bytes."""

    def __init__(self, col: pa.Array):
        data, off = T.buffers(col)
        space = T._SPACE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[off] = True
        start, end = ~space, ~space
        start[1:] &= space[:-1] | edge[1:-1]
        end[:-1] &= space[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.data = data
        self.first = np.searchsorted(self.start, off)
        bounds = np.zeros(len(self.start) + 1, dtype=np.int64)
        np.cumsum(self.end - self.start, out=bounds[1:])
        solid = np.ascontiguousarray(data[~space])
        words = pa.Array.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(bounds), pa.py_buffer(solid)])
        self.code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def joined(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words ``which``, each followed by a space, and the words' bounds in them."""
        size = self.end[which] - self.start[which] + 1
        bounds = np.zeros(len(which) + 1, dtype=np.int64)
        np.cumsum(size, out=bounds[1:])
        at = np.arange(bounds[-1]) + np.repeat(self.start[which] - bounds[:-1], size)
        at[bounds[1:] - 1] = 0
        out = self.data[at] if len(at) else np.zeros(0, np.uint8)
        out[bounds[1:] - 1] = 32
        return out, bounds


def suffix_order(doc: np.ndarray, code: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next words occur again in their document, in suffix order, and the
    common prefix with the one before each (0 where it is below ``shortest``)."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = doc * (int(code.max()) + 1) + code
    active = np.argsort(key, kind="stable")
    sorted_key = key[active]
    t = np.arange(n)
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[active] = np.maximum.accumulate(np.where(head, t, 0))
    active = _repeated(active, head)
    levels, length, wanted = [rank.astype(np.int32)], 1, active
    while len(active):
        after = np.minimum(active + length, n - 1)
        second = np.where(active + length < n, rank[after], -1)
        key = rank[active] * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        t = np.arange(len(active))
        old = np.maximum.accumulate(np.where(np.concatenate([[True], group[1:] != group[:-1]]), t, 0))
        head = np.concatenate([[True], key[1:] != key[:-1]])
        slot = group + t - old  # an equal group keeps its places in the order
        rank[active] = slot[np.maximum.accumulate(np.where(head, t, 0))]
        active = _repeated(active, head)
        length *= 2
        levels.append(rank.astype(np.int32))
        if length <= shortest:
            wanted = active
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pos = wanted[np.argsort(rank[wanted])]
    x, y = pos[:-1], pos[1:]
    common = np.zeros(len(x), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, step = levels[k], 1 << k
        inside = np.maximum(x, y) + common < n
        same = inside & (level[np.minimum(x + common, n - 1)] == level[np.minimum(y + common, n - 1)])
        common[same] += step
    common[common < shortest] = 0
    return pos, np.concatenate([[0], common])


def _repeated(positions: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Members of groups with two positions or more; ``head`` marks each group's first."""
    alone = head & np.concatenate([head[1:], [True]])
    return positions[~alone]


def maximal_pairs(pos: list[int], common: list[int], left: list[int], least: int) -> dict[tuple[int, int], int]:
    """Runs as {(start, end): period}: maximal pairs (x, y) of the LCP-interval tree with y - x <= l and y - x + l >= least."""
    runs: dict[tuple[int, int], int] = {}

    def meet(a, b, l):
        """Pairs between two children of an interval with common prefix l; their union."""
        (lists, every), (few, some) = (a, b) if len(a[1]) >= len(b[1]) else (b, a)
        if len(lists) > 1 or len(few) > 1 or next(iter(lists)) != next(iter(few)):
            for c, xs in few.items():
                if len(lists) <= FEW_LISTS:
                    sought = [ys for c2, ys in lists.items() if c2 != c]
                else:
                    sought = [every]
                for ys in sought:
                    for x in xs:
                        for y in ys[bisect_left(ys, x - l): bisect_right(ys, x + l)]:
                            d = y - x if y > x else x - y
                            if d + l >= least and left[y] != c:
                                found = (x if x < y else y, (x if x > y else y) + l)
                                if d < runs.get(found, d + 1):
                                    runs[found] = d
        for c, xs in few.items():
            ys = lists.get(c)
            if ys is None:
                lists[c] = xs
            else:
                for x in xs:
                    insort(ys, x)
        for x in some:
            insort(every, x)
        return lists, every

    depth: list[int] = []
    held: list[tuple[dict, list]] = []
    cur = None
    for p, l in zip(pos, common, strict=True):
        while depth and depth[-1] > l:
            cur = meet(held.pop(), cur, depth.pop())
        if l:
            if depth and depth[-1] == l:
                held[-1] = meet(held[-1], cur, l)
            else:
                depth.append(l)
                held.append(cur)
        cur = ({left[p]: [p]}, [p])
    while depth:
        cur = meet(held.pop(), cur, depth.pop())
    return runs


def find_runs(doc: np.ndarray, code: np.ndarray, least: int = 12) -> np.ndarray:
    """Rows (start, length, period) of all runs of a slice, by start and period; positions count through the slice."""
    pos, common = suffix_order(doc, code, (least + 1) // 2)
    left = np.concatenate([[-1], np.where(doc[1:] == doc[:-1], code[:-1], -1)]) if len(code) else code
    near = common > 0
    keep = near | np.concatenate([near[1:], [False]])  # without a neighbour there is no pair
    lists = dict(zip(pos[keep].tolist(), left[pos[keep]].tolist(), strict=True))
    runs = maximal_pairs(pos[keep].tolist(), common[keep].tolist(), lists, least)
    out = np.array([(s, e - s, d) for (s, e), d in runs.items()], dtype=np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where and with which period a document's words are made to repeat: every tenth id by its crc32."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _report(least: int, plant: bool):
    def task(batches):
        for batch in T.slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            seq = Sequence(batch.column("text"))
            first = seq.first
            n = np.diff(first)
            source = np.arange(len(seq.code))
            for k, doc_id in enumerate(ids if plant else ()):
                if (made := planted(doc_id, int(n[k]))) is not None:
                    a, p = made
                    source[first[k] + a: first[k + 1]] = first[k] + a + np.arange(n[k] - a) % p
            doc = np.repeat(np.arange(len(ids)), n)
            runs = find_runs(doc, seq.code[source], least)
            cover = np.zeros(len(source) + 1, dtype=np.int64)
            np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
            np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
            stays = np.cumsum(cover[:-1]) == 0
            text, bounds = seq.joined(source[stays])
            upto = np.concatenate([[0], np.cumsum(stays)])[first]
            raw, of = memoryview(text), np.searchsorted(runs[:, 0], first)
            rows = []
            for k, doc_id in enumerate(ids):
                mine = runs[of[k]: of[k + 1]] - [first[k], 0, 0]
                lines = "".join(f"{s},{l},{q}\n" for s, l, q in mine.tolist())
                best = min(((-l, s, q) for s, l, q in mine.tolist()), default=None)
                a, z = int(bounds[upto[k]]), max(int(bounds[upto[k + 1]]) - 1, int(bounds[upto[k]]))
                rows.append((doc_id, len(mine), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
                             hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(raw[a:z]).hexdigest(), int(n[k]), int(upto[k + 1] - upto[k])))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.int64()] * 2
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
    return task


def _runs(least: int):
    def task(batches):
        for batch in T.slices(batches, "text"):
            ids = batch.column("doc_id")
            seq = Sequence(batch.column("text"))
            doc = np.repeat(np.arange(len(ids)), np.diff(seq.first))
            runs = find_runs(doc, seq.code, least)
            of = doc[runs[:, 0]]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(of)), *(pa.array(c) for c in (runs[:, 0] - seq.first[of], runs[:, 1], runs[:, 2]))],
                names=["doc_id", "start", "length", "period"])
    return task


def runs_of(docs: DataFrame, least: int = 12) -> DataFrame:
    """Every run of every document: (doc_id, start, length, period), start counted in words from 0."""
    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return src.mapInArrow(_runs(least), "doc_id long, start long, length long, period long")


def run_report(docs: DataFrame, least: int = 12, plant: bool = False) -> DataFrame:
    """Per document the number of runs, its longest one, digests of all runs and of the text without the
    repeated parts (a word that some run holds after its first period is dropped). With ``plant``
    the words of every tenth document are first made to repeat."""
    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return src.mapInArrow(_report(least, plant), SCHEMA)
