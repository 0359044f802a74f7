"""Benchmark decontamination by n-gram seeds and local alignment (operator 7).

Words are lower-cased and stripped of the marks around them. Every n-gram of a benchmark item is
counted over all documents, and those that some document holds become its seeds. None is left
out for a rarer one: an edited copy may hold only the more frequent n-grams, because the edits broke
the others, which are rare for that reason. A document region with ``least`` or more different seeds of an item (one for an item with
few) in about the item's order is aligned with the item by the Smith-Waterman
recurrence (match 2, mismatch -1, gap -1); the score over twice the item's length, 1 for
a verbatim copy, is reported from ``threshold`` on.

Documents are never shuffled: an item block of at most ``block_words`` words travels to them, a bounded
amount at any size, and a larger benchmark takes several passes. Only the seeds'
counts are summed by Spark. Nothing is grouped by document or item, so no key is hot.

Defined results: null and empty texts hold nothing; items without words match nothing; rows with a null
``doc_id`` are searched and reported with that; repeated rows are reported each, repeated items
under each id; empty tables give an empty result; other columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import words_of
from newsframe.llm.features import _EDGE

N = 4
SCHEMA = "doc_id long, item_id long, score double, start long, end long, n_seeds long"


def bare(col: pa.Array) -> T.Words:
    """Words lower-cased and without the marks around them; words of marks only are dropped."""
    w = T.words(pc.utf8_lower(col), lower=True)  # of all scripts
    s, e = w.start.copy(), w.end.copy()
    for _ in range(8):
        if len(s):
            s += (s < e - 1) & _EDGE[w.data[s]]
            e -= (s < e - 1) & _EDGE[w.data[e - 1]]
    keep = np.flatnonzero(~((e - s == 1) & _EDGE[w.data[s]])) if len(s) else np.zeros(0, np.int64)
    return T.Words(w.data, T._hash_words(w.data, s[keep], e[keep], True), s[keep], e[keep], w.doc[keep], w.n_docs)


@dataclass
class Items:
    """A block of benchmark items: word hashes in a row with bounds, and their n-grams."""
    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    gram: np.ndarray       # n-gram hashes, sorted
    item: np.ndarray       # the item of each
    place: np.ndarray      # and its word number there


def items_of(ids: list, texts: list[str | None]) -> Items:
    w = bare(pa.array(texts, pa.string()))
    h, at = w.ngrams(N)
    item, place = w.doc[at], at - w.first[w.doc[at]]
    count = w.counts()
    short = np.flatnonzero((count > 0) & (count < N))
    for d in short:  # an item of fewer words is one gram of that length
        k = int(count[d])
        g, a = T.Words(w.data, w.hash[w.first[d]:w.first[d + 1]], None, None, np.zeros(k, np.int64), 1).ngrams(k)
        h, item, place = np.append(h, g), np.append(item, d), np.append(place, 0)
    order = np.argsort(h, kind="stable")
    return Items(np.array(ids, dtype=np.int64), w.hash, w.first, h[order], item[order], place[order])


def _doc_grams(w: T.Words, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    parts = [w.ngrams(k) for k in sizes]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _sizes(items: Items) -> list[int]:
    n = np.diff(items.first)
    return sorted({int(min(x, N)) for x in n if x > 0}) or [N]


def _seed_counts(items: Items):
    grams, sizes = np.unique(items.gram), _sizes(items)

    def run(batches):
        total = np.zeros(len(grams), dtype=np.int64)
        for b in T.slices(batches, "text"):
            w = bare(b.column("text"))
            h, at = _doc_grams(w, sizes)
            p = np.searchsorted(grams, h)
            p[p == len(grams)] = 0
            hit = np.flatnonzero(grams[p] == h) if len(grams) else np.zeros(0, np.int64)
            pair = np.unique((w.doc[at[hit]].astype(np.int64) << 32) | p[hit])
            total += np.bincount(pair & 0xFFFFFFFF, minlength=len(grams))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([T.signed(grams[at]), pa.array(total[at])], names=["gram", "n"])
    return run


def pick_seeds(items: Items, counts: dict[int, int]) -> Items:
    """The items with only the n-grams that some document holds."""
    keep = np.flatnonzero([counts.get(int(g), 0) > 0 for g in items.gram.view(np.int64)])
    return Items(items.ids, items.words, items.first, items.gram[keep], items.item[keep], items.place[keep])


def smith_waterman(item: np.ndarray, regions: np.ndarray, match: int = 2, miss: int = -1, gap: int = -1):
    """Best local score of ``item`` against each row of ``regions`` (0: no word), and where it ends
    (item word, region word)."""
    p, r = regions.shape
    h = np.zeros((p, r + 1), dtype=np.int32)
    best, bi, bj = np.zeros(p, np.int32), np.zeros(p, np.int64), np.zeros(p, np.int64)
    slope = gap * np.arange(r + 1, dtype=np.int32)
    rows = np.arange(p)
    for i, x in enumerate(item):
        t = np.maximum(h + gap, 0)
        np.maximum(t[:, 1:], h[:, :-1] + np.where(regions == x, match, miss).astype(np.int32), out=t[:, 1:])
        h = np.maximum.accumulate(t - slope, axis=1) + slope  # gaps along the region
        j = h.argmax(axis=1)
        v = h[rows, j]
        better = v > best
        best[better], bi[better], bj[better] = v[better], i, j[better] - 1
    return best, bi, bj


def _search(items: Items, least: int, threshold: float):
    """For a slice's words: arrays (document, item, score, start, end, seeds) of the matches."""
    sizes = _sizes(items)
    length = np.diff(items.first)
    seeds = np.bincount(items.item, minlength=len(items.ids)) if len(items.item) else np.zeros(len(items.ids), np.int64)
    grams, lo = np.unique(items.gram, return_index=True)
    hi = np.append(lo[1:], len(items.gram))

    def find(w: T.Words):
        h, at = _doc_grams(w, sizes)
        p = np.searchsorted(grams, h)
        p[p == len(grams)] = 0
        hit = np.flatnonzero(grams[p] == h) if len(grams) else np.zeros(0, np.int64)
        if not len(hit):
            return None
        k = hi[p[hit]] - lo[p[hit]]
        which = np.repeat(lo[p[hit]], k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
        at = np.repeat(at[hit], k)
        item, doc = items.item[which], w.doc[at]
        begin = at - items.place[which]  # where the item would begin
        order = np.lexsort((begin, doc, item))
        item, doc, begin, which = item[order], doc[order], begin[order], which[order]
        cut = np.ones(len(item), dtype=bool)
        cut[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] - begin[:-1] > length[item[1:]] // 4 + 3)
        run = np.cumsum(cut) - 1
        pairs = np.unique((run.astype(np.int64) << 32) | which)
        n_seeds = np.bincount(pairs >> 32, minlength=run[-1] + 1)
        head = np.flatnonzero(cut)
        tail = np.append(head[1:], len(item)) - 1
        it, dc = item[head], doc[head]
        ok = n_seeds >= np.minimum(least, np.maximum(seeds[it] // 2, 1))
        head, tail, it, dc, n_seeds = head[ok], tail[ok], it[ok], dc[ok], n_seeds[ok]
        pad = length[it] // 4 + 3
        a = np.maximum(begin[head] - pad, w.first[dc])
        z = np.minimum(begin[tail] + length[it] + pad, w.first[dc + 1])
        found = []
        for x in np.unique(it):
            rows = np.flatnonzero(it == x)
            words = items.words[items.first[x]:items.first[x + 1]]
            rows = rows[np.argsort(z[rows] - a[rows], kind="stable")]
            for c in range(0, len(rows), 256):
                q = rows[c:c + 256]
                size = z[q] - a[q]
                most = int(size.max())
                place = a[q][:, None] + np.minimum(np.arange(most), size[:, None] - 1)
                region = np.where(np.arange(most) < size[:, None], w.hash[place], T.U64(0))
                score, bi, bj = smith_waterman(words, region)
                good = np.flatnonzero(score >= threshold * 2 * len(words))
                for g in good:  # the same alignment backwards ends where it began
                    back, _, bk = smith_waterman(words[:bi[g] + 1][::-1], region[g, :bj[g] + 1][None, ::-1])
                    found.append((dc[q[g]], x, score[g] / (2 * len(words)), a[q[g]] + bj[g] - bk[0] - w.first[dc[q[g]]], a[q[g]] + bj[g] + 1 - w.first[dc[q[g]]], n_seeds[q[g]]))
        if not found:
            return None
        cols = [np.array(c) for c in zip(*found, strict=True)]
        order = np.lexsort((cols[3], -cols[2], cols[1], cols[0]))  # the best place of an item in a document
        cols = [c[order] for c in cols]
        first = np.ones(len(order), dtype=bool)
        first[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        return [c[first] for c in cols]
    return find


def blocks(docs: DataFrame, benchmark: DataFrame, block_words: int) -> list[Items]:
    """The benchmark in blocks of about ``block_words`` words, with the seeds that
    occur in ``docs``."""
    rows = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = rows.agg(F.sum(F.size(words_of(F.col("text"))))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    out = []
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).toPandas().sort_values(["item_id", "text"])
        if not len(part):
            continue
        items = items_of(part.item_id.tolist(), part.text.tolist())
        counts = (docs.select("text").mapInArrow(_seed_counts(items), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas())
        out.append(pick_seeds(items, dict(zip(counts.gram.tolist(), counts.n.tolist(), strict=True))))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 2, threshold: float = 0.5,
                 block_words: int = 400_000) -> DataFrame:
    """doc_id, item_id, score, word range and number of seeds of every match."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def matcher(items: Items):
        find = _search(items, least, threshold)

        def run(batches):
            for b in T.slices(batches, "text"):
                got = find(bare(b.column("text")))
                if got is not None:
                    ids = b.column("doc_id").take(pa.array(got[0]))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(items.ids[got[1]]), pa.array(got[2].astype(float)), *[pa.array(c.astype(np.int64)) for c in got[3:]]],
                        names=["doc_id", "item_id", "score", "start", "end", "n_seeds"])
        return docs.mapInArrow(run, SCHEMA)
    parts = [matcher(x) for x in blocks(docs, benchmark, block_words)]
    out = parts[0] if parts else docs.mapInArrow(lambda batches: iter(()), SCHEMA)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, least: int = 2, threshold: float = 0.5,
          block_words: int = 400_000) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no benchmark item."""
    out = docs
    for items in blocks(docs, benchmark, block_words):
        find = _search(items, least, threshold)

        def run(batches, find=find):
            for b in T.slices(batches, "text"):
                got = find(bare(b.column("text")))
                keep = np.ones(b.num_rows, dtype=bool)
                if got is not None:
                    keep[got[0]] = False
                yield b.filter(pa.array(keep))
        out = out.mapInArrow(run, docs.schema)
    return out
