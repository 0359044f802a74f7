"""Removal of repeated passages by compacting a de Bruijn graph (operator 5).

A word is removed where a window of ``width`` consecutive words covers it whose word
sequence also starts in a document with a smaller ``doc_id``.

The windows are the edges of a de Bruijn graph over the corpus. Only anchors are
shuffled at first: the k-mer with the smallest hash among the k-mers of a window is a function
of the window's words, so equal windows have equal anchors, and runs of windows with one
anchor form one path. A join on the anchors brings the occurrences together:

* an anchor in one document only: its windows are unique, nothing follows;
* all occurrences of the anchor have the same path (it does not branch): the path is
  compacted, the smallest document of the anchor decides for all its windows;
* else the anchor branches, at the ends of a repeated passage. Its windows alone are
  compared one by one, in a second join.

Both decisions go back to the source by (document, anchor) and (document, window), where
the spans are read off at their coordinates in the text.

Occurrences of a path within one slice of an input split form one row, so a passage that
a third of all documents share reaches the shuffle once for each slice, not once for each document.

Defined results: null and empty texts have no words; texts shorter than the window keep
all words; rows with a null ``doc_id`` neither lose words nor make others lose them; rows
that repeat an id are judged each, and not against each other; an empty table gives an
empty result; other columns are ignored. Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import materialize, release

K = 6


class Paths:
    """Windows of the texts of a column, their anchors, and the runs with one anchor."""

    def __init__(self, col: pa.Array, width: int, k: int = K):
        self.words = w = T.words(col, lower=False)
        self.window, self.at = w.ngrams(width)
        self.doc = w.doc[self.at]
        n = len(self.at)
        per = width - k + 1
        if not n:
            self.anchor = self.head = self.tail = self.path = np.zeros(0, T.U64)
            self.head = self.tail = np.zeros(0, np.int64)
            return
        g = np.full(len(w.hash), k, dtype=T.U64)  # k-mers; those across texts are in no window
        m = len(w.hash) - k + 1
        for j in range(k):
            g[:m] = T.mix(g[:m] * T.U64(0x9FB21C651E98DF25) + w.hash[j:j + m])
        best, where = g[self.at], self.at.copy()
        for j in range(1, per):
            x = g[self.at + j]
            less = x < best
            best = np.where(less, x, best)
            where[less] = self.at[less] + j
        self.anchor = best
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (where[1:] != where[:-1]) | (self.doc[1:] != self.doc[:-1])
        self.head = np.flatnonzero(fresh)
        self.tail = np.append(self.head[1:], n) - 1
        a, z = self.window[self.head], self.window[self.tail]
        self.path = T.mix(a * T.U64(0xD6E8FEB86659FD93) + z + (self.tail - self.head).astype(T.U64))


def _anchors(width: int):
    """(anchor, path, doc_id, more): the documents of a slice that share a path make one row."""
    def run(batches):
        for b in T.slices(batches, "text", 2 * T.SLICE_BYTES):
            b = b.filter(b.column("doc_id").is_valid())
            if not b.num_rows:
                continue
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            p = Paths(b.column("text"), width)
            if not len(p.head):
                continue
            anchor, path, who = p.anchor[p.head], p.path, ids[p.doc[p.head]]
            order = np.lexsort((who, path, anchor))
            anchor, path, who = anchor[order], path[order], who[order]
            head = np.ones(len(who), dtype=bool)
            head[1:] = (anchor[1:] != anchor[:-1]) | (path[1:] != path[:-1])
            fresh = head.copy()
            fresh[1:] |= who[1:] != who[:-1]
            anchor, path, who, head = anchor[fresh], path[fresh], who[fresh], head[fresh]
            first = np.flatnonzero(head)
            extra = np.diff(np.append(first, len(who))) - 1
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(extra)]).astype(np.int32)), pa.array(who[~head]), mask=pa.array(extra == 0))
            out = pa.RecordBatch.from_arrays([T.signed(anchor[first]), T.signed(path[first]), pa.array(who[first]), lists], names=["anchor", "path", "doc_id", "more"])
            for i in range(0, out.num_rows, 1 << 17):
                yield out.slice(i, 1 << 17)
    return run


def _listed(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    col = batch.column(name)
    n = np.array([len(v) if v.is_valid else 0 for v in col], dtype=np.int64)
    return col.flatten().to_numpy(zero_copy_only=False).view(T.U64), np.repeat(np.arange(len(n)), n)


def _member(doc: np.ndarray, value: np.ndarray, listed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether (doc, value) is among the listed values of the document."""
    v, row = listed
    if not len(v):
        return np.zeros(len(doc), dtype=bool)
    return np.isin(T.mix(value ^ T.mix(doc.astype(T.U64) + T.U64(11))), T.mix(v ^ T.mix(row.astype(T.U64) + T.U64(11))))


def _windows(width: int):
    """(window, doc_id, more) of the windows whose anchors branch; documents of a slice share a row."""
    def run(batches):
        for b in T.slices(batches, "text", 2 * T.SLICE_BYTES):
            p = Paths(b.column("text"), width)
            at = np.flatnonzero(_member(p.doc, p.anchor, _listed(b, "branch")))
            win, who = p.window[at], b.column("doc_id").to_numpy(zero_copy_only=False)[p.doc[at]]
            order = np.lexsort((who, win))
            win, who = win[order], who[order]
            head = np.ones(len(win), dtype=bool)
            head[1:] = win[1:] != win[:-1]
            fresh = head.copy()
            fresh[1:] |= who[1:] != who[:-1]
            win, who, head = win[fresh], who[fresh], head[fresh]
            first = np.flatnonzero(head)
            extra = np.diff(np.append(first, len(who))) - 1
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(extra)]).astype(np.int32)), pa.array(who[~head]), mask=pa.array(extra == 0))
            yield pa.RecordBatch.from_arrays([T.signed(win[first]), pa.array(who[first]), lists], names=["window", "doc_id", "more"])
    return run


def _cut(width: int, wait: bool):
    """Result rows. ``wait``: texts with branching anchors are passed on instead."""
    def run(batches):
        for b in T.slices(batches, "text"):
            p = Paths(b.column("text"), width)
            gone = _member(p.doc, p.anchor, _listed(b, "gone"))
            if not wait:
                gone |= _member(p.doc, p.window, _listed(b, "same"))
            cover = np.zeros(len(p.words.hash) + 1, dtype=np.int64)
            np.add.at(cover, p.at[gone], 1)
            np.add.at(cover, p.at[gone] + width, -1)
            out = np.cumsum(cover[:-1]) > 0
            branch = b.column("branch")
            rows = []
            texts = b.column("text")
            first = p.words.first
            for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
                text = texts[i].as_py()
                if wait and branch[i].is_valid and len(branch[i]):
                    rows.append((doc_id, None, None, None, None, text, b.column("gone")[i].as_py(), branch[i].as_py()))
                    continue
                flags = out[first[i]:first[i + 1]]
                words = (text or "").encode().split()
                removed = int(flags.sum())
                spans = None
                if removed:
                    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
                    spans = ",".join(f"{x}:{y}" for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
                    words = [w for w, f in zip(words, flags.tolist(), strict=True) if not f]
                rows.append((doc_id, len(flags), removed, hashlib.sha256(b" ".join(words)).hexdigest(), spans, None, None, None))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, _TYPES, strict=True)], names=_NAMES)
    return run


_NAMES = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text", "gone", "branch"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans string, text string, gone array<long>, branch array<long>"
RESULT = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"]


def _members(frame: DataFrame, key: str) -> DataFrame:
    """One row per document of the rows (doc_id, more)."""
    ids = F.concat(F.array("doc_id"), F.coalesce("more", F.array().cast("array<long>")))
    return frame.withColumn("doc_id", F.explode(ids)).drop("more")


def repeated_removed(docs: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed word ranges (spans,
    start:end by word number) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    by = Window.partitionBy("anchor").orderBy("doc_id")
    every = Window.partitionBy("anchor")
    shared = (docs.mapInArrow(_anchors(width), "anchor long, path long, doc_id long, more array<long>")
              .withColumn("near", F.coalesce(F.lag("doc_id").over(by), F.lead("doc_id").over(by))).filter("near is not null or more is not null")
              .withColumn("least", F.min("doc_id").over(every)).withColumn("plain", F.min("path").over(every) == F.max("path").over(every)))
    marks = _members(shared.drop("near", "path"), "anchor").filter("not plain or least < doc_id").distinct()
    marks = marks.groupBy("doc_id").agg(F.collect_list(F.when(F.col("plain"), F.col("anchor"))).alias("gone"),
                                        F.collect_list(F.when(~F.col("plain"), F.col("anchor"))).alias("branch"))
    marks = materialize(marks, "sub-marks")
    none = F.array().cast("array<long>")
    cols = ["doc_id", "text", F.coalesce("gone", none).alias("gone"), F.coalesce("branch", none).alias("branch")]
    first = materialize(docs.join(marks, "doc_id", "left").select(*cols).mapInArrow(_cut(width, True), _SCHEMA), "sub-first")
    waiting = first.filter("n_words is null").select("doc_id", "text", "gone", "branch")
    by = Window.partitionBy("window").orderBy("doc_id")
    same = (waiting.mapInArrow(_windows(width), "window long, doc_id long, more array<long>")
            .withColumn("near", F.coalesce(F.lag("doc_id").over(by), F.lead("doc_id").over(by))).filter("near is not null or more is not null")
            .withColumn("least", F.min("doc_id").over(by)))
    same = _members(same.drop("near"), "window").filter("least < doc_id").groupBy("doc_id").agg(F.collect_set("window").alias("same"))
    last = (waiting.join(same, "doc_id", "left").withColumn("same", F.coalesce("same", none)).mapInArrow(_cut(width, False), _SCHEMA))
    out = materialize(last.select(*RESULT), "sub-last").unionByName(first.filter("n_words is not null").select(*RESULT))
    release(marks)
    return out
