"""Hashed text features for the classifiers, and linear scoring of whole texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import fold

_EDGE = np.zeros(256, dtype=bool)
_EDGE[list(b".,;:!?\"'()[]{}#$%&*<>|-_")] = True
# byte classes of a word's outline: lower, upper, digit, other ASCII mark, beyond ASCII
_CLASS = np.full(256, 3, dtype=np.uint8)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[128:] = 4

Featuriser = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _distinct(h: np.ndarray, doc: np.ndarray, n_docs: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each document (as a run), and the n_docs + 1 bounds."""
    key = np.unique((doc.astype(T.U64) << T.U64(bits)) | (h >> T.U64(64 - bits)))
    owner = (key >> T.U64(bits)).astype(np.int64)
    return (key & T.U64((1 << bits) - 1)).astype(np.int64), np.searchsorted(owner, np.arange(n_docs + 1))


def bare_words(bits: int = 20, stems: tuple[int, ...] = (5, 6, 7)) -> Featuriser:
    """Indicators of lower-cased words without the marks around them, and of the beginnings
    of longer words (in bytes), so that an unseen derivation of a seen word counts."""
    def run(col):
        w = T.words(col, lower=True)
        s, e = w.start.copy(), w.end.copy()
        for _ in range(8):
            s += (s < e - 1) & _EDGE[w.data[s]] if len(s) else 0
            e -= (s < e - 1) & _EDGE[w.data[e - 1]] if len(e) else 0
        h, doc = [T._hash_words(w.data, s, e, True)], [w.doc]
        for k in stems:
            at = np.flatnonzero(e - s > k)
            h.append(T.mix(T._hash_words(w.data, s[at], s[at] + k, True) + T.U64(k)))
            doc.append(w.doc[at])
        return _distinct(np.concatenate(h), np.concatenate(doc), w.n_docs, bits)
    return run


def word_ngrams(bits: int = 20) -> Featuriser:
    """Indicators of words, word pairs, word outlines (runs of byte classes with the
    first and last byte), outline pairs, and of repetition of a word within its four predecessors."""
    def run(col):
        w = T.words(col, lower=True)
        n = len(w.hash)
        if not n:
            return np.zeros(0, np.int64), np.zeros(w.n_docs + 1, np.int64)
        cls = _CLASS[w.data]
        has = np.zeros((5, len(cls) + 1), dtype=np.int32)
        for c in range(5):
            np.cumsum(cls == c, out=has[c, 1:])
        shape = np.zeros(n, dtype=T.U64)
        for c in range(5):
            count = has[c][w.end] - has[c][w.start]
            shape = shape * T.U64(4) + np.minimum(count, 3 if c == 3 else 2).astype(T.U64)
        last = np.where(cls[w.end - 1] == 3, w.data[w.end - 1], 0).astype(T.U64)
        shape = T.mix(shape * T.U64(256) + last + T.U64(0xABCDEF12345))
        again = np.zeros(n, dtype=bool)
        for k in range(1, 5):
            if n > k:
                again[k:] |= (w.hash[k:] == w.hash[:-k]) & (w.doc[k:] == w.doc[:-k])
        h2, at2 = w.ngrams(2)
        pair = np.flatnonzero(w.doc[1:] == w.doc[:-1])
        shape2 = T.mix(shape[pair] * T.U64(0x9FB21C651E98DF25) + shape[pair + 1])
        twice = T.mix(again.astype(T.U64) + T.U64(0x5EED))
        h = np.concatenate([w.hash, h2, shape, shape2, twice])
        doc = np.concatenate([w.doc, w.doc[at2], w.doc, w.doc[pair], w.doc])
        return _distinct(T.mix(h), doc, w.n_docs, bits)
    return run


def sample(spark: SparkSession, docs: DataFrame, ids: DataFrame, featuriser: Featuriser) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature runs of the documents in ``ids`` (doc_id, tag; a bounded sample):
    feature numbers, bounds and tags, in the order of the ids."""
    def run(batches):
        for b in T.slices(batches, "text", T.SMALL_SLICE_BYTES):
            x, bounds = featuriser(b.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("tag").cast(pa.int32()), lists], names=["doc_id", "tag", "x"])
    # the sample has a bounded number of ids, so this side is small at any size of docs
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    got = rows.select("doc_id", "tag", "text").mapInArrow(run, "doc_id long, tag int, x array<int>").toArrow()
    got = got.sort_by("doc_id")  # the unsorted rows go
    col = got.column("x").combine_chunks()
    if got.num_rows == 0:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32)
    n = pc.list_value_length(col).to_numpy().astype(np.int64)
    return col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(n)]), got.column("tag").to_numpy()


def bounded_ids(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the ids, those smallest by a hash: the same ids on every run."""
    return rows.withColumn("_o", F.xxhash64("doc_id")).orderBy("_o", "doc_id").limit(most).drop("_o")


def scored(docs: DataFrame, featuriser: Featuriser, weights: np.ndarray, bias: float, mod: int, rest: int, cut: float, keep: list[str] = (), even: bool = False) -> DataFrame:
    """Every row's score from a linear model on the distinct features of its whole text
    (``even``: their sum divided by the root of their number)."""
    weights = weights.astype(np.float32)

    def run(batches):
        for b in T.slices(batches, "text", T.SMALL_SLICE_BYTES):
            x, bounds = featuriser(b.column("text"))
            c = np.concatenate([[0.0], np.cumsum(weights[x], dtype=np.float64)])
            z = c[bounds[1:]] - c[bounds[:-1]]
            z = np.clip((z / np.sqrt(np.maximum(np.diff(bounds), 1)) if even else z) + bias, -40, 40)
            yield pa.RecordBatch.from_arrays([b.column(k) for k in b.schema.names if k != "text" or "text" in keep] + [pa.array(1 / (1 + np.exp(-z)))],
                                             names=[k for k in b.schema.names if k != "text" or "text" in keep] + ["score"])
    cols = list(keep) or ["doc_id"]
    src = docs.select(*cols, *([] if "text" in cols else ["text"]))
    schema = src.select(*cols).schema.add("score", "double")
    out = src.mapInArrow(run, schema)
    held = F.coalesce(fold("doc_id", mod) == rest, F.lit(False))
    return out.withColumn("held_out", held).withColumn("predicted", (F.col("score") >= cut).cast("int"))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return c[bounds[1:]] - c[bounds[:-1]]
