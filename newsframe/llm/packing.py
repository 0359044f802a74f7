"""Cost-balanced packing of documents into training sequences (operator 10).

A piece of l tokens costs ``linear * l + quadratic * l * l`` (projections and feed-forward
grow with the tokens, attention inside a document with their square). Within a
task, documents are taken in descending order of cost; each goes to the sequence
with the lowest cost so far that has room for it. When none has, the document is cut:
its beginning fills the sequence with the most room and the rest is packed on.
A document longer than a sequence is cut into full sequences first.

A task opens as many full sequences as its tokens fill, and powers of two for
the remainder, which need no padding either; only a remainder below ``least`` is
padded. Tasks pack runs of about ``group`` tokens from their own input split, without
a shuffle: sequence ids combine the split's number with a counter, so a task that is run
again gives the same rows. Nothing depends on a key, so no key can be hot.

Defined results: a null or empty text is one piece holding only the end id; rows with a
null ``doc_id`` are packed like others; repeated rows are packed each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.tokens import default_path, forget_ids, text_ids

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, sequence_cost double")


def plan(lengths: np.ndarray, room: int = 1024, linear: float = 1.0, quadratic: float = 1 / 1024, least: int = 1):
    """Pack documents of the given token counts: rows (document, start, length,
    sequence, offset) as arrays, and each sequence's capacity."""
    total = int(lengths.sum())
    caps = [room] * (total // room)
    rest = total % room
    while rest >= least:
        caps.append(1 << (rest.bit_length() - 1))
        rest -= caps[-1]
    if rest:
        caps.append(room)
    caps = np.array(caps, dtype=np.int64)
    free, cost = caps.copy(), np.zeros(len(caps))
    rows: list[tuple[int, int, int, int, int]] = []
    fresh = deque(range(total // room))

    def put(doc, start, n, seq):
        rows.append((doc, start, n, seq, int(caps[seq] - free[seq])))
        free[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    whole = lengths // room
    for doc in np.flatnonzero(whole):
        for j in range(int(whole[doc])):
            put(int(doc), j * room, room, fresh.popleft())
    todo = deque(sorted(((int(lengths[d] % room), int(d), int(whole[d]) * room) for d in range(len(lengths)) if lengths[d] % room), key=lambda x: (-x[0], x[1])))
    while todo:
        n, doc, start = todo.popleft()
        fits = np.flatnonzero(free >= n)
        if len(fits):
            put(doc, start, n, int(fits[np.argmin(cost[fits])]))
            continue
        seq = int(np.argmax(free))
        part = int(free[seq])
        put(doc, start, part, seq)
        left = (n - part, doc, start + part)
        at = next((i for i, x in enumerate(todo) if x[0] <= left[0]), len(todo))
        todo.insert(at, left)
    return np.array(rows, dtype=np.int64).reshape(-1, 5), caps, cost


def _pack(path: str, room: int, end_id: int, group: int, linear: float, quadratic: float):
    def run(batches):
        task = TaskContext.get()
        seq_base = (task.partitionId() if task else 0) << 36
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            nonlocal seq_base
            docs = [d for h in held for d in h[0]]
            ids = np.concatenate([h[1] for h in held])
            n = np.concatenate([h[2] for h in held])
            first = np.cumsum(n) - n
            rows, caps, cost = plan(n, room, linear, quadratic)
            used = np.bincount(rows[:, 3], weights=rows[:, 2], minlength=len(caps)).astype(np.int64)
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip((first[rows[:, 0]] + rows[:, 1]).tolist(), (first[rows[:, 0]] + rows[:, 1] + rows[:, 2]).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([docs[i] for i in rows[:, 0]], pa.int64()), pa.array(rows[:, 1]), pa.array(rows[:, 2]), pa.array(crc, pa.int64()),
                 pa.array(n[rows[:, 0]]), pa.array(rows[:, 3] + seq_base), pa.array(rows[:, 4]), pa.array(used[rows[:, 3]]), pa.array(cost[rows[:, 3]])],
                names=[x.split()[0] for x in SCHEMA.split(", ")])
            seq_base += len(caps)
            held.clear()

        for b in T.slices(batches, "text", 2 << 20):
            ids, n = text_ids(b.column("text"), path)
            out = np.full(len(ids) + len(n), end_id, dtype=np.uint32)
            keep = np.ones(len(out), dtype=bool)
            keep[np.cumsum(n + 1) - 1] = False
            out[keep] = ids
            held.append((b.column("doc_id").cast(pa.int64()).to_pylist(), out, n + 1))
            size += len(out)
            if size >= group:
                yield from flush()
                size = 0
        if held:
            yield from flush()
        forget_ids()
    return run


def pack(docs: DataFrame, room: int = 1024, tokenizer: str | None = None, end_id: int = 0, group: int = 1 << 20,
         linear: float = 1.0, quadratic: float = 1 / 1024) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text); columns as in ``SCHEMA``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pack(tokenizer or default_path(), room, end_id, group, linear, quadratic), SCHEMA)
