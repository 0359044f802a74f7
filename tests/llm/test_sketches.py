"""Sketches that keep unlinked pairs from the exact test of the Jaccard join, and keys that hold the same sets."""

import random

import numpy as np
import pyarrow as pa

from newsframe.llm import jaccard
from newsframe.llm import textops as T


def edited(words, every, seed):
    rng = random.Random(seed)
    at = set(rng.sample(range(len(words)), len(words) // every))
    return " ".join(f"e{seed}x{i}" if i in at else w for i, w in enumerate(words))


def passed(texts):
    """Pairs of one key that reach the exact test, and the linked ones."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sets = list(jaccard._sets(5)([batch]))
    rows = pa.Table.from_batches(sets)
    zero, one = pa.array([0] * len(texts), pa.int32()), pa.array([1] * len(texts), pa.int64())
    run = pa.RecordBatch.from_arrays([one, zero, zero, zero, *[c.combine_chunks() for c in (rows["id"], rows["id"], rows["n"], rows["sketch"])]],
                                     names=["key", "bi", "bj", "blk", "id", "comp", "n", "sketch"])
    got = {(a, b) for out in jaccard._cross_pairs(8, 10)([run.slice(0, 7), run.slice(7)]) for a, b in zip(*[c.to_pylist() for c in out.columns])}
    toks = [set(x) for x in rows["toks"].to_pylist()]
    linked = {(i, j) for i in range(len(toks)) for j in range(i) if 10 * len(toks[i] & toks[j]) >= 8 * len(toks[i] | toks[j])}
    return got, {(j, i) for i, j in linked}


def test_unlinked_copies_of_an_absent_text_reach_no_exact_test():
    for n in (300, 1_500, 6_000):
        words = [f"w{i}" for i in range(n)]
        got, linked = passed([edited(words, 20, s) for s in range(1, 25)])  # similarity about 0.6
        assert not linked and not got  # before: all 276 pairs of the longer texts


def test_linked_pairs_of_all_sizes_pass():
    texts = [edited([f"w{i}" for i in range(n)], every, s) for n in (8, 100, 700, 900, 1_100, 5_000) for s, every in enumerate((60, 70, 90, 120), 1)]
    texts += [" ".join(f"w{i}" for i in range(n)) for n in (900, 1_000, 1_030, 1_100, 20_000, 22_000)]  # sketches of two lengths
    got, linked = passed(texts)
    assert len(linked) > 20 and linked <= got


def test_folded_sketch_is_the_shorter_sketch_and_bounds_the_difference():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 5_000).astype(T.U64)
    sizes = (0, 1, 40, 900, 1_100, 5_000)
    sets = [np.sort(base[:n]) for n in sizes]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    words, at = jaccard.sketches(np.concatenate(sets), bounds)
    each = [words[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
    assert [len(x) // 8 for x in each] == jaccard.sketch_words(np.array(sizes)).tolist()
    for i, x in enumerate(each):
        for j, y in enumerate(each):
            w = min(len(x), len(y)) // 8
            gap = int(np.bitwise_count(jaccard._folded(x, w) ^ jaccard._folded(y, w)).sum())
            differ = abs(sizes[i] - sizes[j])
            assert gap <= differ and gap % 2 == differ % 2


def test_one_of_the_keys_that_hold_the_same_sets_is_tested(spark, monkeypatch):
    def rows_of(num, den):
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("id")], names=["a", "b"])
        return run
    monkeypatch.setattr(jaccard, "_cross_pairs", rows_of)
    members = [(k, i) for k in range(30) for i in (1, 2)] + [(40, i) for i in (1, 2, 3)] + [(41, i) for i in (1, 3)] + [(50, 4), (50, 5)]
    members = spark.createDataFrame(members, "key long, id long")
    comp = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4)], "id long, comp long")  # 4 and 5 are connected
    sets = spark.createDataFrame([(i, 9, b"\0" * 64) for i in range(1, 6)], "id long, n long, sketch binary")
    got = sorted(tuple(r) for r in jaccard._residual(members, comp, sets, 8, 10, 4).collect())
    assert got == [(0, 1), (0, 2), (40, 1), (40, 2), (40, 3), (41, 1), (41, 3)]
