"""Memory of the steps that hold whole texts."""

import tracemalloc

import numpy as np
import pyarrow as pa

from newsframe.llm import jaccard as J
from newsframe.llm import textops as T
from newsframe.llm import toxicity
from newsframe.llm.common import batch_rows


def texts(n: int, words: int, seed: int = 3) -> pa.RecordBatch:
    rng = np.random.default_rng(seed)
    rows = [" ".join(f"w{x}" for x in rng.integers(0, 5000, words)) for _ in range(n)]
    rows[n // 2] = rows[0] + " more"
    ids = [*range(n - 1), None]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows)], names=["doc_id", "text"])


def peak(run) -> float:
    """MB that ``run`` allocates at most."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_entries_of_a_slice_hold_keys_only():
    b = texts(4000, 300)
    lv = J.levels(dict.fromkeys(range(60), 3000), 400, 8, 10)
    next(J._entries(5, lv)(iter([b.slice(0, 10)])))
    assert 6e6 < b.column("text").nbytes < 8e6  # one slice
    got = []
    assert peak(lambda: got.extend(J._entries(5, lv)(iter([b])))) < 12 * b.column("text").nbytes / 1e6
    # the slice gives one row for each key, as if its keys were made at once
    some = b.slice(0, 3999)
    key, owner = J.segment_keys(*J.shingles(some.column("text"), 5), lv)
    want = sorted({(int(k), int(d)) for k, d in zip(T.signed(key).to_numpy(), owner, strict=True)})
    rows = [(k, i) for o in got for k, i in zip(o.column("key").to_pylist(), o.column("id").to_pylist(), strict=True)]
    assert len({k for k, _ in rows}) == len(rows)
    rows += [(k, i) for o in got for k, more in zip(o.column("key").to_pylist(), o.column("more").to_pylist(), strict=True) for i in more or []]
    assert sorted(rows) == want


def test_telling_holds_little_beside_the_sample():
    rng = np.random.default_rng(5)
    size = rng.integers(0, 700, 8000)
    bounds = np.concatenate([[0], np.cumsum(size)])
    x = rng.integers(0, 1 << 16, bounds[-1]).astype(np.int32)
    positive = np.arange(8000) % 3 == 0
    x[np.repeat(positive, size) & (rng.random(len(x)) < 0.1)] = 77
    got = []
    assert peak(lambda: got.extend(toxicity.telling(x, bounds, positive, 1 << 16))) < 2 * x.nbytes / 1e6
    row = np.repeat(positive, size)
    p, u = np.bincount(x[row], minlength=1 << 16), np.bincount(x[~row], minlength=1 << 16)
    n, m = positive.sum(), (~positive).sum()
    e, f = (p + u) * (n / (n + m)), (p + u) * (m / (n + m))
    with np.errstate(divide="ignore", invalid="ignore"):
        stat = 2 * (np.where(p > 0, p * np.log(p / e), 0) + np.where(u > 0, u * np.log(u / f), 0))
    keep = (stat >= 14)[x]
    assert (got[0] == x[keep]).all() and 77 in got[0]
    assert (got[1] == np.concatenate([[0], np.cumsum(keep)])[bounds]).all()


def test_batches_are_bounded_and_the_setting_comes_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def largest():
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
        return spark.range(0, 9000, 1, 1).mapInArrow(run, "n long").toPandas()["n"].max()
    was = spark.conf.get(name, None)
    try:
        for before in ("10000", "0", "100"):
            spark.conf.set(name, before)
            with batch_rows(spark, J.BATCH_ROWS):
                assert largest() == (100 if before == "100" else J.BATCH_ROWS)
            assert spark.conf.get(name) == before
        spark.conf.unset(name)
        with batch_rows(spark, 50):
            assert largest() == 50
        assert spark.conf.get(name, None) is None
    finally:
        if was is not None:
            spark.conf.set(name, was)
