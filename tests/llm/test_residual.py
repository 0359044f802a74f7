"""Rows that the Jaccard join makes for a group of near copies: in proportion to the group, not to its pairs; same components."""

import random

import numpy as np
import pytest

from newsframe.llm import common, jaccard


def copies(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for j in range(n):
        at = set(rng.sample(range(words), edits))
        out.append(" ".join(f"e{j}x{i}" if i in at else w for i, w in enumerate(base)))
    return out


def components_of(texts, num=8, den=10, k=5):
    sets = []
    for t in texts:
        w = t.split(" ")
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    comp = list(range(len(sets)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    linked = [(i, j) for i in range(len(sets)) for j in range(i) if den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    for i, j in linked:
        a, b = sorted((root(i), root(j)))
        comp[b] = a
    return {i: root(i) for i in range(len(sets))}, linked


def run(spark, monkeypatch, texts, **more):
    """Components, and the rows of each written table."""
    made = {}

    def counted(df, name="x"):
        out = common.materialize(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(jaccard, "materialize", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, 5, 8, 10, **more).collect()}, made


def test_linked_copies_make_few_candidates(spark, monkeypatch):
    texts = copies(120, 250, 2, 1)
    want, linked = components_of(texts)
    assert len(linked) > 4_000
    got, made = run(spark, monkeypatch, texts, rounds=0)
    assert got == want
    # before: every linked pair in jac-lx
    assert sum(made.get(x, 0) for x in ("jac-ln", "jac-ld", "jac-x", "jac-lx")) < 8 * len(texts)


def test_copies_just_below_the_threshold_are_tested_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_PER_SET", 1)
    texts = [" ".join(f"e{j}x{i}" if i % 5 == 4 and i // 5 % 16 == j and i < 320 else f"w{i}" for i in range(354)) for j in range(16)]
    texts += [texts[3] + " one more"]
    want, linked = components_of(texts)
    assert linked == [(16, 3)]
    got, made = run(spark, monkeypatch, texts, rounds=0)
    assert got == want and "jac-ld" in made


@pytest.mark.parametrize("most,block", [(0, 3), (0, 4096), (10 ** 9, 3)])
def test_components_equal_brute_force_on_every_route(spark, monkeypatch, most, block):
    monkeypatch.setattr(jaccard, "PAIRS_PER_SET", most)
    texts = [t for s, (words, edits) in enumerate(((40, 1), (90, 2), (200, 5))) for t in copies(10, words, edits, s)]
    want, _ = components_of(texts)
    got, _ = run(spark, monkeypatch, texts, rounds=1, block=block)
    assert got == want


def test_spanning_forest_is_lightest_and_connects():
    rng = np.random.default_rng(1)
    for n, m in ((1, 0), (5, 4), (30, 200), (60, 50)):
        u, v = rng.integers(0, n, m), rng.integers(0, n, m)
        w = rng.integers(0, 6, m).astype(float)  # ties
        e = jaccard.spanning(u, v, w, n)
        label, total = list(range(n)), 0.0
        for i in np.argsort(w, kind="stable"):
            if label[u[i]] != label[v[i]]:
                total += w[i]
                label = [label[v[i]] if x == label[u[i]] else x for x in label]
        assert w[e].sum() == total and len(e) == n - len(set(label))
        tree = jaccard.trees(np.stack([u[e], v[e]]), n)
        assert len({(a, b) for a, b in zip(tree.tolist(), label, strict=True)}) == len(set(label)) == len(set(tree.tolist()))


def test_sieve_keeps_every_row_that_is_listed(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(500)] + [(None, "n")], "id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 500, 7)] + [(0,), (None,)], "id long")
    for words in (common.SIEVE_WORDS, 4):
        monkeypatch.setattr(common, "SIEVE_WORDS", words)
        got = common.sieved(rows, ids, "id", "held").collect()
        assert len(got) == 501 and all(r.held for r in got if r.id is not None and r.id % 7 == 0)
        assert words == 4 or sum(not r.held for r in got) > 400
