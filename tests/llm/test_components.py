"""Connected components: any shape in few rounds, equal to a plain union of sets."""

import random

from newsframe.llm import common


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in list(root))


def found(spark, links):
    out = common.components(spark.createDataFrame(links, "a long, b long"))
    return sorted((r.id, r.comp) for r in out.collect())


def test_a_long_path_needs_few_steps(spark, monkeypatch):
    written = []
    keep = common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, name: written.append(name) or keep(df, name))
    n = 5_000
    assert found(spark, [(i, i + 1) for i in range(n)]) == [(i, 0) for i in range(n + 1)]
    assert len(written) <= 17  # 13 doublings, one step that moves nothing, the links before and after


def test_shapes(spark):
    rng = random.Random(3)
    ids = rng.sample(range(1, 10_000), 400)
    path = list(zip(ids, ids[1:]))                                     # a path in random order of ids
    star = [(20_000, i) for i in range(30_000, 30_040)] + [(50_000, i) for i in range(40_000, 40_040)]  # a small and a large centre
    some = [(rng.randrange(60_000, 60_300), rng.randrange(60_000, 60_300)) for _ in range(250)]
    odd = [(7, 7), (None, 3), (3, None), (70_001, 70_000), (70_000, 70_001), (70_001, 70_000), (-5, 70_001)]
    links = path + star + some + odd
    rng.shuffle(links)
    assert found(spark, links) == brute(links)
    assert found(spark, []) == [] and found(spark, [(7, 7), (None, None)]) == []
