"""Cases in which an operator once did less than its whole job."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newsframe.llm import decontaminate, lm, secrets
from newsframe.llm import textops as T

TABLE = "doc_id long, text string"


def align(a, b):
    """Smith-Waterman score of two word lists over twice the first one's length."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h)) / (2 * len(a))


def test_edited_copies_are_found_with_and_without_a_verbatim_one(spark):
    cases = [(p, f, v) for p in (6, 7, 8, 9) for f in (0, 2, 4) for v in (False, True)]
    items = [[f"i{k}w{j}" for j in range(24)] for k in range(len(cases))]
    docs = []
    for k, (period, phase, verbatim) in enumerate(cases):
        copy = [f"e{k}x{j}" if j % period == phase else w for j, w in enumerate(items[k])]
        docs.append([*(f"a{k}w{j}" for j in range(30)), *copy, *(f"b{k}w{j}" for j in range(30))])
        if verbatim:
            docs.append(items[k])
    rows = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], TABLE)
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    want = {(i, k): round(s, 9) for i, d in enumerate(docs) for k, x in enumerate(items) if set(d) & set(x) and (s := align(x, d)) >= 0.5}
    assert len(want) == len(docs)
    got = decontaminate.contaminated(rows, bench).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == want
    assert decontaminate.clean(rows, bench).count() == 0


def test_words_behind_a_long_word_have_their_hash(monkeypatch):
    empty = np.empty
    monkeypatch.setattr(np, "empty", lambda shape, dtype=float: np.full(shape, 7, dtype) if dtype == T.U64 else empty(shape, dtype))  # no lucky memory
    tail = [f"tail{i}" for i in range(50)]
    lone = T.words(pa.array([" ".join(tail)]), lower=True).hash
    for head in (["Q" * 5000], ["Q" * 5000, "z" * 4097], ["pad"] * (T.BLOCK // 4 - 600) + ["Q" * 5000], ["y" * (T.BLOCK + 9)], ["Q" * T.BLOCK]):
        w = T.words(pa.array([" ".join(head + tail), " ".join(tail)]), lower=True)
        assert (w.hash[len(head):len(head) + 50] == lone).all() and (w.hash[len(head) + 50:] == lone).all()
        by_word = [T.words(pa.array([x]), lower=True).hash[0] for x in head[-2:]]
        assert w.hash[:len(head)][-2:].tolist() == by_word


def test_every_training_document_is_learnt_from(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % lm.MOD != lm.REST]
    rows = spark.createDataFrame([(i, f"word{i} sat on the mat " * 9) for i in ids], TABLE)
    for warm in (0, 7):  # by the round alone, and behind a start that most documents take no part in
        before, after = ({r.doc_id: r.score for r in lm.lm_scores(rows, rounds=n, warm=warm).collect()} for n in (0, 2))
        assert all(after[i] > before[i] + 0.1 for i in ids)


def test_starting_weights_and_round_lower_the_held_out_loss(spark):
    rng = np.random.default_rng(3)
    chain = [f"{a}{b}" for a in ("red", "green", "blue", "dark") for b in ("house", "tree", "salt", "river", "stone")]
    rows = spark.createDataFrame([(i, " ".join(chain[(k + j) % 20] for j in range(40))) for i, k in enumerate(rng.integers(0, 20, 600).tolist())], TABLE).repartition(4)
    loss = [-lm.lm_scores(rows, rounds=n, warm=k).filter("held_out").agg(F.sum("score")).first()[0] for n, k in ((0, 0), (1, 0), (1, 200))]
    assert loss[2] < loss[1] < loss[0]


def test_order_of_ids_of_one_class_counts(spark):
    words = [["red", "green", "blue", "salt", "tree", "house"][k:] + ["red", "green", "blue", "salt", "tree", "house"][:k] for k in range(6)]
    rows = spark.createDataFrame([(i, " ".join(words[i % 6])) for i in range(30)], TABLE)
    got = {r.doc_id: r.score for r in lm.lm_scores(rows).collect()}
    assert len({round(got[i], 6) for i in range(6)}) == 6 and all(abs(got[i] - got[i + 6]) < 1e-6 for i in range(6))


def test_long_tokens_and_environment_files_are_linked(spark):
    long = "eyJhbGciOiJIUzI1NiJ9." + "aB3" * 200
    texts = [f"user=bob host=db.example.com {long}", f"DB_USER=bob\nDB_HOST=db.example.com\nKEY {long[:129]}",
             "Username: bob, Server: db.example.com, Zx9abcdefGHIJ12345678", "user=bob host=db.example.com " + "z" * 60 + " " + "Z1" * 60]
    want = []
    for t, parts in zip(texts, (("user=bob", "host=db.example.com", long), ("USER=bob", "HOST=db.example.com", long[:129]),
                                ("Username: bob", "Server: db.example.com", "Zx9abcdefGHIJ12345678"), ()), strict=True):
        want.append(",".join(f"{k}:{t.index(x)}:{t.index(x) + len(x)}" for k, x in zip(("account", "endpoint", "weak"), parts)))
    got = {r.doc_id: r.spans for r in secrets.secret_report(spark.createDataFrame(list(enumerate(texts)), TABLE)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_only_members_of_complete_triples_are_linked(spark):
    import random

    rng = random.Random(12)
    scope, rows = 60, []
    for rid in range(1000):
        at = 0
        for _ in range(rng.randint(0, 9)):
            start = at + rng.choice([0, 5, 20, 40, 59, 60, 61, 70, 200])
            at = start + rng.choice([1, 3, 20, 130])
            role = rng.choice(["id", "secret", "end"])
            rows.append((rid, f"k{role}", role, start, at))
        rows.extend((rid, "kend", "end", s, s + 4) for s in (rng.randint(0, 300),) if rng.random() < .3)
    rows = sorted(set(rows))
    got = secrets.linked(spark.createDataFrame(rows, "rid long, kind string, role string, start long, end long"), scope).collect()
    want, by_text = set(), {}
    for r in rows:
        by_text.setdefault(r[0], []).append(r)
    for parts in by_text.values():
        roles = [[p for p in parts if p[2] == role] for role in ("id", "secret", "end")]
        for a in roles[0]:
            for b in roles[1]:
                for c in roles[2]:
                    if all(x[3] - y[4] <= scope and y[3] - x[4] <= scope for x, y in ((a, b), (a, c), (b, c))):
                        want |= {a, b, c}
    assert len(got) == len(want) > 200 and {tuple(r) for r in got} == want


def test_a_secret_whose_identifier_is_out_of_scope_of_its_endpoint(spark):
    secret = "Ab3" * 7
    text = f"{secret} {'x' * 150} user=bob {'y' * 150} host=db1 {'z' * 150} {secret} {'v' * 150} login=amy"
    got = secrets.secret_report(spark.createDataFrame([(1, text)], TABLE)).first()
    assert got.spans == ""
    near = secrets.secret_report(spark.createDataFrame([(1, f"{secret} user=bob host=db1")], TABLE)).first()
    assert [s.split(":")[0] for s in near.spans.split(",")] == ["weak", "account", "endpoint"]


def test_positions_that_an_earlier_window_scores_are_not_computed_again(monkeypatch):
    rng = np.random.default_rng(4)
    cl = lm.classes(rng.integers(0, 50, lm.END + 1).astype(float), 8)
    w = lm.start_weights(8, 8, 16, of=cl.of)
    size = [1, 2, 15, 16, 17, 24, 25, 400]
    bounds = np.concatenate([[0], np.cumsum(size)])
    ids = rng.integers(0, lm.END, bounds[-1])
    rows, keep = [], lm.forward

    def counted(w, c, *a, **k):
        out = keep(w, c, *a, **k)
        rows.append(out[0].size // cl.n)
        return out
    monkeypatch.setattr(lm, "forward", counted)
    got = lm.log_probs(w, cl, ids, bounds, 16, 4, batch=7)
    n = len(lm.windows(bounds, 16, 4)[0])
    assert sum(rows) == 16 * len(size) + 12 * (n - len(size))  # before: 16 * n
    for i, total in enumerate(got):
        text = ids[bounds[i]:bounds[i + 1]]
        want = cl.logp[text].sum()
        for at in range(len(text)):
            k = 0 if at < 16 else (at - 4) // 12
            before = np.concatenate([[lm.END], text])[12 * k:at + 1]
            z = keep(w, np.append(before, np.zeros(16 - len(before), np.int64))[None])[0].reshape(-1, cl.n)[len(before) - 1]
            want += z[cl.of[text[at]]] - np.log(np.exp(z).sum())
        assert abs(total - want) < 1e-3 * max(1, len(text) / 20)
