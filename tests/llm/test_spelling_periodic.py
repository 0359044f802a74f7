"""Spelling variants and periodic runs against plain-Python brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from newsframe.llm import periodic, spelling
from newsframe.llm import queries as Q

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, word string, n string, m string, start string, length string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, given):
    return spark.createDataFrame([(i, t, "w", "n", "m", "s", "l") for i, t in given], EXTRA)


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


# -- spelling ---------------------------------------------------------------

def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    p = 0
    while p < len(b) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == (b[p + 1:] if len(a) == len(b) else b[p:])


def brute_spelling(given, plant=True):
    counts = Counter()
    for i, t in given:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            if plant and i is not None and (h := zlib.crc32(f"{i}:{run}".encode())) % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        about = [x for x in words if near(w, x)]
        best = min(about, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = (form, n, len(about), words[form] if form else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return sorted(((w, f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items()), key=str)


def odd_texts():
    chain = " ".join(w + " " for w, n in (("chainaa", 5), ("chainab", 25), ("chainbb", 125), ("chaibbb", 625)) for _ in range(n))
    ties = "tieword " * 5 + "tiewora " * 30 + "tieworb " * 30 + "tieworz " * 30
    return [(None, "Hello wörld Éclair ×÷abcd " * 20), (5, None), (6, ""), (7, "abcdefgh abcdefgx abcdefg abcdefghi " * 6 + "ABCDEFGH " * 60),
            (7, "abcdefgh abcdefgx " * 3), (8, "x" * 5000), (9, ("y" * 300 + " " + "y" * 301 + " ") * 5), (10, "aaaaaa aaaaaaa aaaaaaaa " * 7), (11, chain), (12, ties),
            (13, "a1b2 Ābcdefg bcdefgĀ " * 9)]


@pytest.mark.parametrize("block", [1 << 14, 64])
def test_spelling_equals_brute_force(spark, block, monkeypatch):
    given = documents() + odd_texts()
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (block,))
    monkeypatch.setattr(spelling, "AT_ONCE", 1000 if block == 64 else 1 << 22)
    got = spelling.spelling_groups(frame(spark, given), plant=True)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == brute_spelling(given)
    assert {r[2] for r in got if r[0].startswith("chai")} == {"chaibbb"}
    assert {r[1] for r in got if r[0] == "tieword"} == {"tiewora"}


def test_spelling_query_and_empty_table(spark):
    got = sorted((tuple(r) for r in Q.op12_spelling_variants(spark, SF).collect()), key=str)
    assert got == brute_spelling(documents())
    assert spelling.spelling_groups(frame(spark, [])).collect() == []


def test_vectorised_crc32():
    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    states = np.array([zlib.crc32(str(k).encode()) for k in range(200)], np.uint32)
    assert spelling.crc32s(states, data, begin, size).tolist() == [zlib.crc32(str(k).encode() + p) for k, p in enumerate(parts)]


# -- periodic runs ----------------------------------------------------------

def brute_runs(words, least=12):
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_report(i, text, plant=True):
    words = WORD.findall(text or "")
    n = len(words)
    if plant and i is not None and n and (h := zlib.crc32(str(i).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
    runs = brute_runs(words)
    gone = {k for s, l, q in runs for k in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (i, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            k, m = rng.choice([1, 2, 3, 5]), rng.randint(0, 70)
            w = [rng.randrange(k) for _ in range(m)]
            if rng.random() < .5 and m:
                a, p = rng.randrange(m), rng.randint(1, 9)
                w = w[:a] + [w[a + (i - a) % min(p, m - a)] for i in range(a, m)]
            docs.append(w)
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs]).astype(np.int64)
        first = np.cumsum([0] + [len(d) for d in docs])
        for least in (12, 5):
            want = [[s + int(first[i]), l, q] for i, d in enumerate(docs) for s, l, q in brute_runs(d, least)]
            got = periodic.find_runs(doc, np.array([x for d in docs for x in d], dtype=np.int64), least).tolist()
            assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_many_lists_of_left_words(monkeypatch):
    rng = random.Random(5)
    words = []
    for k in range(30):
        words += [100 + k] + [1] * rng.randint(3, 40)
    monkeypatch.setattr(periodic, "FEW_LISTS", 2)
    got = periodic.find_runs(np.zeros(len(words), np.int64), np.array(words)).tolist()
    assert got == [list(r) for r in sorted(brute_runs(words), key=lambda r: (r[0], r[2]))]


def test_long_texts_of_one_word_and_of_fibonacci_words():
    n = 300_000
    assert periodic.find_runs(np.zeros(n, np.int64), np.zeros(n, np.int64)).tolist() == [[0, n, 1]]
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert periodic.find_runs(np.zeros(len(b), np.int64), np.array(b)).tolist() == [list(r) for r in sorted(brute_runs(b), key=lambda r: (r[0], r[2]))]


def test_report_of_odd_texts(spark, monkeypatch):
    line = " ".join(f"w{k}" for k in range(7))
    given = [(i, " ".join([line] * 5) + " tail") for i in range(40)] + [(None, "a " * 30), (3, None), (4, ""), (5, " \t\n"), (6, "a b c 　 " * 9), (6, "x\x00y " * 20),
             (50, "  a\nb\r\n" * 20 + "c"), (51, "é\U0001F600 " * 13 + "z" * 20000 + " z" * 13)]
    want = sorted((brute_report(i, t) for i, t in given), key=str)
    for most in (64, 4 << 20):
        monkeypatch.setattr(periodic.T.slices, "__defaults__", (most,))
        got = periodic.run_report(frame(spark, given), plant=True).drop("n_words", "n_kept").collect()
        assert sorted((tuple(r) for r in got), key=str) == want
    runs = periodic.runs_of(frame(spark, given))
    assert sorted(((r.doc_id, r.start, r.length, r.period) for r in runs.collect()), key=str) == \
        sorted(((i, *r) for i, t in given for r in brute_runs(WORD.findall(t or ""))), key=str)
    assert periodic.run_report(frame(spark, []), plant=True).collect() == []


def test_runs_query_equals_brute_force(spark):
    got = sorted((tuple(r) for r in Q.op13_periodic_runs(spark, SF).collect()), key=str)
    assert got == sorted((brute_report(i, t) for i, t in documents()), key=str)
