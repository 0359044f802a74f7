"""Scores of texts under a causal self-attention model on subword ids (operator 6).

Words are lower-cased and split by a public byte-level vocabulary; a text ends with an end
id. The probability of an id is factored into its class and the id within the class:
classes are runs of ids by corpus frequency with about equal mass, ``p(id | class)`` comes from
corpus counts, and ``p(class | ids before)`` from one layer of masked self-attention over the
embeddings of the ids themselves, with a bias by distance, trained in numpy by stochastic gradient steps.

The corpus is used as a whole: word and subword counts come from every training document, and
the steps run where the documents are, in rounds that each pass over every training document. One task first
trains common starting weights on ``warm`` documents (the smallest by hash of the id): tasks that leave from random
weights end too far apart to be averaged. Each task starts from the round's weights, and the
tasks' weights are averaged by Spark, an id's embedding weighted with the places where the task read it, all others
with the windows it saw; one row for each id met and some dozens of others reach the driver. A text is scored in windows of ``span`` ids that overlap by ``lap``: every id is scored once, by the
first window that holds it, with at least ``lap`` ids before it (fewer only at the text's beginning).

The base score needs each word's corpus count. Words with more than a ``1 / most_common`` share of
the training tokens (at most ``most_common`` of them, whatever the corpus) are looked up in
the scoring task; the rest meets the counts in a join, summed per document.

Defined results: null and empty texts hold only the end token; rows with a null ``doc_id``
are learnt from like others (their fold is that of no id) and scored; repeated rows count and come back each;
without training documents N and V are 0, the class model is uniform and every score is finite; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import fold, materialize, release
from newsframe.llm.tokens import default_path, id_table

MOD, REST = 7, 2
END = 50256


def words_and_ids(col: pa.Array, path: str):
    """Word hashes (T.Words), and for each word its slot in the task's table of subword ids."""
    w = T.words(col, lower=True)
    table = id_table(path)
    raw = w.data.tobytes()
    low = bytes(T._LOWER.tolist())
    slots = table.look(T.mix(w.hash + T.U64(0x77)), lambda i: b" " + raw[w.start[i]:w.end[i]].translate(low)) if len(w.hash) else np.zeros(0, np.int64)
    return w, table, slots


def id_stream(w: T.Words, table, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each text ended by END, and the n + 1 bounds."""
    ids, n = table.expand(slots) if len(slots) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    per = np.diff(np.concatenate([[0], np.cumsum(n)])[w.first])
    bounds = np.concatenate([[0], np.cumsum(per + 1)])
    out = np.full(int(bounds[-1]), END, dtype=np.int64)
    keep = np.ones(len(out), dtype=bool)
    keep[bounds[1:] - 1] = False
    out[keep] = ids
    return out, bounds


@dataclass
class Classes:
    of: np.ndarray      # class of each id
    logp: np.ndarray    # log p(id | class)
    n: int


def classes(counts: np.ndarray, n: int) -> Classes:
    order = np.argsort(-counts, kind="stable")
    c = counts[order] + 1.0
    mass = np.cumsum(c) - c / 2
    rank = np.minimum((mass / c.sum() * n).astype(np.int64), n - 1)
    of = np.empty(len(counts), dtype=np.int64)
    of[order] = rank
    total = np.bincount(of, weights=counts + 1.0, minlength=n)
    return Classes(of.astype(np.int32), np.log((counts + 1.0) / total[of]), n)


def start_weights(n: int, d: int, span: int, seed: int = 5, of: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Random weights; with ``of`` (the class of each id) an embedding for each id, near that of its class."""
    rng = np.random.default_rng(seed)
    shapes = {"e": (n, d), "q": (d, d), "k": (d, d), "v": (d, d), "u": (d, n)}
    w = {k: rng.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
    if of is not None:
        w["e"] = w["e"][of] + rng.normal(0, 0.05, (len(of), d)).astype(np.float32)
    return w | {"r": np.zeros(span, np.float32), "b": np.zeros(n, np.float32)}


def _mask(r: np.ndarray, span: int) -> np.ndarray:
    """exp(bias) by distance, 0 above the diagonal."""
    i, j = np.indices((span, span))
    return np.where(i >= j, np.exp(r[np.maximum(i - j, 0)]), 0).astype(np.float32)


def forward(w: dict[str, np.ndarray], c: np.ndarray, keep: bool = False, skip: int = 0):
    """Unnormalised log probabilities (B, span - skip, n) of the next class after each position but the first ``skip``
    of the input windows ``c`` (B, span; rows of ``e``), and what the backward pass needs."""
    b, span = c.shape
    d = w["e"].shape[1]
    x = w["e"][c]
    qk = (w["q"] @ w["k"].T / np.sqrt(d)).astype(np.float32)
    xt = np.ascontiguousarray(x.transpose(0, 2, 1))
    own = x[:, skip:]
    s = np.matmul(own @ qk, xt)
    np.clip(s, -20, 20, out=s)
    np.exp(s, out=s)
    s *= _mask(w["r"], span)[skip:]
    norm = s @ np.ones((span, 1), s.dtype)
    y = np.matmul(s, x) / norm
    h = own + y @ w["v"]
    z = h.reshape(-1, d) @ w["u"] + w["b"]
    return z, (x, xt, s, norm, y, h) if keep else None


def gradients(w, c, target, valid):
    """Mean loss over the valid positions, and its gradients."""
    b, span = c.shape
    d = w["e"].shape[1]
    z, (x, xt, s, norm, y, h) = forward(w, c, True)
    np.minimum(z, 60, out=z)  # exp stays finite
    p = np.exp(z)
    total = p @ np.ones((p.shape[1], 1), p.dtype)
    t, ok = target.reshape(-1), valid.reshape(-1)
    m = max(int(ok.sum()), 1)
    rows = np.arange(len(t))
    loss = -((z[rows, t] - np.log(total[:, 0])) * ok).sum() / m
    part = (ok / m).astype(np.float32)
    p *= part[:, None] / total
    p[rows, t] -= part
    g = {"u": h.reshape(-1, d).T @ p, "b": p.sum(axis=0)}
    dh = (p @ w["u"].T).reshape(b, span, d)
    g["v"] = y.reshape(-1, d).T @ dh.reshape(-1, d)
    dy = dh @ w["v"].T
    a = s * (1 / norm)
    da = np.matmul(dy, xt)
    ds = a * (da - (a * da) @ np.ones((span, 1), a.dtype))
    scale = np.float32(1 / np.sqrt(d))  # a wider scalar would widen all that follows
    qk = w["q"] @ w["k"].T * scale
    left = np.matmul(ds, x)            # sum over keys
    dx = dh + np.matmul(a.transpose(0, 2, 1), dy) + left @ qk.T + np.matmul(ds.transpose(0, 2, 1), x) @ qk
    dqk = x.reshape(-1, d).T @ left.reshape(-1, d) * scale
    g["q"], g["k"] = dqk @ w["k"], dqk.T @ w["q"]
    flat = ds.sum(axis=0)
    g["r"] = np.array([np.trace(flat, -k) for k in range(span)], dtype=np.float32)
    place = c.reshape(-1, 1) * d + np.arange(d)
    g["e"] = np.bincount(place.reshape(-1), dx.reshape(-1), w["e"].size).reshape(w["e"].shape).astype(w["e"].dtype)
    return float(loss), g


def windows(bounds: np.ndarray, span: int, lap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: the stream place of its first target, its text's end, and how many of
    its first targets an earlier window scores."""
    size = np.diff(bounds)
    step = span - lap
    n = np.where(size > 0, 1 + np.maximum(0, -(-(size - span) // step)), 0)
    ends = np.cumsum(n)
    k = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
    return np.repeat(bounds[:-1], n) + k * step, np.repeat(bounds[1:], n), np.where(k > 0, lap, 0)


def _gather(ids: np.ndarray, cls: np.ndarray, start, stop, skip, first, span: int):
    """Windows: inputs (the id before each target), target classes and which to score."""
    at = start[:, None] + np.arange(span)
    valid = (at < stop[:, None]) & (np.arange(span) >= skip[:, None])
    at = np.minimum(at, len(ids) - 1)
    before = ids[np.maximum(at - 1, 0)]
    before[start == first, 0] = END
    return before, cls[at], valid


def log_probs(w, cl: Classes, ids: np.ndarray, bounds: np.ndarray, span: int, lap: int, batch: int = 512) -> np.ndarray:
    """Natural log probability of each text: all its ids, the end id included."""
    cls = cl.of[ids]
    per = np.add.reduceat(cl.logp[ids], bounds[:-1]) if len(ids) else np.zeros(len(bounds) - 1)
    start, stop, skip = windows(bounds, span, lap)
    doc = np.searchsorted(bounds, start, side="right") - 1
    # windows behind the first of a text leave out the positions that an earlier one scores
    for lead in sorted({0, lap}):
        of = np.flatnonzero(skip == lead)
        for i in range(0, len(of), batch):
            j = of[i:i + batch]
            c, t, ok = _gather(ids, cls, start[j], stop[j], skip[j], bounds[doc[j]], span)
            z, _ = forward(w, c, skip=lead)
            t, ok = t[:, lead:], ok[:, lead:]
            hit = z.reshape(-1)[np.arange(0, z.size, cl.n) + t.reshape(-1)]
            np.exp(z, out=z)
            lp = (hit - np.log(z @ np.ones(cl.n, np.float32))).reshape(t.shape)
            np.add.at(per, doc[j], (lp * ok).sum(axis=1, dtype=np.float64))
    return per


def _counts(path: str):
    """(kind, key, n): kind 0 word hashes, 1 subword ids, 2 the tokens of a slice's texts."""
    def run(batches):
        for b in T.slices(batches, "text", 2 * T.SLICE_BYTES):
            w, table, slots = words_and_ids(b.column("text"), path)
            n = np.bincount(slots)
            met = np.flatnonzero(n)
            of_slot = np.zeros(len(n), dtype=T.U64)
            of_slot[slots] = w.hash
            uniq, n = of_slot[met], n[met]
            ids, k = table.expand(met) if len(met) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            sub = np.bincount(ids.astype(np.int64), weights=np.repeat(n, k).astype(float), minlength=END + 1).astype(np.int64)
            sub[END] += w.n_docs
            at = np.flatnonzero(sub)
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(len(uniq), np.int8), np.ones(len(at), np.int8), [np.int8(2)]])),
                 pa.array(np.concatenate([uniq.view(np.int64), at, [0]])), pa.array(np.concatenate([n, sub[at], [len(w.hash) + w.n_docs]]).astype(np.int64))],
                names=["kind", "key", "n"])
            for i in range(0, out.num_rows, 1 << 17):
                yield out.slice(i, 1 << 17)
    return run


def _train(path: str, cl: Classes, w0: dict[str, np.ndarray], span: int, rate: float, batch: int = 256):
    """(at, n, v0, v1, ...) of the rows of weights after one task's steps: embeddings of the ids it read, then the others."""
    def run(batches):
        w = {k: v.copy() for k, v in w0.items()}
        g2 = {k: np.full_like(v, 1e-6 if k == "e" else 1e-3) for k, v in w.items()}
        read, seen = np.zeros(len(w["e"]), dtype=np.int64), 0
        here, row = np.zeros(len(read), dtype=bool), np.zeros(len(read), dtype=np.int64)
        for b in T.slices(batches, "text"):
            ids, bounds = id_stream(*words_and_ids(b.column("text"), path))
            cls = cl.of[ids]
            start, stop, skip = windows(bounds, span, 0)  # every id is a target once
            doc = np.searchsorted(bounds, start, side="right") - 1
            order = np.random.default_rng(len(start)).permutation(len(start))
            for i in range(0, len(order), batch):
                j = order[i:i + batch]
                c, t, ok = _gather(ids, cls, start[j], stop[j], skip[j], bounds[doc[j]], span)
                here[c] = True
                met = np.flatnonzero(here)
                here[met] = False
                row[met] = np.arange(len(met))
                c = row[c]
                times = np.bincount(c.reshape(-1))
                _, g = gradients(w | {"e": w["e"][met]}, c, t, ok)
                for k in w:
                    at = met if k == "e" else slice(None)
                    g2[k][at] = 0.95 * g2[k][at] + 0.05 * g[k] * g[k]
                    w[k][at] -= (rate * g[k] / (np.sqrt(g2[k][at]) + 1e-4)).astype(np.float32)
                read[met] += times
                seen += len(j)
        if seen:
            rest = _flat(w)
            met = np.flatnonzero(read)
            v = np.concatenate([w["e"][met], rest])
            at = np.concatenate([met, len(read) + np.arange(len(rest))])
            n = np.concatenate([read[met], np.full(len(rest), seen)]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n), *[pa.array(x) for x in v.T]], names=["at", "n", *_places(w)])
    return run


def _places(w: dict[str, np.ndarray]) -> list[str]:
    return [f"v{i}" for i in range(w["e"].shape[1])]


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    """All weights but the embeddings, in rows as long as an embedding."""
    d = w["e"].shape[1]
    flat = np.concatenate([w[k].reshape(-1) for k in sorted(w) if k != "e"])
    return np.append(flat, np.zeros(-len(flat) % d, flat.dtype)).reshape(-1, d)


def _unflat(at: np.ndarray, rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """``like`` with the given rows in the order of ``_train``."""
    out = {"e": like["e"].copy()}
    own = at < len(out["e"])
    out["e"][at[own]] = rows[own]
    rest = _flat(like)
    rest[at[~own] - len(out["e"])] = rows[~own]
    flat, i = rest.reshape(-1), 0
    for k in sorted(like):
        if k != "e":
            out[k] = flat[i:i + like[k].size].reshape(like[k].shape).astype(np.float32)
            i += like[k].size
    return out


def _score(path: str, cl: Classes, w, span: int, lap: int, common: np.ndarray, count: np.ndarray, denominator: float, end_count: int):
    """(rid, doc_id, n_tokens, score, known, base, words, times): the common words' part of the base
    score is summed here, the other distinct words of the text and how often each occurs are listed."""
    def run(batches):
        for b in T.slices(batches, "text"):
            words, table, slots = words_and_ids(b.column("text"), path)
            ids, bounds = id_stream(words, table, slots)
            score = log_probs(w, cl, ids, bounds, span, lap) / np.log(10)
            at = np.searchsorted(common, words.hash)
            hit = at < len(common)
            hit[hit] = common[at[hit]] == words.hash[hit]
            lp = np.zeros(len(hit))
            lp[hit] = np.log10((count[at[hit]] + 1) / denominator)
            base = np.bincount(words.doc, weights=lp, minlength=words.n_docs) + np.log10((end_count + 1) / denominator)
            known = np.bincount(words.doc, weights=hit, minlength=words.n_docs).astype(np.int64) + (end_count > 0)
            rest = np.flatnonzero(~hit)
            h, doc = words.hash[rest], words.doc[rest]
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            fresh = np.ones(len(h), dtype=bool)
            fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            place = np.flatnonzero(fresh)
            off = pa.array(np.searchsorted(doc[place], np.arange(words.n_docs + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), b.column("doc_id"), pa.array(words.counts() + 1), pa.array(score), pa.array(known), pa.array(base),
                 pa.ListArray.from_arrays(off, T.signed(h[place])), pa.ListArray.from_arrays(off, pa.array(np.diff(np.append(place, len(h))).astype(np.int32)))],
                names=["rid", "doc_id", "n_tokens", "score", "known", "base", "words", "times"])
    return run


def lm_scores(docs: DataFrame, mod: int = MOD, rest: int = REST, n_classes: int = 32, width: int = 8, span: int = 32, lap: int = 8, warm: int = 2000,
              rounds: int = 1, rate: float = 0.02, most_common: int = 400_000, tokenizer: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    path = tokenizer or default_path()
    held = F.coalesce(fold("doc_id", mod) == rest, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = docs.filter(~held)
    counts = materialize(train.mapInArrow(_counts(path), "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    vocab = counts.filter("kind = 0").select("key", "n")
    # bounded: one row for each id of the vocabulary
    sub = np.zeros(END + 1)
    for k, n in counts.filter("kind = 1").select("key", "n").toPandas().itertuples(index=False):
        sub[k] = n
    total = counts.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    distinct = vocab.count() + (sub[END] > 0)
    denominator = float(total + distinct + 1)
    cl = classes(sub, n_classes)
    w = start_weights(n_classes, width, span, of=cl.of)
    places = _places(w)
    first = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(warm)
    for r, part in enumerate([first] * (warm > 0 and rounds > 0) + [train] * rounds):
        got = (part.mapInArrow(_train(path, cl, w, span, rate / 4 ** r), ", ".join(["at long, n double", *[f"{x} float" for x in places]]))
               .groupBy("at").agg(*[(F.sum(F.col(x) * F.col("n")) / F.sum("n")).alias(x) for x in places]).toPandas())
        if len(got):
            w = _unflat(got["at"].to_numpy(), got[places].to_numpy(dtype=np.float32), w)
    # bounded: fewer than most_common words can hold such a share of the tokens
    top = vocab.filter(F.col("n") * most_common > total).toPandas().sort_values("key")
    key = top.key.to_numpy(dtype=np.int64).view(T.U64)
    order = np.argsort(key)
    scored = docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        _score(path, cl, w, span, lap, key[order], top.n.to_numpy()[order], denominator, int(sub[END])),
        "rid long, doc_id long, n_tokens long, score double, known long, base double, words array<long>, times array<int>")
    scored = materialize(scored, "lm-scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("words", "times")).alias("x")).select("rid", F.col("x.words").alias("key"), F.col("x.times").alias("t"))
    c = F.coalesce(F.col("n"), F.lit(0))
    more = (rare.join(vocab, "key", "left").groupBy("rid")
            .agg(F.sum(F.col("t") * F.log10((c + 1) / F.lit(denominator))).alias("mb"), F.sum(F.when(c > 0, F.col("t")).otherwise(0)).alias("mk")))
    out = scored.drop("words", "times").join(more, "rid", "left")
    zero = F.lit(0)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", (F.col("known") + F.coalesce("mk", zero)).cast("long").alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("mb", F.lit(0.0))).alias("base_score"), "score")
