"""N-gram Jaccard self-join by universe partitioning (operator 1).

Two shingle sets are linked when ``den * |A & B| >= num * |A | B|``. The join
is exact; its candidates come from a pigeonhole on hashed segments.

* Sizes are cut into bands ``[lo, floor(den * lo / num)]``: a partner of a set in
  band L is in band L or L + 1. Level L serves those two bands, and the most by
  which two linked sets can differ there is a constant H (``Level.diff``).
* A level hashes the universe of shingles into segments. Of these, ``dele`` are
  *two-unit* segments, indexed by their subset and by every subset with one
  element removed (the one-deletion neighbourhood); the others are *one-unit*
  segments, indexed by their subset alone. With units summing to H + 1 + slack, two
  linked sets agree on some two-unit segment up to one deletion, or on at least
  ``slack + 1`` one-unit segments. Each set then leaves out its ``slack`` least
  selective one-unit subsets, by an order on the subsets' content that is the same for
  all sets: the best agreeing segment is kept by both. Empty and nearly empty
  segments go this way.
* The split between the two kinds is chosen for each level by a cost: index rows
  plus expected chance meetings, from the number of sets in the level's bands.

Finding links among the sets that share a key must not enumerate groups of
copies. Equal sets are merged first, and of the keys that hold the same sets one stays, with their number.
A few rounds link each set to one head of its keys and merge components. Then each key gives the nearest
candidates that would connect its sets, fewer than it has sets (``_forest``), by parity sketches, which bound the size
of the symmetric difference from below; those that prove to be links are merged. Keys whose sets are all
in one component are done. For the rest every pair of sets from different components is tested in blocks of
bounded size: by sketches, and exactly after that, or, for keys in which many pairs pass the sketches without a link, by the
sets themselves inside the block, which gives at most one link for each component (``reached``). So no step makes more
rows than a few for each set of a key. A sketch has some bits for each shingle, so that it does not
fill up in long texts and pairs well below the threshold reach no exact test. Only links
inside a component that is already connected are not listed.

Defined results: null, empty or blank text has no shingles and no links (its
``component_id`` is its ``doc_id``); fewer than ``k`` words form one shingle; rows with a
null ``doc_id`` get the component of the equal sets that have an id, else null; rows
that repeat a ``doc_id`` are one node and each comes back; an empty table gives an
empty result. Other columns are ignored. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import batch_rows, components, materialize, release, sieved

SLACK_SHARE = 8
#: Rows of a batch that Python gets at most: some 8 MB of usual texts.
BATCH_ROWS = 4096
#: Words of the shortest sketch; all are first compared folded to so many.
SKETCH_WORDS = 8
#: (at least so many bits for each shingle, up to so many words): the first is for usual texts, the second keeps long texts apart.
SKETCH_SIZES = ((4, 64), (1, 256))


@dataclass(frozen=True)
class Level:
    lo: int
    hi: int
    diff: int
    dele: int
    slack: int

    @property
    def one(self) -> int:
        return self.diff + 1 - 2 * self.dele + self.slack


def most_diff(total, num: int, den: int):
    """Largest symmetric difference of linked sets whose sizes sum to ``total``."""
    return total - 2 * -(-(num * total) // (num + den))


def bands(most: int, num: int, den: int) -> list[tuple[int, int]]:
    out, lo = [], 1
    while lo <= most:
        hi = max(lo, den * lo // num)
        out.append((lo, hi))
        lo = hi + 1
    return out


def levels(counts: dict[int, int], most: int, num: int, den: int, chance: float = 0.05) -> list[Level]:
    """The levels for sets of at most ``most`` shingles; ``counts``: sets by band.

    ``chance``: assumed probability that two unrelated sets agree on a shingle of a
    segment (shared boilerplate); only the cost depends on it, never the result."""
    out = []
    for k, (lo, hi) in enumerate(bands(most, num, den)):
        top = hi + den * hi // num
        diff = max(0, most_diff(top, num, den), most_diff(top - 1, num, den))
        slack = 1 + diff // SLACK_SHARE if diff else 0
        met = counts.get(k, 0) + counts.get(k + 1, 0)

        def cost(d: int, diff=diff, slack=slack, met=met, hi=hi) -> float:
            one = diff + 1 - 2 * d + slack
            size = hi / (one + d)
            rows = one - slack + d * (1 + size)
            return rows + met * ((one - slack) * chance ** size + d * (1 + size) * chance ** max(size - 1, 0))
        dele = min(range(0, (diff + 1) // 2 + 1), key=cost) if diff and diff <= 64 else 0
        out.append(Level(lo, hi, diff, dele, slack))
    return out


def shingles(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and the bounds of each text's run."""
    w = T.words(col, lower=True)
    h, at = w.ngrams(k)
    doc = w.doc[at]
    n = w.counts()
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.empty(len(short), dtype=T.U64)
        for i, d in enumerate(short):
            x = np.full(1, 1000 + n[d], dtype=T.U64)
            for v in w.hash[w.first[d]:w.first[d + 1]]:
                x = T.mix(x * T.U64(0x9FB21C651E98DF25) + v)
            whole[i] = x[0]
        h, doc = np.concatenate([h, whole]), np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    return T.per_doc_unique(h, doc, w.n_docs)


def _sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    c = np.zeros(len(x) + 1, dtype=T.U64)
    np.cumsum(x, out=c[1:])
    return c[bounds[1:]] - c[bounds[:-1]]


def _signatures(k: int):
    def run(batches):
        for b in T.slices(batches, "text", T.SMALL_SLICE_BYTES):
            toks, bounds = shingles(b.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(np.diff(bounds)), T.signed(_sums(T.mix(toks), bounds)),
                 T.signed(_sums(T.mix(toks ^ T.U64(0xA0761D6478BD642F)), bounds))], names=["doc_id", "n_shingles", "s1", "s2"])
    return run


def segment_keys(toks: np.ndarray, bounds: np.ndarray, lv: list[Level]) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of all sets and the set of each: both levels of every set."""
    n = np.diff(bounds)
    lows = np.array([x.lo for x in lv], dtype=np.int64)
    diff, dele, slack, one = (np.array([getattr(x, f) for x in lv], dtype=np.int64) for f in ("diff", "dele", "slack", "one"))
    band = np.searchsorted(lows, n, side="right") - 1
    of = np.repeat(np.arange(len(n)), n)
    keys, owner = [], []
    for step in (0, 1):
        level = band - step
        use = (n > 0) & (level >= 0)
        use[use] &= diff[level[use]] > 0
        if not use.any():
            continue
        level = np.where(use, level, 0)
        segs = np.where(use, one[level] + dele[level], 0)
        base = np.concatenate([[0], np.cumsum(segs)])
        mine = use[of]
        t, d = toks[mine], of[mine]
        salt = level.astype(T.U64) * T.U64(0xC2B2AE3D27D4EB4F)
        seg = (T.mix(t + salt[d]) % segs[d].astype(T.U64)).astype(np.int64)
        g = base[d] + seg
        tok = T.mix(t ^ T.U64(0x1D8E4E27C47D124F))
        content = np.zeros(base[-1], dtype=T.U64)
        np.add.at(content, g, tok)
        size = np.bincount(g, minlength=base[-1])
        gd = np.repeat(np.arange(len(n)), segs)
        gs = np.arange(base[-1]) - base[gd]
        place = T.mix(salt[gd] + gs.astype(T.U64) * T.U64(0x9E3779B97F4A7C15) + T.U64(7))
        whole = T.mix(content + place)
        two = gs < dele[level[gd]]
        # one-unit segments: all but the slack least selective, in the order (size, key)
        at = np.flatnonzero(~two)
        at = at[np.lexsort((whole[at], -size[at], gd[at]))]
        rank = np.arange(len(at)) - np.searchsorted(gd[at], gd[at])
        at = at[rank < (one - slack)[level[gd[at]]]]
        keys.append(whole[at])
        owner.append(gd[at])
        if two.any():
            at = np.flatnonzero(two)
            keys.append(whole[at])
            owner.append(gd[at])
            less = np.flatnonzero(two[g])
            keys.append(T.mix(content[g[less]] - tok[less] + place[g[less]]))
            owner.append(d[less])
    if not keys:
        return np.zeros(0, T.U64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owner)


def _entries(k: int, lv: list[Level]):
    """Index rows (key, id, more): sets of one slice that share a key make one row,
    so that a key of very many copies reaches the shuffle once for each slice."""
    def run(batches):
        for b in T.slices(batches, "text", 2 * T.SLICE_BYTES):
            ids = b.column("doc_id").cast(pa.int64())
            b = b.filter(ids.is_valid())
            if not b.num_rows:
                continue
            # the arrays of a shingle's keys are many times its text: only keys and ids are held for a whole slice
            found = []
            for part in T.slices([b], "text", T.SMALL_SLICE_BYTES):
                key, owner = segment_keys(*shingles(part.column("text"), k), lv)
                found.append((key, part.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)[owner]))
            key, who = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            del found
            order = np.lexsort((who, key))
            key, who = key[order], who[order]
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
            key, who = key[fresh], who[fresh]
            head = np.ones(len(key), dtype=bool)
            head[1:] = key[1:] != key[:-1]
            first = np.flatnonzero(head)
            extra = np.diff(np.append(first, len(key))) - 1
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(extra)]).astype(np.int32)),
                                             pa.array(who[~head]), mask=pa.array(extra == 0))
            out = pa.RecordBatch.from_arrays([T.signed(key[first]), pa.array(who[first]), lists], names=["key", "id", "more"])
            for i in range(0, out.num_rows, 1 << 17):
                yield out.slice(i, 1 << 17)
    return run


def sketch_words(n: np.ndarray) -> np.ndarray:
    """Words of the sketches of sets of these sizes: powers of two."""
    out = np.full(len(n), SKETCH_WORDS, dtype=np.int64)
    for bits, most in SKETCH_SIZES:
        need = np.ceil(np.log2(np.maximum(bits * n, 1) / 64)).clip(0, np.log2(most))
        out = np.maximum(out, 1 << need.astype(np.int64))
    return out


def sketches(toks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of all sets in a row, and the bounds of each: a shingle turns one bit. Two sketches are compared
    after the longer one is folded (``_folded``), which gives the sketch that it would have with fewer words."""
    size = sketch_words(np.diff(bounds))
    at = np.concatenate([[0], np.cumsum(size)])
    bit = T.mix(toks ^ T.U64(0x2545F4914F6CDD1D))
    of = np.repeat(np.arange(len(size)), np.diff(bounds))
    out = np.zeros(at[-1], dtype=T.U64)
    np.bitwise_xor.at(out, at[of] + ((bit >> T.U64(6)).astype(np.int64) & (size[of] - 1)), T.U64(1) << (bit & T.U64(63)))
    return out, at


def _folded(sketch: bytes, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, dtype=T.U64).reshape(-1, words), axis=0)


def _sets(k: int):
    def run(batches):
        for b in T.slices(batches, "text", T.SMALL_SLICE_BYTES):
            toks, bounds = shingles(b.column("text"), k)
            words, at = sketches(toks, bounds)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), T.signed(toks))
            bits = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((8 * at).astype(np.int32)), pa.py_buffer(words)])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.diff(bounds)), bits, lists],
                                             names=["id", "n", "sketch", "toks"])
    return run


def _exact(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of a written table that are linked, by the size of the intersection."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    some = sieved(sets.select("id", "n", "toks"), ids, "id", "held").filter("held")
    sa = some.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    sb = some.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(sb, "b").join(sa, "a")
            .filter((F.col("na") * num <= F.col("nb") * den) & (F.col("nb") * num <= F.col("na") * den))
            .filter(den * both >= num * (F.col("na") + F.col("nb") - both)).select("a", "b"))


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the sizes and sketches allow."""
    sa = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    sb = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches):
        for b in batches:
            ids, wide, n = [], [], []
            for side in "ab":
                ids.append(b.column(side).to_numpy())
                wide += b.column(f"s{side}").to_pylist()
                n.append(b.column(f"n{side}").to_numpy())
            if len(ids[0]):
                table, x = np.empty(len(wide), dtype=object), np.arange(len(ids[0]))
                table[:] = wide
                folded = np.stack([_folded(v, SKETCH_WORDS) for v in wide])
                gap = np.bitwise_count(folded[x] ^ folded[x + len(x)]).sum(axis=1, dtype=np.int64)
                x, *_ = _apart(table, x, x + len(x), gap, most_diff(n[0] + n[1], num, den))
                yield pa.RecordBatch.from_arrays([pa.array(ids[0][x]), pa.array(ids[1][x])], names=["a", "b"])
    return (pairs.join(sa, "a").join(sb, "b").filter((F.col("na") * num <= F.col("nb") * den) & (F.col("nb") * num <= F.col("na") * den))
            .mapInArrow(run, "a long, b long"))


def _apart(sketch: np.ndarray, x: np.ndarray, y: np.ndarray, gap: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (x, y) whose full sketches differ in at most ``most`` bits, in steps of bounded memory, and the share of ``most`` in which
    they differ; ``gap``: the bits in which the folded sketches differ."""
    rows, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    size = np.array([len(sketch[i]) // 8 for i in rows], dtype=np.int64)
    px, py = place[:len(x)], place[len(x):]
    words = np.minimum(size[px], size[py])
    gap = gap.copy()
    for w in np.unique(words[words > SKETCH_WORDS]).tolist():
        at = np.flatnonzero(words == w)
        used, back = np.unique(np.concatenate([px[at], py[at]]), return_inverse=True)
        table = np.stack([_folded(sketch[i], w) for i in rows[used]])
        left, right = back[:len(at)], back[len(at):]
        step = max(1, (1 << 18) // w)
        for i in range(0, len(at), step):
            j = slice(i, i + step)
            gap[at[j]] = np.bitwise_count(table[left[j]] ^ table[right[j]]).sum(axis=1, dtype=np.int64)
    keep = gap <= most
    return x[keep], y[keep], gap[keep] / np.maximum(most[keep], 1)


def _runs(batches, names: list[str], more):
    """The runs of equal (key, bi, bj), which are sorted, as lists of columns, in a list for each batch; ``more``: further columns of a batch."""
    rest: list[np.ndarray] | None = None

    def cut(cols, last):
        change = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
        bounds = [0, *change.tolist(), len(cols[0])]
        ends = bounds if last else bounds[:-1]
        return [[c[i:j] for c in cols] for i, j in zip(ends[:-1], ends[1:], strict=True) if j - i > 1], [c[ends[-1]:] for c in cols]

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in names] + more(b)
        if rest is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(rest, cols, strict=True)]
        full, rest = cut(cols, False)
        yield full
    if rest is not None:
        yield cut(rest, True)[0]


def _sketched(b: pa.RecordBatch) -> list[np.ndarray]:
    wide = np.empty(b.num_rows, dtype=object)
    wide[:] = b.column("sketch").to_pylist()
    return [wide, np.stack([_folded(x, SKETCH_WORDS) for x in wide])]


BLOCK_COLUMNS = ["key", "bi", "bj", "blk", "id", "comp", "n"]


def _near(run: list[np.ndarray], num: int, den: int):
    """Pairs of sets of different components of one run that the sizes and sketches allow: row numbers and the share of the allowed
    difference that the sketches show, some rows at a time."""
    at, bi, bj, blk, ids, comp, n, wide, sk = run
    left, right = (np.flatnonzero(blk == bi[0]), np.flatnonzero(blk == bj[0]))
    same = bi[0] == bj[0]
    for i in range(0, len(left), 64):
        a = left[i:i + 64]
        total = n[a][:, None] + n[right][None, :]
        ok = comp[a][:, None] != comp[right][None, :]
        if same:
            ok &= ids[a][:, None] < ids[right][None, :]
        ok &= (n[a][:, None] * num <= n[right][None, :] * den) & (n[right][None, :] * num <= n[a][:, None] * den)
        x, y = np.nonzero(ok)
        if not len(x):
            continue
        gap = np.bitwise_count(sk[a[x]] ^ sk[right[y]]).sum(axis=1, dtype=np.int64)
        most = most_diff(total[x, y], num, den)
        keep = gap <= most
        yield _apart(wide, a[x[keep]], right[y[keep]], gap[keep], most[keep])


def _cross_pairs(num: int, den: int):
    """Pairs of sets of different components within runs of equal (key, bi, bj)
    that the sizes and sketches allow. Rows arrive sorted; a run is at most two blocks."""
    def run(batches):
        for runs in _runs(batches, BLOCK_COLUMNS, _sketched):
            found = [(r[4][x], r[4][y]) for r in runs for x, y, _ in _near(r, num, den) if len(x)]
            if found:
                a, b = (np.concatenate([p[i] for p in found]) for i in (0, 1))
                ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(ab[0]), pa.array(ab[1])], names=["a", "b"])
    return run


def spanning(u: np.ndarray, v: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the edges (u, v) of a lightest spanning forest of n nodes: in each round every tree takes its lightest edge to another."""
    order = np.argsort(weight, kind="stable")
    u, v = u[order], v[order]
    label, chosen, live, none = np.arange(n), [], np.arange(len(u)), len(u)
    while True:
        a, b = label[u[live]], label[v[live]]
        apart = a != b
        live, a, b = live[apart], a[apart], b[apart]
        if not len(live):
            return order[np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *chosen]))]
        best = np.full(n, none)
        np.minimum.at(best, a, live)
        np.minimum.at(best, b, live)
        tree = np.flatnonzero(best < none)
        edge = best[tree]
        chosen.append(edge)
        up = np.arange(n)
        up[tree] = label[u[edge]] + label[v[edge]] - tree
        both = up[up] == np.arange(n)  # two trees that take the same edge
        up = np.where(both & (np.arange(n) < up), np.arange(n), up)
        while (up[up] != up).any():
            up = up[up]
        label = up[label]


def trees(edges: np.ndarray, n: int) -> np.ndarray:
    """A number for each of n nodes, equal for those that the edges (two rows of nodes) of a forest connect."""
    up = np.arange(n)
    while True:
        low = up.copy()
        np.minimum.at(low, edges[0], up[edges[1]])
        np.minimum.at(low, edges[1], up[edges[0]])
        low = low[low]
        if (low == up).all():
            return up
        up = low


#: Pairs that a key may give to the exact test one by one, for each of its sets; other keys are tested in blocks.
PAIRS_PER_SET = 4
#: Share of the allowed difference below which a pair counts as a link in that forecast.
LIKELY = 0.9
#: Pairs that ``_forest`` holds at a time.
FOREST_PAIRS = 1 << 20


def _forest(num: int, den: int):
    """Of the pairs of each run that the sizes and sketches allow, those of a spanning forest of its components, nearest pairs first: fewer rows
    than sets. A further row (null, null, key) stands for a key that may still give more than PAIRS_PER_SET pairs for each set when those are
    linked; ``parts`` is the number of blocks of the key, and a run is one of them."""
    def of(r):
        ids, comp, parts = r[4], r[5], int(r[9][0])
        _, c = np.unique(comp, return_inverse=True)
        keep, pairs, many = [np.zeros((2, 0), dtype=np.int64), np.zeros(0)], [], 0

        def shrunk(keep, pairs):
            xy = np.concatenate([keep[0], *[np.stack([x, y]) for x, y, _ in pairs]], axis=1)
            w = np.concatenate([keep[1], *[w for *_, w in pairs]])
            e = spanning(c[xy[0]], c[xy[1]], w, len(ids))
            return [xy[:, e], w[e]]
        held = 0
        for p in _near(r[:9], num, den):
            pairs.append(p)
            many, held = many + len(p[0]), held + len(p[0])
            if held > FOREST_PAIRS:
                keep, pairs, held = shrunk(keep, pairs), [], 0
        xy, w = shrunk(keep, pairs)
        if many * parts > PAIRS_PER_SET * len(ids):
            # pairs that are left if those well within the bound prove to be links
            tree = trees(c[xy[:, w < LIKELY]], len(ids))[c]
            many = sum(int((tree[x] != tree[y]).sum()) for x, y, _ in _near(r[:9], num, den))
        return ids[xy[0]], ids[xy[1]], many * parts > PAIRS_PER_SET * len(ids)

    def run(batches):
        for runs in _runs(batches, BLOCK_COLUMNS, lambda b: [*_sketched(b), b.column("parts").to_numpy()]):
            found = [(r[0][0], *of(r)) for r in runs]
            dense = [key for key, *_, much in found if much]
            a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *[f[i] for f in found]]) for i in (1, 2))
            if not len(a) and not dense:
                continue
            ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            gone = pa.nulls(len(dense), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(ab[0]), gone]), pa.concat_arrays([pa.array(ab[1]), gone]),
                                              pa.concat_arrays([pa.nulls(ab.shape[1], pa.int64()), pa.array(dense, pa.int64())])], names=["a", "b", "key"])
    return run


def reached(ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links that connect what the links of these sets connect, at most one for each component: a component that is reached is
    compared, by the sets' elements, with the sets that are not reached yet."""
    n = np.array([len(x) for x in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), n)
    bounds = np.concatenate([[0], np.cumsum(n)])
    _, c = np.unique(comp, return_inverse=True)
    left, mark, out = np.ones(len(sets), dtype=bool), np.zeros(place.max() + 1, dtype=bool), []
    for seed in range(len(sets)):
        queue = np.flatnonzero(left & (c == c[seed])).tolist()
        left[queue] = False
        while queue and left.any():
            x = queue.pop()
            mine = place[bounds[x]:bounds[x + 1]]
            mark[mine] = True
            both = np.bincount(owner[mark[place]], minlength=len(sets))
            mark[mine] = False
            y = np.flatnonzero(left & (den * both >= num * (n[x] + n - both)))
            if not len(y):
                continue
            new, first = np.unique(c[y], return_index=True)
            out += [(int(ids[x]), int(ids[i])) for i in y[first]]
            fresh = left & np.isin(c, new)
            left &= ~fresh
            queue += np.flatnonzero(fresh).tolist()
    return out


def _reached(num: int, den: int):
    """``reached`` of every run of equal (key, bi, bj)."""
    def lists(b):
        col, out = b.column("toks"), np.empty(b.num_rows, dtype=object)
        flat, at = col.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))])
        out[:] = [flat[i:j].copy() for i, j in zip(at[:-1], at[1:], strict=True)]
        return [out]

    def run(batches):
        for runs in _runs(batches, ["key", "bi", "bj", "id", "comp"], lists):
            got = [p for r in runs for p in reached(r[3], r[4], list(r[5]), num, den)]
            if got:
                a, b = np.array(sorted(set(got)), dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
    return run


def _best_heads(members: DataFrame, comp: DataFrame, turn: int) -> DataFrame:
    """For each set, the head of the most of its keys among heads of other components. The head of a key is of the first of its components, in
    another order in each turn."""
    m = members.join(comp, "id")
    first = F.xxhash64("comp", F.lit(turn))
    # one row for a key and component: a hot key is reduced before it meets
    heads = (m.groupBy("key", "comp").agg(F.min("id").alias("id"))
             .groupBy("key").agg(F.min_by("id", first).alias("head"), F.min_by("comp", first).alias("hc"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo <> hi").drop("lo", "hi"))
    votes = m.join(heads, "key").filter("comp <> hc").groupBy("id", "head").agg(F.sum("w").alias("v"))
    return votes.groupBy("id").agg(F.max_by("head", F.struct("v", "head")).alias("head")).select(F.col("head").alias("a"), F.col("id").alias("b"))


def _relabel(comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``comp`` (id, comp) after joining the components that ``links`` connect; both written tables are deleted."""
    ca, cb = comp.select(F.col("id").alias("a"), F.col("comp").alias("x")), comp.select(F.col("id").alias("b"), F.col("comp").alias("y"))
    up = components(links.join(ca, "a").join(cb, "b").select(F.col("x").alias("a"), F.col("y").alias("b")), name)
    out = materialize(comp.join(up.select(F.col("id").alias("comp"), F.col("comp").alias("up")), "comp", "left")
                      .select("id", F.coalesce("up", "comp").alias("comp")), f"{name}-comp")
    release(comp, links, *up.written)
    return out


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 8, den: int = 10, rounds: int = 2, block: int = 4096) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return _components_of(docs, k, num, den, rounds, block)


def _components_of(docs: DataFrame, k: int, num: int, den: int, rounds: int, block: int) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = materialize(docs.mapInArrow(_signatures(k), "doc_id long, n_shingles long, s1 long, s2 long"), "jac-sig")
    classes = materialize(sig.filter("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("rep")), "jac-cls")
    own = materialize(sig.join(classes, ["n_shingles", "s1", "s2"], "left").select("doc_id", "n_shingles", "rep"), "jac-own")
    release(sig)
    top = classes.agg(F.max("n_shingles")).first()[0]
    if top is None:
        return own.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    edges = bands(int(top), num, den)
    # sets by band: a table of some dozens of rows, logarithmic in the longest text
    spot = F.lit(0)
    for i, (lo, _) in enumerate(edges):
        spot = F.when(F.col("n_shingles") >= lo, i).otherwise(spot) if i else spot
    counts = {r[0]: r[1] for r in classes.groupBy(spot.alias("band")).count().collect()}
    lv = levels(counts, int(top), num, den)
    links_of_ids = own.filter("doc_id is not null and rep is not null").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    members = _members(docs, links_of_ids, k, lv)
    comp = materialize(members.select("id").distinct().withColumn("comp", F.col("id")), "jac-c0")
    if not comp.isEmpty():
        held = comp.select(F.col("id").alias("doc_id"))
        sets = materialize(sieved(docs, held, "doc_id", "held").filter("held").drop("held").join(held, "doc_id", "left_semi")
                           .mapInArrow(_sets(k), "id long, n long, sketch binary, toks array<long>"), "jac-sets")
        for r in range(rounds):
            heads = materialize(_possible(_best_heads(members, comp, r), sets, num, den), f"jac-h{r}")
            links = materialize(_exact(heads, sets, num, den), f"jac-l{r}")
            release(heads)
            if links.isEmpty():
                release(links)
                break
            comp = _relabel(comp, links, f"jac-r{r}")
        near = materialize(_nearest(members, comp, sets, num, den, block), "jac-n")
        comp = _relabel(comp, materialize(_exact(near.filter("key is null").select("a", "b").distinct(), sets, num, den), "jac-ln"), "jac-rn")
        dense, sparse = near.filter("key is not null").select("key").distinct(), members
        if not dense.isEmpty():
            links = materialize(_blocks(members.join(dense, "key", "left_semi"), comp, sets.select("id", "toks"), block)
                                .select("key", "bi", "bj", "id", "comp", "toks").mapInArrow(_reached(num, den), "a long, b long").distinct(), "jac-ld")
            comp = _relabel(comp, links, "jac-rd")
            sparse = members.join(dense, "key", "left_anti")
        rest = materialize(_residual(sparse, comp, sets, num, den, block), "jac-x")
        links = materialize(_exact(rest, sets, num, den), "jac-lx")
        release(near, rest)
        release(sets)
        comp = _relabel(comp, links, "jac-rx")
    release(members)
    # equal sets, and rows that repeat an id with another text, join the components
    multi = own.filter("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("c")).filter("b <> c")
    odd = multi.select("b", "c").filter("b is not null")
    if not odd.isEmpty():
        reps = classes.select(F.col("rep").alias("id")).filter("id is not null").distinct().join(comp, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))
        ties = own.filter("doc_id is not null and rep is not null").join(multi, "doc_id").select(F.col("rep").alias("a"), "b").distinct()
        known, comp = comp, _relabel(materialize(reps, "jac-all"), materialize(ties, "jac-ties"), "jac-ids")
        release(known)
    release(classes)
    got = own.join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left")
    return got.select("doc_id", "n_shingles", F.coalesce("comp", "rep", "doc_id").alias("component_id"))


def _members(docs: DataFrame, reps: DataFrame, k: int, lv: list[Level]) -> DataFrame:
    """(key, id, w) of the keys that at least two different sets share; id: the class's smallest; w: the keys that hold the same sets."""
    by_key = Window.partitionBy("key").orderBy("id")
    shared = (docs.mapInArrow(_entries(k, lv), "key long, id long, more array<long>")
              .withColumn("before", F.lag("id").over(by_key)).withColumn("after", F.lead("id").over(by_key))
              .filter("before is not null or after is not null or more is not null")
              .select("key", F.explode(F.concat(F.array("id"), F.coalesce("more", F.array().cast("array<long>")))).alias("a")))
    shared = materialize(shared, "jac-m0")
    rows = shared.join(reps, "a").select("key", F.col("b").alias("id")).distinct().repartition("key")
    # of the keys that hold the same sets (128 bits and the number of them) one stays, with their number
    live = rows.groupBy("key").agg(*_content()).filter("lo <> hi").groupBy("c", "lo", "hi", "h1", "h2").agg(F.min("key").alias("key"), F.count("*").alias("w"))
    out = materialize(rows.join(live.select("key", "w"), "key"), "jac-m")
    release(shared)
    return out


def _content() -> list:
    """What a key holds: the number of its sets, the smallest and the largest, and 128 bits of them."""
    return [F.count("*").alias("c"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("h1"),
            F.bit_xor(F.xxhash64("id", F.lit("again"))).alias("h2")]


def _nearest(members: DataFrame, comp: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(a, b, key): candidates that connect the sets of each key, fewer than its sets, and the keys with many pairs (``_forest``). A key of more than
    ``block`` sets is cut into blocks, otherwise for each key; no set is in two blocks of a key."""
    m = members.join(comp, "id")
    sizes = m.groupBy("key").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    m = m.join(sizes.select("key", F.ceil(F.col("c") / block).alias("parts")), "key").withColumn("blk", F.pmod(F.xxhash64("id", "key"), "parts").cast("int"))
    m = m.select("key", F.col("blk").alias("bi"), F.col("blk").alias("bj"), "blk", "id", "comp", "parts").join(sets.select("id", "n", "sketch"), "id")
    m = m.repartition("key", "bi").sortWithinPartitions("key", "bi", "bj")
    return m.select(*BLOCK_COLUMNS, "sketch", "parts").mapInArrow(_forest(num, den), "a long, b long, key long")


def _blocks(members: DataFrame, comp: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Sorted rows (key, bi, bj, blk, id, comp and the columns of ``sets``): the sets of each key with several components, in all pairs of its blocks."""
    m = members.join(comp, "id")
    sizes = m.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last"), *_content()).filter("first <> last")
    # keys that hold the same sets would test the same pairs: one of them stays
    sizes = sizes.groupBy("c", "lo", "hi", "h1", "h2").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("c") / block).cast("int").alias("nb"))
    m = m.join(sizes, "key").withColumn("blk", (F.pmod(F.xxhash64("id"), F.col("nb"))).cast("int"))
    m = m.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    m = m.select("key", F.least("blk", "o").alias("bi"), F.greatest("blk", "o").alias("bj"), "blk", "id", "comp")
    return m.join(sets, "id").repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")


def _residual(members: DataFrame, comp: DataFrame, sets: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """Every pair of sets of different components that share a key and pass the sketch."""
    m = _blocks(members, comp, sets.select("id", "n", "sketch"), block)
    return m.select(*BLOCK_COLUMNS, "sketch").mapInArrow(_cross_pairs(num, den), "a long, b long").distinct()
