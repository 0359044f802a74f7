"""Spelling variants: words of the corpus that differ by one code point (operator 12).

Words are maximal letter runs with A-Z lower-cased. They are counted in the tasks that hold
the texts and added up by Spark; words of ``least_length`` code points or more with
``least_count`` occurrences or more are the vocabulary.

Two words differ by exactly one inserted, deleted or replaced code point when their common prefix
and common suffix together reach the longer one's length m minus one. One of the two then reaches m // 2,
so near words of longer length m share their first or their last m // 2 code points: every
word stands under both parts for m = its own length (as the longer one or one of two equally long)
and m = its length + 1 (as the shorter). Under one key the words form padded code-point
matrices, one aligned left for prefixes and one aligned right for suffixes, and block pairs of them are compared. A key of any
number of words is cut into blocks of ``block`` code points; each block pair is a piece of
work of its own, dealt out by Spark, so a frequent beginning or ending is no hot task. Only near pairs leave a task. A pair that
shares both parts is reported under the first one only.

Every word's form is its near word with the most occurrences (ties: the smallest in
code-point order), if those are ``ratio`` times its own or more. Forms are followed to the last one by pointer
doubling; the counts grow on the way, so there is no circle.

Defined results: null and empty texts have no words; a row with a null ``doc_id`` is counted unchanged;
repeated rows are counted each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm import textops as T
from newsframe.llm.common import materialize, release

#: Fixed value: runs whose hash this divides lose one code point.
EVERY = 199
#: Code points of a block of one key's matrix.
BLOCK = 1 << 14
#: Pairs compared at once, in code points.
AT_ONCE = 1 << 22
#: Letters U+00C0..U+00FF are these two bytes' successors in UTF-8.
_LEAD = 0xC3

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[_LEAD] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc32s(states: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of many byte ranges, each continued from a crc32 so far."""
    order = np.argsort(-size, kind="stable")
    crc = ~states[order].astype(np.uint32)
    at, size = start[order], size[order]
    left = len(order)
    for t in range(int(size[0]) if left else 0):
        left = int(np.searchsorted(-size, -t, side="left"))  # sizes descend: those above t
        c = crc[:left]
        crc[:left] = _CRC[(c ^ data[at[:left] + t]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty(len(order), dtype=np.uint32)
    out[order] = ~crc
    return out


def _distinct_runs(col: pa.Array):
    """Lower-cased letter runs of a slice of texts: the distinct ones as Arrow strings, and
    the (document, run) pairs with their counts."""
    data, off = T.buffers(col)
    letter = _LETTER[data]
    letter[1:] |= data[:-1] == _LEAD
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:-1]
    last[:-1] &= ~letter[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(off[1:], start, side="right")
    bounds = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=bounds[1:])
    solid = T._LOWER[data[letter]]
    coded = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(solid)]).dictionary_encode()
    size = len(coded.dictionary)
    pair, n = np.unique(doc * max(size, 1) + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
    return coded.dictionary, pair // max(size, 1), pair % max(size, 1), n


def _count(least_length: int, plant: bool):
    def task(batches):
        for batch in T.slices(batches, "text"):
            words, doc, code, n = _distinct_runs(batch.column("text"))
            data, off = T.buffers(words)
            total = np.zeros(len(words), dtype=np.int64)
            cut: dict[str, int] = {}
            if plant:
                ids = batch.column("doc_id").to_pylist()
                known = np.array([i is not None for i in ids], dtype=bool)
                so_far = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
                h = crc32s(so_far[doc], data, off[code], off[code + 1] - off[code])
                hit = (h % EVERY == 0) & known[doc]
                for k in np.flatnonzero(hit).tolist():
                    word = words[int(code[k])].as_py()
                    at = int(h[k]) % len(word)
                    word = word[:at] + word[at + 1:]
                    cut[word] = cut.get(word, 0) + int(n[k])
                np.add.at(total, code[~hit], n[~hit])
            else:
                np.add.at(total, code, n)
            starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            points = starts[off[1:]] - starts[off[:-1]]
            keep = np.flatnonzero((total > 0) & (points >= least_length))
            more = [w for w in cut if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([words.take(pa.array(keep)).cast(pa.string()), pa.array(more, pa.string())]),
                 pa.concat_arrays([pa.array(total[keep]), pa.array([cut[w] for w in more], pa.int64())])], names=["word", "n"])
    return task


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, plant: bool = False) -> DataFrame:
    """(word, n): words of all texts with their occurrences. With ``plant`` every 199th (document, run)
    by crc32 first loses one code point."""
    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = src.mapInArrow(_count(least_length, plant), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded right and padded left."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    bounds = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(words)), size)
    col = np.arange(len(flat)) - np.repeat(bounds[:-1], size)
    left = np.zeros((len(words), width), dtype=np.uint32)
    right = np.zeros((len(words), width), dtype=np.uint32)
    left[row, col] = flat
    right[row, width - np.repeat(size, size) + col] = flat
    return left, right


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differs = a != b
    at = differs.argmax(axis=1)
    return np.where(differs[np.arange(len(at)), at], at, a.shape[1])


def near_in_tiles(group: np.ndarray, across: np.ndarray, side: np.ndarray, words: list[str], m: int, by_prefix: np.ndarray):
    """Near pairs (i, j) inside runs of equal ``group``: where it is one of two blocks (``across``) rows of side 0 against
    those of side 1, within one block each row against the later ones. One of a pair has length ``m``."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    left, right = _matrices(words, m)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.concatenate([starts[1:], [len(group)]])
    which = np.repeat(np.arange(len(starts)), ends - starts)
    second = starts + np.add.reduceat(1 - side, starts)  # where side 1 begins
    begin = np.where(across, second[which], np.arange(len(group)) + 1)
    count = np.where(across & (side == 1), 0, ends[which] - begin)
    upto = np.concatenate([[0], np.cumsum(count)])
    out_i, out_j = [], []
    most = max(AT_ONCE // max(m, 1), 1)
    at = 0
    while at < upto[-1]:  # a row's partners may be cut between two rounds
        stop = min(at + most, int(upto[-1]))
        pair = np.arange(at, stop)
        i = np.searchsorted(upto, pair, side="right") - 1
        j = begin[i] + pair - upto[i]
        at = stop
        fit = (size[i] == m) | (size[j] == m)
        i, j = i[fit], j[fit]
        prefix = _first_difference(left[i], left[j])
        prefix = np.minimum(prefix, np.minimum(size[i], size[j]))
        suffix = _first_difference(right[i][:, ::-1], right[j][:, ::-1])
        suffix = np.minimum(suffix, np.minimum(size[i], size[j]))
        good = (prefix + suffix >= m - 1) & (by_prefix[i] | (prefix < m // 2))
        out_i.append(i[good])
        out_j.append(j[good])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, np.int64),) * 2


def _near(batches):
    """Rows (m, by_prefix, part, one, two, side, word, n) sorted by group: both directions of each near pair."""
    held: list[pa.RecordBatch] = []

    def compare(t: pa.Table):
        if not t.num_rows:
            return
        t = t.combine_chunks()
        ms = t.column("m").to_numpy()
        new = np.zeros(t.num_rows, dtype=bool)
        new[0] = True
        for c in ("m", "by_prefix", "part", "one", "two"):
            v = t.column(c).chunk(0)
            new[1:] |= _changes(v)
        group = np.cumsum(new) - 1
        cuts = np.flatnonzero(np.concatenate([[True], ms[1:] != ms[:-1]])).tolist() + [t.num_rows]
        words, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        side, across = t.column("side").to_numpy(), t.column("one").to_numpy() != t.column("two").to_numpy()
        by_prefix = np.array(t.column("by_prefix").to_pylist(), dtype=bool)
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            i, j = near_in_tiles(group[a:z], across[a:z], side[a:z], words[a:z], int(ms[a]), by_prefix[a:z])
            if len(i):
                one, two = np.concatenate([i, j]) + a, np.concatenate([j, i]) + a
                yield pa.RecordBatch.from_arrays(
                    [pa.array([words[k] for k in one.tolist()], pa.string()), pa.array([words[k] for k in two.tolist()], pa.string()), pa.array(n[two])],
                    names=["word", "near", "near_n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t = pa.Table.from_batches(held).combine_chunks()
        last = _last_group(t)
        if last:
            yield from compare(t.slice(0, last))
        held = t.slice(last).to_batches()
    if held:
        yield from compare(pa.Table.from_batches(held))


def _changes(v: pa.Array) -> np.ndarray:
    return pc.not_equal(v.slice(1), v.slice(0, len(v) - 1)).to_numpy(zero_copy_only=False)


def _last_group(t: pa.Table) -> int:
    """Where the last group of a sorted table begins."""
    at = 0
    for c in ("m", "by_prefix", "part", "one", "two"):
        ch = np.flatnonzero(_changes(t.column(c).chunk(0)))
        at = max(at, int(ch[-1]) + 1 if len(ch) else 0)
    return at


def near_pairs(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``vocab`` (word, n) that differ by one code point."""
    size = F.length("word")
    under = [F.struct((size + longer).alias("m"), F.lit(by_prefix).alias("by_prefix"),
                      (F.substring(F.col("word"), F.lit(1), F.floor((size + longer) / 2).cast("int")) if by_prefix
                       else F.right("word", F.floor((size + longer) / 2).cast("int"))).alias("part"))
             for longer in (0, 1) for by_prefix in (True, False)]
    rows = vocab.select("word", "n", F.explode(F.array(*under)).alias("k")).select("k.*", "word", "n")
    key = ["m", "by_prefix", "part"]
    # keys that need several blocks: at most one for every ``block`` code points, written so that their size is known
    large = materialize(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") * F.col("m") > block)
                        .select(*key, F.ceil(F.col("rows") * F.col("m") / block).cast("int").alias("blocks")), "spell-large")
    rows = rows.join(large, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = rows.select(*key, F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"),
                        (F.col("mine") > F.col("other")).cast("int").alias("side"), "word", "n")
    group = [*key, "one", "two"]
    dealt = tiles.repartition(*group).sortWithinPartitions(*group, "side")
    return dealt.mapInArrow(_near, "word string, near string, near_n long")


def spelling_groups(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, plant: bool = False) -> DataFrame:
    """Per word of the vocabulary: word, form, root, n, n_near, form_n."""
    vocab = materialize(vocabulary(docs, least_length, least_count, plant), "spell-words")
    best = near_pairs(vocab).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("near"))).alias("b"))
    formed = vocab.join(best, "word", "left").withColumn("takes", F.coalesce(-F.col("b.neg") >= ratio * F.col("n"), F.lit(False)))
    words = materialize(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("takes"), F.col("b.near")).alias("form"),
        F.when(F.col("takes"), -F.col("b.neg")).cast("long").alias("form_n")), "spell-forms")
    # pointer doubling: who has no form points nowhere; most words have none, so the pointers are few
    up = materialize(words.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spell-up")
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(up.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")), "spell-up")
        done = step.filter("moved").isEmpty()
        release(up)
        up = step.select("word", "root")
        up.written_path = step.written_path
        if done:
            break
    return words.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
