"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.session import materialize, release

__all__ = ["batch_rows", "components", "fold", "lowered", "materialize", "release", "sieved", "table", "words_of"]

#: Words of 64 bits in the filter of ``sieved``.
SIEVE_WORDS = 1 << 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def batch_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries that run inside hand Python at most ``most`` rows at once: a batch of whole texts is held several times, by Spark and by
    the worker. A lower setting of the session stays as it is; after the queries the setting is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name, None)
    if was is not None and 0 < int(was) <= most:
        yield
        return
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, was)


def lowered(c: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(c, UPPER, LOWER)


def words_of(c: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text (null: none), without a user function."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % mod


def sieved(rows: DataFrame, ids: DataFrame, col: str, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: false where ``col`` is certainly not among ``ids`` (a column of that name). One bit
    of a filter of at most SIEVE_WORDS words stands for each id, so what is broadcast does not grow with the input; with very many ids it tells
    fewer rows apart. A join on ``col`` then needs only the flagged rows."""
    word = F.pmod(F.xxhash64(col), F.lit(SIEVE_WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{col}`, 1), 64) as int))")
    bits = ids.groupBy(word.alias(f"{flag}_w")).agg(F.bit_or(bit).alias(f"{flag}_b"))
    out = rows.withColumn(f"{flag}_w", word).join(F.broadcast(bits), f"{flag}_w", "left")
    return out.withColumn(flag, F.coalesce(F.col(f"{flag}_b").bitwiseAND(bit) != 0, F.lit(False))).drop(f"{flag}_w", f"{flag}_b")


def components(links: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of undirected ``links`` (a, b): rows (id, comp), comp the
    smallest id reachable; ids without a link to another id are absent. Rows with a null are no links.

    Each round every component hooks to its smallest neighbour, the hooks are followed to their roots by pointer
    jumping (a path of n hooks in log2 n steps), and the links are contracted. A node that does not become a root in a round is
    gone after it, and what stays beside one root hooks in the next round, so the rounds are logarithmic in
    the nodes as well and need no limit. The hooks of all rounds are composed at the end. Each step is written under
    the shared checkpoint folder; what no later step reads is deleted, and the tables that the result reads are
    listed in its ``written`` for the caller to release.
    """
    edges = materialize(links.filter("a <> b").select("a", "b").distinct(), f"{name}-e")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        sym = edges.union(edges.select("b", "a"))
        hook = sym.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m")).select("c", F.least("c", "m").alias("p"))
        hook = rooted(hook, name)
        hooks.append(hook)
        ha, hb = hook.select(F.col("c").alias("a"), F.col("p").alias("pa")), hook.select(F.col("c").alias("b"), F.col("p").alias("pb"))
        after = edges.join(ha, "a", "left").join(hb, "b", "left").select(
            F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).filter("a <> b").distinct()
        before, edges = edges, materialize(after, f"{name}-e")
        release(before)
    if not hooks:
        out = edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
        out.written = [edges]
        return out
    release(edges)
    out = hooks[0].select(F.col("c").alias("id"), F.col("p").alias("comp"))
    for hook in hooks[1:]:
        out = out.join(hook.select(F.col("c").alias("comp"), "p"), "comp", "left").select("id", F.coalesce("p", "comp").alias("comp"))
    out.written = hooks
    return out


def rooted(hook: DataFrame, name: str) -> DataFrame:
    """``hook`` (c, p), a forest whose roots point to themselves, with every pointer led to its root: each step doubles
    how far the pointers reach. The result is written."""
    written = None
    while True:
        up = hook.select(F.col("c").alias("p"), F.col("p").alias("q"))
        step = hook.join(up, "p", "left").select("c", F.coalesce("q", "p").alias("p"), F.coalesce(F.col("q") != F.col("p"), F.lit(False)).alias("moved"))
        step = materialize(step, f"{name}-h")
        if written is not None:
            release(written)
        if step.filter("moved").isEmpty():
            return step
        written, hook = step, step.select("c", "p")
