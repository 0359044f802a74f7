"""Span finding and array helpers made of Spark SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
WS = "[\\x20\\x09-\\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (a lambda's variable is not
    inlined, a projected column may be)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text that is not null."""
    return let(F.btrim(text, F.lit(BLANKS)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS + "+")))


def matches(text: Column, kind: str, pattern: str, around: int = 0) -> Column:
    """All leftmost non-overlapping matches as an array of (kind, k, gap, len, value, left, right):
    gap is the number of code points between the previous match and this one, left
    and right the ``around`` code points of the gaps on both sides."""
    empty = F.array().cast("array<struct<kind:string,k:int,gap:int,len:int,value:string,left:string,right:string>>")

    def found(m: Column) -> Column:
        def item(gaps):
            return F.transform(m, lambda x, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("k"), F.length(F.get(gaps, i)).alias("gap"), F.length(x).alias("len"), x.alias("value"),
                (F.right(F.get(gaps, i), F.lit(around)) if around else F.lit("")).alias("left"),
                (F.left(F.get(gaps, i + 1), F.lit(around)) if around else F.lit("")).alias("right")))
        return let(F.split(text, pattern, -1), item)
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)).otherwise(empty)


def placed(rows: DataFrame, key: str = "rid") -> DataFrame:
    """Adds start and end (code points) to exploded matches (``key``, kind, k, gap, len, ...)."""
    w = Window.partitionBy(key, "kind").orderBy("k")
    start = F.sum(F.col("gap") + F.col("len")).over(w) - F.col("len")
    return rows.withColumn("start", start.cast("long")).withColumn("end", (start + F.col("len")).cast("long"))


def span_list(order: list[str], only: Column | None = None) -> Column:
    """Aggregate: kind:start:end of the rows by start, then kind as listed, comma-joined."""
    rank = F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind"))
    one = F.struct(F.col("start"), rank.alias("r"), F.col("end"), F.col("kind"))
    got = F.sort_array(F.collect_set(one if only is None else F.when(only, one)))
    return F.concat_ws(",", F.transform(got, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
