"""Quality rules: a threshold table compiled into one projection (operator 4).

Every figure of a document (lengths, symbols, stop words, lines, repetitions) is
an expression of Spark SQL functions, and every rule a row of ``RULES``: a figure, the bounds
between which it passes, and the least number of words from which it applies. The table is compiled into
one ``select`` over the documents: no user function, no shuffle, no join.

Defined results: null, empty and blank texts have no words, fail the base rule and
are not kept; rows are judged each on its own, so null or repeated ids do not
matter; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsframe.llm.native import BLANKS, WS, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
STOP_WORDS = ("the of and to a in is that der die und das ist nicht mit von le la les de des et un une que "
              "el los las en y por con para").split()

#: figure, least, most, from how many words on the rule applies
RULES: list[tuple[str, float | None, float | None, int]] = [
    ("mean_word_length", 2.0, 16.0, 20),
    ("symbols_per_word", None, 0.4, 20),
    ("marks_per_word", None, 0.5, 20),
    ("upper_share", None, 0.6, 20),
    ("digit_share", None, 0.4, 20),
    ("dup_line_share", None, 0.5, 20),
    ("ellipsis_line_share", None, 0.5, 20),
    ("bullet_line_share", None, 0.9, 20),
    ("stop_words", 1.0, None, 100),
]


def _removed(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeat_words(w: Column, size: int = WINDOW) -> Column:
    """Words covered by windows of ``size`` words that occur twice or more. Windows are
    compared by a 64-bit hash; equal ones meet by sorting (hash, place)."""
    def of_hashes(h):
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        starts = let(pairs, lambda s: F.sort_array(F.array_distinct(F.flatten(F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
            lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))))
        covered = let(starts, lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(size), F.coalesce(b - a, F.lit(size)))), F.lit(0), lambda acc, x: acc + x))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered)
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, size)))
    return F.when(F.size(w) <= size, F.lit(0)).otherwise(let(hashes, of_hashes)).cast("long")


def figures(text: Column) -> Column:
    """All figures of a text as a struct."""
    def of_words(w):
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")

        def of_lines(ls):
            n = F.size(w).cast("long")
            chars = (F.length(text) - _removed(text, BLANKS)).cast("long")
            one = F.greatest(F.size(ls), F.lit(1))
            dup = (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
            per_word, per_char = F.greatest(n, F.lit(1)), F.greatest(chars, F.lit(1))
            return F.struct(
                n.alias("n_words"), chars.alias("word_chars"), _removed(text, SYMBOLS).cast("long").alias("n_symbols"), dup.alias("n_dup_lines"),
                repeat_words(w).alias("n_repeat_words"), (chars / per_word).alias("mean_word_length"),
                (_removed(text, SYMBOLS) / per_word).alias("symbols_per_word"), (_removed(text, "!?") / per_word).alias("marks_per_word"),
                (_removed(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / per_char).alias("upper_share"), (_removed(text, "0123456789") / per_char).alias("digit_share"),
                (dup / one).alias("dup_line_share"),
                (F.size(F.filter(ls, lambda x: F.rtrim(x).endswith("..."))) / one).alias("ellipsis_line_share"),
                (F.size(F.filter(ls, lambda x: x.rlike(f"^{WS}*[-*•]{WS}"))) / one).alias("bullet_line_share"),
                F.size(F.array_intersect(F.split(F.lower(text), f"({WS}|[.,;:!?])+"), F.array(*[F.lit(s) for s in STOP_WORDS]))).cast("double").alias("stop_words"))
        return let(lines, of_lines)
    return let(words(text), of_words)


def verdict(f: Column, rules=RULES) -> Column:
    """The rule table as one boolean expression over the figures ``f``."""
    ok = F.lit(True)
    for name, low, high, least in rules:
        good = F.lit(True)
        if low is not None:
            good &= f[name] >= low
        if high is not None:
            good &= f[name] <= high
        ok &= (f["n_words"] < least) | good
    return ok


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and the remaining figures of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select("doc_id", figures(text).alias("f"))
    failed = (F.col("f.n_words") < 20) | (F.col("f.n_repeat_words") * 100 > F.col("f.n_words") * 30)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return src.select("doc_id", *[F.col(f"f.{c}").alias(c) for c in base], failed.alias("base_failed"),
                      (~failed & verdict(F.col("f"), rules)).alias("kept"), *[F.col(f"f.{r[0]}").alias(r[0]) for r in rules])
