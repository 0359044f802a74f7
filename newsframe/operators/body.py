"""Body detection by block scoring, on page trees.

Blocks are the candidate elements (p, pre, td, li, blockquote) outside junk (C13) in document
order. A block is kept when its stop-word count is above 2 and its link density is below one
half. Each kept block adds its score to its parent and half to its grandparent; the node
with the largest positive total (first on ties, by insertion order) is the body.

All of it is computed on a page's own row as arrays of its blocks: no shuffle and no join. The word
counts of the link density come with the nodes. Totals sort the contributions by
node, so each node's are one slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsframe.functions.memo import per_session
from newsframe.functions.stopwords import stop_words
from newsframe.operators.dom import node_runs, path_of
from newsframe.operators.fields import _let

# Fixed values (ours): candidate block tags.
BLOCK_TAGS = ["p", "pre", "td", "li", "blockquote"]
WORD_SPLIT_RE = r"[^\p{L}\p{N}']+"


def stopword_count(text_col, words) -> F.Column:
    """Number of word tokens (lower-cased) that are stop words."""
    toks = F.split(F.lower(text_col), WORD_SPLIT_RE)
    return F.size(F.filter(toks, lambda t: t.isin(*words))) if words else F.lit(0)


@per_session
def _kept_at(words: tuple[str, ...]) -> Column:
    """For each node of a page's row its block where it is a kept one, else null: whether a node was kept is one look-up by its id."""
    def block(n):
        density = F.when(n["words"] == 0, F.lit(1.0)).otherwise(n["link_words"] / n["words"])
        return F.struct(n["id"].alias("node_id"), n["parent"].alias("parent_id"), n["prev"].alias("prev_id"),
                        stopword_count(F.array_join(node_runs(n), " "), words).alias("stopwords"), density.alias("link_density"))
    # the density needs no text: it goes first
    def candidate(n):
        return n["tag"].isin(BLOCK_TAGS) & ~n["junk"] & (n["words"] > 0) & (n["link_words"] / n["words"] < 0.5)
    return F.transform(F.transform("nodes", lambda n: F.when(candidate(n), block(n))), lambda b: F.when(b["stopwords"] > 2, b))


def blocks_of(words: tuple[str, ...]) -> Column:
    """F16: the kept blocks of a page's row: (node_id, parent_id, prev_id, stopwords, link_density)."""
    return F.array_compact(_kept_at(words))


def scores_of(kept_at: Column) -> Column:
    """per kept block its rank ``i``, boost and truncated ``upscore``.

    boostable = the previous sibling element is itself a kept block;
    boost = 50 / k for the k-th boostable block; in pages with more than 15
    blocks the last quarter gets ``-b^2`` (or ``+5`` when ``b^2 > 40``) with
    ``b = N/4 - (N - i)``.
    """
    def ranked(kept):
        return F.transform(F.array_compact(kept), lambda b, i: F.struct(
            i.alias("i"), b["node_id"], b["parent_id"], b["stopwords"], F.get(kept, b["prev_id"]).isNotNull().alias("boostable")))

    def boosted(rk):
        # the boostable blocks are counted, then all are put in order again
        turns = F.sort_array(F.concat(
            F.transform(F.filter(rk, lambda b: b["boostable"]), lambda b, k: F.struct(b["i"].alias("i"), (k + 1).alias("turn"), b.alias("b"))),
            F.transform(F.filter(rk, lambda b: ~b["boostable"]), lambda b: F.struct(b["i"].alias("i"), F.lit(0).alias("turn"), b.alias("b")))))

        def score(b, turn, n):
            left = n - b["i"]
            bneg = n * 0.25 - left
            tail = (n > 15) & (left <= n * 0.25)
            boost = (F.when(tail, F.when(bneg * bneg > 40, F.lit(5.0)).otherwise(-(bneg * bneg)))
                     .when(b["boostable"], F.lit(50.0) / turn).otherwise(F.lit(0.0)))
            return F.struct(b["node_id"].alias("node_id"), b["parent_id"].alias("parent_id"), b["i"].alias("i"), n.alias("n"), b["stopwords"].alias("stopwords"),
                            b["boostable"].alias("boostable"), boost.alias("boost"), (b["stopwords"] + boost).cast("int").alias("upscore"))
        return F.transform(turns, lambda t: score(t["b"], t["turn"], F.size(rk)))
    return _let(kept_at, lambda kept: _let(ranked(kept), boosted))


def best_of(scores: Column) -> Column:
    """F18 on a page's scores: struct (node_id, score), or null without blocks.

    Parent gets ``upscore``, grandparent ``upscore / 2``; insertion order is
    ``2i`` / ``2i + 1``. Best = largest positive score, first inserted on
    ties; when no score is positive, the first parent.
    """
    def gift(node, seq, add):
        return F.struct(node.alias("node_id"), seq.alias("seq"), add.cast("double").alias("add"))
    gifts = F.filter(F.flatten(F.transform(scores, lambda s: F.array(
        gift(s["parent_id"], s["i"] * 2, s["upscore"]), gift(F.get("nodes", s["parent_id"])["parent"], s["i"] * 2 + 1, s["upscore"] / 2.0)))),
        lambda g: (g["seq"] % 2 == 0) | (g["node_id"] >= 0))

    def totals(sorted_gifts, starts):
        def total(a, k):
            mine = F.slice(sorted_gifts, a + 1, F.coalesce(F.get(starts, k + 1), F.size(sorted_gifts)) - a)
            return _let(mine, lambda m: F.struct(F.aggregate(m, F.lit(0.0), lambda t, g: t + g["add"]).alias("score"), F.get(m, 0)["seq"].alias("seq"), F.get(m, 0)["node_id"].alias("node_id")))
        return F.transform(starts, total)

    def pick(t):
        order = F.transform(t, lambda x: F.struct((x["score"] > 0).alias("pos"), F.when(x["score"] > 0, x["score"]).otherwise(F.lit(0.0)).alias("s"),
                                                  (-x["seq"]).alias("first"), x["node_id"].alias("node_id"), x["score"].alias("score")))
        return _let(F.array_max(order), lambda b: F.when(b.isNotNull(), F.struct(b["node_id"].alias("node_id"), b["score"].alias("score"))))

    def summed(g):
        starts = F.filter(F.transform(g, lambda x, i: F.when((i == 0) | (F.get(g, i - 1)["node_id"] != x["node_id"]), i)), lambda i: i.isNotNull())
        return _let(starts, lambda st: pick(totals(g, st)))
    return _let(F.sort_array(gifts), summed)


@per_session
def _body_columns(words: tuple[str, ...]) -> list[tuple[str, Column]]:
    top = F.col("top").isNotNull()
    return [("scores", scores_of(_kept_at(words))), ("_best", best_of(F.col("scores"))), ("top", F.get("nodes", F.col("_best.node_id"))),
            ("text_path", F.when(top, F.concat(path_of(F.col("top.id")), F.lit("//text()")))),
            ("text", F.when(top, F.array_join(F.transform(node_runs(F.col("top")), lambda r: F.concat(r, F.lit("\n"))), "")))]


def _words(language: str, words: list[str] | None) -> tuple[str, ...]:
    return tuple(words) if words is not None else tuple(stop_words(language))


def with_body(trees: DataFrame, language: str = "en", words: list[str] | None = None, text: bool = True) -> DataFrame:
    """Adds ``scores`` (F17), ``top`` (F18: the best node), ``top_score``, ``text_path`` and, on request, ``text`` (F19) to the rows of ``trees``."""
    df = trees
    for name, column in _body_columns(_words(language, words)):
        if text or name != "text":
            df = df.withColumn(name, column)
    return df.withColumn("top_score", F.col("_best.score")).drop("_best")


# the same as rows ---------------------------------------------------------

def text_blocks(trees: DataFrame, language: str = "en", words: list[str] | None = None) -> DataFrame:
    """F16: kept blocks ``(page_id, node_id, parent_id, prev_id, stopwords, link_density)``."""
    return trees.select("page_id", F.inline(blocks_of(_words(language, words))))


def block_scores(trees: DataFrame, language: str = "en", words: list[str] | None = None) -> DataFrame:
    """F17 as rows."""
    return with_body(trees, language, words, text=False).select("page_id", F.inline("scores"))


def best_node(trees: DataFrame, language: str = "en", words: list[str] | None = None) -> DataFrame:
    """``(page_id, top_id, top_score, text_path)`` of pages with a body."""
    return with_body(trees, language, words, text=False).filter("top IS NOT NULL") \
        .select("page_id", F.col("top.id").alias("top_id"), "top_score", "text_path")


def body_text(trees: DataFrame, language: str = "en", words: list[str] | None = None) -> DataFrame:
    """the text runs under the best node, each followed by a newline
    (the node's own tail excluded)."""
    return with_body(trees, language, words).filter("top IS NOT NULL").select("page_id", "text")
