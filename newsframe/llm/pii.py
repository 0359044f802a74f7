"""Information-theoretic sanitisation of personal data (operator 3).

Base spans are e-mail addresses, IPv4 addresses, payment card and phone numbers. Their values are the
protected entities. The corpus then tells which terms reveal them: with N documents,
n(x) documents that hold x, a term t in a document with an entity e carries the pointwise mutual information
``log2(N n(t, e) / (n(t) n(e)))`` about it, out of at most ``log2(N / n(e))``. A term whose share of
that reaches ``disclose`` and that occurs with e in at least ``support`` different texts is
generalised wherever it stands in a document with e; from ``remove`` on it is removed. Both adjoin the base
spans as kind ``term``. A document holds a term wherever it stands; no span is put inside an e-mail address, which is covered as a whole.

Everything is DataFrame expressions. Texts are scanned once for the matches (written
with the texts that have one), once for the document counts of terms, which are summed before
the shuffle, and once more by ``sanitised``. Pairs of entities and terms are made only where they can count: n(t, e)
is at most n(e) and n(t), so an entity or term of too few texts has no support, and a share of ``disclose`` needs
``n(t) <= N (n(e) / N) ** disclose``.

Defined results: null and empty texts have no spans; rows are told apart by their place,
so null and repeated ids come back each with their own spans; an empty table gives an
empty result; other columns are kept by ``sanitised`` and ignored by ``pii_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsframe.llm.common import materialize, release
from newsframe.llm.native import matches, placed, span_list

# Each is the plain pattern in a form that scans a text once: possessive runs, and
# no second start within a run that has failed.
LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]
TERM = r"(?<![\p{L}\p{N}])\p{L}{4,40}(?![\p{L}\p{N}])"


def _valid():
    kind, value = F.col("kind"), F.col("value")
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    part = F.transform(F.split(value, "\\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(part, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (F.when(kind == "email", True).when(kind == "ip", small)
            .when(kind == "card", n.between(12, 19) & F.call_function("luhn_check", F.when(n.between(12, 19), digits).otherwise("1")))
            .otherwise(n.between(9, 15)))


def base_matches(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, context, text, found): one row per row of ``docs``, its candidate matches as an array, the text where it has any."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), matches(text, "ip", IP))
    none = F.array().cast("array<struct<kind:string,k:int,gap:int,len:int,value:string,left:string,right:string>>")
    found = F.concat(matches(text, "email", EMAIL), F.coalesce(ip, none), matches(text, "card", CARD), matches(text, "phone", PHONE))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64(text).alias("context"), text.alias("text"), found.alias("found"))
    return rows.withColumn("text", F.when(F.size("found") > 0, F.col("text")))


def entity_rows(found: DataFrame) -> DataFrame:
    """(rid, context, kind, start, end, entity) of the valid base matches."""
    rows = found.filter(F.size("found") > 0).select("rid", "context", F.explode("found").alias("m")).select("rid", "context", "m.*")
    return placed(rows).filter(_valid()).select("rid", "context", "kind", "start", "end", F.concat_ws(":", "kind", F.lower("value")).alias("entity"))


def document_terms(text) -> Column:
    """The distinct terms of a text, lower-cased."""
    pieces = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda p: p.rlike(r"^\p{L}{4,40}$"))
    return F.array_distinct(F.transform(pieces, F.lower))


def term_counts(docs: DataFrame, support: int) -> DataFrame:
    """(term, n): documents that hold each term, of the terms in at least ``support``."""
    terms = document_terms(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") >= support)


def terms_with(found: DataFrame, entities: DataFrame, counts: DataFrame, n_docs: int, support: int, disclose: float) -> DataFrame:
    """(rid, context, entity, ne, term, n): every entity and term that a document holds both of, where the term can reveal the entity."""
    held = entities.select("rid", "context", "entity").distinct()
    per = held.groupBy("entity").agg(F.count("*").alias("ne"), F.countDistinct("context").alias("c"))
    per = materialize(per.filter((F.col("c") >= support) & (F.col("ne") < n_docs)).select("entity", "ne"), "pii-n")
    held = materialize(held.join(per, "entity"), "pii-held")
    release(per)

    def reach(ne):  # a little above the bound, for rounding
        return F.lit(n_docs * (1 + 1e-9)) * F.pow(F.col(ne) / F.lit(float(max(n_docs, 1))), F.lit(float(disclose)))
    most = held.groupBy("rid").agg(F.max("ne").alias("most"))
    texts = found.filter("text IS NOT NULL").select("rid", "text").join(most, "rid")
    terms = texts.select("rid", "most", F.explode(document_terms(F.col("text"))).alias("term"))
    terms = terms.join(counts, "term").filter(F.col("n") <= reach("most")).select("rid", "term", "n")
    pairs = materialize(held.join(terms, "rid").filter(F.col("n") <= reach("ne")).select("rid", "context", "entity", "ne", "term", "n"), "pii-pairs")
    release(held)
    return pairs


def disclosing(pairs: DataFrame, n_docs: int, support: int, disclose: float) -> DataFrame:
    """(entity, term, share): terms that reveal an entity, by their share of its information."""
    pair = (pairs.groupBy("entity", "ne", "term", "n").agg(F.countDistinct("context").alias("c"), F.count("*").alias("nte"))
            .filter(F.col("c") >= support))
    n = F.lit(float(max(n_docs, 1)))
    share = F.log2(n * F.col("nte") / (F.greatest("n", "nte") * F.col("ne"))) / F.log2(n / F.col("ne"))
    return pair.select("entity", "term", share.alias("share")).filter(F.col("share") >= disclose)


def term_spans(found: DataFrame, told: DataFrame) -> DataFrame:
    """(rid, start, end, share): the places of the terms of ``told`` (rid, term, share) in their documents."""
    texts = found.filter("text IS NOT NULL").join(told.select("rid").distinct(), "rid", "left_semi")
    rows = texts.select("rid", F.explode(matches(F.col("text"), "term", f"{EMAIL}|{TERM}")).alias("m")).select("rid", "m.*")
    rows = placed(rows).filter(~F.col("value").contains("@")).select("rid", F.lower("value").alias("term"), "start", "end")
    return rows.join(told, ["rid", "term"]).select("rid", "start", "end", "share")


def pii_spans(docs: DataFrame, support: int = 2, disclose: float = 0.8, remove: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """The rows (rid, doc_id) of ``docs``, and their spans (rid, kind, start, end, base, removed)."""
    found = materialize(base_matches(docs), "pii-found")
    entities = materialize(entity_rows(found), "pii-ent")
    counts = materialize(term_counts(docs, support), "pii-terms")
    n_docs = found.count()
    pairs = terms_with(found, entities, counts, n_docs, support, disclose)
    told = pairs.join(disclosing(pairs, n_docs, support, disclose), ["entity", "term"]).groupBy("rid", "term").agg(F.max("share").alias("share"))
    told = materialize(told, "pii-told")
    extra = term_spans(found, told)
    spans = entities.select("rid", "kind", "start", "end", F.lit(True).alias("base"), F.lit(False).alias("removed")).unionByName(
        extra.select("rid", F.lit("term").alias("kind"), "start", "end", F.lit(False).alias("base"), (F.col("share") >= remove).alias("removed")))
    spans = materialize(spans, "pii-spans")
    rows = materialize(found.select("rid", "doc_id"), "pii-rows")
    release(found, entities, counts, pairs, told)
    return rows, spans


def pii_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans of every row of ``docs``."""
    rows, spans = pii_spans(docs, **how)
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}")
    per = spans.groupBy("rid").agg(*[count(k) for k in KINDS], F.count(F.when(~F.col("base"), 1)).alias("n_term"),
                                   span_list(KINDS, F.col("base")).alias("b"), span_list([*KINDS, "term"]).alias("spans"))
    zero = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.join(per, "rid", "left").select("doc_id", *zero, F.sha2(text("b"), 256).alias("base_sha256"), text("spans").alias("spans"),
                                                F.coalesce("n_term", F.lit(0)).cast("long").alias("n_term"))


def sanitised(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced by their kind (removed terms by nothing)."""
    _, spans = pii_spans(docs, **how)
    w = Window.partitionBy("rid").orderBy("start", F.col("end").desc(), "kind")
    # a span inside an earlier one is covered by it; an overlapping one loses its beginning
    spans = spans.withColumn("reach", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("start", F.greatest("start", F.coalesce("reach", "start"))).filter("start < end")
    per = spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end", F.when(F.col("removed"), "").otherwise(
        F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).alias("put")))).alias("cuts"))
    tag = "_" + "_".join(docs.columns)  # a name that no column of docs has
    per = per.select(F.col("rid").alias(f"rid{tag}"), F.col("cuts").alias(f"cuts{tag}"))
    rows = docs.withColumn(f"rid{tag}", F.monotonically_increasing_id()).join(per, f"rid{tag}", "left")
    cuts = F.col(f"cuts{tag}")
    state = F.struct(F.lit("").alias("out"), F.col("text").cast("string").alias("rest"), F.lit(0).cast("long").alias("at"))
    done = F.aggregate(cuts, state, lambda s, c: F.struct(
        F.concat(s["out"], F.substring(s["rest"], F.lit(1), (c["start"] - s["at"]).cast("int")), c["put"]).alias("out"),
        F.substring(s["rest"], (c["end"] - s["at"] + 1).cast("int"), F.length(s["rest"])).alias("rest"), c["end"].alias("at")),
        lambda s: F.concat(s["out"], s["rest"]))
    return rows.select(*[F.when(cuts.isNotNull(), done).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
