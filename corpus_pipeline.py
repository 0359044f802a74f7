"""A corpus from raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir) and returns what
it keeps of ``docs`` with all its columns, the last one the packed pieces. ``run`` writes
each stage's rows as Parquet in the shared checkpoint folder and reads them again for the
next. Null and repeated ids, null and empty texts, empty tables and further columns pass
through as the operators define; rows that a stage cannot judge are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.llm.common import materialize, sieved, table
from newsframe.llm.decontaminate import clean
from newsframe.llm.jaccard import jaccard_components
from newsframe.llm.packing import pack
from newsframe.llm.pii import sanitised
from newsframe.llm.toxicity import toxicity_scores

#: Some stages draw on models and statistics that SQL cannot express.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model does not predict as toxic."""
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), keep=docs.columns)
    return scored.filter("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the one with the
    smallest id. Texts without words are in no group; each stays."""
    tag = "_".join(["row", *docs.columns])  # a name that no column of docs has
    numbered = docs.withColumn(tag, F.monotonically_increasing_id())
    groups = jaccard_components(numbered.select(F.col(tag).alias("doc_id"), "text"), k=5, num=8, den=10)
    groups = groups.select(F.col("doc_id").alias(tag), F.col("component_id").alias(f"group_{tag}"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(tag))
    in_groups = materialize(numbered.select("doc_id", tag).join(groups, tag), "pipeline-groups")
    first = in_groups.groupBy(f"group_{tag}").agg(F.min_by(tag, order).alias(tag)).select(tag)
    # few rows go: only those that may be among them meet the list of them
    gone = materialize(in_groups.select(tag).join(first, tag, "left_anti"), "pipeline-gone")
    kept = sieved(numbered, gone, tag, f"gone_{tag}")
    maybe = kept.filter(f"`gone_{tag}`").join(gone, tag, "left_anti")
    return kept.filter(f"not `gone_{tag}`").unionByName(maybe).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data in ``text`` replaced; n_chars, where there is one, follows the text."""
    out = sanitised(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull() | F.col("n_chars").isNull(), F.col("n_chars")).otherwise(changed))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of 1024 ids."""
    return pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
