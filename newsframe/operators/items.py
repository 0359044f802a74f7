"""News items, validation, JSON messages and clone flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsframe.session import materialize

# Article flags of the item schema.
AFLAG_ORIGINAL, AFLAG_CLONE, AFLAG_TRANSLATED = 0, 1, 2

NEWS_ITEM_SCHEMA = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("aflag", T.IntegerType(), False),
    T.StructField("publish_date", T.LongType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
    T.StructField("url_image", T.StringType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
    T.StructField("url_page", T.StringType(), True),
    T.StructField("language", T.StringType(), True),
    T.StructField("ratings", T.DoubleType(), True),
    T.StructField("comments", T.ArrayType(T.StringType()), True),
])

REQUIRED = ["title", "publish_date", "content", "url_page"]


def content_hash(col) -> F.Column:
    """Identity of a content: MD5 of the lower-cased, whitespace-collapsed text."""
    return F.md5(F.lower(F.trim(F.regexp_replace(col, r"\s+", " "))))


def clone_flags(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """``aflag`` = 0 for the first copy of a content, 1 for later ones.

    The first position per content hash is a ``min`` aggregate over ``(id, hash)`` rows,
    combined map-side, so a content copied a million times ships one row per task. Only
    these first rows are joined back, on ``(id, hash)``: no join is keyed by a content, so
    neither a hot content nor the rows without content meet in one task. A row without
    content or without id is never a clone.
    """
    h = df.withColumn("content_hash", content_hash(text_col))
    first = h.select(order_col, "content_hash").filter(F.col("content_hash").isNotNull()) \
        .groupBy("content_hash").agg(F.min(order_col).alias(order_col)).withColumn("_first", F.lit(True))
    later = F.col("content_hash").isNotNull() & F.col(order_col).isNotNull() & F.col("_first").isNull()
    rest = [c for c in df.columns if c not in (order_col, "content_hash")]
    return h.join(first, [order_col, "content_hash"], "left").select(
        order_col, *rest, "content_hash",
        F.when(later, AFLAG_CLONE).otherwise(AFLAG_ORIGINAL).alias("aflag"))


def to_epoch(col) -> F.Column:
    """Publish date text -> epoch seconds (NULL when not a timestamp).

    A date or a time without a zone is read as UTC, so the result does not
    depend on the session time zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    zoned = (F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(c, F.lit("T00:00:00Z")))
             .when(c.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), c)
             .otherwise(F.concat(c, F.lit("Z"))))
    return F.unix_timestamp(F.try_to_timestamp(zoned))


def news_items(articles: DataFrame, category_col: str | None = None) -> DataFrame:
    """A3: project extracted articles to the 13-field item."""
    cat = F.col(category_col) if category_col else F.lit(None).cast("string")
    items = articles.select(
        F.nullif("title", F.lit("")).alias("title"),
        F.nullif(F.array_join("authors", ", "), F.lit("")).alias("author"),
        F.lit(AFLAG_ORIGINAL).alias("aflag"),
        to_epoch(F.nullif("publish_date", F.lit(""))).alias("publish_date"),
        cat.alias("category"),
        F.nullif("description", F.lit("")).alias("summary"),
        F.nullif("text", F.lit("")).alias("content"),
        F.lit(None).cast("string").alias("url_image"),
        F.col("tags").alias("tags"),
        F.col("url").alias("url_page"),
        F.nullif("meta_lang", F.lit("")).alias("language"),
        F.lit(None).cast("double").alias("ratings"),
        F.lit(None).cast("array<string>").alias("comments"),
        "page_id",
    )
    # the flags read the items twice: they are written once, and no cache is held
    flagged = clone_flags(materialize(items.drop("aflag"), "news-items"), "content", "page_id")
    return flagged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in NEWS_ITEM_SCHEMA],
                          "page_id")


def reject_reasons(items: DataFrame) -> DataFrame:
    """Adds ``reasons``: the required fields that are missing."""
    return items.withColumn("reasons", F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])))


def items_valid(items: DataFrame) -> DataFrame:
    return reject_reasons(items).filter(F.size("reasons") == 0).drop("reasons")


def items_rejected(items: DataFrame) -> DataFrame:
    """A4: items missing a required field, with the reasons."""
    return reject_reasons(items).filter(F.size("reasons") > 0)


def items_json(items: DataFrame) -> DataFrame:
    """A5: one JSON message per item (``to_json(struct(*))``); null fields
    are written as ``null`` so every message carries all 13 keys."""
    fields = [c for c in items.columns if c != "page_id"]
    return items.select("page_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
                        .alias("message"))


def write_items(items: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3 sink: Parquet partitioned by language."""
    items.write.mode(mode).partitionBy("language").parquet(path)


def write_messages(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5 sink: newline-delimited JSON text."""
    messages.select("message").write.mode(mode).text(path)


KAFKA_PROVIDER = "org.apache.spark.sql.kafka010.KafkaSourceProvider"


def kafka_available(spark) -> bool:
    """Whether the Kafka data source is on the classpath."""
    try:
        spark._jvm.java.lang.Class.forName(KAFKA_PROVIDER)
        return True
    except Exception:  # noqa: BLE001
        return False


def write_messages_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """A5 sink to a Kafka topic (key = page id, value = message); needs the
    spark-sql-kafka package on the cluster's classpath."""
    if not kafka_available(messages.sparkSession):
        raise RuntimeError("the Kafka data source is not on the classpath; "
                           "use write_messages() or add the spark-sql-kafka package")
    (messages.select(F.col("page_id").cast("string").alias("key"), F.col("message").alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())
