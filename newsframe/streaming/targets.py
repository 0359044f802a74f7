"""Q3 with targets as messages.

A target message names a URL and whether it is an article or a site. ``answers`` gives
each message its answer from the table of known pages (Q1 for an article, Q2 for a site's host) as a JSON message (A5);
``target_stream`` serves a folder of arriving messages. A message that is delivered again within the
watermark's delay is answered once; the state that knows the message ids, the offsets and the commit log lie in the
shared folder, so a restarted stream goes on where it was. Every micro-batch overwrites its own folder of the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.functions.urls import url_netloc, url_valid
from newsframe.operators.sections import source_detect, spread_join
from newsframe.plans.detect import DEFAULT_LANGUAGE, detect_article
from newsframe.session import checkpoint_dir, materialize, release

TARGET_SCHEMA = "message_id string, url string, is_article boolean, sent timestamp"
#: Fields of an answer.
ANSWER = ["message_id", "url", "is_article", "error", "article", "templates"]
TEMPLATE = ["key", "title_path", "text_path", "author_path", "date_path"]


def answers(targets: DataFrame, pages: DataFrame, language: str | None = DEFAULT_LANGUAGE, sampling: int = 1,
            stop_words: list[str] | None = None) -> DataFrame:
    """One row (ANSWER) per row of ``targets`` (message_id, url, is_article).

    ``article`` holds the fields of Q1 for the first known page of the URL, ``templates`` those of the site's sections by key.
    ``error`` is ``bad_url``, ``no_page`` (an article URL without a known page), ``no_template`` (a site without any), or
    Q1's. Many messages for one URL read it once and are no hot key. A null ``is_article`` asks for a site, as the default of the API.
    """
    targets = targets.select("message_id", "url", F.coalesce("is_article", F.lit(False)).alias("is_article"))
    wanted, sites = targets.filter("is_article"), targets.filter("NOT is_article")

    # the narrow list of pages to read is written: its size is known, and the pages are broadcast-joined or shuffled once
    urls = materialize(wanted.filter(url_valid("url")).select("url").distinct(), "target-urls")
    ids = materialize(pages.select("page_id", "url").join(urls, "url", "left_semi").groupBy("url").agg(F.min("page_id").alias("page_id")), "target-pages")
    read = detect_article(pages.join(ids.select("page_id"), "page_id", "left_semi"), language, stop_words)
    fields = [c for c in read.columns if c not in ("url", "error")]
    found = read.select("url", F.col("error").alias("found_error"), F.struct(*fields).alias("article"))
    by_article = spread_join(wanted, found, "url", "message_id").withColumn("templates", F.lit(None)).select(
        "message_id", "url", "is_article",
        F.when(~url_valid("url"), "bad_url").when(F.col("article").isNull(), "no_page").otherwise(F.col("found_error")).alias("error"),
        F.when(F.col("found_error").isNull(), F.col("article")).alias("article"), "templates")

    # a host's templates are learned from all its known pages, whatever else is asked for with it
    hosts = materialize(sites.filter(url_valid("url")).select(url_netloc("url").alias("host")).distinct(), "target-hosts")
    known = pages.withColumn("host", url_netloc("url")).join(hosts, "host", "left_semi").drop("host")
    learned = source_detect(known, sampling, language, stop_words)
    by_host = learned.groupBy(F.split_part("key", F.lit("/"), F.lit(1)).alias("host")).agg(F.sort_array(F.collect_list(F.struct(*TEMPLATE))).alias("templates"))
    asked = sites.withColumn("host", url_netloc("url"))
    by_site = spread_join(asked, by_host, "host", "message_id").withColumn("article", F.lit(None)).select(
        "message_id", "url", "is_article", F.when(~url_valid("url"), "bad_url").when(F.col("templates").isNull(), "no_template").alias("error"),
        "article", F.when(url_valid("url"), F.col("templates")).alias("templates"))
    article, templates = by_article.schema["article"].dataType, by_site.schema["templates"].dataType
    return by_article.withColumn("templates", F.col("templates").cast(templates)).select(*ANSWER).unionByName(
        by_site.withColumn("article", F.col("article").cast(article)).select(*ANSWER))


def answer_messages(answered: DataFrame) -> DataFrame:
    """A5: each answer as one JSON text (null fields are left out)."""
    return answered.select(F.to_json(F.struct(*ANSWER)).alias("value"))


def target_stream(spark: SparkSession, folder: str, pages: DataFrame, sink: str, language: str | None = DEFAULT_LANGUAGE, sampling: int = 1,
                  stop_words: list[str] | None = None, checkpoint: str | None = None, delay: str = "1 day", max_files: int | None = None,
                  available_now: bool = True, name: str = "targets"):
    """Serve target messages (JSON lines of TARGET_SCHEMA) that arrive in ``folder``; answers are written as JSON lines under ``sink``.

    Messages are told apart by ``message_id`` under a watermark of ``delay`` on ``sent`` (null: the time of arrival): a repeated one within
    it is not answered again, and one that comes later than it is not answered at all (it must be sent anew).
    """
    reader = spark.readStream.schema(TARGET_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    messages = reader.json(folder).withColumn("sent", F.coalesce("sent", F.current_timestamp()))
    once = messages.withWatermark("sent", delay).dropDuplicatesWithinWatermark(["message_id"])

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        # the state is asked once; the answers read the written messages
        targets = materialize(batch.select("message_id", "url", "is_article"), "target-messages")
        if not targets.isEmpty():  # a batch may only move the watermark
            answer_messages(answers(targets, pages, language, sampling, stop_words)).write.mode("overwrite").text(f"{sink.rstrip('/')}/batch_id={epoch_id}")
        release(targets)

    writer = once.writeStream.foreachBatch(run_batch).outputMode("append").queryName(name) \
        .option("checkpointLocation", checkpoint or f"{checkpoint_dir(spark)}/{name}-stream")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
