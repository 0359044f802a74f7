"""E5 on a stream: section templates learned while pages arrive.

The state is a table keyed by section: the first ``sampling`` articles of each section (by page id, as E2 lists them),
each with what a template stores of it. A micro-batch is merged into it by aggregates and a rank limit; only pages that
enter a section's sample are parsed. The state of a section never holds more than ``sampling`` rows, whatever arrives, and
needs no timeout to stay bounded; a page that comes late still takes its place. So after any
order of files the learned templates are those of the batch plan (E8) over all pages.

Each micro-batch writes the state after it and the templates it changed to folders of its own, so a replayed batch
overwrites what it wrote. The state before a batch is kept until the batch after it is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsframe.functions import urls as U
from newsframe.operators.sections import TEMPLATE_SCHEMA_COLS, section_articles, section_process_all, section_sample, section_template
from newsframe.session import checkpoint_dir, delete_path, materialize, release
from newsframe.sources import PAGES_SCHEMA

#: What the state holds of a sampled article besides its section, URL and page id.
READ = "is_parsed boolean, title_path string, text_path string, author_path string, date_path string"
STATE_SCHEMA = "section_url string, url string, page_id long, " + READ
FIELDS = [f.split()[0] for f in READ.split(", ")]
#: A change of a key's template; without a template page the key has none any more.
CHANGE_SCHEMA = "key string, page_id long, title_path string, text_path string, author_path string, date_path string"


def first_articles(articles: DataFrame, sampling: int) -> DataFrame:
    """The first ``sampling`` rows of each section of ``articles`` (section_url, url, page_id), a URL
    that occurs again counted at its smallest page id."""
    once = articles.groupBy("section_url", "url").agg(F.min("page_id").alias("page_id"))
    # the partition of E3's own limit; it is pushed below the shuffle, so a hot section ships this many rows per task
    key = F.coalesce(U.article_key("url", True), U.article_key("url", False))
    first = Window.partitionBy("section_url", key).orderBy("page_id", "url")
    return once.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= sampling).drop("_r")


def next_state(state: DataFrame, batch: DataFrame, sampling: int, language: str | None, stop_words: list[str] | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The state after the pages of ``batch``, and the written tables that it reads. Pages without an id or a valid URL (U1) are skipped; a null
    text is a page that does not parse; a page id that comes again with its URL keeps what was read first."""
    pages = batch.filter("page_id IS NOT NULL").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    place = ["section_url", "url", "page_id"]
    arrived = section_articles(pages).select(*place)
    kept = materialize(first_articles(state.select(*place).unionByName(arrived), sampling), "learning-kept")
    new = materialize(kept.join(state.select(*place), place, "left_anti"), "learning-new")
    # the same page id can arrive under several URLs or rows; one of them is read
    todo = pages.join(new.select("page_id", "url"), ["page_id", "url"], "left_semi").groupBy("page_id", "url").agg(F.min("html").alias("html"))
    read = section_process_all(todo, new, language, stop_words=stop_words).select(
        *place, "is_parsed", "title_path", "text_path", F.get("author_paths", 0).alias("author_path"), "date_path")
    read = read.groupBy(*place).agg(*[F.min_by(c, F.struct(F.col("is_parsed").cast("int"), *FIELDS[1:])).alias(c) for c in FIELDS])
    return state.join(kept, place, "left_semi").select(*place, *FIELDS).unionByName(read), [kept, new]


def state_templates(state: DataFrame, sampling: int) -> DataFrame:
    """E5 of the sampled articles in ``state``: the rows (TEMPLATE_SCHEMA_COLS) of the keys that have a template."""
    samples = section_sample(state.select("page_id", "url"), sampling)
    read = state.select("url", "page_id", "is_parsed", "title_path", "text_path", F.array("author_path").alias("author_paths"), "date_path")
    return section_template(samples.join(read, ["url", "page_id"]))


def changed_templates(before: DataFrame, now: DataFrame) -> DataFrame:
    """Rows of ``now`` that ``before`` does not hold, and the keys that lost their template (all fields null)."""
    fields = TEMPLATE_SCHEMA_COLS[1:]
    old, new = before.select("key", F.struct(*fields).alias("was")), now.select("key", F.struct(*fields).alias("t"))
    return old.join(new, "key", "full").filter(~F.col("was").eqNullSafe(F.col("t"))).select("key", *[f"t.{c}" for c in fields])


def learning_stream(spark: SparkSession, folder: str, sink: str, language: str | None = "en", sampling: int = 1,
                    stop_words: list[str] | None = None, checkpoint: str | None = None, max_files: int | None = None,
                    available_now: bool = True, name: str = "learning", file_glob: str | None = None, prepare=None):
    """Learn templates from the pages (Parquet files) that arrive in ``folder``; returns the ``StreamingQuery``.

    ``sink``/templates/batch_id=N holds the templates that batch N made, changed or (without a page id) took back;
    ``learned_templates`` reads the present ones. ``sink``/state holds the sections' samples. The sink and
    the checkpoint belong together. A change of ``sampling`` needs new ones. ``prepare`` (DataFrame ->
    DataFrame) runs on each micro-batch of pages first.
    """
    if sampling < 1:
        raise ValueError("sampling must be >= 1")
    root = sink.rstrip("/")
    reader = spark.readStream.schema(PAGES_SCHEMA)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        if prepare is not None:
            batch = prepare(batch)
        at = f"{root}/state/batch_id="
        before = spark.read.schema(STATE_SCHEMA).parquet(f"{at}{epoch_id - 1}") if epoch_id else spark.createDataFrame([], STATE_SCHEMA)
        after, written = next_state(before, batch, sampling, language, stop_words)
        after.write.mode("overwrite").parquet(f"{at}{epoch_id}")
        release(*written)
        now = spark.read.schema(STATE_SCHEMA).parquet(f"{at}{epoch_id}")
        changed_templates(state_templates(before, sampling), state_templates(now, sampling)) \
            .write.mode("overwrite").parquet(f"{root}/templates/batch_id={epoch_id}")
        if epoch_id > 1:  # a replay of this batch needs the one before it only
            delete_path(spark, f"{at}{epoch_id - 2}")

    writer = reader.parquet(folder).writeStream.foreachBatch(run_batch).queryName(name) \
        .option("checkpointLocation", checkpoint or f"{checkpoint_dir(spark)}/{name}-stream")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def learned_templates(spark: SparkSession, sink: str) -> DataFrame:
    """The present template of each key that has one, from all batches written so far."""
    changes = spark.read.schema(CHANGE_SCHEMA + ", batch_id long").parquet(f"{sink.rstrip('/')}/templates")
    fields = TEMPLATE_SCHEMA_COLS[1:]
    last = changes.groupBy("key").agg(F.max_by(F.struct(*fields), "batch_id").alias("t"))
    return last.filter("t.page_id IS NOT NULL").select("key", *[f"t.{c}" for c in fields])
