"""Q3: the stream form of article detection.

Pages arrive as Parquet files in a folder; each micro-batch runs the same
batch plan (F20) through ``foreachBatch`` and writes the articles to its own
``batch_id=<epoch>`` folder of a Parquet sink. The extraction is stateless
per page, so the stream result equals the batch result. The checkpoint
(offsets + commit log) replays an unfinished micro-batch after a restart,
and because each batch overwrites its own folder the replay is idempotent:
the sink is exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsframe.plans.article import article_extract
from newsframe.session import checkpoint_dir
from newsframe.sources import PAGES_SCHEMA


def page_stream(spark: SparkSession, folder: str, max_files: int | None = None,
                file_glob: str | None = None) -> DataFrame:
    """Pages arriving as Parquet files in ``folder``, which may be a pattern
    (only files whose own names match ``file_glob`` when given)."""
    reader = spark.readStream.schema(PAGES_SCHEMA)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def detect_stream(spark: SparkSession, folder: str, sink: str, language: str | None = "en",
                  checkpoint: str | None = None, available_now: bool = True, name: str = "detect",
                  file_glob: str | None = None, prepare=None):
    """Start the stream; returns the ``StreamingQuery``.

    ``available_now`` processes what is in the folder and stops (batch-like
    scheduling); otherwise a micro-batch runs as files arrive. ``prepare``
    (DataFrame -> DataFrame) runs on each micro-batch of pages first.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/{name}-stream"

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        if prepare is not None:
            batch = prepare(batch)
        # one folder per micro-batch, overwritten: a batch replayed after a
        # failure rewrites its own output instead of appending duplicates
        article_extract(batch, language).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={epoch_id}")

    writer = (page_stream(spark, folder, file_glob=file_glob).writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", ckpt).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def template_stream(spark: SparkSession, folder: str, templates: DataFrame, sink: str,
                    checkpoint: str | None = None, available_now: bool = True,
                    name: str = "templates", file_glob: str | None = None, prepare=None):
    """E6 on a stream: pages arriving in ``folder`` are read with the learned
    section templates (a static table, materialized once in the shared
    folder); each micro-batch writes its own ``batch_id=<epoch>`` folder.

    Template learning stays a batch job: it needs samples across a section.
    """
    from newsframe.operators.sections import apply_template
    from newsframe.session import materialize

    ckpt = checkpoint or f"{checkpoint_dir(spark)}/{name}-stream"
    static = materialize(templates, "stream-templates")

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        if prepare is not None:
            batch = prepare(batch)
        apply_template(batch, static).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={epoch_id}")

    writer = (page_stream(spark, folder, file_glob=file_glob).writeStream.foreachBatch(run_batch)
              .option("checkpointLocation", ckpt).queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
