"""Landing directory → daily compile, as a Structured Streaming query.

* ``readStream`` picks up newly landed article files (Parquet or JSON) with
  an explicit schema; ``maxFilesPerTrigger`` bounds a micro-batch.
* Optional ``dropDuplicatesWithinWatermark`` on the lower-cased title drops
  copies that land in different batches within the watermark delay.
* ``foreachBatch`` runs the batch operators unchanged (tag → clean → new
  titles only) against the stored content plus earlier epochs, and writes
  the epoch to its own folder with ``overwrite``: a retried epoch (executor or
  driver loss) replaces its own output instead of appending twice, and the
  checkpoint in the cluster's shared ``spark.checkpoint.dir`` records which
  files each epoch consumed.
* ``start_cap_stream`` adds the landed files' lengths to a ``CapState``; a
  daily stream that is given the state has the cap of all that ever landed,
  however the files are dealt to triggers.
* With an ``index`` of stored titles an epoch reads keys, not content.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsflow.operators.cap_state import CapState
from newsflow.operators.key_index import KeyIndex
from newsflow.plans.daily import compile_new_articles
from newsflow.session import checkpoint_dir
from newsflow.sources.readers import path_exists


def landing_stream(
    spark: SparkSession, landing_dir: str, schema, fmt: str = "parquet", max_files_per_trigger: int = 1000
) -> DataFrame:
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(landing_dir)
    )


def dedup_titles_within(stream: DataFrame, delay: str) -> DataFrame:
    """Drop later copies of a (case-insensitive) title that arrive within ``delay``."""
    return (
        stream.withColumn("_ingested_at", F.current_timestamp())
        .withColumn("_title_key", F.lower("title"))
        .withWatermark("_ingested_at", delay)
        .dropDuplicatesWithinWatermark(["_title_key"])
        .drop("_title_key", "_ingested_at")
    )


def start_daily_stream(
    spark: SparkSession,
    stream: DataFrame,
    content: DataFrame,
    ref_tags: DataFrame,
    output_path: str,
    order: list[str | Column],
    keep: list[str] | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    on_epoch: Callable[[int, DataFrame], None] | None = None,
    cap: int | None = None,
    cap_state: CapState | None = None,
    index: KeyIndex | None = None,
) -> StreamingQuery:
    """Start the stream; new articles of epoch ``n`` land in ``output_path/epoch=n``.

    ``cap`` fixes the tagger's text cap for the life of the stream, ``cap_state`` takes it from
    the lengths of all that landed (run ``start_cap_stream`` over the same folder first); without
    either every micro-batch has its own, so what an article is tagged with depends on the trigger.
    ``index`` (``plans.daily.stored_titles``) stands for the stored titles and gets each epoch's own;
    an epoch only counts keys of earlier ones, so a retried one finds what it found before.
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/newsflow-daily"
    titles = content.select("title")

    def earlier_titles(epoch_id: int) -> DataFrame:
        if not path_exists(spark, output_path):
            return titles
        return titles.unionByName(spark.read.parquet(output_path).where(F.col("epoch") < epoch_id).select("title"))

    def process(batch: DataFrame, epoch_id: int) -> None:
        stored = titles if index is not None else earlier_titles(epoch_id)
        held = cap_state.fixed() if cap is None and cap_state is not None else cap
        new = compile_new_articles(batch, stored, ref_tags, order=order, keep=keep, cap=held, index=index, before_epoch=epoch_id)
        folder = f"{output_path}/epoch={epoch_id}"
        new.write.mode("overwrite").parquet(folder)
        if index is not None:
            index.append(spark.read.parquet(folder).select(F.col("title").alias("_stored_title")), epoch_id)
        if on_epoch is not None:
            on_epoch(epoch_id, new)

    return _start(stream, process, ckpt, available_now)


def start_cap_stream(spark: SparkSession, stream: DataFrame, state: CapState, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the stream that adds each epoch's lengths to ``state``; a retried epoch replaces its own."""
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/newsflow-cap"
    return _start(stream, state.add, ckpt, available_now)


def _start(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
