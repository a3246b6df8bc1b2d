"""Incremental publishing: the report job over CSV files as they land.

The batch job (:func:`disclosure.plans.job.run`) re-reads the whole snapshot on every
refresh. When the source only ever *adds* files, the same report can be kept current with a
Structured Streaming query instead:

* source: the CSV file source over the landing folder, with the same explicit schema and
  reader options as the batch scan (``maxFilesPerTrigger`` bounds each micro-batch);
* transform: the unchanged :func:`loan_report` projection - a stateless, row-wise map, so
  there is no state store, no watermark and no shuffle;
* sink: the Parquet file sink, exactly once: the checkpoint records which source files were
  consumed and the sink's ``_spark_metadata`` log records which output files were committed,
  so a restarted or retried run neither skips nor duplicates a file.

``trigger(availableNow=True)`` processes everything that has landed and stops, so the query
can be scheduled like a batch job. The checkpoint belongs to the output: by default it is the
folder beside it, so every session and every run finds it again. A fresh checkpoint over an
output that already holds batches would number its batches from zero, which the output takes for
repeats and skips; that is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from disclosure.operators.report import loan_report
from disclosure.schema import LOAN_SCHEMA, SOURCE_DATE_FORMAT
from disclosure.session import create_exclusively, file_names, folder_exists, path_part, read_text
from disclosure.sources.listing import CSV_GLOB

_OUTPUT = "_output"  # in the checkpoint: the output it belongs to


def loan_stream(
    spark: SparkSession,
    landing: str,
    max_files_per_trigger: int | None = None,
    escape: str = '"',
    enforce_schema: bool = False,
) -> DataFrame:
    """Streaming DataFrame of the loan records in CSV files under ``landing`` (not recursive)."""
    reader = (
        spark.readStream.format("csv")
        .schema(LOAN_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("dateFormat", SOURCE_DATE_FORMAT)
        .option("escape", escape)
        .option("enforceSchema", enforce_schema)
        .option("pathGlobFilter", CSV_GLOB)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing)


def default_checkpoint(output: str) -> str:
    """The checkpoint folder beside ``output``, on the same file system."""
    return f"{output.rstrip('/')}__checkpoint"


def publish_stream(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    **stream_options,
) -> StreamingQuery:
    """Starts the incremental report query from ``landing`` into Parquet files at ``output``.

    With ``available_now`` (default) the query drains what has landed and stops; otherwise it
    runs continuously with ``processing_time`` micro-batches. A ``checkpoint`` that is not the
    one that ``output`` was written with is a ``ValueError``.
    """
    checkpoint = checkpoint or default_checkpoint(output)
    if folder_exists(spark, f"{output.rstrip('/')}/_spark_metadata") and not folder_exists(spark, checkpoint):
        raise ValueError(f"{output} holds batches of another checkpoint than {checkpoint}; new files would be skipped")
    own = path_part(output).rstrip("/")
    if _OUTPUT in file_names(spark, checkpoint):
        other = read_text(spark, f"{checkpoint.rstrip('/')}/{_OUTPUT}")
        if other != own:
            raise ValueError(f"The checkpoint {checkpoint} belongs to the output {other}, not {output}")
    else:
        create_exclusively(spark, f"{checkpoint.rstrip('/')}/{_OUTPUT}", own)
    writer = (
        loan_report(loan_stream(spark, landing, **stream_options))
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def publish_available(
    spark: SparkSession, landing: str, output: str, checkpoint: str | None = None, **stream_options
) -> DataFrame:
    """Drains newly landed files into ``output`` and returns the published report (batch read)."""
    query = publish_stream(spark, landing, output, checkpoint=checkpoint, available_now=True, **stream_options)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(output)
