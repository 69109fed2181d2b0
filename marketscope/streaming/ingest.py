"""Incremental registry load as a file stream (the per-file append load, S1+S9).

New registry files dropped into a folder are picked up by a Structured
Streaming file source (fixed schema, suffix filter), blanks become '' and
the rows are appended to a Parquet table. The checkpoint (offsets + commit
log under the shared checkpoint folder) makes the load exactly-once across
restarts and lost executors: a file is either fully committed or re-read.

``trigger(availableNow=True)`` processes everything present, in bounded
micro-batches (``maxFilesPerTrigger``), then stops, which suits a monthly
snapshot drop; a long-running trigger suits continuous drops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketscope.session import shared_dir
from marketscope.sources import schemas as S
from marketscope.sources.registry import registry_csv_options


def stream_registry_files(spark: SparkSession, source: str, table: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the registry files of ``table`` in ``source``.

    The same dialect as the batch reader (multiLine: fields may hold newlines).
    Without ``max_files_per_trigger`` a batch takes all files that are new.
    """
    reader = (spark.readStream.schema(S.REGISTRY_SCHEMAS[table]).options(**registry_csv_options())
              .option("pathGlobFilter", "*" + S.REGISTRY_SUFFIX[table]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(source).na.fill("")


def ingest(spark: SparkSession, source: str, table: str, target: str | None = None,
           checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> str:
    """Append every new file of ``table`` to the Parquet table ``target``; returns it."""
    target = target or shared_dir(spark, f"stream_{table}")
    checkpoint = checkpoint or shared_dir(spark, f"stream_{table}_checkpoint")
    q = (stream_registry_files(spark, source, table, max_files_per_trigger)
         .writeStream.format("parquet").outputMode("append")
         .option("path", target).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return target
