"""Incremental form of the CSV ingest: new files in a folder -> the ingest store.

Same parse as the batch ingest (``parse_lines``) into the same store, where every stream has a
folder of its own (``dest/streams/<name>``): the parquet file sink commits each micro-batch
through its log there, and batch ingests go to other folders, so neither hides the other's rows.

The checkpoint records which input files are done. By default it lies beside the data
(``dest/checkpoints/<name>``), so a restart finds it without being told; a lost executor or a
restarted driver re-runs the unfinished micro-batch without duplicating rows. A stream that has
written data is refused a new checkpoint: it would start to number its micro-batches again, and
the sink would take them for ones it already has and drop them.

Each micro-batch adds its own files to the days it touches. Larger triggers
(``max_files_per_trigger``, a longer ``processing_time``) mean fewer, bigger files; what has
been ingested is compacted by ``write_measurements(read_ingested(spark, dest).good, ...)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetlens.sources.commits import folder_exists
from fleetlens.sources.csv_ingest import parse_lines
from fleetlens.sources.store import store_rows, stream_path


def start_ingest_stream(
    spark: SparkSession,
    src_dir: str,
    dest: str,
    name: str = "landing",
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Start stream ``name`` into the store ``dest``; ``available_now`` processes what is there
    and stops. Started again it goes on where it stopped."""
    path = stream_path(dest, name)
    checkpoint = checkpoint or f"{dest.rstrip('/')}/checkpoints/{name}"
    # Spark's own files: the sink's log, and the query id that a checkpoint begins with
    if folder_exists(spark, f"{path}/_spark_metadata") and not folder_exists(
        spark, f"{checkpoint.rstrip('/')}/metadata"
    ):
        raise ValueError(
            f"stream {name!r} has already written to {path}, but there is no checkpoint of it at "
            f"{checkpoint}: new files would be dropped. Pass the checkpoint it ran with, or "
            "choose another name."
        )
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    out = store_rows(parse_lines(reader.load(src_dir), filter_barrier=False))
    writer = (
        out.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("status", "day")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
