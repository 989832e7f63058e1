"""Snapshot files as a stream: each file is loaded once, ever, tracked by the checkpoint."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartulary.functions.casts import date_in_name
from cartulary.sources.delimited import MOST_FILES, counts_by_file, delimited_options, files_counted, require_headers, row_digest
from cartulary.sources.layouts import Feed

BATCH = "batch"


def load_arrivals(
    spark: SparkSession,
    inbox: str,
    feed: Feed,
    table: str,
    checkpoint: str,
    run_id: str = "stream",
    files_per_batch: int = MOST_FILES,
) -> None:
    """Load every file that has arrived since the last call, then stop.

    Before a batch is written the headers of its files are checked; one that differs from the layout
    stops the stream with `LayoutDrift`, and the batch is due again. Rows go to `<table>/batch=<n>`,
    rows and corrupt rows by file to `<table>_files/batch=<n>`. The checkpoint names the batches that
    are done; one that is run again after a failure replaces its own folders, so nothing is
    added twice.
    """
    name = F.col("_metadata.file_name")
    rows = (
        spark.readStream.schema(feed.layout.raw_schema)
        .options(**delimited_options(feed), pathGlobFilter=feed.pattern, maxFilesPerTrigger=str(min(files_per_batch, MOST_FILES)))
        .csv(inbox)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            name.alias("_source_file"),
            date_in_name(name).alias("_reference_date"),
            F.current_timestamp().alias("_ingested_at"),
            F.lit(run_id).alias("_run_id"),
            row_digest(feed.layout.names).alias("_record_hash"),
        )
    )

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        require_headers(session, [unquote(row[0]) for row in batch.select("_path").distinct().collect()], feed)
        counts = Observation()
        counted = batch.drop("_path").observe(counts, files_counted().alias("files"))
        counted.write.mode("overwrite").partitionBy("_reference_date").parquet(f"{table}/{BATCH}={number}")
        found = [(file, *n, run_id) for file, n in counts_by_file(counts.get["files"]).items()]
        entries = session.createDataFrame(found, "file_name string, rows long, corrupt_rows long, run_id string")
        entries.coalesce(1).write.mode("overwrite").parquet(f"{table}_files/{BATCH}={number}")

    query = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
