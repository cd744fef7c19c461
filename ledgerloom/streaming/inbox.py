"""Incremental CSV inbox (A11) as a Structured Streaming job.

The file source with ``trigger(availableNow=True)`` processes every file
that arrived since the last run exactly once (the checkpoint remembers
them), then stops; ``cleanSource=archive`` moves processed files out of
the inbox (after their batch commits, so the newest files may stay until
the next run — they are not read again either way). Each micro-batch is parsed with the same expressions as the
batch reader and written by ``foreachBatch`` into a folder named by the
batch id with overwrite, so a retried batch replaces its own output
instead of appending twice. Rejected lines go to a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.csv_inbox import bundled_lines, from_bundle, lines_of_text, parse_lines, raw_text_columns


def run_inbox_stream(spark: SparkSession, inbox_dir: str, bronze_dir: str, quarantine_dir: str,
                     checkpoint_dir: str, archive_dir: str, landed_at: str,
                     laid_out_by_name: bool = False, bundled: bool = False) -> None:
    """Process every file that arrived since the last run, once.

    A plain inbox holds the exports themselves (the file name is the account
    hint); ``laid_out_by_name`` reads an inbox partitioned into
    ``source_file=<name>`` folders instead, ``bundled`` one of files that hold
    many exports each (``drop_exports``)."""
    schema = "value string, source_file string" if laid_out_by_name else "value string"
    files = (from_bundle if bundled else raw_text_columns)(
        spark.readStream.format("text")
        .schema(schema)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", archive_dir)
        .load(inbox_dir))

    def write_batch(batch_df, batch_id: int) -> None:
        rows, rejected = parse_lines(lines_of_text(batch_df), F.lit(landed_at).cast("timestamp_ntz"))
        rows.write.mode("overwrite").parquet(f"{bronze_dir}/batch={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{quarantine_dir}/batch={batch_id}")

    q = (files.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def drop_exports(lines, inbox_dir: str) -> None:
    """Write export lines, in order, as bundles of exports: one file a task, as
    a file of its own for every small export costs more than its lines."""
    # Lines are cut after they are sorted, as several lines of an export may have one number.
    (bundled_lines(lines.repartition("source_file").sortWithinPartitions("source_file", "line_no"))
          .write.mode("overwrite").text(inbox_dir))
