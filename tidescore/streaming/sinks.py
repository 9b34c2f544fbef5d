"""Where results and bad rows go, and what a running stream reports."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

log = logging.getLogger("tidescore.streaming")

# Fixed value: seconds between micro-batches.
BATCH_SECONDS = 1


def paced(writer: DataStreamWriter, seconds: int = BATCH_SECONDS) -> DataStreamWriter:
    return writer.trigger(processingTime=f"{seconds} seconds")


def console(df: DataFrame, rows: int = 10) -> DataStreamWriter:
    """Print the head of every batch."""
    return df.writeStream.format("console").option("numRows", rows)


def discard(df: DataFrame) -> DataStreamWriter:
    """Compute everything, keep nothing."""
    return df.writeStream.format("noop")


def table(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append to a parquet folder with Spark's own commit log."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def good_and_bad(parsed: DataFrame, good_path: str, bad_path: str) -> DataStreamWriter:
    """Split parsed rows per batch: good rows to one folder, dead letters to another."""

    def run(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            batch.where("error IS NULL").drop("error").write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            batch.where("error IS NOT NULL").write.mode("overwrite").parquet(f"{bad_path}/batch={number}")
        finally:
            batch.unpersist()

    return parsed.writeStream.foreachBatch(run)


class ProgressLog(StreamingQueryListener):
    """One line each time another `every` records have been read."""

    def __init__(self, every: int = 10) -> None:
        self.every = every
        self.rows = 0
        self.lines = 0

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.id)

    def onQueryProgress(self, event) -> None:
        before, self.rows = self.rows, self.rows + event.progress.numInputRows
        if self.rows // self.every > before // self.every:
            self.lines += 1
            log.info("processed %d records", self.rows)

    def onQueryTerminated(self, event) -> None:
        log.info("stopped %s", event.id)
