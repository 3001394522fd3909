"""Folders watched as streams: each file is taken once, over restarts too."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BINARY = "path string, modificationTime timestamp, length long, content binary"


def watch_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", files_a_batch: int = 100) -> DataFrame:
    """A stream of the files of a folder."""
    return spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch).load(folder)


def run_batches(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, progress: Callable[[int], None] | None = None) -> StreamingQuery:
    """Hands every micro-batch to `process` and stops when nothing is left; the checkpoint replaces looking for outputs.

    `progress` is called with the batch's number before it; the batch is read once, by `process`.
    """

    def each(batch: DataFrame, number: int) -> None:
        if progress:
            progress(number)
        process(batch, number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
