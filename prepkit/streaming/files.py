"""Files that keep arriving, cleaned with values fitted beforehand.

The fits are batch jobs; what they yield are literals, so the row operators run on a
streaming frame as they are. Progress lives in the checkpoint, so a restarted or
retried run neither skips nor repeats a file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from prepkit.operators.profile import word_counts


def arriving_files(spark: SparkSession, folder: str, schema: str, fmt: str = "csv", files_per_batch: int = 1000,
                   **options: str) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.options(**options).load(folder)


def clean_arriving(
    stream: DataFrame, clean: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Apply a row operator to all files there now and append the rows to parquet, then stop.

    ``checkpoint`` holds the progress and goes with ``path``: each later run must name the
    same one, since the sink takes batches it already has as written.
    """
    writer = clean(stream).writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start(path)


def running_word_counts(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Token counts over all lines seen so far, as parquet in ``path``, written anew by each batch."""
    def put(counts: DataFrame, batch: int) -> None:
        counts.write.mode("overwrite").parquet(path)

    writer = word_counts(stream, "value").writeStream.outputMode("complete").foreachBatch(put)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
