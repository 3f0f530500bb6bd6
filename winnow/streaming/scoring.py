"""Scoring of a stream with the unchanged batch chain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_record_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json",
                       files_per_batch: int | None = None) -> DataFrame:
    """New files in a folder, read with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(rows: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Apply a batch scoring function to a stream and append the results as parquet.

    The stages are row-local or stream-static joins, so the query keeps no state; the file
    sink and the checkpoint make each input file count once across restarts.
    """
    return (
        score(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def score_available(spark: SparkSession, rows: DataFrame, score: Callable[[DataFrame], DataFrame], out: str,
                    checkpoint: str) -> DataFrame:
    """Score everything that has arrived and read the result back."""
    query = score_stream(rows, score, out, checkpoint)
    query.awaitTermination()
    return spark.read.parquet(out)
