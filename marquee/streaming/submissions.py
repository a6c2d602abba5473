"""The interaction log as it arrives: the batch operators applied to a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.operators import ratings
from marquee.sources import schemas


def submissions(
    spark: SparkSession, path: str, files_per_trigger: int = 1000, kind: str = "json"
) -> DataFrame:
    """Submissions landed as JSON lines (or files of another ``kind``), read as they appear."""
    return (
        spark.readStream.schema(schemas.SUBMISSIONS)
        .option("maxFilesPerTrigger", files_per_trigger)
        .format(kind)
        .load(path)
    )


def rating_log(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every rated film to a Parquet log, each exactly once.

    Keeps no state, so it runs for any number of users; ``ratings.current`` on the log
    gives the latest ratings.
    """
    return (
        ratings.explode_submissions(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def current_ratings(stream: DataFrame) -> DataFrame:
    """Latest rating of each user and film as an updating table.

    The state holds one rating per pair. Write it in update mode.
    """
    return ratings.current(ratings.explode_submissions(stream))
