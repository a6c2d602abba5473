"""The current ratings as a table that a stream keeps up to date, replays included.

The table is cut into buckets by a hash of user and film. A batch writes new versions of the
buckets it touches, under its own number, and then one file that says so. A bucket's version
is that of the last batch which said so: readers never see half a batch, a batch that died
is simply written again, and one that is replayed after it was finished changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators import ratings
from marquee.session import landed

BUCKETS = 64
RATING = "user_id string, item_id string, rating int, ts timestamp"
VERSION = "batch bigint, bucket int"


class RatingTable:
    """Latest rating of every user and film below ``path``.

    A bucket is rewritten whole by one task, so ``buckets`` should grow with the table; it
    is fixed when the table is made. One stream writes at a time. Versions that no bucket
    needs any more stay on disk.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self._data, self._said = f"{path}/data", f"{path}/versions"
        nothing = spark.createDataFrame([], RATING)
        nothing.write.mode("ignore").parquet(f"{self._data}/batch=-1/bucket=-1")
        spark.createDataFrame([], VERSION).write.mode("ignore").parquet(self._said)

    def versions(self) -> DataFrame:
        """(bucket, batch): the batch that wrote each bucket last."""
        said = self.spark.read.schema(VERSION).parquet(self._said)
        return said.groupBy("bucket").agg(F.max("batch").alias("batch"))

    def read(self) -> DataFrame:
        """(user_id, item_id, rating, ts) as of the last finished batch."""
        data = self.spark.read.schema(f"{RATING}, {VERSION}").parquet(self._data)
        # One row a bucket: a bounded table.
        return data.join(F.broadcast(self.versions()), ["batch", "bucket"]).drop("batch", "bucket")

    def _bucket(self) -> F.Column:
        return F.pmod(F.xxhash64("user_id", "item_id"), F.lit(self.buckets)).cast("int")

    def upsert(self, rated: DataFrame, batch: int) -> int:
        """Put the rating events ``rated`` of a numbered batch into the table; the number of
        buckets written. A batch that the table has is left alone."""
        said = self.spark.read.schema(VERSION).parquet(self._said)
        if not said.filter(F.col("batch") == batch).isEmpty():
            return 0
        named = rated.select("user_id", "item_id", F.col("rating").cast("int").alias("rating"), "ts")
        new = landed(ratings.current(named).withColumn("bucket", self._bucket()), "upsert")
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
        if not touched:
            return 0
        old = self.read().withColumn("bucket", self._bucket()).filter(F.col("bucket").isin(touched))
        both = old.drop("bucket").unionByName(new.drop("bucket"))
        merged = ratings.current(both).withColumn("bucket", self._bucket())
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self._data}/batch={batch}"
        )
        done = self.spark.createDataFrame([(batch, b) for b in touched], VERSION)
        done.coalesce(1).write.mode("append").parquet(self._said)
        return len(touched)


def keep_current(stream: DataFrame, table: RatingTable, checkpoint: str) -> StreamingQuery:
    """Bring the submissions that have arrived into the table, a batch at a time."""

    def put(batch: DataFrame, number: int) -> None:
        table.upsert(ratings.explode_submissions(batch), number)

    return (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def unique(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """Submissions without the repetitions of one that was sent before.

    A submission is the same if user, action, film, ratings and time are. Its key is kept
    for ``delay`` beyond the latest time seen; what comes later than that is dropped and
    counted (``late_rows``), so the state is bounded by the submissions of that time.
    """
    rated = F.to_json(F.array_sort(F.map_entries("ratings")))
    keys = ["username", "action", "movie_id", "ts", "_rated"]
    return (
        stream.withColumn("_rated", rated)
        .withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_rated")
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows a query has dropped because they came too late."""
    return sum(
        int(state.numRowsDroppedByWatermark)
        for progress in query.recentProgress
        for state in progress.stateOperators
    )
