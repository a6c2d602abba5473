import datetime as dt

import pytest

from marquee import streaming
from marquee.operators import ratings
from marquee.sources import schemas

RATED = "user_id string, item_id string, rating int, ts timestamp"
START = dt.datetime(2024, 1, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


@pytest.fixture
def table(spark, tmp_path):
    return streaming.RatingTable(spark, str(tmp_path / "table"), buckets=3)


def test_batches_end_up_as_the_latest_ratings(spark, table, rows):
    batches = [
        [("a", "1", 3, at(1)), ("a", "1", 4, at(2)), ("b", "2", 1, at(1))],
        [("a", "1", 5, at(0)), ("c", "1", 2, at(3))],  # an older rating comes later
        [],
        [("b", "2", 2, at(9)), ("b", "3", 2, at(9))],
    ]
    for number, batch in enumerate(batches):
        table.upsert(spark.createDataFrame(batch, RATED), number)
    events = spark.createDataFrame([r for b in batches for r in b], RATED)
    assert rows(table.read()) == rows(ratings.current(events))
    assert ("a", "1", 4, at(2)) in rows(table.read())


def test_a_replayed_batch_changes_nothing(spark, table, rows, tmp_path):
    first = spark.createDataFrame([("a", "1", 3, at(1)), ("b", "2", 1, at(1))], RATED)
    second = spark.createDataFrame([("a", "1", 4, at(2))], RATED)
    assert table.upsert(first, 0) > 0 and table.upsert(second, 1) == 1
    want = rows(table.read())
    versions = rows(table.versions())
    files = sorted(tmp_path.rglob("*.parquet"))
    assert table.upsert(first, 0) == 0 and table.upsert(second, 1) == 0
    assert rows(table.read()) == want
    assert rows(table.versions()) == versions and len(want) == 2
    assert sorted(tmp_path.rglob("*.parquet")) == files


def test_a_batch_that_died_halfway_is_not_seen_and_is_written_again(spark, table, tmp_path, rows):
    first = spark.createDataFrame([("a", "1", 3, at(1)), ("b", "2", 1, at(1))], RATED)
    table.upsert(first, 0)
    want = rows(table.read())
    # Files of batch 1 without the line that says so.
    half = spark.createDataFrame([("x", "9", 1, at(5))], RATED)
    for bucket in range(3):
        half.write.parquet(str(tmp_path / f"table/data/batch=1/bucket={bucket}"))
    assert rows(table.read()) == want
    table.upsert(spark.createDataFrame([("a", "1", 4, at(2))], RATED), 1)
    assert rows(table.read()) == [("a", "1", 4, at(2)), ("b", "2", 1, at(1))]


def submission(user, hours, film, stars):
    return (user, ratings.SUBMIT, {film: stars}, None, at(hours))


def test_a_stream_keeps_the_table_over_restarts(spark, tmp_path, table, rows):
    sent = [submission("a", 1, "1", 3), submission("b", 1, "2.0", 1), submission("a", 2, "1", 5)]
    inbox = str(tmp_path / "inbox")
    for n, one in enumerate(sent):
        spark.createDataFrame([one], schemas.SUBMISSIONS).write.mode("append").parquet(inbox)
        if n != 1:
            stream = streaming.submissions(spark, inbox, 1, "parquet")
            streaming.keep_current(stream, table, str(tmp_path / "progress")).awaitTermination()
    assert rows(table.read()) == [("a", "1", 5, at(2)), ("b", "2", 1, at(1))]


def test_repeated_and_late_submissions(spark, tmp_path, rows):
    """A repetition within the delay is dropped; what comes later than that is counted."""
    files = [
        [submission("a", 0, "1", 3), submission("a", 0, "1", 3), submission("a", 0, "1", 4)],
        [submission("b", 30, "2", 1), submission("a", 0, "1", 3)],
        [submission("b", 60, "2", 2)],
        [submission("c", 1, "5", 5), submission("b", 60, "2", 2)],  # 59 hours late
    ]
    inbox, log, progress = (str(tmp_path / n) for n in ("inbox", "log", "progress"))
    late = 0
    for batch in files:
        spark.createDataFrame(batch, schemas.SUBMISSIONS).coalesce(1).write.mode("append").parquet(inbox)
        stream = streaming.unique(streaming.submissions(spark, inbox, 1, "parquet"), "24 hours")
        query = streaming.rating_log(stream, log, progress)
        query.awaitTermination()
        late += streaming.late_rows(query)
    assert rows(spark.read.parquet(log)) == [
        ("a", "1", 3, at(0)), ("a", "1", 4, at(0)), ("b", "2", 1, at(30)), ("b", "2", 2, at(60)),
    ]
    assert late == 1
