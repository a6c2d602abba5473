import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from marquee import session, sizing, sources, streaming
from marquee.operators import ratings


def test_tsv(spark, tmp_path, rows):
    path = tmp_path / "x.tsv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write('a\tb\n1\t\\N\n2\tsay "hi\n3\tNA\n')
    df = sources.read_tsv(spark, str(path), "a int, b string")
    assert rows(df) == [(1, None), (2, 'say "hi'), (3, "NA")]
    assert rows(sources.land(df, "x", partitions=3)) == rows(df)


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, 'a "b"\n c,', ["x", "y"]), (2, " pad ", None)], "a int, b string, c array<string>"
    )
    sources.write_csv(df, str(tmp_path / "csv"))
    back = sources.read_csv(spark, str(tmp_path / "csv"), "a int, b string, c string")
    assert rows(back) == [(1, 'a "b"\n c,', '["x","y"]'), (2, " pad ", None)]


def test_records(spark, tmp_path, rows):
    (tmp_path / "list.json").write_text(json.dumps([{"username": "a"}, {"username": "b"}]))
    (tmp_path / "error.json").write_text(json.dumps({"error": "no list"}))
    got = sources.read_records(spark, str(tmp_path), "username string, name string")
    assert rows(got) == [("a", None), ("b", None)]


def test_table_and_preview(spark, tmp_path, rows):
    df = spark.range(50).select(F.col("id"), F.array(F.lit("a"), F.lit(None)).alias("l"))
    sources.write_table(df, str(tmp_path / "t"))
    back = sources.read_table(spark, str(tmp_path / "t"))
    assert rows(back) == rows(df) and dict(back.dtypes)["l"] == "array<string>"
    assert [r["id"] for r in sources.preview(back, 3, keys=["id"]).collect()] == [0, 1, 2]
    one = sources.preview(back, 5, "random", 1, ["id"]).collect()
    assert one == sources.preview(back.repartition(3), 5, "random", 1, ["id"]).collect()


def test_shared_folder_is_the_configured_one(spark):
    path = session.shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or path == configured
    assert session.scratch_path(spark, "x").startswith(path.rstrip("/"))


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(100)
    plan = lambda d: d._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(sizing.broadcast_if_small(df)).lower()
    assert sizing.broadcast_if_small(df, max_bytes=10) is df


def test_rating_stream(spark, tmp_path, rows):
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    inbox.mkdir()

    def submit(name, *records):
        lines = [
            json.dumps(
                {
                    "username": u,
                    "action": "submit_ratings",
                    "ratings": {film: score},
                    "ts": dt.datetime(2024, 1, 1, hour).isoformat(),
                }
            )
            for u, film, score, hour in records
        ]
        (inbox / name).write_text("\n".join(lines))

    def run():
        stream = streaming.submissions(spark, str(inbox))
        streaming.rating_log(stream, log, str(tmp_path / "ck")).awaitTermination()

    submit("1.json", ("u", "1", 3, 1), ("u", "2", 4, 1))
    run()
    submit("2.json", ("u", "1.0", 5, 2), ("v", "1", 2, 0))
    run()
    events = spark.read.parquet(log)
    assert events.count() == 4
    want = [("u", "1", 5), ("u", "2", 4), ("v", "1", 2)]
    assert rows(ratings.current(events), "user_id", "item_id", "rating") == want

    live = streaming.current_ratings(streaming.submissions(spark, str(inbox)))
    query = (
        live.writeStream.format("memory").queryName("live").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("live"), "user_id", "item_id", "rating") == want


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Session:
    def __init__(self, master):
        self.sparkContext = _Context(master)
        self.conf = {}


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session(master))
