"""Writers and readers: each query writes a driver table and returns what is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee import sources
from marquee.operators.factors import FactorModel
from marquee.plans.bindings.collab import item_factors
from marquee.plans.bindings.registry import Tables, query
from marquee.session import scratch_path

_DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sources.write_csv(t.documents, path)
    return sources.read_csv(t.spark, path, _DOCUMENTS)


@query("SELECT p_partkey, '[\"' || replace(p_name, ' ', '\",\"') || '\"]' AS words FROM part")
def csv_lists_as_json(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    sources.write_csv(t.part.select("p_partkey", F.split("p_name", " ").alias("words")), path)
    return sources.read_csv(t.spark, path, "p_partkey bigint, words string", multi_line=False)


@query(
    """
SELECT p_partkey, CASE WHEN p_size > 5 THEN p_size END AS p_size, p_name || ' "' AS p_name
FROM part
"""
)
def tsv_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tsv")
    rows = t.part.select(
        "p_partkey",
        F.when(F.col("p_size") > 5, F.col("p_size")).alias("p_size"),
        F.concat("p_name", F.lit(' "')).alias("p_name"),
    )
    sources.write_tsv(rows, path)
    return sources.land(
        sources.read_tsv(t.spark, path, "p_partkey bigint, p_size int, p_name string"),
        "part",
        partitions=8,
    )


@query("SELECT event_id, user_id, event_type, value, props, ts FROM events")
def json_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json")
    sources.write_json(t.events, path)
    return sources.read_json(
        t.spark,
        path,
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string",
    )


@query("SELECT conv_id, turn, role, text FROM conversations")
def table_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "table")
    sources.write_table(t.conversations, path)
    return sources.read_table(t.spark, path).select("conv_id", "turn", "role", "text")


@query(
    """
SELECT vec_id AS item_id, 0.0::DOUBLE AS bias, CAST(len(embedding) AS INTEGER) AS rank,
  round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total
FROM embeddings
"""
)
def model_round_trip(t: Tables) -> DataFrame:
    items = item_factors(t).withColumn("bias", F.lit(0.0)).select("item_id", "bias", "features")
    users = items.withColumnRenamed("item_id", "user_id")
    path = scratch_path(t.spark, "model")
    FactorModel(t.part.agg(F.avg("p_size").alias("mean")), users, items).save(path)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return FactorModel.load(t.spark, path).items.select(
        "item_id", "bias", F.size("features").alias("rank"), F.round(total, 4).alias("total")
    )


@query(
    """
SELECT c_custkey, c_name FROM customer
WHERE c_nationkey % 3 = 0 AND c_custkey NOT IN (
  SELECT max(c_custkey) FROM customer WHERE c_nationkey % 3 = 0 GROUP BY c_nationkey)
"""
)
def json_list_files(t: Tables) -> DataFrame:
    """One file for each nation: a list of its customers but the last one for every third
    nation; for the others an empty list, or a single record, which is no list."""
    path = scratch_path(t.spark, "lists")
    record = F.struct("c_custkey", "c_name")
    last = F.max("c_custkey").over(Window.partitionBy("c_nationkey"))
    kept = t.customer.withColumn("last", last).filter("c_custkey < last or c_nationkey % 3 > 0")
    files = kept.groupBy("c_nationkey").agg(
        F.to_json(F.collect_list(F.when(F.col("c_nationkey") % 3 == 0, record))).alias("some"),
        F.to_json(F.max(record)).alias("one"),
    )
    text = F.when(F.col("c_nationkey") % 3 < 2, F.col("some")).otherwise(F.col("one"))
    files.select(text.alias("value"), "c_nationkey").write.partitionBy("c_nationkey").text(path)
    return sources.read_records(t.spark, path, "c_custkey bigint, c_name string").select(
        "c_custkey", "c_name"
    )
