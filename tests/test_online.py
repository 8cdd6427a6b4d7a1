"""Bucketed online tables: no shuffle of the table, filters in the scan, versions, restarts."""

import dataclasses
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from featurelake.operators import views as vw
from featurelake.operators.online import OnlineTable
from featurelake.session import scratch_dir

T0 = dt.datetime(2024, 1, 1)
VIEW = vw.FeatureView("v", vw.Entity("m", ("member_id",)), ("x",))
PAIR = dataclasses.replace(VIEW, entity=vw.Entity("pair", ("member_id", "place")))
FIELDS = "member_id long, place string, event_timestamp timestamp_ntz, created timestamp_ntz, x double"


def _rows(spark, n=2000):
    return spark.range(n).select(F.col("id").alias("member_id"), F.concat(F.lit("p"), F.col("id") % 3).alias("place"), F.lit(T0).cast("timestamp_ntz").alias("event_timestamp"),
                                 F.lit(T0).cast("timestamp_ntz").alias("created"), F.col("id").cast("double").alias("x"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _shuffles(plan):
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    return re.findall(r"\bExchange (\w+)\(([^)]*)\)", plan)


@pytest.mark.parametrize("point_keys", [0, 1000])
def test_lookups_shuffle_the_requests_alone(spark, point_keys):
    table = OnlineTable(spark, scratch_dir(spark, "online"), VIEW, buckets=8)
    table.write(_rows(spark).drop("place"))
    requests = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c"), (99999, "d"), (1999, "e")], "member_id long, note string")
    out = vw.online_features(requests, {"v": table.for_requests(requests, point_keys)}, (VIEW,))
    assert sorted((r["note"], r["x"]) for r in out.collect()) == [("a", 5.0), ("b", 5.0), ("c", None), ("d", None), ("e", 1999.0)]
    plan = _plan(out)
    shuffles = _shuffles(plan)
    assert len(shuffles) == 1 and shuffles[0][1].endswith(", 8")  # the requests, into the table's buckets
    formatted = out._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert ("SelectedBucketsCount: 3 out of 8" in formatted or "SelectedBucketsCount: 2 out of 8" in formatted) == bool(point_keys)
    assert ("In(member_id" in formatted) == bool(point_keys)


def test_files_carry_bloom_filters_and_one_file_per_bucket(spark):
    root = scratch_dir(spark, "online")
    table = OnlineTable(spark, root, VIEW, buckets=4)
    table.write(_rows(spark).drop("place"))
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{root.removeprefix('file:')}/data/v=0/*.parquet")
    assert len(files) == 4
    for f in files:
        ids = pq.read_table(f)["member_id"].to_pylist()
        assert ids == sorted(ids)
        size, held = 0, open(f, "rb").read()
        meta = pq.ParquetFile(f).metadata
        size = sum(meta.row_group(0).column(i).total_compressed_size for i in range(meta.num_columns))
        assert len(held) - size > 1024  # the Bloom filter of the key lies beside the columns


def test_versions_and_restarts(spark):
    root = scratch_dir(spark, "online")
    with pytest.raises(ValueError, match="nothing is online"):
        OnlineTable(spark, root, VIEW).read()
    assert OnlineTable(spark, root, VIEW, buckets=4).upsert(_rows(spark, 10).drop("place")) == 0
    late = spark.createDataFrame([(3, "x", T0 - dt.timedelta(days=1), T0, -1.0), (4, "x", T0 + dt.timedelta(days=1), T0, 40.0), (10, "x", T0, T0, 10.0)], FIELDS)
    assert OnlineTable(spark, root, VIEW, buckets=2).upsert(late) == 1
    table = OnlineTable(spark, root, VIEW)
    spark.sql(f"DROP TABLE {table._name(1)}")  # as in a session that has not written it
    again = table.read()
    assert {r["member_id"]: r["x"] for r in again.collect()} == {**{i: float(i) for i in range(10)}, 4: 40.0, 10: 10.0}
    requests = spark.range(20).withColumnRenamed("id", "member_id")
    out = vw.online_features(requests, {"v": table.for_requests(requests, 5)}, (VIEW,))
    assert out.filter("x IS NOT NULL").count() == 11
    out.collect()
    assert len(_shuffles(_plan(out))) == 1


def test_keys_of_two_columns(spark):
    table = OnlineTable(spark, scratch_dir(spark, "online"), PAIR, buckets=4)
    table.write(_rows(spark, 300))
    requests = spark.createDataFrame([(4, "p1"), (4, "p2"), (5, "p2"), (None, "p1"), (6, None)], "member_id long, place string")
    for n in (0, 10):
        out = vw.online_features(requests, {"v": table.for_requests(requests, n)}, (PAIR,))
        assert sorted((str(r["member_id"]), str(r["place"]), r["x"]) for r in out.collect()) == [
            ("4", "p1", 4.0), ("4", "p2", None), ("5", "p2", 5.0), ("6", "None", None), ("None", "p1", None)]
