"""Queries for trip preparation, splits and one-hot encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelake.operators import trips as tp
from featurelake.operators.vocabulary import OneHotTables
from featurelake.plans.catalog import query
from featurelake.session import scratch_dir
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table

VAL_FROM, TEST_FROM = "1999-01-01", "2000-01-01"


def prepared(spark, sf_dir):
    # The stand-in trips carry dates only, so the duration unit is days (1..60 kept).
    return tp.trip_prep(fx.trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime", unit="days")


@query("trip_prep")
def trip_prep(spark, sf_dir):
    return prepared(spark, sf_dir)


@query("trip_prep_minutes")
def trip_prep_minutes(spark, sf_dir):
    return tp.trip_prep(fx.minute_trips(spark, sf_dir), "lpep_pickup_datetime", "lpep_dropoff_datetime")


@query("trip_counts")
def trip_counts(spark, sf_dir):
    return tp.trip_counts(fx.trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime", unit="days")


@query("temporal_split")
def temporal_split(spark, sf_dir):
    return tp.temporal_split(prepared(spark, sf_dir), "pickup_datetime", VAL_FROM, TEST_FROM)


@query("hash_split")
def hash_split(spark, sf_dir):
    return tp.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 80)


@query("one_hot")
def one_hot(spark, sf_dir):
    data = tp.temporal_split(prepared(spark, sf_dir), "pickup_datetime", VAL_FROM, TEST_FROM)
    model = OneHotTables.fit(data.filter(F.col("split") == "train"), ["PU_DO"], scratch_dir(spark, "one-hot"))
    enc = model.transform(data.filter(F.col("split") != "train"), ["trip_distance"])
    return enc.select("PU_DO", "trip_distance", "split", F.col("PU_DO__idx").alias("pu_do_index"))


@query("one_hot_ids")
def one_hot_ids(spark, sf_dir):
    """M5, second input set: pickup and dropoff ids encoded separately (one vocabulary each)."""
    data = tp.temporal_split(prepared(spark, sf_dir), "pickup_datetime", VAL_FROM, TEST_FROM)
    cats = ["PULocationID", "DOLocationID"]
    root = scratch_dir(spark, "one-hot")
    OneHotTables.fit(data.filter(F.col("split") == "train"), cats, root)
    enc = OneHotTables.load(spark, root).indexed(data.filter(F.col("split") != "train"))
    return enc.select(*cats, "split", F.col("PULocationID__idx").alias("pu_index"), F.col("DOLocationID__idx").alias("do_index"))
