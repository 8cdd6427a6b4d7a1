"""Stand-in inputs derived from the given tables (FIXTURES.md part B).

The reference works on data that is not shipped (a flower matrix, driver hourly
stats, taxi trips). Each function here derives the equivalent frame from the
TPC-H-like tables with plain projections, joins and aggregates, so its size grows
with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.functions.columns import nan_to_null
from featurelake.sources.tables import spread, table

FLOWER_FEATURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


def flowers(spark: SparkSession, sf_dir: str, with_key: bool = False, balance: bool = False) -> DataFrame:
    """Lineitem mapped onto the four measurements plus a 0/1/2 class.

    ``with_key`` adds ``row_key`` = order key and line number (not unique in the
    synthetic data, so it serves as an entity id, never as a row id). ``balance`` spreads a scan of few splits
    for what costs much CPU a row; a projection is cheaper than that shuffle.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_extendedprice", "l_discount", "l_returnflag")
    li = spread(li) if balance else li
    key = [F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_key")] if with_key else []
    return li.select(*key,
        nan_to_null("l_quantity").alias("sepal_length"),
        nan_to_null("l_tax").alias("sepal_width"),
        nan_to_null("l_extendedprice").alias("petal_length"),
        nan_to_null("l_discount").alias("petal_width"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
        .when(F.col("l_returnflag") == "R", 2).cast("int").alias("target"),
    )


def flowers_with_period(spark: SparkSession, sf_dir: str, cut: str = "1998-07-01") -> DataFrame:
    """X1 plus a ``period`` column (reference / current) split on ``l_shipdate``."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        nan_to_null("l_quantity").alias("sepal_length"),
        nan_to_null("l_tax").alias("sepal_width"),
        nan_to_null("l_extendedprice").alias("petal_length"),
        nan_to_null("l_discount").alias("petal_width"),
        F.when(F.col("l_shipdate") < F.lit(cut).cast("timestamp_ntz"), "reference").otherwise("current").alias("period"),
    )


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a long feature log (entity_id, feature_name, feature_value, event_ts, ingest_ts, seq)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("event_type").alias("feature_name"),
        nan_to_null("value").alias("feature_value"),
        F.col("ts").alias("event_ts"),
        F.col("ts").alias("ingest_ts"),
        F.col("event_id").alias("seq"),
    )


def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly per-user statistics; event time is the window *end* so no label leaks."""
    ev = table(spark, sf_dir, "events")
    end = (F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    g = ev.groupBy(F.col("user_id").alias("member_id"), end.alias("event_timestamp")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    return g.select(
        "member_id",
        "event_timestamp",
        F.col("event_timestamp").alias("created"),
        (F.col("purchases") / F.col("n")).alias("purchase_share"),
        (F.lit(1.0) - F.col("errors") / F.col("n")).alias("ok_share"),
        F.col("n").cast("bigint").alias("n_events"),
    )


def daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's purchases of a day; event time is the day's end."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    end = (F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    g = ev.groupBy(F.col("user_id").alias("member_id"), end.alias("event_timestamp")).agg(
        F.max("value").alias("best_value"), F.count(F.lit(1)).cast("bigint").alias("n_purchases"))
    return g.select("member_id", "event_timestamp", F.col("event_timestamp").alias("created"), "best_value", "n_purchases")


def member_signals(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> DataFrame:
    """Events of some types as single signals; the id's place in time orders signals of one instant."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds))
    made = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id)")
    return ev.select(F.col("user_id").alias("member_id"), F.col("ts").cast("timestamp_ntz").alias("event_timestamp"), made.alias("created"),
                     F.col("event_type").alias("kind"), F.col("value").alias("strength"))


def training_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as the entity frame (key, time, label, request values)."""
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("member_id"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("label"),
        (F.col("event_id") % 10).cast("bigint").alias("horizon_days"),
        (F.col("event_id") % 100).cast("bigint").alias("target_events"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips: pickup = order date, dropoff = ship date, zones = nations."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey))
    return j.select(
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        F.col("l_quantity").alias("trip_distance"),
    )


def minute_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips with time of day: pickup = event time, dropoff = value minutes later, zones from user and event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("lpep_pickup_datetime"),
        F.expr("ts + make_dt_interval(0, 0, 0, cast(round(value * 60, 6) AS DECIMAL(18, 6)))").cast("timestamp_ntz").alias("lpep_dropoff_datetime"),
        F.col("user_id").alias("PULocationID"),
        (F.col("event_id") % 97).alias("DOLocationID"),
        F.col("value").alias("trip_distance"),
    )


def class_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 (class): actual = X1 target, predicted = quantity band."""
    f = flowers(spark, sf_dir)
    return f.select(
        F.col("target").alias("actual"),
        F.when(F.col("sepal_length") < 17, 0).when(F.col("sepal_length") < 34, 1).otherwise(2).cast("int").alias("predicted"),
    )


def regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 (regression): actual = extended price, predicted = quantity * 1500."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_extendedprice").alias("actual"), (F.col("l_quantity") * 1500.0).alias("predicted"))


def order_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """X6 (keyed): predictions and actuals as two frames sharing ``entity_id`` (orders)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    means = o.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("predicted"))
    preds = o.join(means, "o_orderpriority").select(
        F.col("o_orderkey").cast("string").alias("entity_id"), "predicted")
    actual = o.select(F.col("o_orderkey").cast("string").alias("entity_id"), F.col("o_totalprice").alias("actual"))
    return preds, actual


def learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with targets that are known functions of the inputs."""
    li = table(spark, sf_dir, "lineitem")
    q, t = F.col("l_quantity"), F.col("l_tax")
    return li.select(
        q.alias("quantity"), t.alias("tax"), F.col("l_discount").alias("discount"),
        F.col("l_extendedprice").alias("price"), F.col("l_orderkey"), F.col("l_linenumber"),
        F.when(q < 17, 0).when(q < 34, 1).otherwise(2).cast("double").alias("label"),
        (3 * q - 2 * t + 5).alias("y"),
    )


def purchase_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 (graph at scale): customers, parts and suppliers linked by purchases, a link as often as it was bought.

    Every line item links its buyer, part and supplier (three edges, so the work
    is linear in the line items). Node ids: customer key * 3, part key * 3 + 1, supplier key * 3 + 2.
    """
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    c, p, s = F.col("o_custkey") * 3, F.col("l_partkey") * 3 + 1, F.col("l_suppkey") * 3 + 2
    pairs = F.array(F.struct(c.alias("a"), p.alias("b")), F.struct(p.alias("a"), s.alias("b")),
                    F.struct(c.alias("a"), s.alias("b")))
    raw = j.select(F.explode(pairs).alias("e"))
    return raw.select(F.least("e.a", "e.b").alias("src"), F.greatest("e.a", "e.b").alias("dst"))


def purchase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 as a simple graph: each link of ``purchase_links`` once."""
    return purchase_links(spark, sf_dir).distinct()


def order_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7b (many components): each order linked with its lines, and with the orders of its customer on the same day.

    Node ids: order key * 16, and order key * 16 + line number.
    """
    li = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 16).alias("src"), (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("dst"))
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", (F.col("o_orderkey") * 16).alias("node"))
    first = o.groupBy("o_custkey", "o_orderdate").agg(F.min("node").alias("src"))
    same = o.join(first, ["o_custkey", "o_orderdate"]).select("src", F.col("node").alias("dst")).filter("src < dst")
    return li.unionAll(same).distinct()
