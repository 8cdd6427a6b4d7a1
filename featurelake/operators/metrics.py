"""Model metrics, quality gates, rule scoring and candidate ranking.

Classification metrics are computed from the confusion counts
(``groupBy(actual, predicted).count()``: partial aggregation, output size =
classes squared), regression metrics from one moment pass. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelake.functions.columns import literal_frame


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 (0 for a never-predicted class)."""
    cm = confusion(df, actual, predicted)
    by_true = cm.groupBy(F.col("actual").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n"))).alias("tp"))
    by_pred = cm.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    per = by_true.join(by_pred, "cls", "full").select(
        "cls", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("n_pred", F.lit(0)).alias("n_pred"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred").cast("double")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.select("*", prec.alias("p"), rec.alias("r"))
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    total = F.sum("support")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("support") * F.col("p")) / total).alias("precision"),
        (F.sum(F.col("support") * F.col("r")) / total).alias("recall"),
        (F.sum(F.col("support") * f1) / total).alias("f1"))


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """R^2 = 1 - SSE / SST (not squared correlation), MSE, RMSE; one pass."""
    err = F.col(predicted) - F.col(actual)
    m = df.agg(F.avg(err * err).alias("mse"), F.var_pop(actual).alias("var_y"))
    return m.select(
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("var_y"))).alias("r2"),
        F.col("mse"), F.sqrt("mse").alias("rmse"))


def gate(metrics: DataFrame, accuracy: str = "accuracy", f1: str = "f1", threshold: float = 0.9) -> DataFrame:
    """SUCCESS when accuracy and F1 both reach the threshold, else WARNING, with a message.

    Also reports the single-threshold checks accuracy > 0.8 and accuracy > 0.7.
    """
    ok = (F.col(accuracy) >= threshold) & (F.col(f1) >= threshold)
    # Status words and message texts of the reference's validation step.
    # format_number rounds the exact binary value (half-even), as Python's "{:.4f}" does.
    nums = [F.lit("Accuracy: "), F.format_number(F.col(accuracy), 4), F.lit(", F1: "), F.format_number(F.col(f1), 4)]
    msg = F.when(ok, F.concat(F.lit("✅ Pipeline validation passed! "), *nums)) \
        .otherwise(F.concat(F.lit("⚠️ Pipeline validation warning! "), *nums))
    return metrics.select("*", F.when(ok, "SUCCESS").otherwise("WARNING").alias("status"), msg.alias("message"),
                          (F.col(accuracy) > 0.8).alias("passes_0_8"), (F.col(accuracy) > 0.7).alias("passes_0_7"))


def rule_score(value: Column, threshold: float = 23.0, high: float = 0.8, low: float = 0.3) -> Column:
    """0.8 when the value exceeds 23, else 0.3 (the reference's demo rule)."""
    return F.when(value > threshold, F.lit(high)).otherwise(F.lit(low))


def top_n(runs: DataFrame, metric: str = "rmse", n: int = 5, run_id: str = "run_id") -> DataFrame:
    """L2: the n best runs by ascending metric, ties by run id (TakeOrderedAndProject)."""
    return runs.orderBy(F.col(metric).asc_nulls_last(), F.col(run_id)).limit(n)


def best(runs: DataFrame, metric: str = "rmse", run_id: str = "run_id") -> DataFrame:
    """L3: the single best run (total order on metric, run id)."""
    return top_n(runs, metric, 1, run_id)


def unit_price_candidates(lines: DataFrame, group: str, value: Column) -> DataFrame:
    """X8/M13 candidates: one constant predictor per group value, scored by RMSE over all rows.

    RMSE of predicting constant p over all rows is sqrt(Var[v] + (p - E[v])^2), which keeps its digits when the mean is
    large: the two global moments are one aggregate (two scalars), the per-group
    predictions another; no row is ever paired with a candidate.
    """
    tot = lines.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var")).first()
    if not tot["n"]:
        return literal_frame(lines.sparkSession, [], "run_id string, prediction double, rmse double")
    mean, var = F.lit(tot["mean"]), F.lit(tot["var"])
    g = lines.groupBy(F.col(group).alias("run_id")).agg((F.sum(value) / F.count(value)).alias("prediction"))
    p = F.col("prediction")
    return g.select("run_id", "prediction", F.sqrt(var + (p - mean) * (p - mean)).alias("rmse"))
