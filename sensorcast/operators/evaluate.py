"""Forecast evaluation: MAE, bias, MSE/RMSE, the traditional and autonomy
tests, model comparison (E1-E6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["series_id"]
VALUES = ["ts", "hr", "qfe"]


def paired_long(df: DataFrame, values: list[str] = VALUES, keys: list[str] = KEYS,
                time_col: str = "utc", suffix: str = "_pred") -> DataFrame:
    """``(keys, time, variable, pred, actual)`` from a frame with ``{v}{suffix}`` and ``{v}``."""
    cols = [F.struct(F.lit(v).alias("variable"), F.col(f"{v}{suffix}").alias("pred"),
                     F.col(v).alias("actual")) for v in values]
    return df.select(*keys, time_col, F.inline(F.array(*cols)))


def errors(paired: DataFrame, group: list[str] = ("series_id",)) -> DataFrame:
    """MAE, bias (mean of prediction - actual), MSE, RMSE and n per group and variable."""
    e = F.col("pred") - F.col("actual")
    return (paired.filter(F.col("pred").isNotNull() & F.col("actual").isNotNull())
                  .groupBy(*group, "variable")
                  .agg(F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"),
                       F.avg(e * e).alias("mse"), F.count(F.lit(1)).alias("n"))
                  .withColumn("rmse", F.sqrt("mse")))


def traditional_test(one_step: DataFrame, values: list[str] = VALUES, keys: list[str] = KEYS,
                     split_col: str = "split", on: str = "test") -> DataFrame:
    """Errors of one-step predictions (fed with true values) on the held-out part."""
    src = one_step.filter(F.col(split_col) == on) if split_col in one_step.columns else one_step
    return errors(paired_long(src, values, keys), keys)


def autonomy_test(forecast: DataFrame, actuals: DataFrame, values: list[str] = VALUES,
                  keys: list[str] = KEYS, time_col: str = "utc", by_step: bool = False) -> DataFrame:
    """Errors of a recursive roll-out from the cut against the first test rows (E5).

    Predictions and actuals are aligned on ``(keys, time)``, never by position.
    """
    f = forecast.select(*keys, time_col, "step", *[F.col(v).alias(f"{v}_pred") for v in values])
    joined = f.join(actuals.select(*keys, time_col, *values), [*keys, time_col])
    cols = [F.struct(F.lit(v).alias("variable"), F.col(f"{v}_pred").alias("pred"),
                     F.col(v).alias("actual")) for v in values]
    paired = joined.select(*keys, time_col, "step", F.inline(F.array(*cols)))
    return errors(paired, [*keys, "step"] if by_step else keys)


def model_comparison(tables: dict[str, DataFrame], metric: str = "mae",
                     keys: list[str] = KEYS) -> DataFrame:
    """The same error side by side, one column per model."""
    stacked = None
    for model, t in tables.items():
        part = t.select(*keys, "variable", F.lit(model).alias("model"), F.col(metric).alias("_m"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(*keys, "variable").pivot("model", list(tables)).agg(F.first("_m"))
