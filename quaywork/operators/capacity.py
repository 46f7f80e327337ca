"""Staffing capacity: the fixed linear estimator and its re-fit on history."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of the published estimator and its interval width.
INTERCEPT = 157.3509363146291
PER_PACKER_HOUR = 5.670364553091294
PER_COMPLEXITY = -65.34606343082069
RESIDUAL_SD = 12.897217829187284
Z_80 = 1.28


@dataclass(frozen=True)
class CapacityModel:
    intercept: float = INTERCEPT
    per_packer_hour: float = PER_PACKER_HOUR
    per_complexity: float = PER_COMPLEXITY
    residual_sd: float = RESIDUAL_SD

    def predict(self, packer_hours: Column, complexity: Column) -> Column:
        return (
            F.lit(self.intercept)
            + F.lit(self.per_packer_hour) * packer_hours
            + F.lit(self.per_complexity) * complexity
        )


def packer_hours(headcount: Column, shift_hours: Column, receiving: Column) -> Column:
    return F.greatest(F.lit(0.0), headcount * shift_hours - receiving)


def predict_capacity(days: DataFrame, model: CapacityModel = CapacityModel()) -> DataFrame:
    """Adds ``predicted`` to rows of packer_hours and complexity."""
    return days.withColumn("predicted", model.predict(F.col("packer_hours"), F.col("complexity")))


def assess_capacity(predicted: DataFrame, model: CapacityModel = CapacityModel()) -> DataFrame:
    """80 % interval, gap and status against a ``forecast`` column."""
    margin = F.lit(Z_80 * model.residual_sd)
    status = (
        F.when(F.col("low") >= F.col("forecast"), "ON TRACK")
        .when(F.col("high") < F.col("forecast"), "AT RISK")
        .otherwise("TIGHT — WATCH CLOSELY")
    )
    return (
        predicted.withColumn("low", F.col("predicted") - margin)
        .withColumn("high", F.col("predicted") + margin)
        .withColumn("gap", F.col("predicted") - F.col("forecast"))
        .withColumn("status", status)
    )


def _features(days: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(
        inputCols=["packer_hours", "complexity"], outputCol="features", handleInvalid="skip"
    )
    shaped = days.select(
        "day", F.col("orders_shipped").cast("double").alias("label"), "packer_hours", "complexity"
    )
    return assembler.transform(shaped)


def fit_capacity(days: DataFrame) -> CapacityModel:
    """Ordinary least squares on daily history; only coefficients reach the driver."""
    from pyspark.ml.regression import LinearRegression

    rows = _features(days)
    fitted = LinearRegression(solver="normal", regParam=0.0).fit(rows)
    hours, complexity = fitted.coefficients
    rmse, n = fitted.summary.rootMeanSquaredError, fitted.summary.numInstances
    spread = rmse * (n / max(n - 1, 1)) ** 0.5
    return CapacityModel(fitted.intercept, float(hours), float(complexity), float(spread))


def cross_validate(days: DataFrame, folds: int = 5, forest: bool = True) -> DataFrame:
    """Mean R2 and MAE per model over fixed day folds.

    The fits run on the daily table, one row per day however long its history;
    it is cached because every fold reads it again.
    """
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    fold = F.pmod(F.datediff("day", F.lit("1970-01-01").cast("date")), F.lit(folds))
    rows = _features(days).withColumn("fold", fold.cast("int")).cache()
    models = {"linear regression": LinearRegression(solver="normal", regParam=0.0)}
    if forest:
        models["random forest"] = RandomForestRegressor(seed=7)
    held_out = []
    for name, model in models.items():
        for i in range(folds):
            fitted = model.fit(rows.where(F.col("fold") != i))
            scored = fitted.transform(rows.where(F.col("fold") == i))
            held_out.append(scored.select(F.lit(name).alias("model"), "fold", "label", "prediction"))
    error = F.col("label") - F.col("prediction")
    per_fold = (
        reduce(DataFrame.unionByName, held_out)
        .groupBy("model", "fold")
        .agg(
            F.sum(error * error).alias("_sse"),
            (F.var_pop("label") * F.count("label")).alias("_sst"),
            F.avg(F.abs(error)).alias("_mae"),
        )
    )
    return per_fold.groupBy("model").agg(
        F.avg(1 - F.col("_sse") / F.col("_sst")).alias("r2"), F.avg("_mae").alias("mae")
    )


def shipped_vs_forecast(history: DataFrame, today: DataFrame) -> DataFrame:
    """History of (day, ordersShipped, forecastedOrders) plus today's projection."""
    past = history.select(
        F.col("day").cast("string").alias("label"),
        "ordersShipped",
        "forecastedOrders",
        F.lit(None).cast("bigint").alias("projection"),
    )
    point = today.select(
        F.lit("Today").alias("label"),
        F.lit(None).cast("bigint").alias("ordersShipped"),
        F.floor(F.col("forecast") + 0.5).cast("bigint").alias("forecastedOrders"),
        F.floor(F.col("predicted") + 0.5).cast("bigint").alias("projection"),
    )
    return past.unionByName(point)
