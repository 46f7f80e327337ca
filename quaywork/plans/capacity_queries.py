"""Queries over the staffing-capacity model."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaywork.operators import capacity as K
from quaywork.plans.registry import query

_PREDICTED = "157.3509363146291::DOUBLE + 5.670364553091294::DOUBLE * packer_hours - 65.34606343082069::DOUBLE * complexity"
_MARGIN = "1.28::DOUBLE * 12.897217829187284::DOUBLE"


@query(
    "i1_predict_capacity",
    "days",
    f"""SELECT strftime(day, '%Y-%m-%d') AS day, round(greatest(0, packer_hours * 2 - orders_shipped), 4) AS hours_left,
       round({_PREDICTED}, 4) AS predicted FROM days""",
)
def predict(d):
    left = K.packer_hours(F.col("packer_hours"), F.lit(2.0), F.col("orders_shipped"))
    return K.predict_capacity(d.capacity_days).select(
        "day", F.round(left, 4).alias("hours_left"), F.round("predicted", 4).alias("predicted")
    )


@query(
    "i2_assess_capacity",
    "days",
    f"""SELECT strftime(day, '%Y-%m-%d') AS day, round({_PREDICTED} - {_MARGIN}, 4) AS low, round({_PREDICTED} + {_MARGIN}, 4) AS high,
       round({_PREDICTED} - orders_shipped * 15, 4) AS gap,
       CASE WHEN {_PREDICTED} - {_MARGIN} >= orders_shipped * 15 THEN 'ON TRACK' WHEN {_PREDICTED} + {_MARGIN} < orders_shipped * 15 THEN 'AT RISK'
         ELSE 'TIGHT — WATCH CLOSELY' END AS status FROM days""",
)
def assess(d):
    forecast = d.capacity_days.withColumn("forecast", F.col("orders_shipped") * 15)
    rows = K.assess_capacity(K.predict_capacity(forecast))
    return rows.select(
        "day", *[F.round(c, 4).alias(c) for c in ("low", "high", "gap")], "status"
    )


@query(
    "i3_fit_capacity",
    "days",
    """WITH m AS (SELECT count(*) AS n, avg(orders_shipped) AS my, avg(packer_hours) AS ma, avg(complexity) AS mb,
         covar_samp(packer_hours, packer_hours) AS aa, covar_samp(complexity, complexity) AS bb, covar_samp(packer_hours, complexity) AS ab,
         covar_samp(orders_shipped, packer_hours) AS ya, covar_samp(orders_shipped, complexity) AS yb, covar_samp(orders_shipped, orders_shipped) AS yy FROM days),
       c AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS p, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS q FROM m)
       SELECT round(my - p * ma - q * mb, 4) AS intercept, round(p, 4) AS per_packer_hour, round(q, 4) AS per_complexity,
         round(sqrt(yy - p * ya - q * yb), 4) AS residual_sd FROM c""",
)
def fit(d):
    model = K.fit_capacity(d.capacity_days)
    values = [model.intercept, model.per_packer_hour, model.per_complexity, model.residual_sd]
    names = ["intercept", "per_packer_hour", "per_complexity", "residual_sd"]
    return d.spark.range(1).select(
        *[F.round(F.lit(v), 4).alias(n) for v, n in zip(values, names)]
    )


@query(
    "i3_cross_validate_linear",
    "days",
    """WITH d AS (SELECT *, date_diff('day', DATE '1970-01-01', day) % 5 AS fold FROM days),
       m AS (SELECT k, avg(orders_shipped) AS my, avg(packer_hours) AS ma, avg(complexity) AS mb,
         covar_samp(packer_hours, packer_hours) AS aa, covar_samp(complexity, complexity) AS bb, covar_samp(packer_hours, complexity) AS ab,
         covar_samp(orders_shipped, packer_hours) AS ya, covar_samp(orders_shipped, complexity) AS yb
         FROM (SELECT unnest(range(5)) AS k) JOIN d ON fold <> k GROUP BY k),
       c AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS p, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS q FROM m),
       e AS (SELECT k, orders_shipped AS y, orders_shipped - (my + p * (packer_hours - ma) + q * (complexity - mb)) AS err FROM c JOIN d ON fold = k),
       s AS (SELECT k, 1 - sum(err * err) / (var_pop(y) * count(*)) AS r2, avg(abs(err)) AS mae FROM e GROUP BY k)
       SELECT 'linear regression' AS model, round(avg(r2), 5) AS r2, round(avg(mae), 5) AS mae FROM s""",
)
def cross_validate_linear(d):
    scores = K.cross_validate(d.capacity_days, forest=False)
    return scores.select("model", F.round("r2", 5).alias("r2"), F.round("mae", 5).alias("mae"))


@query("i3_cross_validate")
def cross_validate(d):
    return K.cross_validate(d.capacity_days)


@query(
    "i4_shipped_vs_forecast",
    "days",
    f"""WITH recent AS (SELECT * FROM days ORDER BY day DESC LIMIT 30)
       SELECT strftime(day, '%Y-%m-%d') AS label, orders_shipped AS ordersShipped, CAST(round(orders_shipped * 1.1) AS BIGINT) AS forecastedOrders, CAST(NULL AS BIGINT) AS projection FROM recent
       UNION ALL SELECT 'Today', NULL, 280, CAST(round(157.3509363146291 + 5.670364553091294 * avg(packer_hours) - 65.34606343082069 * avg(complexity)) AS BIGINT) FROM recent""",
)
def shipped_vs_forecast(d):
    recent = d.capacity_days.orderBy(F.col("day").desc()).limit(30)
    history = recent.select(
        "day",
        F.col("orders_shipped").alias("ordersShipped"),
        F.round(F.col("orders_shipped") * 1.1).cast("bigint").alias("forecastedOrders"),
    )
    today = K.predict_capacity(
        recent.agg(F.avg("packer_hours").alias("packer_hours"), F.avg("complexity").alias("complexity"))
    ).withColumn("forecast", F.lit(280.0))
    return K.shipped_vs_forecast(history, today)
