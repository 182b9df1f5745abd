"""Gaps and islands, durations and agreement of observed and modelled congestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.functions.physics import div


def islands(df: DataFrame, by: list[str], t: str, flag: Column, step: int, keep: list[Column] | None = None, gap: int = 0) -> DataFrame:
    """(by..., start, end, minutes, bins, keep...): runs of flagged rows whose times follow by exactly `step`.

    gap: so many missing or unflagged steps are bridged. end is the last row's time + step. keep: aggregates over a run's rows.
    """
    w = Window.partitionBy(*by).orderBy(t)
    d = df.where(flag).withColumn("_new", F.when(F.col(t) - F.lag(t).over(w) <= step * (gap + 1), 0).otherwise(1))
    d = d.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = d.groupBy(*by, "_run").agg(F.min(t).alias("start"), (F.max(t) + step).alias("end"), F.count("*").alias("bins"), *(keep or []))
    return out.drop("_run").withColumn("minutes", F.col("end") - F.col("start"))


def threshold_minutes(v: Column, limit: Column, step: int) -> Column:
    """Aggregate: minutes at or below the limit; null if there is no valid pair."""
    return F.when(F.count(v + limit) > 0, F.count_if(v <= limit) * step)


def accuracy(obs: Column, mod: Column, least: float = 5.0) -> list[Column]:
    """Aggregates of model against observation: n, mae, mape (observations from `least`), rmse, bias, wmape, r2."""
    ok = obs.isNotNull() & mod.isNotNull()
    o, m = F.when(ok, obs), F.when(ok, mod)
    e = m - o
    return [
        F.count(o).alias("n"), F.avg(F.abs(e)).alias("mae"), (100 * F.avg(F.when(o >= least, F.abs(e) / F.when(o >= least, o)))).alias("mape"),
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), (100 * div(F.sum(F.abs(e)), F.sum(F.abs(o)))).alias("wmape"), F.pow(F.corr(o, m), 2).alias("r2"),
    ]


def congestion_fit(df: DataFrame, by: list[str], t: str, obs: Column, mod: Column, step: int) -> DataFrame:
    """Per group: minutes of observed, modelled and common congestion, IoU, precision, recall, F1, accuracy, onset and clearance errors."""
    d = df.select(*by, F.col(t).alias("t"), F.coalesce(obs, F.lit(False)).alias("o"), F.coalesce(mod, F.lit(False)).alias("m"))
    both, either = F.count_if(F.col("o") & F.col("m")), F.count_if(F.col("o") | F.col("m"))
    edge = lambda f, c: f(F.when(F.col(c), F.col("t")))
    out = d.groupBy(*by).agg(
        (F.count_if("o") * step).alias("observed_min"), (F.count_if("m") * step).alias("model_min"), (both * step).alias("overlap_min"),
        div(both.cast("double"), either).alias("iou"), div(both.cast("double"), F.count_if("m")).alias("precision"), div(both.cast("double"), F.count_if("o")).alias("recall"),
        F.avg((F.col("o") == F.col("m")).cast("double")).alias("accuracy"), (edge(F.min, "m") - edge(F.min, "o")).alias("onset_error"), (edge(F.max, "m") - edge(F.max, "o")).alias("clearance_error"),
    )
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", div(2 * p * r, p + r))


def origin_fit(x: Column, y: Column) -> list[Column]:
    """Aggregates of the line through the origin: n, slope, percent against parity, r2 about the origin, mae of the fit left out."""
    ok = x.isNotNull() & y.isNotNull()
    a, b = F.when(ok, x), F.when(ok, y)
    slope = div(F.sum(a * b), F.sum(a * a))
    return [F.count(a).alias("n"), slope.alias("slope"), (100 * (slope - 1)).alias("percent"), (1 - div(F.sum(b * b) - slope * F.sum(a * b), F.sum(b * b))).alias("r2_origin"), F.avg(F.abs(a - b)).alias("mae")]


def scatter(x: Column, y: Column) -> list[Column]:
    """Aggregates of two measures: n, slope through the origin, r, mae, rmse, ratio of totals."""
    ok = x.isNotNull() & y.isNotNull()
    a, b = F.when(ok, x), F.when(ok, y)
    return [
        F.count(a).alias("n"), div(F.sum(a * b), F.sum(a * a)).alias("slope"), F.corr(a, b).alias("r"), F.avg(F.abs(b - a)).alias("mae"),
        F.sqrt(F.avg((b - a) * (b - a))).alias("rmse"), div(F.sum(b), F.sum(a)).alias("total_ratio"),
    ]
