"""Quality control of regular series: ranges, jumps, Hampel filter, gap repair, smoothing.

Series are (key, t, value) with t a whole number that grows by `step`; frames count rows, so a series should hold a row per
step (null where nothing was seen).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAD = 1.4826


def hard_range(v: Column, vf: Column, factor: float = 1.25, most: float = 90.0) -> Column:
    """Whether 0 <= v <= min(factor * vf, most); null counts as out of range."""
    return F.coalesce((v >= 0) & (v <= F.least(vf * factor, F.lit(most))), F.lit(False))


def frame_median(v: Column, over) -> Column:
    """Median over a row frame (built-in percentiles reject frames): sorted list and its middle."""
    a = F.array_sort(F.collect_list(v).over(over))
    n = F.size(a)
    return F.when(n > 0, (F.get(a, F.floor((n - 1) / 2).cast("int")) + F.get(a, F.floor(n / 2).cast("int"))) / 2)


def hampel(df: DataFrame, key: str, t: str, v: str, half: int = 3, limit: float = 3.0) -> DataFrame:
    """df with roll_median, roll_mad and hampel_ok: whether |v - median| <= limit * 1.4826 * MAD of the centred window.

    A zero MAD is replaced by the series' median MAD, and that, if zero too, by 1. Null values aren't ok.
    """
    w = Window.partitionBy(key).orderBy(t).rowsBetween(-half, half)
    d = df.withColumn("roll_median", frame_median(F.col(v), w)).withColumn("_d", F.abs(F.col(v) - F.col("roll_median")))
    d = d.withColumn("roll_mad", frame_median(F.col("_d"), w))
    usual = d.groupBy(key).agg(F.median(F.nullif("roll_mad", F.lit(0.0))).alias("_usual"))
    d = d.join(usual, key, "left").withColumn("_mad", F.coalesce(F.nullif("roll_mad", F.lit(0.0)), "_usual", F.lit(1.0)))
    return d.withColumn("hampel_ok", F.coalesce(F.col("_d") <= limit * MAD * F.col("_mad"), F.lit(False))).drop("_d", "_usual", "_mad")


def jump_ok(key: str, t: str, v: str, limit: float = 30.0) -> Column:
    """Whether the change from the row before is at most `limit`; unknown changes pass."""
    d = F.col(v) - F.lag(v).over(Window.partitionBy(key).orderBy(t))
    return F.coalesce(F.abs(d) <= limit, F.lit(True))


def repair_single_gaps(df: DataFrame, key: str, t: str, v: str) -> DataFrame:
    """df with `repaired` (a lone null between two values is interpolated by time) and `was_repaired`."""
    w = Window.partitionBy(key).orderBy(t)
    a, b, ta, tb = F.lag(v).over(w), F.lead(v).over(w), F.lag(t).over(w), F.lead(t).over(w)
    lone = F.col(v).isNull() & a.isNotNull() & b.isNotNull()
    filled = a + (b - a) * (F.col(t) - ta) / F.nullif(tb - ta, F.lit(0))
    return df.withColumn("repaired", F.when(lone, filled).otherwise(F.col(v))).withColumn("was_repaired", lone)


def interpolate(df: DataFrame, key: str, t: str, v: str) -> DataFrame:
    """df with `filled`: nulls interpolated by time, ends carried."""
    w, back = Window.partitionBy(key).orderBy(t), Window.partitionBy(key).orderBy(F.col(t).desc())  # a frame to the end would take squared time
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), back.rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col(v).isNotNull(), F.col(t))
    a, ta, b, tb = F.last(v, True).over(before), F.last(known, True).over(before), F.last(v, True).over(after), F.last(known, True).over(after)
    mid = a + (b - a) * (F.col(t) - ta) / F.nullif(tb - ta, F.lit(0))
    return df.withColumn("filled", F.coalesce(F.col(v), mid, a, b))


def rolling_mean(key: str, t: str, v: str, half: int = 1) -> Column:
    return F.avg(v).over(Window.partitionBy(key).orderBy(t).rowsBetween(-half, half))


def null_runs(df: DataFrame, key: str, t: str, v: str, least: int = 2) -> DataFrame:
    """(key, start, length): runs of at least `least` successive nulls."""
    w = Window.partitionBy(key).orderBy(t)
    d = df.withColumn("_g", F.row_number().over(w) - F.sum(F.col(v).isNull().cast("int")).over(w)).where(F.col(v).isNull())
    return d.groupBy(key, "_g").agg(F.min(t).alias("start"), F.count("*").alias("length")).where(F.col("length") >= least).drop("_g")


def savgol_weights(window: int, order: int) -> list[float]:
    """Centre weights of a Savitzky-Golay filter (window odd): one fixed convolution. Window 3 and order 2 give (0, 1, 0)."""
    half = window // 2
    a = np.vander(np.arange(-half, half + 1), order + 1, increasing=True)
    return [float(x) for x in np.linalg.pinv(a)[0]]


def savgol(key: str, t: str, v: str, window: int = 5, order: int = 2) -> Column:
    """The smoothed value where the whole window is known, else the value itself."""
    w, half = Window.partitionBy(key).orderBy(t), window // 2
    parts = [(F.lag(v, -o).over(w) if o < 0 else F.lead(v, o).over(w) if o else F.col(v)) if o >= 0 else F.lag(v, -o).over(w) for o in range(-half, half + 1)]
    total = sum((p * c for p, c in zip(parts, savgol_weights(window, order))), F.lit(0.0))
    return F.coalesce(total, F.col(v))


def spatial_ok() -> Column:
    """The spatial check passes everything, as the series alone say nothing of neighbours."""
    return F.lit(1)


def qc_summary(df: DataFrame, key: str, flags: list[str]) -> DataFrame:
    """Per key: rows and the share that passes each flag, and all."""
    every = F.lit(True)
    for f in flags:
        every = every & F.col(f)
    return df.groupBy(key).agg(F.count("*").alias("n"), *(F.avg(F.col(f).cast("double")).alias(f"{f}_share") for f in flags), F.avg(every.cast("double")).alias("pass_share"))
