"""Calibration: robust fits per group from binned points, so that a group of any size is a bounded table before it is fitted."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmark.operators.groups import map_groups

BIN = 0.01  # width of the cells of log values; points of a cell are represented by their mean

LINE = "n bigint, intercept double, slope double, mad double, at_bound boolean"


def _weighted_median(x: np.ndarray, w: np.ndarray) -> float:
    o = np.argsort(x)
    c = np.cumsum(w[o])
    return float(x[o][np.searchsorted(c, c[-1] / 2)])


def robust_line(x, y, w, loss: str = "soft_l1", scale: float = 0.2, low: float = -np.inf, high: float = np.inf, rounds: int = 100) -> tuple[float, float]:
    """(intercept, slope) by iteratively reweighted least squares; the slope is kept within [low, high]."""
    xm = np.average(x, weights=w)
    var = np.average((x - xm) ** 2, weights=w)
    slope = float(np.clip(np.average((x - xm) * (y - np.average(y, weights=w)), weights=w) / var if var > 0 else 1.0, low, high))
    intercept = _weighted_median(y - slope * x, w)
    for _ in range(rounds):
        r = y - intercept - slope * x
        s = scale if loss == "soft_l1" else max(1.4826 * _weighted_median(np.abs(r), w), 1e-9)
        k = w / np.sqrt(1 + (r / s) ** 2) if loss == "soft_l1" else w * np.minimum(1, 1.35 * s / np.maximum(np.abs(r), 1e-12))
        xm, ym = np.average(x, weights=k), np.average(y, weights=k)
        var = np.average((x - xm) ** 2, weights=k)
        b = float(np.clip(np.average((x - xm) * (y - ym), weights=k) / var if var > 0 else slope, low, high))
        a = float(ym - b * xm)
        if abs(a - intercept) + abs(b - slope) < 1e-10:
            intercept, slope = a, b
            break
        intercept, slope = a, b
    return intercept, slope


def fit_lines(df: DataFrame, by: list[str], x: str, y: str, loss: str = "soft_l1", scale: float = 0.2, low: float = -np.inf, high: float = np.inf, least: int = 3, width: float = BIN) -> DataFrame:
    """(by..., LINE): a robust line of y on x per group. Rows with a null key or a null or non-finite x or y are left out, groups below `least` give none."""
    ok = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    for k in by:
        ok = ok & F.col(k).isNotNull()
    cells = df.where(ok).groupBy(*by, F.round(F.col(x) / width).alias("_cx"), F.round(F.col(y) / width).alias("_cy")).agg(F.avg(x).alias("_x"), F.avg(y).alias("_y"), F.count("*").alias("_w"))

    def fit(g: dict) -> dict | None:
        n = int(g["_w"].sum())
        if n < least:
            return None
        xs, ys, ws = (g[c].astype(float) for c in ("_x", "_y", "_w"))
        a, b = robust_line(xs, ys, ws, loss, scale, low, high)
        r = ys - a - b * xs
        mad = 1.4826 * _weighted_median(np.abs(r - _weighted_median(r, ws)), ws)
        return {**{k: [g[k][0]] for k in by}, "n": [n], "intercept": [a], "slope": [b], "mad": [mad], "at_bound": [bool(min(abs(b - low), abs(b - high)) < 1e-3)]}

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*by).schema)
    return map_groups(cells, by, ["_cx", "_cy"], fit, f"{kinds}, {LINE}")  # many groups share a batch


def huber_flags(df: DataFrame, by: list[str], x: str, y: str, out: str, log_x: bool = False, log_y: bool = False, limit: float = 3.0, least: int = 8) -> DataFrame:
    """df with `out`: whether the residual from a Huber line (on logs where asked) is beyond limit * MAD; values not above 0 have no log and are never flagged."""
    lx = F.when(F.col(x) > 0, F.log(x)) if log_x else F.col(x)
    ly = F.when(F.col(y) > 0, F.log(y)) if log_y else F.col(y)
    d = df.withColumn("_lx", lx).withColumn("_ly", ly)
    lines = fit_lines(d, by, "_lx", "_ly", "huber", least=least).select(*by, F.col("intercept").alias("_a"), F.col("slope").alias("_b"), F.col("mad").alias("_m"))
    d = d.join(lines, by, "left")
    far = F.abs(F.col("_ly") - F.col("_a") - F.col("_b") * F.col("_lx")) > limit * F.col("_m")
    return d.withColumn(out, F.coalesce(far & (F.col("_m") > 0), F.lit(False))).drop("_lx", "_ly", "_a", "_b", "_m")


def fit_qvdf(df: DataFrame, by: list[str], doc: str = "doc", hours: str = "p_hr", speed: str = "min_speed", vc: str = "limit", least: int = 3) -> DataFrame:
    """(by..., n, f_d, n_exp, f_p, s, alpha, beta, reliability): two bounded robust log-log fits, P = f_d doc^n and vc / v - 1 = f_p P^s."""
    d = df.where((F.col(doc) > 0) & (F.col(hours) > 0)).withColumn("_lz", F.log(doc)).withColumn("_lp", F.log(hours))
    reduction = F.col(vc) / F.greatest(F.col(speed), F.lit(1e-6)) - 1
    d = d.withColumn("_lr", F.when(reduction > 1e-6, F.log(reduction)))
    a = fit_lines(d, by, "_lz", "_lp", "soft_l1", 0.20, 1.0, 5.0, least).select(*by, "n", F.exp("intercept").alias("f_d"), F.col("slope").alias("n_exp"), F.col("at_bound").alias("b1"))
    b = fit_lines(d, by, "_lp", "_lr", "soft_l1", 0.25, 0.05, 4.0, least).select(*by, F.exp("intercept").alias("f_p"), F.col("slope").alias("s"), F.col("at_bound").alias("b2"), F.col("n").alias("n2"))
    out = a.join(b, by).withColumn("alpha", 8 / 15 * F.col("f_p") * F.pow("f_d", "s")).withColumn("beta", F.col("n_exp") * F.col("s"))
    m = F.least("n", "n2")
    rel = F.when((m < 5) | F.col("b1") | F.col("b2"), "low").when(m >= 10, "high").otherwise("medium")
    return out.select(*by, m.alias("n"), "f_d", "n_exp", "f_p", "s", "alpha", "beta", rel.alias("reliability"))


def with_scope_fallback(df: DataFrame, fine: DataFrame, coarse: DataFrame, fine_keys: list[str], coarse_keys: list[str], values: list[str]) -> DataFrame:
    """df with values from the fine fit where there is one, else the coarse fit, and `scope`."""
    f = fine.select(*fine_keys, *(F.col(v).alias(f"_f_{v}") for v in values))
    c = coarse.select(*coarse_keys, *(F.col(v).alias(f"_c_{v}") for v in values))
    j = df.join(f, fine_keys, "left").join(c, coarse_keys, "left")
    scope = F.when(F.col(f"_f_{values[0]}").isNotNull(), "sensor_period").when(F.col(f"_c_{values[0]}").isNotNull(), "corridor_period").otherwise("none")
    return j.select(*df.columns, *(F.coalesce(f"_f_{v}", f"_c_{v}").alias(v) for v in values), scope.alias("scope"))


def s3_fit(df: DataFrame, by: list[str], speed: str = "speed", flow: str = "flow", least: int = 50) -> DataFrame:
    """(by..., n, vf, kc, m): S3 curve by damped Gauss-Newton with soft-L1 weights on binned (speed, density) points; below `least` points vf is the 95th percentile."""
    cells = df.where((F.col(speed) > 1) & (F.col(flow) > 0)).groupBy(*by, F.round(speed).alias("_cv"), F.round(F.col(flow) / F.col(speed)).alias("_ck")).agg(F.avg(speed).alias("_v"), F.avg(F.col(flow) / F.col(speed)).alias("_k"), F.count("*").alias("_w"))

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        v, k, w = (g[c].to_numpy(float) for c in ("_v", "_k", "_w"))
        o = np.argsort(v)
        vf = float(v[o][min(len(v) - 1, np.searchsorted(np.cumsum(w[o]), 0.95 * w.sum()))])
        p = np.array([vf, max(np.average(k, weights=w), 5.0), 4.0])
        if w.sum() >= least:
            f = lambda p: p[0] / (1 + (k / p[1]) ** p[2]) ** (2 / p[2])
            lam = 1e-2
            cost = lambda p: float((w * (np.sqrt(1 + ((v - f(p)) / 5) ** 2) - 1)).sum())
            for _ in range(60):
                r = v - f(p)
                jac = np.stack([(f(p + e) - f(p)) / 1e-4 for e in np.eye(3) * 1e-4], axis=1)
                wt = w / np.sqrt(1 + (r / 5) ** 2)
                a = (jac * wt[:, None]).T @ jac
                step = np.linalg.solve(a + lam * np.diag(np.diag(a) + 1e-9), (jac * wt[:, None]).T @ r)
                new = np.clip(p + step, [20, 5, 1.2], [95, 200, 12])
                if cost(new) < cost(p):
                    p, lam = new, lam / 3
                else:
                    lam *= 4
                if np.abs(step).max() < 1e-7:
                    break
        return pd.DataFrame({**{c: [g[c].iloc[0]] for c in by}, "n": [int(w.sum())], "vf": [p[0]], "kc": [p[1]], "m": [p[2]]})

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    return cells.groupBy(*by).applyInPandas(fit, f"{kinds}, n bigint, vf double, kc double, m double")
