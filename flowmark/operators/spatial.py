"""Placing along corridors, bracketing neighbours, tiers of imputation and proximity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.functions.physics import angle_difference, bearing, clip, div


def corridor_positions(df: DataFrame, corridor: str, order: list[str], length: str) -> DataFrame:
    """df with position: the middle of each member along its corridor."""
    w = Window.partitionBy(corridor).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("position", F.sum(length).over(w) - F.col(length) / 2)


def bracket(df: DataFrame, by: list[str], position: str, value: str) -> DataFrame:
    """df with the nearest known value on either side (strictly before and after) and its distance: left, left_gap, right, right_gap."""
    w = Window.partitionBy(*by).orderBy(position)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(position))
    return (
        df.withColumn("left", F.last(value, True).over(before)).withColumn("left_gap", F.col(position) - F.last(at, True).over(before))
        .withColumn("right", F.first(value, True).over(after)).withColumn("right_gap", F.first(at, True).over(after) - F.col(position))
    )


def spatial_tiers(df: DataFrame, by: list[str], position: str, value: str, widest: float = 10.0, one_side: float = 5.0) -> DataFrame:
    """df with filled, tier and confidence: A direct, B between two neighbours at most `widest` apart, C beside one within `one_side`, else none."""
    d = bracket(df, by, position, value)
    gap = F.col("left_gap") + F.col("right_gap")
    between = F.col("left") + (F.col("right") - F.col("left")) * div(F.col("left_gap"), gap)
    near_left = F.col("left_gap") <= F.coalesce("right_gap", F.lit(float("inf")))
    side = F.when(near_left, F.col("left")).otherwise(F.col("right"))
    reach = F.least("left_gap", "right_gap")
    tier = F.when(F.col(value).isNotNull(), "A").when(gap <= widest, "B").when(reach <= one_side, "C")
    filled = F.when(tier == "A", F.col(value)).when(tier == "B", F.coalesce(between, "left")).when(tier == "C", side)
    label = F.when(tier == "A", "observed").when(tier == "B", F.when(gap <= widest / 2, "high").otherwise("medium")).when(tier == "C", "low").otherwise("none")
    return d.withColumn("tier", tier).withColumn("filled", filled).withColumn("confidence", label)


def _not_above(x: np.ndarray, y: np.ndarray, s: float) -> int:
    """Pairs with different x whose slope is at most s, by sorted blocks that are merged level by level; x ascending, ties in x by y descending."""
    z = y - s * x
    n, width, total = len(z), 1, 0
    # a pair counts if the later z is not above the earlier one; pairs of one x were put in descending y, so that they all count, and are taken off
    while width < n:
        for a in range(0, n - width, 2 * width):
            left, right = z[a : a + width], z[a + width : a + 2 * width]
            total += len(left) * len(right) - int(np.searchsorted(left, right, "left").sum())
            z[a : a + 2 * width] = np.sort(z[a : a + 2 * width])
        width *= 2
    c = np.unique(x, return_counts=True)[1]
    return total - int((c * (c - 1) // 2).sum())


def median_slope(x: np.ndarray, y: np.ndarray) -> float:
    """The median of the slopes of all pairs with different x, found by bisection over the slope with pairs counted, not made."""
    order = np.lexsort((-y, x))
    x, y = x[order], y[order]
    c = np.unique(x, return_counts=True)[1]
    pairs = len(x) * (len(x) - 1) // 2 - int((c * (c - 1) // 2).sum())
    if not pairs:
        return float("nan")
    if len(x) <= 64:
        i, j = np.triu_indices(len(x), 1)
        apart = x[j] > x[i]
        return float(np.median((y[j] - y[i])[apart] / (x[j] - x[i])[apart]))
    bound = float((y.max() - y.min()) / np.diff(np.unique(x)).min()) + 1.0

    def kth(k: int) -> float:
        low, high = -bound, bound
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (low, mid) if _not_above(x, y, mid) >= k else (mid, high)
        return high

    return (kth((pairs + 1) // 2) + kth(pairs // 2 + 1)) / 2


def theil_sen(df: DataFrame, by: list[str], x: str, y: str, limit: float = 20.0, least: int = 3) -> DataFrame:
    """(by..., n, slope): median of the slopes of all pairs, within ±limit; null if all x of a group are the same. Pairs are counted, never made."""
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.select(*by).schema)

    def fit(g: pd.DataFrame) -> pd.DataFrame:
        rows = {**{k: [g[k].iloc[0]] for k in by}, "n": [len(g)], "slope": [median_slope(g["x"].to_numpy(), g["y"].to_numpy()) if len(g) >= least else float("nan")]}
        return pd.DataFrame(rows)

    s = d.groupBy(*by).applyInPandas(fit, f"{kinds}, n bigint, slope double").where(F.col("n") >= least)
    return s.select(*by, "n", clip(F.nanvl("slope", F.lit(None).cast("double")), -limit, limit).alias("slope")).where("slope is not null")


def nearby_pairs(points: DataFrame, segments: DataFrame, radius_m: float, most: int = 8, widest_angle: float = 75.0) -> DataFrame:
    """(pid, sid, distance, place): segments near points, found through grid cells of the radius, refined exactly, the nearest `most` kept.

    points: pid, x, y, heading; segments: sid, ax, ay, bx, by (metres). A segment is put into every cell its box touches, so
    matching is an equi-join; no pair outside neighbouring cells is made.
    """
    from flowmark.functions.physics import point_segment_distance

    cell = lambda c: F.floor(c / radius_m).cast("bigint")
    around = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    p = points.withColumn("_dx", around).withColumn("_dy", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("cx", cell(F.col("x")) + F.col("_dx")).withColumn("cy", cell(F.col("y")) + F.col("_dy"))
    s = segments.withColumn("cx", F.explode(F.sequence(cell(F.least("ax", "bx")), cell(F.greatest("ax", "bx"))))).withColumn("cy", F.explode(F.sequence(cell(F.least("ay", "by")), cell(F.greatest("ay", "by")))))
    j = p.join(s, ["cx", "cy"]).withColumn("distance", point_segment_distance(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
    j = j.withColumn("angle", angle_difference(F.col("heading"), F.pmod(F.degrees(F.atan2(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))) + 360, F.lit(360.0))))
    j = j.where((F.col("distance") <= radius_m) & (F.col("angle") <= widest_angle)).groupBy("pid", "sid").agg(F.min("distance").alias("distance"), F.min("angle").alias("angle"))
    return j.withColumn("place", F.row_number().over(Window.partitionBy("pid").orderBy("distance", "sid"))).where(F.col("place") <= most)


def local_metres(lat: Column, lon: Column, lat0: float, lon0: float) -> tuple[Column, Column]:
    """East and north metres from an origin on a local plane."""
    import math

    return (lon - lon0) * (111_320.0 * math.cos(math.radians(lat0))), (lat - lat0) * 110_540.0


def plane_feet(lon: Column, lat: Column, origin: tuple[float, float]) -> tuple[Column, Column]:
    """x_ft and y_ft of a point on a plane about an origin (longitude, latitude)."""
    import math

    return ((lon - origin[0]) * (365_228.0 * math.cos(math.radians(origin[1])))).alias("x_ft"), ((lat - origin[1]) * 362_664.0).alias("y_ft")


def segment_bearings(meta: DataFrame) -> DataFrame:
    return meta.select("tmc", bearing(F.col("start_latitude"), F.col("start_longitude"), F.col("end_latitude"), F.col("end_longitude")).alias("bearing"))


def profile_blend(left: Column, right: Column, weight_left: Column, reference: Column, distance: Column, scale: float) -> Column:
    """Two neighbours' values by their weights, drawn towards a reference with distance, within their envelope."""
    mix = left * weight_left + right * (1 - weight_left)
    keep = F.exp(-distance / scale)
    low, high = F.least(left, right, reference), F.greatest(left, right, reference)
    return clip(mix * keep + reference * (1 - keep), low, high)


def treatment_tier(managed: Column, gap_ft: Column, distance_mi: Column) -> Column:
    """Tier of a member without observation: 1 managed, 2 interpolation, 3 near, 4 far, 9 excluded."""
    return F.when(managed, 1).when(gap_ft <= 500, 2).when(distance_mi <= 1, 3).when(distance_mi <= 5, 4).otherwise(9)
