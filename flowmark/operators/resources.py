"""Lookup resources made from episodes: class fits with an overall fallback, primary-only assignment, profile detector, anchor curves, overlap of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.functions.physics import clip, div, smoothstep
from flowmark.operators import calibrate, islands


def class_resource(episodes: DataFrame, classes: DataFrame, least: int = 5) -> DataFrame:
    """(link_class, period, f_d, n_exp, f_p, s, alpha, beta, source): a fit per class and period, the period's overall fit where a class has too few.

    episodes: link_class, period, doc, p_hr, min_speed, limit. classes: link_class, period to give.
    """
    names = ["f_d", "n_exp", "f_p", "s", "alpha", "beta"]
    own = calibrate.fit_qvdf(episodes, ["link_class", "period"], least=least)
    all_ = calibrate.fit_qvdf(episodes, ["period"], least=least)
    out = calibrate.with_scope_fallback(classes.select("link_class", "period").distinct(), own, all_, ["link_class", "period"], ["period"], names)
    return out.withColumn("source", F.when(F.col("scope") == "sensor_period", "class").when(F.col("scope") == "corridor_period", "all").otherwise("none")).drop("scope")


def primary_only(winners: DataFrame, episodes: DataFrame) -> DataFrame:
    """(link_id, period, tmc, t0, t2, t3, source, protected): each link gets its frozen sensor's episode; observed without episode it is protected and gets none.

    winners: link_id, period, tmc, one row per link and period. episodes: tmc, period, t0, t2, t3, one row per sensor and period.
    """
    j = winners.select("link_id", "period", "tmc").join(episodes.select("tmc", "period", "t0", "t2", "t3", F.lit(True).alias("there")), ["tmc", "period"], "left")
    seen = F.coalesce("there", F.lit(False))
    return j.select("link_id", "period", "tmc", "t0", "t2", "t3", F.when(seen, "direct").otherwise("observed_no_congestion").alias("source"), (~seen).alias("protected"))


def profile_detector(profile: DataFrame, share: float = 0.7, step: int = 15, merge: int = 1, least_min: int = 30) -> DataFrame:
    """(tmc_code, t0, t2, t3, least): the worst run of a normalised profile (tmc_code, t_min, ratio) below `share`, runs merged over `merge` bins."""
    keep = [F.min("ratio").alias("least"), F.min(F.struct("ratio", "t_min"))["t_min"].alias("t2")]
    runs = islands.islands(profile, ["tmc_code"], "t_min", F.col("ratio") < share, step, keep, gap=merge).where(F.col("minutes") >= least_min)
    w = Window.partitionBy("tmc_code").orderBy("least", F.col("minutes").desc(), "start")
    return runs.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("tmc_code", F.col("start").alias("t0"), "t2", F.col("end").alias("t3"), "least")


def anchor_curve(bins: DataFrame, anchors: DataFrame) -> DataFrame:
    """(key, t_min, speed): smooth steps between a key's anchors (key, t_min, speed); flat before the first and after the last."""
    u = bins.select("key", "t_min", F.lit(None).cast("double").alias("a"), F.lit(True).alias("bin")).unionByName(anchors.select("key", "t_min", F.col("speed").alias("a"), F.lit(False).alias("bin")))
    w = Window.partitionBy("key").orderBy("t_min", F.col("bin").cast("int"))
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col("a").isNotNull(), F.col("t_min"))
    u = u.withColumn("l", F.last("a", True).over(before)).withColumn("tl", F.last(at, True).over(before)).withColumn("r", F.first("a", True).over(after)).withColumn("tr", F.first(at, True).over(after))
    mid = F.col("l") + (F.col("r") - F.col("l")) * smoothstep(div((F.col("t_min") - F.col("tl")).cast("double"), (F.col("tr") - F.col("tl")).cast("double")))
    return u.where("bin").select("key", "t_min", F.coalesce(mid, "l", "r").alias("speed"))


def weighted_profile(left: Column, right: Column, weight_right: Column) -> Column:
    """Two neighbours' normalised values by weight; where one is unknown the other is carried."""
    return F.coalesce(left * (1 - weight_right) + right * weight_right, left, right)


def overlap_share(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column, dx: Column, dy: Column, width: float) -> Column:
    """Share of the segment a-b that lies within `width` of the line c-d and between its ends (flat caps)."""
    n = F.sqrt(F.pow(dx - cx, 2) + F.pow(dy - cy, 2))
    along = lambda x, y: div((x - cx) * (dx - cx) + (y - cy) * (dy - cy), n)
    across = lambda x, y: div((x - cx) * (dy - cy) - (y - cy) * (dx - cx), n)

    def inside(u: Column, v: Column, low: Column, high: Column) -> tuple[Column, Column]:
        """Range of t in 0..1 where u + t (v - u) lies in low..high; an empty range has its end before its start."""
        p, q = div(low - u, v - u), div(high - u, v - u)
        flat = (v - u) == 0
        ok = (u >= low) & (u <= high)
        return F.when(flat, F.when(ok, 0.0).otherwise(1.0)).otherwise(F.least(p, q)), F.when(flat, F.when(ok, 1.0).otherwise(0.0)).otherwise(F.greatest(p, q))

    s1, e1 = inside(along(ax, ay), along(bx, by), F.lit(0.0), n)
    s2, e2 = inside(across(ax, ay), across(bx, by), F.lit(-width), F.lit(width))
    return clip(F.least(e1, e2, F.lit(1.0)) - F.greatest(s1, s2, F.lit(0.0)), 0.0, 1.0)


def require(df: DataFrame, columns: list[str], name: str = "table") -> DataFrame:
    """df, or an error if columns are missing or it has no row: the check of an input before a run."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: columns are missing: {missing}")
    if df.limit(1).count() == 0:
        raise ValueError(f"{name}: no rows")
    return df


def with_default(table: DataFrame, key: str, default: str = "all") -> DataFrame:
    """table, or an error if it has no row for the default key."""
    if table.where(F.col(key) == default).limit(1).count() == 0:
        raise ValueError(f"no row for {default!r}")
    return table
