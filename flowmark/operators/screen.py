"""Screening of episodes: physical rules, robust scores, regimes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAD = 1.4826
SOFT_TO_EXCLUDE = 2


def regime(minutes: Column, speed: Column, limit: Column, z: Column | None = None) -> Column:
    """uncongested, event (robust score beyond 2.5), severe (120 minutes below half the limit), recurring (60 minutes) or mild."""
    known = minutes.isNotNull() & speed.isNotNull() & limit.isNotNull()
    event = F.lit(False) if z is None else F.coalesce(F.abs(z) > 2.5, F.lit(False))
    return (
        F.when(~known | (minutes < 30) | (speed >= limit), "uncongested").when(event, "event")
        .when((minutes >= 120) & (speed < 0.5 * limit), "severe").when(minutes >= 60, "recurring").otherwise("mild")
    )


def robust_z(df: DataFrame, by: list[str], value: str, reference: Column, out: str, least: int = 10) -> DataFrame:
    """df with `out`: distance from the median of the reference rows in 1.4826 * MAD; null below `least` reference rows or without spread."""
    ref = df.where(reference & F.col(value).isNotNull())
    med = ref.groupBy(*by).agg(F.median(value).alias("_m"), F.count("*").alias("_n"))
    mad = ref.join(med, by).groupBy(*by).agg((F.median(F.abs(F.col(value) - F.col("_m"))) * MAD).alias("_s"))
    d = df.join(med, by, "left").join(mad, by, "left")
    return d.withColumn(out, F.when((F.col("_n") >= least) & (F.col("_s") > 0), (F.col(value) - F.col("_m")) / F.nullif("_s", F.lit(0.0)))).drop("_m", "_n", "_s")


# Names and limits of the physical rules, any of which excludes an episode.
PHYSICAL = {
    "state_nonfinite": "minutes is null or doc is null or speed is null", "duration_exceeds_day": "minutes > 1440", "doc_above_physical": "doc > 8",
    "speed_out_of_range": "speed not between 0 and 90", "mu_nonpositive": "mu <= 0", "doc_high_P_zero": "doc > 1 and minutes < 15", "mu_above_capacity": "mu > 1.05 * capacity",
    "mu_starved": "doc > 1.5 and mu < 0.30 * capacity", "vt2_above_threshold": "speed >= limit", "vt2_too_low": "speed < 5",
}


def hard_rules(minutes: str, doc: str, speed: str, mu: str, capacity: str, limit: str) -> tuple[Column, Column]:
    """A struct of the rules' inputs, to be added as `_own`, and the names of the physical rules that hold, joined by semicolons."""
    own = F.struct(*(F.col(c).alias(n) for n, c in (("minutes", minutes), ("doc", doc), ("speed", speed), ("mu", mu), ("capacity", capacity), ("limit", limit))))
    words = "|".join(("minutes", "doc", "speed", "mu", "capacity", "limit"))
    hold = [F.when(F.expr(re.sub(rf"\b({words})\b", r"_own.\1", rule)), F.lit(name)) for name, rule in PHYSICAL.items()]
    return own, F.concat_ws(";", *hold)


def screen(df: DataFrame, by: list[str], valid: Column, soft: dict[str, Column] | None = None, minutes: str = "minutes", doc: str = "doc", speed: str = "min_speed", mu: str = "mu", capacity: str = "capacity", limit: str = "limit") -> DataFrame:
    """df with hard and soft (names of the rules that hold), excluded, clean.

    Soft rules (low doc with long duration, robust scores above 3.5, and those given) exclude from two on.
    """
    d = df.withColumn("_v", valid)
    d = robust_z(d, by, minutes, F.col("_v"), "z_minutes")
    d = robust_z(d, by, doc, F.col("_v"), "z_doc")
    rules = {"low_doc_long": (F.col(doc) < 0.5) & (F.col(minutes) > 60), "duration_outlier": F.col("z_minutes") > 3.5, "doc_outlier": F.col("z_doc") > 3.5} | (soft or {})
    own, hard = hard_rules(minutes, doc, speed, mu, capacity, limit)
    names = lambda rs: F.concat_ws(";", *(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rs.items()))
    count = sum((F.coalesce(c, F.lit(False)).cast("int") for c in rules.values()), F.lit(0))
    d = d.withColumn("_own", own).withColumn("hard", hard).drop("_own").withColumn("soft", names(rules))
    return d.withColumn("excluded", (F.col("hard") != "") | (count >= SOFT_TO_EXCLUDE)).withColumn("clean", F.col("_v") & ~F.col("excluded")).drop("_v")
