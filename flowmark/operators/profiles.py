"""Ingest of readings, regular profiles, observation quality and corridor speeds.

Column names are parameters with the domain's names as defaults. Rows with null keys are left out unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.functions.clock import day_number, minute_of_day, slot_seconds, weekday_of
from flowmark.functions.physics import clip, div
from flowmark.schema import FREE_FLOW_CLIP, MIN_LENGTH_COVERAGE, VALID_SPEED
from flowmark.session import code, number


def clean_readings(df: DataFrame, least_confidence: float | None = None) -> DataFrame:
    """tmc_code in normal form, ts, speed and the optional columns that exist; no rows without code or time."""
    have = [c for c in ("reference_speed", "confidence_score", "reading_id", "received_at") if c in df.columns]
    out = df.select(code("tmc_code").alias("tmc_code"), F.col("measurement_tstamp").alias("ts"), number("speed").alias("speed"), *have)
    out = out.where("tmc_code is not null and ts is not null")
    if least_confidence is not None and "confidence_score" in have:
        out = out.where(F.col("confidence_score") >= least_confidence)
    return out


def assert_grid(df: DataFrame, ts: str = "ts", minutes: int = 15) -> DataFrame:
    """df; evaluating it fails if any time lies off the grid."""
    off = F.unix_micros(F.col(ts).cast("timestamp")) % (minutes * 60_000_000) != 0
    return df.withColumn(ts, F.when(off, F.raise_error(F.concat(F.lit("off the grid: "), F.col(ts).cast("string")))).otherwise(F.col(ts)))


def resample_median(readings: DataFrame, minutes: int = 15, limits: tuple[float, float] = VALID_SPEED) -> DataFrame:
    """(tmc_code, slot_s, speed, n): exact median of the valid speeds per sensor and slot, in one level."""
    rows = readings.where(F.col("speed").between(*limits)).withColumn("slot_s", slot_seconds("ts", minutes))
    return rows.groupBy("tmc_code", "slot_s").agg(F.median("speed").alias("speed"), F.count("*").alias("n"))


def weekday_profile(slots: DataFrame) -> DataFrame:
    """(tmc_code, t_min, speed, n_days): average weekday per sensor and minute of the day.

    Speeds have nine digits, so that equal averages are equal however their rows were partitioned.
    """
    s = F.col("slot_s")
    rows = slots.where(weekday_of(s) < 5).withColumn("t_min", minute_of_day(s)).withColumn("day", day_number(s))
    return rows.groupBy("tmc_code", "t_min").agg(F.round(F.avg("speed"), 9).alias("speed"), F.countDistinct("day").alias("n_days"))


def free_flow(slots: DataFrame, share: float = 0.85) -> DataFrame:
    """(tmc_code, free_speed): a high percentile of the sensor's speeds, clipped to plausible free-flow speeds."""
    return slots.groupBy("tmc_code").agg(clip(F.percentile("speed", F.lit(share)), *FREE_FLOW_CLIP).alias("free_speed"))


def normalised_profile(profile: DataFrame) -> DataFrame:
    """profile with p95 of the sensor and speed / p95."""
    p = profile.groupBy("tmc_code").agg(F.percentile("speed", F.lit(0.95)).alias("p95"))
    return profile.join(p, "tmc_code").withColumn("ratio", div(F.col("speed"), F.col("p95")))


def latest_metadata(meta: DataFrame) -> DataFrame:
    """One row per sensor: the latest start date (null first), then the greatest road order; ties by all other columns."""
    rows = meta.withColumn("tmc", code("tmc")).where("tmc is not null").withColumn("start", F.try_to_timestamp(F.col("active_start_date"), F.lit("yyyy-MM-dd")).cast("date"))
    order = [F.col("start").desc_nulls_last(), F.col("road_order").desc_nulls_last(), F.col("miles").desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in ("road", "direction", "start_latitude"))]
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("tmc").orderBy(*order))).where("place = 1").drop("place", "start")


def observation_quality(readings: DataFrame, meta: DataFrame, limits: tuple[float, float] = VALID_SPEED) -> DataFrame:
    """(tmc_code, road, valid_share, interval_share, weekday_share, bin_share, score): how well a sensor is observed.

    Shares are against the road's distinct quarter hours, weekdays and minutes of the day; score = 0.20, 0.50, 0.15, 0.15.
    """
    s = F.col("slot_s")
    rows = readings.join(meta.select(F.col("tmc").alias("tmc_code"), "road"), "tmc_code").where("road is not null")
    rows = rows.withColumn("slot_s", slot_seconds("ts")).withColumn("ok", F.coalesce(F.col("speed").between(*limits), F.lit(False)))
    # one row per road, sensor and quarter hour; everything else is counted from these
    seen = rows.groupBy("road", "tmc_code", "slot_s").agg(F.count("*").alias("n"), F.count_if("ok").alias("good"))
    day, t = F.when((F.col("good") > 0) & (weekday_of(s) < 5), day_number(s)), F.when(F.col("good") > 0, minute_of_day(s))
    mine = seen.groupBy("road", "tmc_code").agg((F.sum("good") / F.sum("n")).alias("valid_share"), F.count_if(F.col("good") > 0).alias("i"), F.countDistinct(day).alias("d"), F.countDistinct(t).alias("b"))
    any_ = seen.groupBy("road", "slot_s").agg(F.max("good").alias("good"))
    all_ = any_.groupBy("road").agg(F.count_if(F.col("good") > 0).alias("ri"), F.countDistinct(day).alias("rd"), F.countDistinct(t).alias("rb"))
    share = lambda a, b: F.coalesce(div(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    out = mine.join(all_, "road").select("tmc_code", "road", "valid_share", share("i", "ri").alias("interval_share"), share("d", "rd").alias("weekday_share"), share("b", "rb").alias("bin_share"))
    return out.withColumn("score", 0.20 * F.col("valid_share") + 0.50 * F.col("interval_share") + 0.15 * F.col("weekday_share") + 0.15 * F.col("bin_share"))


def harmonic_speed(speed: Column, length: Column) -> Column:
    """Aggregate: length-weighted harmonic mean over rows with speed and length above 0."""
    ok = (speed > 0) & (length > 0)
    return div(F.sum(F.when(ok, length)), F.sum(F.when(ok, length / F.when(speed > 0, speed))))


def weighted_mean(x: Column, weight: Column) -> Column:
    ok = x.isNotNull() & weight.isNotNull()
    return div(F.sum(F.when(ok, x * weight)), F.sum(F.when(ok, weight)))


def corridor_profile(profile: DataFrame, members: DataFrame, least: float = MIN_LENGTH_COVERAGE) -> DataFrame:
    """(corridor, t_min, speed, coverage): harmonic speed per corridor and bin, null where too little of the length is seen.

    members: corridor, tmc_code, miles, distinct.
    """
    length = members.where("miles > 0").groupBy("corridor").agg(F.sum("miles").alias("total"))
    rows = profile.join(members.where("miles > 0"), "tmc_code").groupBy("corridor", "t_min").agg(harmonic_speed(F.col("speed"), F.col("miles")).alias("v"), F.sum(F.when(F.col("speed") > 0, F.col("miles"))).alias("seen"))
    rows = rows.join(length, "corridor").withColumn("coverage", F.coalesce(F.col("seen"), F.lit(0.0)) / F.col("total"))
    return rows.select("corridor", "t_min", F.when(F.col("coverage") >= least, F.col("v")).alias("speed"), "coverage")


def two_level_profile(fine: DataFrame, by: list[str], samples: int = 3, fine_min: int = 5) -> DataFrame:
    """Harmonic speed per fine bin, then the arithmetic mean of a coarse bin's samples; null where one is missing. fine: by..., t_min, speed, length."""
    one = fine.groupBy(*by, "t_min").agg(harmonic_speed(F.col("speed"), F.col("length")).alias("v"))
    coarse = one.withColumn("t_min", (F.floor(F.col("t_min") / (samples * fine_min)) * samples * fine_min).cast("int"))
    return coarse.groupBy(*by, "t_min").agg(F.when(F.count("v") == samples, F.avg("v")).alias("speed"), F.count("v").alias("samples"))


def edge_speeds(profile: DataFrame, edges: tuple[int, ...] = (360, 540, 900, 1140)) -> DataFrame:
    """Per sensor the profile's speed at the period edges, as start and end per period."""
    rows = profile.where(F.col("t_min").isin(*edges)).groupBy("tmc_code").pivot("t_min", list(edges)).agg(F.avg("speed"))
    a, b, c, d = (F.col(str(e)) for e in edges)
    return rows.select("tmc_code", a.alias("am_start"), b.alias("am_end"), b.alias("md_start"), c.alias("md_end"), c.alias("pm_start"), d.alias("pm_end"), d.alias("nt_start"), a.alias("nt_end"))


def wide_to_long(df: DataFrame, ids: list[str], prefix: str = "spd_mph_") -> DataFrame:
    """(ids..., t_min, speed) of columns such as spd_mph_07:35; columns of other names are left out."""
    from flowmark.functions.clock import clock_of_column

    cols = [c for c in df.columns if c.startswith(prefix)]
    return df.unpivot(ids, [F.col(f"`{c}`") for c in cols], "name", "speed").select(*ids, clock_of_column(F.col("name")).alias("t_min"), "speed").where("t_min is not null")


def panel(profile: DataFrame, times: list[int]) -> DataFrame:
    """One row per sensor, one column per minute of the day in `times`: the array form, for sinks only."""
    return profile.where(F.col("t_min").isin(*times)).groupBy("tmc_code").pivot("t_min", times).agg(F.first("speed"))


def cascade(*choices: tuple[str, Column]) -> tuple[Column, Column]:
    """First non-null of several values and the name of its source."""
    source = F.lit(None).cast("string")
    for name, c in reversed(choices):
        source = F.when(c.isNotNull(), F.lit(name)).otherwise(source)
    return F.coalesce(*(c for _, c in choices)), source


def profile_features(slots: DataFrame) -> DataFrame:
    """Per sensor and period of the average weekday: time of the least and greatest speed, ratios, bins seen."""
    from flowmark.functions.clock import period_of

    p = weekday_profile(slots).withColumn("period", period_of(F.col("t_min")))
    out = p.groupBy("tmc_code", "period").agg(
        F.min(F.struct("speed", "t_min"))["t_min"].alias("t_least"), F.max(F.struct(F.col("speed"), -F.col("t_min")))["col2"].alias("t_most"),
        F.min("speed").alias("least"), F.avg("speed").alias("mean"), F.max("speed").alias("most"), F.count("*").alias("bins"),
    )
    return out.select("tmc_code", "period", "t_least", (-F.col("t_most")).alias("t_most"), div(F.col("least"), F.col("most")).alias("least_ratio"), div(F.col("mean"), F.col("most")).alias("mean_ratio"), "bins")


def median_interval(readings: DataFrame) -> DataFrame:
    """(tmc_code, seconds): median time between successive readings of a sensor."""
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    d = readings.select("tmc_code", t.alias("t")).distinct().withColumn("d", F.col("t") - F.lag("t").over(Window.partitionBy("tmc_code").orderBy("t")))
    return d.groupBy("tmc_code").agg(F.median("d").alias("seconds"))
