"""Queries of ingest, quality control, profiles, islands and measurement, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics
from flowmark.operators import islands, profiles, qc
from flowmark.session import table

#: Results are compared by value: sums that may be large have six digits, everything else eight.
SIX = {"volume", "miles", "mapped", "travel_h", "free_h", "delay_h", "severe_h", "vmt", "vht", "bus_delay_h", "person_delay_h", "total", "episode_demand", "period_demand", "demand", "achieved"}


def r(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 8)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(f"`{c}`"), 6 if c in SIX else 8).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def registry(queries: dict, sqls: dict):
    """A decorator that registers a query (its result rounded) and its SQL."""

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = lambda spark, d: rounded(f(spark, d))
            if sql:
                sqls[f.__name__] = sql
            return f

        return add

    return query


def readings(spark: SparkSession, d: str) -> DataFrame:
    return profiles.clean_readings(table(spark, d, "readings"))


def slots(spark: SparkSession, d: str) -> DataFrame:
    return profiles.resample_median(readings(spark, d))


def members(spark: SparkSession, d: str) -> DataFrame:
    """corridor, tmc_code, miles: the latest metadata of each sensor with a road and a length."""
    m = profiles.latest_metadata(table(spark, d, "tmc_metadata"))
    return m.select(F.concat_ws(" ", "road", "direction").alias("corridor"), F.col("tmc").alias("tmc_code"), "miles").where("road is not null and direction is not null and miles > 0")


_R = """r AS (SELECT upper(trim(tmc_code, ' \t\r\n')) AS tmc_code, measurement_tstamp AS ts, epoch_us(measurement_tstamp) AS us, speed, reference_speed, confidence_score FROM readings
      WHERE nullif(trim(tmc_code, ' \t\r\n'), '') IS NOT NULL AND measurement_tstamp IS NOT NULL)"""
_S = f"""{_R}, s AS (SELECT tmc_code, us // 900000000 * 900 AS slot_s, median(speed) AS speed, count(*) AS n FROM r WHERE speed BETWEEN 1 AND 150 GROUP BY tmc_code, us // 900000000 * 900),
w AS (SELECT *, slot_s // 86400 AS day, (slot_s // 86400 + 3) % 7 AS wd, slot_s % 86400 // 60 AS t_min FROM s)"""
_W = f"""{_S}, p AS (SELECT tmc_code, CAST(t_min AS INT) AS t_min, round(avg(speed), 9) AS speed, count(DISTINCT day) AS n_days FROM w WHERE wd < 5 GROUP BY tmc_code, t_min)"""
_M = """m AS (SELECT upper(trim(tmc, ' \t\r\n')) AS tmc, road, direction, miles, road_order, start_latitude, start_longitude, end_latitude, end_longitude, active_start_date FROM tmc_metadata WHERE tmc IS NOT NULL),
meta AS (SELECT *, row_number() OVER (PARTITION BY tmc ORDER BY TRY_CAST(active_start_date AS DATE) DESC NULLS LAST, road_order DESC NULLS LAST, miles DESC NULLS LAST,
         road ASC NULLS LAST, direction ASC NULLS LAST, start_latitude ASC NULLS LAST) AS place FROM m),
mem AS (SELECT road || ' ' || direction AS corridor, tmc AS tmc_code, miles FROM meta WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL AND miles > 0)"""
_PERIOD = "CASE WHEN {m} % 1440 BETWEEN 360 AND 539 THEN 'AM' WHEN {m} % 1440 BETWEEN 540 AND 899 THEN 'MD' WHEN {m} % 1440 BETWEEN 900 AND 1139 THEN 'PM' WHEN {m} IS NOT NULL THEN 'NT' END"
QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


# ---- ingest ---------------------------------------------------------------------------------------------------------


@query(f"WITH {_R} SELECT tmc_code, count(*) AS n, count(speed) AS n_speed, round(avg(speed), 8) AS mean_speed FROM r WHERE confidence_score >= 30 GROUP BY tmc_code")
def scan_confident_readings(spark, d):
    rows = profiles.clean_readings(table(spark, d, "readings"), 30.0)
    return rows.groupBy("tmc_code").agg(F.count("*").alias("n"), F.count("speed").alias("n_speed"), r(F.avg("speed")).alias("mean_speed"))


@query(f"WITH {_S} SELECT tmc_code, slot_s, round(speed, 8) AS speed, n FROM s")
def resample_15min_median(spark, d):
    return rounded(profiles.assert_grid(slots(spark, d).withColumn("ts", F.timestamp_seconds("slot_s"))).drop("ts"))


@query(f"WITH {_W} SELECT tmc_code, t_min, round(speed, 8) AS speed, n_days FROM p")
def average_weekday(spark, d):
    return rounded(profiles.weekday_profile(slots(spark, d)))


@query(f"WITH {_M} SELECT tmc, road, direction, miles, road_order, active_start_date FROM meta WHERE place = 1")
def latest_metadata(spark, d):
    return profiles.latest_metadata(table(spark, d, "tmc_metadata")).select("tmc", "road", "direction", "miles", "road_order", "active_start_date")


@query(f"""WITH {_R}, {_M}, j AS (SELECT r.tmc_code, road, us // 900000000 * 900 AS s, coalesce(speed BETWEEN 1 AND 150, false) AS ok FROM r JOIN meta ON r.tmc_code = meta.tmc WHERE place = 1 AND road IS NOT NULL),
f AS (SELECT *, CASE WHEN ok THEN s END AS slot, CASE WHEN ok AND (s // 86400 + 3) % 7 < 5 THEN s // 86400 END AS day, CASE WHEN ok THEN s % 86400 // 60 END AS t FROM j),
a AS (SELECT road, tmc_code, avg(ok::INT) AS v, count(DISTINCT slot) AS i, count(DISTINCT day) AS dd, count(DISTINCT t) AS b FROM f GROUP BY road, tmc_code),
g AS (SELECT road, count(DISTINCT slot) AS ri, count(DISTINCT day) AS rd, count(DISTINCT t) AS rb FROM f GROUP BY road),
x AS (SELECT tmc_code, road, v AS valid_share, coalesce(i / nullif(ri, 0), 0) AS interval_share, coalesce(dd / nullif(rd, 0), 0) AS weekday_share, coalesce(b / nullif(rb, 0), 0) AS bin_share FROM a JOIN g USING (road))
SELECT tmc_code, road, round(valid_share, 8) AS valid_share, round(interval_share, 8) AS interval_share, round(weekday_share, 8) AS weekday_share, round(bin_share, 8) AS bin_share,
       round(0.20 * valid_share + 0.50 * interval_share + 0.15 * weekday_share + 0.15 * bin_share, 8) AS score FROM x""")
def observation_quality(spark, d):
    return rounded(profiles.observation_quality(readings(spark, d), profiles.latest_metadata(table(spark, d, "tmc_metadata"))))


@query(f"""WITH {_R} SELECT tmc_code, CASE WHEN max(reference_speed) IS NOT NULL THEN 'reference' WHEN count(speed) > 0 THEN 'observed' ELSE 'default' END AS source,
round(coalesce(max(reference_speed), quantile_cont(speed, 0.95), 60.0), 8) AS free_speed FROM r GROUP BY tmc_code""")
def value_source_cascade(spark, d):
    rows = readings(spark, d).groupBy("tmc_code").agg(F.max("reference_speed").alias("a"), F.percentile("speed", F.lit(0.95)).alias("b"))
    value, source = profiles.cascade(("reference", F.col("a")), ("observed", F.col("b")), ("default", F.lit(60.0)))
    return rows.select("tmc_code", source.alias("source"), r(value).alias("free_speed"))


@query(f"WITH {_S} SELECT tmc_code, round(least(greatest(quantile_cont(speed, 0.85), 35), 85), 8) AS free_speed FROM s GROUP BY tmc_code")
def free_flow_speed(spark, d):
    return rounded(profiles.free_flow(slots(spark, d)))


@query(f"""WITH {_R}, t AS (SELECT DISTINCT tmc_code, us // 1000000 AS t FROM r), g AS (SELECT tmc_code, t - lag(t) OVER (PARTITION BY tmc_code ORDER BY t) AS dt FROM t)
SELECT tmc_code, CAST(median(dt) AS DOUBLE) AS seconds FROM g GROUP BY tmc_code""")
def median_sampling_interval(spark, d):
    return profiles.median_interval(readings(spark, d)).withColumn("seconds", F.col("seconds").cast("double"))


# ---- quality control ------------------------------------------------------------------------------------------------

_J = f"{_S}, v AS (SELECT tmc_code, least(greatest(quantile_cont(speed, 0.85), 35), 85) AS vf FROM s GROUP BY tmc_code)"


@query(f"""WITH {_J} SELECT tmc_code, slot_s, speed >= 0 AND speed <= least(vf * 1.25, 90) AS range_ok,
coalesce(abs(speed - lag(speed) OVER (PARTITION BY tmc_code ORDER BY slot_s)) <= 30, true) AS jump_ok, 1 AS spatial_ok FROM s JOIN v USING (tmc_code)""")
def qc_range_and_jump(spark, d):
    s = slots(spark, d)
    rows = s.join(profiles.free_flow(s), "tmc_code")
    return rows.select("tmc_code", "slot_s", qc.hard_range(F.col("speed"), F.col("free_speed")).alias("range_ok"), qc.jump_ok("tmc_code", "slot_s", "speed").alias("jump_ok"), qc.spatial_ok().alias("spatial_ok"))


@query(f"""WITH {_S}, a AS (SELECT *, median(speed) OVER (PARTITION BY tmc_code ORDER BY slot_s ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS rm FROM s),
b AS (SELECT *, abs(speed - rm) AS dev, median(abs(speed - rm)) OVER (PARTITION BY tmc_code ORDER BY slot_s ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS mad FROM a),
u AS (SELECT tmc_code, median(nullif(mad, 0)) AS usual FROM b GROUP BY tmc_code)
SELECT tmc_code, slot_s, round(rm, 8) AS roll_median, round(mad, 8) AS roll_mad, dev <= 3 * 1.4826 * coalesce(nullif(mad, 0), usual, 1) AS hampel_ok FROM b JOIN u USING (tmc_code)""")
def hampel_filter(spark, d):
    return rounded(qc.hampel(slots(spark, d), "tmc_code", "slot_s", "speed").select("tmc_code", "slot_s", "roll_median", "roll_mad", "hampel_ok"))


_G = f"""{_S}, f AS (SELECT tmc_code, min(slot_s) AS a, max(slot_s) AS b FROM s GROUP BY tmc_code), grid AS (SELECT tmc_code, unnest(range(a, b + 900, 900)) AS slot_s FROM f),
y AS (SELECT grid.tmc_code, grid.slot_s, s.speed FROM grid LEFT JOIN s ON grid.tmc_code = s.tmc_code AND grid.slot_s = s.slot_s)"""


def full_grid(spark, d) -> DataFrame:
    """Every slot from a sensor's first to its last, null where nothing was seen. Gaps are filled by stretches of up to 96 slots, so no long array is made."""
    s = slots(spark, d).select("tmc_code", "slot_s", "speed")
    step = F.lit(900).cast("bigint")
    last = F.coalesce(F.lead("slot_s").over(Window.partitionBy("tmc_code").orderBy("slot_s")) - step, F.col("slot_s"))  # before the next reading
    stretches = s.withColumn("last", last).withColumn("a", F.explode(F.sequence("slot_s", "last", step * 96)))
    grid = stretches.withColumn("at", F.explode(F.sequence("a", F.least(F.col("a") + step * 95, F.col("last")), step)))
    return grid.select("tmc_code", F.col("at").alias("slot_s"), F.when(F.col("at") == F.col("slot_s"), F.col("speed")).alias("speed"))


@query(f"""WITH {_G}, l AS (SELECT *, lag(speed) OVER q AS x, lead(speed) OVER q AS z FROM y WINDOW q AS (PARTITION BY tmc_code ORDER BY slot_s))
SELECT tmc_code, slot_s, round((x + z) / 2, 8) AS repaired FROM l WHERE speed IS NULL AND x IS NOT NULL AND z IS NOT NULL""")
def repair_single_gaps(spark, d):
    return qc.repair_single_gaps(full_grid(spark, d), "tmc_code", "slot_s", "speed").where("was_repaired").select("tmc_code", "slot_s", r("repaired").alias("repaired"))


@query(f"""WITH {_G}, n AS (SELECT tmc_code, slot_s, row_number() OVER (PARTITION BY tmc_code ORDER BY slot_s) - row_number() OVER (PARTITION BY tmc_code, speed IS NULL ORDER BY slot_s) AS g, speed FROM y)
SELECT tmc_code, min(slot_s) AS start, count(*) AS length FROM n WHERE speed IS NULL GROUP BY tmc_code, g HAVING count(*) >= 2""")
def missing_runs(spark, d):
    return qc.null_runs(full_grid(spark, d), "tmc_code", "slot_s", "speed")


@query(f"""WITH {_G}, l AS (SELECT *, last_value(speed IGNORE NULLS) OVER p AS a, last_value(CASE WHEN speed IS NOT NULL THEN slot_s END IGNORE NULLS) OVER p AS ta,
first_value(speed IGNORE NULLS) OVER q AS b, first_value(CASE WHEN speed IS NOT NULL THEN slot_s END IGNORE NULLS) OVER q AS tb FROM y
WINDOW p AS (PARTITION BY tmc_code ORDER BY slot_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), q AS (PARTITION BY tmc_code ORDER BY slot_s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT tmc_code, round(sum(coalesce(speed, a + (b - a) * (slot_s - ta) / nullif(tb - ta, 0), a, b)), 6) AS total, count(*) AS n FROM l GROUP BY tmc_code""")
def interpolate_gaps(spark, d):
    return qc.interpolate(full_grid(spark, d), "tmc_code", "slot_s", "speed").groupBy("tmc_code").agg(r(F.sum("filled")).alias("total"), F.count("*").alias("n"))


@query(f"""WITH {_S} SELECT tmc_code, slot_s, round(avg(speed) OVER (PARTITION BY tmc_code ORDER BY slot_s ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 8) AS mean3,
round(coalesce((-3 * lag(speed, 2) OVER q + 12 * lag(speed) OVER q + 17 * speed + 12 * lead(speed) OVER q - 3 * lead(speed, 2) OVER q) / 35, speed), 8) AS savgol5 FROM s WINDOW q AS (PARTITION BY tmc_code ORDER BY slot_s)""")
def smoothing(spark, d):
    return rounded(slots(spark, d).select("tmc_code", "slot_s", qc.rolling_mean("tmc_code", "slot_s", "speed").alias("mean3"), qc.savgol("tmc_code", "slot_s", "speed").alias("savgol5")))


@query(f"""WITH {_J}, q AS (SELECT tmc_code, speed >= 0 AND speed <= least(vf * 1.25, 90) AS a, coalesce(abs(speed - lag(speed) OVER (PARTITION BY tmc_code ORDER BY slot_s)) <= 30, true) AS b FROM s JOIN v USING (tmc_code))
SELECT tmc_code, count(*) AS n, round(avg(a::INT), 8) AS range_ok_share, round(avg(b::INT), 8) AS jump_ok_share, round(avg((a AND b)::INT), 8) AS pass_share FROM q GROUP BY tmc_code""")
def qc_summary(spark, d):
    return rounded(qc.qc_summary(qc_range_and_jump(spark, d), "tmc_code", ["range_ok", "jump_ok"]))


# ---- profiles -------------------------------------------------------------------------------------------------------

_C = f"""{_W}, {_M}, len AS (SELECT corridor, sum(miles) AS total FROM mem GROUP BY corridor),
c AS (SELECT corridor, t_min, sum(miles) / sum(miles / speed) AS v, sum(miles) / any_value(total) AS coverage FROM p JOIN mem USING (tmc_code) JOIN len USING (corridor) WHERE speed > 0 GROUP BY corridor, t_min)"""


@query(f"WITH {_C} SELECT corridor, t_min, round(CASE WHEN coverage >= 0.8 THEN v END, 8) AS speed, round(coverage, 8) AS coverage FROM c")
def corridor_profile(spark, d):
    return rounded(profiles.corridor_profile(profiles.weekday_profile(slots(spark, d)), members(spark, d)))


@query(f"""WITH {_R}, {_M}, f AS (SELECT tmc_code, us // 300000000 * 5 % 1440 AS t5, avg(speed) AS speed FROM r WHERE speed BETWEEN 1 AND 150 GROUP BY tmc_code, us // 300000000 * 5 % 1440),
h AS (SELECT corridor, t5, sum(miles) / sum(miles / speed) AS v FROM f JOIN mem USING (tmc_code) GROUP BY corridor, t5)
SELECT corridor, CAST(t5 // 15 * 15 AS INT) AS t_min, round(CASE WHEN count(v) = 3 THEN avg(v) END, 8) AS speed, count(v) AS samples FROM h GROUP BY corridor, t5 // 15 * 15""")
def model_corridor_profile(spark, d):
    fine = readings(spark, d).where("speed between 1 and 150").withColumn("t_min", clock.minute_of_day(clock.slot_seconds("ts", 5)))
    fine = fine.groupBy("tmc_code", "t_min").agg(F.avg("speed").alias("speed")).join(members(spark, d).withColumnRenamed("miles", "length"), "tmc_code")
    return rounded(profiles.two_level_profile(fine, ["corridor"]))


@query(f"WITH {_W}, n AS (SELECT tmc_code, quantile_cont(speed, 0.95) AS p95 FROM p GROUP BY tmc_code) SELECT tmc_code, t_min, round(speed / p95, 8) AS ratio FROM p JOIN n USING (tmc_code)")
def normalised_profile(spark, d):
    return rounded(profiles.normalised_profile(profiles.weekday_profile(slots(spark, d))).select("tmc_code", "t_min", "ratio"))


@query(f"""WITH {_W}, e AS (SELECT tmc_code, avg(speed) FILTER (t_min = 360) AS a, avg(speed) FILTER (t_min = 540) AS b, avg(speed) FILTER (t_min = 900) AS c, avg(speed) FILTER (t_min = 1140) AS dd FROM p WHERE t_min IN (360, 540, 900, 1140) GROUP BY tmc_code)
SELECT tmc_code, round(a, 8) AS am_start, round(b, 8) AS am_end, round(b, 8) AS md_start, round(c, 8) AS md_end, round(c, 8) AS pm_start, round(dd, 8) AS pm_end, round(dd, 8) AS nt_start, round(a, 8) AS nt_end FROM e""")
def boundary_speed_pivot(spark, d):
    return rounded(profiles.edge_speeds(profiles.weekday_profile(slots(spark, d))))


@query(f"""WITH {_W}, q AS (SELECT *, {_PERIOD.format(m='t_min')} AS period FROM p) SELECT tmc_code, period, arg_min(t_min, (speed, t_min)) AS t_least, arg_max(t_min, (speed, -t_min)) AS t_most,
round(min(speed) / max(speed), 8) AS least_ratio, round(avg(speed) / max(speed), 8) AS mean_ratio, count(*) AS bins FROM q GROUP BY tmc_code, period""")
def profile_features(spark, d):
    return rounded(profiles.profile_features(slots(spark, d)))


DAY = range(0, 1440, 15)
_BINS = ", ".join(f'round(any_value(speed) FILTER (t_min = {m}), 8) AS "{m}"' for m in DAY)


@query(f"WITH {_W} SELECT tmc_code, {_BINS} FROM p GROUP BY tmc_code")
def profile_panel(spark, d):
    """The panel of all bins of the day."""
    return rounded(profiles.panel(profiles.weekday_profile(slots(spark, d)), list(DAY)))


@query(f"""WITH {_W}, x AS (SELECT tmc_code, CAST(unnest(range(0, 1440, 15)) AS INT) AS t_min FROM (SELECT DISTINCT tmc_code FROM p)) SELECT tmc_code, t_min, round(speed, 8) AS speed FROM x LEFT JOIN p USING (tmc_code, t_min)""")
def wide_profile_to_long(spark, d):
    """All bins of the day, from wide to long."""
    wide = profiles.panel(profiles.weekday_profile(slots(spark, d)), list(DAY)).withColumnsRenamed({str(m): f"spd_mph_{m // 60:02d}:{m % 60:02d}" for m in DAY})
    return rounded(profiles.wide_to_long(wide, ["tmc_code"]))


# ---- islands and agreement ------------------------------------------------------------------------------------------

_F = f"{_W}, v AS (SELECT tmc_code, least(greatest(quantile_cont(speed, 0.95), 35), 85) AS vf FROM s GROUP BY tmc_code), k AS (SELECT p.*, vf * 0.7 AS thr, {_PERIOD.format(m='t_min')} AS period FROM p JOIN v USING (tmc_code))"


def thresholds(spark, d) -> DataFrame:
    """The weekday profile with the congestion threshold of the sensor and the period."""
    s = slots(spark, d)
    return profiles.weekday_profile(s).join(profiles.free_flow(s, 0.95), "tmc_code").withColumn("thr", F.col("free_speed") * 0.7).withColumn("period", clock.period_of(F.col("t_min")))


@query(f"""WITH {_F}, g AS (SELECT *, t_min - 15 * row_number() OVER (PARTITION BY tmc_code, period ORDER BY t_min) AS run FROM k WHERE speed <= thr),
i AS (SELECT tmc_code, period, min(t_min) AS start_min, max(t_min) + 15 AS end_min, count(*) AS bins, min(speed) AS min_speed, arg_min(t_min, (speed, t_min)) AS t2 FROM g GROUP BY tmc_code, period, run),
o AS (SELECT *, row_number() OVER (PARTITION BY tmc_code, period ORDER BY min_speed, bins DESC, start_min) AS place, count(*) OVER (PARTITION BY tmc_code, period) AS n_runs, sum(bins) OVER (PARTITION BY tmc_code, period) * 15 AS minutes FROM i)
SELECT tmc_code, period, start_min, end_min, bins, round(min_speed, 8) AS min_speed, t2, n_runs, CAST(minutes AS BIGINT) AS minutes FROM o WHERE place = 1""")
def weekday_congestion(spark, d):
    """The flagship: average weekday, threshold, congested runs per sensor and period, the worst run, total minutes."""
    keep = [F.min("speed").alias("min_speed"), F.min(F.struct("speed", "t_min"))["t_min"].alias("t2")]
    runs = islands.islands(thresholds(spark, d), ["tmc_code", "period"], "t_min", F.col("speed") <= F.col("thr"), 15, keep)
    w = Window.partitionBy("tmc_code", "period")
    runs = runs.withColumn("place", F.row_number().over(w.orderBy("min_speed", F.col("bins").desc(), "start")))
    runs = runs.withColumn("n_runs", F.count("*").over(w)).withColumn("minutes", F.sum("bins").over(w) * 15).where("place = 1")
    return rounded(runs.select("tmc_code", "period", F.col("start").alias("start_min"), F.col("end").alias("end_min"), "bins", "min_speed", "t2", "n_runs", "minutes"))


@query(f"""WITH {_F}, b AS (SELECT *, CASE WHEN t_min - lag(t_min) OVER q <= 30 THEN 0 ELSE 1 END AS new FROM k WHERE speed <= thr WINDOW q AS (PARTITION BY tmc_code ORDER BY t_min)),
g AS (SELECT *, sum(new) OVER (PARTITION BY tmc_code ORDER BY t_min ROWS UNBOUNDED PRECEDING) AS run FROM b)
SELECT tmc_code, min(t_min) AS start_min, max(t_min) + 15 AS end_min, count(*) AS bins FROM g GROUP BY tmc_code, run HAVING max(t_min) + 15 - min(t_min) >= 30""")
def merged_runs(spark, d):
    """Runs merged over one missing bin, of at least 30 minutes."""
    runs = islands.islands(thresholds(spark, d), ["tmc_code"], "t_min", F.col("speed") <= F.col("thr"), 15, gap=1).where("minutes >= 30")
    return runs.select("tmc_code", F.col("start").alias("start_min"), F.col("end").alias("end_min"), "bins")


@query(f"WITH {_F} SELECT tmc_code, period, count(*) FILTER (speed <= thr) * 15 / 60 AS congested_h, count(*) FILTER (speed <= 45) * 15 / 60 AS below_45_h FROM k GROUP BY tmc_code, period")
def threshold_duration(spark, d):
    v = F.col("speed")
    return thresholds(spark, d).groupBy("tmc_code", "period").agg((islands.threshold_minutes(v, F.col("thr"), 15) / 60).alias("congested_h"), (islands.threshold_minutes(v, F.lit(45.0), 15) / 60).alias("below_45_h"))


# observed: first week's days; modelled: the other days, of the same sensor and minute
_O = f"""{_S}, h AS (SELECT tmc_code, CAST(t_min AS INT) AS t_min, round(avg(speed) FILTER (day % 2 = 0), 9) AS o, round(avg(speed) FILTER (day % 2 = 1), 9) AS m FROM w GROUP BY tmc_code, t_min), hp AS (SELECT *, {_PERIOD.format(m='t_min')} AS period FROM h)"""
_ACC = """count(*) FILTER (o IS NOT NULL AND m IS NOT NULL) AS n, round(avg(abs(m - o)), 8) AS mae, round(100 * avg(abs(m - o) / o) FILTER (o >= 5), 8) AS mape, round(sqrt(avg((m - o) ** 2)), 8) AS rmse,
round(avg(m - o), 8) AS bias, round(100 * sum(abs(m - o)) / nullif(sum(abs(o)) FILTER (m IS NOT NULL), 0), 8) AS wmape, round(CASE WHEN isnan(corr(o, m)) THEN NULL ELSE corr(o, m) ** 2 END, 8) AS r2"""


def halves(spark, d) -> DataFrame:
    """Two profiles of each sensor, of even and of odd days, standing for observation and model."""
    s = slots(spark, d)
    even = clock.day_number(F.col("slot_s")) % 2 == 0
    out = s.groupBy("tmc_code", clock.minute_of_day(F.col("slot_s")).alias("t_min")).agg(F.round(F.avg(F.when(even, F.col("speed"))), 9).alias("o"), F.round(F.avg(F.when(~even, F.col("speed"))), 9).alias("m"))
    return out.withColumn("period", clock.period_of(F.col("t_min")))


@query(f"WITH {_O} SELECT period, grouping(period) AS overall, {_ACC} FROM hp GROUP BY GROUPING SETS ((period), ())")
def profile_accuracy(spark, d):
    out = halves(spark, d).groupingSets([["period"], []], "period").agg(F.grouping("period").cast("bigint").alias("overall"), *islands.accuracy(F.col("o"), F.col("m")))
    return rounded(out)


@query(f"""WITH {_O}, b AS (SELECT tmc_code, period, t_min, coalesce(o <= 45, false) AS oc, coalesce(m <= 45, false) AS mc FROM hp)
SELECT tmc_code, period, count(*) FILTER (oc) * 15 AS observed_min, count(*) FILTER (mc) * 15 AS model_min, count(*) FILTER (oc AND mc) * 15 AS overlap_min,
round(count(*) FILTER (oc AND mc) / nullif(count(*) FILTER (oc OR mc), 0), 8) AS iou, round(count(*) FILTER (oc AND mc) / nullif(count(*) FILTER (mc), 0), 8) AS precision,
round(count(*) FILTER (oc AND mc) / nullif(count(*) FILTER (oc), 0), 8) AS recall, round(avg((oc = mc)::INT), 8) AS accuracy,
min(t_min) FILTER (mc) - min(t_min) FILTER (oc) AS onset_error, max(t_min) FILTER (mc) - max(t_min) FILTER (oc) AS clearance_error,
round(2 * count(*) FILTER (oc AND mc) / nullif(count(*) FILTER (oc) + count(*) FILTER (mc), 0), 8) AS f1_all FROM b GROUP BY tmc_code, period""")
def congestion_fit(spark, d):
    out = islands.congestion_fit(halves(spark, d), ["tmc_code", "period"], "t_min", F.col("o") <= 45, F.col("m") <= 45, 15)
    dice = physics.div(2.0 * F.col("overlap_min"), F.col("observed_min") + F.col("model_min"))
    return rounded(out.withColumn("f1_all", dice).drop("f1"))


@query(f"""WITH {_O} SELECT period, grouping(period) AS overall, count(*) FILTER (o IS NOT NULL AND m IS NOT NULL) AS n, round(sum(o * m) / nullif(sum(o * o) FILTER (m IS NOT NULL), 0), 8) AS slope,
round(corr(o, m), 8) AS r, round(avg(abs(m - o)), 8) AS mae, round(sqrt(avg((m - o) ** 2)), 8) AS rmse, round(sum(m) FILTER (o IS NOT NULL) / nullif(sum(o) FILTER (m IS NOT NULL), 0), 8) AS total_ratio FROM hp GROUP BY GROUPING SETS ((period), ())""")
def scatter_metrics(spark, d):
    out = halves(spark, d).groupingSets([["period"], []], "period").agg(F.grouping("period").cast("bigint").alias("overall"), *islands.scatter(F.col("o"), F.col("m")))
    return rounded(out)


@query(f"""WITH {_O}, z AS (SELECT period, o, m FROM hp WHERE o IS NOT NULL AND m IS NOT NULL), f AS (SELECT period, count(*) AS n, sum(o * m) / sum(o * o) AS slope, sum(o * m) AS xy, sum(m * m) AS yy, avg(abs(o - m)) AS mae FROM z GROUP BY period)
SELECT period, n, round(slope, 8) AS slope, round(100 * (slope - 1), 8) AS percent, round(1 - (yy - slope * xy) / yy, 8) AS r2_origin, round(mae, 8) AS mae FROM f""")
def origin_fit(spark, d):
    return rounded(halves(spark, d).groupBy("period").agg(*islands.origin_fit(F.col("o"), F.col("m"))))


# ---- scalar functions -----------------------------------------------------------------------------------------------


@query("""SELECT link_id, round(free_speed * pow(1 + pow(20 / (capacity / nullif(free_speed * 0.7, 0)), 4), -0.5), 8) AS s3_speed, round(20 * free_speed * pow(1 + pow(20 / (capacity / nullif(free_speed * 0.7, 0)), 4), -0.5), 8) AS s3_flow,
round(least(least(40, free_speed * 0.99) * (capacity / nullif(free_speed * 0.7, 0)) * pow(greatest(pow(greatest(free_speed / greatest(least(40, free_speed * 0.99), 1), 1.00001), 2) - 1, 1e-8), 0.25), capacity), 8) AS inverse_flow,
round(60 * length / nullif(free_speed, 0), 8) AS fftt, round(length * 1609.344, 8) AS metres, round(free_speed * 1.609344, 8) AS kph,
round(least(greatest(0.080 - 0.0022 * least(greatest(free_speed, 3), 80) + 0.0000235 * least(greatest(free_speed, 3), 80) ** 2, 0.02), 0.20) * 8887, 8) AS co2
FROM (SELECT DISTINCT link_id, CAST(free_speed AS DOUBLE) AS free_speed, CAST(capacity AS DOUBLE) AS capacity, length FROM link WHERE free_speed > 0 AND capacity > 0)""")
def traffic_physics(spark, d):
    rows = table(spark, d, "link").where("free_speed > 0 and capacity > 0").select("link_id", "free_speed", "capacity", "length").distinct()
    vf, cap, m = F.col("free_speed"), F.col("capacity"), F.lit(4.0)
    kc = physics.div(cap, vf * 0.7)
    return rows.select(
        "link_id", r(physics.s3_speed(F.lit(20.0), vf, kc, m)).alias("s3_speed"), r(physics.s3_flow(F.lit(20.0), vf, kc, m)).alias("s3_flow"), r(physics.inverse_s3_flow(F.lit(40.0), vf, kc, m, cap)).alias("inverse_flow"),
        r(physics.free_travel_minutes(F.col("length"), vf)).alias("fftt"), r(F.col("length") * physics.MILE_M).alias("metres"), r(vf * physics.MPH_KPH).alias("kph"), r(physics.co2_grams_per_mile(vf)).alias("co2"),
    )


@query("""SELECT t2_id, round(CASE WHEN x < 0 THEN 0 WHEN x > 1 THEN 1 ELSE x * x * (3 - 2 * x) END, 8) AS smooth, round(CASE WHEN x > 0 AND x < 1 THEN pow(x / 0.4, 1.6) * pow((1 - x) / 0.6, 2.4) ELSE 0 END, 8) AS shape,
round(1.2 * pow(greatest(p_hr, 0), 1.4), 8) AS p_hat, round(greatest(least(45 / (1 + 0.3 * pow(greatest(p_hr, 0), 1.2)), 45), 1), 8) AS v_hat, round(t2_hour - p_hr * 0.4, 8) AS t0_hat, round(t2_hour + p_hr * 0.6, 8) AS t3_hat
FROM (SELECT *, (t2_hour - t0_hour) / nullif(t3_hour - t0_hour, 0) AS x FROM link_t2) WHERE x IS NOT NULL AND p_hr IS NOT NULL""")
def queue_functions(spark, d):
    rows = table(spark, d, "link_t2").withColumn("x", (F.col("t2_hour") - F.col("t0_hour")) / F.nullif(F.col("t3_hour") - F.col("t0_hour"), F.lit(0.0))).where("x is not null and p_hr is not null")
    p, b = F.col("p_hr"), physics.predicted_bounds(F.col("t2_hour"), F.col("p_hr"), F.lit(0.4))
    return rows.select(
        "t2_id", r(physics.smoothstep(F.col("x"))).alias("smooth"), r(physics.queue_shape(F.col("x"), F.lit(0.4))).alias("shape"), r(physics.qvdf_duration(p, F.lit(1.2), F.lit(1.4))).alias("p_hat"),
        r(physics.qvdf_min_speed(p, F.lit(45.0), F.lit(0.3), F.lit(1.2))).alias("v_hat"), r(b["t0"]).alias("t0_hat"), r(b["t3"]).alias("t3_hat"),
    )


@query(f"""WITH x AS (SELECT t2_id, CAST(round(t0_hour * 60) AS BIGINT) AS a, CAST(round(t3_hour * 60) AS BIGINT) AS b FROM link_t2 WHERE t0_hour IS NOT NULL AND t3_hour IS NOT NULL),
y AS (SELECT t2_id, a, b, unnest(range(a, greatest(a, b) + 1, 15)) AS m FROM x), z AS (SELECT t2_id, {_PERIOD.format(m='m')} AS p, min(m) AS f FROM y GROUP BY t2_id, {_PERIOD.format(m='m')})
SELECT t2_id, {_PERIOD.format(m='any_value(a)')} AS period, string_agg(p, ';' ORDER BY f) AS touched FROM z JOIN x USING (t2_id) GROUP BY t2_id""")
def period_tags(spark, d):
    m = lambda c: F.round(F.col(c) * 60).cast("bigint")
    rows = table(spark, d, "link_t2").where("t0_hour is not null and t3_hour is not null")
    return rows.select("t2_id", clock.period_of(m("t0_hour")).alias("period"), clock.touched_periods(m("t0_hour"), m("t3_hour")).alias("touched"))
