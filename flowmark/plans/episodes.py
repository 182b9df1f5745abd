"""Queries of the episode engine, calibration, reconstruction and learned fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.functions import clock, physics
from flowmark.operators import calibrate, episodes, ml, profiles, screen
from flowmark.plans import episode_sql
from flowmark.plans.measurement import _PERIOD, _W, r, readings, registry, rounded, slots, thresholds
from flowmark.plans.relational import _H, _J, _P, _REP, joined, performance_rows
from flowmark.operators import ranking
from flowmark.session import cut, table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)
CAP = 2000.0


def series(spark: SparkSession, d: str) -> DataFrame:
    """Daily series of quarter hours with free-flow speed, flow from the S3 curve, and capacity."""
    s = slots(spark, d)
    rows = s.join(profiles.free_flow(s).withColumnRenamed("free_speed", "vf"), "tmc_code").where(clock.weekday_of(F.col("slot_s")) < 5)
    vf = F.col("vf")
    kc = F.lit(CAP) / (vf * 0.7)
    flow = physics.inverse_s3_flow(F.col("speed"), vf, kc, F.lit(3.9), F.lit(CAP))
    return rows.select("tmc_code", clock.day_number(F.col("slot_s")).alias("day"), clock.minute_of_day(F.col("slot_s")).alias("t_min"), "speed", "vf", flow.alias("flow"), F.lit(CAP).alias("capacity"))


def detected(spark, d) -> DataFrame:
    return episodes.detect_episodes(series(spark, d))


@query(episode_sql.DETECT)
def detect_episodes(spark, d):
    return rounded(detected(spark, d))


@query(episode_sql.DETECT_WEEKDAY)
def average_weekday_episodes(spark, d):
    s = slots(spark, d)
    p = profiles.weekday_profile(s).join(profiles.free_flow(s).withColumnRenamed("free_speed", "vf"), "tmc_code").withColumn("day", F.lit(0))
    return rounded(episodes.detect_episodes(p))


@query(episode_sql.SCREENED)
def screened_episodes(spark, d):
    e = cut(detected(spark, d), "episodes").withColumn("lane", F.lit(CAP))
    soft = {}
    for x, y, name, lx, ly in (("doc", "minutes", "huber_doc_duration", True, True), ("doc", "mu", "huber_doc_mu", True, False), ("minutes", "min_speed", "huber_duration_speed", True, False)):
        e = calibrate.huber_flags(e, ["period"], x, y, name, lx, ly)
        soft[name] = F.col(name)
    out = screen.screen(e, ["period"], F.col("valid_for_mu"), soft, capacity="lane")
    return out.select("tmc_code", "day", "t0_min", "hard", "soft", "excluded", "clean", screen.regime(F.col("minutes"), F.col("min_speed"), F.col("limit"), F.col("z_minutes")).alias("regime"))


@query(episode_sql.RULES)
def ruled_episodes(spark, d):
    """Physical rules, robust scores and regimes, without the rules that need fitted lines."""
    out = screen.screen(detected(spark, d).withColumn("lane", F.lit(CAP)), ["period"], F.col("valid_for_mu"), capacity="lane")
    return out.select("tmc_code", "day", "t0_min", "hard", "soft", "excluded", "clean", "z_minutes", screen.regime(F.col("minutes"), F.col("min_speed"), F.col("limit"), F.col("z_minutes")).alias("regime"))


@query(episode_sql.CALIBRATION)
def qvdf_calibration(spark, d):
    """Sensor and period first, all sensors of a period where a sensor has too few."""
    e = cut(detected(spark, d), "episodes").withColumn("p_hr", F.col("minutes") / 60)
    names = ["f_d", "n_exp", "f_p", "s", "alpha", "beta"]
    fine, coarse = calibrate.fit_qvdf(e, ["tmc_code", "period"], least=5), calibrate.fit_qvdf(e, ["period"])
    out = calibrate.with_scope_fallback(e.select("tmc_code", "period").distinct(), fine, coarse, ["tmc_code", "period"], ["period"], names)
    return out.select("tmc_code", "period", *(F.round(c, 5).alias(c) for c in names), "scope")  # iterative fits agree to five digits


@query("""WITH x AS (SELECT period, ln(p_hr) AS lp, ln(45 / min_speed_mph - 1) AS lr FROM link_t2 WHERE p_hr > 0 AND min_speed_mph > 0 AND min_speed_mph < 45)
SELECT period, count(*) AS n, round(regr_slope(lr, lp), 8) AS s, round(exp(regr_intercept(lr, lp)), 8) AS f_p, round(regr_r2(lr, lp), 8) AS r2 FROM x GROUP BY period""")
def qvdf_least_squares(spark, d):
    x = table(spark, d, "link_t2").where("p_hr > 0 and min_speed_mph > 0 and min_speed_mph < 45").select("period", F.log("p_hr").alias("lp"), F.log(45 / F.col("min_speed_mph") - 1).alias("lr"))
    return x.groupBy("period").agg(F.count("*").alias("n"), r(F.regr_slope("lr", "lp")).alias("s"), r(F.exp(F.regr_intercept("lr", "lp"))).alias("f_p"), r(F.regr_r2("lr", "lp")).alias("r2"))


@query()
def s3_curve_fit(spark, d):
    return rounded(calibrate.s3_fit(series(spark, d), ["tmc_code"]))


@query(f"""WITH {_W}, {_REP}, e AS (SELECT t2_id AS id, upper(trim(tmc)) AS key, round(t0_hour * 60) AS t0, round(t2_hour * 60) AS t2, round(t3_hour * 60) AS t3 FROM rep WHERE place = 1 AND tmc IS NOT NULL AND t0_hour IS NOT NULL AND t2_hour IS NOT NULL AND t3_hour > t0_hour),
f AS (SELECT *, {_PERIOD.format(m='CAST(t2 AS BIGINT)')} AS period FROM e), g AS (SELECT *, CASE period WHEN 'AM' THEN 360 WHEN 'MD' THEN 540 WHEN 'PM' THEN 900 ELSE 1140 END AS ps, CASE period WHEN 'AM' THEN 540 WHEN 'MD' THEN 900 WHEN 'PM' THEN 1140 ELSE 1800 END AS pe FROM f),
h AS (SELECT g.*, greatest(t0, ps) AS es, least(t3, pe) AS ee, t_min, speed * 30 AS flow FROM g JOIN p ON g.key = p.tmc_code),
q AS (SELECT key, id, period, sum(greatest(least(t_min + 15, ee) - greatest(t_min, es), 0) / 60 * flow) AS ed, sum(greatest(least(t_min + 15, pe) - greatest(t_min, ps), 0) / 60 * flow) AS pd FROM h GROUP BY key, id, period)
SELECT id, period, round(ed, 6) AS episode_demand, round(pd, 6) AS period_demand, round(CASE WHEN pd > 0 THEN ed / pd END, 8) AS qdf, round(CASE WHEN pd > 0 AND ed > 0 THEN 1 / (ed / pd * {_H}) END, 8) AS plf FROM q""")
def qdf_and_plf(spark, d):
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("tmc is not null and t0_hour is not null and t2_hour is not null and t3_hour > t0_hour")
    m = lambda c: F.round(F.col(f"{c}_hour") * 60).alias(c)
    e = e.select(F.col("t2_id").alias("id"), F.upper(F.trim("tmc")).alias("key"), m("t0"), m("t2"), m("t3"))
    flows = profiles.weekday_profile(slots(spark, d)).select(F.col("tmc_code").alias("key"), "t_min", (F.col("speed") * 30).alias("flow"))
    return rounded(episodes.clipped_qdf(e, flows).drop("key"))


def t2_episodes(spark, d) -> DataFrame:
    t = table(spark, d, "link_t2").where("link_id is not null")
    return t.select(F.col("t2_id").alias("id"), "link_id", "period", F.col("t0_hour").alias("t0"), F.col("t2_hour").alias("t2"), F.col("t3_hour").alias("t3"), F.col("min_speed_mph").alias("min_speed"), "p_hr")


@query(episode_sql.SELECTION)
def overlap_selection(spark, d):
    return episodes.select_without_overlap(t2_episodes(spark, d), ["link_id", "period"])


@query(f"""WITH {_REP}, e AS (SELECT link_id, period, t0_hour * 60 AS t0, t2_hour * 60 AS t2, t3_hour * 60 AS t3, min_speed_mph AS v2 FROM rep WHERE place = 1 AND min_speed_mph > 0 AND t3_hour > t2_hour AND t2_hour > t0_hour),
b AS (SELECT *, CAST(unnest(range(0, CAST(greatest(1425, ceil(t3 / 15) * 15) AS INT) + 15, 15)) AS INT) AS t_min FROM e), x AS (SELECT *, (t_min - t0) / (t3 - t0) AS x, (t2 - t0) / (t3 - t0) AS rho FROM b)
SELECT link_id, period, t_min, round(CASE WHEN x > 0 AND x < 1 THEN least(60, 1 / (1 / 45.0 + pow(x / rho, 4 * rho) * pow((1 - x) / (1 - rho), 4 * (1 - rho)) * (1 / v2 - 1 / 45.0))) ELSE 60 END, 8) AS speed FROM x""")
def reconstructed_speeds(spark, d):
    """Every period's episode over all bins of the day, counting on past midnight as far as the episode goes."""
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("min_speed_mph > 0 and t3_hour > t2_hour and t2_hour > t0_hour")
    e = e.select(F.struct("link_id", "period").alias("key"), *((F.col(f"{c}_hour") * 60).alias(c) for c in ("t0", "t2", "t3")), F.col("min_speed_mph").alias("v2"))
    end = F.greatest(F.lit(1425), (F.ceil(F.col("t3") / 15) * 15).cast("int"))
    bins = e.select("key", F.explode(F.sequence(F.lit(0), end, F.lit(15))).alias("t_min"), F.lit(60.0).alias("base"))
    return episodes.reconstruct(bins, e, F.lit(45.0)).select("key.link_id", "key.period", "t_min", r("speed").alias("speed"))


@query(episode_sql.CONSERVED)
def flow_conservation(spark, d):
    """Flows of a sensor's weekday shifted so that they carry nine tenths of capacity on average, each within capacity."""
    q = series(spark, d).where("flow is not null").groupBy("tmc_code", "t_min").agg(F.avg("flow").alias("f")).groupBy("tmc_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("t_min", "f"))), lambda x: x["f"]).alias("q"))
    demand = F.size("q") * F.lit(CAP * 0.9)
    out = q.withColumn("shifted", episodes.conserve_flow(F.col("q"), demand, F.lit(CAP)))
    total = F.aggregate("shifted", F.lit(0.0), lambda a, x: a + x)
    return rounded(out.select("tmc_code", F.size("q").alias("n"), demand.alias("demand"), total.alias("achieved"), (F.abs(total - demand) <= 1e-6 * demand).alias("conserved")))


@query(f"""WITH {_J} SELECT perf_id, round(volume / nullif(lanes * {_H}, 0), 6) AS demand, round(volume / nullif(lanes * {_H}, 0) / nullif(capacity, 0), 8) AS doc, round(pow(greatest(volume / nullif(lanes * {_H}, 0) / nullif(capacity, 0), 0), 1.1), 8) AS p_hr,
round(least(greatest(45 / (1 + 0.28125 * pow(pow(greatest(volume / nullif(lanes * {_H}, 0) / nullif(capacity, 0), 0), 1.1), 4)), 1), 45), 8) AS vt2 FROM j WHERE volume IS NOT NULL AND lanes IS NOT NULL AND lanes <> 0 AND capacity <> 0""")
def queue_vdf(spark, d):
    j = joined(spark, d).where("volume is not null and lanes is not null and lanes != 0 and capacity != 0")
    x = episodes.queue_profile(F.col("volume"), F.col("lanes").cast("double"), clock.period_hours(F.col("period")), F.lit(1.0), F.col("capacity"), F.lit(45.0), n=1.1)
    return j.select("perf_id", x.alias("x")).select("perf_id", r("x.demand").alias("demand"), r("x.doc").alias("doc"), r("x.p_hr").alias("p_hr"), r("x.vt2").alias("vt2"))


def five_minutes(spark, d) -> DataFrame:
    """Average weekday by five minutes per sensor, keyed by a hash of its code."""
    s = readings(spark, d).where("speed between 1 and 150").withColumn("t", clock.slot_seconds("ts", 5))
    return s.where(clock.weekday_of(F.col("t")) < 5).groupBy(F.xxhash64("tmc_code").alias("key"), clock.minute_of_day(F.col("t")).alias("t_min")).agg(F.avg("speed").alias("speed"))


@query(episode_sql.LIMITED)
def rate_limited_profiles(spark, d):
    keys = readings(spark, d).select("tmc_code", F.xxhash64("tmc_code").alias("key")).distinct()
    m = episodes.constraint_metrics(episodes.limit_rates(five_minutes(spark, d))).join(keys, "key")
    return m.select("tmc_code", F.round("most_change", 6).alias("most_change"), F.round("most_mean_change", 6).alias("most_mean_change"), F.round("most_acceleration", 4).alias("most_acceleration"))


@query(episode_sql.EDGES)
def smoothed_period_edges(spark, d):
    keys = readings(spark, d).select("tmc_code", F.xxhash64("tmc_code").alias("key")).distinct()
    return episodes.smooth_edges(five_minutes(spark, d)).join(keys, "key").select("tmc_code", "t_min", "target", "speed")


@query(f"""WITH {_P}, x AS (SELECT link_id, period, median(t2_hour) AS t2 FROM link_t2 WHERE link_id IS NOT NULL GROUP BY ALL) SELECT perf_id, CASE WHEN x.link_id IS NULL THEN 'unmapped' WHEN volume IS NULL THEN 'no_assignment' WHEN x.t2 IS NULL THEN 'no_assignment_curve' ELSE 'ready' END AS status FROM pf LEFT JOIN x ON pf.link_id = x.link_id AND pf.period = x.period""")
def projection_status(spark, d):
    x = table(spark, d, "link_t2").where("link_id is not null").groupBy("link_id", "period").agg(F.median("t2_hour").alias("t2"), F.lit(True).alias("there"))
    status = F.when(F.col("there").isNull(), "unmapped").when(F.col("volume").isNull(), "no_assignment").when(F.col("t2").isNull(), "no_assignment_curve").otherwise("ready")
    return performance_rows(spark, d).join(x, ["link_id", "period"], "left").select("perf_id", status.alias("status"))


@query("""SELECT t2_id, round((t2_hour - 6) * 60, 8) AS t2_rel, round(ln((t3_hour - t0_hour) * 60), 8) AS log_span, round(ln(greatest(least((t2_hour - t0_hour) / (t3_hour - t0_hour), 0.9999), 0.0001) / (1 - greatest(least((t2_hour - t0_hour) / (t3_hour - t0_hour), 0.9999), 0.0001))), 8) AS logit_place
FROM link_t2 WHERE t3_hour > t0_hour AND t2_hour IS NOT NULL""")
def boundary_targets(spark, d):
    x = ml.boundaries_to_targets(F.col("t0_hour"), F.col("t2_hour"), F.col("t3_hour"), F.lit(6.0))
    return table(spark, d, "link_t2").where("t3_hour > t0_hour and t2_hour is not null").select("t2_id", x.alias("x")).select("t2_id", r("x.t2_rel").alias("t2_rel"), r("x.log_span").alias("log_span"), r("x.logit_place").alias("logit_place"))


def features(spark, d) -> DataFrame:
    """Observed t2 of links with their features."""
    t = ranking.representative(table(spark, d, "link_t2").where("link_id is not null and t2_hour >= 0"), ["link_id", "period"]).select("link_id", "period", F.col("t2_hour").alias("target"))
    j = joined(spark, d).select("link_id", "period", "district", "link_type", F.col("lanes").cast("double").alias("lanes"), "free_speed", "capacity", "doc", "volume")
    return t.join(j, ["link_id", "period"])


@query()
def ridge_fill(spark, d):
    out = ml.cross_predict(features(spark, d), ["lanes", "free_speed", "capacity", "doc"], ["period", "link_type"], "target", F.col("district"))
    return ml.error_measures(out, ["period"], "target").select("period", "n", *(r(c).alias(c) for c in ("mae", "median", "p90", "rmse")))


@query()
def forest_fill(spark, d):
    out = ml.cross_predict(features(spark, d), ["lanes", "free_speed", "capacity", "doc"], ["period"], "target", F.col("district"), "forest", 2)
    return ml.error_measures(out, ["period"], "target").select("period", "n", *(r(c).alias(c) for c in ("mae", "median", "p90", "rmse")))


@query()
def bootstrap_difference(spark, d):
    h = thresholds(spark, d).select("tmc_code", "speed", "thr")
    return rounded(ml.bootstrap_delta(h, "tmc_code", "speed", "thr"))
