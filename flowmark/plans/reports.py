"""Queries of the result tables: congestion, calibrated speeds, gamma, fit quality, gates, accounting and errors by stratum, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics
from flowmark.operators import calibrate, episodes, ml, profiles, spatial
from flowmark.plans import episode_sql as es
from flowmark.plans.episodes import CAP, detected, series
from flowmark.plans.measurement import _F, _M, _PERIOD, members, registry, slots, thresholds
from flowmark.plans.relational import _ALL, _L, _MAP, links, mapping, positions_with_speed
from flowmark.session import cut

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)

_EP = es.episodes(es.DAILY)
_FITS = f"""{_EP}, er AS (SELECT tmc_code, period, doc, minutes / 60 AS p_hr, min_speed, "limit" AS lim FROM ep), {es.qvdf('fine', 'er', "tmc_code || '|' || period", 5)}, {es.qvdf('rough', 'er', 'period', 3)}"""
_NAMES = ["f_d", "n_exp", "f_p", "s"]


def fitted(spark, d) -> DataFrame:
    """Daily episodes with the parameters of their sensor and period, else of their period."""
    e = cut(detected(spark, d), "episodes").withColumn("p_hr", F.col("minutes") / 60)
    fine, coarse = calibrate.fit_qvdf(e, ["tmc_code", "period"], least=5), calibrate.fit_qvdf(e, ["period"])
    return calibrate.with_scope_fallback(e, fine, coarse, ["tmc_code", "period"], ["period"], _NAMES)


@query(f"""WITH RECURSIVE {_EP}, vd AS (SELECT tmc_code, {_PERIOD.format(m='t_min')} AS period, count(DISTINCT day) AS days FROM ser GROUP BY ALL), c AS (SELECT tmc_code, period, count(DISTINCT day) AS congested, avg(minutes) / 60 AS p FROM ep GROUP BY ALL)
SELECT vd.tmc_code, vd.period, days AS valid_days, coalesce(congested, 0) AS congested_days, round(100.0 * coalesce(congested, 0) / days, 8) AS congested_pct, round(p, 8) AS mean_p FROM vd LEFT JOIN c ON vd.tmc_code = c.tmc_code AND vd.period = c.period""")
def congested_days(spark: SparkSession, d: str) -> DataFrame:
    """Days seen and days congested of each sensor and period, and the mean duration of its episodes in hours."""
    days = series(spark, d).groupBy("tmc_code", clock.period_of(F.col("t_min")).alias("period")).agg(F.countDistinct("day").alias("valid_days"))
    e = detected(spark, d).groupBy("tmc_code", "period").agg(F.countDistinct("day").alias("c"), (F.avg("minutes") / 60).alias("mean_p"))
    j = days.join(e, ["tmc_code", "period"], "left")
    n = F.coalesce("c", F.lit(0))
    return j.select("tmc_code", "period", "valid_days", n.alias("congested_days"), (100.0 * n / F.col("valid_days")).alias("congested_pct"), "mean_p")


@query(f"""WITH RECURSIVE {_FITS}, fx AS (SELECT er.*, coalesce(f.f_p, k.f_p) AS fp, coalesce(f.s, k.s) AS sx FROM er LEFT JOIN fine f ON f.g = er.tmc_code || '|' || er.period LEFT JOIN rough k ON k.g = er.period)
SELECT tmc_code, period, count(*) AS n, round(avg(min_speed), 8) AS observed, round(avg(greatest(least(lim / (1 + fp * pow(greatest(p_hr, 0), sx)), lim), 1)), 4) AS predicted FROM fx WHERE fp IS NOT NULL GROUP BY tmc_code, period""")
def calibrated_least_speeds(spark, d):
    """Mean least speed observed and predicted from the fitted parameters."""
    e = fitted(spark, d).where("f_p is not null")
    v = physics.qvdf_min_speed(F.col("p_hr"), F.col("limit"), F.col("f_p"), F.col("s"))
    return e.groupBy("tmc_code", "period").agg(F.count("*").alias("n"), F.avg("min_speed").alias("observed"), F.round(F.avg(v), 4).alias("predicted"))


@query(f"""WITH RECURSIVE {_FITS}, {_M}, fx AS (SELECT (day + 3) % 7 AS weekday, ep.period, 64 * mu * (miles / "limit") * k.f_p * pow(minutes / 60, k.s - 4) AS g FROM ep JOIN mem USING (tmc_code) JOIN rough k ON k.g = ep.period WHERE mu IS NOT NULL)
SELECT CAST(weekday AS INT) AS weekday, period, count(*) AS n, round(avg(g), 3) AS gamma FROM fx GROUP BY weekday, period""")
def weekday_gamma(spark, d):
    """The curvature of the queue by weekday and period, with the parameters of the period."""
    e = cut(detected(spark, d), "episodes").withColumn("p_hr", F.col("minutes") / 60)
    x = e.join(calibrate.fit_qvdf(e, ["period"]).select("period", "f_p", "s"), "period").join(members(spark, d), "tmc_code").where("mu is not null")
    g = physics.gamma(F.col("mu"), F.col("miles"), F.col("limit"), F.col("f_p"), F.col("p_hr"), F.col("s"))
    return x.groupBy(F.pmod(F.col("day") + 3, F.lit(7)).cast("int").alias("weekday"), "period").agg(F.count("*").alias("n"), F.round(F.avg(g), 3).alias("gamma"))


@query(f"""WITH RECURSIVE {_FITS}, fx AS (SELECT er.period, p_hr, k.f_d * pow(doc, k.n_exp) AS p FROM er JOIN rough k ON k.g = er.period WHERE doc > 0 AND p_hr > 0), fy AS (SELECT *, avg(p_hr) OVER (PARTITION BY period) AS mean FROM fx)
SELECT period, count(*) AS n, round(greatest(least(1 - sum((p_hr - p) ** 2) / nullif(sum((p_hr - mean) ** 2), 0), 1), -1), 5) AS r2, round(avg(abs(p_hr - p)), 5) AS mae, round(100 * avg(abs(p_hr - p) / p_hr), 3) AS mape FROM fy GROUP BY period HAVING count(*) >= 3""")
def duration_fit_quality(spark, d):
    """Durations predicted by the period's fit against the observed ones: R2 within ±1, MAE and MAPE of three episodes or more."""
    e = cut(detected(spark, d), "episodes").withColumn("p_hr", F.col("minutes") / 60)
    x = e.where("doc > 0 and p_hr > 0").join(calibrate.fit_qvdf(e, ["period"]).select("period", "f_d", "n_exp"), "period").withColumn("p", F.col("f_d") * F.pow("doc", "n_exp"))
    x = x.withColumn("mean", F.avg("p_hr").over(Window.partitionBy("period")))
    err = F.col("p_hr") - F.col("p")
    r2 = physics.clip(1 - physics.div(F.sum(err * err), F.sum(F.pow(F.col("p_hr") - F.col("mean"), 2))), -1.0, 1.0)
    out = x.groupBy("period").agg(F.count("*").alias("n"), F.round(r2, 5).alias("r2"), F.round(F.avg(F.abs(err)), 5).alias("mae"), F.round(100 * F.avg(F.abs(err) / F.col("p_hr")), 3).alias("mape"))
    return out.where("n >= 3")


# Gates of a run's episodes and the least value that passes.
GATES = {"episodes": 20.0, "valid_share": 0.1, "start_measured": 0.9, "end_measured": 0.5, "doc_known": 0.9, "mean_minutes": 60.0, "discharge_share": 0.3}


@query(f"""WITH RECURSIVE {_EP}, qg AS (SELECT period, count(*)::DOUBLE AS episodes, avg(valid_for_mu::INT) AS valid_share, avg((t0_source = 'post_qc')::INT) AS start_measured, avg((t3_source = 'post_qc')::INT) AS end_measured, avg((doc IS NOT NULL)::INT) AS doc_known, avg(minutes) AS mean_minutes, avg((discharge_min >= 30)::INT) AS discharge_share FROM ep GROUP BY period),
u AS (UNPIVOT qg ON episodes, valid_share, start_measured, end_measured, doc_known, mean_minutes, discharge_share INTO NAME gate VALUE value)
SELECT period, gate, round(value, 8) AS value, CASE WHEN value >= CASE gate {' '.join(f"WHEN '{k}' THEN {v}" for k, v in GATES.items())} END THEN 'PASS' ELSE 'FAIL' END AS status FROM u""")
def episode_gates(spark, d):
    """Seven gates per period, one row each."""
    e = detected(spark, d)
    share = lambda c: F.avg(c.cast("double"))
    g = e.groupBy("period").agg(
        F.count("*").cast("double").alias("episodes"), share(F.col("valid_for_mu")).alias("valid_share"), share(F.col("t0_source") == "post_qc").alias("start_measured"), share(F.col("t3_source") == "post_qc").alias("end_measured"),
        share(F.col("doc").isNotNull()).alias("doc_known"), F.avg("minutes").alias("mean_minutes"), share(F.col("discharge_min") >= 30).alias("discharge_share"),
    )
    long = F.explode(F.array(*(F.struct(F.lit(k).alias("gate"), F.col(k).alias("value"), F.when(F.col(k) >= v, "PASS").otherwise("FAIL").alias("status")) for k, v in GATES.items())))
    return g.select("period", long.alias("x")).select("period", "x.gate", "x.value", "x.status")


@query(f"""WITH {_F}, {_M}, b AS (SELECT tmc_code, t_min, miles, vf, thr, greatest(speed, 1) AS v, speed, least(least(speed, vf * 0.99) * (2000.0 / thr) * pow(greatest(pow(greatest(vf / greatest(least(speed, vf * 0.99), 1), 1.00001), 1.95) - 1, 1e-8), 1 / 3.9), 2000.0) / 4 AS n FROM (SELECT k.*, thr / 0.7 AS vf FROM k) JOIN mem USING (tmc_code))
SELECT tmc_code, t_min, round(n * miles, 5) AS vmt, round(n * miles / v, 6) AS vht, round(n * miles / vf, 6) AS ffvht, round(greatest(n * miles / v - n * miles / vf, 0), 6) AS vdt, round(CASE WHEN speed < thr THEN greatest(n * miles / v - n * miles / thr, 0) ELSE 0 END, 6) AS vcdt,
round(least(greatest(0.080 - 0.0022 * least(greatest(speed, 3), 80) + 0.0000235 * least(greatest(speed, 3), 80) ** 2, 0.02), 0.20) * 8887 * n * miles, 3) AS co2_g FROM b""")
def bin_accounting(spark, d):
    """Vehicle miles, hours, free hours, delay, congested delay and CO2 of each sensor and bin of the average weekday, at the flow of its speed."""
    k = thresholds(spark, d).join(members(spark, d), "tmc_code")
    speed, vf, thr, m = F.col("speed"), F.col("thr") / 0.7, F.col("thr"), F.col("miles")
    n = physics.inverse_s3_flow(speed, vf, F.lit(CAP) / thr, F.lit(3.9), F.lit(CAP)) / 4
    v, zero = F.greatest("speed", F.lit(1.0)), F.lit(0.0)
    out = k.select(
        "tmc_code", "t_min", (n * m).alias("vmt"), (n * m / v).alias("vht"), (n * m / vf).alias("ffvht"), F.greatest(n * m / v - n * m / vf, zero).alias("vdt"),
        F.when(speed < thr, F.greatest(n * m / v - n * m / thr, zero)).otherwise(0.0).alias("vcdt"), (physics.co2_grams_per_mile(speed) * n * m).alias("co2_g"),
    )
    return out.select("tmc_code", "t_min", F.round("vmt", 5).alias("vmt"), *(F.round(c, 6).alias(c) for c in ("vht", "ffvht", "vdt", "vcdt")), F.round("co2_g", 3).alias("co2_g"))


@query(f"""WITH {_F} SELECT tmc_code, period, count(*)::INT AS n, count(*) * 1800.0 AS demand, count(*) * 1800.0 AS achieved FROM k WHERE speed < thr GROUP BY tmc_code, period""")
def conserved_handoff(spark, d):
    """Flows of the congested bins of each sensor and period, shifted within capacity so that they carry the demand; a miss of more than a millionth is an error."""
    k = thresholds(spark, d).where("speed < thr")
    flow = physics.inverse_s3_flow(F.col("speed"), F.col("thr") / 0.7, F.lit(CAP) / F.col("thr"), F.lit(3.9), F.lit(CAP))
    q = k.groupBy("tmc_code", "period").agg(F.transform(F.array_sort(F.collect_list(F.struct("t_min", flow.alias("f")))), lambda x: x["f"]).alias("q"))  # the bins of one period
    demand = F.size("q") * F.lit(CAP * 0.9)
    total = F.aggregate(episodes.conserve_flow(F.col("q"), demand, F.lit(CAP)), F.lit(0.0), lambda a, x: a + x)
    out = q.select("tmc_code", "period", F.size("q").alias("n"), demand.alias("demand"), total.alias("achieved"))
    held = F.assert_true(F.abs(F.col("achieved") - F.col("demand")) <= 1e-6 * F.col("demand"), F.lit("flow isn't conserved"))
    return out.where(held.isNull())


@query(f"""WITH {_L}, {_MAP}, vv AS (SELECT DISTINCT mp.tmc, link_id, link_type, free_speed FROM mp JOIN lk USING (link_id) WHERE link_type IS NOT NULL AND free_speed IS NOT NULL), a AS (SELECT link_type, sum(free_speed) AS s, count(*) AS n FROM vv GROUP BY ALL), o AS (SELECT tmc, link_type, sum(free_speed) AS s, count(*) AS n FROM vv GROUP BY ALL),
e AS (SELECT vv.link_type AS stratum, prior, abs(prior - free_speed) AS e FROM vv JOIN (SELECT o.tmc, o.link_type, (a.s - o.s) / nullif(a.n - o.n, 0) AS prior FROM o JOIN a USING (link_type)) USING (tmc, link_type) WHERE prior IS NOT NULL)
SELECT stratum, count(*) AS n, round(avg(e), 8) AS mean, round(median(e), 8) AS median, round(quantile_cont(e, 0.9), 8) AS p90, round(avg((e <= 5)::INT), 8) AS within_5, count(*) FILTER (prior < 0 OR prior > 90) AS violations FROM e GROUP BY stratum""")
def prior_errors(spark, d):
    """Errors of the class mean without the own sensor, by stratum: mean, median, 90th percentile, share within five, and impossible values."""
    v = mapping(spark, d).select("tmc", "link_id").join(links(spark, d).select("link_id", "link_type", "free_speed"), "link_id").where("link_type is not null and free_speed is not null").distinct()
    x = v.join(ml.leave_group_out(v, "tmc", ["link_type"], "free_speed"), ["tmc", "link_type"]).where("prior is not null")
    e = F.abs(F.col("prior") - F.col("free_speed"))
    return x.groupBy(F.col("link_type").alias("stratum")).agg(
        F.count("*").alias("n"), F.avg(e).alias("mean"), F.median(e).alias("median"), F.percentile(e, F.lit(0.9)).alias("p90"), F.avg((e <= 5).cast("double")).alias("within_5"), F.count_if(~F.col("prior").between(0, 90)).alias("violations")
    )


@query(f"""WITH {_ALL}, b AS (SELECT * EXCLUDE (fold), ntile(5) OVER (PARTITION BY corridor ORDER BY position) AS block FROM p WHERE vf IS NOT NULL), f AS (SELECT unnest(range(1, 6)) AS fold),
z AS (SELECT fold, corridor, position, vf, CASE WHEN block <> fold THEN vf END AS known, block FROM b, f),
y AS (SELECT *, last_value(known IGNORE NULLS) OVER a AS lv, position - last_value(CASE WHEN known IS NOT NULL THEN position END IGNORE NULLS) OVER a AS lg, first_value(known IGNORE NULLS) OVER c AS rv, first_value(CASE WHEN known IS NOT NULL THEN position END IGNORE NULLS) OVER c - position AS rg FROM z
WINDOW a AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
e AS (SELECT CASE WHEN least(lg, rg) <= 1 THEN 'near' WHEN least(lg, rg) <= 5 THEN 'middle' WHEN lg IS NULL AND rg IS NULL THEN 'none' ELSE 'far' END AS stratum, abs(coalesce(lv + (rv - lv) * lg / nullif(lg + rg, 0), lv, rv) - vf) AS e FROM y WHERE block = fold)
SELECT stratum, count(*) AS n, count(e) AS n_filled, round(avg(e), 8) AS mean, round(quantile_cont(e, 0.9), 8) AS p90, round(max(e), 8) AS most FROM e GROUP BY stratum""")
def spatial_validation_strata(spark, d):
    """Errors of values held out in blocks, by the distance to the nearest known one."""
    b = positions_with_speed(spark, d).where("vf is not null").withColumn("block", F.ntile(5).over(Window.partitionBy("corridor").orderBy("position")))
    z = b.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn("known", F.when(F.col("block") != F.col("fold"), F.col("vf")))
    y = spatial.bracket(z, ["fold", "corridor"], "position", "known").where("block = fold")
    guess = F.coalesce(F.col("left") + (F.col("right") - F.col("left")) * physics.div(F.col("left_gap"), F.col("left_gap") + F.col("right_gap")), "left", "right")
    gap = F.least("left_gap", "right_gap")
    e = F.abs(guess - F.col("vf"))
    stratum = F.when(gap <= 1, "near").when(gap <= 5, "middle").when(gap.isNull(), "none").otherwise("far")
    return y.groupBy(stratum.alias("stratum")).agg(F.count("*").alias("n"), F.count(e).alias("n_filled"), F.avg(e).alias("mean"), F.percentile(e, F.lit(0.9)).alias("p90"), F.max(e).alias("most"))


@query(f"""WITH {_F}, {_M}, h AS (SELECT corridor, period, grouping(corridor) AS all_, count(*) AS n, sum(miles) / nullif(sum(miles / speed), 0) AS speed, count(*) FILTER (speed <= thr) / count(*) AS share FROM k JOIN mem USING (tmc_code) WHERE speed > 0 GROUP BY GROUPING SETS ((corridor, period), (corridor), (period), ()))
SELECT CASE WHEN all_ = 1 THEN 'ALL' ELSE corridor END AS corridor, coalesce(period, 'DAY') AS period, n, round(speed, 8) AS speed, round(share, 8) AS share FROM h""")
def overall_metrics(spark, d):
    """Corridors and all of them, by period and by day, in one pass."""
    k = thresholds(spark, d).join(members(spark, d), "tmc_code").where("speed > 0")
    g = k.groupingSets([["corridor", "period"], ["corridor"], ["period"], []], "corridor", "period").agg(F.grouping("corridor").alias("all_"), F.count("*").alias("n"), profiles.harmonic_speed(F.col("speed"), F.col("miles")).alias("speed"), (F.count_if(F.col("speed") <= F.col("thr")) / F.count("*")).alias("share"))
    return g.select(F.when(F.col("all_") == 1, "ALL").otherwise(F.col("corridor")).alias("corridor"), F.coalesce("period", F.lit("DAY")).alias("period"), "n", "speed", "share")
