"""Queries of resources, detectors on profiles, curves, calibration quality and defaults, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.functions import physics, text
from flowmark.operators import profiles, ranking, resources
from flowmark.plans import episode_sql
from flowmark.plans.measurement import _W, registry, slots
from flowmark.plans.relational import _L, _MAP, _REP, links, mapping
from flowmark.session import table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


@query(episode_sql.class_calibration(_L))
def class_calibration(spark: SparkSession, d: str) -> DataFrame:
    """QVDF parameters per link type and period from all queue rows, the overall fit as fallback."""
    k = links(spark, d).select("link_id", F.col("link_type").alias("link_class")).where("link_class is not null")
    t = table(spark, d, "link_t2").where("p_hr > 0 and min_speed_mph > 0").join(k, "link_id").select("link_class", "period", (F.col("p_hr") / 2).alias("doc"), "p_hr", F.col("min_speed_mph").alias("min_speed"), F.lit(45.0).alias("limit"))
    out = resources.class_resource(t, k.select("link_class").distinct().withColumn("period", F.explode(F.array(*map(F.lit, ("AM", "MD", "PM", "NT"))))), 10)
    return out.select("link_class", "period", *(F.round(c, 5).alias(c) for c in ("f_d", "n_exp", "f_p", "s", "alpha", "beta")), "source")  # iterative fits agree to five digits


@query("""WITH x AS (SELECT period, p_hr, 1.1 * pow(greatest(t2_hour - t0_hour, 0.01), 0.9) AS p FROM link_t2 WHERE p_hr > 0 AND t2_hour > t0_hour), y AS (SELECT *, avg(p_hr) OVER (PARTITION BY period) AS m FROM x)
SELECT period, count(*) AS n, round(greatest(least(1 - sum((p_hr - p) ** 2) / nullif(sum((p_hr - m) ** 2), 0), 1), -1), 8) AS r2, round(avg(abs(p_hr - p)), 8) AS mae, round(100 * avg(abs(p_hr - p) / p_hr), 8) AS mape FROM y GROUP BY period HAVING count(*) >= 3""")
def calibration_quality(spark, d):
    """Predicted against observed duration: R2 within ±1, MAE, MAPE, for groups of three or more."""
    x = table(spark, d, "link_t2").where("p_hr > 0 and t2_hour > t0_hour").select("period", "p_hr", physics.qvdf_duration(F.greatest(F.col("t2_hour") - F.col("t0_hour"), F.lit(0.01)), F.lit(1.1), F.lit(0.9)).alias("p"))
    m = x.groupBy("period").agg(F.avg("p_hr").alias("m"))
    e = F.col("p_hr") - F.col("p")
    out = x.join(m, "period").groupBy("period").agg(F.count("*").alias("n"), physics.clip(1 - physics.div(F.sum(e * e), F.sum(F.pow(F.col("p_hr") - F.col("m"), 2))), -1.0, 1.0).alias("r2"), F.avg(F.abs(e)).alias("mae"), (100 * F.avg(F.abs(e) / F.col("p_hr"))).alias("mape"))
    return out.where("n >= 3")


@query("""WITH x AS (SELECT period, tmc, avg(min_speed_mph) AS v, avg(greatest(least(45 / (1 + 0.3 * pow(greatest(p_hr, 0), 1.2)), 45), 1)) AS q, count(*) AS n FROM link_t2 WHERE min_speed_mph > 0 AND p_hr IS NOT NULL AND tmc IS NOT NULL GROUP BY period, tmc)
SELECT period, tmc, n, round(v, 8) AS observed, round(q, 8) AS predicted, round(q - v, 8) AS error FROM x""")
def predicted_least_speeds(spark, d):
    x = table(spark, d, "link_t2").where("min_speed_mph > 0 and p_hr is not null and tmc is not null")
    g = x.groupBy("period", "tmc").agg(F.count("*").alias("n"), F.avg("min_speed_mph").alias("observed"), F.avg(physics.qvdf_min_speed(F.col("p_hr"), F.lit(45.0), F.lit(0.3), F.lit(1.2))).alias("predicted"))
    return g.withColumn("error", F.col("predicted") - F.col("observed"))


@query(f"""WITH {_MAP}, {_REP}, w AS (SELECT link_id, period, tmc FROM (SELECT *, row_number() OVER (PARTITION BY link_id, period ORDER BY node_pair_tmc_rank ASC NULLS LAST, distance_to_tmc_ft ASC NULLS LAST, map_id) AS k FROM mp) WHERE k = 1),
e AS (SELECT tmc, period, t0_hour AS t0, t2_hour AS t2, t3_hour AS t3 FROM (SELECT *, row_number() OVER (PARTITION BY tmc, period ORDER BY min_speed_mph ASC NULLS LAST, p_hr DESC NULLS LAST, t2_hour ASC NULLS LAST, t2_id) AS k FROM link_t2 WHERE tmc IS NOT NULL) WHERE k = 1)
SELECT w.link_id, w.period, w.tmc, round(t0, 8) AS t0, round(t2, 8) AS t2, round(t3, 8) AS t3, CASE WHEN e.tmc IS NULL THEN 'observed_no_congestion' ELSE 'direct' END AS source, e.tmc IS NULL AS protected FROM w LEFT JOIN e ON w.tmc = e.tmc AND w.period = e.period""")
def primary_only_assignment(spark, d):
    w = ranking.pick_first(mapping(spark, d), ["link_id", "period"], [F.col("node_pair_tmc_rank").asc_nulls_last(), F.col("distance_to_tmc_ft").asc_nulls_last(), F.col("map_id")])
    e = ranking.representative(table(spark, d, "link_t2").where("tmc is not null"), ["tmc", "period"]).select("tmc", "period", *(F.col(f"{c}_hour").alias(c) for c in ("t0", "t2", "t3")))
    return resources.primary_only(w, e)


@query(f"""WITH {_W}, n AS (SELECT tmc_code, quantile_cont(speed, 0.95) AS p95 FROM p GROUP BY tmc_code), q AS (SELECT p.tmc_code, t_min, round(speed / p95, 9) AS ratio FROM p JOIN n USING (tmc_code)),
b AS (SELECT *, CASE WHEN t_min - lag(t_min) OVER (PARTITION BY tmc_code ORDER BY t_min) <= 30 THEN 0 ELSE 1 END AS new FROM q WHERE ratio < 0.7), g AS (SELECT *, sum(new) OVER (PARTITION BY tmc_code ORDER BY t_min ROWS UNBOUNDED PRECEDING) AS run FROM b),
i AS (SELECT tmc_code, min(t_min) AS t0, max(t_min) + 15 AS t3, min(ratio) AS least, arg_min(t_min, (ratio, t_min)) AS t2 FROM g GROUP BY tmc_code, run HAVING max(t_min) + 15 - min(t_min) >= 30)
SELECT tmc_code, t0, t2, t3, round(least, 8) AS least FROM (SELECT *, row_number() OVER (PARTITION BY tmc_code ORDER BY least, t3 - t0 DESC, t0) AS k FROM i) WHERE k = 1""")
def profile_detector(spark, d):
    p = profiles.normalised_profile(profiles.weekday_profile(slots(spark, d))).withColumn("ratio", F.round("ratio", 9))
    return resources.profile_detector(p)


@query(f"""WITH {_W}, a AS (SELECT tmc_code AS k, t_min AS t, speed AS v FROM p WHERE t_min IN (360, 540, 900, 1140)), b AS (SELECT DISTINCT k, unnest(range(0, 1440, 60)) AS t FROM a),
j AS (SELECT b.k, b.t, (SELECT arg_max(v, x.t) FROM a x WHERE x.k = b.k AND x.t <= b.t) AS l, (SELECT max(x.t) FROM a x WHERE x.k = b.k AND x.t <= b.t) AS tl, (SELECT arg_min(v, x.t) FROM a x WHERE x.k = b.k AND x.t > b.t) AS r, (SELECT min(x.t) FROM a x WHERE x.k = b.k AND x.t > b.t) AS tr FROM b),
st AS (SELECT *, (t - tl) / (tr - tl) AS x FROM j) SELECT k AS key, CAST(t AS INT) AS t_min, round(coalesce(l + (r - l) * x * x * (3 - 2 * x), l, r), 7) AS speed FROM st""")
def anchor_curves(spark, d):
    a = profiles.weekday_profile(slots(spark, d)).where(F.col("t_min").isin(360, 540, 900, 1140)).select(F.col("tmc_code").alias("key"), "t_min", "speed")
    bins = a.select("key").distinct().select("key", F.explode(F.sequence(F.lit(0), F.lit(1380), F.lit(60))).alias("t_min"))
    return resources.anchor_curve(bins, a).withColumn("speed", F.round("speed", 7))


@query("""SELECT c_custkey AS key, coalesce(r_regionkey, 10) AS district FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 4 LEFT JOIN region ON n_regionkey = r_regionkey""")
def district_assignment(spark, d):
    """Zone to jurisdiction to district by two small lookups; unknown zones are district 10."""
    n, g = table(spark, d, "nation").where("n_nationkey % 5 != 4"), table(spark, d, "region")
    return table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(g, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("c_custkey").alias("key"), F.coalesce("r_regionkey", F.lit(10)).alias("district"))


@query("SELECT perf_id, coalesce(regexp_replace(regexp_replace(CAST(TRY_CAST(trim(link_id) AS DECIMAL(38, 9)) AS VARCHAR), '0+$', ''), '\\.$', ''), trim(link_id)) AS canonical FROM link_performance WHERE link_id IS NOT NULL")
def canonical_numbers(spark, d):
    return table(spark, d, "link_performance").where("link_id is not null").select("perf_id", text.number_text(F.col("link_id")).alias("canonical"))
