"""Queries of state labels, lookups, validation by blocks, quality over days, chains of sensors and SQL functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics
from flowmark.functions.registry import register
from flowmark.operators import classes, islands, matching, profiles, ranking, spatial
from flowmark.plans.measurement import _F, _M, _PERIOD, _S, _W, registry, slots, thresholds
from flowmark.plans.relational import _ALL, _BR, _J, _L, _MAP, _REP, held_out, joined, links, mapping, positions_with_speed
from flowmark.session import table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


@query(f"""WITH {_F}, l AS (SELECT *, lag(speed, 2) OVER q AS before, lead(speed) OVER q AS nxt, thr / 0.7 AS vf FROM k WINDOW q AS (PARTITION BY tmc_code ORDER BY t_min))
SELECT tmc_code, t_min, CASE WHEN speed > thr AND nxt <= thr THEN 'breakdown' WHEN speed > thr AND speed - before >= 8 THEN 'recovery' WHEN speed > thr AND before - speed >= 10 THEN 'breakdown' WHEN speed <= 0.5 * thr THEN 'severe' WHEN speed <= thr THEN 'congested' WHEN speed >= round(0.85 * vf, 8) THEN 'free' ELSE 'normal' END AS state FROM l""")
def state_labels(spark: SparkSession, d: str) -> DataFrame:
    """Traffic states by level, then change over two steps, then a step ahead of congestion; later rules win."""
    w = Window.partitionBy("tmc_code").orderBy("t_min")
    v, thr = F.col("speed"), F.col("thr")
    before, nxt = F.lag("speed", 2).over(w), F.lead("speed").over(w)
    state = classes.ordered([((v > thr) & (nxt <= thr), "breakdown"), ((v > thr) & (v - before >= 8), "recovery"), ((v > thr) & (before - v >= 10), "breakdown"), (v <= 0.5 * thr, "severe"), (v <= thr, "congested"), (v >= F.round(0.85 * F.col("free_speed"), 8), "free")], "normal")
    return thresholds(spark, d).select("tmc_code", "t_min", state.alias("state"))


@query(f"""WITH {_F}, l AS (SELECT tmc_code, period, speed, speed - lag(speed) OVER (PARTITION BY tmc_code, period ORDER BY t_min) AS dv, t_min FROM k)
SELECT tmc_code, period, round(avg((dv >= 0)::INT), 8) AS rising_share, round(arg_max(speed, t_min) - arg_min(speed, t_min), 8) AS net_change, round(max(abs(dv)), 8) AS most_change FROM l GROUP BY tmc_code, period""")
def monotone_share(spark, d):
    x = thresholds(spark, d).withColumn("dv", F.col("speed") - F.lag("speed").over(Window.partitionBy("tmc_code", "period").orderBy("t_min")))
    return x.groupBy("tmc_code", "period").agg(F.avg((F.col("dv") >= 0).cast("double")).alias("rising_share"), (F.max_by("speed", "t_min") - F.min_by("speed", "t_min")).alias("net_change"), F.max(F.abs("dv")).alias("most_change"))


@query(f"""WITH {_L}, {_MAP}, u AS (SELECT from_node_id, to_node_id, min(distance_to_tmc_ft) AS best, count(*) AS n FROM mp GROUP BY ALL) SELECT link_id, best, coalesce(n, 0) AS n, CASE WHEN u.n IS NULL THEN 'default' ELSE 'lookup' END AS source FROM lk LEFT JOIN u ON lk.from_node_id = u.from_node_id AND lk.to_node_id = u.to_node_id""")
def node_pair_lookup(spark, d):
    """Lookup by node pair as two key columns (no packed keys, which overflow)."""
    u = mapping(spark, d).groupBy("from_node_id", "to_node_id").agg(F.min("distance_to_tmc_ft").alias("best"), F.count("*").alias("n"))
    out = links(spark, d).join(u, ["from_node_id", "to_node_id"], "left")
    return out.select("link_id", "best", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "default").otherwise("lookup").alias("source"))


@query(f"""WITH {_S}, dd AS (SELECT tmc_code, t_min, day, speed, avg(speed) OVER (PARTITION BY tmc_code, t_min) AS m FROM w) SELECT tmc_code, count(*) AS n, round(sqrt(avg((speed - m) ** 2)), 8) AS rmse, round(stddev_samp(speed) / nullif(avg(speed), 0), 8) AS cv,
round(1 - sum((speed - m) ** 2) / nullif(sum((speed - mm) ** 2), 0), 7) AS r2 FROM (SELECT *, avg(speed) OVER (PARTITION BY tmc_code) AS mm FROM dd) GROUP BY tmc_code""")
def day_to_day_quality(spark, d):
    """Spread of days about the mean profile of a sensor: RMSE, coefficient of variation, share explained."""
    s = slots(spark, d).withColumn("t_min", clock.minute_of_day(F.col("slot_s")))
    s = s.withColumn("m", F.avg("speed").over(Window.partitionBy("tmc_code", "t_min"))).withColumn("mm", F.avg("speed").over(Window.partitionBy("tmc_code")))
    e = F.col("speed") - F.col("m")
    out = s.groupBy("tmc_code").agg(F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), physics.div(F.stddev_samp("speed"), F.avg("speed")).alias("cv"), (1 - physics.div(F.sum(e * e), F.sum(F.pow(F.col("speed") - F.col("mm"), 2)))).alias("r2"))
    return out.withColumn("r2", F.round("r2", 7))


@query(f"""WITH {_REP}, e AS (SELECT upper(trim(tmc)) AS tmc, period, p_hr, min_speed_mph FROM rep WHERE place = 1 AND tmc IS NOT NULL) SELECT tmc, period, count(*) AS n, round(sum(p_hr) FILTER (p_hr >= 0), 8) AS p_hr, round(max(p_hr), 8) AS longest, round(min(min_speed_mph) FILTER (min_speed_mph >= 0), 8) AS slowest FROM e GROUP BY tmc, period""")
def selected_episode_summary(spark, d):
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("tmc is not null")
    return e.groupBy(F.upper(F.trim("tmc")).alias("tmc"), "period").agg(F.count("*").alias("n"), F.sum(F.when(F.col("p_hr") >= 0, F.col("p_hr"))).alias("p_hr"), F.max("p_hr").alias("longest"), F.min(F.when(F.col("min_speed_mph") >= 0, F.col("min_speed_mph"))).alias("slowest"))


@query(f"""WITH {_F}, {_M}, h AS (SELECT corridor, period, count(*) AS n, sum(miles) / nullif(sum(miles / speed), 0) AS speed, count(*) FILTER (speed <= thr) / count(*) AS share FROM k JOIN mem USING (tmc_code) WHERE speed > 0 GROUP BY GROUPING SETS ((corridor, period), (corridor)))
SELECT corridor, coalesce(period, 'DAY') AS period, n, round(speed, 8) AS speed, round(share, 8) AS share, CASE WHEN n < 12 THEN 'insufficient' WHEN share > 0.3 THEN 'congested' WHEN share > 0 THEN 'partly' ELSE 'free' END AS status FROM h""")
def metrics_tables(spark, d):
    """Corridor by period and by day in one pass."""
    from flowmark.plans.measurement import members

    k = thresholds(spark, d).join(members(spark, d), "tmc_code").where("speed > 0")
    g = k.groupingSets([["corridor", "period"], ["corridor"]], "corridor", "period").agg(F.count("*").alias("n"), profiles.harmonic_speed(F.col("speed"), F.col("miles")).alias("speed"), (F.count_if(F.col("speed") <= F.col("thr")) / F.count("*")).alias("share"))
    status = classes.ordered([(F.col("n") < 12, "insufficient"), (F.col("share") > 0.3, "congested"), (F.col("share") > 0, "partly")], "free")
    return g.select("corridor", F.coalesce("period", F.lit("DAY")).alias("period"), "n", "speed", "share", status.alias("status"))


@query(f"""WITH {_ALL}, b AS (SELECT * EXCLUDE (fold), ntile(5) OVER (PARTITION BY corridor ORDER BY position) AS block FROM p WHERE vf IS NOT NULL), f AS (SELECT unnest(range(1, 6)) AS fold),
z AS (SELECT fold, corridor, tmc, position, vf, CASE WHEN block <> fold THEN vf END AS known, block FROM b, f),
y AS (SELECT *, last_value(known IGNORE NULLS) OVER a AS lv, position - last_value(CASE WHEN known IS NOT NULL THEN position END IGNORE NULLS) OVER a AS lg, first_value(known IGNORE NULLS) OVER c AS rv, first_value(CASE WHEN known IS NOT NULL THEN position END IGNORE NULLS) OVER c - position AS rg FROM z
WINDOW a AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT CASE WHEN lv IS NOT NULL AND rv IS NOT NULL THEN 'bracketed' WHEN lv IS NOT NULL OR rv IS NOT NULL THEN 'one_sided' ELSE 'none' END AS method, count(*) AS n, round(avg(abs(coalesce(lv + (rv - lv) * lg / nullif(lg + rg, 0), lv, rv) - vf)), 8) AS mae, round(median(abs(coalesce(lv + (rv - lv) * lg / nullif(lg + rg, 0), lv, rv) - vf)), 8) AS median_error
FROM y WHERE block = fold GROUP BY 1""")
def blocked_validation(spark, d):
    """Anchors held out in five blocks along each corridor and filled from the others."""
    b = positions_with_speed(spark, d).where("vf is not null").withColumn("block", F.ntile(5).over(Window.partitionBy("corridor").orderBy("position")))
    z = b.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn("known", F.when(F.col("block") != F.col("fold"), F.col("vf")))
    y = spatial.bracket(z, ["fold", "corridor"], "position", "known").where("block = fold")
    guess = F.coalesce(F.col("left") + (F.col("right") - F.col("left")) * physics.div(F.col("left_gap"), F.col("left_gap") + F.col("right_gap")), "left", "right")
    e = F.abs(guess - F.col("vf"))
    method = F.when(F.col("left").isNotNull() & F.col("right").isNotNull(), "bracketed").when(F.col("left").isNotNull() | F.col("right").isNotNull(), "one_sided").otherwise("none")
    return y.groupBy(method.alias("method")).agg(F.count("*").alias("n"), F.avg(e).alias("mae"), F.median(e).alias("median_error"))


_XY = f"""{_M}, g AS (SELECT road || ' ' || direction AS corridor, tmc, road_order, (start_longitude + 40) * 365228.0 * cos(radians(12.0)) AS sx, (start_latitude - 12) * 362664.0 AS sy, (end_longitude + 40) * 365228.0 * cos(radians(12.0)) AS ex, (end_latitude - 12) * 362664.0 AS ey FROM meta
WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL AND start_latitude IS NOT NULL AND end_latitude IS NOT NULL AND start_longitude IS NOT NULL AND end_longitude IS NOT NULL)"""


def sensor_ends(spark, d) -> DataFrame:
    m = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and direction is not null and start_latitude is not null and end_latitude is not null and start_longitude is not null and end_longitude is not null")
    import math

    east = lambda c: (F.col(c) + 40) * F.lit(365228.0) * F.lit(math.cos(math.radians(12.0)))
    north = lambda c: (F.col(c) - 12) * F.lit(362664.0)
    return m.select(F.concat_ws(" ", "road", "direction").alias("corridor"), "tmc", "road", "road_order", "miles", east("start_longitude").alias("start_x"), north("start_latitude").alias("start_y"), east("end_longitude").alias("end_x"), north("end_latitude").alias("end_y"))


@query(f"""WITH {_XY}, n AS (SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY road_order ASC NULLS LAST, tmc) AS place FROM g), j AS (SELECT a.corridor, a.tmc, b.tmc AS before, sqrt((b.ex - a.sx) ** 2 + (b.ey - a.sy) ** 2) AS gap, coalesce(abs(a.road_order - b.road_order), 'infinity'::DOUBLE) AS o, b.place AS p0
FROM n a JOIN n b ON a.corridor = b.corridor AND b.place < a.place) SELECT corridor, tmc, before, round(gap, 6) AS gap_ft FROM (SELECT *, row_number() OVER (PARTITION BY corridor, tmc ORDER BY gap, o, -p0, before) AS k FROM j WHERE gap <= 20000) WHERE k = 1""")
def source_chains(spark, d):
    """The sensor that feeds each sensor of a corridor, by the distance of their ends."""
    return matching.predecessors(sensor_ends(spark, d), 20_000.0).withColumn("gap_ft", F.round("gap_ft", 6))


@query(f"""WITH {_BR}, t AS (SELECT fold, tmc, corridor, lg, rg, lv, rv, vf, regexp_matches(corridor, '(?i)(HOV|EXPRESS|HOT|MANAGED)') AS managed FROM q) SELECT fold, tmc, CASE WHEN vf IS NOT NULL THEN 0 WHEN managed THEN 1 WHEN least(lg, rg) * 5280 <= 500 THEN 2 WHEN least(lg, rg) <= 1 THEN 3 WHEN least(lg, rg) <= 5 THEN 4 ELSE 9 END AS tier,
round(CASE WHEN lv IS NULL OR rv IS NULL THEN NULL ELSE least(greatest((lv * 0.5 + rv * 0.5) * exp(-least(lg, rg) / 1.5) + 60.0 * (1 - exp(-least(lg, rg) / 1.5)), least(lv, rv, 60.0)), greatest(lv, rv, 60.0)) END, 8) AS blend FROM t""")
def treatment_tiers(spark, d):
    from flowmark.functions import text

    b = spatial.bracket(held_out(spark, d), ["fold", "corridor"], "position", "vf")
    gap = F.least("left_gap", "right_gap")
    tier = F.when(F.col("vf").isNotNull(), 0).otherwise(spatial.treatment_tier(text.is_managed(F.col("corridor")), gap * 5280, gap))
    both = F.col("left").isNotNull() & F.col("right").isNotNull()
    return b.select("fold", "tmc", tier.alias("tier"), F.when(both, spatial.profile_blend(F.col("left"), F.col("right"), F.lit(0.5), F.lit(60.0), gap, 1.5)).alias("blend"))


@query(f"""WITH {_BR}, t AS (SELECT fold, tmc, vf, lg, rg, lv, rv, coalesce(least(lg, rg), 99) AS gap FROM q WHERE vf IS NULL) SELECT fold, tmc, CASE WHEN lv IS NULL AND gap <= 1 THEN 'before_first_within_1_mi' WHEN rv IS NULL AND gap <= 1 THEN 'after_last_within_1_mi' WHEN (lv IS NULL OR rv IS NULL) AND gap <= 5 THEN 'outside_within_5_mi' WHEN lv IS NULL OR rv IS NULL THEN 'outside_beyond_5_mi'
WHEN (lg + rg) * 5280 <= 500 THEN 'between_anchors' ELSE 'within_corridor' END AS reason FROM t""")
def unmatched_reasons(spark, d):
    b = spatial.bracket(held_out(spark, d), ["fold", "corridor"], "position", "vf").where("vf is null")
    yes, no = F.lit(True), F.lit(False)
    gap = F.coalesce(F.least("left_gap", "right_gap"), F.lit(99.0))
    reason = classes.unmatched_reason({"transition": no, "same_class": yes, "gap_mi": gap, "before": F.col("left").isNull(), "after": F.col("right").isNull(), "same_direction": yes, "connector": no, "managed": no, "between_ft": (F.col("left_gap") + F.col("right_gap")) * 5280, "within": yes, "terminal": no})
    return b.select("fold", "tmc", reason.alias("reason"))


@query(f"""WITH {_XY}, c AS (SELECT corridor, arg_min(sx, (coalesce(road_order, 1e9), tmc)) AS ax, arg_min(sy, (coalesce(road_order, 1e9), tmc)) AS ay, arg_min(ex, (coalesce(road_order, 1e9), tmc)) AS bx, arg_min(ey, (coalesce(road_order, 1e9), tmc)) AS byy FROM g GROUP BY corridor),
r AS (SELECT tmc, sqrt((bx - ax) ** 2 + (byy - ay) ** 2) AS n, (sx - ax) * (bx - ax) + (sy - ay) * (byy - ay) AS dot, (sx - ax) * (byy - ay) - (sy - ay) * (bx - ax) AS crs FROM g JOIN c USING (corridor)) SELECT tmc, round(dot / nullif(n, 0), 5) AS along, round(abs(crs / nullif(n, 0)), 5) AS lateral, round(abs(crs / nullif(n, 0)) + 0.1 * abs(dot / nullif(n, 0)), 5) AS score FROM r""")
def ray_relations(spark, d):
    """Each sensor against the ray of its corridor's first sensor."""
    g = sensor_ends(spark, d)
    first = g.groupBy("corridor").agg(F.min_by(F.struct("start_x", "start_y", "end_x", "end_y"), F.struct(F.coalesce("road_order", F.lit(1e9)), "tmc")).alias("f"))
    x = physics.ray_relation(F.col("start_x"), F.col("start_y"), F.col("f.start_x"), F.col("f.start_y"), F.col("f.end_x"), F.col("f.end_y"))
    return g.join(first, "corridor").select("tmc", x.alias("x")).select("tmc", *(F.round(f"x.{c}", 5).alias(c) for c in ("along", "lateral", "score")))


@query(f"""WITH {_J} SELECT perf_id, period FROM j WHERE NOT EXISTS (SELECT 1 FROM tmc_mapping m WHERE m.from_node_id = j.from_node_id AND m.to_node_id = j.to_node_id)""")
def unmatched_override_keys(spark, d):
    """Keys of one table that another lacks: the check before overrides are applied."""
    return joined(spark, d).join(table(spark, d, "tmc_mapping"), ["from_node_id", "to_node_id"], "left_anti").select("perf_id", "period")


@query(f"""WITH {_W}, q AS (SELECT tmc_code, t_min, speed, {_PERIOD.format(m='t_min')} AS period FROM p) SELECT tmc_code, period, round(avg(speed), 8) AS speed, count(*) AS bins, min(t_min) AS first_min FROM q WHERE period IN ('AM', 'PM') GROUP BY tmc_code, period""")
def sql_functions(spark, d):
    """The registered SQL functions in a user's query over a temporary view."""
    register(spark)
    profiles.weekday_profile(slots(spark, d)).createOrReplaceTempView("flowmark_profile")
    return spark.sql("select tmc_code, period_of(t_min) as period, avg(speed) as speed, count(*) as bins, min(t_min) as first_min from flowmark_profile where period_of(t_min) in ('AM', 'PM') group by all")


@query(f"""WITH {_F}, b AS (SELECT tmc_code, period, count(*) AS n, count(*) FILTER (speed <= thr) AS c FROM k GROUP BY GROUPING SETS ((tmc_code, period))) SELECT period, round(avg(c * 15), 8) AS mean_min, round(median(c * 15), 8) AS median_min, round(quantile_cont(c * 15, 0.9), 8) AS p90_min, round(avg((c > 0)::INT), 8) AS share FROM b GROUP BY period""")
def congestion_summary(spark, d):
    b = thresholds(spark, d).groupBy("tmc_code", "period").agg(islands.threshold_minutes(F.col("speed"), F.col("thr"), 15).alias("m"))
    return b.groupBy("period").agg(F.avg("m").alias("mean_min"), F.median("m").alias("median_min"), F.percentile("m", F.lit(0.9)).alias("p90_min"), F.avg((F.col("m") > 0).cast("double")).alias("share"))
