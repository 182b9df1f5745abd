"""Queries of rules, texts, clocks and matching whose inputs reach every branch, with their SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics, text
from flowmark.operators import classes, matching, ml, network, profiles, ranking, resources, spatial
from flowmark.plans.extras import _XY, sensor_ends
from flowmark.plans.measurement import _M, _PERIOD, _R, _S, _W, readings, registry, slots
from flowmark.plans.relational import _J, _L, _MAP, _REP, joined, links, mapping
from flowmark.plans.storage import _OPEN, _PARTS, period_tables
from flowmark.session import table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


# ---- texts ----------------------------------------------------------------------------------------------------------


@query(f"""WITH {_L}, {_PARTS}, u AS (SELECT link_id, trim(x.m) AS m, min(CASE period WHEN 'MD' THEN 0 WHEN 'AM' THEN 10 ELSE 20 END + x.i) AS pos FROM pl, LATERAL (SELECT unnest(string_split(use, ';')) AS m, generate_subscripts(string_split(use, ';'), 1) AS i) x WHERE lower(trim(x.m)) NOT IN ('', '0', 'closed', 'nan', 'none') GROUP BY ALL)
SELECT k.link_id, coalesce(string_agg(m, ';' ORDER BY pos), '') AS uses FROM (SELECT DISTINCT link_id FROM pl) k LEFT JOIN u ON k.link_id = u.link_id GROUP BY k.link_id""")
def allowed_uses(spark: SparkSession, d: str) -> DataFrame:
    """Distinct modes of a link over its periods, in order of first appearance."""
    p = period_tables(spark, d).groupBy("link_id").pivot("period", ["MD", "AM", "PM"]).agg(F.first("use"))
    return p.select("link_id", text.union_of_uses(F.col("MD"), F.col("AM"), F.col("PM")).alias("uses"))


@query(f"WITH {_L}, {_PARTS} SELECT period, link_id, from_node_id, to_node_id FROM pl WHERE {_OPEN}")
def open_links(spark, d):
    """Links by period without those closed in it."""
    return period_tables(spark, d).where(text.is_open(F.col("use"))).select("period", "link_id", "from_node_id", "to_node_id")


_NAMES = """nm AS (SELECT DISTINCT name FROM (SELECT road AS name FROM tmc_metadata UNION ALL SELECT streetname FROM link UNION ALL SELECT 'Interstate 66 (HOV)' UNION ALL SELECT 'US Highway 050' UNION ALL SELECT 'State Route 7 North' UNION ALL SELECT 'Route 28' UNION ALL SELECT ' & ' UNION ALL SELECT 'I 664 ramp') WHERE name IS NOT NULL),
pl2 AS (SELECT name, trim(regexp_replace(regexp_replace(upper(name), '&', ' AND ', 'g'), '[^A-Z0-9]+', ' ', 'g')) AS a FROM nm),
ab AS (SELECT name, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(a, '\\bINTERSTATE\\b', 'I', 'g'), '\\bUNITED STATES\\b', 'US', 'g'), '\\bHIGHWAY\\b', 'HWY', 'g'), '\\bBOULEVARD\\b', 'BLVD', 'g'), '\\bAVENUE\\b', 'AVE', 'g'), '\\bPARKWAY\\b', 'PKWY', 'g'), '\\bTURNPIKE\\b', 'TPKE', 'g'), '\\bROAD\\b', 'RD', 'g'), '\\bSTREET\\b', 'ST', 'g') AS b FROM pl2),
tk AS (SELECT name, list_filter(string_split(b, ' '), lambda w: w <> '' AND w NOT IN ('N', 'S', 'E', 'W', 'NB', 'SB', 'EB', 'WB', 'NORTHBOUND', 'SOUTHBOUND', 'EASTBOUND', 'WESTBOUND', 'RD', 'ST', 'AVE', 'BLVD', 'PKWY', 'HWY', 'TPKE')) AS t FROM ab)"""


def names(spark, d) -> DataFrame:
    own = spark.createDataFrame([(x,) for x in ("Interstate 66 (HOV)", "US Highway 050", "State Route 7 North", "Route 28", " & ", "I 664 ramp")], "name string")
    return table(spark, d, "tmc_metadata").select(F.col("road").alias("name")).unionByName(table(spark, d, "link").select(F.col("streetname").alias("name"))).unionByName(own).where("name is not null").distinct()


@query(rf"""WITH {_NAMES}, k AS (SELECT name, t, array_to_string(t, ' ') AS s FROM tk)
SELECT name, s AS tokens, CASE WHEN regexp_matches(s, '\bI ?[0-9]+\b') THEN 1.0 WHEN regexp_matches(s, '\bUS ?[0-9]+\b') THEN 2.0 WHEN regexp_matches(s, '\b((VA|SR) ?|ROUTE )[0-9]+\b') THEN 3.0 WHEN len(t) > 0 THEN 3.5 END::DOUBLE AS class,
regexp_matches(name, '(?i)\bI[\s-]*66([^0-9]|$)') AS on_i66, regexp_matches(trim(name), '(?i)(HOV|EXPRESS|HOT|MANAGED)') AS managed, trim(regexp_replace(upper(name), '\s*\([^)]*\)', '')) AS base FROM k""")
def road_classes(spark, d):
    """Words, inferred class, route pattern, managed label and base name of road names."""
    n, tokens = F.col("name"), text.road_tokens(F.col("name"))
    return names(spark, d).select("name", F.array_join(tokens, " ").alias("tokens"), text.road_class(n).alias("class"), n.rlike(text.route_pattern("I", 66)).alias("on_i66"), text.is_managed(n).alias("managed"), text.base_road(n).alias("base"))


@query(f"""WITH {_L}, c AS (SELECT link_id, TRY_CAST(link_type AS INT) % 10 AS g, coalesce(regexp_matches(trim(streetname), '(?i)(HOV|EXPRESS|HOT|MANAGED)'), false) OR link_id % 17 = 0 AS m FROM lk)
SELECT link_id, CASE WHEN m THEN 'managed' WHEN g >= 5 THEN 'ramp' WHEN g = 0 THEN 'connector' WHEN g IS NOT NULL THEN 'general_purpose' ELSE 'unknown' END AS role FROM c""")
def facility_roles(spark, d):
    managed = text.is_managed(F.col("streetname")) | (F.col("link_id") % 17 == 0)
    return links(spark, d).select("link_id", text.facility_role(F.col("link_type"), managed).alias("role"))


@query(f"""WITH {_MAP}, g AS (SELECT tmc, count(*) AS n, sum(link_id) AS total FROM (SELECT DISTINCT tmc, link_id FROM mp) GROUP BY tmc) SELECT tmc, CAST(n AS INT) AS n_ids, CAST(total AS BIGINT) AS total FROM g""")
def parsed_id_lists(spark, d):
    """Lists of link ids as text, with parts that are no numbers, parsed to whole numbers."""
    t = mapping(spark, d).select("tmc", "link_id").distinct().groupBy("tmc").agg(F.concat_ws("; ", F.lit("n/a"), F.concat_ws(";", F.collect_list(F.col("link_id").cast("string"))), F.lit("")).alias("ids"))
    ids = text.id_list(F.col("ids"))
    return t.select("tmc", F.size(ids).alias("n_ids"), F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


# ---- clocks ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {_S}, q AS (SELECT tmc_code, slot_s, day, t_min, {_PERIOD.format(m='t_min')} AS period FROM w)
SELECT tmc_code, slot_s, period, CAST(day * 86400 + CASE period WHEN 'AM' THEN 21600 WHEN 'MD' THEN 32400 WHEN 'PM' THEN 54000 ELSE CASE WHEN t_min < 360 THEN -18000 ELSE 68400 END END AS BIGINT) AS start_s,
CAST(day * 86400 + CASE period WHEN 'AM' THEN 32400 WHEN 'MD' THEN 54000 WHEN 'PM' THEN 68400 ELSE CASE WHEN t_min < 360 THEN 21600 ELSE 108000 END END AS BIGINT) AS end_s FROM q""")
def period_windows(spark, d):
    """The concrete window of the period that each slot lies in; a night began the day before or ends the day after."""
    s = slots(spark, d)
    day, minute = clock.day_number(F.col("slot_s")), clock.minute_of_day(F.col("slot_s"))
    x = clock.period_window(day, minute)
    return s.select("tmc_code", "slot_s", clock.period_of(minute).alias("period"), x["start_s"].cast("bigint").alias("start_s"), x["end_s"].cast("bigint").alias("end_s"))


_WINDOWS = ["0600_0900", "0900_1500", "1500_1900", "1900_0600"]


@query(f"""WITH {_S}, k(name, a, b) AS (VALUES ('0600_0900', 360, 540), ('0900_1500', 540, 900), ('1500_1900', 900, 1140), ('1900_0600', 1140, 360)), m AS (SELECT DISTINCT tmc_code, t_min FROM w)
SELECT name, tmc_code, count(*) AS n, CAST(min(t_min) AS INT) AS first_min, ((b - a + 1440) % 1440)::DOUBLE AS minutes, CASE WHEN b > a THEN b - a ELSE 1440 - a END / 60.0 AS same_day_hours FROM m, k WHERE CASE WHEN a < b THEN t_min >= a AND t_min < b ELSE t_min >= a OR t_min < b END GROUP BY ALL""")
def window_members(spark, d):
    """Times of day that lie in windows written HHMM_HHMM, with the windows' minutes and their hours up to midnight."""
    w = spark.createDataFrame([(x,) for x in _WINDOWS], "name string").withColumn("w", clock.window_text(F.col("name")))
    m = slots(spark, d).select("tmc_code", clock.minute_of_day(F.col("slot_s")).alias("t_min")).distinct()
    j = m.join(F.broadcast(w), clock.in_window(F.col("t_min"), F.col("w.start"), F.col("w.end")))  # four windows
    return j.groupBy("name", "tmc_code").agg(F.count("*").alias("n"), F.min("t_min").alias("first_min"), F.max("w.minutes").alias("minutes"), F.max(clock.truncated_at_midnight(F.col("w.start"), F.col("w.end"))).alias("same_day_hours"))


# ---- physics and profiles -------------------------------------------------------------------------------------------


@query(f"""WITH {_S}, x AS (SELECT tmc_code, quantile_cont(speed, 0.95) AS p95 FROM s GROUP BY tmc_code), y AS (SELECT tmc_code, median(reference_speed) AS ref FROM r GROUP BY tmc_code), z AS (SELECT x.tmc_code, least(greatest(greatest(p95, ref, 60.0), 35), 85) AS vf FROM x JOIN y USING (tmc_code))
SELECT tmc_code, round(vf, 8) AS vf, round(vf * 0.7, 8) AS vc, round(2 * ln(2) / ln(1 / 0.7), 8) AS m, round(1800.0 / (vf * 0.7), 8) AS kc FROM z""")
def synthetic_curves(spark, d):
    """The curve of a sensor without measured flow, from its 95th percentile, its median reference and a default."""
    a = slots(spark, d).groupBy("tmc_code").agg(F.percentile("speed", F.lit(0.95)).alias("p95"))
    b = readings(spark, d).groupBy("tmc_code").agg(F.median("reference_speed").alias("ref"))
    x = physics.s3_context(F.col("p95"), F.col("ref"), F.lit(60.0), F.lit(1800.0))
    return a.join(b, "tmc_code").select("tmc_code", x.alias("x")).select("tmc_code", "x.vf", "x.vc", "x.m", "x.kc")


@query(f"""WITH {_W}, q AS (SELECT *, speed / quantile_cont(speed, 0.95) OVER (PARTITION BY tmc_code) AS ratio FROM p), l AS (SELECT tmc_code, t_min, ratio, lag(ratio) OVER w AS a, lead(ratio) OVER w AS b FROM q WINDOW w AS (PARTITION BY tmc_code ORDER BY t_min))
SELECT tmc_code, t_min, round(CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a ELSE a * 0.75 + b * 0.25 END, 8) AS blended FROM l""")
def blended_profiles(spark, d):
    """Normalised profiles interpolated from the values on either side, one carried where the other is unknown."""
    p = profiles.normalised_profile(profiles.weekday_profile(slots(spark, d)))
    w = Window.partitionBy("tmc_code").orderBy("t_min")
    return p.select("tmc_code", "t_min", resources.weighted_profile(F.lag("ratio").over(w), F.lead("ratio").over(w), F.lit(0.25)).alias("blended"))


@query("""WITH x AS (SELECT t2_id, (t2_hour - 6) * 60 AS rel, ln((t3_hour - t0_hour) * 60) AS sp, greatest(least((t2_hour - t0_hour) / (t3_hour - t0_hour), 0.9999), 0.0001) AS pl FROM link_t2 WHERE t3_hour > t0_hour AND t2_hour IS NOT NULL),
y AS (SELECT t2_id, 6 + least(greatest(rel / 60, 0), 3) AS t2, least(greatest(exp(sp), 15), 900) / 60 AS h, 1 / (1 + exp(-least(greatest(ln(pl / (1 - pl)), -20), 20))) AS s FROM x) SELECT t2_id, round(t2 - h * s, 8) AS t0, round(t2, 8) AS t2, round(t2 + h * (1 - s), 8) AS t3 FROM y""")
def recovered_boundaries(spark, d):
    """Boundaries from unbounded targets, within the AM period and the allowed spans."""
    t = table(spark, d, "link_t2").where("t3_hour > t0_hour and t2_hour is not null")
    x = ml.boundaries_to_targets(F.col("t0_hour"), F.col("t2_hour"), F.col("t3_hour"), F.lit(6.0))
    y = ml.targets_to_boundaries(F.col("x.t2_rel"), F.col("x.log_span"), F.col("x.logit_place"), F.lit(6.0), F.lit(3.0))
    return t.select("t2_id", x.alias("x")).select("t2_id", y.alias("y")).select("t2_id", "y.t0", "y.t2", "y.t3")


# ---- rules with all their branches ----------------------------------------------------------------------------------


@query(f"""WITH {_MAP}, x AS (SELECT map_id, distance_to_tmc_ft AS ft, node_pair_tmc_rank AS rk, map_id % 23 AS a, map_id % 29 AS b, match_confidence FROM mp)
SELECT map_id, CASE WHEN rk IS NULL THEN 'no_path' WHEN a = 1 THEN 'review_loop' WHEN a = 2 THEN 'review_facility_class' WHEN a = 3 THEN 'review_corridor_continuity' WHEN ft > 3200 OR b = 1 THEN 'review_od_distance' WHEN b IN (2, 3) THEN 'review_length' WHEN ft > 900 OR b = 4 THEN 'review_geometry'
WHEN rk > 4 THEN 'review_direction' WHEN b = 5 THEN 'review_ambiguous_route' WHEN coalesce(match_confidence = 'high', false) THEN 'matched' ELSE 'review_low_confidence' END AS status FROM x""")
def match_statuses(spark, d):
    """Every status of a matched route, from measures that reach each rule."""
    a, b, ft, rk = F.col("map_id") % 23, F.col("map_id") % 29, F.col("distance_to_tmc_ft"), F.col("node_pair_tmc_rank")
    status = classes.match_status(
        {
            "links": F.when(rk.isNull(), 0).otherwise(2), "repeated": F.when(a == 1, 1).otherwise(0), "class_switches": F.when(a == 2, 2).otherwise(0), "transition": F.when(a == 3, "disconnected").otherwise("node_connected"),
            "start_ft": ft, "end_ft": F.when(b == 1, 3300.0).otherwise(100.0), "length_ratio": F.when(b == 2, 0.3).when(b == 3, 3.1).otherwise(1.0), "mean_offset_ft": ft, "most_offset_ft": F.when(b == 4, 2700.0).otherwise(50.0),
            "bearing": F.when(rk > 4, 60.0).otherwise(10.0), "margin": F.when(b == 5, 1.5).when(b == 6, F.lit(None)).otherwise(9.0), "confidence": F.when(F.col("match_confidence") == "high", 80.0).otherwise(40.0),
        }
    )
    return mapping(spark, d).select("map_id", status.alias("status"))


@query(f"""WITH {_MAP}, x AS (SELECT map_id, map_id % 31 AS a, CASE WHEN map_id % 7 > 0 THEN map_id % 7 END * 1.0 AS gap FROM mp)
SELECT map_id, CASE WHEN a = 1 THEN 'transition_link' WHEN a = 2 THEN 'facility_class_differs' WHEN a IN (3, 4, 5) AND gap <= 1 THEN 'before_first_within_1_mi' WHEN a IN (6, 7, 8) AND gap <= 1 THEN 'after_last_within_1_mi' WHEN a BETWEEN 3 AND 8 AND gap <= 5 THEN 'outside_within_5_mi'
WHEN a BETWEEN 3 AND 8 AND gap > 5 THEN 'outside_beyond_5_mi' WHEN a IN (9, 10) THEN 'other_direction' WHEN a = 11 THEN 'connector_or_ramp' WHEN a = 12 THEN 'managed_lane' WHEN a BETWEEN 13 AND 17 THEN 'between_anchors' WHEN a BETWEEN 18 AND 24 THEN 'within_corridor' WHEN a BETWEEN 25 AND 28 THEN 'terminal' ELSE 'other' END AS reason FROM x""")
def unmatched_reason_tree(spark, d):
    """Every reason why a link has no sensor, from inputs that reach each rule."""
    a, gap = F.col("map_id") % 31, F.when(F.col("map_id") % 7 > 0, (F.col("map_id") % 7).cast("double"))
    reason = classes.unmatched_reason(
        {
            "transition": a == 1, "same_class": a != 2, "gap_mi": gap, "before": a.isin(3, 4, 5), "after": a.isin(6, 7, 8), "same_direction": ~a.isin(9, 10), "connector": a == 11, "managed": a == 12,
            "between_ft": F.when(a.between(13, 17), 400.0).when(a > 20, F.lit(None)).otherwise(900.0), "within": a.between(18, 24), "terminal": a.between(25, 28),
        }
    )
    return mapping(spark, d).select("map_id", reason.alias("reason"))


@query(f"""WITH {_J}, x AS (SELECT perf_id, speed_mph, speed_mph + perf_id % 5 - 2 AS e, free_speed * 0.8 AS cut, vht / 10 AS p, doc, speed_mph * 1.01 AS v, CASE WHEN perf_id % 19 = 0 THEN 0 ELSE volume END AS vol, speed_mph + perf_id % 3 - 1 AS vt2 FROM j)
SELECT perf_id, CASE WHEN speed_mph < cut AND e < cut THEN concat_ws(';', CASE WHEN p < 0.5 THEN 'short_p' END, CASE WHEN doc < 0.5 THEN 'low_doc' END, CASE WHEN v > greatest(speed_mph, e) THEN 'faster_than_boundaries' END, CASE WHEN vol = 0 THEN 'no_volume' END, CASE WHEN vt2 > greatest(speed_mph, e) THEN 'vt2_above_boundaries' END) ELSE '' END AS reasons FROM x""")
def low_boundary_reasons(spark, d):
    """Every reason of the selection of links with low boundary speeds."""
    v, k = F.col("speed_mph"), F.col("perf_id")
    why = classes.low_boundary_reasons(v, v + k % 5 - 2, F.col("free_speed") * 0.8, F.col("vht") / 10, F.col("doc"), v * 1.01, F.when(k % 19 == 0, 0.0).otherwise(F.col("volume")), v + k % 3 - 1)
    return joined(spark, d).select("perf_id", why.alias("reasons"))


@query(f"""WITH {_L}, x AS (SELECT link_id, length, free_speed AS v, length * 1609.344 * CASE WHEN link_id % 13 = 0 THEN 1.001 ELSE 1 END AS m, free_speed * 1.609344 * CASE WHEN link_id % 13 = 1 THEN 1.001 ELSE 1 END AS k, 60 * length / free_speed * CASE WHEN link_id % 13 = 2 THEN 1.001 ELSE 1 END AS t FROM lk WHERE length > 0 AND free_speed > 0)
SELECT link_id, link_id % 13 > 2 AS agrees FROM x""")
def unit_violations(spark, d):
    """Links whose metres, kilometres an hour or free minutes don't fit their miles and speed."""
    n, length, v = F.col("link_id") % 13, F.col("length"), F.col("free_speed")
    off = lambda i: F.when(n == i, 1.001).otherwise(1.0)
    ok = classes.units_agree(length, length * physics.MILE_M * off(0), v, v * physics.MPH_KPH * off(1), 60 * length / v * off(2))
    return links(spark, d).where("length > 0 and free_speed > 0").select("link_id", ok.alias("agrees"))


@query(f"""WITH {_MAP}, x AS (SELECT link_id, tmc, distance_to_tmc_ft + 22 * (map_id % 90) + 0.10 * (map_id % 5000) AS score FROM mp WHERE distance_to_tmc_ft IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY score, tmc) AS place FROM x) SELECT link_id, tmc, round(score, 6) AS score FROM k WHERE place = 1""")
def direction_assignment(spark, d):
    """The sensor with the least score of distance, angle and distance along the route."""
    m = mapping(spark, d).where("distance_to_tmc_ft is not null")
    m = m.select("link_id", "tmc", classes.direction_score(F.col("distance_to_tmc_ft"), F.col("map_id") % 90, F.col("map_id") % 5000).alias("score"))
    return ranking.pick_first(m, ["link_id"], [F.col("score"), F.col("tmc")]).select("link_id", "tmc", F.round("score", 6).alias("score"))


@query("SELECT * FROM (VALUES ('capacity'), ('doc'), ('free_speed'), ('lanes'), ('volume')) t(feature)")
def guarded_features(spark, d):
    """Columns of the learning table that aren't known only after detection; asking for one that is fails."""
    own = ["lanes", "free_speed", "capacity", "doc", "volume"]
    for bad in ("t2_hour", "P_HR"):
        try:
            ml.guard([*own, bad])
            raise AssertionError(f"{bad} passed the guard")
        except ValueError:
            pass
    return spark.createDataFrame([(f,) for f in ml.guard(own)], "feature string")


@query(f"""WITH {_J}, {_REP}, x AS (SELECT t2_hour AS y, j.* FROM j JOIN rep ON rep.link_id = j.link_id AND rep.period = j.period AND rep.place = 1 WHERE t2_hour >= 0),
c AS (SELECT 'lanes' AS feature, corr(y, lanes) AS r FROM x UNION ALL SELECT 'free_speed', corr(y, free_speed) FROM x UNION ALL SELECT 'capacity', corr(y, capacity) FROM x UNION ALL SELECT 'doc', corr(y, doc) FROM x UNION ALL SELECT 'volume', corr(y, volume) FROM x UNION ALL SELECT 'length', corr(y, length) FROM x)
SELECT feature, round(abs(r), 7) AS importance, row_number() OVER (ORDER BY round(abs(r), 7) DESC, feature) AS place FROM c WHERE r IS NOT NULL ORDER BY place LIMIT 4""")
def feature_importance(spark, d):
    """The features that go most with the target, the greatest first (a report of the top four)."""
    t = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("t2_hour >= 0").select("link_id", "period", F.col("t2_hour").alias("y"))
    x = t.join(joined(spark, d), ["link_id", "period"]).withColumn("lanes", F.col("lanes").cast("double"))
    return ml.importance(x, ["lanes", "free_speed", "capacity", "doc", "volume", "length"], "y", 4)


@query(f"""WITH {_W}, e AS (SELECT tmc_code, day, t_min, speed, quantile_disc(day, 0.8) OVER () AS cut FROM w), m AS (SELECT tmc_code, t_min, avg(speed) AS guess FROM e WHERE day < cut GROUP BY ALL), k AS (SELECT e.*, guess, CASE WHEN day < cut THEN 'train' ELSE 'test' END AS part FROM e LEFT JOIN m USING (tmc_code, t_min))
SELECT part, count(guess) AS n, round(avg(abs(speed - guess)), 7) AS mae, round(sqrt(avg((speed - guess) ** 2)), 7) AS rmse FROM k GROUP BY part""")
def temporal_holdout(spark, d):
    """Mean profiles of the earlier days, held against the last fifth of them."""
    s = slots(spark, d).select("tmc_code", clock.day_number(F.col("slot_s")).alias("day"), clock.minute_of_day(F.col("slot_s")).alias("t_min"), "speed")
    cut_day = s.agg(F.percentile_disc("day", F.lit(0.8)).alias("cut")) if hasattr(F, "percentile_disc") else s.agg(F.expr("percentile_disc(0.8) within group (order by day)").alias("cut"))
    s = s.join(F.broadcast(cut_day)).withColumn("part", ml.temporal_holdout(F.col("day"), F.col("cut")))  # one row
    k = s.join(s.where("part = 'train'").groupBy("tmc_code", "t_min").agg(F.avg("speed").alias("guess")), ["tmc_code", "t_min"], "left")
    e = F.col("speed") - F.col("guess")
    return k.groupBy("part").agg(F.count("guess").alias("n"), F.round(F.avg(F.abs(e)), 7).alias("mae"), F.round(F.sqrt(F.avg(e * e)), 7).alias("rmse"))


@query(f"""WITH {_L}, {_MAP}, v AS (SELECT DISTINCT mp.tmc, link_id, link_type, free_speed FROM mp JOIN lk USING (link_id) WHERE link_type IS NOT NULL AND free_speed IS NOT NULL),
a AS (SELECT link_type, sum(free_speed) AS s, count(*) AS n FROM v GROUP BY ALL), o AS (SELECT tmc, link_type, sum(free_speed) AS s, count(*) AS n FROM v GROUP BY ALL) SELECT o.tmc, o.link_type, CAST(a.n - o.n AS BIGINT) AS n_others, round((a.s - o.s) / nullif(a.n - o.n, 0), 8) AS prior FROM o JOIN a USING (link_type)""")
def leave_one_sensor_out(spark, d):
    """Class means without the rows of the sensor that they are given to."""
    v = mapping(spark, d).select("tmc", "link_id").join(links(spark, d).select("link_id", "link_type", "free_speed"), "link_id").where("link_type is not null and free_speed is not null").distinct()
    return ml.leave_group_out(v, "tmc", ["link_type"], "free_speed")


@query(f"""WITH {_M}, c AS (SELECT road || ' ' || direction AS corridor, tmc, miles, road_order FROM meta WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL AND miles > 0), st AS (SELECT upper(trim(tmc_code)) AS tmc, median(free_flow_speed_model_mph) AS vf FROM stage0_outputs GROUP BY 1),
p AS (SELECT corridor, c.tmc, vf, sum(miles) OVER (PARTITION BY corridor ORDER BY road_order ASC NULLS FIRST, c.tmc ROWS UNBOUNDED PRECEDING) - miles / 2 AS position FROM c LEFT JOIN st USING (tmc)),
q AS (SELECT *, last_value(vf IGNORE NULLS) OVER b AS lv, position - last_value(CASE WHEN vf IS NOT NULL THEN position END IGNORE NULLS) OVER b AS lg, first_value(vf IGNORE NULLS) OVER a AS rv, first_value(CASE WHEN vf IS NOT NULL THEN position END IGNORE NULLS) OVER a - position AS rg FROM p
WINDOW b AS (PARTITION BY corridor ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY corridor ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT tmc, round(lv, 8) AS "left", round(rv, 8) AS "right", round(lg, 8) AS left_gap, round(rg, 8) AS right_gap, round(coalesce(lv + (rv - lv) * lg / nullif(lg + rg, 0), lv, rv), 8) AS spatial_prior FROM q""")
def spatial_features(spark, d):
    """Neighbours' values along the corridor as features; a sensor's own value takes no part."""
    from flowmark.plans.relational import positions_with_speed

    b = spatial.bracket(positions_with_speed(spark, d), ["corridor"], "position", "vf")
    prior = F.coalesce(F.col("left") + (F.col("right") - F.col("left")) * physics.div(F.col("left_gap"), F.col("left_gap") + F.col("right_gap")), "left", "right")
    return b.select("tmc", "left", "right", "left_gap", "right_gap", prior.alias("spatial_prior"))


# ---- geometry and matching ------------------------------------------------------------------------------------------


@query(f"""WITH {_XY}, n AS (SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY road_order ASC NULLS LAST, tmc) AS i FROM g), h AS (SELECT a.tmc, a.sx, a.sy, a.ex, a.ey, b.sx AS cx, b.sy AS cy, b.ex AS dx, b.ey AS dy FROM n a JOIN n b ON a.corridor = b.corridor AND b.i = a.i + 1),
u AS (SELECT tmc, sqrt((dx - cx) ** 2 + (dy - cy) ** 2) AS n, ((sx - cx) * (dx - cx) + (sy - cy) * (dy - cy)) AS pa, ((ex - cx) * (dx - cx) + (ey - cy) * (dy - cy)) AS pb, ((sx - cx) * (dy - cy) - (sy - cy) * (dx - cx)) AS qa, ((ex - cx) * (dy - cy) - (ey - cy) * (dx - cx)) AS qb FROM h),
v AS (SELECT tmc, pa / n AS pa, pb / n AS pb, qa / n AS qa, qb / n AS qb, n FROM u WHERE n > 0), z AS (SELECT tmc, least((0 - pa) / (pb - pa), (n - pa) / (pb - pa)) AS s1, greatest((0 - pa) / (pb - pa), (n - pa) / (pb - pa)) AS e1, least((-8000 - qa) / (qb - qa), (8000 - qa) / (qb - qa)) AS s2, greatest((-8000 - qa) / (qb - qa), (8000 - qa) / (qb - qa)) AS e2 FROM v WHERE pb <> pa AND qb <> qa)
SELECT tmc, round(least(greatest(least(e1, e2, 1) - greatest(s1, s2, 0), 0), 1), 6) AS share FROM z""")
def overlap_with_next(spark, d):
    """Share of a sensor's line that lies within 8,000 feet beside the next one of its corridor."""
    w = Window.partitionBy("corridor").orderBy(F.col("road_order").asc_nulls_last(), "tmc")
    g = sensor_ends(spark, d)
    cols = ("start_x", "start_y", "end_x", "end_y")
    h = g.select("tmc", *cols, *(F.lead(c).over(w).alias(f"n_{c}") for c in cols)).where("n_start_x is not null")
    n = F.hypot(F.col("n_end_x") - F.col("n_start_x"), F.col("n_end_y") - F.col("n_start_y"))
    along = (F.col("end_x") - F.col("start_x")) * (F.col("n_end_x") - F.col("n_start_x")) + (F.col("end_y") - F.col("start_y")) * (F.col("n_end_y") - F.col("n_start_y"))
    across = (F.col("end_x") - F.col("start_x")) * (F.col("n_end_y") - F.col("n_start_y")) - (F.col("end_y") - F.col("start_y")) * (F.col("n_end_x") - F.col("n_start_x"))
    share = resources.overlap_share(*(F.col(c) for c in cols), *(F.col(f"n_{c}") for c in cols), 8000.0)
    return h.where((n > 0) & (along != 0) & (across != 0)).select("tmc", F.round(share, 6).alias("share"))


_GRID = """k AS (SELECT corridor, tmc, row_number() OVER (PARTITION BY corridor ORDER BY tmc) - 1 AS i, dense_rank() OVER (ORDER BY corridor) AS c FROM (SELECT DISTINCT corridor, tmc FROM g))"""


def laid_out(spark, d) -> tuple[DataFrame, DataFrame]:
    """Sensors and links of a laid-out network: each corridor a straight chain of sensors of a mile, two links to a sensor, with a parallel detour; as the tables give links no geometry."""
    g = sensor_ends(spark, d).select("corridor", "tmc").distinct()
    i = F.row_number().over(Window.partitionBy("corridor").orderBy("tmc")) - 1
    k = g.select("corridor", "tmc", i.alias("i"), F.dense_rank().over(Window.orderBy("corridor")).alias("c"))  # one row per sensor
    x, y = F.col("i") * 5280.0, F.col("c") * 1e6
    sensors = k.select("corridor", "tmc", F.col("corridor").alias("road"), F.col("i").cast("double").alias("road_order"), F.lit(1.0).alias("miles"), x.alias("start_x"), y.alias("start_y"), (x + 5280.0).alias("end_x"), y.alias("end_y"))
    parts = [
        (0, 0, 1, 0.5, 0.0, 0.0, 0.5, 0.0), (1, 1, 2, 0.5, 0.5, 0.0, 1.0, 0.0),  # the sensor's own halves
        (2, 0, 3, 0.62, 0.0, 0.0, 0.5, 700.0), (3, 3, 2, 0.62, 0.5, 700.0, 1.0, 0.0),  # a detour beside it
    ]
    base = F.col("c") * 100_000 + F.col("i") * 4
    node = lambda j: (F.col("c") * 100_000 + F.col("i") * 4 + (4 if j == 2 else 0 if j == 0 else j)).alias
    out = None
    for n, a, b, miles, ax, ay, bx, by in parts:
        p = k.select(
            "corridor", (base + n).alias("link_id"), node(a)("from_node_id"), node(b)("to_node_id"), F.lit(miles).alias("miles"), F.col("corridor").alias("streetname"), F.lit("freeway").alias("facility"),
            (x + 5280.0 * ax).alias("ax"), (y + ay).alias("ay"), (x + 5280.0 * bx).alias("bx"), (y + by).alias("by"),
        )
        out = p if out is None else out.unionByName(p)
    return sensors, out


@query(f"""WITH {_XY}, {_GRID} SELECT corridor, tmc, CAST(i + 1 AS INT) AS place, CAST(c * 100000 + i * 4 AS BIGINT) || ';' || CAST(c * 100000 + i * 4 + 1 AS BIGINT) AS links, CASE WHEN i = 0 THEN 'predecessor_no_path' ELSE 'node_connected' END AS transition FROM k""")
def corridor_matches(spark, d):
    """The chain of routes that fits the sensors of each corridor best: their own links, not the detours beside them."""
    return matching.match_corridors(*laid_out(spark, d)).select("corridor", "tmc", "place", "links", "transition")


@query(f"""WITH {_XY}, {_GRID} SELECT corridor, CAST(c * 100000 + i * 4 + h AS BIGINT) AS link_id, CAST(i * 2 + h + 1 AS INT) AS link_order, tmc AS tmcs FROM k, (VALUES (0), (1)) x(h)""")
def corridor_link_order(spark, d):
    """Links of the matched routes in order of first appearance, with the sensors they belong to."""
    return matching.ordered_links(matching.match_corridors(*laid_out(spark, d)))


@query(f"""WITH {_XY}, {_GRID}, mm AS (SELECT corridor, max(i) AS n, any_value(c) AS c FROM k GROUP BY corridor)
SELECT corridor, CAST(c * 100000 + 4 AS BIGINT) AS start_id, CAST(c * 100000 + 8 AS BIGINT) AS end_id, 1 AS place, 7.44 AS cost, CAST(c * 100000 + 4 AS BIGINT) || ';' || CAST(c * 100000 + 7 AS BIGINT) || ';' || CAST(c * 100000 + 8 AS BIGINT) AS path, 1.24 AS miles FROM mm WHERE n >= 1""")
def bridged_gaps(spark, d):
    """Gaps of corridors where the second sensor's own links are missing, bridged by links off the corridor at six times their length."""
    links_ = laid_out(spark, d)[1]
    n = F.col("link_id") % 100_000
    edges = links_.where(~n.isin(4, 5)).withColumn("on_corridor", F.col("link_id") % 4 < 2).withColumn("is_ramp", F.lit(False))
    gaps = links_.where(n == 4).select("corridor", F.col("from_node_id").alias("start_id"), (F.col("from_node_id") + 4).alias("end_id"))
    return network.gap_bridges(edges, gaps)


@query(f"""WITH {_REP}, e AS (SELECT link_id, period, t2_hour AS observed, t0_hour, t3_hour, p_hr FROM rep WHERE place = 1), {_J},
x AS (SELECT perf_id, j.link_id, j.period, volume, doc, observed, t0_hour, t3_hour, e.p_hr, e.link_id IS NOT NULL AS there FROM j LEFT JOIN e ON j.link_id = e.link_id AND j.period = e.period)
SELECT perf_id, CASE WHEN NOT there THEN 'unmapped' WHEN volume IS NULL THEN 'no_assignment' WHEN observed IS NULL THEN 'no_assignment_curve' ELSE 'ready' END AS status, round(observed, 8) AS observed_t2, round(t3_hour - t0_hour, 8) AS observed_p,
round(0.8 * pow(greatest(doc, 0), 1.4), 8) AS projected_p, round(observed - 0.8 * pow(greatest(doc, 0), 1.4) * 0.5, 8) AS projected_t0, round(observed + 0.8 * pow(greatest(doc, 0), 1.4) * 0.5, 8) AS projected_t3, round(0.8 * pow(greatest(doc, 0), 1.4) - (t3_hour - t0_hour), 8) AS delta_p FROM x""")
def projection_table(spark, d):
    """Observed, queue-based and assigned values of each link and period side by side."""
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).select("link_id", "period", F.col("t2_hour").alias("observed"), (F.col("t3_hour") - F.col("t0_hour")).alias("observed_p"), F.lit(True).alias("there"))
    j = joined(spark, d).join(e, ["link_id", "period"], "left")
    status = F.when(F.col("there").isNull(), "unmapped").when(F.col("volume").isNull(), "no_assignment").when(F.col("observed").isNull(), "no_assignment_curve").otherwise("ready")
    p = 0.8 * F.pow(F.greatest("doc", F.lit(0.0)), F.lit(1.4))
    p = F.when(F.col("doc").isNotNull(), p).otherwise(0.0)
    x = physics.predicted_bounds(F.col("observed"), p, F.lit(0.5))
    return j.select("perf_id", status.alias("status"), F.col("observed").alias("observed_t2"), "observed_p", p.alias("projected_p"), x["t0"].alias("projected_t0"), x["t3"].alias("projected_t3"), (p - F.col("observed_p")).alias("delta_p"))


