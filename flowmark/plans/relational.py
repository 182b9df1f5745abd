"""Queries of joins, rankings, aggregations, set operations, classes and text functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics, text
from flowmark.operators import islands, performance, profiles, ranking, spatial
from flowmark.plans.measurement import _M, _PERIOD, r, registry, rounded
from flowmark.schema import PERIODS
from flowmark.session import code, spelled_id, table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


# ---- cleaned tables -------------------------------------------------------------------------------------------------


def good(c: str):
    return F.when(F.col(c) >= 0, F.col(c)).alias(c)


def performance_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per link and period: the last iteration, then the latest load, then the smallest id; negative fillers are null."""
    rows = table(spark, d, "link_performance").withColumn("link_id", spelled_id("link_id")).withColumn("period", F.upper(F.btrim("period", F.lit(" \t"))))
    rows = rows.where("link_id is not null and period is not null")
    rows = ranking.pick_first(rows, ["link_id", "period"], [F.col("iteration_no").desc_nulls_last(), F.col("loaded_at").desc_nulls_last(), F.col("perf_id")])
    return rows.select("perf_id", "link_id", "period", "iteration_no", *(good(c) for c in ("volume", "speed_mph", "travel_time", "doc", "vmt", "vht")), "link_capacity")


def links(spark: SparkSession, d: str) -> DataFrame:
    """The latest version of each link, its type in normal form."""
    rest = [F.col(c).asc_nulls_last() for c in ("length", "lanes", "link_type", "free_speed", "capacity", "streetname", "from_node_id", "to_node_id")]
    rows = ranking.pick_first(table(spark, d, "link"), ["link_id"], [F.col("valid_from").desc_nulls_last(), F.col("valid_to").desc_nulls_first(), *rest])
    return rows.withColumn("link_type", text.normal_code(F.col("link_type")))


def mapping(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tmc_mapping").withColumn("tmc", code("tmc")).where("tmc is not null and link_id is not null")


def joined(spark: SparkSession, d: str) -> DataFrame:
    """Performance with the link's columns and derived measures; district is a tenth of the from node."""
    p = performance_rows(spark, d).join(links(spark, d).drop("valid_from", "valid_to"), "link_id")
    return performance.performance_columns(p).withColumn("district", (F.col("from_node_id") % 10).cast("int"))


_L = """lr AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY valid_from DESC NULLS LAST, valid_to DESC NULLS FIRST, length ASC NULLS LAST, lanes ASC NULLS LAST, link_type ASC NULLS LAST, free_speed ASC NULLS LAST, capacity ASC NULLS LAST, streetname ASC NULLS LAST, from_node_id ASC NULLS LAST, to_node_id ASC NULLS LAST) AS place FROM link),
lk AS (SELECT link_id, from_node_id, to_node_id, nullif(regexp_replace(trim(link_type), '\\.0+$', ''), '') AS link_type, length, lanes, free_speed, capacity, streetname FROM lr WHERE place = 1)"""
_P = """pr AS (SELECT *, TRY_CAST(trim(link_id, ' \t\r\n') AS DECIMAL(38, 9)) AS x, upper(trim(period, ' \t')) AS p FROM link_performance),
pk AS (SELECT *, row_number() OVER (PARTITION BY CAST(x AS BIGINT), p ORDER BY iteration_no DESC NULLS LAST, loaded_at DESC NULLS LAST, perf_id) AS place FROM pr WHERE x = CAST(x AS BIGINT) AND p IS NOT NULL),
pf AS (SELECT perf_id, CAST(x AS BIGINT) AS link_id, p AS period, iteration_no, CASE WHEN volume >= 0 THEN volume END AS volume, CASE WHEN speed_mph >= 0 THEN speed_mph END AS speed_mph,
       CASE WHEN travel_time >= 0 THEN travel_time END AS travel_time, CASE WHEN doc >= 0 THEN doc END AS doc, CASE WHEN vmt >= 0 THEN vmt END AS vmt, CASE WHEN vht >= 0 THEN vht END AS vht, link_capacity FROM pk WHERE place = 1)"""
_H = "CASE period WHEN 'AM' THEN 3.0 WHEN 'MD' THEN 6.0 WHEN 'PM' THEN 4.0 WHEN 'NT' THEN 11.0 END::DOUBLE"
_J = f"""{_L}, {_P}, j0 AS (SELECT pf.*, lk.* EXCLUDE (link_id), CAST(from_node_id % 10 AS INT) AS district, length / nullif(speed_mph, 0) AS t, length / nullif(free_speed, 0) AS f, speed_mph / nullif(free_speed, 0) AS speed_ratio FROM pf JOIN lk ON pf.link_id = lk.link_id),
j1 AS (SELECT *, volume * t AS travel_h, volume * f AS free_h, volume * length AS miles, CASE WHEN speed_ratio < 1 THEN greatest(t - f, 0) ELSE 0 END * volume AS delay_h FROM j0),
j AS (SELECT *, CASE WHEN speed_ratio < 0.5 THEN delay_h ELSE 0 END AS severe_h FROM j1)"""
_MAP = """mp AS (SELECT map_id, upper(trim(tmc, ' \t\r\n')) AS tmc, link_id, from_node_id, to_node_id, period, distance_to_tmc_ft, node_pair_tmc_rank, match_confidence FROM tmc_mapping WHERE nullif(trim(tmc, ' \t\r\n'), '') IS NOT NULL AND link_id IS NOT NULL)"""


# ---- joins ----------------------------------------------------------------------------------------------------------


@query(f"WITH {_MAP}, {_M} SELECT map_id, mp.tmc, link_id, road, miles FROM mp JOIN meta ON mp.tmc = meta.tmc WHERE place = 1")
def inner_join_metadata(spark, d):
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).select("tmc", "road", "miles")
    return mapping(spark, d).join(meta, "tmc").select("map_id", "tmc", "link_id", "road", "miles")


@query(f"WITH {_L}, {_P} SELECT perf_id, pf.link_id, period, lanes, link_type FROM pf LEFT JOIN lk ON pf.link_id = lk.link_id")
def left_join_checked(spark, d):
    return performance_rows(spark, d).join(ranking.assert_unique(links(spark, d), ["link_id"]), "link_id", "left").select("perf_id", "link_id", "period", "lanes", "link_type")


@query(f"""WITH {_P}, {_MAP}, a AS (SELECT link_id, count(*) AS n_perf FROM pf GROUP BY link_id), b AS (SELECT link_id, count(*) AS n_map FROM mp GROUP BY link_id)
SELECT coalesce(a.link_id, b.link_id) AS link_id, CASE WHEN a.link_id IS NULL THEN 'mapping_only' WHEN b.link_id IS NULL THEN 'performance_only' ELSE 'paired' END AS side, coalesce(n_perf, 0) AS n_perf, coalesce(n_map, 0) AS n_map FROM a FULL JOIN b ON a.link_id = b.link_id""")
def full_outer_audit(spark, d):
    a = performance_rows(spark, d).groupBy("link_id").agg(F.count("*").alias("n_perf"))
    b = mapping(spark, d).groupBy("link_id").agg(F.count("*").alias("n_map"))
    side = F.when(F.col("n_perf").isNull(), "mapping_only").when(F.col("n_map").isNull(), "performance_only").otherwise("paired")
    return a.join(b, "link_id", "full_outer").select("link_id", side.alias("side"), F.coalesce("n_perf", F.lit(0)).alias("n_perf"), F.coalesce("n_map", F.lit(0)).alias("n_map"))


@query(f"WITH {_MAP} SELECT map_id, tmc, link_id FROM mp WHERE link_id IN (SELECT link_id FROM link_t2 WHERE p_hr > 0.5)")
def semi_join_wanted(spark, d):
    return mapping(spark, d).join(table(spark, d, "link_t2").where("p_hr > 0.5"), "link_id", "left_semi").select("map_id", "tmc", "link_id")


@query(f"WITH {_MAP} SELECT map_id, tmc, link_id FROM mp WHERE NOT EXISTS (SELECT 1 FROM link WHERE link.link_id = mp.link_id)")
def anti_join_unmatched(spark, d):
    return mapping(spark, d).join(table(spark, d, "link"), "link_id", "left_anti").select("map_id", "tmc", "link_id")


@query(f"""WITH {_J}, up AS (SELECT to_node_id AS node, period, count(*) AS n, sum(capacity) AS cap, avg(doc) AS doc FROM j GROUP BY ALL), dn AS (SELECT from_node_id AS node, period, count(*) AS n, sum(capacity) AS cap, avg(doc) AS doc FROM j GROUP BY ALL)
SELECT perf_id, coalesce(up.n, 0) AS n_up, coalesce(dn.n, 0) AS n_down, round(up.doc, 8) AS up_doc, round(dn.doc, 8) AS down_doc, round(capacity / nullif(up.cap, 0), 8) AS up_ratio, coalesce(up.n, 0) > 1 AS merge, coalesce(dn.n, 0) > 1 AS diverge
FROM j LEFT JOIN up ON j.from_node_id = up.node AND j.period = up.period LEFT JOIN dn ON j.to_node_id = dn.node AND j.period = dn.period""")
def neighbour_features(spark, d):
    """Upstream and downstream of each link through node aggregates, never through link pairs."""
    j = joined(spark, d)
    side = lambda end, own, p: j.groupBy(F.col(end).alias(own), "period").agg(F.count("*").alias(f"n_{p}"), F.sum("capacity").alias(f"{p}_cap"), F.avg("doc").alias(f"{p}_doc"))
    out = j.join(side("to_node_id", "from_node_id", "up"), ["from_node_id", "period"], "left").join(side("from_node_id", "to_node_id", "down"), ["to_node_id", "period"], "left")
    up, down = F.coalesce("n_up", F.lit(0)), F.coalesce("n_down", F.lit(0))
    return rounded(out.select("perf_id", up.alias("n_up"), down.alias("n_down"), "up_doc", "down_doc", physics.div(F.col("capacity"), F.col("up_cap")).alias("up_ratio"), (up > 1).alias("merge"), (down > 1).alias("diverge")))


@query(f"""WITH {_L}, a AS (SELECT DISTINCT link_id FROM link_t2 WHERE link_id IS NOT NULL), g AS (SELECT a.link_id, p.period FROM a CROSS JOIN (VALUES ('AM'), ('MD'), ('PM'), ('NT')) p(period))
SELECT g.link_id, g.period, count(t2_id) AS n FROM g LEFT JOIN link_t2 t ON g.link_id = t.link_id AND g.period = t.period GROUP BY g.link_id, g.period""")
def cross_join_grid(spark, d):
    t = table(spark, d, "link_t2").where("link_id is not null")
    grid = t.select("link_id").distinct().withColumn("period", F.explode(F.array(*map(F.lit, ("AM", "MD", "PM", "NT")))))
    return grid.join(t.groupBy("link_id", "period").agg(F.count("t2_id").alias("n")), ["link_id", "period"], "left").na.fill(0, ["n"])


@query(f"""WITH {_MAP}, w AS (SELECT tmc, from_node_id, to_node_id FROM (SELECT *, row_number() OVER (PARTITION BY from_node_id, to_node_id ORDER BY distance_to_tmc_ft ASC NULLS LAST, map_id) AS k FROM mp) WHERE k = 1),
o AS (SELECT upper(trim(tmc_code)) AS tmc, max(free_flow_speed_model_mph) AS vf FROM stage0_outputs GROUP BY 1) SELECT w.tmc, from_node_id, to_node_id, round(vf, 8) AS vf FROM w JOIN o ON w.tmc = o.tmc""")
def expand_to_node_pairs(spark, d):
    w = ranking.map_ranks(mapping(spark, d)).where("pair_rank = 1").select("tmc", "from_node_id", "to_node_id")
    return rounded(w.join(table(spark, d, "stage0_outputs").groupBy(code("tmc_code").alias("tmc")).agg(F.max("free_flow_speed_model_mph").alias("vf")), "tmc"))


@query(f"""WITH x AS (SELECT t2_id, period, t0_hour AS a, t3_hour AS b FROM link_t2 WHERE t0_hour IS NOT NULL AND t3_hour > t0_hour), w(name, s, e) AS (VALUES ('AM', 6, 9), ('MD', 9, 15), ('PM', 15, 19), ('NT', 19, 30))
SELECT t2_id, name, round(least(b, e) - greatest(a, s), 8) AS hours, round((least(b, e) - greatest(a, s)) / (b - a), 8) AS share FROM x JOIN w ON a < e AND b > s""")
def range_overlap_join(spark, d):
    """Hours of each congestion inside each period window (range join on a four-row side)."""
    x = table(spark, d, "link_t2").where("t0_hour is not null and t3_hour > t0_hour").select("t2_id", F.col("t0_hour").alias("a"), F.col("t3_hour").alias("b"))
    windows = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.lit(s).alias("s"), F.lit(e).alias("e")) for n, s, e in (("AM", 6, 9), ("MD", 9, 15), ("PM", 15, 19), ("NT", 19, 30)))))
    x = x.withColumn("w", windows).where("a < w.e and b > w.s")
    hours = F.least("b", F.col("w.e").cast("double")) - F.greatest("a", F.col("w.s").cast("double"))
    return rounded(x.select("t2_id", "w.name", hours.alias("hours"), (hours / (F.col("b") - F.col("a"))).alias("share")))


@query(f"""WITH {_J}, b AS (SELECT link_type, median(capacity / nullif(lanes, 0)) AS cap FROM lk WHERE capacity > 0 GROUP BY link_type HAVING count(*) >= 5), a AS (SELECT median(capacity / nullif(lanes, 0)) AS cap FROM lk WHERE capacity > 0)
SELECT link_id, round(coalesce(b.cap, a.cap), 8) AS cap, CASE WHEN b.cap IS NULL THEN 'all' ELSE 'type' END AS source FROM lk LEFT JOIN b ON lk.link_type = b.link_type CROSS JOIN a""")
def lookup_with_default(spark, d):
    lk = links(spark, d)
    per = physics.div(F.col("capacity"), F.col("lanes").cast("double"))
    b = lk.where("capacity > 0").groupBy("link_type").agg(F.median(per).alias("b"), F.count("*").alias("n")).where("n >= 5")
    a = lk.where("capacity > 0").agg(F.median(per).alias("a"))
    out = lk.join(b, "link_type", "left").join(F.broadcast(a))  # one row
    return rounded(out.select("link_id", F.coalesce("b", "a").alias("cap"), F.when(F.col("b").isNull(), "all").otherwise("type").alias("source")))


@query(f"""WITH {_J}, x AS (SELECT link_type, period, doc FROM j WHERE doc IS NOT NULL), a AS (SELECT link_type, period, median(doc) AS v FROM x GROUP BY ALL HAVING count(*) >= 5), b AS (SELECT period, median(doc) AS v FROM x GROUP BY ALL HAVING count(*) >= 5), c AS (SELECT median(doc) AS v FROM x)
SELECT perf_id, round(coalesce(a.v, b.v, c.v), 8) AS doc, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 ELSE 2 END AS level FROM j LEFT JOIN a ON j.link_type = a.link_type AND j.period = a.period LEFT JOIN b ON j.period = b.period CROSS JOIN c WHERE doc IS NULL""")
def hierarchical_fallback(spark, d):
    j = joined(spark, d)
    known = j.where("doc is not null").select("link_type", "period", "doc")
    return rounded(ranking.fallback_lookup(j.where("doc is null").select("perf_id", "link_type", "period"), known, [["link_type", "period"], ["period"]], "doc").select("perf_id", "doc", "level"))


# ---- rankings and windows -------------------------------------------------------------------------------------------


@query(f"""WITH {_MAP} SELECT map_id, row_number() OVER (PARTITION BY link_id ORDER BY distance_to_tmc_ft ASC NULLS LAST, map_id) AS link_rank, row_number() OVER (PARTITION BY tmc ORDER BY distance_to_tmc_ft ASC NULLS LAST, map_id) AS tmc_rank,
row_number() OVER (PARTITION BY from_node_id, to_node_id ORDER BY distance_to_tmc_ft ASC NULLS LAST, map_id) AS pair_rank FROM mp""")
def mapping_ranks(spark, d):
    out = ranking.map_ranks(mapping(spark, d)).select("map_id", "link_rank", "tmc_rank", "pair_rank")
    return out.select(*(F.col(c).cast("bigint") for c in out.columns))


_REP = """rep AS (SELECT *, row_number() OVER (PARTITION BY link_id, period ORDER BY min_speed_mph ASC NULLS LAST, p_hr DESC NULLS LAST, t2_hour ASC NULLS LAST, t2_id) AS place FROM link_t2 WHERE link_id IS NOT NULL)"""


@query(f"WITH {_REP} SELECT t2_id, link_id, period, round(min_speed_mph, 8) AS min_speed_mph, round(p_hr, 8) AS p_hr FROM rep WHERE place = 1")
def representative_episode(spark, d):
    return rounded(ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).select("t2_id", "link_id", "period", "min_speed_mph", "p_hr"))


@query("""WITH x AS (SELECT *, CAST(updated_at AS DATE) AS day FROM link_t2 WHERE link_id IS NOT NULL), y AS (SELECT *, row_number() OVER (PARTITION BY link_id, period, day ORDER BY min_speed_mph ASC NULLS LAST, p_hr DESC NULLS LAST, t2_hour ASC NULLS LAST, t2_id) AS place FROM x)
SELECT link_id, period, count(*) AS days, round(avg(t2_hour), 8) AS t2, round(stddev_pop(t2_hour), 8) AS sd FROM y WHERE place = 1 GROUP BY link_id, period""")
def daily_pick_then_mean(spark, d):
    day = table(spark, d, "link_t2").where("link_id is not null").withColumn("day", F.to_date("updated_at"))
    out = ranking.representative(day, ["link_id", "period", "day"]).groupBy("link_id", "period").agg(F.count("*").alias("days"), F.avg("t2_hour").alias("t2"), F.stddev_pop("t2_hour").alias("sd"))
    return out.select("link_id", "period", "days", r("t2").alias("t2"), r("sd").alias("sd"))


@query(f"WITH {_J}, n AS (SELECT perf_id, period, delay_h, row_number() OVER (PARTITION BY period ORDER BY delay_h DESC NULLS LAST, perf_id) AS place FROM j) SELECT perf_id, period, round(delay_h, 6) AS delay_h, place FROM n WHERE place <= 20")
def worst_links_per_period(spark, d):
    out = ranking.top_n(joined(spark, d), ["period"], [F.col("delay_h").desc_nulls_last(), F.col("perf_id")], 20)
    return rounded(out.select("perf_id", "period", "delay_h", F.col("place").cast("bigint").alias("place")))


@query(f"""WITH {_M}, c AS (SELECT road || ' ' || direction AS corridor, tmc, road_order, miles, stage.vf FROM meta LEFT JOIN (SELECT upper(trim(tmc_code)) AS k, median(free_flow_speed_model_mph) AS vf FROM stage0_outputs GROUP BY 1) stage ON meta.tmc = stage.k WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL AND miles > 0),
p AS (SELECT *, sum(miles) OVER (PARTITION BY corridor ORDER BY road_order ASC NULLS FIRST, tmc ROWS UNBOUNDED PRECEDING) - miles / 2 AS position, ntile(5) OVER (PARTITION BY corridor ORDER BY road_order ASC NULLS FIRST, tmc) AS segment FROM c)
SELECT corridor, tmc, round(position, 8) AS position, segment FROM p""")
def corridor_positions(spark, d):
    c = corridor_members(spark, d)
    c = spatial.corridor_positions(c, "corridor", ["road_order", "tmc"], "miles")
    return rounded(c.select("corridor", "tmc", "position", F.ntile(5).over(Window.partitionBy("corridor").orderBy("road_order", "tmc")).cast("bigint").alias("segment")))


def corridor_members(spark, d) -> DataFrame:
    """corridor, tmc, road_order, miles and the median modelled free-flow speed where published."""
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and direction is not null and miles > 0")
    vf = table(spark, d, "stage0_outputs").groupBy(code("tmc_code").alias("tmc")).agg(F.median("free_flow_speed_model_mph").alias("vf"))
    return meta.select(F.concat_ws(" ", "road", "direction").alias("corridor"), "tmc", "road_order", "miles").join(vf, "tmc", "left")


_BR = f"""{_M}, c AS (SELECT road || ' ' || direction AS corridor, tmc, road_order, miles, fold, CASE WHEN ascii(substr(tmc, -1)) % 3 <> fold THEN vf END AS vf FROM (SELECT meta.*, stage.vf FROM meta
LEFT JOIN (SELECT upper(trim(tmc_code)) AS k, median(free_flow_speed_model_mph) AS vf FROM stage0_outputs GROUP BY 1) stage ON meta.tmc = stage.k WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL AND miles > 0), (VALUES (0), (1), (2)) folds(fold)),
p AS (SELECT *, sum(miles) OVER (PARTITION BY fold, corridor ORDER BY road_order ASC NULLS FIRST, tmc ROWS UNBOUNDED PRECEDING) - miles / 2 AS position FROM c),
q AS (SELECT *, last_value(vf IGNORE NULLS) OVER b AS lv, position - last_value(CASE WHEN vf IS NOT NULL THEN position END IGNORE NULLS) OVER b AS lg, first_value(vf IGNORE NULLS) OVER a AS rv, first_value(CASE WHEN vf IS NOT NULL THEN position END IGNORE NULLS) OVER a - position AS rg FROM p
WINDOW b AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY fold, corridor ORDER BY position ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


_ALL = _BR.replace("(VALUES (0), (1), (2))", "(VALUES (3))")  # nothing is held out


def positions_with_speed(spark, d) -> DataFrame:
    """Corridor members with their place along the corridor and their median free-flow speed, where known."""
    return spatial.corridor_positions(corridor_members(spark, d), "corridor", ["road_order", "tmc"], "miles")


def held_out(spark, d) -> DataFrame:
    """Corridor members three times (fold): in each, a third of them, by the last character of their code, lose their value, to be filled from neighbours. So every member is held out once."""
    c = positions_with_speed(spark, d).withColumn("fold", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return c.withColumn("vf", F.when(F.ascii(F.substring("tmc", -1, 1)) % 3 != F.col("fold"), F.col("vf")))


@query(f"""WITH {_BR}, t AS (SELECT *, CASE WHEN vf IS NOT NULL THEN 'A' WHEN lg + rg <= 10 THEN 'B' WHEN least(lg, rg) <= 5 THEN 'C' END AS tier FROM q)
SELECT fold, tmc, tier, round(CASE tier WHEN 'A' THEN vf WHEN 'B' THEN coalesce(lv + (rv - lv) * lg / nullif(lg + rg, 0), lv) WHEN 'C' THEN CASE WHEN lg <= coalesce(rg, 'infinity'::DOUBLE) THEN lv ELSE rv END END, 8) AS filled,
CASE WHEN tier = 'A' THEN 'observed' WHEN tier = 'B' AND lg + rg <= 5 THEN 'high' WHEN tier = 'B' THEN 'medium' WHEN tier = 'C' THEN 'low' ELSE 'none' END AS confidence FROM t""")
def spatial_tiers(spark, d):
    """As-of neighbours on both sides along the corridor; tiers A, B, C."""
    return rounded(spatial.spatial_tiers(held_out(spark, d), ["fold", "corridor"], "position", "vf").select("fold", "tmc", "tier", "filled", "confidence"))


@query(f"WITH {_BR} SELECT fold, tmc, round(CASE WHEN lg IS NULL THEN rv WHEN rg IS NULL THEN lv WHEN lg <= rg THEN lv ELSE rv END, 8) AS nearest, round(least(lg, rg), 8) AS gap FROM q WHERE lv IS NOT NULL OR rv IS NOT NULL")
def nearest_anchor(spark, d):
    b = spatial.bracket(held_out(spark, d), ["fold", "corridor"], "position", "vf").where("left is not null or right is not null")
    return rounded(b.select("fold", "tmc", F.when(F.col("left_gap").isNull(), F.col("right")).when(F.col("right_gap").isNull() | (F.col("left_gap") <= F.col("right_gap")), F.col("left")).otherwise(F.col("right")).alias("nearest"), F.least("left_gap", "right_gap").alias("gap")))


@query(f"""WITH {_ALL}, k AS (SELECT corridor, position AS x, vf AS y FROM p WHERE vf IS NOT NULL), n AS (SELECT corridor, count(*) AS n FROM k GROUP BY corridor HAVING count(*) >= 3),
s AS (SELECT a.corridor, median((b.y - a.y) / (b.x - a.x)) AS slope FROM k a JOIN k b ON a.corridor = b.corridor AND a.x < b.x GROUP BY a.corridor) SELECT corridor, n, round(least(greatest(slope, -20), 20), 8) AS slope FROM n JOIN s USING (corridor)""")
def theil_sen_slope(spark, d):
    return rounded(spatial.theil_sen(positions_with_speed(spark, d), ["corridor"], "position", "vf"))


# ---- aggregations ---------------------------------------------------------------------------------------------------


@query(f"""WITH {_P}, h AS (SELECT *, {_H} AS hh FROM pf) SELECT link_id, round(sum(volume), 6) AS volume, round(sum(speed_mph * hh) / nullif(sum(hh) FILTER (speed_mph IS NOT NULL), 0), 8) AS speed_mph, round(sum(vmt), 6) AS vmt, round(sum(vht), 6) AS vht, count(*) AS periods FROM h GROUP BY link_id""")
def day_from_periods(spark, d):
    out = performance.day_totals(performance_rows(spark, d), ["link_id"])
    return out.select("link_id", r("volume").alias("volume"), r("speed_mph").alias("speed_mph"), r("vmt").alias("vmt"), r("vht").alias("vht"), "periods")


_DS = """SELECT period, district, grouping(period) * 2 + grouping(district) AS level, count(*) AS n_links, round(sum(volume), 6) AS volume, round(sum(miles), 6) AS miles, round(sum(travel_h), 6) AS travel_h, round(sum(free_h), 6) AS free_h, round(sum(delay_h), 6) AS delay_h, round(sum(severe_h), 6) AS severe_h,
round(max(delay_h), 8) AS most_delay, round(avg(delay_h), 8) AS mean_delay, round(avg(doc), 8) AS mean_doc, round(sum(miles) / nullif(sum(travel_h), 0), 8) AS speed, round(sum(delay_h) / nullif(sum(miles), 0), 8) AS delay_per_mile, round(sum(travel_h) / nullif(sum(free_h), 0), 8) AS time_index
FROM j GROUP BY GROUPING SETS ((period, district), (period), ())"""


@query(f"WITH {_J} {_DS}")
def district_statistics(spark, d):
    s = performance.district_statistics(joined(spark, d))
    return s


@query(f"WITH {_J}, p AS (SELECT period, max(delay_h) AS a, avg(delay_h) AS b FROM j GROUP BY period) SELECT round(max(a), 8) AS most_delay, round(avg(a), 8) AS mean_of_most, round(avg(b), 8) AS mean_of_means FROM p")
def district_overall_row(spark, d):
    out = performance.overall_of_periods(performance.district_statistics(joined(spark, d)))
    return out.select(*(r(c).alias(c) for c in out.columns))


@query(f"""WITH {_J} SELECT period, CAST(CAST(floor(speed_mph / 5) * 5 AS INT) AS VARCHAR) || '_' || CAST(CAST(floor(speed_mph / 5) * 5 + 5 AS INT) AS VARCHAR) AS speed_class, count(*) AS n_links, round(sum(volume), 6) AS volume, round(sum(travel_h), 6) AS travel_h, round(sum(delay_h), 6) AS delay_h,
round(sum(delay_h) / greatest(sum(travel_h), 0.1), 8) AS delay_ratio FROM j WHERE speed_mph IS NOT NULL GROUP BY ALL""")
def speed_classes(spark, d):
    s = performance.speed_class_statistics(joined(spark, d))
    return s.select("period", "speed_class", "n_links", r("volume").alias("volume"), r("travel_h").alias("travel_h"), r("delay_h").alias("delay_h"), r("delay_ratio").alias("delay_ratio"))


@query(f"""WITH {_P}, x AS (SELECT link_id, volume, speed_mph FROM pf WHERE period = 'AM'), y AS (SELECT link_id, volume, speed_mph FROM pf WHERE period = 'PM')
SELECT link_id, coalesce(x.volume, -1) AS volume_base, coalesce(y.volume, -1) AS volume_other, round(coalesce(y.volume - x.volume, -1), 8) AS volume_diff, coalesce(x.speed_mph, -1) AS speed_mph_base, coalesce(y.speed_mph, -1) AS speed_mph_other, round(coalesce(y.speed_mph - x.speed_mph, -1), 8) AS speed_mph_diff FROM x LEFT JOIN y USING (link_id)""")
def scenario_difference(spark, d):
    p = performance_rows(spark, d)
    return rounded(performance.scenario_difference(p.where("period = 'AM'"), p.where("period = 'PM'"), ["link_id"], ["volume", "speed_mph"]))


@query(f"""WITH {_J}, {_MAP}, b AS (SELECT from_node_id, to_node_id, count(*) AS buses FROM mp GROUP BY ALL) SELECT period, count(*) AS n_links, CAST(sum(buses) AS BIGINT) AS buses, round(sum(buses * greatest(t - f, 0)), 6) AS bus_delay_h, round(sum(buses * 25 * greatest(t - f, 0)), 6) AS person_delay_h
FROM j JOIN b USING (from_node_id, to_node_id) GROUP BY period""")
def bus_delay(spark, d):
    """Transit runs per node pair (candidate rows stand for runs, 25 persons each) times the link's delay."""
    b = mapping(spark, d).groupBy("from_node_id", "to_node_id").agg(F.count("*").alias("buses"))
    late = F.greatest(physics.div(F.col("length"), F.col("speed_mph")) - physics.div(F.col("length"), F.col("free_speed")), F.lit(0.0))
    known = F.col("speed_mph").isNotNull() & (F.col("speed_mph") != 0) & F.col("free_speed").isNotNull() & F.col("length").isNotNull()
    late = F.when(known, late).otherwise(F.lit(0.0))
    return joined(spark, d).join(b, ["from_node_id", "to_node_id"]).groupBy("period").agg(F.count("*").alias("n_links"), F.sum("buses").alias("buses"), r(F.sum(F.col("buses") * late)).alias("bus_delay_h"), r(F.sum(F.col("buses") * 25 * late)).alias("person_delay_h"))


@query(f"""WITH {_J}, v AS (SELECT perf_id, volume * length AS vmt, volume * coalesce(CASE WHEN speed_mph > 0 THEN length / speed_mph END, CASE WHEN travel_time > 0 THEN travel_time / 60 END, CASE WHEN free_speed > 0 THEN length / free_speed END) AS vht, CASE WHEN free_speed > 0 THEN volume * length / free_speed END AS ff FROM j)
SELECT perf_id, round(vmt, 6) AS vmt, round(vht, 6) AS vht, round(ff, 8) AS ffvht, round(CASE WHEN vht IS NULL OR ff IS NULL THEN 0 ELSE greatest(vht - ff, 0) END, 8) AS delay FROM v""")
def vmt_vht_cascade(spark, d):
    x = physics.vmt_vht(F.col("volume"), F.col("length"), F.col("speed_mph"), F.col("free_speed"), F.col("travel_time"))
    return joined(spark, d).select("perf_id", x.alias("x")).select("perf_id", *(r(f"x.{c}").alias(c) for c in ("vmt", "vht", "ffvht", "delay")))


@query(f"""WITH {_J}, {_MAP}, {_M}, cm AS (SELECT DISTINCT road || ' ' || direction AS corridor, link_id FROM mp JOIN meta ON mp.tmc = meta.tmc WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL)
SELECT corridor, period, count(*) AS n_links, count(volume) AS n_volume, round(sum(volume), 6) AS volume, round(sum(miles), 6) AS vmt, round(sum(travel_h), 6) AS vht FROM cm JOIN j ON cm.link_id = j.link_id GROUP BY corridor, period""")
def corridor_period_sums(spark, d):
    """Membership is made distinct first, so a link counts once per corridor."""
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and direction is not null").select("tmc", F.concat_ws(" ", "road", "direction").alias("corridor"))
    cm = mapping(spark, d).join(meta, "tmc").select("corridor", "link_id").distinct()
    out = cm.join(joined(spark, d), "link_id").groupBy("corridor", "period").agg(F.count("*").alias("n_links"), F.count("volume").alias("n_volume"), F.sum("volume").alias("volume"), F.sum("miles").alias("vmt"), F.sum("travel_h").alias("vht"))
    return out.select("corridor", "period", "n_links", "n_volume", r("volume").alias("volume"), r("vmt").alias("vmt"), r("vht").alias("vht"))


@query(f"""WITH {_MAP} SELECT link_id, string_agg(DISTINCT tmc, ';' ORDER BY tmc) AS tmc_codes, count(DISTINCT tmc) AS n_tmc, min(distance_to_tmc_ft) AS nearest, max(node_pair_tmc_rank) AS worst_rank FROM mp GROUP BY link_id""")
def link_collapse(spark, d):
    return mapping(spark, d).groupBy("link_id").agg(F.array_join(F.array_sort(F.collect_set("tmc")), ";").alias("tmc_codes"), F.countDistinct("tmc").alias("n_tmc"), F.min("distance_to_tmc_ft").alias("nearest"), F.max("node_pair_tmc_rank").alias("worst_rank"))


@query(f"""WITH {_MAP}, {_M}, a AS (SELECT DISTINCT tmc FROM mp) SELECT road, round(sum(miles), 6) AS miles, round(sum(miles) FILTER (a.tmc IS NOT NULL), 6) AS mapped, round(coalesce(sum(miles) FILTER (a.tmc IS NOT NULL), 0) / sum(miles), 8) AS share,
coalesce(sum(miles) FILTER (a.tmc IS NOT NULL), 0) / sum(miles) >= 0.8 AS eligible FROM meta LEFT JOIN a ON meta.tmc = a.tmc WHERE place = 1 AND road IS NOT NULL AND miles > 0 GROUP BY road""")
def length_coverage(spark, d):
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and miles > 0")
    a = mapping(spark, d).select("tmc", F.lit(True).alias("m")).distinct()
    out = meta.join(a, "tmc", "left").groupBy("road").agg(F.sum("miles").alias("miles"), F.sum(F.when(F.col("m"), F.col("miles"))).alias("mapped"))
    share = F.coalesce("mapped", F.lit(0.0)) / F.col("miles")
    return rounded(out.withColumn("share", share).withColumn("eligible", share >= 0.8))


@query("""SELECT upper(trim(tmc_code, ' \t\r\n')) AS tmc, fd_source, count(*) AS n, round(median(free_flow_speed_model_mph), 8) AS vf, round(quantile_cont(observed_speed_p99_mph, 0.99), 8) AS p99, round(max(abs(observed_speed_p99_mph - observed_speed_p95_mph) / greatest(abs(observed_speed_p99_mph), 1)), 8) AS spread
FROM stage0_outputs WHERE tmc_code IS NOT NULL GROUP BY ALL""")
def stage0_table(spark, d):
    a, b = F.col("observed_speed_p99_mph"), F.col("observed_speed_p95_mph")
    out = table(spark, d, "stage0_outputs").where("tmc_code is not null").groupBy(code("tmc_code").alias("tmc"), "fd_source").agg(
        F.count("*").alias("n"), F.median("free_flow_speed_model_mph").alias("vf"), F.percentile(a, F.lit(0.99)).alias("p99"), F.max(F.abs(a - b) / F.when(a.isNotNull(), F.greatest(F.abs(a), F.lit(1.0)))).alias("spread"),
    )
    return rounded(out)


@query("""SELECT link_id, period, round(coalesce(median(CASE WHEN p_hr > 0 THEN least(p_hr / 4, 1) END), 0.25), 8) AS qdf, count(p_hr) AS n, round(1 / (coalesce(median(CASE WHEN p_hr > 0 THEN least(p_hr / 4, 1) END), 0.25) * 4), 8) AS plf FROM link_t2 WHERE link_id IS NOT NULL GROUP BY link_id, period""")
def plf_override(spark, d):
    """Median share of demand inside the congestion per link and period; without congestion 1 / hours (four-hour window)."""
    q = F.coalesce(F.median(F.when(F.col("p_hr") > 0, F.least(F.col("p_hr") / 4, F.lit(1.0)))), F.lit(0.25))
    out = table(spark, d, "link_t2").where("link_id is not null").groupBy("link_id", "period").agg(q.alias("qdf"), F.count("p_hr").alias("n"))
    return rounded(out.withColumn("plf", physics.plf(F.col("qdf"), F.lit(4.0))))


@query("""WITH x AS (SELECT link_id, nullif(regexp_replace(trim(link_type), '\\.0+$', ''), '') AS t FROM link) SELECT link_id, count(*) AS versions, count(t) AS present, min(t) AS link_type, count(DISTINCT t) > 1 AS conflict FROM x GROUP BY link_id""")
def link_type_consensus(spark, d):
    t = text.normal_code(F.col("link_type"))
    return table(spark, d, "link").groupBy("link_id").agg(F.count("*").alias("versions"), F.count(t).alias("present"), F.min(t).alias("link_type"), (F.countDistinct(t) > 1).alias("conflict"))


@query("""WITH m AS (SELECT tmc, period, t2_source_method AS s, count(*) AS n FROM link_t2 WHERE tmc IS NOT NULL AND t2_source_method IS NOT NULL GROUP BY ALL), k AS (SELECT tmc, period, arg_max(s, (n, 0)) AS ignored, min(s) FILTER (n = mx) AS method FROM (SELECT *, max(n) OVER (PARTITION BY tmc, period) AS mx FROM m) GROUP BY tmc, period)
SELECT upper(trim(x.tmc)) AS tmc, x.period, round(median(t2_hour), 8) AS t2, round(stddev_samp(p_hr), 8) AS sd_p, any_value(method) AS method, count(*) AS n FROM link_t2 x LEFT JOIN k ON x.tmc = k.tmc AND x.period = k.period WHERE x.tmc IS NOT NULL AND x.tmc = upper(trim(x.tmc)) GROUP BY x.tmc, x.period""")
def sensor_period_statistics(spark, d):
    """Median of numbers, mode of texts (smallest on ties), sample deviation."""
    rows = table(spark, d, "link_t2").where("tmc is not null and tmc = upper(trim(tmc))")
    out = rows.groupBy("tmc", "period").agg(F.median("t2_hour").alias("t2"), F.stddev_samp("p_hr").alias("sd_p"), F.mode("t2_source_method", True).alias("method"), F.count("*").alias("n"))
    return out.select("tmc", "period", r("t2").alias("t2"), r("sd_p").alias("sd_p"), "method", "n")


@query("""SELECT period, t2_source_method AS method, grouping(period) * 2 + grouping(t2_source_method) AS level, count(*) AS n, count(t2_hour) AS n_t2, round(count(t2_hour) / count(*), 8) AS share FROM link_t2 GROUP BY GROUPING SETS ((period, t2_source_method), (period), ())""")
def coverage_summary(spark, d):
    rows = table(spark, d, "link_t2").withColumnRenamed("t2_source_method", "method")
    return rounded(rows.groupingSets([["period", "method"], ["period"], []], "period", "method").agg((F.grouping("period") * 2 + F.grouping("method")).cast("bigint").alias("level"), F.count("*").alias("n"), F.count("t2_hour").alias("n_t2"), (F.count("t2_hour") / F.count("*")).alias("share")))


@query(None)
def table_fingerprint(spark, d):
    return ranking.fingerprint(table(spark, d, "link"))


@query(f"""WITH {_J} SELECT period, link_type, count(*) AS n, round(corr(volume, doc), 8) AS r, round(100 * avg((speed_mph <= 0.7 * free_speed)::INT), 8) AS congested_pct, round(64 * 1500 * avg(length) / 45 * 0.3 * pow(2, 1.2 - 4), 8) AS gamma FROM j WHERE volume IS NOT NULL AND doc IS NOT NULL GROUP BY period, link_type HAVING count(*) >= 20 AND NOT isnan(corr(volume, doc))""")
def congestion_tables(spark, d):
    rows = joined(spark, d).where("volume is not null and doc is not null").groupBy("period", "link_type").agg(
        F.count("*").alias("n"), F.corr("volume", "doc").alias("r"), (100 * F.avg((F.col("speed_mph") <= 0.7 * F.col("free_speed")).cast("double"))).alias("congested_pct"), F.avg("length").alias("len"),
    )
    g = physics.gamma(F.lit(1500.0), F.col("len"), F.lit(45.0), F.lit(0.3), F.lit(2.0), F.lit(1.2))
    return rows.where("n >= 20 and r is not null").select("period", "link_type", "n", r("r").alias("r"), r("congested_pct").alias("congested_pct"), r(g).alias("gamma"))


@query(f"""WITH {_J}, g AS (SELECT period, count(*) AS n, avg((volume IS NOT NULL)::INT) AS has_volume, avg((speed_mph IS NOT NULL)::INT) AS has_speed, avg((doc <= 8)::INT) AS doc_ok, count(DISTINCT link_id) = count(*) AS unique_ok FROM j GROUP BY period)
SELECT period, gate, value >= limit_ AS pass FROM (SELECT period, unnest(['has_volume', 'has_speed', 'doc_ok', 'unique_ok']) AS gate, unnest([has_volume, has_speed, doc_ok, unique_ok::INT]) AS value, unnest([0.8, 0.8, 0.99, 1.0]) AS limit_ FROM g)""")
def quality_gates(spark, d):
    g = joined(spark, d).groupBy("period").agg(
        F.avg(F.col("volume").isNotNull().cast("double")).alias("has_volume"), F.avg(F.col("speed_mph").isNotNull().cast("double")).alias("has_speed"), F.avg((F.col("doc") <= 8).cast("double")).alias("doc_ok"), (F.countDistinct("link_id") == F.count("*")).cast("double").alias("unique_ok"),
    )
    limits = {"has_volume": 0.8, "has_speed": 0.8, "doc_ok": 0.99, "unique_ok": 1.0}
    long = F.explode(F.array(*(F.struct(F.lit(k).alias("gate"), (F.col(k) >= v).alias("pass")) for k, v in limits.items())))
    return g.select("period", long.alias("x")).select("period", "x.gate", "x.pass")


@query(f"""WITH {_J}, g AS (SELECT district, avg((volume IS NOT NULL)::INT) >= 0.8 AS a, avg((speed_mph IS NOT NULL)::INT) >= 0.8 AS b, coalesce(max(doc) <= 8, false) AS c FROM j GROUP BY district) SELECT district, CAST(a::INT + b::INT + c::INT AS VARCHAR) || '/3' AS passed FROM g""")
def cross_corridor_summary(spark, d):
    g = joined(spark, d).groupBy("district").agg((F.avg(F.col("volume").isNotNull().cast("double")) >= 0.8).alias("a"), (F.avg(F.col("speed_mph").isNotNull().cast("double")) >= 0.8).alias("b"), F.coalesce(F.max("doc") <= 8, F.lit(False)).alias("c"))
    return g.select("district", F.concat((F.col("a").cast("int") + F.col("b").cast("int") + F.col("c").cast("int")).cast("string"), F.lit("/3")).alias("passed"))


# ---- sets and precedence --------------------------------------------------------------------------------------------


@query("SELECT DISTINCT from_node_id AS node_id FROM link WHERE from_node_id IS NOT NULL UNION SELECT to_node_id FROM link WHERE to_node_id IS NOT NULL")
def node_set(spark, d):
    k = table(spark, d, "link")
    return k.select(F.col("from_node_id").alias("node_id")).unionByName(k.select(F.col("to_node_id").alias("node_id"))).where("node_id is not null").distinct()


@query("SELECT link_id FROM link_t2 WHERE link_id IS NOT NULL INTERSECT SELECT link_id FROM tmc_mapping")
def links_in_both(spark, d):
    return table(spark, d, "link_t2").where("link_id is not null").select("link_id").intersect(table(spark, d, "tmc_mapping").select("link_id"))


@query("SELECT link_id FROM link_t2 WHERE link_id IS NOT NULL EXCEPT SELECT link_id FROM tmc_mapping")
def links_without_mapping(spark, d):
    return table(spark, d, "link_t2").where("link_id is not null").select("link_id").subtract(table(spark, d, "tmc_mapping").select("link_id"))


@query("SELECT link_id, 'even' AS side, count(*) AS n FROM link WHERE link_id % 2 = 0 GROUP BY link_id UNION ALL SELECT link_id, 'odd', count(*) FROM link WHERE link_id % 2 = 1 GROUP BY link_id")
def disjoint_union(spark, d):
    k = table(spark, d, "link").groupBy("link_id").agg(F.count("*").alias("n"))
    a, b = k.where("link_id % 2 = 0").withColumn("side", F.lit("even")), k.where("link_id % 2 = 1").withColumn("side", F.lit("odd"))
    return ranking.disjoint_union(a, b, ["link_id"]).select("link_id", "side", "n")


@query(f"""WITH {_J}, a AS (SELECT link_id, period, median(t2_hour) AS v FROM link_t2 WHERE t2_source_method = 'probe_days' AND t2_hour >= 0 AND link_id IS NOT NULL GROUP BY ALL), b AS (SELECT link_id, period, median(t2_hour) AS v FROM link_t2 WHERE t2_source_method = 'neighbour' AND t2_hour >= 0 AND link_id IS NOT NULL GROUP BY ALL),
m AS (SELECT link_type, t.period, avg(t2_hour) AS v FROM link_t2 t JOIN lk ON t.link_id = lk.link_id WHERE t2_hour >= 0 GROUP BY ALL), c AS (SELECT j.link_id, j.period, m.v FROM j JOIN m ON j.link_type = m.link_type AND j.period = m.period),
u AS (SELECT link_id, period, 0 AS i, 'direct' AS source, v FROM a UNION ALL SELECT link_id, period, 1, 'spatial', v FROM b UNION ALL SELECT link_id, period, 2, 'class', v FROM c WHERE v IS NOT NULL)
SELECT link_id, period, round(arg_min(v, i), 8) AS t2, arg_min(source, i) AS source FROM u GROUP BY link_id, period""")
def hybrid_precedence(spark, d):
    """Direct before spatial before class mean."""
    t = table(spark, d, "link_t2").where("t2_hour >= 0 and link_id is not null")
    one = lambda m: t.where(F.col("t2_source_method") == m).groupBy("link_id", "period").agg(F.median("t2_hour").alias("t2"))
    kinds = t.join(links(spark, d).select("link_id", "link_type"), "link_id").groupBy("link_type", "period").agg(F.avg("t2_hour").alias("t2"))
    by_class = joined(spark, d).select("link_id", "period", "link_type").join(kinds, ["link_type", "period"])
    out = ranking.precedence(["link_id", "period"], ("direct", one("probe_days")), ("spatial", one("neighbour")), ("class", by_class), field="t2")
    return out


@query(f"""WITH {_L}, k AS (SELECT unnest(['AM', 'MD', 'PM', 'NT']) AS period), t AS (SELECT lk.link_id, k.period, link_type, max(t2_hour) FILTER (t2_hour >= 0) AS own FROM lk CROSS JOIN k LEFT JOIN link_t2 x ON lk.link_id = x.link_id AND x.period = k.period GROUP BY ALL), m AS (SELECT link_type, period, avg(own) AS v FROM t WHERE own IS NOT NULL GROUP BY link_type, period)
SELECT link_id, t.period, round(coalesce(own, m.v), 8) AS t2, CASE WHEN own IS NOT NULL THEN 'carried_original' WHEN m.v IS NOT NULL THEN 'propagated' ELSE 'unmatched' END AS status FROM t LEFT JOIN m ON t.link_type = m.link_type AND t.period = m.period""")
def class_propagation(spark, d):
    """The same for each period: a link takes over the mean of its type in that period."""
    own = table(spark, d, "link_t2").where("t2_hour >= 0").groupBy("link_id", "period").agg(F.max("t2_hour").alias("own"))
    t = links(spark, d).select("link_id", "link_type", F.explode(F.array(*map(F.lit, PERIODS))).alias("period")).join(own, ["link_id", "period"], "left")
    m = t.where("own is not null").groupBy("link_type", "period").agg(F.avg("own").alias("v"))
    status = F.when(F.col("own").isNotNull(), "carried_original").when(F.col("v").isNotNull(), "propagated").otherwise("unmatched")
    return t.join(m, ["link_type", "period"], "left").select("link_id", "period", r(F.coalesce("own", "v")).alias("t2"), status.alias("status"))


@query(f"""WITH {_L}, {_REP}, pd AS (SELECT unnest(['AM', 'MD', 'PM', 'NT']) AS period), o AS (SELECT link_id, period, t0_hour AS t0, t2_hour AS t2, t3_hour AS t3, coalesce(p_hr > 0, false) AS congested FROM rep WHERE place = 1), q AS (SELECT link_id, median(t0_hour) AS t0, median(t2_hour) AS t2, median(t3_hour) AS t3 FROM link_t2 WHERE link_id IS NOT NULL GROUP BY link_id),
s AS (SELECT lk.link_id, pd.period, q.t0 AS a0, q.t2 AS a2, q.t3 AS a3, o.t0 AS b0, o.t2 AS b2, o.t3 AS b3, CASE WHEN congested AND o.t0 IS NOT NULL AND o.t2 IS NOT NULL AND o.t3 IS NOT NULL THEN 'observed' WHEN congested IS NOT NULL AND NOT congested THEN 'observed_no_congestion' WHEN q.t0 IS NOT NULL AND q.t2 IS NOT NULL AND q.t3 IS NOT NULL THEN 'lookup' ELSE 'none' END AS source
FROM lk, pd LEFT JOIN q ON lk.link_id = q.link_id LEFT JOIN o ON lk.link_id = o.link_id AND pd.period = o.period)
SELECT link_id, period, round(CASE source WHEN 'observed' THEN b0 WHEN 'lookup' THEN a0 END, 8) AS t0, round(CASE source WHEN 'observed' THEN b2 WHEN 'lookup' THEN a2 END, 8) AS t2, round(CASE source WHEN 'observed' THEN b3 WHEN 'lookup' THEN a3 END, 8) AS t3, source FROM s""")
def boundary_overlay(spark, d):
    """Every link's boundaries in every period: the observed ones, else the link's medians over all its episodes."""
    t = table(spark, d, "link_t2").where("link_id is not null")
    cols = [F.col(f"{c}_hour").alias(c) for c in ("t0", "t2", "t3")]
    observed = ranking.representative(t, ["link_id", "period"]).select("link_id", "period", *cols, F.coalesce(F.col("p_hr") > 0, F.lit(False)).alias("congested"))
    lookup = t.groupBy("link_id").agg(*(F.median(f"{c}_hour").alias(c) for c in ("t0", "t2", "t3")))
    every = F.explode(F.array(*map(F.lit, ("AM", "MD", "PM", "NT"))))
    lookup = lookup.withColumn("period", every)
    return rounded(performance.overlay_boundaries(links(spark, d).withColumn("period", every), lookup, observed, ["link_id", "period"]))


# ---- classes and links ----------------------------------------------------------------------------------------------


@query(f"""WITH {_L} SELECT link_id, link_type, CASE TRY_CAST(link_type AS INT) % 10 WHEN 0 THEN 'connector' WHEN 1 THEN 'freeway' WHEN 2 THEN 'arterial' WHEN 3 THEN 'collector' WHEN 4 THEN 'collector' ELSE CASE WHEN TRY_CAST(link_type AS INT) % 10 >= 5 THEN 'ramp' END END AS facility,
round(60 * length / free_speed, 8) AS fftt, CAST(floor(TRY_CAST(link_type AS INT) / 100) % 10 AS INT) AS area, round(capacity * CASE WHEN link_id % 3 = 0 AND link_id % 2 = 0 THEN 1.06 WHEN link_id % 2 = 0 THEN 1.05 WHEN link_id % 3 = 0 THEN 1.01 ELSE 1.0 END, 8) AS capacity
FROM lk WHERE from_node_id <> to_node_id AND lanes > 0 AND capacity > 0 AND free_speed > 0 AND length > 0""")
def link_construction(spark, d):
    nodes = node_set(spark, d)
    out = performance.build_links(links(spark, d), nodes)
    cap = physics.capacity_adjustment(F.col("capacity"), F.col("link_id") % 3 == 0, F.col("link_id") % 2 == 0)
    return out.select("link_id", "link_type", text.facility_class(F.col("link_type")).alias("facility"), r("fftt").alias("fftt"), "area", r(cap).alias("capacity"))


@query(f"""WITH {_J} SELECT perf_id, CASE WHEN volume IS NULL OR volume <= 0 THEN 'no_volume' WHEN doc <= 0.10 THEN 'low_loading' WHEN doc > 1 THEN 'over_capacity' ELSE 'normal' END AS status, coalesce(volume <= 0 OR doc <= 0.10, false) AS problem,
concat_ws(';', CASE WHEN doc < 0.5 THEN 'low_doc' END, CASE WHEN speed_mph > free_speed THEN 'above_free_speed' END, CASE WHEN volume = 0 THEN 'zero_volume' END) AS reasons FROM j""")
def link_diagnostics(spark, d):
    v, doc = F.col("volume"), F.col("doc")
    status = F.when(v.isNull() | (v <= 0), "no_volume").when(doc <= 0.10, "low_loading").when(doc > 1, "over_capacity").otherwise("normal")
    why = F.concat_ws(";", F.when(doc < 0.5, "low_doc"), F.when(F.col("speed_mph") > F.col("free_speed"), "above_free_speed"), F.when(v == 0, "zero_volume"))
    return joined(spark, d).select("perf_id", status.alias("status"), F.coalesce((v <= 0) | (doc <= 0.10), F.lit(False)).alias("problem"), why.alias("reasons"))


@query("""SELECT t2_id, CASE WHEN p_hr IS NULL OR min_speed_mph IS NULL THEN 'uncongested' WHEN p_hr * 60 < 30 OR min_speed_mph >= 45 THEN 'uncongested' WHEN p_hr * 60 >= 120 AND min_speed_mph < 22.5 THEN 'severe' WHEN p_hr * 60 >= 60 THEN 'recurring' ELSE 'mild' END AS regime FROM link_t2""")
def regime_classes(spark, d):
    from flowmark.operators.screen import regime

    return table(spark, d, "link_t2").select("t2_id", regime(F.col("p_hr") * 60, F.col("min_speed_mph"), F.lit(45.0)).alias("regime"))


@query(f"""WITH {_M} SELECT tmc, regexp_matches(road, '(?i)(HOV|EXPRESS|HOT|MANAGED)') AS managed, regexp_replace(upper(trim(road)), '[^A-Z0-9]+', '', 'g') || '_' || upper(trim(direction))[1] AS key,
CASE WHEN regexp_matches(road, '(?i)\\bpike\\b') THEN 'pike' ELSE 'other' END AS family FROM meta WHERE place = 1 AND road IS NOT NULL AND direction IS NOT NULL""")
def road_names(spark, d):
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and direction is not null")
    family = F.when(F.col("road").rlike(r"(?i)\bpike\b"), "pike").otherwise("other")
    return meta.select("tmc", text.is_managed(F.col("road")).alias("managed"), text.corridor_key(F.col("road"), F.col("direction")).alias("key"), family.alias("family"))


@query("""SELECT perf_id, nullif(regexp_replace(trim(link_id), '\\.0+$', ''), '') AS code, lower(trim(period)) IN ('true', '1', 'yes', 'y') AS flag FROM link_performance WHERE link_id IS NOT NULL AND period IS NOT NULL""")
def normal_codes(spark, d):
    return table(spark, d, "link_performance").where("link_id is not null and period is not null").select("perf_id", text.normal_code(F.col("link_id")).alias("code"), text.truth(F.col("period")).alias("flag"))


@query(None)
def match_scores(spark, d):
    """Composite score of sensor and link: geometry, road name (with sequence similarity), length; per node pair the best."""
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).select("tmc", "road", "direction", "miles")
    rows = mapping(spark, d).join(meta, "tmc").join(links(spark, d).select("link_id", "streetname", "length"), "link_id")
    names = rows.select("road", "streetname").distinct().withColumn("name_score", text.road_name_score(F.col("road"), F.col("streetname")))
    rows = rows.join(names, ["road", "streetname"], "left")
    score = physics.match_score({"geometry": physics.geometry_part(F.col("distance_to_tmc_ft")), "name": F.col("name_score"), "length": physics.length_part(F.col("miles"), F.col("length"))})
    rows = rows.withColumn("score", score)
    return rounded(ranking.pick_first(rows, ["from_node_id", "to_node_id", "period"], [F.col("score").desc_nulls_last(), F.col("distance_to_tmc_ft").asc_nulls_last(), F.col("map_id")]).select("from_node_id", "to_node_id", "period", "tmc", "map_id", "score"))


@query(f"""WITH {_M} SELECT tmc, round((degrees(atan2((end_longitude - start_longitude) * cos(radians((start_latitude + end_latitude) / 2)), end_latitude - start_latitude)) + 360) % 360, 8) AS bearing,
round(sqrt(pow((end_longitude - start_longitude) * 111320.0 * cos(radians(12.0)), 2) + pow((end_latitude - start_latitude) * 110540.0, 2)), 8) AS metres FROM meta WHERE place = 1 AND start_latitude IS NOT NULL AND end_latitude IS NOT NULL AND start_longitude IS NOT NULL AND end_longitude IS NOT NULL""")
def sensor_geometry(spark, d):
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("start_latitude is not null and end_latitude is not null and start_longitude is not null and end_longitude is not null")
    ax, ay = spatial.local_metres(F.col("start_latitude"), F.col("start_longitude"), 12.0, -40.0)
    bx, by = spatial.local_metres(F.col("end_latitude"), F.col("end_longitude"), 12.0, -40.0)
    b = physics.bearing(F.col("start_latitude"), F.col("start_longitude"), F.col("end_latitude"), F.col("end_longitude"))
    return meta.select("tmc", r(b).alias("bearing"), r(F.sqrt(F.pow(bx - ax, 2) + F.pow(by - ay, 2))).alias("metres"))


_GEO = f"""{_M}, g AS (SELECT tmc, (start_longitude + 40) * 111320.0 * cos(radians(12.0)) AS ax, (start_latitude - 12) * 110540.0 AS ay, (end_longitude + 40) * 111320.0 * cos(radians(12.0)) AS bx, (end_latitude - 12) * 110540.0 AS byy FROM meta
WHERE place = 1 AND start_latitude IS NOT NULL AND end_latitude IS NOT NULL AND start_longitude IS NOT NULL AND end_longitude IS NOT NULL)"""


@query(f"""WITH {_GEO}, q AS (SELECT p.tmc AS pid, s.tmc AS sid, p.ax AS x, p.ay AS y, s.ax, s.ay, s.bx, s.byy, least(greatest(coalesce(((p.ax - s.ax) * (s.bx - s.ax) + (p.ay - s.ay) * (s.byy - s.ay)) / nullif((s.bx - s.ax) ** 2 + (s.byy - s.ay) ** 2, 0), 0), 0), 1) AS t,
(degrees(atan2(p.bx - p.ax, p.byy - p.ay)) + 360) % 360 AS h1, (degrees(atan2(s.bx - s.ax, s.byy - s.ay)) + 360) % 360 AS h2 FROM g p, g s),
z AS (SELECT pid, sid, sqrt((x - ax - t * (bx - ax)) ** 2 + (y - ay - t * (byy - ay)) ** 2) AS dist, abs((((h1 - h2 + 180) % 360) + 360) % 360 - 180) AS ang FROM q)
SELECT pid, sid, round(dist, 8) AS distance, place FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY dist, sid) AS place FROM z WHERE dist <= 1500 AND ang <= 75) WHERE place <= 8""")
def proximity_join(spark, d):
    """Sensors' start points against sensors' segments within 1,500 m and 75 degrees, the nearest eight."""
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("start_latitude is not null and end_latitude is not null and start_longitude is not null and end_longitude is not null")
    ax, ay = spatial.local_metres(F.col("start_latitude"), F.col("start_longitude"), 12.0, -40.0)
    bx, by = spatial.local_metres(F.col("end_latitude"), F.col("end_longitude"), 12.0, -40.0)
    g = meta.select("tmc", ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))
    heading = F.pmod(F.degrees(F.atan2(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))) + 360, F.lit(360.0))
    points = g.select(F.col("tmc").alias("pid"), F.col("ax").alias("x"), F.col("ay").alias("y"), heading.alias("heading"))
    out = spatial.nearby_pairs(points, g.withColumnRenamed("tmc", "sid"), 1500.0)
    return out.select("pid", "sid", r("distance").alias("distance"), F.col("place").cast("bigint").alias("place"))


@query(f"""WITH {_J}, s AS (SELECT period, sum(volume) AS v, sum(vmt) AS vmt FROM j GROUP BY period), t AS (SELECT sum(volume) AS v FROM j) SELECT (SELECT sum(v) FROM s) IS NOT DISTINCT FROM t.v OR abs((SELECT sum(v) FROM s) - t.v) <= 1e-9 * abs(t.v) AS reconciled FROM t""")
def reconciliation(spark, d):
    j = joined(spark, d)
    s = j.groupBy("period").agg(F.sum("volume").alias("v")).agg(F.sum("v").alias("a"))
    return s.join(j.agg(F.sum("volume").alias("b"))).select((F.abs(F.col("a") - F.col("b")) <= 1e-9 * F.abs("b")).alias("reconciled"))


@query(f"""WITH {_P}, a AS (SELECT link_id, period, volume AS x FROM pf WHERE period = 'AM'), b AS (SELECT link_id, volume AS y FROM pf WHERE period = 'PM') SELECT count(*) AS n, round(sum(x * y) / sum(x * x), 8) AS slope, round(100 * (sum(x * y) / sum(x * x) - 1), 8) AS percent, round(avg(abs(x - y)), 8) AS mae FROM a JOIN b USING (link_id) WHERE x IS NOT NULL AND y IS NOT NULL""")
def volume_origin_fit(spark, d):
    p = performance_rows(spark, d)
    j = p.where("period = 'AM'").select("link_id", F.col("volume").alias("x")).join(p.where("period = 'PM'").select("link_id", F.col("volume").alias("y")), "link_id").where("x is not null and y is not null")
    out = j.agg(*islands.origin_fit(F.col("x"), F.col("y")))
    return out.select("n", r("slope").alias("slope"), r("percent").alias("percent"), r("mae").alias("mae"))


@query(f"""WITH {_P} SELECT perf_id, round(ln(greatest(speed_mph, 0.0001)), 8) AS log_speed, round(ln(greatest(least(doc / 2, 0.9999), 0.0001) / (1 - greatest(least(doc / 2, 0.9999), 0.0001))), 8) AS logit_doc FROM pf WHERE speed_mph IS NOT NULL AND doc IS NOT NULL""")
def target_transform(spark, d):
    x = F.greatest(F.least(F.col("doc") / 2, F.lit(0.9999)), F.lit(0.0001))
    return rounded(performance_rows(spark, d).where("speed_mph is not null and doc is not null").select("perf_id", F.log(F.greatest("speed_mph", F.lit(0.0001))).alias("log_speed"), F.log(x / (1 - x)).alias("logit_doc")))


@query("SELECT link_type, row_number() OVER (ORDER BY TRY_CAST(link_type AS DOUBLE) IS NULL, TRY_CAST(link_type AS DOUBLE), link_type) AS place FROM (SELECT DISTINCT link_type FROM link WHERE link_type IS NOT NULL)")
def natural_code_order(spark, d):
    k = table(spark, d, "link").where("link_type is not null").select("link_type").distinct()  # codes: a few
    return k.withColumn("place", F.row_number().over(Window.orderBy(*ranking.natural_order(F.col("link_type")))).cast("bigint"))


_ = (_PERIOD, clock)
