"""Queries of classifications, audits, accounting and further lookups, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.functions import clock, physics
from flowmark.operators import classes, performance, profiles, ranking
from flowmark.plans.measurement import _F, _M, _PERIOD, _S, _W, registry, slots, thresholds
from flowmark.plans.relational import _H, _J, _L, _MAP, _REP, joined, links, mapping
from flowmark.session import table

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


@query(f"""WITH {_MAP} SELECT map_id, CASE WHEN node_pair_tmc_rank IS NULL THEN 'no_path' WHEN distance_to_tmc_ft > 3200 THEN 'review_od_distance' WHEN distance_to_tmc_ft > 900 THEN 'review_geometry' WHEN node_pair_tmc_rank > 4 THEN 'review_direction'
WHEN match_confidence = 'high' THEN 'matched' ELSE 'review_low_confidence' END AS status FROM mp""")
def match_status(spark: SparkSession, d: str) -> DataFrame:
    none, no = F.lit(None).cast("double"), F.lit(0)
    m = mapping(spark, d)
    dist, rank = F.col("distance_to_tmc_ft"), F.col("node_pair_tmc_rank")
    status = classes.match_status(
        {
            "links": F.when(rank.isNull(), 0).otherwise(1), "repeated": no, "class_switches": no, "transition": F.lit("connected"), "start_ft": dist, "end_ft": dist, "length_ratio": F.lit(1.0), "mean_offset_ft": dist, "most_offset_ft": none,
            "bearing": F.when(rank > 4, 60.0).otherwise(10.0), "margin": none, "confidence": F.when(F.col("match_confidence") == "high", 80.0).otherwise(40.0),
        }
    )
    return m.select("map_id", status.alias("status"))


@query(f"""WITH {_J}, s AS (SELECT link_id, period, median(p_hr) * 1000 AS syn, count(*) AS n FROM link_t2 WHERE link_id IS NOT NULL GROUP BY ALL)
SELECT perf_id, CASE WHEN volume > 5e4 THEN 'calculation_mismatch' WHEN coalesce(n, 0) = 1 THEN 'mapmatching_review' WHEN coalesce(volume, 0) <= 0 AND coalesce(syn, 0) > 0 THEN 'assignment_zero_despite_observed_demand'
WHEN coalesce(doc <= 0.10, false) AND coalesce(syn, 0) > 0 AND volume / nullif(CASE WHEN syn > 0 THEN syn END, 0) < 0.25 THEN 'assignment_underloaded_vs_observed' WHEN coalesce(doc <= 0.10, false) THEN 'plausible_low_assignment_loading' ELSE 'no_primary_issue' END AS cause
FROM j LEFT JOIN s ON j.link_id = s.link_id AND j.period = s.period""")
def likely_causes(spark, d):
    s = table(spark, d, "link_t2").where("link_id is not null").groupBy("link_id", "period").agg((F.median("p_hr") * 1000).alias("syn"), F.count("*").alias("n"))
    j = joined(spark, d).join(s, ["link_id", "period"], "left")
    cause = classes.likely_cause(F.col("volume"), F.col("doc"), F.col("syn"), ~F.coalesce(F.col("volume") > 5e4, F.lit(False)), F.coalesce(F.col("n") == 1, F.lit(False)))
    return j.select("perf_id", cause.alias("cause"))


@query(f"""WITH {_J} SELECT perf_id, CASE WHEN speed_mph < 30 AND free_speed < 50 THEN concat_ws(';', CASE WHEN vht < 0.5 THEN 'short_p' END, CASE WHEN doc < 0.5 THEN 'low_doc' END, CASE WHEN volume = 0 THEN 'no_volume' END) ELSE '' END AS reasons FROM j""")
def low_boundary_selection(spark, d):
    none = F.lit(None).cast("double")
    cutoff = F.when(F.col("free_speed") < 50, 30.0).otherwise(-1.0)
    return joined(spark, d).select("perf_id", classes.low_boundary_reasons(F.col("speed_mph"), F.col("speed_mph"), cutoff, F.col("vht"), F.col("doc"), none, F.col("volume"), none).alias("reasons"))


@query(f"""WITH {_J} SELECT perf_id, volume AS vol, doc, problem_rank FROM (SELECT *, row_number() OVER (ORDER BY coalesce(volume, 0), doc NULLS LAST, perf_id) AS problem_rank FROM j WHERE volume <= 0 OR doc <= 0.10) WHERE problem_rank <= 100""")
def problem_links(spark, d):
    rows = joined(spark, d).where((F.col("volume") <= 0) | (F.col("doc") <= 0.10))
    top = rows.orderBy(F.coalesce("volume", F.lit(0.0)), F.col("doc").asc_nulls_last(), "perf_id").limit(100)  # a report of the worst 100
    w = Window.orderBy(F.coalesce("volume", F.lit(0.0)), F.col("doc").asc_nulls_last(), "perf_id")
    return top.select("perf_id", F.col("volume").alias("vol"), "doc", F.row_number().over(w).cast("bigint").alias("problem_rank"))


@query(f"""WITH {_L} SELECT link_id, abs(length * 1609.344 / 1609.344 - length) <= 1e-9 AND abs(60 * length / free_speed - 60 / free_speed * length) <= 1e-9 AS agrees FROM lk WHERE length > 0 AND free_speed > 0""")
def unit_contract(spark, d):
    length, v = F.col("length"), F.col("free_speed")
    ok = classes.units_agree(length, length * physics.MILE_M, v, v * physics.MPH_KPH, 60 / v * length)
    return links(spark, d).where("length > 0 and free_speed > 0").select("link_id", ok.alias("agrees"))


@query(f"""WITH {_J} SELECT perf_id, CASE WHEN abs(volume / nullif(lanes * {_H}, 0) / nullif(capacity, 0) - doc) <= 5e-3 THEN 'reconciled' WHEN abs(volume / nullif(lanes * {_H}, 0) / nullif(capacity, 0) - doc) IS NOT NULL THEN 'mismatch' ELSE 'unknown' END AS status FROM j""")
def kernel_reconciliation(spark, d):
    lanes, h = F.col("lanes").cast("double"), clock.period_hours(F.col("period"))
    demand = physics.div(F.col("volume"), lanes * h)
    return joined(spark, d).select("perf_id", classes.kernel_agrees(F.col("volume"), lanes, h, F.lit(1.0), demand, F.col("capacity"), F.col("doc")).alias("status"))


@query(f"""WITH {_J} SELECT perf_id, coalesce(lanes = 2 OR TRY_CAST(link_type AS INT) % 10 IN (2, 3), false) AS hov, coalesce(from_node_id % 5000 > 1404 AND from_node_id % 5000 < 2820 AND TRY_CAST(link_type AS INT) % 10 > 0, false) AS regional FROM j""")
def link_flags(spark, d):
    fac = performance.facility_digit(F.col("link_type"))
    return joined(spark, d).select("perf_id", classes.is_hov(F.col("lanes"), fac).alias("hov"), classes.in_region(F.col("from_node_id") % 5000, fac).alias("regional"))


@query(f"""WITH {_J}, s AS (SELECT period, district, volume * 0.6 AS sov, volume * 0.2 AS hov2, volume * 0.1 AS hov3, volume * 0.04 AS com, volume * 0.05 AS trk, volume * 0.01 AS apv FROM j)
SELECT period, district, round(sum(coalesce(sov, 0) * 1.0 + coalesce(hov2, 0) * 2.0 + coalesce(hov3, 0) * 3.5 + coalesce(com, 0) * 1.0 + coalesce(trk, 0) * 1.0 + coalesce(apv, 0) * 1.6), 6) AS total, round(sum(trk) / nullif(sum(sov + hov2 + hov3 + com + trk + apv), 0), 8) AS truck_share FROM s GROUP BY ALL""")
def trips_by_occupancy(spark, d):
    share = {"sov": 0.6, "hov2": 0.2, "hov3": 0.1, "com": 0.04, "trk": 0.05, "apv": 0.01}
    j = joined(spark, d).select("period", "district", *((F.col("volume") * v).alias(k) for k, v in share.items()))
    all_ = sum((F.col(k) for k in list(share)[1:]), F.col("sov"))
    return j.groupBy("period", "district").agg(F.sum(performance.persons({k: F.col(k) for k in share})).alias("total"), physics.div(F.sum("trk"), F.sum(all_)).alias("truck_share"))


@query(f"""WITH {_J} SELECT perf_id, round(volume / nullif(lanes, 0), 8) AS per_lane, round(volume / nullif(capacity * {_H}, 0), 8) AS dc, round(speed_ratio, 8) AS speed_ratio, round(t / nullif(f, 0) - 1, 8) AS delay_index FROM j""")
def demand_features(spark, d):
    j = joined(spark, d)
    t, f = physics.div(F.col("length"), F.col("speed_mph")), physics.div(F.col("length"), F.col("free_speed"))
    return j.select("perf_id", physics.div(F.col("volume"), F.col("lanes").cast("double")).alias("per_lane"), physics.div(F.col("volume"), F.col("capacity") * clock.period_hours(F.col("period"))).alias("dc"), "speed_ratio", (physics.div(t, f) - 1).alias("delay_index"))


# ---- durations and accounting ---------------------------------------------------------------------------------------

_AUD = f"""{_F}, {_REP}, o AS (SELECT tmc_code, period, count(*) FILTER (speed <= thr) / 4 AS observed_h, count(*) FILTER (speed <= 45) / 4 AS fixed_h FROM k GROUP BY ALL),
e AS (SELECT upper(trim(tmc)) AS tmc_code, period, count(*) AS n, sum(p_hr) AS p_h, max(p_hr) AS longest FROM rep WHERE place = 1 AND p_hr >= 0 AND tmc IS NOT NULL GROUP BY ALL),
a AS (SELECT o.*, n, p_h, longest, p_h - observed_h AS delta FROM o LEFT JOIN e USING (tmc_code, period))"""


def duration_rows(spark, d) -> DataFrame:
    o = thresholds(spark, d).groupBy("tmc_code", "period").agg((F.count_if(F.col("speed") <= F.col("thr")) / 4).alias("observed_h"), (F.count_if(F.col("speed") <= 45) / 4).alias("fixed_h"))
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("p_hr >= 0 and tmc is not null")
    e = e.groupBy(F.upper(F.trim("tmc")).alias("tmc_code"), "period").agg(F.count("*").alias("n"), F.sum("p_hr").alias("p_h"), F.max("p_hr").alias("longest"))
    return o.join(e, ["tmc_code", "period"], "left").withColumn("delta", F.col("p_h") - F.col("observed_h"))


@query(f"WITH {_AUD} SELECT tmc_code, period, observed_h, fixed_h, n, round(p_h, 8) AS p_h, round(longest, 8) AS longest, round(delta, 8) AS delta FROM a")
def duration_audit(spark, d):
    return duration_rows(spark, d)


@query(f"WITH {_AUD} SELECT period, count(*) AS rows, round(avg(delta), 8) AS mean, round(median(delta), 8) AS median, round(max(abs(delta)), 8) AS most, round(avg((abs(delta) <= 0.25)::INT), 8) AS close_share FROM a GROUP BY period")
def duration_summary(spark, d):
    x = F.col("delta")
    return duration_rows(spark, d).groupBy("period").agg(F.count("*").alias("rows"), F.avg(x).alias("mean"), F.median(x).alias("median"), F.max(F.abs(x)).alias("most"), F.avg((F.abs(x) <= 0.25).cast("double")).alias("close_share"))


@query(f"""WITH {_W}, v AS (SELECT tmc_code, least(greatest(quantile_cont(speed, 0.85), 35), 85) AS vf FROM s GROUP BY tmc_code), {_M}, b AS (SELECT p.tmc_code, {_PERIOD.format(m='t_min')} AS period, speed, vf, miles, greatest(speed, 1) AS sp FROM p JOIN v USING (tmc_code) JOIN mem USING (tmc_code))
SELECT period, round(sum(miles * 250), 6) AS vmt, round(sum(miles / sp * 250), 6) AS vht, round(sum(miles / vf * 250), 8) AS ffvht, round(sum(greatest(miles / sp - miles / vf, 0) * 250), 8) AS delay, round(sum(CASE WHEN speed < 0.7 * vf THEN greatest(miles / sp - miles / (0.7 * vf), 0) ELSE 0 END * 250), 8) AS congested_delay,
round(sum(least(greatest(0.080 - 0.0022 * least(greatest(speed, 3), 80) + 0.0000235 * least(greatest(speed, 3), 80) ** 2, 0.02), 0.20) * 8887 * miles * 250) / 1e6, 8) AS co2_tons FROM b GROUP BY period""")
def corridor_accounting(spark, d):
    """Vehicle miles, hours, free hours, delay, congested delay and CO2 of 1,000 vehicles an hour over the average weekday."""
    s = slots(spark, d)
    from flowmark.plans.measurement import members

    b = profiles.weekday_profile(s).join(profiles.free_flow(s), "tmc_code").join(members(spark, d), "tmc_code").withColumn("period", clock.period_of(F.col("t_min")))
    v, m, vf = F.greatest("speed", F.lit(1.0)), F.col("miles"), F.col("free_speed")
    slow = F.when(F.col("speed") < 0.7 * vf, F.greatest(m / v - m / (0.7 * vf), F.lit(0.0))).otherwise(0.0)
    return b.groupBy("period").agg(
        F.sum(m * 250).alias("vmt"), F.sum(m / v * 250).alias("vht"), F.sum(m / vf * 250).alias("ffvht"), F.sum(F.greatest(m / v - m / vf, F.lit(0.0)) * 250).alias("delay"), F.sum(slow * 250).alias("congested_delay"),
        (F.sum(physics.co2_grams_per_mile(F.col("speed")) * m * 250) / 1e6).alias("co2_tons"),
    )


@query(f"""WITH {_S}, x AS (SELECT tmc_code, speed * 30 AS q, 30.0 AS k, speed AS v, n FROM s), y AS (SELECT tmc_code, abs(q - k * v) / greatest(abs(q), 1) AS e FROM x) SELECT tmc_code, round(median(e), 8) AS median, round(quantile_cont(e, 0.95), 8) AS p95, round(avg((e <= 0.01)::INT), 8) AS within FROM y GROUP BY tmc_code""")
def flow_identity_audit(spark, d):
    """Relative error of flow against density times speed."""
    q = F.col("speed") * 30
    e = F.abs(q - F.lit(30.0) * F.col("speed")) / F.greatest(F.abs(q), F.lit(1.0))
    return slots(spark, d).select("tmc_code", e.alias("e")).groupBy("tmc_code").agg(F.median("e").alias("median"), F.percentile("e", F.lit(0.95)).alias("p95"), F.avg((F.col("e") <= 0.01).cast("double")).alias("within"))


@query(f"""WITH {_J}, p AS (SELECT link_id, any_value(speed_mph) FILTER (period = 'AM') AS am, any_value(speed_mph) FILTER (period = 'MD') AS md, any_value(speed_mph) FILTER (period = 'PM') AS pm FROM j GROUP BY link_id)
SELECT link_id, round(am, 8) AS am_start, round(CASE WHEN am IS NULL THEN md WHEN md IS NULL THEN am ELSE (am + md) / 2 END, 8) AS am_md, round(CASE WHEN md IS NULL THEN pm WHEN pm IS NULL THEN md ELSE (md + pm) / 2 END, 8) AS md_pm, round(pm, 8) AS pm_end FROM p""")
def assignment_boundary_speeds(spark, d):
    p = joined(spark, d).groupBy("link_id").pivot("period", ["AM", "MD", "PM"]).agg(F.first("speed_mph", True))
    mean = lambda a, b: F.coalesce((F.col(a) + F.col(b)) / 2, F.col(a), F.col(b))
    return p.select("link_id", F.col("AM").alias("am_start"), mean("AM", "MD").alias("am_md"), mean("MD", "PM").alias("md_pm"), F.col("PM").alias("pm_end"))


@query(f"""WITH {_W}, {_MAP}, b AS (SELECT link_id, count(DISTINCT tmc) AS n_tmc, string_agg(DISTINCT tmc, ';' ORDER BY tmc) AS codes FROM mp GROUP BY link_id), f AS (SELECT link_id, t_min, median(speed * 30) AS q FROM (SELECT DISTINCT link_id, tmc FROM mp) x JOIN p ON x.tmc = p.tmc_code GROUP BY link_id, t_min),
a AS (SELECT link_id, {_PERIOD.format(m='t_min')} AS period, sum(q) / 4 AS total, count(*) AS bins FROM f GROUP BY ALL)
SELECT a.link_id, period, round(total, 6) AS total, round(bins / CASE period WHEN 'AM' THEN 12 WHEN 'MD' THEN 24 WHEN 'PM' THEN 16 ELSE 44 END, 8) AS coverage, n_tmc, codes FROM a JOIN b USING (link_id)""")
def observed_link_volume(spark, d):
    """Median flow of a link's sensors per quarter hour, summed per period, with the share of bins seen."""
    m = mapping(spark, d).select("link_id", "tmc").distinct()
    b = m.groupBy("link_id").agg(F.countDistinct("tmc").alias("n_tmc"), F.array_join(F.array_sort(F.collect_set("tmc")), ";").alias("codes"))
    f = m.join(profiles.weekday_profile(slots(spark, d)).withColumnRenamed("tmc_code", "tmc"), "tmc").groupBy("link_id", "t_min").agg(F.median(F.col("speed") * 30).alias("q"))
    a = f.groupBy("link_id", clock.period_of(F.col("t_min")).alias("period")).agg((F.sum("q") / 4).alias("total"), F.count("*").alias("bins"))
    return a.join(b, "link_id").select("link_id", "period", "total", (F.col("bins") / (clock.period_hours(F.col("period")) * 4)).alias("coverage"), "n_tmc", "codes")


@query(f"""WITH {_MAP}, w AS (SELECT *, row_number() OVER (PARTITION BY tmc, period ORDER BY (link_id IN (SELECT link_id FROM link_t2)) DESC, node_pair_tmc_rank ASC NULLS LAST, distance_to_tmc_ft ASC NULLS LAST, map_id) AS k FROM mp) SELECT tmc, period, map_id, link_id FROM w WHERE k = 1""")
def projection_candidate(spark, d):
    known = table(spark, d, "link_t2").where("link_id is not null").select("link_id", F.lit(True).alias("known")).distinct()
    m = mapping(spark, d).join(known, "link_id", "left")
    order = [F.coalesce("known", F.lit(False)).desc(), F.col("node_pair_tmc_rank").asc_nulls_last(), F.col("distance_to_tmc_ft").asc_nulls_last(), F.col("map_id")]
    return ranking.pick_first(m, ["tmc", "period"], order).select("tmc", "period", "map_id", "link_id")


@query(f"""WITH {_M}, {_MAP}, u AS (SELECT link_id, period, road, map_id FROM mp JOIN meta ON mp.tmc = meta.tmc WHERE place = 1 AND road IS NOT NULL), f AS (SELECT *, row_number() OVER (PARTITION BY link_id, period ORDER BY map_id) AS k FROM u)
SELECT link_id, period, count(*) AS rows, count(DISTINCT road) AS n_roads, string_agg(DISTINCT road, '|' ORDER BY road) AS roads, min(map_id) FILTER (k = 1) AS first_id FROM f GROUP BY link_id, period""")
def unique_link_periods(spark, d):
    """Rows made unique per link and period, with all roads they came from and the first row's id."""
    meta = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null").select("tmc", "road")
    u = mapping(spark, d).join(meta, "tmc")
    return u.groupBy("link_id", "period").agg(F.count("*").alias("rows"), F.countDistinct("road").alias("n_roads"), F.array_join(F.array_sort(F.collect_set("road")), "|").alias("roads"), F.min("map_id").alias("first_id"))


@query(f"""WITH {_L}, x AS (SELECT link_type, lanes, free_speed FROM lk WHERE link_type IS NOT NULL AND free_speed IS NOT NULL AND lanes IS NOT NULL), g AS (SELECT link_type, sum(free_speed) AS s, count(*) AS n FROM x GROUP BY link_type)
SELECT link_id, round((s - free_speed) / nullif(n - 1, 0), 8) AS others_mean FROM lk JOIN g USING (link_type) WHERE free_speed IS NOT NULL AND lanes IS NOT NULL""")
def leave_one_out_prior(spark, d):
    """Class mean of the other links of a type: the class's sum less the link's own value."""
    x = links(spark, d).where("link_type is not null and free_speed is not null and lanes is not null")
    w = Window.partitionBy("link_type")
    return x.select("link_id", ((F.sum("free_speed").over(w) - F.col("free_speed")) / F.nullif(F.count("*").over(w) - 1, F.lit(0))).alias("others_mean"))


@query(f"""WITH {_F}, c AS (SELECT tmc_code, period, count(*) AS bins, count(*) FILTER (speed > 0 AND speed <= 150) AS good, count(DISTINCT t_min) AS times FROM k GROUP BY ALL) SELECT tmc_code, period, bins = times AS unique_times, bins = good AS plausible, bins = CASE period WHEN 'AM' THEN 12 WHEN 'MD' THEN 24 WHEN 'PM' THEN 16 ELSE 44 END AS complete FROM c""")
def result_validation(spark, d):
    c = thresholds(spark, d).groupBy("tmc_code", "period").agg(F.count("*").alias("bins"), F.count_if((F.col("speed") > 0) & (F.col("speed") <= 150)).alias("good"), F.countDistinct("t_min").alias("times"))
    return c.select("tmc_code", "period", (F.col("bins") == F.col("times")).alias("unique_times"), (F.col("bins") == F.col("good")).alias("plausible"), (F.col("bins") == clock.period_hours(F.col("period")) * 4).alias("complete"))


@query(f"""WITH {_M}, {_MAP}, g AS (SELECT tmc, road, regexp_matches(road, '(?i)(HOV|EXPRESS|HOT|MANAGED)') AS managed FROM meta WHERE place = 1 AND road IS NOT NULL), l AS (SELECT link_id, bool_or(managed) AS any_managed, bool_and(NOT managed) AS general FROM mp JOIN g USING (tmc) GROUP BY link_id)
SELECT g.tmc, bool_and(general) AS general_purpose FROM g JOIN mp USING (tmc) JOIN l USING (link_id) GROUP BY g.tmc""")
def general_purpose_sensors(spark, d):
    """Whether all of a sensor's links are only ever matched by general-purpose roads."""
    from flowmark.functions import text

    g = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null").select("tmc", text.is_managed(F.col("road")).alias("managed"))
    m = mapping(spark, d).join(g, "tmc")
    per_link = m.groupBy("link_id").agg(F.bool_and(~F.col("managed")).alias("general"))
    return m.join(per_link, "link_id").groupBy("tmc").agg(F.bool_and("general").alias("general_purpose"))


@query("""SELECT o_orderpriority AS class, date_part('year', o_orderdate) AS year, grouping(o_orderpriority) * 2 + grouping(date_part('year', o_orderdate)) AS level, count(*) AS n, round(sum(o_totalprice), 2) AS price, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY GROUPING SETS ((o_orderpriority, date_part('year', o_orderdate)), (o_orderpriority), ())""")
def grouping_sets_on_orders(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("class"), F.year("o_orderdate").cast("bigint").alias("year"), "o_totalprice", "o_custkey")
    out = o.groupingSets([["class", "year"], ["class"], []], "class", "year").agg((F.grouping("class") * 2 + F.grouping("year")).cast("bigint").alias("level"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("price"), F.countDistinct("o_custkey").alias("customers"))
    return out


@query("""SELECT n_name AS nation, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted_price, count(DISTINCT l_orderkey) AS n_orders FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_shipdate >= TIMESTAMP '1995-01-01' GROUP BY n_name""")
def star_join_aggregate(spark, d):
    """Fact table with two small dimensions: filters reach the scan, the dimensions are broadcast by size."""
    li = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
    j = li.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    mean = profiles.weighted_mean(F.col("l_extendedprice"), F.col("l_quantity"))
    return j.groupBy(F.col("n_name").alias("nation")).agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(mean, 4).alias("weighted_price"), F.countDistinct("l_orderkey").alias("n_orders"))
