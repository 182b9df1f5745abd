"""Fixtures with closed-form expectations for the engine's operators."""

from __future__ import annotations

import math
import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from flowmark.functions import clock, physics, text
from flowmark.operators import calibrate, episodes, islands, ml, network, performance, profiles, qc, ranking, screen, spatial

RULES = episodes.Rules(step=15)
NAN = float("nan")


def one(spark, *cols):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first()


def test_grid_check_rejects_other_times(spark):
    t = datetime(2025, 1, 1)
    df = spark.createDataFrame([("TMC-1", t, 50.0), ("TMC-1", t + timedelta(minutes=5), 50.0)], "tmc_code string, ts timestamp_ntz, speed double")
    with pytest.raises(PySparkException, match="off the grid"):
        profiles.assert_grid(df).collect()
    assert profiles.assert_grid(df.limit(1)).count() == 1


def test_harmonic_and_accuracy(spark):
    df = spark.createDataFrame([(60.0, 1.0), (30.0, 1.0), (0.0, 5.0), (None, 1.0)], "v double, l double")
    assert df.agg(profiles.harmonic_speed(F.col("v"), F.col("l"))).first()[0] == pytest.approx(40)
    r = spark.createDataFrame([(50.0, 45.0), (40.0, 50.0), (None, 3.0)], "o double, m double").agg(*islands.accuracy(F.col("o"), F.col("m"))).first()
    assert (r["n"], r["mae"], r["mape"]) == (2, pytest.approx(7.5), pytest.approx(17.5))


def test_islands_split_at_gaps(spark):
    df = spark.createDataFrame([("a", t, True) for t in (360, 375, 405)], "k string, t int, f boolean")
    got = sorted((r["start"], r["end"], r["minutes"]) for r in islands.islands(df, ["k"], "t", F.col("f"), 15).collect())
    assert got == [(360, 390, 30), (405, 420, 15)]
    assert islands.islands(df, ["k"], "t", F.col("f"), 15, gap=1).count() == 1


def test_congestion_fit(spark):
    df = spark.createDataFrame([("a", i * 15, o, m) for i, (o, m) in enumerate([(False, False), (True, False), (True, True), (False, True)])], "k string, t int, o boolean, m boolean")
    r = islands.congestion_fit(df, ["k"], "t", F.col("o"), F.col("m"), 15).first()
    assert (r["observed_min"], r["model_min"], r["overlap_min"]) == (30, 30, 15) and r["iou"] == pytest.approx(1 / 3) and r["onset_error"] == 15


def test_threshold_and_origin_fit(spark):
    df = spark.createDataFrame([(40.0,), (55.0,), (None,)], "v double")
    assert df.agg(islands.threshold_minutes(F.col("v"), F.lit(50.0), 15)).first()[0] == 15
    r = spark.createDataFrame([(0.0, 0.0), (1.0, 2.0), (2.0, 4.0)], "x double, y double").agg(*islands.origin_fit(F.col("x"), F.col("y"))).first()
    assert (r["slope"], r["percent"], r["r2_origin"]) == (2, 100, 1)


def test_hampel_and_repair(spark):
    v = [50.0, 51.0, 50.0, 90.0, 50.0, None, 52.0, 50.0]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "k string, t int, v double")
    ok = [r["hampel_ok"] for r in qc.hampel(df, "k", "t", "v").orderBy("t").collect()]
    assert ok[3] is False and ok[0] is True and ok[5] is False
    fixed = {r["t"]: r for r in qc.repair_single_gaps(df, "k", "t", "v").collect()}
    assert fixed[5]["repaired"] == 51.0 and fixed[5]["was_repaired"]
    assert qc.savgol_weights(3, 2) == pytest.approx([0, 1, 0], abs=1e-12)


def test_periods_and_windows(spark):
    r = one(spark, clock.period_of(F.lit(360)), clock.period_of(F.lit(1140)), clock.period_of(F.lit(1799)), clock.period_of(F.lit(899)), clock.in_window(F.lit(1435), F.lit(1140), F.lit(360)), clock.in_window(F.lit(360), F.lit(1140), F.lit(360)), clock.clock_of_column(F.lit("spd_mph_07:35")), clock.window_text(F.lit("1900_0600"))["minutes"])
    assert list(r) == ["AM", "NT", "NT", "MD", True, False, 455, 660]
    w = one(spark, clock.period_window(F.lit(10), F.lit(100)))[0]
    assert (w["start_s"], w["end_s"]) == ((9 * 1440 + 1140) * 60, (9 * 1440 + 1800) * 60)


def test_inverse_s3_is_bounded(spark):
    cap, vf = F.lit(2000.0), F.lit(60.0)
    m = F.lit(2 * math.log(2) / math.log(60 / 42))
    r = one(spark, *(physics.inverse_s3_flow(F.lit(v), vf, F.lit(2000 / 42), m, cap) for v in (60.0, 42.0, 20.0)))
    assert r[1] == pytest.approx(2000) and all(0 <= x <= 2000 for x in r)


def test_link_queue_profile(spark):
    x = one(spark, episodes.queue_profile(F.lit(10800.0), F.lit(2.0), F.lit(3.0), F.lit(1.0), F.lit(1800.0), F.lit(45.0)), episodes.queue_profile(F.lit(0.0), F.lit(2.0), F.lit(3.0), F.lit(1.0), F.lit(1800.0), F.lit(45.0)))
    assert tuple(x[0]) == pytest.approx((1800, 1, 1, 45 / 1.28125)) and tuple(x[1]) == pytest.approx((0, 0, 0, 45))


def test_text_functions(spark):
    r = one(
        spark, text.normal_code(F.lit("301.0")), text.number_text(F.lit("1.500")), text.number_text(F.lit("abc")), text.id_list(F.lit("1;x; 3")), text.route_ids(F.lit("Interstate 66 / US-50 & SR 007")), text.road_tokens(F.lit("Lee Highway NB")),
        text.corridor_key(F.lit("I-66 East"), F.lit("Eastbound")), text.union_of_uses(F.lit("sov;hov2"), F.lit("closed;trk;sov")), text.is_open(F.lit("closed")), text.road_class(F.lit("Route 7")), text.base_road(F.lit("I-66 (Express)")),
    )
    assert list(r) == ["301", "1.5", "abc", [1, 3], ["I-66", "US-50", "VA-7"], ["LEE"], "I66EAST_EB", "sov;hov2;trk", False, 3.0, "I-66"]
    df = spark.createDataFrame([("I-66", "Interstate 66"), ("I-66", "US 50"), ("Lee Highway", "Lee Hwy"), ("Alpha Way", "Zulu Pass"), (None, "x"), ("NB", "x")], "a string, b string")
    got = [x[0] for x in df.select(text.road_name_score(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [1.0, 0.0, 1.0] and got[3] >= 0.5 and got[4:] == [None, None]


def arrays(v, pre=None):
    return np.array(v, float), np.array(pre if pre is not None else v, float)


def test_recovery_boundary_is_repaired():
    v, pre = arrays([55, 30, 35, 40, NAN, NAN, 50])
    got = episodes.repair_boundary(v, pre, 4, 1, 65, RULES, lambda x: x >= 45 and x >= 30, lambda x: x >= 30)
    assert got == (6, 50.0, "shifted_post_qc")
    v, pre = arrays([55, 30, 35, 40, NAN], [55, 30, 35, 40, 42])
    assert episodes.repair_boundary(v, pre, 4, 1, 65, RULES, lambda x: x >= 45, lambda x: x >= 30) == (4, 42.0, "pre_qc_fallback")
    pre[4] = 95
    assert episodes.repair_boundary(v, pre, 4, 1, 65, RULES, lambda x: x >= 45, lambda x: x >= 30)[2] == "missing"
    v, pre = arrays([55, 50, NAN, 30, 25, 35, 50])
    assert episodes.repair_boundary(v, pre, 2, -1, 65, RULES, lambda x: x >= 45, lambda x: True) == (1, 50.0, "shifted_post_qc")


def test_detector_finds_one_episode(spark):
    v = [60, 60, 58, 40, 30, 25, 30, 38, 50, 58, 60, 60]
    rows = [("a", 0, 360 + 15 * i, float(x), 60.0, 1000.0 + 10 * i, 2000.0) for i, x in enumerate(v)] + [("b", 0, 360 + 15 * i, 60.0, 60.0, None, None) for i in range(12)] + [(None, 0, 1, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "tmc_code string, day bigint, t_min int, speed double, vf double, flow double, capacity double")
    got = episodes.detect_episodes(df).collect()
    assert len(got) == 1
    e = got[0]
    assert e["t2_min"] == 435 and e["min_speed"] == 25 and e["limit"] == pytest.approx(42) and e["period"] == "AM"
    assert e["t0_min"] == 390 and e["valid_for_mu"] and e["mu"] == pytest.approx(1065) and e["discharge_min"] == 30
    assert episodes.detect_episodes(df.limit(0)).count() == 0


def test_demand_and_capacity():
    t = 360 + 15 * np.arange(4)
    v = np.array([40.0, 35, 30, 42])
    rows = episodes.detect_series("a", 0, t, v, v, np.full(4, 100.0), np.full(4, 1000.0), 65.0, RULES)
    assert len(rows) == 1 and rows[0]["capacity"] == 3000 and rows[0]["demand"] == 100 and rows[0]["doc"] == pytest.approx(1 / 30)


def test_bounds_merge():
    assert episodes.merge_bounds([(5, 6), (0, 2), (4, 4)], 1) == [(0, 6)]


def test_clipped_qdf(spark):
    flows = spark.createDataFrame([("a", 360 + 15 * i, 100.0) for i in range(16)], "key string, t_min int, flow double")
    e = spark.createDataFrame([("a", 1, 420.0, 480.0, 600.0)], "key string, id int, t0 double, t2 double, t3 double")
    r = episodes.clipped_qdf(e, flows).first()
    assert (r["episode_demand"], r["period_demand"], r["qdf"], r["plf"]) == (200, 300, pytest.approx(2 / 3), pytest.approx(0.5))


def test_overlap_selection(spark):
    rows = [(1, 7.0, 8.0, 9.0, 15.0), (2, 8.5, 9.0, 9.5, 25.0), (3, 10.0, 10.5, 11.0, 30.0), (4, 9.0, 9.2, 10.0, 40.0), (5, None, 1.0, 2.0, 1.0)]
    df = spark.createDataFrame([(i, "k", a, b, c, v, c - a if a else None) for i, a, b, c, v in rows], "id bigint, link string, t0 double, t2 double, t3 double, min_speed double, p_hr double")
    got = {r["id"]: r for r in episodes.select_without_overlap(df, ["link"]).collect()}
    assert {i for i, r in got.items() if r["selected"]} == {1, 3, 4} and got[2]["reason"] == "overlaps:1" and got[5]["reason"] == "invalid_bounds"


def test_power_law_is_recovered(spark):
    z = np.linspace(0.4, 2, 20)
    p = 0.8 * z**1.4
    v = 50 / (1 + 0.3 * p**1.2)
    df = spark.createDataFrame([("a", float(a), float(b), float(c), 50.0) for a, b, c in zip(z, p, v)], "g string, doc double, p_hr double, min_speed double, limit double")
    r = calibrate.fit_qvdf(df, ["g"]).first()
    assert r["n_exp"] == pytest.approx(1.4, abs=0.05) and r["s"] == pytest.approx(1.2, abs=0.05) and r["f_d"] == pytest.approx(0.8, abs=0.03) and r["reliability"] == "high"
    assert calibrate.fit_qvdf(df.limit(2), ["g"]).count() == 0


def test_huber_flags_an_outlier(spark):
    rows = [("a", float(i), 2.0 * i + (0.1 if i % 2 else -0.1)) for i in range(30)] + [("a", 15.5, 90.0), ("a", None, 1.0)]
    got = calibrate.huber_flags(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y", "bad").where("bad").collect()
    assert [r["y"] for r in got] == [90.0]


def test_screen_and_regime(spark):
    rows = [("a", 60.0, 0.5, 30.0, 1500.0, 2000.0, 42.0, True)] * 12 + [("a", 60.0, 9.0, 30.0, 1500.0, 2000.0, 42.0, True), ("a", 60.0, 0.5, 45.0, None, 2000.0, 42.0, False), ("a", 900.0, 0.4, 30.0, 1500.0, 2000.0, 42.0, True)]
    got = screen.screen(spark.createDataFrame(rows, "g string, minutes double, doc double, min_speed double, mu double, capacity double, limit double, ok boolean"), ["g"], F.col("ok")).collect()
    hard = {r["hard"] for r in got}
    assert "doc_above_physical" in hard and "vt2_above_threshold" in hard and sum(r["clean"] for r in got) >= 12
    r = one(spark, *(screen.regime(F.lit(m), F.lit(v), F.lit(42.0)) for m, v in ((20.0, 10.0), (130.0, 20.0), (70.0, 30.0), (40.0, 30.0), (40.0, 50.0))))
    assert list(r) == ["uncongested", "severe", "recurring", "mild", "uncongested"]


def test_flow_conservation_and_rate_limits(spark):
    df = spark.createDataFrame([([100.0, 500.0, 900.0],)], "q array<double>")
    x = df.select(episodes.conserve_flow(F.col("q"), F.lit(2000.0), F.lit(1000.0))).first()[0]
    assert sum(x) == pytest.approx(2000) and max(x) <= 1000
    p = spark.createDataFrame([(1, 5 * i, float(v)) for i, v in enumerate([60] * 10 + [20] * 20 + [60] * 40)], "key bigint, t_min bigint, speed double")
    s = episodes.limit_rates(p)
    m = episodes.constraint_metrics(s).first()
    assert m["most_change"] <= 8 + 1e-9 and m["most_mean_change"] <= 4 + 1e-9 and m["most_acceleration"] <= 576 + 1e-6
    assert s.orderBy(F.col("t_min").desc()).first()["speed"] == pytest.approx(60, abs=1)


def test_monotone_hermite():
    y = episodes.hermite(0, 10.0, 50.0, 10, 20.0, 0.0, np.linspace(0, 10, 50))
    assert (np.diff(y) >= -1e-9).all() and y[0] == 10 and y[-1] == pytest.approx(20)


def test_ranks_put_nulls_last(spark):
    rows = [("A", 10, 30.0, 1), ("B", 10, 10.0, 2), ("C", 11, None, 3), ("C", 12, None, 4)]
    df = spark.createDataFrame([(t, l, 1, 2, d, i) for t, l, d, i in rows], "tmc string, link_id int, from_node_id int, to_node_id int, distance_to_tmc_ft double, map_id int")
    got = {(r["tmc"], r["link_id"]): r for r in ranking.map_ranks(df).collect()}
    assert got["B", 10]["link_rank"] == 1 and [got["C", k]["tmc_rank"] for k in (11, 12)] == [1, 2]


def test_unique_and_disjoint_are_enforced(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(PySparkException, match="key occurs twice"):
        ranking.assert_unique(df, ["k"]).collect()
    with pytest.raises(PySparkException, match="meet"):
        ranking.disjoint_union(df, df.where("k = 2"), ["k"]).collect()
    assert ranking.disjoint_union(df.where("k = 1"), df.where("k = 2"), ["k"]).count() == 3


def test_period_to_day(spark):
    df = spark.createDataFrame([(1, "AM", 100.0, 10.0), (1, "MD", 200.0, 20.0), (2, "AM", None, None)], "link_id int, period string, volume double, speed_mph double").withColumn("vmt", F.lit(1.0)).withColumn("vht", F.lit(1.0))
    got = {r["link_id"]: r for r in performance.day_totals(df, ["link_id"]).collect()}
    assert got[1]["volume"] == 300 and got[1]["speed_mph"] == pytest.approx((10 * 3 + 20 * 6) / 9) and got[2]["volume"] is None


def test_overlay_precedence(spark):
    links = spark.createDataFrame([(1,), (2,), (3,), (4,)], "link_id int")
    lookup = spark.createDataFrame([(1, 6.0, 7.0, 8.0), (2, 6.0, 7.0, 8.0), (3, 6.0, None, 8.0)], "link_id int, t0 double, t2 double, t3 double")
    seen = spark.createDataFrame([(1, 6.5, 7.5, 8.5, True), (2, None, None, None, False)], "link_id int, t0 double, t2 double, t3 double, congested boolean")
    got = {r["link_id"]: (r["t2"], r["source"]) for r in performance.overlay_boundaries(links, lookup, seen).collect()}
    assert got == {1: (7.5, "observed"), 2: (None, "observed_no_congestion"), 3: (None, "none"), 4: (None, "none")}


def test_tiers_and_blend(spark):
    rows = [("c", 0.0, 10.0), ("c", 2.0, None), ("c", 4.0, 20.0), ("c", 8.5, None), ("c", 30.0, None)]
    got = {r["p"]: r for r in spatial.spatial_tiers(spark.createDataFrame(rows, "c string, p double, v double"), ["c"], "p", "v").collect()}
    assert (got[2.0]["tier"], got[2.0]["filled"]) == ("B", 15.0) and (got[8.5]["tier"], got[8.5]["filled"]) == ("C", 20.0) and got[30.0]["tier"] is None
    r = one(spark, spatial.profile_blend(F.lit(30.0), F.lit(50.0), F.lit(0.75), F.lit(40.0), F.lit(0.0), 1.0), spatial.profile_blend(F.lit(30.0), F.lit(30.0), F.lit(1.0), F.lit(60.0), F.lit(1.0), 1.0))
    assert r[0] == 35 and 30 < r[1] < 60


def test_paths_and_reach(spark):
    edges = [(1, 2, 1.0), (2, 3, 1.0), (1, 3, 3.0), (3, 4, 1.0), (2, 4, 2.5), (5, 1, 1.0)]
    df = spark.createDataFrame([("c", *e) for e in edges], "corridor string, from_node_id bigint, to_node_id bigint, cost double")
    src = spark.createDataFrame([(1,)], "node_id bigint")
    assert {r["node_id"]: r["hops"] for r in network.reachable(df, src).collect()} == {1: 0, 2: 1, 3: 1, 4: 2}
    assert {r["node_id"]: r["cost"] for r in network.shortest_costs(df, src, 2.5).collect()} == {1: 0, 2: 1, 3: 2}
    pairs = spark.createDataFrame([("c", 1, 4), ("c", 4, 1)], "corridor string, start_id bigint, end_id bigint")
    got = [(r["cost"], r["path"]) for r in network.corridor_paths(df, pairs, 3).orderBy("place").collect()]
    assert got == [(3.0, "1;2;3;4"), (3.5, "1;2;4"), (4.0, "1;3;4")]
    assert network.corridor_paths(df, pairs, 1).first()["miles"] is None


def test_grid_keeps_sensors_of_many_days(spark, tmp_path):
    """A sensor that spans 40 days has all its slots in the three queries, like one of an hour."""
    from flowmark.plans import measurement as plans

    t0, q = datetime(2025, 1, 1), timedelta(minutes=15)
    rows = [("A", t0, 50.0), ("A", t0 + 2 * q, 54.0), ("A", t0 + 3840 * q, 60.0), ("B", t0, 40.0), ("B", t0 + 2 * q, 44.0)]
    df = spark.createDataFrame([(i, c, t, v, 60.0, 30.0, t) for i, (c, t, v) in enumerate(rows)], "reading_id bigint, tmc_code string, measurement_tstamp timestamp_ntz, speed double, reference_speed double, confidence_score double, received_at timestamp_ntz")
    df.write.parquet(f"{tmp_path}/readings.parquet")
    first = int((t0 - datetime(1970, 1, 1)).total_seconds())
    assert {(r["tmc_code"], r["slot_s"], r["repaired"]) for r in plans.repair_single_gaps(spark, str(tmp_path)).collect()} == {("A", first + 900, 52.0), ("B", first + 900, 42.0)}
    assert [(r["tmc_code"], r["start"], r["length"]) for r in plans.missing_runs(spark, str(tmp_path)).collect()] == [("A", first + 3 * 900, 3837)]
    got = {r["tmc_code"]: (r["n"], r["total"]) for r in plans.interpolate_gaps(spark, str(tmp_path)).collect()}
    assert got["B"] == (3, 126.0) and got["A"][0] == 3841 and abs(got["A"][1] - (50 + 52 + sum(54 + 6 * i / 3838 for i in range(3839)))) < 1e-4


def test_reach_and_costs_of_long_chains(spark):
    """A chain of 70 links: no round limit ends the search early."""
    df = spark.createDataFrame([(i, i + 1, 0.5) for i in range(70)], "from_node_id bigint, to_node_id bigint, cost double").coalesce(1)
    src = spark.createDataFrame([(0,)], "node_id bigint").coalesce(1)
    assert {r["node_id"]: r["hops"] for r in network.reachable(df, src).collect()} == {i: i for i in range(71)}
    assert {r["node_id"]: r["cost"] for r in network.shortest_costs(df, src, 1e9).collect()} == {i: i / 2 for i in range(71)}


def test_costs_take_no_round_per_link(spark):
    """Costs along a chain write as many tables as costs over one link, so labels of many sources aren't written again in each round."""
    from flowmark import session

    counts = []
    for n in (1, 40):
        df = spark.createDataFrame([(i, i + 1, 0.5) for i in range(n)], "from_node_id bigint, to_node_id bigint, cost double").coalesce(1)
        before = len(session._CUTS)
        got = network.shortest_costs(df, spark.createDataFrame([(i,) for i in range(n)], "node_id bigint").coalesce(1)).collect()
        counts.append(len(session._CUTS) - before)
        assert {(r["source_id"], r["node_id"]): r["cost"] for r in got} == {(i, j): (j - i) / 2 for i in range(n) for j in range(i, n + 1)}
    assert counts[0] == counts[1]


def test_costs_of_whole_networks_equal_rounds(spark):
    """Searches of the whole network in a task and rounds over labels agree: hubs, loops, repeated, null, NaN, endless and unusable links, sources off the network, cutoffs."""
    rng = np.random.default_rng(5)
    links = [(f"n{a}", f"n{b}", float(c)) for a, b, c in zip(rng.integers(0, 60, 150), rng.integers(0, 60, 150), rng.uniform(0.1, 2, 150))]
    links += [(f"n{a}", "n3", 1.0 + a / 7) for a in range(45)]  # many links to one node
    links += [("n1", "n1", 1.0), (None, "n2", 1.0), ("n2", None, 1.0), ("n2", "n4", None), ("n5", "n6", float("nan")), ("n7", "x", math.inf), ("x", "y", 1.0), ("n8", "z", 0.0), ("n8", "z", -1.0)]
    df = spark.createDataFrame(links, "from_node_id string, to_node_id string, cost double").coalesce(1)
    src = spark.createDataFrame([(f"n{i}",) for i in range(0, 60, 3)] + [("n7",), ("n7",), ("alone",), (None,)], "node_id string").coalesce(1)
    for cutoff in (math.inf, 1.5):
        one, two = ({(r["source_id"], r["node_id"]): r["cost"] for r in network.shortest_costs(df, src, cutoff, whole).collect()} for whole in (network.WHOLE, 0))
        assert one == two and one["alone", "alone"] == 0.0 and (("n7", "y") in one) == (cutoff == math.inf)
    assert network.shortest_costs(df, src.limit(0)).count() == 0 and network.shortest_costs(df.limit(0), src).count() == 22


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test data here")
def test_reach_and_costs_from_all_starts(spark):
    """Against a search in Python from every start of a chain."""
    from flowmark.plans import network as plans
    from flowmark.session import table

    d = "/root/testdata/sf0.001"
    graph, cost, ends = {}, {}, set()
    for r in table(spark, d, "link").where("from_node_id is not null and to_node_id is not null").collect():
        graph.setdefault(r["from_node_id"], set()).add(r["to_node_id"])
        ends.add(r["to_node_id"])
        if r["length"] is not None and r["length"] > 0:
            k = r["from_node_id"], r["to_node_id"]
            cost[k] = min(r["length"], cost.get(k, math.inf))
    starts = set(graph) - ends
    hops, front = dict.fromkeys(starts, 0), starts
    while front:
        front = {b for a in front for b in graph.get(a, ())} - set(hops)
        hops |= dict.fromkeys(front, max(hops.values()) + 1)
    assert len(starts) > 1 and {r["node_id"]: r["hops"] for r in plans.reachable_from_starts(spark, d).collect()} == hops
    least = {(s, s): 0.0 for s in starts}
    again = True
    while again:
        again = False
        for (s, a), c in list(least.items()):
            for b in graph.get(a, ()):
                if c + cost.get((a, b), math.inf) < least.get((s, b), math.inf):
                    least[s, b], again = c + cost[a, b], True
    got = {(r["source_id"], r["node_id"]): r["cost"] for r in plans.shortest_costs_from_starts(spark, d).collect()}
    assert set(got) == set(least) and all(abs(got[k] - least[k]) < 1e-6 for k in got)


def test_targets_round_trip_and_guard(spark):
    t = ml.boundaries_to_targets(F.lit(6.5), F.lit(7.2), F.lit(8.5), F.lit(6.0))
    b = one(spark, ml.targets_to_boundaries(t["t2_rel"], t["log_span"], t["logit_place"], F.lit(6.0), F.lit(3.0)))[0]
    assert tuple(b) == pytest.approx((6.5, 7.2, 8.5))
    with pytest.raises(ValueError, match="after detection"):
        ml.guard(["lanes", "T2"])


def test_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    y = x @ [2.0, -1.0] + 5 + rng.normal(0, 0.1, 60)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    m = ml.pipeline(["a", "b"], [], "y", rows=60, spread=float(np.std(y))).fit(df)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    w = np.linalg.solve(z.T @ z + 10 * np.eye(2), z.T @ (y - y.mean()))
    assert np.allclose([r["prediction"] for r in m.transform(df).collect()], z @ w + y.mean(), atol=1e-6)


def test_fallback_levels(spark):
    known = spark.createDataFrame([("a", "x", float(i)) for i in range(5)] + [("a", "y", 100.0)], "p string, q string, v double")
    got = {(r["p"], r["q"]): (r["v"], r["level"]) for r in ranking.fallback_lookup(spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "p string, q string"), known, [["p", "q"], ["p"]], "v").collect()}
    assert got == {("a", "x"): (2.0, 0), ("a", "y"): (2.5, 1), ("b", "x"): (2.5, 2)}


def test_corridor_matching_follows_the_parallel_chain(spark):
    from flowmark.operators import matching

    mile = 5280.0
    sensors = spark.createDataFrame([("c", f"t{i}", "Main St", float(i), 1.0, i * mile, 0.0, (i + 1) * mile, 0.0) for i in range(3)], "corridor string, tmc string, road string, road_order double, miles double, start_x double, start_y double, end_x double, end_y double")
    rows = [("c", 10 + i, i, i + 1, 1.0, "Main St", "arterial", i * mile, 60.0, (i + 1) * mile, 60.0) for i in range(3)]
    rows += [("c", 20 + i, i + 1, i, 1.0, "Main St", "arterial", (i + 1) * mile, 60.0, i * mile, 60.0) for i in range(3)]  # the other direction
    rows += [("c", 30 + i, 100 + i, 101 + i, 1.0, "Side Rd", "arterial", i * mile, 900.0, (i + 1) * mile, 900.0) for i in range(3)]
    links = spark.createDataFrame(rows, "corridor string, link_id bigint, from_node_id bigint, to_node_id bigint, miles double, streetname string, facility string, ax double, ay double, bx double, by double")
    got = matching.match_corridors(sensors, links).orderBy("place").collect()
    assert [r["links"] for r in got] == ["10", "11", "12"] and [r["transition"] for r in got] == ["predecessor_no_path", "node_connected", "node_connected"]
    assert got[0]["confidence"] > 90 and got[0]["mean_turn"] == pytest.approx(0)
    order = [(r["link_id"], r["link_order"]) for r in matching.ordered_links(matching.match_corridors(sensors, links)).orderBy("link_order").collect()]
    assert order == [(10, 1), (11, 2), (12, 3)]
    chain = {r["tmc"]: r["before"] for r in matching.predecessors(sensors).collect()}
    assert chain == {"t1": "t0", "t2": "t1"}
    none = matching.match_corridors(sensors, links.limit(0)).collect()
    assert len(none) == 3 and all(r["links"] is None for r in none)


def test_sql_functions(spark):
    from flowmark.functions.registry import register

    register(spark)
    r = spark.sql("select period_of(450), period_of(1799), qvdf_vt2(1, 45, 0.28125, 4), spelled_code('301.0'), inverse_s3(42, 60, 2000/42D, 3.886, 2000)").first()
    assert (r[0], r[1], r[3]) == ("AM", "NT", "301") and r[2] == pytest.approx(45 / 1.28125) and r[4] == pytest.approx(2000, rel=1e-3)


def test_overlap_share_and_weights(spark):
    from flowmark.operators import resources

    c = lambda *xs: [F.lit(float(x)) for x in xs]
    r = one(
        spark, resources.overlap_share(*c(0, 1, 10, 1, 0, 0, 10, 0), 2.0), resources.overlap_share(*c(5, 1, 15, 1, 0, 0, 10, 0), 2.0), resources.overlap_share(*c(0, 5, 10, 5, 0, 0, 10, 0), 2.0),
        resources.overlap_share(*c(5, -4, 5, 4, 0, 0, 10, 0), 2.0), resources.weighted_profile(F.lit(1.0), F.lit(2.0), F.lit(0.25)), resources.weighted_profile(F.lit(1.0), F.lit(None).cast("double"), F.lit(0.25)),
    )
    assert list(r) == pytest.approx([1.0, 0.5, 0.0, 0.5, 1.25, 1.0])


def test_anchor_curve_steps(spark):
    from flowmark.operators import resources

    a = spark.createDataFrame([("k", 0, 40.0), ("k", 100, 60.0)], "key string, t_min int, speed double")
    b = spark.createDataFrame([("k", t) for t in (-5, 0, 50, 100, 120)], "key string, t_min int")
    assert [x["speed"] for x in resources.anchor_curve(b, a).orderBy("t_min").collect()] == [40, 40, 50, 60, 60]


def test_inputs_are_required(spark):
    from flowmark.operators import resources

    df = spark.createDataFrame([("all", 1)], "k string, v int")
    assert resources.with_default(resources.require(df, ["k", "v"]), "k").count() == 1
    for bad in (lambda: resources.require(df, ["x"]), lambda: resources.require(df.limit(0), ["k"]), lambda: resources.with_default(df, "k", "none")):
        with pytest.raises(ValueError):
            bad()


def test_gap_bridges_prefer_the_corridor(spark):
    rows = [(1, 2, 1.0, True, False), (2, 3, 1.0, True, False), (1, 3, 0.5, False, False), (1, 4, 0.2, False, True), (4, 3, 0.2, True, False), (3, 9, 2.9, False, False), (1, 8, 2.9, True, False), (8, 9, 0.2, True, False)]
    e = spark.createDataFrame([("c", *r) for r in rows], "corridor string, from_node_id bigint, to_node_id bigint, miles double, on_corridor boolean, is_ramp boolean")
    g = spark.createDataFrame([("c", 1, 3), ("c", 3, 9), ("c", 1, 9), ("c", 3, 1)], "corridor string, start_id bigint, end_id bigint")
    got = {(r["start_id"], r["end_id"]): (r["path"], r["miles"]) for r in network.gap_bridges(e, g).collect()}
    assert got == {(1, 3): ("1;2;3", 2.0), (3, 9): ("3;9", 2.9)}


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from flowmark import session

    fake = lambda master, known=None: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: known), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError):
        session.shared_dir(fake("spark://head:7077"))
    with pytest.raises(ValueError):
        session.shared_dir(fake("local-cluster[3,2,1024]"))
    assert session.shared_dir(fake("spark://head:7077", "hdfs://shared")) == "hdfs://shared"
    assert session.shared_dir(fake("local[4]")).startswith("file://")


def test_early_deletion_leaves_other_tables(spark):
    from flowmark import session

    a, b = session.cut(spark.range(5), "a"), session.cut(spark.range(7), "b")
    session.discard(a)
    assert b.count() == 7 and session.cut(spark.range(0), "empty").count() == 0
    t = session.bucketed(spark.range(50).withColumn("k", F.col("id") % 5).repartition(3, "k"), "t", ["k"], 3)
    assert t.groupBy("k").count().count() == 5
    session.release(spark)
    with pytest.raises(Exception):
        b.count()


def test_long_chains_are_followed_to_their_end(spark):
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(100)], "from_node_id bigint, to_node_id bigint, cost double")
    start = spark.createDataFrame([(0,)], "node_id bigint")
    assert {r["node_id"]: r["hops"] for r in network.reachable(e, start).collect()} == {i: i for i in range(101)}
    assert max(r["cost"] for r in network.shortest_costs(e, start).collect()) == 100.0


def test_sensors_of_more_than_two_months_keep_their_grid(spark, tmp_path):
    from flowmark.plans import measurement

    t0 = datetime(2025, 1, 1)
    rows = [(i, "A", t0 + timedelta(days=i), 50.0) for i in range(70)]
    spark.createDataFrame(rows, "reading_id bigint, tmc_code string, measurement_tstamp timestamp_ntz, speed double").withColumn("reference_speed", F.lit(1.0)).withColumn("confidence_score", F.lit(30.0)).write.parquet(str(tmp_path / "readings.parquet"))
    grid = measurement.full_grid(spark, str(tmp_path))
    assert grid.count() == 69 * 96 + 1 and grid.where("speed is not null").count() == 70


def machine(v, states, limit, rules):
    """Steps one by one, for comparison with the cuts."""
    out, i, n = [], 0, len(v)
    support = lambda at, start: states[at] in episodes.ACTIVE
    while i < n:
        entry = next((j for j in range(i, n) if states[j] in episodes.ENTRY), None)
        if entry is None:
            break
        start = next((j for j in range(entry, n - 1) if v[j + 1] < limit), None)
        if start is None:
            break
        end = None
        for j in range(start + 1, n):
            quiet = next((q for q in range(j - start) if support(j - q, start)), j - start)
            known = [x for x in v[max(start, j - rules.mean_steps + 1) : j + 1] if not np.isnan(x)]
            if quiet > rules.gap_steps and not (known and np.mean(known) <= limit):
                end = j
                out.append((start, max(start, j - quiet + 1)))
                break
        if end is None:
            out.append((start, n - 1))
            break
        i = end + 1
    return out


def test_episode_cuts_equal_steps():
    rng = np.random.default_rng(11)
    for k in range(3000):
        rules = episodes.Rules(gap_steps=int(rng.integers(0, 4)), mean_steps=1)
        rules = episodes.Rules(gap_steps=rules.gap_steps, mean_steps=int(rng.integers(1, rules.gap_steps + 3)))
        v = np.round(rng.choice([20, 30, 40, 44, 46, 50, 60, 70], int(rng.integers(1, 40))) + rng.normal(0, 2, 1)[0], 1)
        v[rng.random(len(v)) < 0.1] = np.nan
        states = episodes.label_states(v, 64.0, rules)
        limit = rules.congested_share * 64.0
        assert episodes.episode_bounds(v, states, limit, rules) == machine(v, states, limit, rules), (v, states)
    with pytest.raises(ValueError):
        episodes.Rules(gap_steps=0, mean_steps=4)


def test_median_slope_counts_pairs():
    rng = np.random.default_rng(12)
    for n in (3, 65, 150):
        x, y = rng.integers(0, 40, n).astype(float), rng.normal(0, 1, n)
        i, j = np.triu_indices(n, 1)
        o = np.argsort(x, kind="stable")
        dx, dy = x[o][j] - x[o][i], y[o][j] - y[o][i]
        assert abs(spatial.median_slope(x, y) - np.median((dy / np.where(dx > 0, dx, 1))[dx > 0])) < 1e-9
    assert np.isnan(spatial.median_slope(np.ones(5), np.arange(5.0)))


def test_sources_are_dispatched_and_refused(spark, tmp_path):
    from flowmark.sources import readers

    with pytest.raises(ValueError):
        readers.load_source(spark, {"source": "satellite", "path": "x"})
    spark.createDataFrame([("a", 1, True), ("b", 2, False)], "tmc string, t2 int, accepted boolean").write.parquet(str(tmp_path / "episodes"))
    with pytest.raises(ValueError):
        readers.read_episode_files(spark, str(tmp_path), ("03-episodes", "episodes"), "tmc string, t2 int")
    with pytest.raises(ValueError):
        readers.read_episode_files(spark, str(tmp_path), ("none",), "tmc string, t2 int")
    with pytest.raises(ValueError):
        readers.with_time_columns(spark.createDataFrame([(1, 2.0)], "link_id int, `spd_mph_25:00` double"))
    spark.createDataFrame([("1", 0.1, 4.0)], "vdf_code string, alpha double, beta double").write.option("header", True).csv(str(tmp_path / "vdf"))
    with pytest.raises(ValueError):
        readers.read_vdf_table(spark, str(tmp_path / "vdf"))
