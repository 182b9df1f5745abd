"""Matching corridors of sensors to the link network: candidates, routes, transitions, and the best chain of routes.

Routes are searched per sensor, among the links that a grid join finds around it. The chain of a corridor is chosen from the
few best routes of each of its sensors, so only these tables come together, never the links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmark.operators.network import k_paths, within

# Penalties of the transition between the routes of successive sensors, and limits in miles and feet.
CONNECTOR_MILES, CONNECTOR_BASE, CONNECTOR_PER_MILE, DISCONNECTED = 1.0, 20.0, 80.0, 250.0
CHAIN_FEET = 100.0
NAME_MISMATCH = 3.0
CANDIDATES, PATHS = 8, 6


def predecessors(sensors: DataFrame, most_feet: float = CHAIN_FEET) -> DataFrame:
    """(corridor, tmc, before, gap_ft): the earlier sensor whose end lies nearest to a sensor's start, within most_feet.

    sensors: corridor, tmc, road_order, start_x, start_y, end_x, end_y (feet). Nearest first, then nearest in order, then the
    later one. Pairs are only made inside a corridor between ends in the same or neighbouring grid cells.
    """
    w = Window.partitionBy("corridor").orderBy(F.col("road_order").asc_nulls_last(), "tmc")
    s = sensors.withColumn("place", F.row_number().over(w))
    cell = lambda c: F.floor(F.col(c) / most_feet).cast("bigint")
    ends = s.select("corridor", F.col("tmc").alias("before"), F.col("place").alias("p0"), F.col("road_order").alias("o0"), F.col("end_x"), F.col("end_y"), cell("end_x").alias("cx"), cell("end_y").alias("cy"))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    starts = s.select("corridor", "tmc", "place", "road_order", "start_x", "start_y", F.explode(F.transform(around, lambda d: cell("start_x") + d)).alias("cx"), cell("start_y").alias("y0"))
    starts = starts.withColumn("cy", F.explode(F.transform(around, lambda d: F.col("y0") + d)))
    j = starts.join(ends, ["corridor", "cx", "cy"]).where("p0 < place").withColumn("gap_ft", F.hypot(F.col("end_x") - F.col("start_x"), F.col("end_y") - F.col("start_y"))).where(F.col("gap_ft") <= most_feet)
    order = F.struct("gap_ft", F.coalesce(F.abs(F.col("road_order") - F.col("o0")), F.lit(float("inf"))).alias("o"), (-F.col("p0")).alias("p"), "before")
    best = j.groupBy("corridor", "tmc").agg(F.min(order).alias("b"))
    return best.select("corridor", "tmc", F.col("b.before").alias("before"), F.col("b.gap_ft").alias("gap_ft"))


def _angle(a: float, b: float) -> float:
    return abs((a - b + 180) % 360 - 180)


def _distance(ax, ay, bx, by, cx, cy, dx, dy) -> float:
    """Least distance of two segments' ends to each other's line."""

    def point(px, py, qx, qy, rx, ry):
        n = (rx - qx) ** 2 + (ry - qy) ** 2
        t = 0.0 if n == 0 else min(1.0, max(0.0, ((px - qx) * (rx - qx) + (py - qy) * (ry - qy)) / n))
        return math.hypot(px - qx - t * (rx - qx), py - qy - t * (ry - qy))

    return min(point(ax, ay, cx, cy, dx, dy), point(bx, by, cx, cy, dx, dy), point(cx, cy, ax, ay, bx, by), point(dx, dy, ax, ay, bx, by))


def _route_score(rows: pd.DataFrame, s, start_ft: float, end_ft: float) -> tuple[float, dict]:
    feet = np.maximum(np.hypot(rows["bx"] - rows["ax"], rows["by"] - rows["ay"]).to_numpy(), 1.0)
    off = np.array([_distance(r.ax, r.ay, r.bx, r.by, s.start_x, s.start_y, s.end_x, s.end_y) for r in rows.itertuples()])
    heading = math.degrees(math.atan2(s.end_x - s.start_x, s.end_y - s.start_y)) % 360
    turn = np.array([_angle(math.degrees(math.atan2(r.bx - r.ax, r.by - r.ay)) % 360, heading) for r in rows.itertuples()])
    ratio = max(float(rows["miles"].sum()) / max(s.miles, 1e-6), 1e-6)
    off_scale = abs(math.log(ratio)) * 28.0 * (0.25 if 0.45 <= ratio <= 2.30 else 1.0)
    mean = lambda x: float((x * feet).sum() / feet.sum())
    names = rows["streetname"].fillna("").str.upper()
    unnamed = ((names == "") | names.str.contains("RAMP", regex=False)).to_numpy()
    other = (names != str(s.road or "").upper()).to_numpy() & ~unnamed
    kinds = rows["facility"].fillna("").tolist()
    switches = sum(a != b and bool(a) and bool(b) for a, b in zip(kinds, kinds[1:]))
    score = mean(off) / 45 + off.max() / 120 + mean(turn) * 1.4 + off_scale + (start_ft + end_ft) / 850 + NAME_MISMATCH * mean(other.astype(float)) + mean(unnamed.astype(float)) + 25.0 * switches
    return score, {"length_ratio": ratio, "mean_offset_ft": mean(off), "most_offset_ft": float(off.max()), "mean_turn": mean(turn), "switches": switches}


MATCHES = "corridor string, tmc string, place int, links string, score double, margin double, transition string, confidence double, length_ratio double, mean_offset_ft double, most_offset_ft double, mean_turn double, switches int"
_FACTS = ("length_ratio", "mean_offset_ft", "most_offset_ft", "mean_turn", "switches")
ROUTES = "corridor string, tmc string, links array<bigint>, first bigint, last bigint, score double, length_ratio double, mean_offset_ft double, most_offset_ft double, mean_turn double, switches int, near array<struct<node: bigint, miles: double>>"
REACH_FT = 3500.0  # ends of links farther from a sensor's end are no candidates
MILE_FT = 5280.0


def near_links(sensors: DataFrame, links: DataFrame) -> DataFrame:
    """links of the same corridor around each sensor, with its tmc: those with an end in a grid cell that the sensor's box, widened by its reach, touches."""
    s = sensors.where("corridor is not null").select("corridor", "tmc", *(F.col(c).cast("double").alias(c) for c in ("start_x", "start_y", "end_x", "end_y", "miles")))
    reach = REACH_FT + MILE_FT * F.greatest(4 * F.greatest("miles", F.lit(0.05)), F.lit(CONNECTOR_MILES))  # a route stays within that of its start
    size = 4 * MILE_FT
    cells = lambda a, b: F.explode(F.sequence(F.floor((F.least(a, b) - reach) / size), F.floor((F.greatest(a, b) + reach) / size)))
    s = s.select("corridor", "tmc", cells("start_x", "end_x").alias("cx"), "start_y", "end_y", "miles").select("corridor", "tmc", "cx", cells("start_y", "end_y").alias("cy"))
    own = links.where("corridor is not null").select(*(F.coalesce(F.col(c), F.col(c)).alias(c) for c in ("corridor", "link_id", "from_node_id", "to_node_id", "miles", "streetname", "facility", "ax", "ay", "bx", "by")))
    cell = lambda x, y: F.struct(F.floor(F.col(x) / size).alias("cx"), F.floor(F.col(y) / size).alias("cy"))
    at = own.withColumn("_c", F.explode(F.array_distinct(F.array(cell("ax", "ay"), cell("bx", "by"))))).select(*own.columns, "_c.cx", "_c.cy")
    return at.join(s, ["corridor", "cx", "cy"]).select("tmc", *own.columns).distinct()


def sensor_routes(sensors: DataFrame, links: DataFrame) -> DataFrame:
    """ROUTES: the best routes of links for each sensor by itself, 2 * PATHS at most, and the nodes from which a short connector leads to a route's start.

    Routes run between the CANDIDATES nearest ends of links within REACH_FT of the sensor's ends, up to PATHS for each pair.
    """

    def work(key, sn: pd.DataFrame, ln: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(columns=["corridor", "tmc", "links", "first", "last", "score", *_FACTS, "near"])
        if not len(sn) or not len(ln):
            return empty
        s = next(sn.itertuples())
        ln = ln.drop_duplicates("link_id").sort_values("link_id")
        graph: dict = {}
        back: dict = {}
        by_pair: dict = {}
        miles = ln["miles"].to_numpy()
        for i, (a, b) in enumerate(zip(ln["from_node_id"], ln["to_node_id"])):
            if (a, b) not in by_pair or miles[by_pair[a, b]] > miles[i]:
                by_pair[a, b] = i
        for (a, b), i in sorted(by_pair.items()):
            graph.setdefault(a, []).append((b, max(float(miles[i]), 1e-6)))
            back.setdefault(b, []).append((a, max(float(miles[i]), 1e-6)))
        ids = ln["link_id"].to_numpy()
        places: dict = {}
        for r in ln.itertuples():
            places.setdefault(r.from_node_id, (r.ax, r.ay))
            places.setdefault(r.to_node_id, (r.bx, r.by))
        nodes = np.array(sorted(places))
        xy = np.array([places[n] for n in nodes])

        def near(x, y):
            d = np.hypot(xy[:, 0] - x, xy[:, 1] - y)
            return [(int(nodes[i]), float(d[i])) for i in np.argsort(d, kind="stable")[:CANDIDATES] if d[i] <= REACH_FT]

        options = {}
        for a, da in near(s.start_x, s.start_y):
            for b, db in near(s.end_x, s.end_y):
                for _, path in k_paths(graph, a, b, PATHS, 4 * max(s.miles, 0.05)) if a != b else []:
                    at = [by_pair[e] for e in zip(path, path[1:])]
                    score, facts = _route_score(ln.iloc[at], s, da, db)
                    route = tuple(int(x) for x in ids[at])
                    if route not in options or score < options[route][0]:
                        options[route] = (score, facts, path)
        ranked = sorted(options.items(), key=lambda o: (o[1][0], o[0]))[: PATHS * 2]
        if not ranked:
            return empty
        joins = {p: [{"node": int(n), "miles": float(m)} for n, m in sorted(within(back, p, CONNECTOR_MILES).items())] for p in {x[1][2][0] for x in ranked}}
        rows = [(key[0], key[1], list(route), int(path[0]), int(path[-1]), score, *(facts[c] for c in _FACTS), joins[path[0]]) for route, (score, facts, path) in ranked]
        return pd.DataFrame(rows, columns=empty.columns)

    sn = sensors.where("corridor is not null").select(*(F.coalesce(F.col(c), F.col(c)).alias(c) for c in ("corridor", "tmc", "road", "miles", "start_x", "start_y", "end_x", "end_y")))
    return sn.groupBy("corridor", "tmc").cogroup(near_links(sensors, links).groupBy("corridor", "tmc")).applyInPandas(work, ROUTES)


def match_corridors(sensors: DataFrame, links: DataFrame, beam: int = 12) -> DataFrame:
    """MATCHES: the route of links of each sensor of a corridor that fits best as a chain.

    sensors: corridor, tmc, road, road_order, miles, start_x, start_y, end_x, end_y (feet). links: corridor, link_id,
    from_node_id, to_node_id, miles, streetname, facility, ax, ay, bx, by (feet), those near the corridor. Routes are searched
    per sensor among the links around it, so a long corridor is many tasks; the chain is then chosen from these tables alone,
    with the `beam` best chains kept at each step. Sensors without a route come out with no links.
    """
    routes = sensor_routes(sensors, links)
    steps = sensors.where("corridor is not null").select("corridor", "tmc", "road_order").join(routes, ["corridor", "tmc"], "left")

    def work(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        chains: list[tuple[float, list]] = [(0.0, [])]
        order = g[["road_order", "tmc"]].drop_duplicates("tmc").sort_values(["road_order", "tmc"], na_position="last")
        by_tmc = {t: x for t, x in g.groupby("tmc")}
        for tmc in order["tmc"]:
            ranked = [(tuple(int(x) for x in r.links), r) for r in by_tmc[tmc].itertuples() if r.links is not None]
            ranked.sort(key=lambda o: (o[1].score, o[0]))
            if not ranked:
                chains = [(c, [*steps_, (tmc, None)]) for c, steps_ in chains]
                continue
            joins = [{x["node"]: x["miles"] for x in r.near} for _, r in ranked]
            grown = []
            for cost, steps_ in chains:
                last = next((x[1] for x in reversed(steps_) if x[1]), None)
                for i, (route, r) in enumerate(ranked):
                    if last is None:
                        how, more = "predecessor_no_path", 0.0
                    elif set(last[0]) & set(route):
                        how, more = "shared_link", 0.0
                    elif last[1].last == r.first:
                        how, more = "node_connected", 0.0
                    elif last[1].last in joins[i]:
                        how, more = "short_connector", CONNECTOR_BASE + CONNECTOR_PER_MILE * joins[i][last[1].last]
                    else:
                        how, more = "disconnected", DISCONNECTED
                    margin = ranked[1][1].score - r.score if i == 0 and len(ranked) > 1 else None
                    grown.append((cost + r.score + more, [*steps_, (tmc, (route, r, how, margin))]))
            chains = sorted(grown, key=lambda c: (c[0], str(c[1][-1][1][0])))[:beam]
        rows = []
        for i, (tmc, x) in enumerate(chains[0][1]):
            if x is None:
                rows.append((key[0], tmc, i + 1, None, None, None, "no_path", None, None, None, None, None, None))
            else:
                route, r, how, margin = x
                rows.append((key[0], tmc, i + 1, ";".join(map(str, route)), r.score, margin, how, max(0.0, min(100.0, 100 - r.score)), *(getattr(r, c) for c in _FACTS)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in MATCHES.split(", ")])

    return steps.groupBy("corridor").applyInPandas(work, MATCHES)


def ordered_links(matches: DataFrame) -> DataFrame:
    """(corridor, link_id, link_order, tmcs): links of a corridor's routes in order of first appearance."""
    x = matches.where("links is not null").select("corridor", "tmc", "place", F.posexplode(F.split("links", ";")).alias("step", "link_id"))
    g = x.groupBy("corridor", F.col("link_id").cast("bigint").alias("link_id")).agg(F.min(F.struct("place", "step")).alias("first"), F.array_join(F.array_sort(F.collect_set("tmc")), ";").alias("tmcs"))
    return g.select("corridor", "link_id", F.row_number().over(Window.partitionBy("corridor").orderBy("first", "link_id")).alias("link_order"), "tmcs")
