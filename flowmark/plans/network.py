"""Queries of graph operators, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.operators import network
from flowmark.plans.measurement import registry, rounded
from flowmark.plans.relational import links
from flowmark.session import table
from flowmark.streaming import readings as streams

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


_E = "e AS (SELECT DISTINCT from_node_id AS a, to_node_id AS b FROM link WHERE from_node_id IS NOT NULL AND to_node_id IS NOT NULL), s AS (SELECT min(a) AS node_id FROM e)"


def first_node(spark, d) -> DataFrame:
    return table(spark, d, "link").where("from_node_id is not null and to_node_id is not null").agg(F.min("from_node_id").alias("node_id"))


@query(f"WITH RECURSIVE {_E}, t(node_id, hops) AS (SELECT node_id, 0 FROM s UNION SELECT b, hops + 1 FROM t JOIN e ON t.node_id = e.a WHERE hops < 6) SELECT node_id, min(hops) AS hops FROM t GROUP BY node_id")
def reachable_nodes(spark, d):
    return network.reachable(table(spark, d, "link"), first_node(spark, d), 6)


@query(f"""WITH RECURSIVE {_E}, w AS (SELECT from_node_id AS a, to_node_id AS b, min(length) AS w FROM link WHERE length > 0 AND from_node_id IS NOT NULL AND to_node_id IS NOT NULL GROUP BY ALL),
t(node_id, cost, hops) AS (SELECT node_id, 0.0::DOUBLE, 0 FROM s UNION SELECT b, cost + w, hops + 1 FROM t JOIN w ON t.node_id = w.a WHERE cost + w <= 1.2 AND hops < 12) SELECT (SELECT node_id FROM s) AS source_id, node_id, round(min(cost), 8) AS cost FROM t GROUP BY node_id""")
def shortest_costs(spark, d):
    e = table(spark, d, "link").where("from_node_id is not null and to_node_id is not null").withColumn("cost", F.col("length"))
    return rounded(network.shortest_costs(e, first_node(spark, d), 1.2))


def chain_starts(spark, d) -> DataFrame:
    return network.chain_ends(table(spark, d, "link").where("from_node_id is not null and to_node_id is not null")).where("kind = 'start'").select("node_id")


@query(f"""WITH RECURSIVE {_E}, st AS (SELECT DISTINCT a AS node_id FROM e WHERE a NOT IN (SELECT b FROM e)), t(node_id, hops) AS (SELECT node_id, 0 FROM st UNION SELECT b, hops + 1 FROM t JOIN e ON t.node_id = e.a WHERE hops < (SELECT count(DISTINCT b) FROM e)) SELECT node_id, min(hops) AS hops FROM t GROUP BY node_id""")
def reachable_from_starts(spark, d):
    """All nodes reachable from any start of a chain, over any number of hops."""
    return network.reachable(table(spark, d, "link"), chain_starts(spark, d))


@query(f"""WITH RECURSIVE {_E.split(", s AS")[0]}, w AS (SELECT from_node_id AS a, to_node_id AS b, min(length) AS w FROM link WHERE length > 0 AND from_node_id IS NOT NULL AND to_node_id IS NOT NULL GROUP BY ALL), st AS (SELECT DISTINCT a AS node_id FROM e WHERE a NOT IN (SELECT b FROM e)),
t(source_id, node_id, cost, i) AS (SELECT node_id, node_id, 0.0::DOUBLE, 0 FROM st UNION ALL SELECT source_id, node_id, min(cost), i + 1 FROM (SELECT t.source_id, x.b AS node_id, t.cost + x.w AS cost, t.i FROM t JOIN (SELECT a, b, w FROM w UNION ALL SELECT DISTINCT n, n, 0.0 FROM (SELECT a AS n FROM e UNION SELECT b FROM e)) x ON t.node_id = x.a WHERE t.i < 64) GROUP BY source_id, node_id, i)
SELECT source_id, node_id, round(cost, 8) AS cost FROM t WHERE i = 64""")
def shortest_costs_from_starts(spark, d):
    """Least costs from every start of a chain to all nodes it reaches, without a cutoff: up to starts times nodes rows."""
    e = table(spark, d, "link").where("from_node_id is not null and to_node_id is not null").withColumn("cost", F.col("length"))
    return rounded(network.shortest_costs(e, chain_starts(spark, d)))


@query("""WITH e AS (SELECT DISTINCT from_node_id AS a, to_node_id AS b FROM link WHERE from_node_id IS NOT NULL AND to_node_id IS NOT NULL) SELECT DISTINCT a AS node_id, 'start' AS kind FROM e WHERE a NOT IN (SELECT b FROM e) UNION ALL SELECT DISTINCT b, 'end' FROM e WHERE b NOT IN (SELECT a FROM e)""")
def chain_ends(spark, d):
    return network.chain_ends(table(spark, d, "link").where("from_node_id is not null and to_node_id is not null"))


def corridor_edges(spark, d) -> DataFrame:
    """The links of each street that have a length."""
    return links(spark, d).where("streetname is not null and length > 0").select(F.col("streetname").alias("corridor"), "link_id", "from_node_id", "to_node_id", F.col("length").alias("miles"), F.col("length").alias("cost"))


@query("""WITH RECURSIVE lr AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY valid_from DESC NULLS LAST, valid_to DESC NULLS FIRST, length ASC NULLS LAST, lanes ASC NULLS LAST, link_type ASC NULLS LAST, free_speed ASC NULLS LAST, capacity ASC NULLS LAST, streetname ASC NULLS LAST, from_node_id ASC NULLS LAST, to_node_id ASC NULLS LAST) AS place FROM link),
e AS (SELECT streetname AS corridor, link_id, from_node_id AS a, to_node_id AS b, length AS miles FROM lr WHERE place = 1 AND streetname IS NOT NULL AND length > 0 AND from_node_id IS NOT NULL AND to_node_id IS NOT NULL),
w AS (SELECT corridor, a, b, min(miles) AS w FROM e GROUP BY corridor, a, b),
pr AS (SELECT corridor, a AS s, b AS t FROM e WHERE a <> b UNION SELECT x.corridor, x.a, y.b FROM e x JOIN e y ON x.corridor = y.corridor AND x.b = y.a AND x.link_id <> y.link_id WHERE x.a <> y.b),
g(corridor, s, node, path, cost) AS (SELECT DISTINCT corridor, s, s, [s], 0.0::DOUBLE FROM pr UNION ALL SELECT g.corridor, g.s, w.b, list_append(g.path, w.b), g.cost + w.w FROM g JOIN w ON w.corridor = g.corridor AND w.a = g.node WHERE NOT list_contains(g.path, w.b)),
r AS (SELECT pr.corridor, pr.s, pr.t, g.path, g.cost, row_number() OVER (PARTITION BY pr.corridor, pr.s, pr.t ORDER BY round(g.cost, 9), g.path) AS place FROM pr JOIN g ON g.corridor = pr.corridor AND g.s = pr.s AND g.node = pr.t)
SELECT corridor, s AS start_id, t AS end_id, CAST(place AS INT) AS place, round(cost, 8) AS cost, array_to_string(path, ';') AS path, round(cost, 8) AS miles FROM r WHERE place <= 3""")
def corridor_paths(spark, d):
    """Up to three paths inside each street between the ends of its links and of successive links."""
    e = corridor_edges(spark, d).where("from_node_id is not null and to_node_id is not null")
    ends = e.select("corridor", "link_id", F.col("from_node_id").alias("start_id"), F.col("to_node_id").alias("end_id"))
    nxt = ends.select(F.col("corridor").alias("c"), F.col("link_id").alias("n"), F.col("end_id").alias("far_id"))
    first = ends.select(F.col("corridor").alias("c0"), F.col("link_id").alias("l"), "start_id")
    far = network.line_graph(e).join(first, (F.col("corridor") == F.col("c0")) & (F.col("link_id") == F.col("l"))).join(nxt, (F.col("corridor") == F.col("c")) & (F.col("next_id") == F.col("n")))
    far = far.select("corridor", "start_id", F.col("far_id").alias("end_id"))
    pairs = ends.select("corridor", "start_id", "end_id").unionByName(far.select("corridor", "start_id", "end_id")).where("start_id != end_id").distinct()
    return network.corridor_paths(e, pairs, 3)


@query("""WITH lr AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY valid_from DESC NULLS LAST, valid_to DESC NULLS FIRST, length ASC NULLS LAST, lanes ASC NULLS LAST, link_type ASC NULLS LAST, free_speed ASC NULLS LAST, capacity ASC NULLS LAST, streetname ASC NULLS LAST, from_node_id ASC NULLS LAST, to_node_id ASC NULLS LAST) AS place FROM link),
e AS (SELECT streetname AS corridor, link_id, from_node_id, to_node_id, length AS miles FROM lr WHERE place = 1 AND streetname IS NOT NULL AND length > 0) SELECT a.corridor, a.link_id, b.link_id AS next_id, round((a.miles + b.miles) / 2, 8) AS cost FROM e a JOIN e b ON a.corridor = b.corridor AND a.to_node_id = b.from_node_id AND a.link_id <> b.link_id""")
def line_graph(spark, d):
    return rounded(network.line_graph(corridor_edges(spark, d)))


@query("SELECT epoch_us(ts) // 900000000 * 900 AS slot_s, event_type, count(*) AS n, round(avg(value), 8) AS mean FROM events GROUP BY ALL")
def stream_tumbling(spark: SparkSession, d: str):
    return rounded(streams.run_tumbling(spark, d))


@query("SELECT count(DISTINCT event_id) AS n_events, count(DISTINCT user_id) AS n_users FROM events")
def stream_deduplicated(spark, d):
    return streams.run_deduplicated(spark, d)


@query("""WITH o AS (SELECT user_id, coalesce(value > 100, false) AS hit, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events WHERE user_id IS NOT NULL), g AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, hit ORDER BY i) AS run FROM o),
l AS (SELECT user_id, hit, run, count(*) AS c FROM g GROUP BY ALL) SELECT user_id, CAST(sum(c) AS BIGINT) AS events, CAST(coalesce(sum(c) FILTER (hit), 0) AS BIGINT) AS above, coalesce(max(c) FILTER (hit), 0) AS longest FROM l GROUP BY user_id""")
def stream_stateful_runs(spark, d):
    return streams.run_stateful(spark, d)


@query("""WITH o AS (SELECT user_id, epoch_us(ts) AS us FROM events WHERE ts IS NOT NULL), l AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 1800000000 THEN 0 ELSE 1 END AS new FROM o WINDOW w AS (PARTITION BY user_id ORDER BY us)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS s FROM l), x AS (SELECT user_id, min(us) AS start_us, max(us) + 1800000000 AS end_us, count(*) AS n FROM g GROUP BY user_id, s)
SELECT * FROM x WHERE end_us <= (SELECT max(us) // 1000 * 1000 - 604800000000 FROM o)""")
def stream_sessions(spark, d):
    """Sessions of users with gaps of half an hour, those that are closed for good."""
    return streams.run_sessions(spark, d)
