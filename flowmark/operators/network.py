"""Graph operators on edge tables (from_node_id, to_node_id, cost) by frontier iteration, and path search in bounded corridors."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmark.session import cut


def reachable(edges: DataFrame, sources: DataFrame, most_hops: int | None = None) -> DataFrame:
    """(node_id, hops): nodes reachable from any source (within most_hops, if given), and the fewest hops.

    Rounds end when the frontier is empty, as each takes new nodes only. The frontier is cut after each round, what was seen every 16 rounds.
    """
    e = edges.select(F.col("from_node_id").alias("a"), F.col("to_node_id").alias("b")).where("a is not null and b is not null").distinct()
    e = cut(e, "reach-edges")
    seen = cut(sources.select(F.col("node_id"), F.lit(0).alias("hops")).where("node_id is not null").distinct(), "reach-0")
    frontier, hop = seen, 0
    while most_hops is None or hop < most_hops:
        hop += 1
        new = frontier.join(e, F.col("node_id") == F.col("a")).select(F.col("b").alias("node_id")).distinct().join(seen, "node_id", "left_anti").withColumn("hops", F.lit(hop))
        frontier = cut(new, f"reach-{hop}")
        if frontier.limit(1).count() == 0:
            break
        seen = seen.unionByName(frontier)
        if hop % 16 == 0:
            seen = cut(seen, f"reach-seen-{hop}")
    return seen


WHOLE = 1_000_000  # links and sources together up to which each task searches the whole network
TOGETHER = 64  # sources searched at once
PANEL = 4_000_000  # labels of such a search
ENDLESS = 1e300  # stands for an infinite cost, which isn't the same as being out of reach


class _Network:
    """Links by the node they lead to, for searches from many sources at once; nodes are numbered by their number of such links, most first."""

    def __init__(self, tails: pa.Array, heads: pa.Array, costs: np.ndarray, sources: pa.Array):
        every = pa.chunked_array([tails, heads, sources]).combine_chunks().dictionary_encode()
        place, k, n = every.indices.to_numpy(), len(tails), len(every.dictionary)
        by = np.argsort(-np.bincount(place[k : 2 * k], minlength=n), kind="stable")
        number = np.empty(n, np.int64)
        number[by] = np.arange(n)
        place = number[place]
        order = np.argsort(place[k : 2 * k], kind="stable")
        self.ids, self.sources = every.dictionary.take(pa.array(by)), place[2 * k :]
        self.tail, self.head, self.cost = place[:k][order], place[k : 2 * k][order], np.minimum(costs[order], ENDLESS)[:, None]
        self.first = np.searchsorted(self.head, np.arange(n + 1))

    def costs(self, sources: np.ndarray, cutoff: float, most: int = 2048, many: int = 32) -> np.ndarray:
        """Least costs, nodes by sources, infinite where out of reach. Only nodes behind an improved one are looked at again, until nothing improves."""
        best = np.full((len(self.ids), len(sources)), np.inf)
        best[sources, np.arange(len(sources))] = 0.0
        improved = np.zeros(len(self.ids), bool)
        improved[sources] = True

        def steps(links):
            x = best[self.tail[links]]
            x += self.cost[links]
            return x if cutoff == np.inf else np.where(x > cutoff, np.inf, x)

        while improved.any():
            nodes = np.unique(self.head[improved[self.tail]])
            improved[:] = False
            crowded = int(np.searchsorted(self.first[nodes] - self.first[nodes + 1], -many))  # those with more than `many` links come first
            for node in nodes[:crowded]:
                old = best[node]
                least = old.copy()
                for at in range(self.first[node], self.first[node + 1], most):
                    np.minimum(least, steps(slice(at, min(at + most, self.first[node + 1]))).min(axis=0), out=least)
                improved[node] = (least < old).any()
                best[node] = least
            for at in range(crowded, len(nodes), most):
                part = nodes[at : at + most]
                begin, n = self.first[part], self.first[part + 1] - self.first[part]
                old = best[part]
                least = old.copy()
                for i in range(n[0]):  # the i-th link of each node that has as many
                    own = int(np.searchsorted(-n, -i))
                    np.minimum(least[:own], steps(begin[:own] + i), out=least[:own])
                improved[part] = (least < old).any(axis=1)
                best[part] = least
        return best


def _from_sources(cutoff: float):
    def run(batches):
        for batch in batches:
            for starts, links in zip(batch.column("starts"), batch.column("links")):
                e = links.values
                net = _Network(e.field("a"), e.field("b"), e.field("w").to_numpy(), starts.values)
                width = max(1, min(TOGETHER, PANEL // len(net.ids)))
                for at in range(0, len(net.sources), width):
                    own = net.sources[at : at + width]
                    best = net.costs(own, cutoff)
                    for c in range(0, len(own), 8):  # batches of moderate size
                        part = np.ascontiguousarray(best[:, c : c + 8].T)
                        s, node = np.nonzero(part < np.inf)
                        cost = part[s, node]
                        cost[cost >= ENDLESS] = np.inf
                        yield pa.RecordBatch.from_arrays([net.ids.take(pa.array(own[c + s])), net.ids.take(pa.array(node)), pa.array(cost)], names=["source_id", "node_id", "cost"])

    return run


def shortest_costs(edges: DataFrame, sources: DataFrame, cutoff: float = float("inf"), whole: int = WHOLE) -> DataFrame:
    """(source_id, node_id, cost): least cost from each source to every node within the cutoff; costs are above 0.

    Networks of up to `whole` links and sources go to each task as one row, and a task searches them from its sources, so
    nothing but the result grows with sources times nodes. Larger ones are searched in rounds over labels. Both end when
    nothing improves, which they do as costs are above 0; so all costs are final, and the same.
    """
    e = edges.where("cost > 0 and from_node_id is not null and to_node_id is not null").groupBy(F.col("from_node_id").alias("a"), F.col("to_node_id").alias("b")).agg(F.min(F.col("cost").cast("double")).alias("w"))
    e = cut(e.where("not isnan(w)"), "cost-edges")
    own = cut(sources.select("node_id").where("node_id is not null").distinct(), "cost-sources")
    starts = own.count()
    if e.count() + starts > whole:
        return _costs_in_rounds(e, own, cutoff)
    kind = e.schema["a"].dataType.simpleString()
    tasks = max(1, -(-starts // TOGETHER))
    own = own.select(F.col("node_id").cast(kind).alias("node_id")).groupBy(F.pmod(F.xxhash64("node_id"), F.lit(tasks)).alias("task")).agg(F.collect_list("node_id").alias("starts"))
    graph = e.agg(F.collect_list(F.struct("a", F.col("b").cast(kind).alias("b"), "w")).alias("links"))
    rows = edges.sparkSession.range(0, tasks, 1, tasks).withColumnRenamed("id", "task").join(F.broadcast(own), "task").crossJoin(F.broadcast(graph))
    return rows.select("starts", "links").mapInArrow(_from_sources(cutoff), f"source_id {kind}, node_id {kind}, cost double")


def _costs_in_rounds(e: DataFrame, own: DataFrame, cutoff: float) -> DataFrame:
    """The same by rounds over labels, of which only improved ones are extended, so a round's join is as small as its frontier."""
    labels = cut(own.select(F.col("node_id").alias("source_id"), "node_id", F.lit(0.0).alias("cost")), "cost-0")
    frontier, i = labels, 0
    while frontier.limit(1).count():
        i += 1
        step = frontier.join(e, F.col("node_id") == F.col("a")).select("source_id", F.col("b").alias("node_id"), (F.col("cost") + F.col("w")).alias("cost")).where(F.col("cost") <= cutoff)
        step = step.groupBy("source_id", "node_id").agg(F.min("cost").alias("cost"))
        old = labels.withColumnRenamed("cost", "old")
        both = cut(step.join(old, ["source_id", "node_id"], "full_outer"), f"cost-{i}")
        frontier = both.where("cost is not null and (old is null or cost < old)").select("source_id", "node_id", "cost")
        labels = both.select("source_id", "node_id", F.least("cost", "old").alias("cost"))
    return labels


def _dijkstra(graph: dict, start, goal, banned_nodes=frozenset(), banned_edges=frozenset(), cutoff=float("inf")):
    heap, done = [(0.0, start, (start,))], set()
    while heap:
        cost, node, path = heapq.heappop(heap)
        if node == goal:
            return cost, path
        if node in done:
            continue
        done.add(node)
        for nxt, w in graph.get(node, ()):
            if nxt not in done and nxt not in banned_nodes and (node, nxt) not in banned_edges and cost + w <= cutoff:
                heapq.heappush(heap, (cost + w, nxt, (*path, nxt)))
    return None


def within(graph: dict, start, most: float) -> dict:
    """Least cost from start to every node within `most`."""
    heap, done = [(0.0, start)], {}
    while heap:
        cost, node = heapq.heappop(heap)
        if node not in done:
            done[node] = cost
            for nxt, w in graph.get(node, ()):
                if nxt not in done and cost + w <= most:
                    heapq.heappush(heap, (cost + w, nxt))
    return done


def k_paths(graph: dict, start, goal, k: int, cutoff: float = float("inf")) -> list[tuple[float, tuple]]:
    """Up to k loopless paths by cost: each next path leaves a found one at some node, avoiding what found ones do there."""
    first = _dijkstra(graph, start, goal, cutoff=cutoff)
    found, waiting, known = ([first] if first else []), [], {first[1]} if first else set()
    cost_of = {(a, b): w for a, es in graph.items() for b, w in es}
    while found and len(found) < k:
        _, path = found[-1]
        for i in range(len(path) - 1):
            root = path[: i + 1]
            used = {(p[i], p[i + 1]) for _, p in found if len(p) > i + 1 and p[: i + 1] == root}
            rest = _dijkstra(graph, path[i], goal, frozenset(root[:-1]), frozenset(used), cutoff)
            if rest:
                whole = (*root[:-1], *rest[1])
                if whole not in known:
                    known.add(whole)
                    heapq.heappush(waiting, (sum(cost_of[a, b] for a, b in zip(root, root[1:])) + rest[0], whole))
        if not waiting:
            break
        found.append(heapq.heappop(waiting))
    return found


PATHS = "corridor string, start_id bigint, end_id bigint, place int, cost double, path string, miles double"


PAIRS_TOGETHER = 500  # pairs of one corridor that stay in one task


def corridor_paths(edges: DataFrame, pairs: DataFrame, k: int = 6, cutoff: float = float("inf"), together: int = PAIRS_TOGETHER) -> DataFrame:
    """PATHS: up to k loopless paths per pair inside each corridor's own sub-network.

    edges: corridor, from_node_id, to_node_id, cost, and miles if known. pairs: corridor, start_id, end_id; repeated ones count
    once. A corridor with many pairs is spread over tasks of `together` pairs each, to all of which its cheapest links per
    pair of nodes go; what a task holds is one corridor's links.
    """

    def work(key, e: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        graph: dict = {}
        length: dict = {}
        for a, b, w, m in zip(e["a"], e["b"], e["cost"], e["miles"]):
            graph.setdefault(a, []).append((b, w))
            length[a, b] = m
        for out in graph.values():
            out.sort()
        rows = []
        for s, t in sorted(zip(p["start_id"], p["end_id"])):
            rows += [(key[0], s, t, i + 1, c, ";".join(str(int(x)) for x in path), sum(length[x] for x in zip(path, path[1:]))) for i, (c, path) in enumerate(k_paths(graph, s, t, k, cutoff))]
        return pd.DataFrame(rows, columns=["corridor", "start_id", "end_id", "place", "cost", "path", "miles"])

    miles = F.col("miles").cast("double") if "miles" in edges.columns else F.lit(None).cast("double")
    e = edges.where("corridor is not null and from_node_id is not null and to_node_id is not null and cost > 0")
    e = e.groupBy("corridor", F.col("from_node_id").alias("a"), F.col("to_node_id").alias("b")).agg(F.min(F.struct(F.col("cost").cast("double").alias("cost"), miles.alias("miles"))).alias("x")).select("corridor", "a", "b", "x.cost", "x.miles")
    own = pairs.where("corridor is not null and start_id is not null and end_id is not null").select("corridor", "start_id", "end_id").distinct()
    own = cut(own, "pairs")
    salts = own.groupBy("corridor").agg(F.ceil(F.count("*") / together).cast("int").alias("salts"))
    own = own.join(salts, "corridor").withColumn("salt", F.pmod(F.xxhash64("start_id", "end_id"), F.col("salts")).cast("int")).drop("salts")
    spread = e.join(salts, "corridor").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return spread.groupBy("corridor", "salt").cogroup(own.groupBy("corridor", "salt")).applyInPandas(work, PATHS)


def gap_bridges(edges: DataFrame, gaps: DataFrame, own: str = "on_corridor", ramp: str = "is_ramp", off_factor: float = 6.0, ramp_factor: float = 12.0, longest: float = 3.0) -> DataFrame:
    """PATHS that bridge gaps of a corridor, of at most `longest` miles: links off it cost off_factor times as much, ramps ramp_factor times, both together.

    edges: corridor, from_node_id, to_node_id, miles, and whether a link is the corridor's own and whether it is a ramp.
    """
    cost = F.col("miles") * F.when(F.coalesce(own, F.lit(False)), 1.0).otherwise(off_factor) * F.when(F.coalesce(ramp, F.lit(False)), ramp_factor).otherwise(1.0)
    return corridor_paths(edges.withColumn("cost", cost), gaps, 1, longest * max(1.0, off_factor)).where(F.col("miles") <= longest)


def line_graph(edges: DataFrame) -> DataFrame:
    """(link_id, next_id, cost): successive links inside a corridor. For corridors, where a node has a few links."""
    a = edges.select("corridor", "link_id", F.col("to_node_id").alias("node"), "miles")
    b = edges.select("corridor", F.col("link_id").alias("next_id"), F.col("from_node_id").alias("node"), F.col("miles").alias("next_miles"))
    return a.join(b, ["corridor", "node"]).where("link_id != next_id").select("corridor", "link_id", "next_id", ((F.col("miles") + F.col("next_miles")) / 2).alias("cost"))


def chain_ends(edges: DataFrame) -> DataFrame:
    """(node_id, kind): nodes where chains start (no link ends there) and end (no link starts there)."""
    a, b = edges.select(F.col("from_node_id").alias("node_id")).distinct(), edges.select(F.col("to_node_id").alias("node_id")).distinct()
    return a.join(b, "node_id", "left_anti").withColumn("kind", F.lit("start")).unionByName(b.join(a, "node_id", "left_anti").withColumn("kind", F.lit("end")))
