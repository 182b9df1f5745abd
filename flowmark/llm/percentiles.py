"""Percentiles of very large numeric columns (problem 1).

Exact: distributed multi-select. The values of a key and day are kept as one sorted run, or as several if they are very many. In each round every
run cuts what is still possible of a target (a key, a span of days and a rank) into slices, as many as the square root of
its candidates and at most SLICES, and proposes their local medians, weighted by their sizes. Of the proposals of all runs the weighted median at the target's rank becomes a pivot, and
so do the nearest ones on either side that are sure to lie beyond the target, whatever the slices hide. All runs count values
below, equal and above the pivots three ways; the ruled-out ranges are discarded. A round leaves about three slices of the
candidates, so a target of 10^9 values in runs of a million needs six. Rounds go on until a target is found or at most FEW candidates are left,
which are then gathered. Only counts, proposals and those few values are shuffled; the runs stay in their buckets.

Mergeable: a digest of counts per key, day and bin of fixed width. Digests of files, partitions and days add up, and a
percentile from them is within half a bin of the exact one between ranks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import bucketed, code, cut, discard, number

RUN_BITS = 20  # a block holds at most 2**20 values; so many values of a key and day come together in a run, more are spread over runs by salt
FEW = 128
SLICES = 64


def clean_values(df: DataFrame, key: str, ts: str, value: str, lowest: float, highest: float) -> DataFrame:
    """(k, day, v) of rows with a key, a time and a value from lowest to highest; day counts from 1970."""
    rows = df.select(code(key).alias("k"), F.unix_date(F.col(ts).cast("date")).alias("day"), number(value).alias("v"))
    return rows.where(F.col("k").isNotNull() & F.col("day").isNotNull() & F.col("v").between(lowest, highest))


def value_blocks(values: DataFrame) -> DataFrame:
    """(k, day, block, n, vals): the values of a key and day in one block of at most 2**RUN_BITS rows of one partition."""
    block = F.expr(f"shiftright(monotonically_increasing_id(), {RUN_BITS})")
    blocks = values.withColumn("block", block).groupBy("k", "day", "block").agg(F.collect_list("v").alias("vals"))
    return blocks.select("k", "day", "block", F.size("vals").alias("n"), "vals")


def digest(values: DataFrame, width: float = 0.5) -> DataFrame:
    """(k, day, bin, n): counts per bin of `width`; sums of digests are digests of the union."""
    return values.groupBy("k", "day", F.floor(F.col("v") / width).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))


def digest_percentiles(d: DataFrame, by: list[str], qs: list[float], width: float = 0.5) -> DataFrame:
    """(by..., q, n, value): for each q the middle of the bin that holds the rank floor(q * (n - 1)) of the merged digests."""
    merged = d.groupBy(*by, "bin").agg(F.sum("n").alias("c"))
    w = Window.partitionBy(*by).orderBy("bin")
    merged = merged.withColumn("upto", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.withColumn("n", F.sum("c").over(Window.partitionBy(*by)))
    rows = merged.withColumn("q", F.explode(F.array(*map(F.lit, qs)))).withColumn("rank", F.floor(F.col("q") * (F.col("n") - 1)))
    hit = rows.where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
    return hit.select(*by, "q", "n", ((F.col("bin") + 0.5) * width).alias("value"))


def _slices(b: pa.RecordBatch):
    """For each row of a batch: its sorted values and its targets' fields as numpy slices."""
    vals, offs = b["vals"].values.to_numpy(), b["vals"].offsets.to_numpy()
    t_offs = b["targets"].offsets.to_numpy()
    f = {x.name: b["targets"].values.field(i).to_numpy(zero_copy_only=False) for i, x in enumerate(b["targets"].type.value_type)}
    for r in range(b.num_rows):
        yield vals[offs[r] : offs[r + 1]], range(t_offs[r], t_offs[r + 1]), f


def _bounds(v: np.ndarray, lo: float, hi: float) -> tuple[int, int]:
    return (0 if np.isnan(lo) else int(np.searchsorted(v, lo, "right"))), (len(v) if np.isnan(hi) else int(np.searchsorted(v, hi, "left")))


def _propose(batches):
    for b in batches:
        out = []
        for v, ts, f in _slices(b):
            for i in ts:
                x, y = _bounds(v, f["lo"][i], f["hi"][i])
                if y > x:
                    n = min(SLICES, math.isqrt(y - x - 1) + 1)  # so that proposals are few against what they are of
                    edges = x + np.arange(n + 1) * (y - x) // n
                    size = np.diff(edges)
                    hidden = np.zeros(n, "int64")
                    hidden[0] = size.max()
                    out.append((np.full(n, f["tid"][i]), v[(edges[:-1] + edges[1:] - 1) // 2], size, hidden))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ("int64", "float64", "int64", "int64"))], names=["tid", "p", "c", "hidden"])


def _count(batches):
    names = ["tid", "pivot", "lt", "eq", "max_lt", "min_gt"]
    for b in batches:
        out = []
        for v, ts, f in _slices(b):
            for i in ts:
                x, y = _bounds(v, f["lo"][i], f["hi"][i])
                if y > x:
                    l, r = np.searchsorted(v[x:y], f["pivot"][i], "left"), np.searchsorted(v[x:y], f["pivot"][i], "right")
                    out.append((f["tid"][i], f["pivot"][i], int(l), int(r - l), float(v[x + l - 1]) if l else None, float(v[x + r]) if x + r < y else None))
        cols = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, ("int64", "float64", "int64", "int64", "float64", "float64"))], names=names)


def _gather(batches):
    for b in batches:
        tids, lists = [], []
        for v, ts, f in _slices(b):
            for i in ts:
                x, y = _bounds(v, f["lo"][i], f["hi"][i])
                if y > x:
                    tids.append(f["tid"][i])
                    lists.append(v[x:y])
        yield pa.RecordBatch.from_arrays([pa.array(tids, "int64"), pa.array(lists, pa.list_(pa.float64()))], names=["tid", "vs"])


def _with_targets(runs: DataFrame, busy: DataFrame, state: DataFrame, *fields: str) -> DataFrame:
    """Runs with the list of targets that their day counts for; the runs are in buckets by (k, day, salt) and stay where they are."""
    nan = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)
    wide = state.select("k", F.explode(F.sequence("d0", "d1")).alias("day"), F.struct("tid", nan("lo"), nan("hi"), *map(nan, fields)).alias("x"))
    packs = wide.groupBy("k", "day").agg(F.collect_list("x").alias("targets")).join(busy, ["k", "day"], "left")
    packs = packs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return runs.join(packs, ["k", "day", "salt"]).select("vals", "targets")


def multi_select(blocks: DataFrame, spans: DataFrame, qs: list[float], few: int = FEW) -> DataFrame:
    """(k, d0, d1, q, n, value): exact percentiles, linear between ranks, of the values of key k on days d0 to d1 (inclusive).

    spans: distinct (k, d0, d1). Spans without values give no row. Ties need no care: equal values are counted together.
    """
    spark = blocks.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    raw = cut(blocks, "blocks")
    sizes = cut(raw.groupBy("k", "day").agg(F.sum("n").alias("n")).withColumn("salts", F.ceil(F.col("n") / (1 << RUN_BITS)).cast("int")), "sizes")
    busy = sizes.where("salts > 1").select("k", "day", "salts")
    salt = F.when(F.col("salts") > 1, F.pmod(F.xxhash64("block"), F.col("salts")).cast("int")).otherwise(0)
    runs = raw.join(busy, ["k", "day"], "left").withColumn("salt", salt).repartition(parts, "k", "day", "salt")
    runs = runs.groupBy("k", "day", "salt").agg(F.sort_array(F.flatten(F.collect_list("vals"))).alias("vals"))
    runs = bucketed(runs, "runs", ["k", "day", "salt"], parts)
    discard(raw)
    days = spans.select("k", "d0", "d1", F.explode(F.sequence("d0", "d1")).alias("day"))
    totals = days.join(sizes, ["k", "day"]).groupBy("k", "d0", "d1").agg(F.sum("n").alias("n"))
    state = totals.withColumn("q", F.explode(F.array(*map(F.lit, qs))))
    place = F.col("q") * (F.col("n") - 1)
    state = state.select(
        F.xxhash64("k", "d0", "d1", "q").alias("tid"), "k", "d0", "d1", "q", "n",
        F.floor(place).cast("bigint").alias("rank"), (place - F.floor(place)).alias("frac"), F.lit(0).cast("bigint").alias("below"), F.col("n").alias("active"),
        *(F.lit(None).cast("double").alias(c) for c in ("lo", "hi", "v0", "v1")),
    )
    state = cut(state, "select-0")
    turn, columns = 0, state.columns
    searching = F.col("v0").isNull() & (F.col("active") > few)
    while state.where(searching).limit(1).count():
        turn += 1
        two, r = (F.col("frac") > 0).cast("bigint"), F.col("rank") - F.col("below")
        open_ = state.where(searching).withColumn("two", two).withColumn("r", r)
        asked = _with_targets(runs, busy, open_).mapInArrow(_propose, "tid bigint, p double, c bigint, hidden bigint")
        w = Window.partitionBy("tid").orderBy("p")
        weight = asked.groupBy("tid", "p").agg(F.sum("c").alias("c"), F.sum("hidden").alias("hidden"))
        weight = weight.withColumn("upto", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("hidden", F.sum("hidden").over(Window.partitionBy("tid")))
        weight = weight.join(open_.select("tid", "r", "two"), "tid")
        sure_below, sure_above = F.col("upto") <= F.col("r") - F.col("hidden"), F.col("upto") - F.col("c") > F.col("r") + F.col("two") + F.col("hidden")
        picked = weight.groupBy("tid").agg(F.array(F.max(F.when(sure_below, F.col("p"))), F.min(F.when(F.col("upto") > F.col("r"), F.col("p"))), F.min(F.when(sure_above, F.col("p")))).alias("pivots"))
        pivots = open_.join(picked, "tid").withColumn("pivot", F.explode(F.array_distinct(F.array_compact("pivots")))).drop("pivots")
        counts = _with_targets(runs, busy, pivots, "pivot").mapInArrow(_count, "tid bigint, pivot double, lt bigint, eq bigint, max_lt double, min_gt double")
        counts = counts.groupBy("tid", "pivot").agg(F.sum("lt").alias("lt"), F.sum("eq").alias("eq"), F.max("max_lt").alias("max_lt"), F.min("min_gt").alias("min_gt"))
        c = counts.join(open_.select("tid", "r", "two"), "tid").withColumn("le", F.col("lt") + F.col("eq"))
        right, left = F.col("le") <= F.col("r"), F.col("lt") > F.col("r") + F.col("two")
        here, edge = (F.col("lt") <= F.col("r")) & (F.col("r") < F.col("le")), (F.col("two") == 1) & (F.col("lt") == F.col("r") + 1)
        upper = F.when((F.col("two") == 1) & (F.col("r") + 1 >= F.col("le")), F.coalesce("min_gt", "pivot")).otherwise(F.col("pivot"))
        c = c.groupBy("tid").agg(
            F.max(F.when(right, F.col("pivot"))).alias("lo2"), F.coalesce(F.max(F.when(right, F.col("le"))), F.lit(0)).alias("gone"), F.min(F.when(left, F.col("pivot"))).alias("hi2"), F.min(F.when(left, F.col("lt"))).alias("kept"),
            F.max(F.when(here, F.col("pivot")).when(edge, F.col("max_lt"))).alias("w0"), F.max(F.when(here, upper).when(edge, F.col("pivot"))).alias("w1"),
        )
        s = open_.join(c, "tid").select(
            *(x for x in columns if x not in ("below", "active", "lo", "hi", "v0", "v1")), (F.col("below") + F.col("gone")).alias("below"), (F.coalesce("kept", "active") - F.col("gone")).alias("active"),
            F.coalesce("lo2", "lo").alias("lo"), F.coalesce("hi2", "hi").alias("hi"), F.col("w0").alias("v0"), F.col("w1").alias("v1"),
        )
        after = cut(state.where(~searching).unionByName(s.select(*columns)), f"select-{turn}")
        discard(state)
        state = after
    rest = state.where("v0 is null")
    few_values = _with_targets(runs, busy, rest).mapInArrow(_gather, "tid bigint, vs array<double>")
    few_values = few_values.groupBy("tid").agg(F.sort_array(F.flatten(F.collect_list("vs"))).alias("vs"))
    r = (F.col("rank") - F.col("below")).cast("int")
    ends = rest.join(few_values, "tid").withColumn("v0", F.get("vs", r)).withColumn("v1", F.when(F.col("frac") > 0, F.get("vs", r + 1)).otherwise(F.get("vs", r)))
    all_ = state.where("v0 is not null").unionByName(ends.select(*columns))
    return all_.select("k", "d0", "d1", "q", "n", (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")).alias("value"))


def span_percentiles(readings: DataFrame, outputs: DataFrame, qs: list[float], lowest: float = 0.0, highest: float = 120.0, few: int = FEW) -> DataFrame:
    """multi_select over the speeds of each sensor and span of days that `outputs` names (tmc_code, obs_start, obs_end).

    Null codes and dates and spans that end before they start name nothing; the same span named twice is one span.
    """
    spans = outputs.select(code("tmc_code").alias("k"), F.unix_date("obs_start").alias("d0"), F.unix_date("obs_end").alias("d1"))
    spans = spans.where("k is not null and d0 <= d1").distinct()
    blocks = value_blocks(clean_values(readings, "tmc_code", "measurement_tstamp", "speed", lowest, highest))
    return multi_select(blocks, spans, qs, few)


def misfit_outputs(readings: DataFrame, outputs: DataFrame, tolerance: float = 2.0, few: int = FEW) -> DataFrame:
    """Rows of outputs whose non-null p95 or p99 is more than tolerance from the exact one, with both exact values.

    A span without any reading fits by definition (there is nothing to differ from); so do rows with a null code or date.
    """
    p95, p99 = number("observed_speed_p95_mph"), number("observed_speed_p99_mph")
    asked = outputs.where(p95.isNotNull() | p99.isNotNull())
    got = span_percentiles(readings, asked, [0.95, 0.99], few=few)
    wide = got.groupBy("k", "d0", "d1").agg(F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("p95"), F.max(F.when(F.col("q") == 0.99, F.col("value"))).alias("p99"))
    named = asked.select(F.struct("*").alias("_row"), p95.alias("a95"), p99.alias("a99"), code("tmc_code").alias("k"), F.unix_date("obs_start").alias("d0"), F.unix_date("obs_end").alias("d1"))
    off = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) > tolerance + 1e-9, F.lit(False))
    rows = named.join(wide, ["k", "d0", "d1"]).where(off("a95", "p95") | off("a99", "p99"))
    return rows.select(*(F.col(f"_row.`{c}`") for c in outputs.columns if c not in ("p95", "p99")), "p95", "p99")
