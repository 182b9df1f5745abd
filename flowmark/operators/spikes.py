"""Implausible spikes in measurements (problem 7).

Per source the series of distinct readings is decomposed robustly: a daily season (medians by time of day), a local trend
(lines through the next readings of either side, continued to the suspected group, which is left out of them) and a
remainder, the smaller of the two deviations from the trend. Generalised extreme studentised deviate limits on the
remainders of the whole source pick the outlying readings; of these, groups of at most three successive ones are spikes if
they also stand apart from the line across them by eight times the source's usual reading-to-reading scatter. Runs of one
unchanged value and readings outside the physical range are found separately.

Everything that describes a source (scatter, usual interval, season, limit) is made over all its readings from rounded values.
A source of many readings is scanned in shards of equal numbers of readings with an overlap that is longer than anything the
scan looks at, and described by mergeable exact counts; the others are described where they are scanned, by the same rules.
So the result doesn't depend on how a source is split.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import code, cut, micros, number

LOWEST, HIGHEST = 0.0, 120.0
TIMES = 8.0  # a group stands apart by TIMES scatters from the line across it
ALPHA = 0.01  # level of the generalised ESD test
SHARE = 5  # at most one reading in SHARE is taken for an outlier
NOISE = 1.4826 / 2**0.5  # standard deviation of a remainder in scatters: a difference of two readings has twice its variance
LEVEL, LEAST_LEVEL = 5, 3  # the trend of a side is a line through its next LEVEL readings, a level if fewer than four, none if fewer than LEAST_LEVEL
LONGEST_SPIKE, LEAST_RUN = 3, 12
QUIET_S = 7200.0  # readings further apart than this (or 8 usual intervals) aren't around each other
FLOOR = 0.2  # mph, the least scatter
SLOTS = 48  # of the daily season
WATCHED = 2.5  # remainders of more scatters than this are ranked for the limits; no limit of 20 or more readings lies below
FINE = 16  # limits are found to 1/FINE of a scatter
HOT = 100_000  # a source with more distinct readings is scanned in shards of this many
HALO = 120  # distinct readings of overlap on either side: LEVEL + LONGEST_SPIKE readings, each at most LEAST_RUN from the next, and more
LISTED = 100_000  # names of split sources are broadcast only up to this many
SPIKE_SCHEMA = "reading_id bigint, tmc_code string, speed double, kind string, deviation double"


def esd_limits(n: int, most: int, alpha: float = ALPHA) -> np.ndarray:
    """Critical values of the generalised ESD test for the 1st to the most-th outlier among n."""
    i = np.arange(1, most + 1)
    df = np.maximum(n - i - 1, 1).astype(float)
    z = np.array([NormalDist().inv_cdf(1 - alpha / (2 * max(n - k + 1, 2))) for k in i[:: max(1, most // 64)]])
    z = np.interp(i, i[:: max(1, most // 64)], z)
    t = z + (z**3 + z) / (4 * df) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * df**2)  # Student's quantile by its expansion in 1/df
    return np.maximum(n - i, 1) * t / np.sqrt((df + t * t) * np.maximum(n - i + 1, 1))


def esd_limit(n: Column, i: Column, alpha: float = ALPHA) -> Column:
    """The same for the i-th outlier as an expression; the normal quantile by its rational approximation (error below 0.0005)."""
    n, i = n.cast("double"), i.cast("double")
    df = F.greatest(n - i - 1, F.lit(1.0))
    once = lambda x, f: F.transform(F.array(x), f)[0]  # noqa: E731  names x for f, which uses it more than once
    tail = F.sqrt(-2 * F.log(F.lit(alpha) / (2 * F.greatest(n - i + 1, F.lit(2.0)))))
    normal = lambda r: r - (2.515517 + r * (0.802853 + r * 0.010328)) / (1 + r * (1.432788 + r * (0.189269 + r * 0.001308)))
    student = lambda z: z + z * (z * z + 1) / (4 * df) + z * ((5 * z * z + 16) * z * z + 3) / (96 * df * df)
    return F.greatest(n - i, F.lit(1.0)) * once(once(once(tail, normal), student), lambda t: t / F.sqrt((df + t * t) * F.greatest(n - i + 1, F.lit(1.0))))


def season_at(t: np.ndarray, medians: np.ndarray | None) -> np.ndarray:
    """The smooth time-of-day effect at times t (seconds), from the medians of the day's SLOTS; zero without them."""
    if medians is None:
        return np.zeros(len(t))
    med = np.where(np.isnan(medians), np.nanmedian(medians), medians)
    ring = np.r_[med[-2:], med, med[:2]]
    smooth = np.median(sliding_window_view(ring, 5), axis=1)
    smooth = (np.r_[smooth[-1], smooth[:-1]] + 2 * smooth + np.r_[smooth[1:], smooth[0]]) / 4
    wide = 86400 // SLOTS
    return np.interp(t % 86400, np.arange(-1, SLOTS + 1) * wide + wide / 2, np.r_[smooth[-1], smooth, smooth[0]]) - np.median(smooth)


def _side(t: np.ndarray, x: np.ndarray, stretch: np.ndarray, at: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level, its time, slope) of the trend on one side: the next LEVEL readings from `at` on, within its stretch; NaN levels where there are too few."""
    i = at[:, None] + way * np.arange(LEVEL)
    inside = (i >= 0) & (i < len(x))
    i = np.clip(i, 0, len(x) - 1)
    inside &= stretch[i] == stretch[at][:, None]
    y, s, n = np.where(inside, x[i], np.nan), np.where(inside, t[i], np.nan), inside.sum(axis=1)
    full = n == LEVEL
    level, mid, slope = np.full(len(at), np.nan), np.full(len(at), np.nan), np.zeros(len(at))
    level[full], mid[full] = np.median(y[full], axis=1), np.median(s[full], axis=1)
    slope[full] = np.median(np.diff(y[full], axis=1) / np.diff(s[full], axis=1), axis=1)
    for j in np.flatnonzero(~full & (n >= LEAST_LEVEL)):
        level[j], mid[j] = np.median(y[j, : n[j]]), np.median(s[j, : n[j]])
        slope[j] = np.median(np.diff(y[j, : n[j]]) / np.diff(s[j, : n[j]])) if n[j] >= 4 else 0.0
    return level, mid, slope


def remainders(t: np.ndarray, v: np.ndarray, at: np.ndarray, scatter: float, quiet: float, season: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder, deviation, remainder of it) per reading, all in scatters and 0 where there is none.

    The first is the largest over the groups of at most three that hold the reading, of the smallest remainder within the
    group. The others are those of the group that stands apart from the line across it by more than TIMES, if there is one.
    t: seconds ascending; v: plausible values; at: their places in the series with all others, where a jump of more than
    LEAST_RUN parts the series as a silence does.
    """
    n = len(v)
    rem, dev, own = np.zeros(n), np.zeros(n), np.zeros(n)
    if n < 4:
        return rem, dev, own
    s = max(scatter, FLOOR)
    free = v - season
    stretch = np.r_[0, np.cumsum((np.diff(t) > quiet) | (np.diff(at) > LEAST_RUN))]

    def note(group: np.ndarray, r: np.ndarray, d: np.ndarray):
        np.maximum.at(rem, group, r)
        far = d > TIMES
        np.maximum.at(dev, group[far], d[far])
        np.maximum.at(own, group[far], r[far])

    levels = {way: _side(t, free, stretch, np.arange(n), way) for way in (-1, 1)}
    for size in range(1, LONGEST_SPIKE + 1):
        left = np.arange(0, n - size - 1)
        left = left[stretch[left] == stretch[left + size + 1]]
        right = left + size + 1
        if not len(left):
            continue
        sign = np.sign(v[left + 1] - (v[left] + (v[right] - v[left]) * (t[left + 1] - t[left]) / (t[right] - t[left])))
        r, d = np.full(len(left), np.inf), np.full(len(left), np.inf)
        for k in range(1, size + 1):
            i = left + k
            d = np.minimum(d, sign * (v[i] - (v[left] + (v[right] - v[left]) * (t[i] - t[left]) / (t[right] - t[left]))))
            for side, way in ((left, -1), (right, 1)):
                level, mid, slope = (x[side] for x in levels[way])
                known = ~np.isnan(level)
                off = np.where(known, sign * (free[i] - (np.where(known, level, 0) + slope * (t[i] - np.where(known, mid, 0)))), np.inf)
                r = np.minimum(r, np.minimum(off, sign * (v[i] - v[side])))
        for k in range(1, size + 1):
            note(left + k, np.maximum(r, 0) / s, np.maximum(d, 0) / s)
    # beside a long silence there is one side only; stretches too short for a trend are judged by the levels across the silences
    starts = np.flatnonzero(np.r_[True, np.diff(stretch) > 0])
    stops = np.r_[starts[1:], n]
    for a, b in zip(starts, stops):
        before = np.flatnonzero(at[a] - at[max(0, a - LEVEL) : a] <= 3 * LEAST_RUN) + max(0, a - LEVEL)
        after = np.flatnonzero(at[b : b + LEVEL] - at[b - 1] <= 3 * LEAST_RUN) + b
        for way in (1, -1):
            order = np.arange(a, b) if way == 1 else np.arange(a, b)[::-1]
            for size in range(1, min(LONGEST_SPIKE, b - a) + 1):
                group, near = order[:size], order[size : size + LEVEL]
                if len(near) >= LEAST_LEVEL:
                    level, mid, slope = (x[near[0]] for x in levels[way])
                    offs = [v[group] - np.median(v[near]), free[group] - (level + slope * (t[group] - mid))]
                    least = [v[group] - v[near[0]]]
                else:
                    offs = [v[group] - np.median(v[x]) for x in (before, after) if len(x) >= LEAST_LEVEL]
                    least = [v[group] - v[near[0]]] if len(near) else []
                if not offs:
                    continue
                sign = np.sign(offs[0][0])
                d = min((sign * x).min() for x in offs)
                r = min([d, *((sign * x).min() for x in least)])
                note(group, np.full(size, max(r, 0.0)) / s, np.full(size, max(d, 0.0)) / s)
    return rem, dev, own


def _runs(v: np.ndarray) -> np.ndarray:
    """Length of the run of one value that each reading is in."""
    first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    length = np.diff(np.r_[first, len(v)])
    return np.repeat(length, length)


def _middle(x: np.ndarray, digits: int) -> float:
    """The median of x rounded to so many digits, NaN without values."""
    return float(np.median(np.floor(x * 10.0**digits + 0.5) / 10.0**digits)) if len(x) else float("nan")


def describe(t: np.ndarray, v: np.ndarray) -> tuple[float, int, float, np.ndarray | None]:
    """(scatter, n, quiet, medians) of a whole source, as source_scatters and source_seasons give them; t in microseconds."""
    sane = (v >= LOWEST) & (v <= HIGHEST)
    new = np.flatnonzero(t[1:] != t[:-1]) + 1
    both = new[sane[new] & sane[new - 1]]
    scatter = _middle(np.abs(v[both] - v[both - 1]), 3)
    gap = _middle(np.minimum((t[new] - t[new - 1]) / 10_000_000, 8640.0), 0)
    quiet = QUIET_S if np.isnan(gap) else max(QUIET_S, 80 * gap)
    day, medians = t[sane] // 86_400_000_000, None
    if len(day) >= 96 and day.max() - day.min() >= 2:
        x, slot = np.floor(v[sane] * 10 + 0.5) / 10, t[sane] % 86_400_000_000 // (86_400_000_000 // SLOTS)
        order = np.lexsort((x, slot))
        n = np.bincount(slot, minlength=SLOTS)
        start = np.cumsum(n) - n
        x, has = x[order], n > 0
        medians = np.full(SLOTS, np.nan)
        medians[has] = 0.5 * x[(start + (n - 1) // 2)[has]] + 0.5 * x[(start + n // 2)[has]]
    return 1.0 if np.isnan(scatter) else scatter, len(both), quiet, medians


def _judge(t, v, halo, scatter, quiet, medians):
    """(rows, kinds, remainders, deviations, own remainders, first deliveries) of what is stuck, impossible or watched in one shard, whose rows are sorted by time, then id."""
    first = np.r_[True, t[1:] != t[:-1]]  # a re-delivery has the time of the reading
    group = np.cumsum(first) - 1
    dt, dv = t[first] / 1e6, v[first]
    stuck = _runs(dv) >= LEAST_RUN
    sane = (dv >= LOWEST) & (dv <= HIGHEST)
    moving = np.flatnonzero(sane & ~stuck)  # what is stuck is no traffic to compare with
    found = np.zeros((3, len(dv)))
    found[:, moving] = remainders(dt[moving], dv[moving], moving, scatter, quiet, season_at(dt[moving], medians))
    kind = np.where(found[0][group] > WATCHED, "watched", None)
    kind[stuck[group]] = "stuck"
    kind[(v < LOWEST) | (v > HIGHEST) | ~sane[group]] = "impossible"
    keep = np.flatnonzero((kind != None) & ~halo)  # noqa: E711
    return keep, kind[keep], *(x[group][keep] for x in found), first[keep]


_SCANNED = "reading_id bigint, tmc_code string, speed double, n bigint, kind string, remainder double, deviation double, own double, fresh boolean"


def _scan(whole: bool, seasonal: bool, hold: int = 200_000):
    """A scan of sorted sources, which describes them itself if they are `whole`."""

    def run(batches):
        kept: list[pa.RecordBatch] = []
        rows = 0

        def work(tab: pa.Table, final: bool):
            k = tab["k"].combine_chunks().dictionary_encode()
            codes, shard = k.indices.to_numpy(), tab["shard"].to_numpy()
            change = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (shard[1:] != shard[:-1])])
            ends = np.r_[change[1:], len(codes)]
            if not final:
                change, ends = change[:-1], ends[:-1]
            t, v, halo = (tab[c].to_numpy() for c in ("us", "v", "halo"))
            if not whole:
                scatter, quiet, n, medians = tab["scatter"].to_numpy(), tab["quiet"].to_numpy(), tab["n"].to_numpy(), tab["medians"].combine_chunks()
            out = []
            for a, b in zip(change, ends):
                if whole:
                    about = describe(t[a:b], v[a:b])
                    about = about if seasonal else (*about[:3], None)
                else:
                    season = medians[int(a)].as_py()
                    about = scatter[a], n[a], quiet[a], None if season is None else np.array(season, float)
                got = _judge(t[a:b], v[a:b], halo[a:b], about[0], about[2], about[3])
                if len(got[0]):
                    out.append((got[0] + a, *got[1:], np.full(len(got[0]), about[1], "int64")))
            if out:
                at, kind, rem, dev, own, fresh, size = (np.concatenate(x) for x in zip(*out))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [tab["reading_id"].combine_chunks().take(rows), k.take(rows).cast(pa.string()), pa.array(v[at]), pa.array(size), pa.array(kind, pa.string()), pa.array(rem), pa.array(dev), pa.array(own), pa.array(fresh)],
                    names=[x.split()[0] for x in _SCANNED.split(", ")],
                )
            return tab.slice(int(ends[-1]) if len(ends) else 0)

        for b in batches:
            kept.append(b)
            rows += b.num_rows
            if rows >= hold:
                rest = yield from work(pa.Table.from_batches(kept), False)
                kept, rows = rest.to_batches(), 0
        if kept and (tab := pa.Table.from_batches(kept)).num_rows:
            yield from work(tab, True)

    return run


def busy_sources(rows: DataFrame, hot: int) -> tuple[DataFrame, int]:
    """Names (k) of the sources with more than `hot` rows, and their number."""
    if hot < 2 * HALO:
        raise ValueError(f"hot must be {2 * HALO} at least")
    busy = cut(rows.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("k"), "busy")
    n = busy.count()
    return F.broadcast(busy) if n <= LISTED else busy, n


def split_sources(rows: DataFrame, hot: int) -> DataFrame:
    """rows (k, us, v, reading_id) in shards of `hot` distinct times per source, overlapping by HALO: with `shard` and `halo`.

    The place of a time in its source is its place in the day, ranked per source and day, after the number of times on the
    days before; so no source is sorted as a whole. Rows of the overlap come twice, once as halo.
    """
    day = F.floor(F.col("us") / 86_400_000_000)
    parts = rows.withColumn("day", day).withColumn("place", F.dense_rank().over(Window.partitionBy("k", "day").orderBy("us")))
    days = parts.groupBy("k", "day").agg(F.max("place").alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("k").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per day of a source
    place = F.col("before") + F.col("place") - 1
    parts = parts.join(days.select("k", "day", before.alias("before")), ["k", "day"]).withColumn("shard", F.floor(place / hot).cast("int")).withColumn("within", place % hot)
    side = lambda when, by: F.when(when, F.struct((F.col("shard") + by).alias("shard"), F.lit(True).alias("halo")))
    copies = F.array_compact(F.array(F.struct("shard", F.lit(False).alias("halo")), side((F.col("within") < HALO) & (F.col("shard") > 0), -1), side(F.col("within") >= hot - HALO, 1)))
    return parts.select("k", "us", "v", "reading_id", F.explode(copies).alias("x")).select("k", "us", "v", "reading_id", "x.shard", "x.halo")


def source_seasons(rows: DataFrame) -> DataFrame:
    """k, medians (by half hour of the day, of values rounded to tenths) of the sources with 96 plausible values or more over at least three days."""
    slot = F.floor(F.pmod(F.col("us"), F.lit(86_400_000_000)) / (86_400_000_000 // SLOTS)).cast("int")
    day = F.floor(F.col("us") / 86_400_000_000)
    per = rows.where(F.col("v").between(LOWEST, HIGHEST)).groupBy("k", slot.alias("slot")).agg(F.percentile(F.floor(F.col("v") * 10 + 0.5) / 10, 0.5).alias("m"), F.count("*").alias("n"), F.min(day).alias("a"), F.max(day).alias("b"))
    per = per.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("slot", "m"))).alias("by"), F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"))  # SLOTS rows at most
    per = per.where("n >= 96 and b - a >= 2")
    return per.select("k", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.try_element_at("by", i)).alias("medians"))


def source_scatters(parts: DataFrame) -> DataFrame:
    """k, scatter (median difference of successive plausible readings, to a thousandth), n of these, quiet (seconds of silence that part the series)."""
    w = Window.partitionBy("k", "shard").orderBy("us", "reading_id")
    sane = F.when(F.col("v").between(LOWEST, HIGHEST), F.col("v"))
    new = F.lag("us").over(w) < F.col("us")
    rows = parts.withColumn("d", F.when(new, F.abs(sane - F.lag(sane).over(w)))).withColumn("gap", F.when(new, F.least((F.col("us") - F.lag("us").over(w)) / 10_000_000, F.lit(8640.0))))
    out = rows.where("not halo and gap is not null").groupBy("k").agg(F.percentile(F.floor(F.col("d") * 1000 + 0.5) / 1000, 0.5).alias("scatter"), F.count("d").alias("n"), F.percentile(F.floor(F.col("gap") + 0.5), 0.5).alias("gap"))
    return out.select("k", F.coalesce("scatter", F.lit(1.0)).alias("scatter"), "n", F.greatest(F.lit(QUIET_S), 80 * F.col("gap")).alias("quiet"))


def source_limits(watched: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """k, limit: the least remainder (in scatters) that the generalised ESD test takes for an outlier, of the sources with one.

    The i-th largest remainder is compared with the i-th critical value; the last that exceeds it and all above are outliers.
    Remainders are ranked by counts per 1/FINE of a scatter, so no source is sorted.
    """
    bins = watched.where("fresh").groupBy("tmc_code", F.floor(F.col("remainder") * FINE).alias("bin")).agg(F.count("*").alias("c"), F.max("n").alias("n"))
    ranked = bins.withColumn("i", F.sum("c").over(Window.partitionBy("tmc_code").orderBy(F.desc("bin"))))  # bins are bounded by the range of speeds
    over = ranked.where((F.col("i") <= F.greatest(F.floor(F.col("n") / SHARE), F.lit(1))) & (F.col("bin") / FINE / NOISE > esd_limit(F.col("n"), F.col("i"), alpha)))
    return over.groupBy("tmc_code").agg((F.min("bin") / FINE).alias("limit"))


def flag_implausible(df: DataFrame, row_id: str = "reading_id", key: str = "tmc_code", ts: str = "measurement_tstamp", value: str = "speed", hot: int = HOT, alpha: float = ALPHA, seasonal: bool = True) -> DataFrame:
    """The implausible rows of df, SPIKE_SCHEMA: kind is impossible, stuck or spike.

    Rows with a null source, time or value are skipped. Rows of one source and time are deliveries of one reading: the first
    by id stands for it in the series, and all share its flag. A source's scatter is the median absolute difference of
    successive plausible readings, 0.2 at least. An empty table gives none; ties are broken by row id. The result is the same
    for any `hot`. `seasonal` = False leaves the daily season out of the decomposition.
    """
    rows = df.select(code(key).alias("k"), micros(ts).alias("us"), number(value).alias("v"), F.col(row_id).alias("reading_id"))
    rows = rows.where("k is not null and us is not null and v is not null and reading_id is not null")
    names, n_busy = busy_sources(rows, hot)
    calm = (rows.join(names, "k", "left_anti") if n_busy else rows).withColumn("shard", F.lit(0)).withColumn("halo", F.lit(False))
    calm = calm.select("k", "shard", "us", "v", "reading_id", "halo").repartition("k").sortWithinPartitions("k", "us", "reading_id")
    scanned = calm.mapInArrow(_scan(True, seasonal), _SCANNED)
    if n_busy:
        busy = rows.join(names, "k", "left_semi")
        parts = split_sources(busy, hot).repartition("k", "shard")
        about = source_scatters(parts)
        about = about.join(source_seasons(busy), "k", "left") if seasonal else about.withColumn("medians", F.lit(None).cast("array<double>"))
        about = parts.select("k", "shard").distinct().join(about, "k", "left")  # by shard, so that the readings aren't gathered by source
        w = Window.partitionBy("k", "shard").orderBy("us", "reading_id")
        once = F.when(F.row_number().over(w) == 1, F.col("medians"))  # one season per shard is enough for the batch
        fill = [F.coalesce("scatter", F.lit(1.0)).alias("scatter"), F.coalesce("quiet", F.lit(QUIET_S)).alias("quiet"), F.coalesce("n", F.lit(0)).alias("n")]
        ordered = parts.join(about, ["k", "shard"], "left").select("k", "shard", "us", "v", "reading_id", "halo", *fill, once.alias("medians")).sortWithinPartitions("k", "shard", "us", "reading_id")
        scanned = scanned.unionByName(ordered.mapInArrow(_scan(False, seasonal), _SCANNED))
    found = cut(scanned, "scanned")
    limits = source_limits(found.where("kind = 'watched'"), alpha)
    judged = found.where("kind <> 'watched' or deviation > 0").join(limits, "tmc_code", "left")
    spike = (F.col("kind") == "watched") & (F.col("own") >= F.col("limit"))
    return judged.where((F.col("kind") != "watched") | spike).select("reading_id", "tmc_code", "speed", F.when(spike, "spike").otherwise(F.col("kind")).alias("kind"), "deviation")
