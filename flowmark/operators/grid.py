"""Irregular readings onto a regular grid (problem 4).

Each plausible reading enters at its own time. A continuous-time local trend (level and damped slope) runs through the readings
of a stretch of service, and is smoothed and evaluated at the middle of every slot. What the readings between two middles say is
first condensed to one conditional Gaussian, for the i-th readings of all such intervals together; then many stretches are
smoothed together as columns of one array, so the Python loops run over time steps and places in a slot, not over rows.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmark.session import code, micros, number

LOWEST, HIGHEST = 0.0, 120.0  # speeds outside count as present but are not believed
PHI = float(np.exp(-1 / 8))  # what is left of the slope after one slot
PRIOR = 10.0  # forecasts that count as expected, against few seen ones
CELLS = 400_000  # cells smoothed at once
GRID_SCHEMA = "tmc_code string, slot_s bigint, n_readings bigint, missing boolean, speed_mean double, speed_smooth double, speed_sd double"


def _noise(slot, n, s1, s2) -> tuple[float, float]:
    """Observation variance r and slope variance q of a source, from medians, so that spikes don't count."""
    m = s1 / np.maximum(n, 1)
    many = n >= 2
    var = (s2[many] - s1[many] ** 2 / n[many]) / (n[many] - 1)
    good = n > 0
    sl, y, w = slot[good], m[good], n[good]
    near = np.flatnonzero((np.diff(sl)[:-1] == 1) & (np.diff(sl)[1:] == 1)) if len(sl) > 2 else np.array([], int)
    bend = np.abs(y[near + 2] - 2 * y[near + 1] + y[near]) if len(near) else np.array([])
    total = (1.4826 * np.median(bend)) ** 2 if len(bend) >= 5 else 25.0
    r = np.median(np.maximum(var, 0)) * 1.3 if len(var) >= 10 else total / 8 * (np.median(w) if len(w) else 1)
    r = float(np.clip(r, 0.25, 100.0))
    return r, float(np.clip(total - 6 * r / (np.median(w) if len(w) else 1), 0.05, 25.0))


def transition(dt):
    """Of the state (level, slope) over dt slots: what the level takes from the slope, what is left of the slope, and the covariance (00, 01, 11) that a slope variance of 1 a slot adds."""
    left = np.exp(-dt / 8)
    return 8 * (1 - left), left, 64 * (dt - 16 * (1 - left) + 4 * (1 - left * left)), 32 * (1 - left) ** 2, 4 * (1 - left * left)


#: What condense() says of an interval: the state at its end given that at its start (matrix, shift, covariance), and the readings'
#: likelihood of the state at its start (vector, matrix), their squared errors were that state zero, and their number.
PARTS = A00, A01, A10, A11, B0, B1, C00, C01, C11, E0, E1, J00, J01, J11, SQUARES, SEEN = range(16)


def nothing(q):
    """condense() without readings."""
    gain, left, c00, c01, c11 = transition(1.0)
    z = np.zeros_like(q)
    return np.stack([z + 1, z + gain, z, z + left, z, z, c00 * q, c01 * q, c11 * q, z, z, z, z, z, z, z])


def condense(place, value, begin, count, r, q):
    """PARTS by interval, whose readings lie at place[begin : begin + count] (0 to 1, in order); r and q by interval. Most readings first."""
    n = len(begin)
    x = np.zeros((16, n))
    x[A00] = x[A11] = 1.0
    at = np.zeros(n)

    def forward(m, dt):
        y = x[:, :m]
        gain, left, c00, c01, c11 = transition(dt)
        u = y[C01] + gain * y[C11]
        y[C00] += gain * (y[C01] + u) + c00 * q[:m]
        y[C01], y[C11] = left * u + c01 * q[:m], left * left * y[C11] + c11 * q[:m]
        for level, slope in ((A00, A10), (A01, A11), (B0, B1)):
            y[level] += gain * y[slope]
            y[slope] *= left

    for i in range(int(count[0]) if n else 0):
        m = int(np.searchsorted(-count, -i))
        here = place[begin[:m] + i]
        forward(m, here - at[:m])
        at[:m] = here
        y = x[:, :m]
        s, e = y[C00] + r[:m], value[begin[:m] + i] - y[B0]
        k0, k1 = y[C00] / s, y[C01] / s
        a, b = y[A00].copy(), y[A01].copy()
        y[E0] += a * e / s
        y[E1] += b * e / s
        y[J00] += a * a / s
        y[J01] += a * b / s
        y[J11] += b * b / s
        y[SQUARES] += e * e / s
        for level, slope, h in ((A00, A10, a), (A01, A11, b), (B0, B1, -e)):
            y[level] -= k0 * h
            y[slope] -= k1 * h
        y[C11] -= k1 * y[C01]
        y[C01] -= k0 * y[C01]
        y[C00] -= k0 * y[C00]
    forward(n, 1.0 - at)
    x[SEEN] = count
    return x


def posterior(parts, m0, misfit: list | None = None):
    """Level and its standard deviation at the start of each interval; parts: (intervals, PARTS, series), m0: level expected at the first start.

    What is appended to `misfit` is, per series, the mean square of its forecast errors in the standard deviations expected of
    them (the mean of an interval counted up to three), drawn to one where few were seen.
    """
    steps, _, n = parts.shape
    total, times = np.full(n, PRIOR), np.full(n, PRIOR)
    m0, m1 = m0.copy(), np.zeros(n)
    p00, p01, p11 = np.full(n, 50.0), np.zeros(n), np.full(n, 4.0)
    keep = np.empty((steps, 5, n))
    pred = np.empty((steps, 5, n))
    for t in range(steps):
        x = parts[t]
        pred[t] = m0, m1, p00, p01, p11
        if x[SEEN].any():
            j00, j01, j11 = x[J00], x[J01], x[J11]
            # the inverse of one plus covariance times information
            a, b, c, d = 1 + p00 * j00 + p01 * j01, p00 * j01 + p01 * j11, p01 * j00 + p11 * j01, 1 + p01 * j01 + p11 * j11
            det = a * d - b * c
            v0, v1 = x[E0] - j00 * m0 - j01 * m1, x[E1] - j01 * m0 - j11 * m1
            w00, w01, w11 = (d * p00 - b * p01) / det, (d * p01 - b * p11) / det, (a * p11 - c * p01) / det
            if t and misfit is not None:
                far = x[SQUARES] - m0 * (x[E0] + v0) - m1 * (x[E1] + v1) - (v0 * (w00 * v0 + w01 * v1) + v1 * (w01 * v0 + w11 * v1))
                seen = x[SEEN] > 0
                total += np.where(seen, np.clip(far / np.maximum(x[SEEN], 1), 0.0, 9.0), 0.0)
                times += seen
            m0, m1 = m0 + w00 * v0 + w01 * v1, m1 + w01 * v0 + w11 * v1
            p00, p01, p11 = w00, w01, w11
        keep[t] = m0, m1, p00, p01, p11
        g00, g01, g10, g11 = x[A00] * p00 + x[A01] * p01, x[A00] * p01 + x[A01] * p11, x[A10] * p00 + x[A11] * p01, x[A10] * p01 + x[A11] * p11
        m0, m1 = x[A00] * m0 + x[A01] * m1 + x[B0], x[A10] * m0 + x[A11] * m1 + x[B1]
        p00, p01, p11 = g00 * x[A00] + g01 * x[A01] + x[C00], g00 * x[A10] + g01 * x[A11] + x[C01], g10 * x[A10] + g11 * x[A11] + x[C11]
    if misfit is not None:
        misfit.append(total / times)
    level, var = np.empty((steps, n)), np.empty((steps, n))
    s0, s1, c00, c01, c11 = keep[-1]
    level[-1], var[-1] = s0, c00
    for t in range(steps - 2, -1, -1):
        f0, f1, a, b, c = keep[t]
        u0, u1, x, z, v = pred[t + 1]
        y = parts[t]
        det = np.maximum(x * v - z * z, 1e-12)
        # the covariance times the transposed matrix times the inverse of the prediction's covariance
        g00, g01, g10, g11 = a * y[A00] + b * y[A01], a * y[A10] + b * y[A11], b * y[A00] + c * y[A01], b * y[A10] + c * y[A11]
        j00, j01 = (g00 * v - g01 * z) / det, (g01 * x - g00 * z) / det
        j10, j11 = (g10 * v - g11 * z) / det, (g11 * x - g10 * z) / det
        d0, d1 = s0 - u0, s1 - u1
        e00, e01, e11 = c00 - x, c01 - z, c11 - v
        s0, s1 = f0 + j00 * d0 + j01 * d1, f1 + j10 * d0 + j11 * d1
        t0, t1 = e00 * j00 + e01 * j01, e01 * j00 + e11 * j01
        r0, r1 = e00 * j10 + e01 * j11, e01 * j10 + e11 * j11
        c00, c01, c11 = a + j00 * t0 + j01 * t1, b + j10 * t0 + j11 * t1, c + j10 * r0 + j11 * r1
        level[t], var[t] = s0, c00
    return level, np.sqrt(np.maximum(var, 0))


def smooth_panel(y, w, off, r, q):
    """posterior() of a (steps, series) panel with one observation a slot; w: weight (0 where nothing was seen), off: place in the slot."""
    steps, n = y.shape
    parts = np.zeros((steps, 16, n))
    parts[:, A00], parts[:, A01], parts[:, A11] = 1.0, (1 - PHI) * 8, PHI
    parts[:, C00], parts[:, C01], parts[:, C11] = q / 3, q / 2, q
    s = np.where(w > 0, r / np.where(w > 0, w, 1) + q * np.abs(off) ** 3 / 3, np.inf)
    for part, c in ((E0, y), (E1, off * y), (J00, 1.0), (J01, off), (J11, off * off), (SQUARES, y * y)):
        parts[:, part] = c / s
    parts[:, SEEN] = w > 0
    return posterior(parts, y[0])


def _starts(*columns):
    """Where the first of equal successive rows of sorted columns stand."""
    return np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in columns], axis=0)]) if len(columns[0]) else np.array([], int)


def _slots(codes, us, v, width):
    """Per source and slot: number of readings, and of the plausible ones number, sum and sum of squares."""
    cell = us // width
    top = _starts(codes, cell)
    ok = (v >= LOWEST) & (v <= HIGHEST)
    sums = lambda x: np.add.reduceat(np.where(ok, x, 0.0), top)
    return codes[top], cell[top], np.diff(np.r_[top, len(codes)]), sums(1.0).astype("int64"), sums(v), sums(v * v)


def _smooth(keys, chunks, step, longest):
    """Record batches of the grid of complete sources. chunks() yields codes, times and values, sorted by source and time; a chunk ends at a slot's middle or with a source."""
    width = step * 1_000_000
    codes, slot, n, n_ok, s1, s2 = (np.concatenate(x) for x in zip(*(_slots(*c, width) for c in chunks())))
    top = _starts(codes, slot)  # two chunks may share a slot
    codes, slot, n, n_ok, s1, s2 = codes[top], slot[top], *(np.add.reduceat(x, top) for x in (n, n_ok, s1, s2))
    change = _starts(codes)
    ends = np.r_[change[1:], len(codes)]
    noise = np.array([_noise(slot[a:b], n_ok[a:b], s1[a:b], s2[a:b]) for a, b in zip(change, ends)])
    brk = np.r_[True, (codes[1:] != codes[:-1]) | (np.diff(slot) - 1 > longest)]
    first = np.flatnonzero(brk)
    last = np.r_[first[1:], len(slot)] - 1
    length = slot[last] - slot[first] + 1
    r, q = noise[np.searchsorted(change, first, "right") - 1].T
    # readings by the interval between the middles of slots that they lie in; interval 0 of a stretch ends at its first slot's middle
    stretch_of_slot, base, found = np.cumsum(brk) - 1, 0, []
    for c, us, v in chunks():
        cell = us // width
        same = np.r_[False, (c[1:] == c[:-1]) & (cell[1:] == cell[:-1])]
        base += int((codes[base], slot[base]) != (c[0], cell[0]))
        at_slot = base + np.cumsum(~same) - 1
        base = int(at_slot[-1])
        ok = (v >= LOWEST) & (v <= HIGHEST)
        stretch, place, v = stretch_of_slot[at_slot[ok]], (us[ok] - cell[ok] * width) / width + 0.5, v[ok]
        later = place >= 1
        interval, place = cell[ok] - slot[first[stretch]] + later, place - later
        begin = _starts(stretch, interval)
        count = np.diff(np.r_[begin, len(v)])
        by = np.argsort(-count, kind="stable")
        begin, count = begin[by], count[by]
        own = stretch[begin]
        found.append((own, interval[begin], condense(place, v, begin, count, r[own], q[own]).T))
    of_stretch, interval, condensed = (np.concatenate(x) for x in zip(*found))
    items = np.argsort(of_stretch, kind="stable")
    from_item = np.searchsorted(of_stretch[items], np.arange(len(first) + 1))
    by = np.argsort(length, kind="stable")
    at = 0
    while at < len(by):
        more = at + 1
        while more < len(by) and (length[by[more]] + 1) * (more + 1 - at) <= CELLS:
            more += 1
        part = by[at:more]
        at = more
        steps, cols = int(length[part[-1]]), len(part)
        y, w, m0 = np.zeros((steps, cols)), np.zeros((steps, cols), "int64"), np.zeros(cols)
        count_all = np.zeros((steps, cols), "int64")
        parts = np.empty((steps + 1, 16, cols))
        parts[:] = nothing(q[part])
        for c, i in enumerate(part):
            rows = slice(first[i], last[i] + 1)
            to = slot[rows] - slot[first[i]]
            y[to, c], w[to, c], count_all[to, c] = s1[rows] / np.maximum(n_ok[rows], 1), n_ok[rows], n[rows]
            seen = np.flatnonzero(n_ok[rows])
            m0[c] = y[to[seen[0]], c] if len(seen) else 0.0  # start from the first believed value
            own = items[from_item[i] : from_item[i + 1]]
            parts[interval[own], :, c] = condensed[own]
        misfit: list = []
        level, sd = posterior(parts, m0, misfit)
        level, sd = level[1:], sd[1:] * np.sqrt(np.maximum(misfit[0], 1.0))  # a common factor of both variances leaves the level as it is
        none = w.sum(axis=0) == 0
        inside = np.arange(steps)[:, None] < length[part][None, :]
        tt, cc = np.nonzero(inside.T)[::-1]
        which = part[cc]
        unseen = none[cc]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys).take(pa.array(codes[first[which]])),
                pa.array((slot[first[which]] + tt) * step),
                pa.array(count_all[tt, cc]),
                pa.array(count_all[tt, cc] == 0),
                pa.array(y[tt, cc], mask=w[tt, cc] == 0),
                pa.array(np.clip(level[tt, cc], LOWEST, HIGHEST), mask=unseen),
                pa.array(sd[tt, cc], mask=unseen),
            ],
            names=["tmc_code", "slot_s", "n_readings", "missing", "speed_mean", "speed_smooth", "speed_sd"],
        )


class _Spool:
    """Readings of one source that are too many to hold: a file of the task, read in chunks that end at slots' middles."""

    def __init__(self, kept: list[pa.RecordBatch], width: int, size: int):
        self.key, self.width, self.size = kept[0]["k"][0].as_py(), width, size
        self.file = tempfile.TemporaryFile()
        self.writer = pa.ipc.new_stream(self.file, pa.schema([("us", pa.int64()), ("v", pa.float64())]))
        for b in kept:
            self.add(b)

    def add(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """What follows the source's rows."""
        n = batch.num_rows if batch["k"][-1].as_py() == self.key else int(np.argmin(pc.equal(batch["k"], self.key).to_numpy(zero_copy_only=False)))
        self.writer.write_batch(batch.select(["us", "v"]).slice(0, n))
        return batch.slice(n)

    def chunks(self):
        self.file.seek(0)
        us, v = [], []
        for b in pa.ipc.open_stream(self.file):
            us.append(b["us"].to_numpy())
            v.append(b["v"].to_numpy())
            if sum(map(len, us)) >= self.size:
                x, y = np.concatenate(us), np.concatenate(v)
                stop = int(np.searchsorted(x, (x[-1] + self.width // 2) // self.width * self.width - self.width // 2))
                if stop:
                    yield np.zeros(stop, "int64"), x[:stop], y[:stop]
                us, v = [x[stop:]], [y[stop:]]
        yield np.zeros(sum(map(len, us)), "int64"), np.concatenate(us), np.concatenate(v)

    def close(self, step: int, longest: int):
        self.writer.close()
        yield from _smooth(pa.array([self.key]), self.chunks, step, longest)
        self.file.close()


def _grid(step: int, longest: int, hold: int = 150_000, most: int = 2_000_000):
    """hold: rows that are smoothed together, most: rows of one source that are held."""

    def run(batches):
        kept: list[pa.RecordBatch] = []
        rows, full, spool = 0, hold, None

        def work(t: pa.Table, final: bool):
            d = t["k"].combine_chunks().dictionary_encode()
            d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
            codes = d.indices.to_numpy()
            stop = len(codes) if final else int(np.flatnonzero(codes != codes[-1])[-1] + 1) if (codes != codes[-1]).any() else 0
            if stop:
                yield from _smooth(d.dictionary, lambda: [(codes[:stop], t["us"].to_numpy()[:stop], t["v"].to_numpy()[:stop])], step, longest)
            return t.slice(stop)

        for b in batches:
            if spool and b.num_rows:
                b = spool.add(b)
                if b.num_rows:
                    yield from spool.close(step, longest)
                    spool = None
            if not b.num_rows:
                continue
            kept.append(b)
            rows += b.num_rows
            if rows >= full:
                rest = yield from work(pa.Table.from_batches(kept), False)
                kept, rows = rest.to_batches(), rest.num_rows
                full = max(hold, min(2 * rows, most))  # a long source is looked at a few times only
                if rows >= most:
                    spool, kept, rows, full = _Spool(kept, step * 1_000_000, most), [], 0, hold
        if spool:
            yield from spool.close(step, longest)
        if kept and (t := pa.Table.from_batches(kept)).num_rows:
            yield from work(t, True)

    return run


def regular_grid(df: DataFrame, key: str = "tmc_code", ts: str = "measurement_tstamp", value: str = "speed", step: int = 900, longest_gap: int = 192) -> DataFrame:
    """One row per source and slot of `step` seconds from its first to its last non-null value, GRID_SCHEMA.

    missing marks slots without a value; speed_smooth and speed_sd (its standard deviation) are there for all, from
    readings that enter each at its own time. More than `longest_gap` successive empty slots are a break in service: they have
    no rows, and the smoother starts anew after them.
    Rows with a null source, time or value are left out; repeated readings count in n_readings only as further readings;
    values outside 0 to 120 make a slot present but don't enter the means. An empty table gives an empty grid.
    """
    base = df.select(code(key).alias("k"), micros(ts).alias("us"), number(value).alias("v")).where("k is not null and us is not null and v is not null")
    return base.repartition("k").sortWithinPartitions("k", "us").mapInArrow(_grid(step, longest_gap), GRID_SCHEMA)
