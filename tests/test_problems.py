"""Operators of problems 3 to 7 against brute force and on edge cases."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowmark.operators import grid, intervals, orphans, spikes, timestamps

E = datetime(1970, 1, 1)
us = lambda *a: int((datetime(*a) - E).total_seconds() * 1e6)

RAW = "raw_id bigint, feed_id string, measurement_tstamp string, tz_name int, _text string"
FEEDS = "feed_id string, tz_name string, date_order string, raw_id int"


def parsed(spark, texts):
    feeds = spark.createDataFrame([("ny", "America/New_York", "mdy", 1), ("ny", "America/New_York", "mdy", 2), ("de", "Europe/Berlin", "dmy", 1), ("u", "Etc/UTC", "ymd", 1), ("none", None, "ymd", 1), ("bad", "Mars/Base", "mdy", 1), ("blank", "Etc/UTC", None, 1)], FEEDS)
    df = spark.createDataFrame([(i, f, t, 0, "x") for i, (f, t) in enumerate(texts)], RAW)
    got = {r["raw_id"]: r["utc_us"] for r in timestamps.normalise_timestamps(df, feeds).collect()}
    return [got[i] for i in range(len(texts))]


def test_timestamp_forms(spark):
    cases = [
        (("ny", "11/19/2024 7:06:28 PM"), us(2024, 11, 20, 0, 6, 28)), (("de", "20/11/2024 02:55"), us(2024, 11, 20, 1, 55)), (("ny", "20/11/2024 02:55"), None), (("u", "24/11/20 02:55"), us(2024, 11, 20, 2, 55)),
        (("ny", "11/20/24 02:55"), us(2024, 11, 20, 7, 55)), (("u", "11/20/2024 02:55"), None), (("none", "2024-11-20 10:00:00"), None), (("none", "2024-11-20T10:00:00Z"), us(2024, 11, 20, 10)),
        (("x", "2024-11-20t10:00:00z"), us(2024, 11, 20, 10)), ((None, "2024-11-20T07:36:00+05:30"), us(2024, 11, 20, 2, 6)), (("x", "2024-11-20 02:36:37 -0700"), us(2024, 11, 20, 9, 36, 37)),
        (("ny", "Nov 2, 2025 4:14:00 AM EST"), us(2025, 11, 2, 9, 14)), (("ny", "Mar 30, 2025 3:06:35 AM CEST"), us(2025, 3, 30, 1, 6, 35)), (("ny", "2024-11-20 15:46:24 CET"), us(2024, 11, 20, 14, 46, 24)),
        (("x", "Thu, 21 Nov 2024 10:01:28 GMT"), us(2024, 11, 21, 10, 1, 28)), (("x", "Fri, 21 Nov 2024 10:01:28 GMT"), None), (("x", "1732116246"), 1732116246 * 10**6), (("x", "1732074059537"), 1732074059537 * 1000),
        (("x", "1732066842715945"), 1732066842715945), (("x", "1732205866.073"), 1732205866073000), (("x", "17322058"), None), (("ny", "20241119191811"), us(2024, 11, 20, 0, 18, 11)), (("ny", "20241319191811"), None),
        (("x", "20241121T090609Z"), us(2024, 11, 21, 9, 6, 9)), (("de", "20-Nov-2024 09:05:45"), us(2024, 11, 20, 8, 5, 45)), (("de", "2024-11-20 13:57:07,386"), us(2024, 11, 20, 12, 57, 7) + 386000), (("u", " 2024-11-20 13:57:07.5\t"), us(2024, 11, 20, 13, 57, 7) + 500000),
        (("ny", "03/09/2025 02:51"), None), (("ny", "11/2/2025 1:01:58 AM"), None), (("ny", "11/2/2025 2:01:58 AM"), us(2025, 11, 2, 7, 1, 58)), (("de", "26.10.2025 03:48:47"), us(2025, 10, 26, 2, 48, 47)), (("de", "26.10.2025 02:48:47"), None),
        (("u", "2024-02-30 10:00:00"), None), (("u", "2023-02-29 10:00:00"), None), (("u", "2024-02-29 10:00:00"), us(2024, 2, 29, 10)), (("u", "2024-11-23 32:10:06Z"), None), (("u", "2024-11-23 24:00:00"), None), (("u", "13:00:00 PM"), None),
        (("ny", "11/19/2024 0:06:28 PM"), None), (("ny", "11/19/2024 13:06:28 PM"), None), (("ny", "11/19/2024 12:06:28 AM"), us(2024, 11, 19, 5, 6, 28)), (("u", "2024-11-21"), None), (("u", "22:01:25"), None), (("u", "2024-11-21 14:"), None), (("u", None), None), (("u", ""), None),
        (("u", "  "), None), (("u", "N/A"), None), (("bad", "11/19/2024 10:06"), None), (("blank", "11/19/2024 10:06"), None), (("blank", "2024-11-19 10:06:00"), us(2024, 11, 19, 10, 6)), (("u", "2024-11-20T10:00:00+19:00"), None), (("u", "0000-00-00 00:00:00"), None), (("u", "9" * 100_000), None),
    ]
    got = parsed(spark, [c for c, _ in cases])
    assert [(c, g) for (c, w), g in zip(cases, got) if g != w] == []


def test_timestamp_zones_in_texts_and_other_forms(spark):
    cases = [
        (("x", "2024-03-01 10:00:00 America/New_York"), us(2024, 3, 1, 15)), (("x", "2024-03-01T10:00:00-05:00[America/New_York]"), us(2024, 3, 1, 15)), (("x", "2024-03-01T10:00:00-04:00[America/New_York]"), None),
        (("x", "2024-03-01T10:00:00[Europe/Berlin]"), us(2024, 3, 1, 9)), (("x", "2024-03-01 10:00 Mars/Base"), None), (("ny", "2024-03-10 02:30:00 America/New_York"), None), (("ny", "2024-03-01 10:00 UTC+1"), us(2024, 3, 1, 9)),
        (("ny", "2024-03-01 10:00 GMT-05:30"), us(2024, 3, 1, 15, 30)), (("ny", "2024-03-01 10:00 ABC+1"), None), (("x", "20240301T1000Z"), us(2024, 3, 1, 10)), (("x", "20240301X100000Z"), None),
        (("x", "Friday, 1 March 2024 10:00:00 UTC"), us(2024, 3, 1, 10)), (("x", "Monday, 1 March 2024 10:00:00 UTC"), None), (("x", "2024-061T10:00:00Z"), us(2024, 3, 1, 10)), (("x", "2023-366T10:00:00Z"), None),
        (("x", "2024-W09-5T10:00:00Z"), us(2024, 3, 1, 10)), (("x", "2024-W53-1T10:00:00Z"), None), (("x", "2020-W53-5T10:00:00Z"), us(2021, 1, 1, 10)), (("ny", "03/01/2024 1:00 p.m."), us(2024, 3, 1, 18)),
        (("ny", "03/01/2500 12:00"), us(2500, 3, 1, 17)), (("ny", "07/01/2500 12:00"), us(2500, 7, 1, 16)), (("x", "2024-03-01 10:00:00 America/Argentina/ComodRivadavia"), us(2024, 3, 1, 13)),
        (("x", "2024-03-01T10:00:00.123456789-03:00[America/Argentina/Buenos_Aires]"), us(2024, 3, 1, 13) + 123456), (("x", "2024-03-01 10:00:00Z" + " and more" * 40), None),
    ]
    got = parsed(spark, [c for c, _ in cases])
    assert [(c, g, w) for (c, w), g in zip(cases, got) if g != w] == []


def test_unnamed_release_of_zones_is_refused(monkeypatch):
    import builtins
    import zoneinfo

    real = builtins.__import__
    monkeypatch.setattr(builtins, "__import__", lambda name, *a, **k: (_ for _ in ()).throw(ImportError()) if name == "tzdata" else real(name, *a, **k))
    monkeypatch.setattr(zoneinfo, "TZPATH", ())
    with pytest.raises(RuntimeError):
        timestamps.tz_version()


def test_zone_tables_follow_the_zone_database():
    random.seed(1)
    for name in ("America/New_York", "Europe/Berlin", "America/Phoenix", "Australia/Lord_Howe", "Asia/Kathmandu"):
        z = ZoneInfo(name)
        local = np.array([random.randint(0, 4_000_000_000) for _ in range(500)] + [1741502000 + i * 600 for i in range(-60, 60)] + [1762050000 + i * 600 for i in range(-90, 60)])
        utc, one = timestamps.wall_to_utc(local, name)
        for x, u, ok in zip(local.tolist(), utc.tolist(), one.tolist()):
            wall = E + timedelta(seconds=x)
            fits = {int((wall.replace(tzinfo=z, fold=f)).timestamp()) for f in (0, 1)}
            fits = {s for s in fits if datetime.fromtimestamp(s, timezone.utc).astimezone(z).replace(tzinfo=None) == wall}
            assert ok == (len(fits) == 1) and (not ok or fits == {u})


def test_timestamps_of_an_empty_table(spark):
    assert timestamps.normalise_timestamps(spark.createDataFrame([], RAW), spark.createDataFrame([], FEEDS)).count() == 0


READ = "reading_id bigint, tmc_code string, measurement_tstamp timestamp_ntz, speed double, k string, slot int, n string, us string, v string, scatter int, shard int, halo int"


def readings(spark, rows):
    return spark.createDataFrame([(i, c, t, v, "x", 1, "y", "z", "w", 1, 1, 1) for i, (c, t, v) in enumerate(rows)], READ)


def test_grid_marks_gaps_and_breaks(spark):
    t0 = datetime(2025, 1, 1)
    at = lambda slot, s=0: t0 + timedelta(seconds=900 * slot + s)
    rows = [("a ", at(0, 5), 50.0), ("A", at(0, 5), 50.0), ("A", at(1), None), ("A", at(3, 899), 60.0), ("A", at(5), 255.0), ("A", at(6), float("nan")), ("A", at(7), 55.0), ("A", at(7 + 193), 50.0), ("A", at(7 + 193 + 194), 51.0), (None, at(2), 9.0), ("B", None, 9.0), ("C", at(4), 700.0)]
    got = grid.regular_grid(readings(spark, rows)).collect()
    slots = {(r["tmc_code"], (r["slot_s"] - int((t0 - E).total_seconds())) // 900): r for r in got}
    missing = {k for k, r in slots.items() if r["missing"]}
    assert missing == {("A", s) for s in (1, 2, 4, 6)} | {("A", 7 + i) for i in range(1, 193)}  # 192 empty slots are filled, 193 are a break
    assert slots["A", 0]["n_readings"] == 2 and slots["A", 5]["n_readings"] == 1 and slots["A", 5]["speed_mean"] is None
    assert slots["C", 4]["speed_smooth"] is None and all(0 <= r["speed_smooth"] <= 120 for k, r in slots.items() if k[0] == "A")
    assert grid.regular_grid(readings(spark, [])).count() == 0


def test_smoother_equals_dense_gaussian_posterior():
    """The panel smoother against the joint Gaussian solved at once."""
    rng = np.random.default_rng(0)
    steps, r, q = 12, 1.5, 0.4
    y, w, off = rng.normal(50, 3, (steps, 1)), (rng.random((steps, 1)) < 0.6).astype(float) * rng.integers(1, 4, (steps, 1)), rng.uniform(-0.5, 0.5, (steps, 1))
    w[0] = 1
    f = np.array([[1, (1 - grid.PHI) * 8], [0, grid.PHI]])
    qm = q * np.array([[1 / 3, 1 / 2], [1 / 2, 1]])
    n = 2 * steps
    prec, rhs = np.zeros((n, n)), np.zeros(n)
    p0 = np.linalg.inv(np.diag([50.0, 4.0]))
    prec[:2, :2] += p0
    rhs[:2] += p0 @ np.array([y[0, 0], 0.0])
    qi = np.linalg.inv(qm)
    for t in range(steps):
        if t:
            a, b = slice(2 * t - 2, 2 * t), slice(2 * t, 2 * t + 2)
            prec[b, b] += qi
            prec[a, a] += f.T @ qi @ f
            prec[a, b] -= f.T @ qi
            prec[b, a] -= qi @ f
        if w[t, 0]:
            h, s = np.array([1, off[t, 0]]), r / w[t, 0] + q * abs(off[t, 0]) ** 3 / 3
            prec[2 * t : 2 * t + 2, 2 * t : 2 * t + 2] += np.outer(h, h) / s
            rhs[2 * t : 2 * t + 2] += h * y[t, 0] / s
    cov = np.linalg.inv(prec)
    level, sd = grid.smooth_panel(y, w, off, np.array([r]), np.array([q]))
    assert np.allclose(level[:, 0], (cov @ rhs)[::2]) and np.allclose(sd[:, 0], np.sqrt(np.diag(cov)[::2]))


def test_readings_at_their_times_equal_dense_gaussian_posterior():
    """Condensed intervals and the smoother over them against the joint Gaussian of the states at all readings and slot middles, solved at once."""
    rng = np.random.default_rng(3)
    steps, r, q = 7, 1.5, 0.4
    times = [np.sort(rng.random(m)) for m in (0, 3, 1, 0, 8, 2, 1)]
    values = [rng.normal(50, 3, len(x)) for x in times]
    points = sorted([(float(t), None) for t in range(steps)] + [(t + float(d), float(v)) for t in range(steps) for d, v in zip(times[t], values[t])])
    n = 2 * len(points)
    prec, rhs = np.zeros((n, n)), np.zeros(n)
    prec[0, 0], prec[1, 1], rhs[0] = 1 / 50, 1 / 4, 50 / 50
    for i, (t, v) in enumerate(points):
        b = slice(2 * i, 2 * i + 2)
        if i:
            a, dt = slice(2 * i - 2, 2 * i), t - points[i - 1][0]
            left = math.exp(-dt / 8)
            f = np.array([[1, 8 * (1 - left)], [0, left]])
            u = (np.arange(20_000) + 0.5) * dt / 20_000  # slope noise of a moment, as the level and the slope have it at the end
            h = np.stack([8 * (1 - np.exp(-u / 8)), np.exp(-u / 8)])
            qi = np.linalg.inv(q * h @ h.T * dt / 20_000)
            prec[b, b] += qi
            prec[a, a] += f.T @ qi @ f
            prec[a, b] -= f.T @ qi
            prec[b, a] -= qi @ f
        if v is not None:
            prec[2 * i, 2 * i] += 1 / r
            rhs[2 * i] += v / r
    cov = np.linalg.inv(prec)
    mids = [2 * i for i, (_, v) in enumerate(points) if v is None]
    by = sorted((i for i in range(steps) if len(times[i])), key=lambda i: -len(times[i]))
    begin = np.cumsum([0] + [len(x) for x in times])
    parts = np.repeat(grid.nothing(np.array([q]))[None], steps, axis=0)
    one = np.ones(len(by))
    parts[by, :, 0] = grid.condense(np.concatenate(times), np.concatenate(values), begin[by], np.array([len(times[i]) for i in by]), r * one, q * one).T
    level, sd = grid.posterior(parts, np.array([50.0]))
    assert np.allclose(level[:, 0], (cov @ rhs)[mids], rtol=1e-5) and np.allclose(sd[:, 0], np.sqrt(np.diag(cov)[mids]), rtol=1e-5)


def test_grid_takes_readings_at_their_own_times(spark):
    """Two series with the same means and mean places in every slot, whose readings rise in one and fall in the other: what comes after differs accordingly."""
    t0 = datetime(2025, 1, 1)
    rows = []
    for c, turn in (("UP", 1), ("DOWN", -1)):
        for i in [0, 1, 2, 8, 9]:
            rows += [(c, t0 + timedelta(seconds=900 * i + (450 if s == 0 else 450 + s * 400)), 50.0 + turn * s * 4) for s in (-1, 0, 1)]
    got = {(r["tmc_code"], (r["slot_s"] - int((t0 - E).total_seconds())) // 900): r for r in grid.regular_grid(readings(spark, rows)).collect()}
    assert all(abs(got["UP", i]["speed_mean"] - got["DOWN", i]["speed_mean"]) < 1e-9 for i in (0, 1, 2, 8, 9))
    assert got["UP", 3]["speed_smooth"] > got["DOWN", 3]["speed_smooth"] + 1 and got["UP", 7]["speed_smooth"] < got["DOWN", 7]["speed_smooth"] - 1


@pytest.mark.parametrize("most", [2_000_000, 400, 100, 60])
def test_grid_is_the_same_in_any_batches(most):
    """Sources that arrive in many small batches, and those of too many readings to hold, give the same grid."""
    rng = np.random.default_rng(9)
    us = [np.sort(rng.integers(0, 400 * 900_000_000, n)) for n in (400, 500, 3)]
    us[1][400:] += 300 * 900_000_000  # a break
    t = pa.table({"k": ["A"] * 400 + ["B"] * 500 + ["C"] * 3, "us": np.concatenate(us), "v": np.where(rng.random(903) < 0.02, 200.0, rng.normal(50, 5, 903))})
    whole, small = (pa.Table.from_batches(g).sort_by([("tmc_code", "ascending"), ("slot_s", "ascending")]) for g in (grid._grid(900, 192)(t.to_batches()), grid._grid(900, 192, 50, most)(t.to_batches(max_chunksize=17))))
    for c in whole.column_names:
        assert whole[c].to_pylist() == pytest.approx(small[c].to_pylist(), abs=1e-9) if c.startswith("speed") else whole[c].to_pylist() == small[c].to_pylist()


def test_grid_fills_held_out_slots_within_its_deviation(spark):
    """Of slots left out of a noisy series with a wandering slope, as the smoother takes it to be, nearly all lie within three deviations of their fills, which beat carrying the last value forward."""
    rng = np.random.default_rng(8)
    n = 1500
    slope, level = 0.0, 60.0
    walk = np.empty(n)
    for i in range(n):
        walk[i] = level
        level += (1 - grid.PHI) * 8 * slope + 0.02 * (60 - level)  # drawn back, to stay plausible
        slope = grid.PHI * slope + rng.normal(0, 0.7)
    left = set(rng.choice(np.arange(5, n - 5), 150, replace=False).tolist())
    t0 = datetime(2025, 1, 1)
    rows = [("A", t0 + timedelta(minutes=15 * i + float(rng.uniform(0, 15))), float(walk[i] + rng.normal(0, 0.7))) for i in range(n) if i not in left for _ in range(2)]
    got = {(r["slot_s"] - int(t0.replace(tzinfo=timezone.utc).timestamp())) // 900: r for r in grid.regular_grid(readings(spark, rows)).collect()}
    e = np.array([abs(got[i]["speed_smooth"] - walk[i]) for i in left])
    sd = np.array([got[i]["speed_sd"] for i in left])
    carried = np.array([abs(walk[max(j for j in range(i) if j not in left)] - walk[i]) for i in left])
    assert all(got[i]["missing"] for i in left) and (e <= 3 * sd).mean() > 0.97 and e.mean() < carried.mean()


LINK = "link_id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, reason string"
REF = "row_id bigint, table_name string, link_id bigint, period string, loaded_at timestamp_ntz, reason string, w0 int, _k string, _block int"


def orphan_reason(versions, k, t):
    own = [v for v in versions if v[0] == k]
    if not own:
        return "missing"
    if t is not None and any(a is not None and a <= t and (b is None or t < b) for _, a, b in own):
        return None
    return "later" if t is not None and all(a is not None and a > t for _, a, b in own) else "deleted"


def test_orphans_equal_brute_force(spark):
    random.seed(4)
    day = lambda: datetime(2025, 1, random.randint(1, 28), random.randint(0, 3))
    versions = []
    for k in range(120):
        for _ in range(random.randint(1, 3)):
            a, b = random.choice([None, day(), day(), day()]), random.choice([None, day(), day()])
            versions += [(k, a, b)] * random.randint(1, 2)
    versions.append((None, day(), None))
    refs = [(i, random.choice([None, 7, 7, *range(160)]), random.choice([None, day(), day(), day()])) for i in range(4000)]
    p = spark.createDataFrame([(k, a, b, "x") for k, a, b in versions], LINK)
    df = spark.createDataFrame([(i, "t", k, "AM", t, "old", 1, "s", 2) for i, k, t in refs], REF)
    want = {i: orphan_reason(versions, k, t) for i, k, t in refs if k is not None}
    want = {i: r for i, r in want.items() if r}
    for hot in (1_000_000, 20):  # without and with salted keys
        rows = orphans.find_orphans(df, p, hot=hot).collect()
        assert {r["row_id"]: r["reason"] for r in rows} == want and len(rows) == len(want)
    assert orphans.find_orphans(df, p.limit(0)).where("reason != 'missing'").count() == 0
    assert orphans.find_orphans(df.limit(0), p).count() == 0
    assert orphans.orphan_report(orphans.find_orphans(df, p)).agg(F.sum("n_rows")).first()[0] == len(want)


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).select((F.col("id") * 7919).alias("_k"))
    blocks = orphans.block_count(keys, "_k")
    bloom = {r["block"]: r for r in orphans.bloom_blocks(keys, "_k", blocks).collect()}
    assert len(bloom) <= blocks
    probe = keys.unionByName(spark.range(5000).select((F.col("id") * 7919 + 1).alias("_k"))).select("_k", orphans._block("_k", blocks).alias("block"), *(orphans._bit("_k", i).alias(f"b{i}") for i in range(4))).collect()
    hit = [r["block"] in bloom and all(bloom[r["block"]][f"w{i}"] & r[f"b{i}"] for i in range(4)) for r in probe]
    assert all(h for h, r in zip(hit, probe) if r["_k"] % 7919 == 0) and sum(h for h, r in zip(hit, probe) if r["_k"] % 7919) < 100


def merged(rows):
    out = []
    for s, e, in sorted(rows):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
        else:
            out.append((s, e, 1))
    return out


def test_intervals_equal_brute_force(spark):
    random.seed(9)
    rows = [(random.choice([1, 1, 1, 2, 3, None]), s, s + random.choice([-5, 0, 1, 5, 60, 360, 719, 100_000])) for s in (random.randint(-2000, 200_000) for _ in range(900))]
    rows += [(4, 0, 360), (4, 360, 720), (4, 721, 722), (4, 721, 722), (5, None, 3), (5, 3, None)]
    df = spark.createDataFrame([(k, s, e, "x", 1, 2) for k, s, e in rows], "key bigint, start bigint, stop bigint, sh string, piece int, n int")
    got = {}
    for r in intervals.merge_intervals(df, "key", "start", "stop").collect():
        got.setdefault(r["key"], []).append((r["start"], r["stop"], r["n_rows"]))
    want = {k: merged([(s, e) for kk, s, e in rows if kk == k and s is not None and e is not None and e > s]) for k in (1, 2, 3, 4)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    gaps = {(r["start"], r["stop"]) for r in intervals.coverage_and_gaps(df, "key", "start", "stop").where("key = 4 and kind = 'gap'").collect()}
    assert gaps == {(720, 721)}
    assert intervals.coverage_and_gaps(df.limit(0), "key", "start", "stop").count() == 0


def test_spikes_runs_and_range(spark):
    rng = np.random.default_rng(2)
    t0 = datetime(2025, 1, 1)
    v = 55 + np.cumsum(rng.normal(0, 0.1, 3000)) + rng.normal(0, 1, 3000)
    v[1000:1400] -= 30  # a lasting drop
    planted = {100: 25, 300: -20, 301: -20, 302: -20, 700: 30, 701: 30, 1200: 25}
    for i, d in planted.items():
        v[i] += d
    v[1500:1504] -= 25  # four are no spike
    v[2000:2012] = 50.0
    v[2100:2111] = 51.0  # eleven are no run
    v[2500], v[2600] = 255.0, -1.0
    rows = [("s1", t0 + timedelta(minutes=3 * i), float(x)) for i, x in enumerate(v)]
    rows += [("S1 ", t0 + timedelta(minutes=300), float(v[100])), ("S1", t0 + timedelta(minutes=9000), None), (None, t0, 999.0), ("tiny", t0, 50.0), ("tiny", t0, 50.0), ("nul", None, 50.0)]
    want = set(planted) | set(range(2000, 2012)) | {2500, 2600, 3000}
    for hot in (100_000, 2_000, 300):  # whole and cut into shards with overlaps
        got = spikes.flag_implausible(readings(spark, rows), hot=hot).collect()
        assert len(got) == len({r["reading_id"] for r in got})
        assert {r["reading_id"] for r in got} == want
    kinds = {r["reading_id"]: r["kind"] for r in got}
    assert kinds[100] == kinds[3000] == "spike" and kinds[2005] == "stuck" and kinds[2500] == "impossible"
    assert spikes.flag_implausible(readings(spark, [])).count() == 0


def test_spikes_beside_silences():
    """Ten scatters beside a silence or at an end of ordinarily noisy series, and a lone reading between silences, are spikes; a ramp's end is none."""
    rng = np.random.default_rng(4)
    t = np.arange(300) * 180.0
    t[100:] += 40_000
    t[200:] += 40_000
    v = 55 + rng.normal(0, 1.5, 300)
    v[[0, 99, 100, 299]] = 55.0
    s = float(np.median(np.abs(np.diff(v))))
    for at in (0, 99, 100, 101, 299):
        v[at] = 55 - 13 * s
    limit = spikes.esd_limits(300, 1)[0] * spikes.NOISE
    found = lambda t, v, s: set(np.flatnonzero(spikes.remainders(t, v, np.arange(len(v)), s, 7200.0, np.zeros(len(v)))[2] > limit))
    assert found(t, v, s) == {0, 99, 100, 101, 299}
    alone_t, alone_v = np.r_[t[:100], t[99] + 20_000, t[100:]], np.r_[v[:100], 55 + 30 * s, v[100:]]
    assert 100 in found(alone_t, alone_v, s)
    ramp = 60 - 3.0 * np.maximum(0, np.arange(300) % 100 - 90)
    assert not found(t, ramp + rng.normal(0, 0.3, 300), 0.5) & set(range(95, 100))


def test_season_and_esd_limits_decide(spark):
    """A short dip at the same time every day is usual for its source; a stricter test level finds less."""
    rng = np.random.default_rng(5)
    t0 = datetime(2025, 1, 1)
    n = 48 * 10
    v = 60 + rng.normal(0, 1, n)
    dips = {day * 48 + 18 + k for day in range(10) for k in range(3)}
    v[sorted(dips)] -= 20  # 9:15, 9:45 and 10:15
    v[250] -= 20
    df = readings(spark, [("S", t0 + timedelta(minutes=15 + 30 * i), float(x)) for i, x in enumerate(v)])
    ids = lambda **kw: {r["reading_id"] for r in spikes.flag_implausible(df, **kw).collect()}
    assert ids() == {250}
    assert ids(seasonal=False) == {250} | dips
    assert ids(alpha=1e-300) == set()


def test_esd_limit_expression_equals_the_function(spark):
    rows = [(n, i) for n in (25, 300, 100_000) for i in (1, 2, 5)]
    got = spark.createDataFrame(rows, "n bigint, i bigint").select("n", "i", spikes.esd_limit(F.col("n"), F.col("i")).alias("x")).collect()
    assert all(abs(r["x"] - spikes.esd_limits(r["n"], 5)[r["i"] - 1]) < 0.01 for r in got)


def test_esd_limits_near_published_values():
    # two-sided 5 % critical values for n = 54 of the usual worked example
    assert np.allclose(spikes.esd_limits(54, 3, 0.05), [3.158, 3.151, 3.143], atol=0.02)
