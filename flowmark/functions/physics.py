"""Traffic physics as column expressions. A null input gives null; nothing divides by zero."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MILE_M, MPH_KPH = 1609.344, 1.609344
CO2_PER_GALLON = 8887.0


def div(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def clip(x: Column, low, high) -> Column:
    """x within bounds; null stays null (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low) if not isinstance(low, Column) else low), F.lit(high) if not isinstance(high, Column) else high))


def s3_speed(k: Column, vf: Column, kc: Column, m: Column) -> Column:
    """S-shaped three-parameter speed at density k."""
    return vf / F.pow(1 + F.pow(div(k, kc), m), 2 / m)


def s3_flow(k: Column, vf: Column, kc: Column, m: Column) -> Column:
    return k * s3_speed(k, vf, kc, m)


def inverse_s3_flow(v: Column, vf: Column, kc: Column, m: Column, cap: Column) -> Column:
    """Flow at speed v on the S3 curve, at most the capacity."""
    v1 = F.least(v, vf * 0.99)
    ratio = F.greatest(div(vf, F.greatest(v1, F.lit(1.0))), F.lit(1.00001))
    k = kc * F.pow(F.greatest(F.pow(ratio, m / 2) - 1, F.lit(1e-8)), 1 / m)
    return F.when(v.isNotNull() & vf.isNotNull() & kc.isNotNull() & m.isNotNull() & cap.isNotNull(), F.least(v1 * k, cap))


def s3_context(p95: Column, reference: Column, default: Column, cap: Column) -> Column:
    """Struct (vf, vc, m, kc) of a synthetic S3 curve."""
    vf = clip(F.greatest(p95, reference, default), 35.0, 85.0)
    vc = vf * 0.7
    return F.struct(vf.alias("vf"), vc.alias("vc"), (F.lit(2 * math.log(2)) / F.log(vf / vc)).alias("m"), div(cap, vc).alias("kc"))


def qvdf_duration(dc: Column, f_d: Column, n: Column) -> Column:
    """Hours of congestion of a demand-to-capacity ratio."""
    return f_d * F.pow(F.greatest(dc, F.lit(0.0)), n)


def qvdf_min_speed(p: Column, vc: Column, f_p: Column, s: Column) -> Column:
    return clip(vc / (1 + f_p * F.pow(F.greatest(p, F.lit(0.0)), s)), F.lit(1.0), vc)


def qvdf_alpha(f_p: Column, f_d: Column, s: Column) -> Column:
    return F.lit(8 / 15) * f_p * F.pow(f_d, s)


def predicted_bounds(t2: Column, p: Column, left_share: Column) -> Column:
    """Struct (t0, t3) of a congestion of p hours around t2, left_share of it before."""
    x = clip(left_share, 0.05, 0.95)
    return F.struct((t2 - p * x).alias("t0"), (t2 + p * (1 - x)).alias("t3"))


def smoothstep(x: Column) -> Column:
    x = clip(x, 0.0, 1.0)
    return x * x * (3 - 2 * x)


def queue_shape(x: Column, rho: Column) -> Column:
    """Share of the greatest queue at x in (0, 1), greatest at rho; 0 outside."""
    inside = (x > 0) & (x < 1)
    return F.when(inside, F.pow(x / rho, 4 * rho) * F.pow((1 - x) / (1 - rho), 4 * (1 - rho))).when(x.isNotNull(), F.lit(0.0))


def queue_speed(length: Column, queue: Column, mu: Column, vc: Column) -> Column:
    """Speed over a section whose delay is the queue at discharge rate mu."""
    return div(length, div(queue, mu) + div(length, vc))


def co2_grams_per_mile(v: Column) -> Column:
    x = clip(v, 3.0, 80.0)
    return clip(0.080 - 0.0022 * x + 0.0000235 * x * x, 0.02, 0.20) * CO2_PER_GALLON


def plf(qdf: Column, hours: Column) -> Column:
    return div(F.lit(1.0), qdf * hours)


def free_travel_minutes(length_mi: Column, speed: Column) -> Column:
    return div(60.0 * length_mi, speed)


def gamma(mu: Column, length: Column, vc: Column, f_p: Column, p: Column, s: Column) -> Column:
    return 64 * mu * div(length, vc) * f_p * F.pow(p, s - 4)


def capacity_adjustment(cap: Column, its: Column, intersection: Column) -> Column:
    """Capacity raised by 1 % for ITS, 5 % for intersection works, 6 % for both."""
    return cap * F.when(its & intersection, 1.06).when(intersection, 1.05).when(its, 1.01).otherwise(1.0)


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Degrees clockwise from north on a plane of scaled longitude."""
    east = (lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return F.pmod(F.degrees(F.atan2(east, lat2 - lat1)) + 360, F.lit(360.0))


def angle_difference(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + 180, F.lit(360.0)) - 180)


def point_segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    t = clip(F.coalesce(div((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0)), 0.0, 1.0)
    return F.sqrt(F.pow(px - ax - t * dx, 2) + F.pow(py - ay - t * dy, 2))


def ray_relation(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Struct (along, lateral, score) of a point against the ray from a through b: score = lateral + 0.1 |along|."""
    n = F.sqrt(F.pow(bx - ax, 2) + F.pow(by - ay, 2))
    along = div((px - ax) * (bx - ax) + (py - ay) * (by - ay), n)
    lateral = F.abs(div((px - ax) * (by - ay) - (py - ay) * (bx - ax), n))
    return F.struct(along.alias("along"), lateral.alias("lateral"), (lateral + 0.1 * F.abs(along)).alias("score"))


# Weights of the composite match score.
MATCH_WEIGHTS = {"geometry": 0.25, "name": 0.15, "direction": 0.20, "class": 0.10, "position": 0.10, "observation": 0.10, "length": 0.10}


def match_score(parts: dict[str, Column]) -> Column:
    """0 to 100: the weighted mean of the parts that are known, null if none is."""
    total = sum((F.coalesce(c * MATCH_WEIGHTS[k], F.lit(0.0)) for k, c in parts.items()), F.lit(0.0))
    weight = sum((F.when(c.isNotNull(), MATCH_WEIGHTS[k]).otherwise(0.0) for k, c in parts.items()), F.lit(0.0))
    return 100 * div(total, weight)


def geometry_part(distance_ft: Column) -> Column:
    return F.exp(-distance_ft / 300)


def direction_part(angle: Column) -> Column:
    return F.greatest(F.cos(F.radians(angle)), F.lit(0.0))


def class_part(a: Column, b: Column) -> Column:
    return F.exp(-0.7 * F.abs(a - b))


def length_part(a: Column, b: Column) -> Column:
    return F.exp(-F.abs(F.log(div(a, b))))


def vmt_vht(volume: Column, length: Column, speed: Column, free_speed: Column, travel_min: Column) -> Column:
    """Struct (vmt, vht, ffvht, delay): hours from speed, else from travel time, else from free speed."""
    hours = F.coalesce(F.when(speed > 0, length / F.when(speed > 0, speed)), F.when(travel_min > 0, travel_min / 60), F.when(free_speed > 0, length / F.when(free_speed > 0, free_speed)))
    free = F.when(free_speed > 0, volume * length / F.when(free_speed > 0, free_speed))
    vht = volume * hours
    return F.struct((volume * length).alias("vmt"), vht.alias("vht"), free.alias("ffvht"), F.greatest(vht - free, F.lit(0.0)).alias("delay"))
