"""Ordered classifications and unit checks as column expressions; the first rule that holds counts, unknown values hold no rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmark.functions.physics import MILE_M, MPH_KPH, div


def ordered(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for condition, name in reversed(rules):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def match_status(c: dict[str, Column]) -> Column:
    """Status of a matched route from its measures.

    Keys: links, repeated, class_switches, transition, start_ft, end_ft, length_ratio, mean_offset_ft, most_offset_ft, bearing, margin, confidence.
    """
    return ordered(
        [
            (c["links"] == 0, "no_path"), (c["repeated"] > 0, "review_loop"), (c["class_switches"] > 0, "review_facility_class"), (c["transition"] == "disconnected", "review_corridor_continuity"),
            ((c["start_ft"] > 3200) | (c["end_ft"] > 3200), "review_od_distance"), ((c["length_ratio"] < 0.35) | (c["length_ratio"] > 3.0), "review_length"),
            ((c["mean_offset_ft"] > 900) | (c["most_offset_ft"] > 2600), "review_geometry"), (c["bearing"] > 55, "review_direction"), (c["margin"] < 2.0, "review_ambiguous_route"), (c["confidence"] >= 55, "matched"),
        ],
        "review_low_confidence",
    )


def likely_cause(volume: Column, doc: Column, synthetic: Column, reconciled: Column, map_review: Column) -> Column:
    """Likely cause of a link's odd loading."""
    seen = F.coalesce(synthetic, F.lit(0.0)) > 0
    zero, low = F.coalesce(volume, F.lit(0.0)) <= 0, F.coalesce(doc <= 0.10, F.lit(False))
    ratio = div(volume, F.when(synthetic > 0, synthetic))
    return ordered(
        [
            (~reconciled, "calculation_mismatch"), (map_review, "mapmatching_review"), (zero & seen, "assignment_zero_despite_observed_demand"),
            (low & seen & (ratio < 0.25), "assignment_underloaded_vs_observed"), (low, "plausible_low_assignment_loading"),
        ],
        "no_primary_issue",
    )


def low_boundary_reasons(start: Column, end: Column, cutoff: Column, p: Column, doc: Column, speed: Column, volume: Column, vt2: Column) -> Column:
    """Semicolon list of reasons where both boundary speeds are below the cutoff; empty where the link isn't selected."""
    both = (start < cutoff) & (end < cutoff)
    high = F.greatest(start, end)
    why = F.concat_ws(";", F.when(p < 0.5, "short_p"), F.when(doc < 0.5, "low_doc"), F.when(speed > high, "faster_than_boundaries"), F.when(volume == 0, "no_volume"), F.when(vt2 > high, "vt2_above_boundaries"))
    return F.when(both, why).otherwise("")


def unmatched_reason(c: dict[str, Column]) -> Column:
    """Why a corridor's link has no sensor.

    Keys: transition, same_class, gap_mi (distance to the nearest anchor; null without), before, after, same_direction, connector, managed, between_ft, within, terminal.
    """
    return ordered(
        [
            (c["transition"], "transition_link"), (~c["same_class"], "facility_class_differs"), (c["before"] & (c["gap_mi"] <= 1), "before_first_within_1_mi"), (c["after"] & (c["gap_mi"] <= 1), "after_last_within_1_mi"),
            ((c["before"] | c["after"]) & (c["gap_mi"] <= 5), "outside_within_5_mi"), ((c["before"] | c["after"]) & (c["gap_mi"] > 5), "outside_beyond_5_mi"), (~c["same_direction"], "other_direction"),
            (c["connector"], "connector_or_ramp"), (c["managed"], "managed_lane"), (c["between_ft"] <= 500, "between_anchors"), (c["within"], "within_corridor"), (c["terminal"], "terminal"),
        ],
        "other",
    )


def direction_score(distance: Column, angle: Column, route_distance: Column) -> Column:
    return distance + 22 * angle + 0.10 * route_distance


def units_agree(length_mi: Column, length_m: Column, mph: Column, kph: Column, fftt: Column, tolerance: float = 1e-6) -> Column:
    """Whether a link's miles, metres, speeds and free travel minutes fit each other."""
    close = lambda a, b: F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1e-12))
    return close(length_mi * MILE_M, length_m) & close(mph * MPH_KPH, kph) & close(div(60 * length_mi, mph), fftt)


def kernel_agrees(volume: Column, lanes: Column, hours: Column, plf: Column, demand: Column, lane_cap: Column, doc: Column) -> Column:
    """reconciled where demand and doc recomputed from volume fit within 1e-4 and 5e-3, else mismatch; unknown without inputs."""
    d = div(volume, lanes * hours * plf)
    x = div(d, lane_cap)
    ok = (F.abs(d - demand) <= 1e-4 * F.greatest(F.abs(d), F.lit(1.0))) & (F.abs(x - doc) <= 5e-3)
    return F.when(ok, "reconciled").when(ok.isNotNull(), "mismatch").otherwise("unknown")


def is_hov(toll_group: Column, limit: Column) -> Column:
    return F.coalesce((toll_group == 2) | limit.isin(2, 3), F.lit(False))


def in_region(taz: Column, facility: Column, low: int = 1404, high: int = 2820) -> Column:
    return F.coalesce((taz > low) & (taz < high) & (facility > 0), F.lit(False))
