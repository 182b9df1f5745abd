"""Periods, thresholds and table schemas. Values here are fixed by the domain and stated plainly."""

from __future__ import annotations

# Assignment periods as (start minute, end minute), half-open; NT wraps midnight.
PERIODS = {"AM": (360, 540), "MD": (540, 900), "PM": (900, 1140), "NT": (1140, 360)}
PERIOD_HOURS = {"AM": 3.0, "MD": 6.0, "PM": 4.0, "NT": 11.0}

# Limits and shares used by the operators' defaults.
VALID_SPEED = (1.0, 150.0)
CONGESTED_SHARE, FREE_SHARE, SEVERE_SHARE = 0.70, 0.85, 0.35
MIN_LENGTH_COVERAGE = 0.8
FREE_FLOW_CLIP = (35.0, 85.0)


# Table schemas in DDL, for explicit reads.
READINGS = "tmc_code string, measurement_tstamp timestamp_ntz, speed double, reference_speed double, confidence_score double"
METADATA = "tmc string, road string, direction string, miles double, road_order double, start_latitude double, start_longitude double, end_latitude double, end_longitude double, active_start_date string"
MAPPING = "tmc string, link_id bigint, from_node_id bigint, to_node_id bigint, distance_to_tmc_ft double"
LINK = "link_id bigint, from_node_id bigint, to_node_id bigint, link_type string, length double, lanes int, free_speed double, capacity double, geometry string"
EPISODE = "episode_id string, tmc_code string, period string, t0 double, t2 double, t3 double, min_speed double, p_hr double"
