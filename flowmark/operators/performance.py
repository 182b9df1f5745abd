"""Link performance by period, day, district, class and scenario."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmark.functions.clock import period_hours
from flowmark.functions.physics import div

# Persons per vehicle by class.
OCCUPANCY = {"sov": 1.0, "hov2": 2.0, "hov3": 3.5, "com": 1.0, "trk": 1.0, "apv": 1.6}


def day_totals(df: DataFrame, by: list[str]) -> DataFrame:
    """Per key: volume summed over periods, speed weighted by the hours of the periods that have one, periods seen."""
    h = period_hours(F.col("period"))
    known = F.col("speed_mph").isNotNull()
    return df.groupBy(*by).agg(F.sum("volume").alias("volume"), div(F.sum(F.col("speed_mph") * h), F.sum(F.when(known, h))).alias("speed_mph"), F.sum("vmt").alias("vmt"), F.sum("vht").alias("vht"), F.count("*").alias("periods"))


def performance_columns(df: DataFrame) -> DataFrame:
    """df with hours of travel, free hours, delay (only below free speed) and severe delay (below half of it), persons and trucks shared by type."""
    t = div(F.col("length"), F.col("speed_mph"))
    f = div(F.col("length"), F.col("free_speed"))
    ratio = div(F.col("speed_mph"), F.col("free_speed"))
    delay = F.when(ratio < 1, F.greatest(t - f, F.lit(0.0))).otherwise(0.0) * F.col("volume")
    return df.withColumns({"speed_ratio": ratio, "travel_h": F.col("volume") * t, "free_h": F.col("volume") * f, "delay_h": delay, "severe_h": F.when(ratio < 0.5, delay).otherwise(0.0), "miles": F.col("volume") * F.col("length")})


def persons(parts: dict[str, Column]) -> Column:
    """Person trips of vehicle trips by class."""
    return sum((F.coalesce(c, F.lit(0.0)) * OCCUPANCY[k] for k, c in parts.items()), F.lit(0.0))


def district_statistics(df: DataFrame, district: str = "district", period: str = "period") -> DataFrame:
    """Sums and ratios per period and district, per period, and overall; grouping tells the level (0, 1, 3)."""
    sums = [F.sum(c).alias(c) for c in ("volume", "miles", "travel_h", "free_h", "delay_h", "severe_h")]
    out = df.groupingSets([[period, district], [period], []], period, district).agg(
        (F.grouping(period) * 2 + F.grouping(district)).cast("bigint").alias("level"), F.count("*").alias("n_links"), *sums, F.max("delay_h").alias("most_delay"), F.avg("delay_h").alias("mean_delay"), F.avg("doc").alias("mean_doc"),
    )
    return out.withColumn("speed", div(F.col("miles"), F.col("travel_h"))).withColumn("delay_per_mile", div(F.col("delay_h"), F.col("miles"))).withColumn("time_index", div(F.col("travel_h"), F.col("free_h")))


def overall_of_periods(stats: DataFrame) -> DataFrame:
    """The overall row of clipped maxima: the maximum and the mean of the periods' values, not recomputed over links."""
    p = stats.where("level = 1")
    return p.agg(F.max("most_delay").alias("most_delay"), F.avg("most_delay").alias("mean_of_most"), F.avg("mean_delay").alias("mean_of_means"))


def speed_class(v: Column, width: int = 5) -> Column:
    low = (F.floor(v / width) * width).cast("int")
    return F.concat_ws("_", low.cast("string"), (low + width).cast("string"))


def speed_class_statistics(df: DataFrame) -> DataFrame:
    """Per period and class of five mph: links, volume, hours, and delay per hour with a floor of 0.1 hours."""
    out = df.where("speed_mph is not null").groupBy("period", speed_class(F.col("speed_mph")).alias("speed_class")).agg(F.count("*").alias("n_links"), F.sum("volume").alias("volume"), F.sum("travel_h").alias("travel_h"), F.sum("delay_h").alias("delay_h"))
    return out.withColumn("delay_ratio", F.col("delay_h") / F.greatest("travel_h", F.lit(0.1)))


def scenario_difference(base: DataFrame, other: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """base joined with other: per value both and the difference other - base; missing partners and their differences are -1."""
    o = other.select(*keys, *(F.col(v).alias(f"{v}_other") for v in values))
    j = base.select(*keys, *(F.col(v).alias(f"{v}_base") for v in values)).join(o, keys, "left")
    cols = []
    for v in values:
        gone = F.col(f"{v}_other").isNull() | F.col(f"{v}_base").isNull()
        cols += [F.coalesce(f"{v}_base", F.lit(-1.0)).alias(f"{v}_base"), F.coalesce(f"{v}_other", F.lit(-1.0)).alias(f"{v}_other"), F.when(gone, -1.0).otherwise(F.col(f"{v}_other") - F.col(f"{v}_base")).alias(f"{v}_diff")]
    return j.select(*keys, *cols)


def facility_digit(link_type: Column, hundreds: bool = False) -> Column:
    """Facility digit of a type code 100 * area + facility: the last digit, or (in the other derivation) the hundreds digit."""
    n = link_type.try_cast("int")
    return F.pmod(F.floor(n / 100), F.lit(10)).cast("int") if hundreds else F.pmod(n, F.lit(10)).cast("int")


def build_links(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Usable links: no self-loops, both nodes known, lanes, capacity and speed above 0; free time in minutes; deduplicated by link."""
    ok = rows.where("from_node_id != to_node_id and lanes > 0 and capacity > 0 and free_speed > 0 and length > 0")
    for side in ("from_node_id", "to_node_id"):
        ok = ok.join(nodes.select(F.col("node_id").alias(side)), side, "left_semi")
    return ok.withColumn("fftt", 60 * F.col("length") / F.col("free_speed")).withColumn("area", facility_digit(F.col("link_type"), True)).withColumn("facility", facility_digit(F.col("link_type")))


def overlay_boundaries(links: DataFrame, lookup: DataFrame, observed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """t0, t2, t3 per link (or other keys): cleared, then the completed lookup, then observed triplets; an observed link without episode clears all three.

    lookup: keys, t0, t2, t3. observed: keys, t0, t2, t3, congested. A triplet with a gap counts as no triplet.
    """
    keys = keys or ["link_id"]
    whole = lambda p: F.col(f"{p}t0").isNotNull() & F.col(f"{p}t2").isNotNull() & F.col(f"{p}t3").isNotNull()
    a = lookup.select(*keys, *(F.col(c).alias(f"l_{c}") for c in ("t0", "t2", "t3")))
    b = observed.select(*keys, "congested", *(F.col(c).alias(f"o_{c}") for c in ("t0", "t2", "t3")))
    j = links.select(*keys).join(a, keys, "left").join(b, keys, "left")
    source = F.when(F.col("congested") & whole("o_"), "observed").when(F.col("congested").isNotNull() & ~F.col("congested"), "observed_no_congestion").when(whole("l_"), "lookup").otherwise("none")
    pick = lambda c: F.when(source == "observed", F.col(f"o_{c}")).when(source == "lookup", F.col(f"l_{c}")).alias(c)
    return j.select(*keys, pick("t0"), pick("t2"), pick("t3"), source.alias("source"))
