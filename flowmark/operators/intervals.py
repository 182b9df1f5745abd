"""Overlapping and gapped time intervals (problem 6): two-level merge.

Intervals are clipped into fixed time shards and equal pieces of a shard are counted together before the shuffle, so what a
task holds of one entity and shard is bounded by the shard's length, not by the rows. Pieces are merged per shard. What touches
no boundary of its shard is final; only the coverage at boundaries, two pieces a shard at most, is stitched per entity.
Intervals of more than LONG shards skip the clipping; the coverage of their entities goes to the stitch as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, LONG = 360, 64


def merge_intervals(df: DataFrame, key: str, start: str, end: str, shard: int = SHARD) -> DataFrame:
    """(key, start, end, n_rows): continuous periods per entity; intervals that overlap or touch are one.

    start and end are whole numbers. Rows with a null key, start or end, or end not after start, are left out. Repeated rows
    count in n_rows. An empty table gives none.
    """
    base = df.select(F.col(key).alias("k"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    base = base.where("k is not null and s is not null and e is not null and e > s")
    first, last = F.floor(F.col("s") / shard).cast("bigint"), F.floor((F.col("e") - 1) / shard).cast("bigint")
    base = base.withColumn("f", first).withColumn("l", last)
    clip = base.where(F.col("l") - F.col("f") < LONG).withColumn("sh", F.explode(F.sequence("f", "l")))
    clip = clip.select("k", "sh", F.greatest("s", F.col("sh") * shard).alias("s"), F.least("e", (F.col("sh") + 1) * shard).alias("e"), (F.col("sh") == F.col("f")).cast("bigint").alias("n"))
    clip = clip.groupBy("k", "sh", "s", "e").agg(F.sum("n").alias("n"))

    def joined(d: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("s", "e")
        before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
        d = d.withColumn("new", F.when(before.isNull() | (F.col("s") > before), 1).otherwise(0))
        d = d.withColumn("piece", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return d.groupBy(*by, "piece").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"))

    local = joined(clip, ["k", "sh"]).select("k", "sh", "s", "e", "n")
    long = base.where(F.col("l") - F.col("f") >= LONG).groupBy("k", "s", "e").agg(F.count("*").alias("n"))
    whole = long.select("k", F.lit(True).alias("whole")).distinct()
    open_ = F.coalesce("whole", F.lit(False)) | (F.col("s") == F.col("sh") * shard) | (F.col("e") == (F.col("sh") + 1) * shard)
    # what is final is a group of its own in the stitch, by its start
    local = local.join(whole, "k", "left").select("k", F.when(~open_, F.col("s")).alias("g"), "s", "e", "n")
    out = joined(local.unionByName(long.withColumn("g", F.lit(None).cast("bigint")).select("k", "g", "s", "e", "n")), ["k", "g"])
    return out.select(F.col("k").alias(key), F.col("s").alias(start), F.col("e").alias(end), F.col("n").alias("n_rows"))


def coverage_and_gaps(df: DataFrame, key: str, start: str, end: str, shard: int = SHARD) -> DataFrame:
    """(key, kind, start, end, n_rows): `period` rows and, between successive periods of an entity, `gap` rows (n_rows null)."""
    # the next period is the next in the same shard; for the last of a shard, the next among the first and last ones of the shards
    p = merge_intervals(df, key, start, end, shard).withColumn("_sh", F.floor(F.col(start) / shard))
    w = Window.partitionBy(key, "_sh").orderBy(start)
    p = p.withColumn("_own", F.lead(start).over(w)).withColumn("_inner", F.when(F.col("_own").isNotNull() & F.lag(start).over(w).isNotNull(), F.col(start)))
    p = p.withColumn("next", F.coalesce("_own", F.lead(start).over(Window.partitionBy(key, "_inner").orderBy(start))))
    both = F.array(
        F.struct(F.lit("period").alias("kind"), F.col(start).alias("a"), F.col(end).alias("b"), F.col("n_rows").alias("n")),
        F.struct(F.lit("gap").alias("kind"), F.col(end).alias("a"), F.col("next").alias("b"), F.lit(None).cast("bigint").alias("n")),
    )
    out = p.select(key, F.explode(both).alias("x")).where("x.b is not null")
    return out.select(key, "x.kind", F.col("x.a").alias(start), F.col("x.b").alias(end), F.col("x.n").alias("n_rows"))
