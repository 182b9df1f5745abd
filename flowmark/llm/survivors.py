"""Best representative of each duplicate group (problem 2): skyline selection.

Records of a group are compared by which fields they fill (completeness, field by field), trust, and recency (time, then
smaller id). A record is dominated if another fills all fields that it fills, is trusted at least as much and is at least as
recent. A field's donor under the lexicographic policy (trust, then recency) is never dominated: whatever dominated it would
fill the field too and come earlier. So the skyline holds every donor; its records in policy order are the layers from which
the survivor's fields are filled: the first layer gives the base record, later ones what is still missing.

Before the shuffle, records of a group with the same fields and trust are reduced to the most recent one (that is dominance
too), so a group of any size arrives as at most 2**fields times the number of distinct trust values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import number


MOST_FIELDS = 10  # 2**fields running maxima a row


def skyline(df: DataFrame, group: list[str], fields: list[str], trust: Column, recency: Column, row_id: str) -> DataFrame:
    """The undominated records: group..., row_id, fields..., mask (bit i: field i is filled), layer (1 is the base), n_rows of the group.

    A field is filled if its value is neither null, NaN nor negative. Higher trust is better, null the worst; later recency is
    better, null the worst; ids are unique. Rows with a null in a group column belong to no group.
    """
    if len(fields) > MOST_FIELDS:
        raise ValueError(f"{len(fields)} fields: their combinations are kept in one row, so {MOST_FIELDS} at most; give more in several calls")
    rows = df.where(" and ".join(f"`{g}` is not null" for g in group))
    filled = lambda f: F.coalesce(number(f) >= 0, F.lit(False))
    mask = sum((F.when(filled(f), 1 << i).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    rows = rows.select(*group, mask.alias("mask"), trust.cast("double").alias("trust"), F.struct(recency.alias("at"), (-F.col(row_id)).alias("first"), *(number(f).alias(f) for f in fields)).alias("r"))
    kept = rows.groupBy(*group, "mask", "trust").agg(F.max("r").alias("r"), F.count("*").alias("n"))
    by = Window.partitionBy(*group)
    ahead = by.orderBy(F.col("trust").desc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    order = F.struct("r.at", "r.first")
    best = [F.max(F.when(F.col("mask").bitwiseAND(m) == m, order)).over(ahead) for m in range(1 << len(fields))]
    kept = kept.withColumn("best", F.get(F.array(*best), F.col("mask"))).withColumn("n_rows", F.sum("n").over(by))
    kept = kept.where(F.col("best") == order)
    policy = by.orderBy(F.col("trust").desc_nulls_last(), F.col("r.at").desc_nulls_last(), F.col("r.first").desc())
    kept = kept.withColumn("layer", F.row_number().over(policy))
    return kept.select(*group, (-F.col("r.first")).alias("row_id"), *(F.col(f"r.{f}").alias(f) for f in fields), "mask", "layer", "n_rows")


def survivors(df: DataFrame, group: list[str], fields: list[str], trust: Column, recency: Column, row_id: str) -> DataFrame:
    """One record per group of two or more rows: base_row_id, and per field its value, <field>_row (the donor) and <field>_layer; null if no row fills it."""
    s = skyline(df, group, fields, trust, recency, row_id).where("n_rows >= 2")
    give = lambda i, f: F.min(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.struct("layer", "row_id", f))).alias(f"x_{f}")
    out = s.groupBy(*group).agg(F.max("n_rows").alias("n_rows"), F.min(F.struct("layer", "row_id"))["row_id"].alias("base_row_id"), *(give(i, f) for i, f in enumerate(fields)))
    each = [c for f in fields for c in (F.col(f"x_{f}.{f}").alias(f), F.col(f"x_{f}.row_id").alias(f"{f}_row"), F.col(f"x_{f}.layer").alias(f"{f}_layer"))]
    return out.select(*group, "n_rows", "base_row_id", *each)


def field_donors(df: DataFrame, group: list[str], fields: list[str], trust: Column, recency: Column, row_id: str) -> DataFrame:
    """group..., field, row_id: the row whose value survives, for groups of two or more rows; no row for a field nobody fills."""
    one = survivors(df, group, fields, trust, recency, row_id)
    long = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}_row").alias("row_id")) for f in fields)))
    return one.select(*group, long.alias("x")).where("x.row_id is not null").select(*group, "x.field", "x.row_id")
