"""Rankings, picks and precedence: always with a total order, nulls where stated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row per group in the given total order."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_place = 1").drop("_place")


def top_n(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= n)


def map_ranks(df: DataFrame, distance: str = "distance_to_tmc_ft", ordinal: str = "map_id") -> DataFrame:
    """df with link_rank, tmc_rank and pair_rank: by distance (null last), then ordinal, per link, sensor and node pair."""
    order = [F.col(distance).asc_nulls_last(), F.col(ordinal)]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("link_rank", rank("link_id")).withColumn("tmc_rank", rank("tmc")).withColumn("pair_rank", rank("from_node_id", "to_node_id"))


def representative(df: DataFrame, by: list[str]) -> DataFrame:
    """The representative episode per group: least speed, longest, earliest t2, smallest id."""
    return pick_first(df, by, [F.col("min_speed_mph").asc_nulls_last(), F.col("p_hr").desc_nulls_last(), F.col("t2_hour").asc_nulls_last(), F.col("t2_id")])


def precedence(key: list[str], *layers: tuple[str, DataFrame], field: str) -> DataFrame:
    """(key..., field, source): per key the first layer that has a non-null value; keys of all layers."""
    all_ = None
    for i, (name, df) in enumerate(layers):
        part = df.where(F.col(field).isNotNull()).select(*key, F.struct(F.lit(i).alias("i"), F.col(field).alias("v"), F.lit(name).alias("s")).alias("x"))
        all_ = part if all_ is None else all_.unionByName(part)
    return all_.groupBy(*key).agg(F.min("x").alias("x")).select(*key, F.col("x.v").alias(field), F.col("x.s").alias("source"))


def fallback_lookup(df: DataFrame, table: DataFrame, levels: list[list[str]], value: str, least: int = 5) -> DataFrame:
    """df with `value` as a median from the most specific level that has at least `least` rows, then the overall median, and `level`.

    Medians are made per level from `table`; what is joined grows with the number of distinct keys of a level only.
    """
    out = df
    names = []
    for i, keys in enumerate(levels):
        m = table.groupBy(*keys).agg(F.median(value).alias(f"_v{i}"), F.count(value).alias("_n")).where(F.col("_n") >= least).drop("_n")
        out = out.join(m, keys, "left")
        names.append(f"_v{i}")
    g = table.agg(F.median(value).alias("_all"))
    out = out.join(F.broadcast(g))  # one row
    level = F.coalesce(*(F.when(F.col(n).isNotNull(), F.lit(i)) for i, n in enumerate(names)), F.lit(len(names)))
    return out.withColumn(value, F.coalesce(*names, "_all")).withColumn("level", level).drop(*names, "_all")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df; evaluating it fails if a key occurs twice (the cardinality check of a join)."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", F.when(n > 1, F.raise_error(F.concat(F.lit("key occurs twice: "), F.to_json(F.struct(*keys)))).cast("bigint")).otherwise(n)).where("_n = 1").drop("_n")


def disjoint_union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two tables whose keys may not meet; evaluating it fails if they do."""
    both = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(2)), allowMissingColumns=True)
    w = Window.partitionBy(*keys)
    clash = F.min("_side").over(w) != F.max("_side").over(w)
    return both.withColumn("_ok", F.when(clash, F.raise_error(F.lit("keys of the two tables meet")).cast("boolean")).otherwise(True)).where("_ok").drop("_side", "_ok")


def fingerprint(df: DataFrame) -> DataFrame:
    """(n, xor, total): an order-free fingerprint of a table from 64-bit hashes of its rows."""
    h = F.xxhash64(*df.columns)
    return df.select(h.alias("h")).agg(F.count("*").alias("n"), F.bit_xor("h").alias("xor"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("total"))


def natural_order(c: Column) -> list[Column]:
    """Order of codes: numbers first by value, then texts."""
    n = c.try_cast("double")
    return [n.isNull().asc(), n.asc(), c.asc()]


def select_groups(members: DataFrame, group: str, member: str, winners: DataFrame, winner: str) -> DataFrame:
    """(group, n_sensors, n_winning, selected): every group with its members, those of them that win, and whether it holds one."""
    own = members.where(F.col(group).isNotNull() & F.col(member).isNotNull()).select(group, member).distinct()
    w = winners.select(F.col(winner).alias(member), F.lit(1).alias("_w")).distinct()
    return own.join(w, member, "left").groupBy(group).agg(F.count("*").alias("n_sensors"), F.count("_w").alias("n_winning")).withColumn("selected", F.col("n_winning") > 0)


def dense_ids(df: DataFrame, key: str, out: str) -> DataFrame:
    """df with numbers from 0 in order of a unique key, for tables of zones and the like (the order is global)."""
    return df.withColumn(out, (F.row_number().over(Window.orderBy(key)) - 1).cast("bigint"))
