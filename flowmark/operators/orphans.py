"""References to records that do not exist (problem 5).

A split-block Bloom filter of all parent keys is built by aggregation (one row of four 64-bit words per block) and broadcast;
its size is fixed by MOST_BLOCKS. A reference whose bits aren't all set is a proven orphan. The rest is verified exactly by
one pass in time order per key over parent versions and references (no pairs are made): a running maximum of valid_to over
the versions begun so far tells whether one still holds. Keys with very many references are split by salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import hot_keys, micros

KEYS_PER_BLOCK = 16  # 16 bits a key: about 0.3 % false positives
MOST_BLOCKS = 1 << 20  # about 48 MB broadcast at most; beyond it only more references are verified exactly
HOT = 1_000_000  # references of one key that stay together
MOST_SALTS = 1024  # of one key; its versions are repeated as often
_LOW, _HIGH = -(1 << 62), (1 << 62)


def _block(k: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(k), F.lit(blocks)).cast("int")


def _bit(k: str, i: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({k}, 77), {6 * i}) & 63 as int))")


def bloom_blocks(keys: DataFrame, k: str, blocks: int) -> DataFrame:
    """The filter as a table (block, w0..w3) of at most `blocks` rows."""
    rows = keys.select(_block(k, blocks).alias("block"), *(_bit(k, i).alias(f"b{i}") for i in range(4)))
    return rows.groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(4)))


def block_count(keys: DataFrame, k: str) -> int:
    n = keys.agg(F.approx_count_distinct(k)).first()[0]
    return max(1, min(MOST_BLOCKS, n // KEYS_PER_BLOCK + 1))


def find_orphans(refs: DataFrame, parents: DataFrame, key: str = "link_id", at: str = "loaded_at", row_id: str = "row_id", hot: int = HOT) -> DataFrame:
    """The rows of refs that have no valid parent row when loaded, with `reason`: missing, later or deleted.

    refs needs key (bigint; rows with null are no references and never come out), at, row_id. parents needs key, valid_from,
    valid_to (null = still valid), one row per version; repeated versions don't matter. A null valid_from holds never; a null
    load time falls into no version and counts as missing or deleted. Columns of refs are kept as they are (a `reason` of
    their own is replaced); repeated references come out as often as they are there.
    """
    known = parents.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), micros("valid_from").alias("_from"), micros("valid_to").alias("_to"))
    ids = known.select("_k").distinct()
    blocks = block_count(known, "_k")
    named = refs.where(F.col(key).isNotNull()).select(F.struct("*").alias("_row"), F.col(key).alias("_k"), micros(at).alias("_at"), F.col(row_id).alias("_id"), _block(key, blocks).alias("_block"))
    bloom = bloom_blocks(ids, "_k", blocks).withColumnRenamed("block", "_block")
    tested = named.join(F.broadcast(bloom), "_block", "left")  # at most MOST_BLOCKS rows
    maybe = F.lit(True)
    for i in range(4):
        maybe = maybe & (F.col(f"w{i}").bitwiseAND(_bit("_k", i)) != 0)
    tested = tested.withColumn("_maybe", F.coalesce(maybe, F.lit(False)))
    proven = tested.where(~F.col("_maybe")).select("_row", F.lit("missing").alias("_reason"))

    rest = tested.where("_maybe").select("_row", "_k", "_at", "_id")
    salts = F.least(F.ceil(F.col("n") / hot) * 2, F.lit(MOST_SALTS)).cast("int")
    busy = F.broadcast(hot_keys(rest, "_k", hot).select("_k", salts.alias("_salts")))  # at most rows / hot keys
    rest = rest.join(busy, "_k", "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    spread = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    begun = F.coalesce("_from", F.lit(_LOW + 1))
    till = F.when(F.col("_from").isNull(), F.lit(_LOW + 1)).otherwise(F.coalesce("_to", F.lit(_HIGH)))
    versions = known.select("_k", begun.alias("_t"), till.alias("_till")).unionAll(ids.select("_k", F.lit(_LOW).alias("_t"), F.lit(_LOW).alias("_till"))).distinct()
    versions = versions.join(busy, "_k", "left").select("_k", spread.alias("_salt"), "_t", "_till", F.lit(0).alias("_kind"), F.lit(None).cast(rest.schema["_row"].dataType).alias("_row"))
    asked = rest.select("_k", "_salt", F.coalesce("_at", F.lit(_HIGH)).alias("_t"), F.lit(None).cast("bigint").alias("_till"), F.lit(1).alias("_kind"), "_row")
    w = Window.partitionBy("_k", "_salt").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = versions.unionByName(asked).withColumn("_most", F.max("_till").over(w)).where("_kind = 1")
    lost = seen.where(F.col("_most").isNull() | (F.col("_most") <= F.col("_t")) | (F.col("_t") == _HIGH))
    reason = F.when(F.col("_most").isNull(), "missing").when(F.col("_most") == _LOW, "later").otherwise("deleted")
    plain = [F.col(f"_row.`{c}`") for c in refs.columns if c != "reason"]
    return proven.unionByName(lost.select("_row", reason.alias("_reason"))).select(*plain, F.col("_reason").alias("reason"))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, period and reason."""
    return orphans.groupBy("table_name", "period", "reason").agg(F.count("*").alias("n_rows"), F.countDistinct("link_id").alias("n_links"))
