"""Mixing sources to target weights (problem 9).

The largest total is taken at which every source can give its share within its cap. Each source gives its complete epochs
first; the rest of its budget is filled by weighted sampling without replacement after Efraimidis and Spirakis: documents
in ascending order of -ln(u) / weight, u a fixed random number of the document and weight its quality (quality.with_weight). The prefix sums are made in two levels
(tokens per bucket of the key, then inside the one bucket where the budget ends), so no source is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmark.session import cut

BUCKETS = 16_384  # per source; the bucket table has at most sources times this many rows
LISTED = 1_000_000  # rows up to which a table of sources or buckets is broadcast; a larger one is joined by shuffle


def counted(df: DataFrame, label: str) -> DataFrame:
    """df, written and counted, with a hint to broadcast it if it has at most LISTED rows."""
    df = cut(df, label)
    return F.broadcast(df) if df.count() <= LISTED else df


def sampling_key(doc_id: str, weight: str, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.col(weight)


def distinct_targets(targets: DataFrame) -> DataFrame:
    """One row per named source; of repeated ones the greatest share and repeats count."""
    return targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def source_plan(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source that has tokens: target_share, max_repeats, size, budget, epochs (complete), rest (tokens).

    Sources without any token can't contribute; the others keep their proportions. Null sources are no source.
    """
    sizes = docs.where("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("size"), F.count("*").alias("n_docs"))
    rows = distinct_targets(targets).where("target_share > 0 and max_repeats > 0").join(sizes, "source").where("size > 0")
    total = F.min(F.col("max_repeats") * F.col("size") / F.col("target_share")).over(Window.partitionBy(F.lit(1)))
    rows = rows.withColumn("budget", total * F.col("target_share"))
    epochs = F.least(F.floor(F.col("budget") / F.col("size") + 1e-9), F.col("max_repeats").cast("bigint"))
    return rows.withColumn("epochs", epochs).withColumn("rest", F.greatest(F.col("budget") - F.col("epochs") * F.col("size"), F.lit(0.0)))


def mix_sources(docs: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, source, n_tokens, repeats (at least 1, at most the source's max_repeats) of the documents in the mixture.

    docs: doc_id, source, n_tokens, weight (above 0). Documents of no tokens or no target source are left out. The last
    document of a source is taken if at least half of it fits. Ties in the key are broken by doc_id.
    """
    docs = docs.where("source is not null and n_tokens > 0 and weight > 0").select("doc_id", "source", "n_tokens", "weight")
    plan = counted(source_plan(docs, targets).select("source", "max_repeats", "epochs", "rest"), "plan")
    rows = docs.join(plan, "source").withColumn("key", sampling_key("doc_id", "weight", seed))
    rows = rows.withColumn("bucket", F.least(F.floor((1 - F.exp(-0.6 * F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fill = rows.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("limit")).withColumn("upto", F.sum("t").over(w))
    fill = fill.where(F.col("upto") - F.col("t") < F.col("limit")).select("source", "bucket", (F.col("upto") - F.col("t")).alias("before"), "upto", "limit")
    rows = rows.join(counted(fill, "fill"), ["source", "bucket"], "left")
    sure = F.coalesce(F.col("upto") <= F.col("limit"), F.lit(False))
    edge = rows.where(F.col("limit").isNotNull() & (F.col("upto") > F.col("limit")))
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.col("before") + F.sum("n_tokens").over(order)
    edge = edge.withColumn("more", (run - F.col("n_tokens") / 2 <= F.col("limit")).cast("int"))
    rest = rows.where(F.col("limit").isNull() | (F.col("upto") <= F.col("limit"))).withColumn("more", sure.cast("int"))
    both = rest.unionByName(edge).withColumn("repeats", F.least(F.col("epochs") + F.col("more"), F.col("max_repeats").cast("bigint")))
    return both.where("repeats >= 1").select("doc_id", "source", "n_tokens", "repeats")


def mixture_report(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: target_share, tokens, share reached, documents and the most repeats; zeros for sources that give nothing."""
    got = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("n_docs"), F.max("repeats").alias("most_repeats"))
    rows = distinct_targets(targets).join(got, "source", "left").na.fill(0, ["tokens", "n_docs", "most_repeats"])
    share = F.col("tokens") / F.nullif(F.sum("tokens").over(Window.partitionBy(F.lit(1))), F.lit(0))
    return rows.select("source", "target_share", "max_repeats", "tokens", share.alias("share"), "n_docs", "most_repeats")
