"""Queries of problems 1, 2, 8, 9 and 10 with their SQL counterparts where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.llm import bpe, mixing, percentiles, quality, survivors
from flowmark.session import cut, spelled_id, table

QS = [0.5, 0.95, 0.99]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.misfit_outputs(table(spark, d, "readings"), table(spark, d, "stage0_outputs")).select("output_id")


def p1_percentiles(spark: SparkSession, d: str) -> DataFrame:
    got = percentiles.span_percentiles(table(spark, d, "readings"), table(spark, d, "stage0_outputs"), QS)
    return got.select(F.col("k").alias("tmc_code"), F.date_from_unix_date("d0").cast("string").alias("obs_start"), F.date_from_unix_date("d1").cast("string").alias("obs_end"), "q", "n", "value")


def p1_digest(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of each sensor over all days, from daily digests (within a quarter mph between ranks)."""
    values = percentiles.clean_values(table(spark, d, "readings"), "tmc_code", "measurement_tstamp", "speed", 0.0, 120.0)
    return percentiles.digest_percentiles(percentiles.digest(values), ["k"], QS).withColumnRenamed("k", "tmc_code")


def performance_groups(spark: SparkSession, d: str) -> dict:
    rows = table(spark, d, "link_performance").withColumn("link_id", spelled_id("link_id"))
    rows = rows.withColumn("period", F.nullif(F.upper(F.btrim("period", F.lit(" \t\r\n"))), F.lit("")))
    return {"df": rows, "group": ["link_id", "period"], "fields": ["volume", "speed_mph", "travel_time", "doc"], "trust": F.col("iteration_no"), "recency": F.col("loaded_at"), "row_id": "perf_id"}


def t2_groups(spark: SparkSession, d: str) -> dict:
    rank = F.col("node_pair_tmc_rank")
    return {"df": table(spark, d, "link_t2"), "group": ["link_id", "period"], "fields": ["t2_hour", "min_speed_mph", "p_hr"], "trust": F.when(rank >= 1, -rank), "recency": F.col("updated_at"), "row_id": "t2_id"}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    a = survivors.field_donors(**performance_groups(spark, d)).select(F.lit("link_performance").alias("table_name"), "link_id", "period", "field", "row_id")
    return a.unionByName(survivors.field_donors(**t2_groups(spark, d)).select(F.lit("link_t2").alias("table_name"), "link_id", "period", "field", "row_id"))


def p2_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(**performance_groups(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_column(table(spark, d, "documents"))


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return bpe.round_trip(table(spark, d, "documents"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, weight (from the tails of the text's statistics) and n_tokens of each document."""
    weighted = quality.with_weight(table(spark, d, "documents"), ("source",))
    return cut(bpe.count_tokens(weighted, "_text", ("doc_id", "source", "weight")), "sizes")


def _mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sized(spark, d), table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture_report(_mixture(spark, d), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.unnatural_documents(table(spark, d, "documents"))


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics, robust scores and tails of each document."""
    stats = cut(quality.document_statistics(table(spark, d, "documents")), "measured")
    return quality.flag_tails(quality.robust_scores(stats, cut(quality.statistic_sketches(stats), "sketch")))


def p10_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles per language and statistic from the sketches of the documents of even and of odd days, merged."""
    docs = table(spark, d, "documents")
    stats = cut(quality.document_statistics(docs.withColumn("odd", F.coalesce(F.day("created_at") % 2, F.lit(0))), keep=("odd",)), "measured")
    return quality.sketch_quantiles(quality.merge_sketches(*(quality.statistic_sketches(stats.where(F.col("odd") == i)) for i in (0, 1))))


def p10_agreement(spark: SparkSession, d: str) -> DataFrame:
    return quality.label_agreement(table(spark, d, "documents"), table(spark, d, "doc_labels"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_percentiles, p1_digest, p2_found, p2_survivors, p8_ids, p8_round_trip, p9_mix, p9_shares, p10_found, p10_statistics, p10_sketches, p10_agreement)
}

_V = """
v AS (SELECT upper(trim(tmc_code, ' \t\r\n')) AS k, CAST(measurement_tstamp AS DATE) AS day, speed AS x FROM readings
      WHERE nullif(trim(tmc_code, ' \t\r\n'), '') IS NOT NULL AND speed BETWEEN 0 AND 120 AND NOT isnan(speed)),
o AS (SELECT *, upper(trim(tmc_code, ' \t\r\n')) AS k FROM stage0_outputs)"""

_P = """
f AS (SELECT *, TRY_CAST(trim(link_id, ' \t\r\n') AS DECIMAL(38, 9)) AS y, nullif(upper(trim(period, ' \t\r\n')), '') AS p FROM link_performance),
a AS (SELECT 'link_performance' AS table_name, CAST(y AS BIGINT) AS link_id, p AS period, perf_id AS row_id, CAST(iteration_no AS DOUBLE) AS trust, loaded_at AS seen,
             count(*) OVER (PARTITION BY CAST(y AS BIGINT), p) AS n, volume, speed_mph, travel_time, doc FROM f WHERE y = CAST(y AS BIGINT) AND p IS NOT NULL),
b AS (SELECT 'link_t2' AS table_name, link_id, period, t2_id AS row_id, CASE WHEN node_pair_tmc_rank >= 1 THEN -CAST(node_pair_tmc_rank AS DOUBLE) END AS trust, updated_at AS seen,
             count(*) OVER (PARTITION BY link_id, period) AS n, t2_hour, min_speed_mph, p_hr FROM link_t2 WHERE link_id IS NOT NULL AND period IS NOT NULL),
l AS (SELECT table_name, link_id, period, row_id, trust, seen, n, field, value FROM (UNPIVOT a ON volume, speed_mph, travel_time, doc INTO NAME field VALUE value)
      UNION ALL SELECT table_name, link_id, period, row_id, trust, seen, n, field, value FROM (UNPIVOT b ON t2_hour, min_speed_mph, p_hr INTO NAME field VALUE value)),
r AS (SELECT *, row_number() OVER (PARTITION BY table_name, link_id, period, field ORDER BY trust DESC NULLS LAST, seen DESC NULLS LAST, row_id) AS place
      FROM l WHERE n >= 2 AND value >= 0 AND NOT isnan(value))"""

SQL = {
    "p1_found": f"""WITH {_V}, e AS (SELECT output_id, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.99) AS p99 FROM o JOIN v ON o.k = v.k AND v.day BETWEEN o.obs_start AND o.obs_end GROUP BY output_id)
        SELECT output_id FROM o JOIN e USING (output_id) WHERE abs(observed_speed_p95_mph - p95) > 2.000000001 OR abs(observed_speed_p99_mph - p99) > 2.000000001""",
    "p1_percentiles": f"""WITH {_V}, s AS (SELECT DISTINCT k, obs_start, obs_end FROM o WHERE k IS NOT NULL AND obs_start <= obs_end),
        g AS (SELECT k, obs_start, obs_end, count(*) AS n, quantile_cont(x, [0.5, 0.95, 0.99]) AS vs FROM s JOIN v USING (k) WHERE day BETWEEN obs_start AND obs_end GROUP BY k, obs_start, obs_end)
        SELECT k AS tmc_code, CAST(CAST(obs_start AS DATE) AS VARCHAR) AS obs_start, CAST(CAST(obs_end AS DATE) AS VARCHAR) AS obs_end, CAST(unnest([0.5, 0.95, 0.99]) AS DOUBLE) AS q, n, unnest(vs) AS value FROM g""",
    "p1_digest": f"""WITH {_V}, g AS (SELECT k, count(*) AS n, quantile_disc(floor(x / 0.5), [0.5, 0.95, 0.99]) AS ignored, list(floor(x / 0.5) ORDER BY x) AS xs FROM v GROUP BY k),
        u AS (SELECT k, n, xs, CAST(unnest([0.5, 0.95, 0.99]) AS DOUBLE) AS q FROM g)
        SELECT k AS tmc_code, q, n, (xs[CAST(floor(q * (n - 1)) AS BIGINT) + 1] + 0.5) * 0.5 AS value FROM u""",
    "p2_survivors": f"""WITH {_P}, z AS (SELECT *, coalesce(trust, '-infinity'::DOUBLE) AS tr, coalesce(seen, '-infinity'::TIMESTAMP) AS at_, coalesce(volume >= 0 AND NOT isnan(volume), false)::INT + 2 * coalesce(speed_mph >= 0 AND NOT isnan(speed_mph), false)::INT
          + 4 * coalesce(travel_time >= 0 AND NOT isnan(travel_time), false)::INT + 8 * coalesce(doc >= 0 AND NOT isnan(doc), false)::INT AS mask FROM a),
        s AS (SELECT * FROM z WHERE NOT EXISTS (SELECT 1 FROM z o WHERE o.link_id = z.link_id AND o.period = z.period AND o.row_id <> z.row_id AND o.mask & z.mask = z.mask AND o.tr >= z.tr AND (o.at_ > z.at_ OR (o.at_ = z.at_ AND o.row_id < z.row_id)))),
        y AS (SELECT *, row_number() OVER (PARTITION BY link_id, period ORDER BY tr DESC, at_ DESC, row_id) AS layer FROM s WHERE n >= 2)
        SELECT link_id, period, any_value(n) AS n_rows, arg_min(row_id, layer) AS base_row_id, {", ".join(f"arg_min({f}, layer) FILTER (mask & {1 << i} > 0) AS {f}, arg_min(row_id, layer) FILTER (mask & {1 << i} > 0) AS {f}_row, CAST(min(layer) FILTER (mask & {1 << i} > 0) AS INT) AS {f}_layer" for i, f in enumerate(("volume", "speed_mph", "travel_time", "doc")))}
        FROM y GROUP BY link_id, period""",
    "p2_found": f"WITH {_P} SELECT table_name, link_id, period, field, row_id FROM r WHERE place = 1",
}
