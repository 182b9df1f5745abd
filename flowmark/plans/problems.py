"""Queries of the general data problems (3 to 7) with their SQL counterparts where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.operators.grid import regular_grid
from flowmark.operators.intervals import coverage_and_gaps
from flowmark.operators.orphans import find_orphans, orphan_report
from flowmark.operators.spikes import flag_implausible
from flowmark.operators.timestamps import normalise_timestamps, parser_report
from flowmark.session import number, spelled_id, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return normalise_timestamps(table(spark, d, "readings_raw"), table(spark, d, "feeds")).where("utc_us is not null")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return parser_report(table(spark, d, "readings_raw"), table(spark, d, "feeds"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_grid(spark, d).where("missing").select("tmc_code", "slot_s")


def p4_grid(spark: SparkSession, d: str) -> DataFrame:
    return regular_grid(table(spark, d, "readings"))


def link_references(spark: SparkSession, d: str) -> DataFrame:
    """All references to links, one row each: table_name, row_id, link_id (as read), period, loaded_at."""
    a = table(spark, d, "tmc_mapping").select(F.lit("tmc_mapping").alias("table_name"), F.col("map_id").alias("row_id"), "link_id", "period", "loaded_at")
    b = table(spark, d, "link_performance").select(F.lit("link_performance").alias("table_name"), F.col("perf_id").alias("row_id"), spelled_id("link_id").alias("link_id"), "period", "loaded_at")
    return a.unionByName(b).withColumn("period", F.upper(F.btrim("period", F.lit(" \t"))))


def p5_orphans(spark: SparkSession, d: str) -> DataFrame:
    return find_orphans(link_references(spark, d), table(spark, d, "link"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_orphans(spark, d).select("table_name", "row_id", "reason")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p5_orphans(spark, d))


def p6_periods(spark: SparkSession, d: str) -> DataFrame:
    minutes = lambda c: F.round(number(c) * 60).cast("bigint")
    rows = table(spark, d, "link_t2").select("link_id", minutes("t0_hour").alias("start_min"), minutes("t3_hour").alias("end_min"))
    return coverage_and_gaps(rows, "link_id", "start_min", "end_min")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    rows = p6_periods(spark, d).where("kind = 'gap' or n_rows >= 2")
    return rows.select("link_id", F.when(F.col("kind") == "gap", "gap").otherwise("merged").alias("kind"), "start_min", "end_min")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return flag_implausible(table(spark, d, "readings")).select("reading_id")


def p7_flags(spark: SparkSession, d: str) -> DataFrame:
    """Flags per sensor and kind."""
    return flag_implausible(table(spark, d, "readings")).groupBy("tmc_code", "kind").agg(F.count("*").alias("n_readings"))


QUERIES = {f.__name__: f for f in (p3_found, p3_report, p4_found, p4_grid, p5_found, p5_report, p6_found, p6_periods, p7_found, p7_flags)}

_SLOTS = """
b AS (SELECT DISTINCT upper(trim(tmc_code, ' \t\r\n')) AS tmc_code, epoch_us(measurement_tstamp) // 900000000 AS slot FROM readings
      WHERE nullif(trim(tmc_code, ' \t\r\n'), '') IS NOT NULL AND speed IS NOT NULL AND NOT isnan(speed) AND measurement_tstamp IS NOT NULL),
g AS (SELECT *, lead(slot) OVER (PARTITION BY tmc_code ORDER BY slot) AS nxt FROM b)"""

_REFS = """
spelled AS (SELECT perf_id, period, loaded_at, TRY_CAST(trim(link_id, ' \t\r\n') AS DECIMAL(38, 9)) AS x FROM link_performance),
refs AS (SELECT 'tmc_mapping' AS table_name, map_id AS row_id, link_id, upper(trim(period, ' \t')) AS period, loaded_at FROM tmc_mapping WHERE link_id IS NOT NULL
         UNION ALL SELECT 'link_performance', perf_id, CAST(x AS BIGINT), upper(trim(period, ' \t')), loaded_at FROM spelled WHERE x = CAST(x AS BIGINT)),
firsts AS (SELECT link_id, min(valid_from) AS first_from FROM link GROUP BY link_id),
orphans AS (SELECT r.*, CASE WHEN f.link_id IS NULL THEN 'missing' WHEN r.loaded_at < f.first_from THEN 'later' ELSE 'deleted' END AS reason
            FROM refs r LEFT JOIN firsts f ON r.link_id = f.link_id
            WHERE NOT EXISTS (SELECT 1 FROM link l WHERE l.link_id = r.link_id AND l.valid_from <= r.loaded_at AND (l.valid_to IS NULL OR r.loaded_at < l.valid_to)))"""

_PERIODS = """
i AS (SELECT link_id, CAST(round(t0_hour * 60) AS BIGINT) AS s, CAST(round(t3_hour * 60) AS BIGINT) AS e, count(*) AS c FROM link_t2
      WHERE link_id IS NOT NULL AND t0_hour IS NOT NULL AND t3_hour IS NOT NULL AND NOT isnan(t0_hour) AND NOT isnan(t3_hour) GROUP BY ALL),
m AS (SELECT *, max(e) OVER (PARTITION BY link_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM i WHERE e > s),
n AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY link_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS piece FROM m),
p AS (SELECT link_id, min(s) AS start_min, max(e) AS end_min, CAST(sum(c) AS BIGINT) AS n_rows FROM n GROUP BY link_id, piece),
q AS (SELECT *, lead(start_min) OVER (PARTITION BY link_id ORDER BY start_min) AS nxt FROM p)"""

SQL = {
    "p4_found": f"WITH {_SLOTS} SELECT tmc_code, CAST(u.s * 900 AS BIGINT) AS slot_s FROM g, unnest(range(slot + 1, nxt)) AS u(s) WHERE nxt - slot - 1 BETWEEN 1 AND 192",
    "p5_found": f"WITH {_REFS} SELECT table_name, row_id, reason FROM orphans",
    "p5_report": f"WITH {_REFS} SELECT table_name, period, reason, count(*) AS n_rows, count(DISTINCT link_id) AS n_links FROM orphans GROUP BY table_name, period, reason",
    "p6_found": f"""WITH {_PERIODS} SELECT link_id, 'merged' AS kind, start_min, end_min FROM p WHERE n_rows >= 2
        UNION ALL SELECT link_id, 'gap', end_min, nxt FROM q WHERE nxt IS NOT NULL""",
    "p6_periods": f"""WITH {_PERIODS} SELECT link_id, 'period' AS kind, start_min, end_min, n_rows FROM p
        UNION ALL SELECT link_id, 'gap', end_min, nxt, NULL FROM q WHERE nxt IS NOT NULL""",
}
