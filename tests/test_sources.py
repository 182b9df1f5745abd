"""Sources, sinks and streams: round trips on small files."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmark.sources import readers, writers
from flowmark.streaming import readings as streams


def test_csv_with_a_column_map(spark, tmp_path):
    (tmp_path / "r.csv").write_text("code,measurement_tstamp,speed\nA,2025-01-01 00:00:00,50.5\nB,bad,x\n")
    rows = readers.read_readings(spark, str(tmp_path / "r.csv"), {"tmc_code": "code"}).orderBy("tmc_code").collect()
    assert rows[0]["speed"] == 50.5 and rows[1]["speed"] is None and rows[1]["measurement_tstamp"] is None and rows[0]["reference_speed"] is None
    with pytest.raises(ValueError, match="columns are missing"):
        readers.read_readings(spark, str(tmp_path / "r.csv"))


def test_period_files_and_union(spark, tmp_path):
    head = "link_id,from_node_id,to_node_id,link_type\n"
    (tmp_path / "am.csv").write_text(head + "1,1,2,101\n2,2,3,102\n")
    (tmp_path / "md.csv").write_text(head + "1,1,2,999\n")
    got = {r["link_id"]: (r["link_type"], r["periods"]) for r in readers.read_network_union(spark, {"AM": str(tmp_path / "am.csv"), "MD": str(tmp_path / "md.csv")}).collect()}
    assert got == {1: ("999", "AM;MD"), 2: ("102", "AM")}


def test_demand_table_round_trip(spark, tmp_path):
    rng = np.random.default_rng(0)
    m = [(i, *(float(x) if x > 0.7 else 0.0 for x in rng.random(30))) for i in range(1, 31)]
    wide = spark.createDataFrame(m, "o int, " + ", ".join(f"`{j}` double" for j in range(1, 31)))
    triples = readers.matrix_triples(wide, "o", [str(j) for j in range(1, 31)])
    path = str(tmp_path / "d.bin")
    n = writers.write_dtab(triples, path)
    assert n == triples.count() == readers.dtab_records(path)
    back = readers.read_dtab(spark, path)
    assert back.exceptAll(triples).count() == 0 and triples.exceptAll(back).count() == 0
    zones = spark.createDataFrame([(i, i + 100) for i in range(1, 16)], "zone_id int, new_id int")
    assert readers.remap_zones(back, zones).agg(F.min("o_zone_id"), F.max("d_zone_id")).first()[1] <= 115
    with open(path, "ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="bytes found"):
        readers.dtab_records(path)


def test_sinks_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", 2, 3.0)], "tmc_code string, id int, v double")
    writers.write_csv(df, str(tmp_path / "csv"), "run-1", gzip=True)
    assert {r["run_id"] for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()} == {"run-1"}
    with pytest.raises(Exception, match="(?i)exist"):
        writers.write_csv(df, str(tmp_path / "csv"), "run-2")
    writers.write_lookup(df, str(tmp_path / "lookup"), ["id"])
    writers.write_series(df, str(tmp_path / "series"))
    writers.write_by_corridor(df.withColumnRenamed("tmc_code", "corridor"), str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "by")).where("corridor = 'a'").count() == 1
    a = writers.manifest(str(tmp_path / "lookup"), rows=2)
    assert a == writers.manifest(str(tmp_path / "lookup"), rows=2) and writers.changed(str(tmp_path / "lookup")) == []
    (tmp_path / "lookup" / "new.txt").write_text("x")
    assert writers.changed(str(tmp_path / "lookup")) == ["new.txt"]


def test_windows_close_behind_the_watermark(spark, tmp_path):
    (tmp_path / "events.parquet").mkdir()
    rows = [(i, f"2025-01-01 00:{m:02d}:00", i % 3, "x", float(i)) for i, m in enumerate([0, 1, 20, 50])] + [(9, "2025-01-20 00:00:00", 1, "x", 1.0)]
    df = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    out = streams.finish(streams.tumbling(streams.source(spark, str(tmp_path)), late="1 hour")).collect()
    assert sorted(r["n"] for r in out) == [1, 1, 2]
    assert streams.finish(streams.sessions(streams.source(spark, str(tmp_path)), "10 minutes", "1 hour").select("user_id", "n")).count() == 4


def test_steps_and_install(spark, tmp_path):
    df = spark.range(3)
    path = writers.write_step(df, str(tmp_path), "episodes", "selected")
    assert path.endswith("03-episodes/selected") and spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError, match="unknown step"):
        writers.write_step(df, str(tmp_path), "other", "x")
    for n in (2, 5):
        writers.install(spark.range(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5 and spark.read.parquet(str(tmp_path / "t.before")).count() == 2


def test_cuts_are_kept_until_released(spark):
    from flowmark import session

    a = session.cut(spark.range(4), "test")
    assert a.count() == 4 and session.release(spark) >= 1
    assert session.release(spark) == 0
