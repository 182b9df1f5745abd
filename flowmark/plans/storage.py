"""Queries of sources and sinks: written to the shared folder, read back, and compared with SQL over the tables they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmark.functions import text
from flowmark.operators import performance, profiles, ranking
from flowmark.plans.measurement import _M, _R, _W, members, readings, registry, slots
from flowmark.plans.relational import _L, _MAP, _P, _REP, links, mapping, performance_rows
from flowmark.session import code, cut, scratch, table
from flowmark.sources import readers, writers

QUERIES, SQL = {}, {}
query = registry(QUERIES, SQL)


@query(f"WITH {_R} SELECT tmc_code, us, speed, reference_speed, confidence_score, 'run-1' AS run_id FROM r")
def csv_readings(spark: SparkSession, d: str) -> DataFrame:
    """Readings as CSV under other column names, every row with the run's id, read by a column map."""
    path = scratch(spark, "csv-readings")
    rows = readings(spark, d).select(F.col("tmc_code").alias("Code"), F.col("ts").cast("timestamp_ntz").alias("measurement_tstamp"), F.col("speed").alias("Speed MPH"), "reference_speed", "confidence_score")
    writers.write_csv(rows, path, "run-1")
    got = readers.read_readings(spark, path, {"tmc_code": "Code", "speed": "Speed MPH"})
    ids = spark.read.option("header", True).csv(path).select("run_id").distinct()
    return got.join(F.broadcast(ids)).select("tmc_code", F.unix_micros(F.col("measurement_tstamp").cast("timestamp")).alias("us"), "speed", "reference_speed", "confidence_score", "run_id")  # one id


@query(f"""WITH {_W} SELECT source, tmc_code, t_min, round(speed, 8) AS speed, round(CASE WHEN source = 'measured' THEN speed * 30 END, 7) AS flow FROM p, (VALUES ('readings'), ('average_weekday'), ('measured')) k(source)""")
def source_dispatch(spark, d):
    """The average weekday from each kind of source: from readings, supplied, and supplied with measured flow."""
    raw, day = scratch(spark, "raw"), scratch(spark, "weekday")
    writers.write_csv(readings(spark, d).select("tmc_code", F.col("ts").cast("timestamp_ntz").alias("measurement_tstamp"), "speed"), raw, "run-1")
    writers.write_csv(profiles.weekday_profile(slots(spark, d)).select(F.col("tmc_code").alias("tmc"), "t_min", "speed", (F.col("speed") * 30).alias("flow")), day, "run-1")
    specs = [{"source": "readings", "path": raw}] + [{"source": k, "path": day, "columns": {"tmc_code": "tmc"}} for k in ("average_weekday", "measured")]
    parts = [readers.load_source(spark, s).withColumn("source", F.lit(s["source"])).withColumn("flow", F.round("flow", 7)) for s in specs]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_KEYS = """key AS (SELECT tmc AS tmc_code, coalesce(nullif(regexp_replace(upper(trim(road)), '[^A-Z0-9]+', '', 'g'), ''), 'UNNAMED') || '_' || left(direction, 1) AS corridor FROM meta WHERE place = 1 AND road IS NOT NULL AND direction IN ('NB', 'SB', 'EB', 'WB'))"""


def keyed_members(spark, d) -> DataFrame:
    m = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("road is not null and direction in ('NB', 'SB', 'EB', 'WB')")
    return m.select(F.col("tmc").alias("tmc_code"), text.corridor_key(F.col("road"), F.col("direction")).alias("corridor"))


def corridor_slices(spark, d) -> DataFrame:
    path = scratch(spark, "slices")
    writers.write_by_corridor(profiles.weekday_profile(slots(spark, d)).join(keyed_members(spark, d), "tmc_code").select("tmc_code", "t_min", "speed", F.col("corridor").alias("corridor_key")), path, "corridor_key")
    return readers.with_corridor(spark.read.option("basePath", path).parquet(path).drop("corridor_key"), r"/corridor_key=([^/]+)/[^/]+$")


@query(f"WITH {_W}, {_M}, {_KEYS} SELECT corridor, count(*) AS n, count(DISTINCT tmc_code) AS n_sensors, round(avg(speed), 8) AS mean_speed FROM p JOIN key USING (tmc_code) GROUP BY corridor")
def corridor_folders(spark, d):
    """Slices of the weekday written to one folder per corridor and found again by their folders."""
    return corridor_slices(spark, d).groupBy("corridor").agg(F.count("*").alias("n"), F.countDistinct("tmc_code").alias("n_sensors"), F.avg("speed").alias("mean_speed"))


@query(f"""WITH {_W}, {_M}, {_KEYS}, {_MAP}, win AS (SELECT DISTINCT tmc FROM mp WHERE node_pair_tmc_rank = 1), sl AS (SELECT DISTINCT corridor, tmc_code FROM p JOIN key USING (tmc_code))
SELECT corridor, count(*) AS n_sensors, count(win.tmc) AS n_winning, count(win.tmc) > 0 AS selected FROM sl LEFT JOIN win ON sl.tmc_code = win.tmc GROUP BY corridor""")
def corridor_selection(spark, d):
    """Corridors that hold at least one winning sensor, with an audit row for every corridor found."""
    winners = mapping(spark, d).where("node_pair_tmc_rank = 1").select("tmc")
    return ranking.select_groups(corridor_slices(spark, d), "corridor", "tmc_code", winners, "tmc")


_PARTS = "pk(period, k) AS (VALUES ('MD', 0), ('AM', 1), ('PM', 2)), pl AS (SELECT period, lk.*, CASE WHEN (link_id + k) % 7 = 0 THEN 'closed' WHEN (link_id + k) % 7 = 1 THEN 'sov;hov2' ELSE 'sov' END AS use, CASE WHEN link_id % 11 < 2 THEN link_id % 11 + 2 ELSE 0 END AS limit_code FROM lk, pk WHERE (link_id + k) % 5 <> 0)"


def period_tables(spark, d) -> DataFrame:
    """Links by period, for the files of a network with periods: some links lack a period, some are closed in one."""
    k = F.when(F.col("period") == "MD", 0).when(F.col("period") == "AM", 1).otherwise(2)
    rows = links(spark, d).withColumn("period", F.explode(F.array(F.lit("MD"), F.lit("AM"), F.lit("PM")))).where((F.col("link_id") + k) % 5 != 0)
    use = F.when((F.col("link_id") + k) % 7 == 0, "closed").when((F.col("link_id") + k) % 7 == 1, "sov;hov2").otherwise("sov")
    return rows.withColumn("use", use).withColumn("limit_code", F.when(F.col("link_id") % 11 < 2, F.col("link_id") % 11 + 2).otherwise(0))


def period_files(spark, rows: DataFrame, label: str) -> dict[str, str]:
    paths = {}
    for p in ("AM", "MD", "PM"):
        paths[p] = scratch(spark, f"{label}-{p}")
        writers.write_csv(rows.where(F.col("period") == p).drop("period"), paths[p], "run-1")
    return paths


_OPEN = "lower(trim(use)) NOT IN ('', '0', 'closed', 'nan', 'none')"


@query(f"""WITH {_L}, {_PARTS}, f AS (SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY CASE period WHEN 'MD' THEN 1 WHEN 'AM' THEN 2 ELSE 3 END) AS place FROM pl),
o AS (SELECT link_id, string_agg(period, ';' ORDER BY period) AS periods, string_agg(period, ';' ORDER BY period) FILTER ({_OPEN}) AS open_in FROM pl GROUP BY link_id)
SELECT link_id, from_node_id, to_node_id, round(length, 8) AS length, periods, coalesce(open_in, '') AS open_in, CASE WHEN limit_code IN (2, 3) THEN 'managed' ELSE 'general_purpose' END AS lane_class FROM f JOIN o USING (link_id) WHERE place = 1""")
def links_of_periods(spark, d):
    """Links of three period files as one table: from the first period that has them, with the periods they are in and open in, and the class of their lanes."""
    paths = period_files(spark, period_tables(spark, d).select("period", "link_id", "from_node_id", "to_node_id", "length", "use", "limit_code"), "links")
    ddl = "link_id bigint, from_node_id bigint, to_node_id bigint, length double, use string, limit_code int"
    status = readers.read_periods(spark, paths, ddl).groupBy("link_id").agg(F.array_join(F.array_sort(F.collect_list(F.when(text.is_open(F.col("use")), F.col("period")))), ";").alias("open_in"))
    lane = F.when(F.col("limit_code").isin(2, 3), "managed").otherwise("general_purpose")
    return readers.read_network_union(spark, paths, ddl).join(status, "link_id").select("link_id", "from_node_id", "to_node_id", "length", "periods", "open_in", lane.alias("lane_class"))


@query(f"""WITH {_L}, {_PARTS}, n AS (SELECT DISTINCT period, from_node_id AS node_id, from_node_id % 1000 / 1000.0 - 77.5 + CASE period WHEN 'AM' THEN 0.5 ELSE 0 END AS lon, from_node_id % 700 / 700.0 + 38.5 AS lat FROM pl WHERE from_node_id IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY CASE period WHEN 'MD' THEN 1 WHEN 'AM' THEN 2 ELSE 3 END) AS place FROM n) SELECT node_id, round((lon + 77.0) * 365228.0 * cos(radians(39.0)), 4) AS x_ft, round((lat - 39.0) * 362664.0, 4) AS y_ft FROM f WHERE place = 1""")
def nodes_of_periods(spark, d):
    n = F.col("from_node_id")
    lon = (n % 1000) / 1000 - 77.5 + F.when(F.col("period") == "AM", 0.5).otherwise(0.0)
    rows = period_tables(spark, d).where("from_node_id is not null").select("period", n.alias("node_id"), lon.alias("longitude"), ((n % 700) / 700 + 38.5).alias("latitude")).distinct()
    out = readers.read_nodes_union(spark, period_files(spark, rows, "nodes"), origin=(-77.0, 39.0))
    return out.select("node_id", F.round("x_ft", 4).alias("x_ft"), F.round("y_ft", 4).alias("y_ft"))


@query(f"""WITH {_MAP}, o AS (SELECT map_id, tmc, link_id, period, row_number() OVER (PARTITION BY period ORDER BY map_id) - 1 AS place FROM mp WHERE period IN ('AM', 'MD', 'PM')) SELECT map_id, tmc, link_id, period, CAST(CASE period WHEN 'AM' THEN 0 WHEN 'MD' THEN 1 ELSE 2 END * 10000000 + place AS BIGINT) AS occurrence FROM o""")
def period_maps(spark, d):
    """Maps of three period files with a global occurrence: the file's number times ten million plus the row's place."""
    m = mapping(spark, d).where("period in ('AM', 'MD', 'PM')").select("map_id", "tmc", "link_id", "period")
    rows = readers.read_periods(spark, period_files(spark, m, "maps"), "map_id bigint, tmc string, link_id bigint")
    return readers.with_occurrence(rows.withColumn("tmc", code("tmc")), "period", ["AM", "MD", "PM"], "map_id")


@query(f"WITH {_REP} SELECT t2_id, link_id, period, round(t2_hour, 8) AS t2 FROM rep WHERE place = 1 AND t2_hour IS NOT NULL")
def episode_files(spark, d):
    """Episodes of a run from its numbered folder, though an older folder is there too."""
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("t2_hour is not null").select("t2_id", "link_id", "period", F.col("t2_hour").alias("t2"), F.lit(True).alias("accepted"))
    root = scratch(spark, "run")
    writers.write_step(e, root, "episodes", "selected")
    e.limit(0).write.parquet(f"{root}/episodes")
    return readers.read_episode_files(spark, root, ("03-episodes/selected", "episodes"), "t2_id bigint, link_id bigint, period string, t2 double")


_OD = f"{_P}, od AS (SELECT CAST(link_id % 97 AS INT) AS o, CAST(link_id % 53 AS INT) AS d, sum(volume) AS volume FROM pf WHERE link_id IS NOT NULL AND volume > 0 GROUP BY ALL)"


def trips(spark, d) -> DataFrame:
    p = performance_rows(spark, d).where("link_id is not null and volume > 0")
    return p.groupBy((F.col("link_id") % 97).cast("int").alias("o_zone_id"), (F.col("link_id") % 53).cast("int").alias("d_zone_id")).agg(F.sum("volume").alias("volume"))


@query(f"WITH {_OD} SELECT o AS o_zone_id, d AS d_zone_id, round(volume, 6) AS volume FROM od")
def binary_demand(spark, d):
    """A demand table in binary form, written and read in parts."""
    path = scratch(spark, "demand") + ".dtab"
    writers.write_dtab(trips(spark, d), path)
    return readers.read_dtab(spark, path)


@query(f"WITH {_OD}, z AS (SELECT zone, dense_rank() OVER (ORDER BY zone) - 1 AS id FROM (SELECT DISTINCT o AS zone FROM od WHERE o % 10 <> 3)) SELECT CAST(a.id AS BIGINT) AS o_zone_id, CAST(b.id AS BIGINT) AS d_zone_id, round(volume, 6) AS volume FROM od JOIN z a ON od.o = a.zone JOIN z b ON od.d = b.zone")
def remapped_demand(spark, d):
    """Demand between compact zone ids; trips of unknown zones are left out."""
    t = cut(trips(spark, d), "trips")
    zones = t.where("o_zone_id % 10 != 3").groupBy(F.col("o_zone_id").alias("zone_id")).agg(F.lit(1).alias("one"))
    return readers.remap_zones(t, ranking.dense_ids(zones, "zone_id", "new_id"))


@query(f"WITH {_OD} SELECT o AS o_zone_id, d AS d_zone_id, round(volume, 6) AS volume FROM od WHERE d < 20")
def demand_matrix(spark, d):
    """A matrix with a column per destination, back to one row per pair with trips."""
    ds = [str(i) for i in range(20)]
    wide = trips(spark, d).where("d_zone_id < 20").groupBy("o_zone_id").pivot("d_zone_id", [int(x) for x in ds]).agg(F.sum("volume"))
    return readers.matrix_triples(wide, "o_zone_id", ds)


@query(f"WITH {_MAP} SELECT from_node_id, to_node_id, min(distance_to_tmc_ft) AS best FROM mp WHERE from_node_id IS NOT NULL AND to_node_id IS NOT NULL GROUP BY ALL")
def sorted_lookup(spark, d):
    """A lookup with unique keys, sorted and range-partitioned, read back."""
    u = mapping(spark, d).where("from_node_id is not null and to_node_id is not null").groupBy("from_node_id", "to_node_id").agg(F.min("distance_to_tmc_ft").alias("best"))
    path = scratch(spark, "lookup")
    writers.write_lookup(u, path, ["from_node_id", "to_node_id"])
    return spark.read.parquet(path)


@query(f"WITH {_W} SELECT tmc_code, count(*) AS n, round(min(speed), 8) AS least, round(max(speed), 8) AS most FROM s GROUP BY tmc_code")
def series_parquet(spark, d):
    """Series sorted by sensor inside files, and the summary per sensor made from what was written."""
    path = scratch(spark, "series")
    writers.write_series(slots(spark, d), path)
    return spark.read.parquet(path).groupBy("tmc_code").agg(F.count("*").alias("n"), F.min("speed").alias("least"), F.max("speed").alias("most"))


@query(f"WITH {_W} SELECT step, tmc_code, t_min, round(speed, 8) AS speed FROM p, (VALUES ('01-input-and-qc'), ('07-tables')) x(step)")
def numbered_steps(spark, d):
    """Results under the numbered folders of a run; a second write of one is refused."""
    from pyspark.errors import AnalysisException

    root, p = scratch(spark, "steps"), profiles.weekday_profile(slots(spark, d)).select("tmc_code", "t_min", "speed")
    paths = {s: writers.write_step(p, root, s.split("-", 1)[1], "profile") for s in ("01-input-and-qc", "07-tables")}
    try:
        writers.write_step(p, root, "tables", "profile")
        raise AssertionError("a folder was written twice")
    except AnalysisException:
        pass
    return spark.read.parquet(*paths.values()).withColumn("step", F.regexp_extract(F.input_file_name(), r"/(\d\d-[^/]+)/profile/", 1)).select("step", "tmc_code", "t_min", "speed")


@query(f"WITH {_L} SELECT 'now' AS version, link_id, lanes + 1 AS lanes FROM lk UNION ALL SELECT 'before', link_id, lanes FROM lk")
def installed_table(spark, d):
    """A table replaced by a new version, with the old one kept beside."""
    path, l = scratch(spark, "installed"), links(spark, d).select("link_id", "lanes")
    writers.install(l, path)
    writers.install(l.withColumn("lanes", F.col("lanes") + 1), path)
    return spark.read.parquet(path).withColumn("version", F.lit("now")).unionByName(spark.read.parquet(path + ".before").withColumn("version", F.lit("before"))).select("version", "link_id", "lanes")


@query(f"""WITH {_MAP}, w AS (SELECT *, row_number() OVER (PARTITION BY link_id, period ORDER BY node_pair_tmc_rank ASC NULLS LAST, map_id) AS k FROM mp) SELECT kind, tmc, link_id, map_id FROM (SELECT 'all' AS kind, * FROM w UNION ALL SELECT 'winner', * FROM w WHERE k = 1)""")
def mapping_artifacts(spark, d):
    """All pairs and the winners as two CSV tables, read by the columns that are needed."""
    m = mapping(spark, d).select("tmc", "link_id", "period", "map_id", "node_pair_tmc_rank", "distance_to_tmc_ft")
    win = ranking.pick_first(m, ["link_id", "period"], [F.col("node_pair_tmc_rank").asc_nulls_last(), F.col("map_id")])
    out = []
    for kind, part in (("all", m), ("winner", win)):
        path = scratch(spark, f"pairs-{kind}")
        writers.write_csv(part, path, "run-1")
        out.append(readers.read_csv(spark, path, "tmc string, link_id bigint, map_id bigint", required=["tmc", "link_id"]).withColumn("kind", F.lit(kind)))
    return out[0].unionByName(out[1]).select("kind", "tmc", "link_id", "map_id")


@query(f"WITH {_L} SELECT link_id, from_node_id, to_node_id, round(length, 8) AS length, row_number() OVER (ORDER BY link_id) - 1 AS place FROM lk")
def ordered_csv(spark, d):
    """Links written in chunks and merged into files whose order by link is the order of the table."""
    l, chunks, path = links(spark, d).select("link_id", "from_node_id", "to_node_id", "length"), scratch(spark, "chunks"), scratch(spark, "merged")
    for i in range(3):
        writers.write_csv(l.where(F.pmod("link_id", F.lit(3)) == i), f"{chunks}/{i}", "run-1")
    ddl = "link_id bigint, from_node_id bigint, to_node_id bigint, length double"
    writers.write_sorted_csv(readers.read_csv(spark, [f"{chunks}/{i}" for i in range(3)], ddl), path, ["link_id"], "run-1")
    return writers.with_file_order(readers.read_csv(spark, path, ddl), "place")


@query(f"WITH {_P} SELECT perf_id, link_id, period, round(volume, 6) AS volume FROM pf")
def gzip_performance(spark, d):
    """Performance rows as compressed CSV, read back."""
    path = scratch(spark, "performance")
    writers.write_csv(performance_rows(spark, d).select("perf_id", "link_id", "period", "volume"), path, "run-1", gzip=True)
    return readers.read_csv(spark, path, "perf_id bigint, link_id bigint, period string, volume double")


@query("""SELECT link_id, period, CAST(split_part(c, ':', 1) AS INT) * 60 + CAST(split_part(c, ':', 2) AS INT) AS t_min, round(CASE c WHEN '07:35' THEN speed_mph WHEN '16:05' THEN speed_mph + 1 END, 8) AS speed FROM (SELECT perf_id AS link_id, period, speed_mph FROM link_performance WHERE speed_mph IS NOT NULL), (VALUES ('07:35'), ('16:05')) k(c)""")
def wide_speed_scan(spark, d):
    """A file with a column per time of day, checked and read as one row per time."""
    path = scratch(spark, "wide")
    rows = table(spark, d, "link_performance").where("speed_mph is not null").select(F.col("perf_id").alias("link_id"), "period", F.col("speed_mph").alias("spd_mph_07:35"), (F.col("speed_mph") + 1).alias("spd_mph_16:05"))
    rows.write.parquet(path)
    return profiles.wide_to_long(readers.with_time_columns(spark.read.parquet(path)), ["link_id", "period"]).select("link_id", "period", "t_min", "speed")


@query(f"""WITH {_L}, t AS (SELECT CAST(CAST(link_type AS VARCHAR) AS VARCHAR) AS c, round(avg(free_speed), 6) AS a, round(max(lanes), 6)::DOUBLE AS b FROM lk WHERE link_type IS NOT NULL AND free_speed IS NOT NULL AND lanes IS NOT NULL GROUP BY link_type UNION ALL SELECT 'all', 0.15, 4.0)
SELECT link_id, coalesce(t.c, 'all') AS used, coalesce(t.a, 0.15) AS alpha, coalesce(t.b, 4.0) AS beta FROM lk LEFT JOIN t ON t.c = lk.link_type""")
def vdf_table(spark, d):
    """Volume-delay parameters by code from a table that must have a default row, applied to links."""
    l, path = links(spark, d), scratch(spark, "vdf")
    own = l.where("link_type is not null and free_speed is not null and lanes is not null").groupBy(F.col("link_type").alias("vdf_code")).agg(F.round(F.avg("free_speed"), 6).alias("alpha"), F.max("lanes").cast("double").alias("beta"))
    writers.write_csv(own.unionByName(spark.createDataFrame([("all", 0.15, 4.0)], own.schema)), path, "run-1")
    t = readers.read_vdf_table(spark, path)
    rest = t.where("vdf_code = 'all'").select(F.col("alpha").alias("a0"), F.col("beta").alias("b0"))
    j = l.join(t, l["link_type"] == t["vdf_code"], "left").join(F.broadcast(rest))  # one row
    return j.select("link_id", F.coalesce("vdf_code", F.lit("all")).alias("used"), F.coalesce("alpha", "a0").alias("alpha"), F.coalesce("beta", "b0").alias("beta"))


@query(f"""WITH {_W}, {_M}, q AS (SELECT tmc_code, quantile_cont(speed, 0.95) AS p95 FROM p GROUP BY tmc_code) SELECT p.tmc_code, t_min, corridor, round(speed / p95, 8) AS ratio FROM p JOIN q USING (tmc_code) JOIN mem USING (tmc_code)""")
def profile_snapshot(spark, d):
    """Snapshot of normalised weekday profiles: written once, read with its sensors' corridors."""
    path = scratch(spark, "snapshot")
    writers.write_series(profiles.normalised_profile(profiles.weekday_profile(slots(spark, d))), path)
    snap = spark.read.parquet(path)
    return snap.join(members(spark, d).select("tmc_code", "corridor"), "tmc_code").select("tmc_code", "t_min", "corridor", "ratio")


@query(f"""WITH {_REP}, {_L}, e AS (SELECT link_id, period, t2_hour, p_hr, min_speed_mph FROM rep WHERE place = 1 AND t2_hour IS NOT NULL) SELECT e.link_id, period, round(t2_hour, 8) AS t2, round(p_hr, 8) AS p_hr, round(min_speed_mph, 8) AS slowest, round(free_speed, 8) AS free_speed, round(capacity, 8) AS capacity, lanes FROM e JOIN lk USING (link_id)""")
def learning_table(spark, d):
    """Accepted products of earlier steps joined for learning: episodes with the context of their link."""
    e = ranking.representative(table(spark, d, "link_t2").where("link_id is not null"), ["link_id", "period"]).where("t2_hour is not null")
    root = scratch(spark, "products")
    a = writers.write_step(e.select("link_id", "period", F.col("t2_hour").alias("t2"), "p_hr", F.col("min_speed_mph").alias("slowest")), root, "episodes", "accepted")
    b = writers.write_step(links(spark, d).select("link_id", "free_speed", "capacity", "lanes"), root, "fundamental-diagram", "context")
    return spark.read.parquet(a).join(spark.read.parquet(b), "link_id")


@query("SELECT DISTINCT link_id FROM link_t2 WHERE link_id IS NOT NULL")
def staged_keys(spark, d):
    """Distinct keys staged in a bucket-like layout (hash-partitioned, sorted), in place of a staging database."""
    path = scratch(spark, "staged")
    writers.write_series(table(spark, d, "link_t2").where("link_id is not null").select("link_id").distinct(), path, "link_id")
    return spark.read.parquet(path)


@query(f"""WITH {_M} SELECT tmc, road, round(start_longitude, 8) AS x0, round(start_latitude, 8) AS y0, round(end_longitude, 8) AS x1, round(end_latitude, 8) AS y1 FROM meta WHERE place = 1 AND start_longitude IS NOT NULL AND start_latitude IS NOT NULL AND end_longitude IS NOT NULL AND end_latitude IS NOT NULL""")
def geojson_sensors(spark, d):
    """Sensors as lines in GeoJSON, one feature a line, read back."""
    m = profiles.latest_metadata(table(spark, d, "tmc_metadata")).where("start_longitude is not null and start_latitude is not null and end_longitude is not null and end_latitude is not null")
    path = scratch(spark, "geojson")
    writers.write_geojson(m, path, [("start_longitude", "start_latitude"), ("end_longitude", "end_latitude")], ["tmc", "road"])
    return readers.read_geojson_lines(spark, path, "tmc string, road string")


@query("""WITH t AS (SELECT row_number() OVER (ORDER BY source) - 1 AS place, '| ' || source || ' | ' || max_repeats || ' |' AS line FROM mix_targets) SELECT CAST(-2 AS BIGINT) AS place, '| source | max_repeats |' AS line UNION ALL SELECT -1, '|---|---|' UNION ALL SELECT * FROM t""")
def markdown_table(spark, d):
    return writers.markdown_rows(table(spark, d, "mix_targets").select("source", "max_repeats"), ["source"])


_FEEDS = "f AS (SELECT feed_id, coalesce(feed_name, '') AS line FROM feeds)"


def feed_files(spark, rows: DataFrame, label: str) -> str:
    path = scratch(spark, label)
    rows.repartition("feed_id").write.partitionBy("feed_id").text(path)
    return path


@query(f"WITH {_FEEDS} SELECT feed_id, CAST(octet_length(encode(line)) + 1 AS BIGINT) AS bytes, sha256(line || chr(10)) AS sha256 FROM f")
def file_hashes(spark, d):
    """Hashes of the files of a bundle, computed where they are read."""
    path = feed_files(spark, table(spark, d, "feeds").select("feed_id", F.coalesce("feed_name", F.lit("")).alias("line")), "bundle")
    return writers.hash_files(spark, path).select(F.regexp_extract("path", "feed_id=([^/]+)/", 1).alias("feed_id"), "bytes", "sha256").where("feed_id != ''")


@query(f"WITH {_FEEDS}, k AS (SELECT feed_id, row_number() OVER (ORDER BY feed_id) AS i FROM f) SELECT feed_id, CASE WHEN i % 3 = 0 THEN 'missing' WHEN i % 3 = 1 THEN 'changed' END AS change FROM k WHERE i % 3 < 2")
def changed_bundle(spark, d):
    """Files of a run that are missing or changed against the hashes taken before: the lineage check."""
    f = ranking.dense_ids(table(spark, d, "feeds").select("feed_id", F.coalesce("feed_name", F.lit("")).alias("line")), "feed_id", "i").withColumn("i", F.col("i") + 1)
    before = writers.hash_files(spark, feed_files(spark, f.select("feed_id", "line"), "before"))
    now = writers.hash_files(spark, feed_files(spark, f.where("i % 3 != 0").select("feed_id", F.when(F.col("i") % 3 == 1, F.concat("line", F.lit("!"))).otherwise(F.col("line")).alias("line")), "now"))
    by = lambda x: x.where("path like 'feed_id=%'").withColumn("path", F.regexp_extract("path", "feed_id=([^/]+)/", 1))
    return writers.changed_files(by(before), by(now)).select(F.col("path").alias("feed_id"), "change")


@query("""SELECT t, n > 0 AS filled, CAST(c AS BIGINT) AS n_columns FROM (SELECT 'feeds' AS t, count(*) AS n, 4 AS c FROM feeds UNION ALL SELECT 'mix_targets', count(*), 3 FROM mix_targets UNION ALL SELECT 'readings', count(*), 7 FROM readings)""")
def input_checks(spark, d):
    """Inputs of a run: their columns are there and they have rows, else the run is refused."""
    from flowmark.operators.resources import require

    need = {"feeds": ["feed_id", "tz_name"], "mix_targets": ["source", "target_share"], "readings": ["tmc_code", "measurement_tstamp", "speed"]}
    rows = [(t, True, len(require(table(spark, d, t), c, t).columns)) for t, c in need.items()]
    return spark.createDataFrame(rows, "t string, filled boolean, n_columns bigint")
