"""Scans: CSV with explicit schemas and column maps, node-pair tables, period files, and binary demand tables."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from flowmark import schema


def read_csv(spark: SparkSession, path: str | list[str], ddl: str, columns: dict[str, str] | None = None, required: list[str] | None = None) -> DataFrame:
    """CSV by header names. columns maps canonical to source names; missing optional columns come as null, missing required ones are an error.

    Texts that aren't of a column's type become null.
    """
    raw = spark.read.option("header", True).csv(path)
    names = columns or {}
    want = [p.strip().split(None, 1) for p in ddl.split(",")]
    have = {c.strip(): c for c in raw.columns}
    missing = [c for c in (required or []) if names.get(c, c) not in have]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    cols = []
    for c, kind in want:
        source = have.get(names.get(c, c))
        text = F.trim(F.col(f"`{source}`")) if source else F.lit(None)
        cols.append((text.try_cast(kind) if source else text.cast(kind)).alias(c))
    return raw.select(*cols)


def read_readings(spark: SparkSession, path: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    return read_csv(spark, path, schema.READINGS, columns, ["tmc_code", "measurement_tstamp", "speed"])


def read_metadata(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    return read_csv(spark, path, schema.METADATA, columns, ["tmc"])


def read_mapping(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    return read_csv(spark, path, schema.MAPPING, columns, ["tmc", "link_id"])


def read_periods(spark: SparkSession, paths: dict[str, str], ddl: str) -> DataFrame:
    """One file per period as one table with a period column; a column that a file lacks is null."""
    out = None
    for period, path in paths.items():
        part = read_csv(spark, path, ddl).withColumn("period", F.lit(period))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_network_union(spark: SparkSession, paths: dict[str, str], ddl: str = schema.LINK, order: tuple[str, ...] = ("MD", "AM", "PM", "NT")) -> DataFrame:
    """Links of all periods, one row each, from the first period in `order` that has it, with the list of periods it is in."""
    from pyspark.sql import Window

    rank = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("period")), F.lit(99))
    rows = read_periods(spark, paths, ddl).where("link_id is not null").withColumn("_rank", rank)
    rows = rows.withColumn("periods", F.array_join(F.array_sort(F.collect_set("period").over(Window.partitionBy("link_id"))), ";"))
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy("link_id").orderBy("_rank"))).where("_place = 1").drop("_rank", "_place", "period")


def read_weekday(spark: SparkSession, path: str, columns: dict[str, str] | None = None, measured: bool = False) -> DataFrame:
    """(tmc_code, t_min, speed, flow) of an average weekday; the flow that is supplied counts only if it was `measured`."""
    rows = read_csv(spark, path, "tmc_code string, t_min int, speed double, flow double", columns, ["tmc_code", "t_min", "speed"])
    return rows if measured else rows.withColumn("flow", F.lit(None).cast("double"))


def load_source(spark: SparkSession, spec: dict) -> DataFrame:
    """(tmc_code, t_min, speed, flow): the average weekday of a source. spec: source ("readings", "average_weekday" or "measured"), path and optionally columns.

    Readings are averaged from quarter-hour medians of working days; unknown sources are an error.
    """
    from flowmark.operators import profiles

    kind, path, columns = spec.get("source"), spec["path"], spec.get("columns")
    if kind == "readings":
        slots = profiles.resample_median(profiles.clean_readings(read_readings(spark, path, columns)))
        return profiles.weekday_profile(slots).select("tmc_code", "t_min", "speed", F.lit(None).cast("double").alias("flow"))
    if kind in ("average_weekday", "measured"):
        return read_weekday(spark, path, columns, kind == "measured")
    raise ValueError(f"unknown source {kind!r}")


def read_nodes_union(spark: SparkSession, paths: dict[str, str], order: tuple[str, ...] = ("MD", "AM", "PM", "NT"), origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """(node_id, x_ft, y_ft): nodes of all periods, each from the first period in `order` that has it, on a plane in feet about an origin (longitude, latitude)."""
    from flowmark.operators.ranking import pick_first
    from flowmark.operators.spatial import plane_feet

    rank = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("period")), F.lit(99))
    rows = read_periods(spark, paths, "node_id bigint, longitude double, latitude double").where("node_id is not null")
    rows = pick_first(rows, ["node_id"], [rank, F.col("longitude").asc_nulls_last(), F.col("latitude").asc_nulls_last()])
    return rows.select("node_id", *plane_feet(F.col("longitude"), F.col("latitude"), origin))


def read_episode_files(spark: SparkSession, root: str, folders: tuple[str, ...], ddl: str, accepted: str = "accepted") -> DataFrame:
    """Episodes of a run: from the first of `folders` (the numbered one, then older names) that exists under root. Rows that aren't accepted are an error."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        p = jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        if p.getFileSystem(conf).exists(p):
            rows = spark.read.schema(f"{ddl}, {accepted} boolean").parquet(f"{root}/{folder}")
            if rows.where(~F.coalesce(F.col(accepted), F.lit(False))).limit(1).count():
                raise ValueError(f"{folder}: rows that aren't accepted")
            return rows.drop(accepted)
    raise ValueError(f"none of {folders} exists under {root}")


def read_vdf_table(spark: SparkSession, path: str, key: str = "vdf_code", default: str = "all") -> DataFrame:
    """(key, alpha, beta): volume-delay parameters by code; an error without a row for the default code or with a code twice."""
    from flowmark.operators.ranking import assert_unique
    from flowmark.operators.resources import with_default

    rows = read_csv(spark, path, f"{key} string, alpha double, beta double", required=[key, "alpha", "beta"]).where(F.col(key).isNotNull())
    return with_default(assert_unique(rows, [key]), key, default)


def with_corridor(df: DataFrame, pattern: str = r"/([^/]+)/[^/]+$") -> DataFrame:
    """df with the folder that a row's file lies in, as corridor."""
    return df.withColumn("corridor", F.regexp_extract(F.input_file_name(), pattern, 1))


def with_occurrence(df: DataFrame, part: str, parts: list[str], order: str, width: int = 10_000_000) -> DataFrame:
    """df with occurrence: the number of the row's part times `width` plus its place in the part by `order`."""
    from pyspark.sql import Window

    number = F.array_position(F.array(*map(F.lit, parts)), F.col(part)) - 1
    return df.withColumn("occurrence", (number * width + F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1).cast("bigint"))


def with_time_columns(df: DataFrame, prefix: str = "spd_mph_") -> DataFrame:
    """df, or an error if it has no column of a time of day (prefix and HH:MM) or one that names no time."""
    times = [c[len(prefix) :] for c in df.columns if c.startswith(prefix)]
    bad = [t for t in times if not (len(t) == 5 and t[2] == ":" and t[:2].isdigit() and t[3:].isdigit() and int(t[:2]) < 24 and int(t[3:]) < 60)]
    if bad or not times:
        raise ValueError(f"no times of day: {bad}" if bad else f"no column {prefix}HH:MM")
    return df


def read_geojson_lines(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Properties and ends (x0, y0, x1, y1) of the LineStrings in newline-delimited GeoJSON."""
    fields = ", ".join(p.strip().replace(" ", ": ", 1) for p in properties.split(","))
    f = spark.read.text(path).select(F.from_json("value", f"type string, geometry struct<type: string, coordinates: array<array<double>>>, properties struct<{fields}>").alias("f"))
    c = F.col("f.geometry.coordinates")
    return f.where("f.geometry.type = 'LineString'").select("f.properties.*", c[0][0].alias("x0"), c[0][1].alias("y0"), F.element_at(F.element_at(c, -1), 1).alias("x1"), F.element_at(F.element_at(c, -1), 2).alias("y1"))


# Layout of the binary demand table: magic, version and count, then records of origin, destination and volume.
DTAB_MAGIC, DTAB_VERSION, DTAB_HEADER = b"DTAB", 1, struct.Struct("<4siq")
DTAB_RECORD = np.dtype([("o_zone_id", "<i4"), ("d_zone_id", "<i4"), ("volume", "<f8")])
DTAB_CHUNK = 1 << 20


def local_path(path: str) -> str:
    """The path of a file that all machines have mounted."""
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def dtab_records(path: str) -> int:
    """Records of a binary demand table; an error if header or size don't fit."""
    with open(path, "rb") as f:
        head = f.read(DTAB_HEADER.size)
        size = f.seek(0, 2)
    if len(head) < DTAB_HEADER.size:
        raise ValueError(f"{path}: header is cut short")
    magic, version, n = DTAB_HEADER.unpack(head)
    if magic != DTAB_MAGIC or version != DTAB_VERSION or n < 0:
        raise ValueError(f"{path}: no demand table of version {DTAB_VERSION}")
    if size != DTAB_HEADER.size + n * DTAB_RECORD.itemsize:
        raise ValueError(f"{path}: {n} records announced, but {size} bytes found")
    return n


class _Chunk(InputPartition):
    def __init__(self, path: str, start: int, count: int):
        self.path, self.start, self.count = path, start, count


class _DtabReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_Chunk(p, a, min(DTAB_CHUNK, n - a)) for p in self.paths for n in [dtab_records(p)] for a in range(0, n, DTAB_CHUNK)] or [_Chunk("", 0, 0)]

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        if part.count:
            r = np.fromfile(part.path, DTAB_RECORD, part.count, offset=DTAB_HEADER.size + part.start * DTAB_RECORD.itemsize)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(r[c])) for c in DTAB_RECORD.names], names=list(DTAB_RECORD.names))


class DtabSource(DataSource):
    """spark.read.format("dtab").load(path): a partition per million records, read by offset."""

    @classmethod
    def name(cls) -> str:
        return "dtab"

    def schema(self) -> str:
        return "o_zone_id int, d_zone_id int, volume double"

    def reader(self, schema) -> DataSourceReader:
        return _DtabReader([local_path(p) for p in self.options["path"].split(",")])


def read_dtab(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(DtabSource)
    return spark.read.format("dtab").load(path)


def matrix_triples(df: DataFrame, origin: str, volumes: list[str]) -> DataFrame:
    """(o_zone_id, d_zone_id, volume) of a wide matrix (one row per origin, one column per destination named by its id), above 0 only."""
    long = df.unpivot([origin], [F.col(f"`{v}`") for v in volumes], "d", "volume")
    return long.where("volume > 0").select(F.col(origin).cast("int").alias("o_zone_id"), F.col("d").cast("int").alias("d_zone_id"), "volume")


def remap_zones(triples: DataFrame, zones: DataFrame) -> DataFrame:
    """Triples with compact zone ids; zones: zone_id, new_id. Trips of unknown zones are left out."""
    o, t = zones.select(F.col("zone_id").alias("o_zone_id"), F.col("new_id").alias("o")), zones.select(F.col("zone_id").alias("d_zone_id"), F.col("new_id").alias("d"))
    return triples.join(o, "o_zone_id").join(t, "d_zone_id").select(F.col("o").alias("o_zone_id"), F.col("d").alias("d_zone_id"), "volume")
