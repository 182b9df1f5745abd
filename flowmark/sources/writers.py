"""Sinks: tables with the run's id, partitioned Parquet, sorted lookups, and manifests."""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmark.session import cut
from flowmark.sources.readers import DTAB_HEADER, DTAB_MAGIC, DTAB_RECORD, DTAB_VERSION, local_path


def write_csv(df: DataFrame, path: str, run_id: str, gzip: bool = False) -> None:
    """CSV with a header and the run's id in every row; refuses an existing folder."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("errorifexists").option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def write_sorted_csv(df: DataFrame, path: str, keys: list[str], run_id: str) -> None:
    """CSV whose files, in order of their names, hold the rows in order of the keys: range-partitioned, no single task."""
    write_csv(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path, run_id)


def with_file_order(df: DataFrame, name: str) -> DataFrame:
    """df, read from files, with each row's place over all files in order of their names; places are made from counts per file."""
    rows = df.withColumn("_f", F.input_file_name()).withColumn("_i", F.monotonically_increasing_id())
    rows = cut(rows.withColumn("_k", F.row_number().over(Window.partitionBy("_f").orderBy("_i"))), "ordered")
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per file
    sizes = rows.groupBy("_f").agg(F.count("*").alias("_n")).select("_f", before.alias("_b"))
    return rows.join(sizes, "_f").withColumn(name, (F.col("_b") + F.col("_k") - 1).cast("bigint")).drop("_f", "_i", "_k", "_b")


def write_series(df: DataFrame, path: str, key: str = "tmc_code") -> None:
    """Parquet sorted by key inside files of a hash partitioning, so that a key is found by its row-group statistics.

    One folder per key would make a file for each of very many sensors.
    """
    df.repartition(key).sortWithinPartitions(key).write.mode("errorifexists").parquet(path)


def write_by_corridor(df: DataFrame, path: str, corridor: str = "corridor") -> None:
    df.repartition(corridor).write.mode("errorifexists").partitionBy(corridor).parquet(path)


def write_lookup(df: DataFrame, path: str, keys: list[str]) -> None:
    """Lookup with unique keys, range-partitioned and sorted by them."""
    from flowmark.operators.ranking import assert_unique

    assert_unique(df, keys).repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("errorifexists").parquet(path)


def write_dtab(df: DataFrame, path: str) -> int:
    """A binary demand table, written by the executors: each origin's records in order of destination, at the place its rank gives; returns their number.

    Sizes per origin come first, positions are their running sum, so tasks write without waiting for each other and a task
    that runs twice writes the same bytes. The path must be mounted on all machines. Records without zones or volume above 0
    are left out; the header goes in last.
    """
    rows = df.select("o_zone_id", "d_zone_id", F.col("volume").cast("double").alias("volume")).where("o_zone_id is not null and d_zone_id is not null and volume > 0")
    sizes = cut(rows.groupBy("o_zone_id").agg(F.count("*").alias("_n")), "origins")  # one row per zone
    before = F.coalesce(F.sum("_n").over(Window.orderBy("o_zone_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = sizes.agg(F.sum("_n")).first()[0] or 0
    target, head, kind, width = local_path(path), DTAB_HEADER.size, DTAB_RECORD, DTAB_RECORD.itemsize
    with open(target + ".part", "wb") as f:
        f.truncate(head + n * width)

    def run(batches):
        with open(target + ".part", "r+b") as f:
            key, at = None, 0
            for b in batches:
                o, d, v, p = (b[c].to_numpy() for c in ("o_zone_id", "d_zone_id", "volume", "_at"))
                for i, j in zip(starts := np.flatnonzero(np.r_[True, o[1:] != o[:-1]]), [*starts[1:], len(o)]):
                    key, at = (o[i], int(p[i])) if o[i] != key else (key, at)
                    block = np.empty(j - i, kind)
                    block["o_zone_id"], block["d_zone_id"], block["volume"] = o[i:j], d[i:j], v[i:j]
                    f.seek(head + at * width)
                    f.write(block.tobytes())
                    at += j - i
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    placed = rows.join(sizes.select("o_zone_id", before.alias("_at")), "o_zone_id")
    placed = placed.repartition("o_zone_id").sortWithinPartitions("o_zone_id", "d_zone_id", "volume").select(F.col("o_zone_id").cast("int"), F.col("d_zone_id").cast("int"), "volume", "_at")
    placed.mapInArrow(run, "n bigint").write.format("noop").mode("overwrite").save()
    with open(target + ".part", "r+b") as f:
        f.write(DTAB_HEADER.pack(DTAB_MAGIC, DTAB_VERSION, n))
    os.replace(target + ".part", target)
    return n


def hash_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of the files under a folder, hashed where they are read; hidden ones are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.regexp_replace(F.col("path"), F.lit("^.*?" + re.escape(folder.rstrip("/").split("://")[-1].split(":", 1)[-1].rstrip("/")) + "/"), F.lit(""))
    return files.select(name.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def changed_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """(path, change): files that are new, missing or of other content against an earlier hash_files."""
    a, b = before.select("path", F.col("sha256").alias("a")), now.select("path", F.col("sha256").alias("b"))
    change = F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, "path", "full_outer").select("path", change.alias("change")).where("change is not null")


def write_geojson(df: DataFrame, path: str, lines: list[tuple[str, str]], properties: list[str]) -> None:
    """Newline-delimited GeoJSON: a LineString through the (longitude, latitude) columns of each row, with properties."""
    place = F.struct(F.lit("LineString").alias("type"), F.array(*(F.array(F.col(x), F.col(y)) for x, y in lines)).alias("coordinates"))
    df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), place.alias("geometry"), F.struct(*properties).alias("properties"))).alias("value")).write.mode("errorifexists").text(path)


def markdown_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """(place, line): a table in Markdown, header first; for reports of a few rows, as the order is global."""
    names = df.columns
    head = df.sparkSession.createDataFrame([(-2, "| " + " | ".join(names) + " |"), (-1, "|" + "---|" * len(names))], "place bigint, line string")
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names)), F.lit(" |"))
    return head.unionByName(df.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("place"), cells.alias("line")))


def manifest(folder: str, **facts) -> dict:
    """Hashes of a folder's files beside facts of the run, written as manifest.json; unchanged inputs give the same bytes."""
    files = {}
    for root, _, names in sorted(os.walk(folder)):
        for n in sorted(names):
            if n != "manifest.json" and not n.startswith((".", "_")):
                h = hashlib.sha256()
                with open(os.path.join(root, n), "rb") as f:
                    for block in iter(lambda: f.read(1 << 20), b""):
                        h.update(block)
                files[os.path.relpath(os.path.join(root, n), folder)] = h.hexdigest()
    out = {"files": files} | facts
    with open(os.path.join(folder, "manifest.json"), "w") as f:
        json.dump(out, f, indent=1, sort_keys=True)
    return out


def changed(folder: str) -> list[str]:
    """Files whose content doesn't fit the manifest, or that are missing or new."""
    with open(os.path.join(folder, "manifest.json")) as f:
        before = json.load(f)["files"]
    text = open(os.path.join(folder, "manifest.json")).read()
    now = manifest(folder)["files"]
    with open(os.path.join(folder, "manifest.json"), "w") as f:
        f.write(text)
    return sorted(k for k in before.keys() | now.keys() if before.get(k) != now.get(k))


#: Numbered folders of a run's results, in order of the steps.
STEPS = ["01-input-and-qc", "02-fundamental-diagram", "03-episodes", "04-screening", "05-calibration", "06-reconstruction", "07-tables"]


def write_step(df: DataFrame, root: str, step: str, name: str) -> str:
    """One result of a step under its numbered folder; refuses an existing one. Returns the path."""
    folder = next((s for s in STEPS if s.split("-", 1)[1] == step), None)
    if folder is None:
        raise ValueError(f"unknown step {step!r}")
    path = f"{root}/{folder}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return path


def install(df: DataFrame, path: str) -> None:
    """Replace a table: written beside, the old one kept as <path>.before, then renamed into place."""
    spark = df.sparkSession
    P = spark._jvm.org.apache.hadoop.fs.Path
    new, old, now = P(path + ".new"), P(path + ".before"), P(path)
    fs = now.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(path + ".new")
    if fs.exists(now):
        fs.delete(old, True)
        fs.rename(now, old)
    fs.rename(new, now)
