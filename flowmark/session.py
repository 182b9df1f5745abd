"""Session helpers: reading tables, cutting lineage, finding hot keys, normal forms of keys."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CUTS: list[str] = []  # folders written by cut() and the like in this process
_TABLES: list[str] = []  # tables of bucketed()

#: Characters counted as blanks around a code.
BLANKS = " \t\r\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder. Timestamps carry no zone and mean UTC, so the session is set to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a local folder only where that is unset on a local master (tests)."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share; master is {master}")
    own = os.path.join(tempfile.gettempdir(), f"flowmark-{os.getpid()}")
    os.makedirs(own, exist_ok=True)
    return f"file://{own}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, which release() deletes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _CUTS.append(path)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: a durable cut of the lineage that survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, keys: list[str], buckets: int) -> DataFrame:
    """df, already repartitioned by keys into `buckets`, as a table of so many buckets in the shared folder, so that joins on the keys move only their other side. release() drops it."""
    path, spark = scratch(df.sparkSession, label), df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    _TABLES.append(name)
    return spark.table(name)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table that cut() returned, once nothing reads it any more."""
    spark, paths = df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for known in [c for c in _CUTS if any(p.split(":", 1)[-1].lstrip("/") == c.split(":", 1)[-1].lstrip("/") for p in paths)]:
        _CUTS.remove(known)
        p = spark._jvm.org.apache.hadoop.fs.Path(known)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> int:
    """Delete the tables behind all cuts of this process, once no result that reads them is needed any more; returns their number."""
    jvm, n = spark._jvm, len(_CUTS)
    while _TABLES:
        spark.sql(f"drop table if exists {_TABLES.pop()}")
    while _CUTS:
        p = jvm.org.apache.hadoop.fs.Path(_CUTS.pop())
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return n


def code(c: Column | str) -> Column:
    """Sensor code in normal form: upper case, no outer blanks; empty counts as null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.upper(F.btrim(c, F.lit(BLANKS))), F.lit(""))


def number(c: Column | str) -> Column:
    """A double with NaN as null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def spelled_id(c: Column | str) -> Column:
    """The whole number that a text spells ('001007', ' 1007', '1007.0' are all 1007), else null."""
    c = F.col(c) if isinstance(c, str) else c
    c = F.btrim(c.cast("string"), F.lit(BLANKS))
    d = F.when(F.length(c) <= 38, c.try_cast("decimal(38,9)"))
    whole = d.try_cast("decimal(19,0)")
    return F.when(d == whole, whole).try_cast("bigint")


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a UTC timestamp."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def hot_keys(df: DataFrame, key: str, least: int) -> DataFrame:
    """Keys with more than `least` rows: (key, n). At most rows/least keys, so the result has a proven bound."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > least)
