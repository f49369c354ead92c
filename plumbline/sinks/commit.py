"""Staged commits: a run is written beside its place, verified, then renamed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.contracts import compare_hashes


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path (below the folder), size and sha256 of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    base = path.split("://")[-1].rstrip("/")
    return files.select(F.regexp_extract("path", rf"{base}/+(.*)$", 1).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def commit(tables: dict[str, DataFrame], folder: str, run_id: str) -> str:
    """Writes the tables as folder/run_id/<name>, all or none.  Fails if the run is
    there already; what was staged is removed if anything goes wrong."""
    spark = next(iter(tables.values())).sparkSession
    staged, final = f"{folder}/.staging/{run_id}", f"{folder}/{run_id}"
    fs, target, Path = _fs(spark, final)
    if fs.exists(target):
        raise FileExistsError(final)
    try:
        for name, df in tables.items():
            df.write.mode("errorifexists").parquet(f"{staged}/{name}")
        written = {(r.path, r.sha256) for r in file_hashes(spark, staged).select("path", "sha256").collect()}
        if not fs.rename(Path(staged), target):
            raise OSError(f"could not move {staged}")
        try:
            # A row a file: what arrived must be what was written.
            if {(r.path, r.sha256) for r in file_hashes(spark, final).select("path", "sha256").collect()} != written:
                raise OSError(f"{final} differs from what was staged")
        except Exception:
            fs.delete(target, True)
            raise
    finally:
        fs.delete(Path(staged), True)
    return final


def verify(spark: SparkSession, folder: str, declared: DataFrame) -> DataFrame:
    """Files that differ from the declared (path, sha256)."""
    return compare_hashes(declared, file_hashes(spark, folder), "path")


def write_texts(rows: DataFrame, folder: str, name: str, suffix: str) -> None:
    """One text file for each row, in a folder of its own: name=<key>/part.<suffix>."""
    rows.write.mode("errorifexists").partitionBy(name).format("text").option("lineSep", "\n").save(f"{folder}/{suffix}")
