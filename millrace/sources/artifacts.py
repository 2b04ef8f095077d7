"""Artifacts of an offer: names, long table, wide table and index of times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: artifact file names
FILENAMES = ("raw.meta.json", "raw.job.json", "raw.job.html", "raw.html-json.json", "clean.job.json", "clean.job.html", "clean.html-json.json", "clean.meta.json", "clean.md", "clean.combined.json", "enrich.llm.json", "errors.json")


def known(name: Column) -> Column:
    return name.isin(*FILENAMES)


def scan(spark, path: str) -> DataFrame:
    """(job_id, artifact, mtime, payload) of a folder tree <job_id>/<artifact>; unknown
    files are left out. A missing folder is an error of Spark's reader."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    name = F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1)
    return files.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("job_id"), name.alias("artifact"), F.col("_metadata.file_modification_time").alias("mtime"), F.col("value").alias("payload")).where(known(F.col("artifact")))


def latest(files: DataFrame, usable: Column) -> DataFrame:
    """(job_id, artifact, source, payload, mtime): of each job and artifact the usable payload
    with the largest file_id; times are the latest of all."""
    own = files.where(F.col("job_id").isNotNull())
    return own.groupBy("job_id", "artifact").agg(F.max("source").alias("source"), F.max_by("payload", F.when(usable, F.col("file_id"))).alias("payload"), F.max("mtime").alias("mtime"))


def wide(long: DataFrame) -> DataFrame:
    """One row per job with its json, html and their times. One aggregation, no pivot scan."""
    pick = lambda a, c: F.max(F.when(F.col("artifact") == a, F.col(c)))
    return long.groupBy("job_id").agg(
        F.max("source").alias("source"), pick("raw.job.json", "payload").alias("json"), pick("raw.job.html", "payload").alias("html"),
        pick("raw.job.json", "mtime").alias("json_mtime"), pick("raw.job.html", "mtime").alias("html_mtime"),
    )
