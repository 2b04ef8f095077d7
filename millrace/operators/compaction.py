"""Consolidation of very many small files (problem 6).

``compact`` packs small files into few large ones by the engine's own split packing,
without a shuffle, writes to a staging folder and publishes it only after counts and
checksums agree. ``consolidate`` does the same for saves of records and keeps each
record once: ``record_owners`` finds the first file that holds it.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPACE = re.compile(r"\s+")
_HALF = re.compile(r"[\ud800-\udfff]")
_RESUME = re.compile(r"\n(?=\{)")
_DECODER = json.JSONDecoder()


def _plain(value):
    """Numbers that are equal as JSON values get one form."""
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return value


def listing_records(payload: str | None) -> list[str]:
    """The complete listing records of a json file as canonical texts.

    A file holds one object, an array of objects, or one object per line. A
    record that does not parse is not complete and is left out; reading goes on
    at the next line that opens a record. Null, empty and blank payloads hold none.
    """
    if not payload:
        return []
    text = payload.replace("\ufeff", "")
    out, at, end = [], 0, len(text)
    while at < end:
        if text[at] in " \t\r\n,[]":
            at += 1
            continue
        try:
            value, at = _DECODER.raw_decode(text, at)
        except (ValueError, RecursionError):
            following = _RESUME.search(text, at)
            if following is None:
                break
            at = following.end()
            continue
        if isinstance(value, dict):
            record = json.dumps(_plain(value), sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            # halves of surrogate pairs can't be written; they stay escapes
            out.append(record if record.isascii() or not _HALF.search(record) else json.dumps(_plain(value), sort_keys=True, separators=(",", ":")))
    return out


def page_text(payload: str | None) -> str | None:
    """A complete html page with each run of white space as one space, or None."""
    if not payload:
        return None
    text = _SPACE.sub(" ", payload.replace("\ufeff", "")).strip()
    return text if text.endswith("</html>") else None


RECORD = "file_id bigint, rec_no int, scope string, record string, key string"
_OUT = {"text": "row bigint, " + RECORD, "key": "row bigint, file_id bigint, key string"}


def _rows(kind: str):
    def run(batches):
        for pdf in batches:
            rows = []
            for row, fid, source, job, artifact, payload in zip(pdf.row, pdf.file_id, pdf.source, pdf.job_id, pdf.artifact, pdf.payload):
                if artifact is None or pd.isna(fid):
                    continue
                if str(artifact).endswith(".json"):
                    found, scope = listing_records(payload), f"j|{source}|"
                else:
                    page = page_text(payload)
                    found, scope = [] if page is None else [page], f"h|{job}|"
                seen = set()
                for no, record in enumerate(found):
                    key = hashlib.md5((scope + record).encode("utf-8", "surrogatepass")).hexdigest()
                    if key not in seen:
                        seen.add(key)
                        rows.append((row, int(fid), no, scope, record, key))
            out = pd.DataFrame(rows, columns=["row", "file_id", "rec_no", "scope", "record", "key"]).astype({"row": "int64", "file_id": "int64", "rec_no": "int32"})
            yield out if kind == "text" else out[["row", "file_id", "key"]]

    return run


_READ = ("file_id", "source", "job_id", "artifact", "payload")


def _records(files: DataFrame, kind: str) -> DataFrame:
    """The complete records of a table of saved files, once per row of it. ``row`` tells rows
    of the table apart, by where they are stored, so that a row that is there twice can be
    taken once without moving its text."""
    stored = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("row")
    return files.select(stored, *_READ).mapInPandas(_rows(kind), _OUT[kind])


def owned(files: DataFrame) -> DataFrame:
    """(row, file_id, key): each distinct record with the first file that holds it. The minimum
    per key is combined on the map side, so a job that has a third of the files costs no
    more than any other; only keys and numbers move."""
    first = _records(files, "key").groupBy("key").agg(F.min(F.struct("file_id", "row")).alias("o"))
    return first.select("o.row", "o.file_id", "key")


def redundant_files(files: DataFrame, kept: DataFrame) -> DataFrame:
    """(file_id): files none of whose records were kept from them: they have no complete one,
    or each also stands in a file with a smaller id. Null file ids are ignored; an empty
    table gives no rows."""
    ids = files.where("file_id is not null").select("file_id").distinct()
    return ids.join(kept.select("file_id").distinct(), "file_id", "left_anti")


def plan_packing(n_files: int, n_bytes: int, target_bytes: int, open_cost: int = 64 * 1024) -> dict[str, int]:
    """Split sizes such that the scan itself packs files to about target_bytes.

    The reader charges open_cost per file; a split is closed at maxPartitionBytes,
    so the charge of the files that fit into one target is added to it."""
    n_out = max(1, math.ceil(n_bytes / max(1, target_bytes)))
    per_split = math.ceil(n_files / n_out)
    return {"n_out": n_out, "max_partition_bytes": target_bytes + per_split * open_cost, "open_cost": open_cost}


def _summary(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def packing_session(spark: SparkSession, plan: dict[str, int]) -> SparkSession:
    """A session of its own whose scans pack files as planned; that of the caller, and other
    queries in it, keep their settings."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.enabled", "spark.sql.caseSensitive"):
        value = spark.conf.get(key, None)
        if value is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(plan["max_partition_bytes"]))
    own.conf.set("spark.sql.files.openCostInBytes", str(plan["open_cost"]))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def _hdfs(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, staging: str, target: str, wrote, read) -> None:
    """Renames a staged folder into place if it holds what was read, else deletes it."""
    path, fs = _hdfs(spark, staging)
    if wrote != read:
        fs.delete(path, True)
        raise RuntimeError(f"staged copy differs from its source: {wrote} and {read}")
    if not fs.rename(path, _hdfs(spark, target)[0]):
        raise RuntimeError(f"could not publish {target}")


def _packed(spark: SparkSession, source: str, target: str, target_bytes: int) -> tuple[dict[str, int], SparkSession, str]:
    path, fs = _hdfs(spark, source)
    if fs.exists(_hdfs(spark, target)[0]):
        raise FileExistsError(target)
    summary = fs.getContentSummary(path)
    plan = {"files_in": summary.getFileCount(), **plan_packing(summary.getFileCount(), summary.getLength(), target_bytes)}
    return plan, packing_session(spark, plan), f"{target.rstrip('/')}._staging_{uuid.uuid4().hex[:8]}"


def compact(spark: SparkSession, source: str, target: str, fmt: str = "parquet", target_bytes: int = 128 << 20, options: dict | None = None) -> dict[str, int]:
    """Rewrites the small files under source as few files of about target_bytes.

    No shuffle: combined splits are read and coalesced. The output is written to a
    staging folder beside target, compared with the source by row count and an
    order-free checksum, and only then renamed. On a mismatch the staging folder is
    deleted and an error raised; an existing target is never overwritten."""
    plan, own, staging = _packed(spark, source, target, target_bytes)
    load = lambda path: own.read.format(fmt).options(**(options or {})).load(path)
    load(source).coalesce(plan["n_out"]).write.format(fmt).options(**(options or {})).save(staging)
    read = _summary(load(source))
    _publish(spark, staging, target, _summary(load(staging)), read)
    return {"rows": read[0], **plan}


def consolidate(spark: SparkSession, source: str, target: str, target_bytes: int = 128 << 20) -> dict[str, int]:
    """Rewrites a table of saved files (parquet at ``source``) as few large files at ``target``
    that hold each complete record exactly once: (file_id, rec_no, scope, record, key), with
    the smallest file_id that holds it.

    The scan packs splits to about target_bytes. Which file keeps a record is found from keys
    alone; the texts then go from their packed splits into the output. They move only where
    the engine finds the list of kept records too large to send to every task, and then once.
    Output is staged and verified: as many records as there are distinct keys, the same
    order-free checksum over file and key, and every key equal to the hash of the text that
    was written. Only then is it published. Empty tables give an empty output."""
    plan, own, staging = _packed(spark, source, target, target_bytes)
    files = own.read.parquet(source)
    keys = f"{staging}_keys"
    owned(files).write.parquet(keys)
    keep = own.read.parquet(keys)
    rows = _records(files, "text").join(keep, ["row", "file_id", "key"], "left_semi")
    rows.select("file_id", "rec_no", "scope", "record", "key").coalesce(plan["n_out"]).write.parquet(staging)
    back = own.read.parquet(staging)
    spoilt = back.where(F.md5(F.concat("scope", "record")) != F.col("key")).count()
    if spoilt:
        _hdfs(spark, staging)[1].delete(_hdfs(spark, staging)[0], True)
        raise RuntimeError(f"{spoilt} records differ from their keys")
    read = _summary(keep.select("file_id", "key"))
    _publish(spark, staging, target, _summary(back.select("file_id", "key")), read)
    _hdfs(spark, keys)[1].delete(_hdfs(spark, keys)[0], True)
    return {"records": read[0], **plan}
