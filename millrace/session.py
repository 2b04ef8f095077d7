"""Session helpers shared by every operator."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, as tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
        # on one machine small stages keep all cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. The cluster names it in
    spark.checkpoint.dir; only where that is unset and the master is this machine (tests)
    a folder of our own is taken and set. On a cluster a missing setting is an error, as a
    folder of one machine would lose what other executors write."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        current = sc._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _file(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_bytes(spark: SparkSession, name: str, content: bytes) -> None:
    """A small file in the shared folder, whole or not at all: written beside and renamed. Of
    several writers of one name the first wins."""
    path, fs = _file(spark, name)
    beside, _ = _file(spark, f"{name}.{uuid.uuid4().hex[:8]}")
    out = fs.create(beside, True)
    out.write(bytearray(content))
    out.close()
    if not fs.rename(beside, path):
        fs.delete(beside, False)


def read_bytes(spark: SparkSession, name: str) -> bytes | None:
    """The content of a small file, None where there is none."""
    path, fs = _file(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream))
    finally:
        stream.close()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once per application, through the
    shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_millrace_shipped", False):
        return
    root, buffer = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.writestr(str(Path(root.name) / f.relative_to(root)), f.read_text())
    target = f"{shared_dir(spark).rstrip('/')}/code/{sc.applicationId}/{root.name}.zip"
    write_bytes(spark, target, buffer.getvalue())
    sc.addPyFile(target)
    sc._millrace_shipped = True


def parts(spark: SparkSession) -> int:
    """Partitions for work that costs more than its bytes tell: those of a shuffle, and at
    least one per core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, split: int = 1 << 20) -> DataFrame:
    """Input smaller than ``split`` bytes per core, by the optimizer's estimate, dealt out anew:
    for row-wise Python over a small table, which may be a single split. Larger tables come
    with splits enough and are left alone. Nothing is run to find out."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if int(str(size)) < cores * split else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
