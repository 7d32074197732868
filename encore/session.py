"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app_name: str = "encore", **conf: str) -> SparkSession:
    """A session with the settings every job here assumes; cluster values win where given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. A local session without that setting gets a
    folder of its own; on a cluster the setting is needed."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    named = tempfile.mkdtemp(prefix="encore-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Folders of staged tables, by application and shared folder.
_FOLDERS: dict[tuple[str, str], str] = {}


def staging_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one; it goes when the application ends."""
    top = shared_dir(spark).rstrip("/")
    at = (spark.sparkContext.applicationId, top)
    if at not in _FOLDERS:
        folder = f"{top}/encore-{at[0]}-{uuid.uuid4().hex[:8]}"
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[at] = folder
    return _FOLDERS[at]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's staging folder."""
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark, top = df.sparkSession, urlsplit(staging_dir(df.sparkSession)).path
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {unquote(url).rpartition("/")[0] for url in df.inputFiles()}:
        if urlsplit(folder).path.startswith(f"{top}/"):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Shuffled bytes of a task and input bytes of a partition where tasks hold many times what they read.
SMALL_TASK, SMALL_PART = 8 << 20, 4 << 20


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads; 0 where it reads none. Lists their folders once."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files, folders = set(), set()
    for url in df.inputFiles():
        files.add(unquote(urlsplit(url).path))
        folders.add(unquote(url).rpartition("/")[0])
    found = 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        for f in path.getFileSystem(conf).listStatus(path):
            if f.getPath().toUri().getPath() in files:
                found += f.getLen()
    return found


def small_parts(spark: SparkSession, size: int) -> int:
    """Shuffle partitions for ``size`` bytes of files: the session's, and more where the input asks for them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SMALL_PART)


@contextmanager
def small_tasks(spark: SparkSession, size: int) -> Iterator[None]:
    """Within, shuffles of a job over ``size`` bytes of files are cut finer than by default, so that
    a task's joins and hash tables stay small and their number follows the input."""
    most = small_parts(spark, size)
    finer = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SMALL_TASK),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(most),
    }
    before = {k: spark.conf.get(k, None) for k in finer}
    for k, v in finer.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
