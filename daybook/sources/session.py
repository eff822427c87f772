"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

OBJECT_STORE_SETTINGS = {
    "spark.hadoop.fs.s3a.path.style.access": "true",
    "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
}


def create_session(app_name: str, object_store: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings.

    ``object_store`` adds ``fs.s3a`` options (endpoint, region, keys) for
    ``s3a://`` paths; every reader and writer takes any Hadoop path.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if object_store is not None:
        for key, value in OBJECT_STORE_SETTINGS.items():
            builder = builder.config(key, value)
        for key, value in object_store.items():
            builder = builder.config(f"spark.hadoop.fs.s3a.{key}", value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, on storage all executors share.

    It lies under ``spark.checkpoint.dir``. Only a local session may go
    without that setting; its folders then lie beside its tables.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: How large tables are written: some half of the default codec's size.
COMPACT = {"compression": "zstd"}

#: Up to so many folders a task writes side by side; only for more are its rows sorted by folder first.
FOLDERS_AT_ONCE = 4

#: What a task reads of compressed files, which unfold to several times their size.
SPLIT_BYTES = 32 * 1024 * 1024


@contextmanager
def lean_writes(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no more on disk than their files.

    What a write shuffled is deleted when it ends, not when the driver next collects its
    garbage, and rows for few folders are not sorted, so that sorts need not spill.
    """
    before = spark.conf.getAll
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = "spark.sql.files.maxPartitionBytes"
    settings = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.maxConcurrentOutputFileWriters": str(FOLDERS_AT_ONCE),
        split: str(min(SPLIT_BYTES, size(spark.conf.get(split)))),
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in settings:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


def stored(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """The rows of ``df``, written to a work table and read back: cuts the lineage, survives lost executors.

    With ``lean`` the table is compact and what was shuffled for it is deleted at once.
    """
    spark: SparkSession = df.sparkSession
    path = work_folder(spark, name)
    if lean:
        with lean_writes(spark):
            df.write.options(**COMPACT).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def files_below(spark: SparkSession, folder: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of every file below a folder, at any depth, empty files too.

    The file system's own iterator is followed, which fetches a large listing page
    by page, so taking the first file costs one page and counting holds one entry at
    a time. Names that start with ``_`` or ``.`` are left out with all below
    them; a folder that does not exist has no files.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return
    top = system.getFileStatus(path).getPath().toString().rstrip("/")
    files = system.listFiles(path, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()
        if not any(part.startswith(("_", ".")) for part in name[len(top):].split("/")):
            yield name, status.getLen()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a work folder once nothing reads it any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
