"""Session settings that results depend on, and scratch folders that all executors reach."""

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_scope = ContextVar("pagetide scratch folder of the running query", default=None)
_previous = {}


def utc(spark):
    """Days, hours and labels are UTC; pin the session zone so they do not follow the driver."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores="*", app="pagetide", **conf):
    """A small local session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def keep_state_on_disk(spark):
    """State of streams goes to RocksDB, on disk and not on the heap.

    A commit writes what changed since the last one, not the whole state. Rows are not counted, as
    that reads each key a second time.
    """
    place = "spark.sql.streaming.stateStore"
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set(f"{place}.providerClass", provider)
    spark.conf.set(f"{place}.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set(f"{place}.rocksdb.trackTotalNumberOfRows", "false")


def _shared_folder(spark):
    """The folder that the cluster names for checkpoints; there is no fallback."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark._jsc.sc().getCheckpointDir()
        folder = folder.get() if folder.isDefined() else None
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return folder.rstrip("/")


def file_system(spark, folder):
    """A path and the file system that it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_file(spark, name):
    path, files = file_system(spark, name)
    return files.getFileStatus(path).isFile()


def delete_folder(spark, folder):
    path, files = file_system(spark, folder)
    files.delete(path, True)


def folders(spark, pattern):
    """Existing folders that match a glob, as paths."""
    path, files = file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def move_folder(spark, new, place):
    """Put a complete folder in a place that is free; False where it is taken."""
    new_path, files = file_system(spark, new)
    path, _ = file_system(spark, place)
    files.mkdirs(path.getParent())
    return not files.exists(path) and files.rename(new_path, path)


@contextmanager
def query_run(spark, name):
    """The scratch folders of one run of a named query.

    They live as long as the result may be read: until the query is run again in the session, or
    until the session ends.
    """
    key = (spark.sparkContext.applicationId, name)
    for folder in _previous.pop(key, []):
        delete_folder(spark, folder)
    made = _previous.setdefault(key, [])
    token = _scope.set((name, made))
    try:
        yield
    finally:
        _scope.reset(token)


def scratch_folder(spark, label):
    """A new folder below `spark.checkpoint.dir`, which every executor can reach.

    What is written there is a copy of table data. It is removed when the query that made it is
    run again, and at the latest when the session's JVM ends.
    """
    name, made = _scope.get() or ("call", [])
    own = f"{_shared_folder(spark)}/pagetide-{name}-{label}-{uuid.uuid4().hex}"
    path, files = file_system(spark, own)
    files.mkdirs(path)
    files.deleteOnExit(path)
    made.append(own)
    return f"{own}/data"
