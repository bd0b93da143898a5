"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # one run of all models generates more classes than the default cache of 100 holds
    "spark.sql.codegen.cache.maxEntries": "2000",
}

#: what results depend on, and what only the running time does
NEEDED = ["spark.sql.ansi.enabled"]
ADVISED = ["spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"]

#: for writes of tables: their shuffle files go when the write ends, not when the driver happens to
#: collect its garbage, so the steps of a build do not pile theirs up
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: for writes by month of lines that a task has in the order of their time, or a few months of: it keeps
#: their files open and sorts nothing
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "100"}

_local_folders: dict[str, str] = {}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings for the time of a step."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def check_session(spark: SparkSession) -> None:
    """Refuse a session whose sums could overflow unseen; warn of one that meets skew unprepared."""

    def off(names: list[str]) -> list[str]:
        return [name for name in names if spark.conf.get(name).lower() != "true"]

    if off(NEEDED):
        raise RuntimeError(f"set to true: {', '.join(off(NEEDED))}")
    if off(ADVISED):
        warnings.warn(f"large groups are not split: set {', '.join(off(ADVISED))} to true", stacklevel=3)


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder, which goes when the
    program ends; on a cluster a
    machine-local folder would lose tables with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    # local-cluster has executors of its own
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"
