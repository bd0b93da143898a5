"""What a stored table was made from, as a short text (L9): files, plan, and this package's code."""

from __future__ import annotations

import hashlib
from functools import cache
from importlib.resources import files
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def digest(*parts: str) -> str:
    return hashlib.md5("\n".join(parts).encode()).hexdigest()[:16]


@cache
def code() -> str:
    """The modules that decide what is in a table."""
    package = files("tallyhouse")
    modules = [m for part in ("functions", "operators", "sources", "plans") for m in package.joinpath(part).iterdir()]
    texts = {f"{m.name}": m.read_text() for m in modules if m.name.endswith(".py")}
    return digest(*(f"{name}\n{text}" for name, text in sorted(texts.items())))


def of_files(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of files and of the files in folders; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = found.agg(F.count(F.lit(1)), F.sum(each)).first()
    return digest(*map(str, row))


def of_source(df: DataFrame) -> str:
    """A source's files and what is done with them; rows that lie in no file are new every time."""
    paths = df.inputFiles()
    if not paths:
        return uuid4().hex[:16]
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized().toString()
    return digest(of_files(df.sparkSession, sorted(paths)), plan)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder ended: Spark's mark of a finished job is there."""
    where, system = _file_system(spark, f"{path}/_SUCCESS")
    return system.exists(where)


def folder_stamp(spark: SparkSession, folder: str) -> str:
    """Changes when a file directly in the folder, or in one of its folders, is added, removed or replaced."""
    where, system = _file_system(spark, folder)
    entries = system.listStatus(where)
    return digest(*sorted(f"{e.getPath().getName()} {e.getLen()} {e.getModificationTime()}" for e in entries))
