"""Folders on whatever file system the path names."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


# fixed values: what Spark spells as % and two hexadecimal digits in the name of a partition's folder
ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def escaped(name: str) -> str:
    """A value as Spark writes it into the name of a folder; there is no folder for an empty one."""
    if not name:
        raise ValueError("a folder needs a name")
    return ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", name)


def unescaped(name: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), name)


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.mkdirs(target)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in `path`, or none if it is missing."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def holding_batch(spark: SparkSession, root: str, column: str, batch_id: int) -> list[str]:
    """Values of a partition column that already hold the folder of one micro-batch."""
    return [unescaped(name.split("=", 1)[1]) for name in folders(spark, root)
            if name.startswith(f"{column}=") and exists(spark, f"{root}/{name}/batch={batch_id}")]
