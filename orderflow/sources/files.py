"""Small files and folder listings on whatever file system holds a path.

Used for run manifests and markers only; tables are read and written by Spark.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _open(spark: SparkSession, path: str):
    """The path and its file system."""
    p = _path(spark, path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    p, fs = _open(spark, path)
    fs.delete(p, True)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(path, bytes, modified)`` of every file below a folder, in order;
    hidden files (``_SUCCESS``, ``.crc``) are no input and left out."""
    p, fs = _open(spark, path)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """The contents of a file written here, or None if there is none."""
    p, fs = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Replace a file in one step: written beside it, then renamed over it, so
    that a reader sees the old contents or the new ones."""
    jvm = spark.sparkContext._jvm
    beside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    p, fs = _open(spark, beside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(_path(spark, path)), options)
