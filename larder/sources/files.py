"""Small metadata operations on the session's Hadoop file systems.

Only names and sizes pass through here, never table rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def child_directories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below ``path``; none if it is absent."""
    if not exists(spark, path):
        return []
    listed = _fs(spark, path).listStatus(_path(spark, path))
    return sorted(s.getPath().getName() for s in listed if s.isDirectory())


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A digest of the names, sizes and times of all files below some paths: another one once a table is rewritten."""
    found = []
    for path in paths:
        listed = _fs(spark, path).listFiles(_path(spark, path), True)
        while listed.hasNext():
            status = listed.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.md5(repr(sorted(found)).encode()).hexdigest()


def make_directory(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file so that readers see the old text or the new one."""
    jvm = spark._jvm
    staged = _path(spark, f"{path}.staged")
    out = _fs(spark, path).create(staged, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        staged.toUri() if staged.toUri().getScheme() else _fs(spark, path).getUri(),
        spark._jsc.hadoopConfiguration(),
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(staged, _path(spark, path), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is absent."""
    if not exists(spark, path):
        return None
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_child(spark: SparkSession, parent: str, name: str) -> None:
    """Delete one directory directly below ``parent`` and nothing else."""
    if not name or "/" in name or name in (".", ".."):
        raise ValueError(f"not a child name: {name!r}")
    _fs(spark, parent).delete(_path(spark, f"{parent}/{name}"), True)
