"""Small text files that commit a version of something: written beside, then renamed.

A rename that refuses to replace is one atomic step of the file system (HDFS, local
disks), so a version exists whole or not at all, and of two writers of the same
version one fails. All access goes through Hadoop's file systems, so a folder may
lie in any store that Spark reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of a folder's entries, sorted; none if it does not exist."""
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def commit_text(spark: SparkSession, path: str, text: str) -> None:
    """``text`` as the new file ``path``; raises ``CommitConflict`` if it exists."""
    folder, _, name = path.rpartition("/")
    beside = f"{folder}/_{name}.{uuid.uuid4().hex}"
    p, fs = _fs(spark, beside)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(p, jvm.org.apache.hadoop.fs.Path(path), options)
    except Exception as failed:
        fs.delete(p, False)
        if path.rpartition("/")[2] in names_in(spark, folder):
            raise CommitConflict(path) from failed
        raise
