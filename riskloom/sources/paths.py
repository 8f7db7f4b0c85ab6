"""Small file-system questions, answered by the file system Spark itself uses."""

from __future__ import annotations

import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _resolve(spark, path)
    return files.exists(target)


def is_directory(spark: SparkSession, path: str) -> bool:
    files, target = _resolve(spark, path)
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one, if it is there."""
    files, target = _resolve(spark, path)
    files.delete(target, True)


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the complete folders ``<prefix>=<n>`` below a folder, ascending."""
    found = [n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith(f"{prefix}=")]
    return sorted(int(n) for n in found if exists(spark, f"{path}/{prefix}={n}/_SUCCESS"))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when there is no such folder."""
    files, target = _resolve(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


#: A local file system renames a file and its checksum one after another; writers of one process take turns.
_turn = threading.Lock()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, and nothing changed, when there is one already.

    Written under another name and renamed without overwriting, so no reader sees a part of it: one step
    on HDFS. A store without such a rename needs one writer at a time.
    """
    files, target = _resolve(spark, path)
    if files.exists(target):
        return False
    _, draft = _resolve(spark, f"{path}.{uuid.uuid4().hex[:12]}.draft")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        with _turn:
            context.rename(files.makeQualified(draft), files.makeQualified(target), no_options)
    except Py4JJavaError as taken:
        files.delete(draft, False)
        if "FileAlreadyExists" not in str(taken.java_exception):
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _resolve(spark, path)
    with _turn:
        stream = files.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
