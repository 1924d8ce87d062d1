"""Small files beside written tables, by Hadoop's file API: any file system that Spark reaches.

These go through the driver's JVM gateway, so they need a classic session, not Spark Connect.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder for written stages: ``spark.checkpoint.dir``.  Only a local master, where
    the driver is the executor, may do without the setting."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/tmp/checkpoints"


def _system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole of a small file, None if there is none."""
    jvm, at, system = _system(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file that must not exist; False if it does.  The file system decides between
    two callers."""
    jvm, at, system = _system(spark, path)
    if system.getUri().getScheme() == "file":
        return _create_local(at.toUri().getPath(), text)
    try:
        out = system.create(at, False)
    except Exception as e:
        if system.exists(at):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _create_local(path: str, text: str) -> bool:
    """Hadoop's local file system looks for the file before it creates it, which two callers may do at
    once; a link is made by one alone, and its file has its text from the start."""
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    new = f"{folder}/.{uuid.uuid4().hex}"
    with open(new, "x") as f:
        f.write(text)
    try:
        os.link(new, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(new)
    return True


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a file by one rename: a reader sees the old or the new text."""
    jvm, at, system = _system(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}-{uuid.uuid4().hex}")
    out = system.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new, at, options)


def delete(spark: SparkSession, path: str) -> None:
    jvm, at, system = _system(spark, path)
    system.delete(at, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of last change in seconds) of what lies in a folder; empty if it is missing."""
    jvm, at, system = _system(spark, path)
    if not system.exists(at):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(at)]
