"""Numbered commit files that are created only if absent.

A commit is one small file whose name is its number.  It is written under
another name first and then given its own in one step that fails if that name
exists: a hard link on a local disk, a rename without overwriting elsewhere
(atomic on HDFS and the file systems that follow it).  So of two writers that
aim at one number exactly one gets it, and a reader sees a whole file or none.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DIGITS = 12


def _folder(spark: SparkSession, path: str):
    """The JVM, Hadoop's file system of ``path`` and ``path`` with its scheme."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return jvm, fs, fs.makeQualified(p)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of all files under a folder or of a file; empty if there is none."""
    _, fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        s = files.next()
        found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(found)


def commits(spark: SparkSession, folder: str) -> dict[int, str]:
    """Number and path of every commit file in a folder."""
    named = {path.rsplit("/", 1)[-1]: path for path, _, _ in listing(spark, folder)}
    return {int(name): path for name, path in named.items() if name.isdigit()}


def read_commit(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def publish(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Create commit ``number`` with ``text``; False if it exists already."""
    jvm, fs, base = _folder(spark, folder)
    fs.mkdirs(base)
    name, draft = f"{number:0{_DIGITS}d}", f".draft-{uuid.uuid4().hex}"
    if base.toUri().getScheme() == "file":
        local = base.toUri().getPath()
        own = os.path.join(local, draft)
        with open(own, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(own, os.path.join(local, name))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    source, target = (jvm.org.apache.hadoop.fs.Path(base, x) for x in (draft, name))
    out = fs.create(source, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(base.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as exc:
        fs.delete(source, False)
        if "FileAlreadyExistsException" in str(exc.java_exception):
            return False
        raise


def publish_next(spark: SparkSession, folder: str, text: str) -> int:
    """Create the next free commit; returns its number."""
    number = max(commits(spark, folder), default=0) + 1
    while not publish(spark, folder, number, text):
        number += 1
    return number
