"""Numbered commits of a stored table.

A commit is one small file named by its number. Whoever creates the file first has the number, all
others are told so, and a reader sees the whole file or none: the text is written beside it and then
takes the number's name, which fails where that name is taken. This needs a file system that can do
so at once: HDFS (a rename that does not overwrite) or a local or mounted one (a hard link). Object
stores without such a rename are refused rather than trusted.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# File systems whose rename or link creates a name at most once.
EXCLUSIVE = ("file", "hdfs", "viewfs")
# Those of them where a link is exclusive and a rename is not.
LINKED = ("file",)
_NAME = re.compile(r"^(\d{12})\.json$")


class CommitConflictError(RuntimeError):
    """Another writer has this number."""


def _folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _raised(error: Py4JJavaError, *names: str) -> bool:
    """Whether the error is or was caused by one of the Java exceptions."""
    cause = error.java_exception
    while cause is not None:
        if cause.getClass().getSimpleName() in names:
            return True
        cause = cause.getCause()
    return False


def commit(spark: SparkSession, folder: str, number: int, entry: dict) -> None:
    """Give ``entry`` the number, or raise ``CommitConflictError`` if another entry has it."""
    files, path = _folder(spark, folder)
    kind = files.getUri().getScheme()
    if kind not in EXCLUSIVE:
        raise ValueError(f"commits need one of {', '.join(EXCLUSIVE)}, not {kind}")
    jvm = spark._jvm
    made = jvm.org.apache.hadoop.fs.Path(path, f"_{uuid.uuid4().hex}")
    target = jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}.json")
    out = files.create(made, False)
    out.write(bytearray(json.dumps(entry), "utf-8"))
    out.close()
    try:
        if kind in LINKED:
            jvm.java.nio.file.Files.createLink(files.pathToFile(target).toPath(), files.pathToFile(made).toPath())
        else:
            option = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(option, 1)
            options[0] = option.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(made, target, options)
    except Py4JJavaError as error:
        if not _raised(error, "FileAlreadyExistsException"):
            raise
        raise CommitConflictError(f"number {number} in {folder} is taken") from None
    finally:
        files.delete(made, False)


def latest(spark: SparkSession, folder: str) -> tuple[int, dict] | None:
    """The highest number and its entry; nothing where nothing has been committed."""
    files, path = _folder(spark, folder)
    if not files.exists(path):
        return None
    numbers = [int(m[1]) for m in (_NAME.match(s.getPath().getName()) for s in files.listStatus(path)) if m]
    if not numbers:
        return None
    return max(numbers), entry_of(spark, folder, max(numbers))


def entry_of(spark: SparkSession, folder: str, number: int) -> dict:
    files, path = _folder(spark, folder)
    stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
