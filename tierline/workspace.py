"""Shared folders, and the few file system calls Spark has no DataFrame for."""

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the session's shared folder, spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tierline-")
    return f"{root.rstrip('/')}/tierline/{purpose}-{uuid.uuid4().hex}"


def check_utc(spark: SparkSession) -> None:
    """Refuse sessions whose zone is not UTC: event text, labels and folders are all in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, it is {zone}")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    system, target = _file_system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file with its whole content at once; False if there is one already."""
    system, target = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = spark._jvm.org.apache.hadoop.fs
    whole = system.makeQualified(target)
    context = files.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    never_replace = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    never_replace[0] = files.Options.Rename.NONE
    try:
        context.rename(system.makeQualified(draft), whole, never_replace)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def remove(spark: SparkSession, path: str) -> bool:
    """Delete one folder or file; a metadata call, however large it is."""
    system, target = _file_system(spark, path)
    return system.delete(target, True)


def matching(spark: SparkSession, glob: str) -> list[str]:
    """Paths that a glob matches."""
    system, pattern = _file_system(spark, glob)
    return sorted(entry.getPath().toString() for entry in system.globStatus(pattern) or [])


def remove_unchanged(spark: SparkSession, path: str, length: int, modified: int) -> bool:
    """Delete a file if it still has this length and modification time (in ms)."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return False
    status = system.getFileStatus(target)
    same = status.getLen() == length and status.getModificationTime() == modified
    return same and system.delete(target, False)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    system, target = _file_system(spark, path)
    system.create(target, True).close()


def remove_matching(spark: SparkSession, glob: str) -> int:
    """Delete what a glob matches; returns how many entries that were."""
    system, pattern = _file_system(spark, glob)
    entries = system.globStatus(pattern) or []
    for entry in entries:
        system.delete(entry.getPath(), True)
    return len(entries)
