"""Versions of a stored folder: small files, each of which names all that is current.

Data is only ever added to a folder, under new names; what counts is what the newest version
names. A commit writes the next version aside and renames it, which fails if another writer
took the number. So a reader sees a change whole or not at all, and a failed writer leaves
nothing but files that no version names. The rename must be atomic, as on HDFS.
"""

import json
import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_versions"
KEPT = 20


class Conflict(RuntimeError):
    """Another writer committed the same version."""


def file_system(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def delete(spark: SparkSession, path: str) -> None:
    system, found = file_system(spark, path)
    system.delete(found, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, found = file_system(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(found)] if system.exists(found) else []


class Versions:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, posixpath.join(folder, FOLDER)

    def _numbers(self) -> list[int]:
        names = children(self.spark, self.folder)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest version; (0, {}) before the first."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        system, path = file_system(self.spark, posixpath.join(self.folder, _name(numbers[-1])))
        stream = system.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return numbers[-1], json.loads(text)

    def commit(self, number: int, content: dict) -> None:
        """Make `content` version `number`, one above the version it was made from."""
        jvm = self.spark.sparkContext._jvm
        aside = posixpath.join(self.folder, f".{uuid.uuid4().hex}")
        system, path = file_system(self.spark, aside)
        stream = system.create(path, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        target = jvm.org.apache.hadoop.fs.Path(posixpath.join(self.folder, _name(number)))
        try:
            context.rename(path, target, options)
        except Py4JJavaError as error:
            system.delete(path, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise Conflict(f"version {number} of {self.folder} exists") from error
            raise
        for old in self._numbers():
            if old <= number - KEPT:
                delete(self.spark, posixpath.join(self.folder, _name(old)))


def _name(number: int) -> str:
    return f"{number:012d}.json"
