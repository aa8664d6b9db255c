"""Small records in a shared folder, of which each is created once: commits and claims of ids."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    path = _path(spark, folder)
    files = _files(spark, path)
    if not files.exists(path):
        return []
    found = [s.getPath().getName() for s in files.listStatus(path)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def read(spark: SparkSession, path: str) -> dict:
    where = _path(spark, path)
    stream = _files(spark, where).open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def create(spark: SparkSession, path: str, record: dict) -> bool:
    """Write a record unless there is one of that name; readers see it whole or not at all.

    The record is written under a name of its own and then renamed without overwriting, which of several
    writers at the same time one can do.
    """
    target = _path(spark, path)
    files = _files(spark, target)
    own = _path(spark, f"{target.getParent()}/_{uuid.uuid4().hex}")
    out = files.create(own, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
    try:
        context.rename(own, target, keep)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        files.delete(own, False)
        return False


class Claims:
    """Ranges of ids for loads that may run at the same time; no table is scanned for its highest id.

    The claims on a sequence are records named after their first id. A load reads the last claim and creates
    the next; if another load was faster, it tries again behind that one. Ids that are not used leave a gap.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _claims(self, sequence: str) -> list[str]:
        return names(self.spark, f"{self.folder}/{sequence}")

    def claim(self, sequence: str, count: int, *, owner: str | None = None, first: int | Callable[[], int] = 1) -> int:
        """The first of ``count`` ids that no one else has or gets.

        ``first`` starts a new sequence (a function is called only then). A claim of the same ``owner`` that is
        large enough is used again, so that a load that is repeated gets the ids that it had.
        """
        folder = f"{self.folder}/{sequence}"
        if owner is not None:
            for name in self._claims(sequence):
                held = read(self.spark, f"{folder}/{name}")
                if held["owner"] == owner and held["end"] - held["start"] >= count:
                    return held["start"]
        while True:
            taken = self._claims(sequence)
            start = read(self.spark, f"{folder}/{taken[-1]}")["end"] if taken else first() if callable(first) else first
            if create(self.spark, f"{folder}/{start:020d}", {"start": start, "end": start + count, "owner": owner}):
                return start

    def take(self, sequence: str, number: int, **facts) -> bool:
        """Whether ``number`` itself was free; it is taken then."""
        return create(self.spark, f"{self.folder}/{sequence}/{number:020d}", {"start": number, "end": number + 1, "owner": None, **facts})

    def taken(self, sequence: str) -> dict[int, dict]:
        """The numbers that ``take`` gave, with their facts."""
        return {int(n): read(self.spark, f"{self.folder}/{sequence}/{n}") for n in self._claims(sequence)}
