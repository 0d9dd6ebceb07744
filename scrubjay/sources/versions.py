"""Tables whose overwrite is atomic: versioned folders and a numbered pointer that one rename commits.

Below a table's path lie ``_table/data/<version folders>`` and ``_table/commits/<numbers>``; a commit is a small file that names a
version folder. A writer first writes a whole new folder, then a pointer under a temporary name, and renames that to
the next free number; a rename never replaces a file. Readers take the highest number. So whenever a writer dies, readers still
see the old rows; a frame that reads the table can overwrite it, because its own files stay; and of two writers that saw
the same version and say so (``expect``), one fails. Old versions stay readable until ``release`` deletes them.

The rename is atomic on file systems such as HDFS and local disks; on object stores without one, use a table format.
Plain readers of the path find no files there (names that begin with ``_`` are hidden), never a mixture of versions.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class TableChanged(RuntimeError):
    """Another writer committed a version in between."""


class _Store:
    """The few file operations that a versioned table needs, through Hadoop's own clients."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = f"{path.rstrip('/')}/_table"
        self.fs = self.path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in a folder of the table."""
        at = self.path(f"{self.root}/{folder}")
        if not self.fs.exists(at):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(at)]

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(f"{self.root}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(f"{self.root}/{name}"), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        """False if ``new`` is there already."""
        source, target = self.path(f"{self.root}/{old}"), self.path(f"{self.root}/{new}")
        kind = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        never = self.jvm.java.lang.reflect.Array.newInstance(kind, 0)  # no option: nothing is replaced
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(source), self.fs.makeQualified(target), never)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> bool:
        return self.fs.delete(self.path(f"{self.root}/{name}"), True)


def _commits(store: _Store) -> dict[int, str]:
    return {int(name): name for name, _ in store.names("commits") if name.isdigit()}


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that can be read, oldest first."""
    return sorted(_commits(_Store(spark, path)))


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A scan of the newest version, or of one that is still kept."""
    store = _Store(spark, path)
    commits = _commits(store)
    number = version if version is not None else max(commits, default=None)
    if number not in commits:
        raise FileNotFoundError(f"{path} has no version {number}" if version is not None else f"{path} has no table")
    return spark.read.parquet(f"{store.root}/data/{store.read(f'commits/{commits[number]}')}")


def publish(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, expect: int | None = None) -> DataFrame:
    """Writes ``df`` as the next version of the table at ``path`` and returns a scan of just that version.

    ``expect``: the version number that ``df`` was computed from (0: no table yet); if another is the newest at commit,
    ``TableChanged`` is raised and the table stays as it is. Without it the last writer wins.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    folder = f"v-{uuid.uuid4().hex}"
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{store.root}/data/{folder}")
    commit(store, folder, expect)
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(f"{store.root}/data/{folder}")


def commit(store: _Store, folder: str, expect: int | None = None) -> int:
    """Makes a written folder the newest version."""
    pointer = f"commits/.{folder}"
    store.write(pointer, folder)
    while True:
        newest = max(_commits(store), default=0)
        if expect is not None and newest != expect:
            store.delete(pointer)
            raise TableChanged(f"version {expect} was expected, {newest} is the newest")
        if store.rename(pointer, f"commits/{newest + 1:012d}"):
            return newest + 1


def release(spark: SparkSession, path: str, keep: int = 1, grace_seconds: float = 86_400.0) -> int:
    """Deletes all but the newest ``keep`` versions, and leftovers of dead writers older than ``grace_seconds``.

    Pointers go before their folders, so no reader finds a version without its files. Returns the folders deleted.
    """
    if keep < 1:
        raise ValueError("the newest version cannot be released")
    store = _Store(spark, path)
    commits = _commits(store)
    numbers = sorted(commits)
    named = {n: store.read(f"commits/{commits[n]}") for n in numbers}
    for n in numbers[:-keep]:
        store.delete(f"commits/{commits[n]}")
    kept = {named[n] for n in numbers[-keep:]}
    dropped = {named[n] for n in numbers[:-keep]}
    before, gone = (time.time() - grace_seconds) * 1000, 0
    for name, changed in store.names("data"):
        if name not in kept and (name in dropped or changed <= before):
            gone += bool(store.delete(f"data/{name}"))
    for name, changed in store.names("commits"):
        if not name.isdigit() and changed <= before:
            store.delete(f"commits/{name}")
    return gone
