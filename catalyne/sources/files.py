"""Files in any store that Spark reaches, from the driver."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHUNK = 1 << 22


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: spark.checkpoint.dir, or the warehouse where that is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: what reads them more than once doesn't compute them again,
    and a lost executor costs no more than the stage that reads. The files stay until the folder is cleaned."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Options of the session for a while; __ stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def endless_recursion(spark: SparkSession):
    """Recursive queries that run inside follow their rows to the end."""
    return settings(spark, spark__sql__cteRecursionRowLimit="-1", spark__sql__cteRecursionLevelLimit="-1")


class Files:
    """A folder of a store, through Hadoop's own file system classes."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm, self._conf = root.rstrip("/"), spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> dict[str, int]:
        """What stands in a folder, with the milliseconds of its last change; a folder that isn't there has nothing."""
        path = self._path(folder)
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(path)} if self._fs.exists(path) else {}

    def size(self, name: str) -> int:
        return self._fs.getContentSummary(self._path(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, data: bytes) -> None:
        out = self._fs.create(self._path(name), True)
        try:
            for i in range(0, len(data), CHUNK):
                out.write(bytearray(data[i : i + CHUNK]))
        finally:
            out.close()

    def publish(self, name: str, data: bytes, beside: str) -> bool:
        """Makes a file appear whole or not at all: it is written beside and renamed. False if there is one of that name.
        HDFS decides that atomically; a local folder looks first, and object stores need a rename of their own for it."""
        self.write(beside, data)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName(rename.NONE.getClass().getName()), 0)
        try:
            context.rename(self._fs.makeQualified(self._path(beside)), self._fs.makeQualified(self._path(name)), none)
        except Exception:
            taken = self._fs.exists(self._path(name))
            self.delete(beside)
            if taken:
                return False
            raise
        return True

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)
