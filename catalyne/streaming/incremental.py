"""New files, one after another: a checkpointed batch loop, a stream whose offset is a file's name, and one by time of change."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import pending
from ..sources.sinks import ensure_schema, read_table, replace_table, upsert

CHECKPOINT = "name string, last_file string"


def last_file(spark: SparkSession, table: str, name: str = "delta") -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    row = read_table(spark, table).where(F.col("name") == name).first()
    return row["last_file"] if row else None


def pending_files(index: DataFrame, checkpoint: str | None) -> DataFrame:
    """(file): the names after the checkpoint, sorted."""
    return index.where(pending("file", checkpoint)).orderBy("file")


def run_pending(spark: SparkSession, index: DataFrame, step: Callable[[str], None], table: str, name: str = "delta") -> list[str]:
    """Runs a step on every pending file in order of name, and moves the checkpoint once all have succeeded; the steps are
    upserts, so that files of a run that failed are simply run again. Nothing pending: nothing happens."""
    files = [r["file"] for r in pending_files(index, last_file(spark, table, name)).collect()]
    for f in files:
        step(f)
    if files:
        ensure_schema(spark, table)
        row = spark.createDataFrame([(name, files[-1])], CHECKPOINT)
        upsert(row, table, ["name"]) if spark.catalog.tableExists(table) else replace_table(row, table, ["name"])
    return files


def stream_files(spark: SparkSession, path: str, schema: str, handle: Callable[[DataFrame, int], None], checkpoint: str, format: str = "json", files: int = 1) -> StreamingQuery:
    """All files that a folder has now and that no earlier run has seen, a batch for each; ended when they are done. Files come
    by their time of change; where names must rule, use run_pending()."""
    source = spark.readStream.format(format).schema(schema).option("maxFilesPerTrigger", files).load(path)
    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_batches(table: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A handler that upserts each batch; a batch that runs twice changes nothing."""
    return lambda batch, _: upsert(batch, table, keys)


class NameReader(DataSourceStreamReader):
    """The names of an index as a stream; the offset is the last name, so that names rule and not times of change."""

    def __init__(self, names: list[str]):
        self.names = sorted(set(names))

    def initialOffset(self) -> dict:
        return {"file": ""}

    def latestOffset(self) -> dict:
        return {"file": self.names[-1] if self.names else ""}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition([n for n in self.names if start["file"] < n <= end["file"]])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from ((n,) for n in partition.value)


class FileNames(DataSource):
    """Option names: a JSON list, such as an index holds."""

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "file string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return NameReader(json.loads(self.options["names"]))


def stream_names(spark: SparkSession, index: DataFrame, step: Callable[[str], None], checkpoint: str) -> list[str]:
    """Runs a step on every file of an index (file) whose name comes after the stream's offset, in order of name, and ends
    when all are done. Spark's checkpoint takes the offset forward once all steps of a run have succeeded; a run that failed
    is run again, so that steps have to be such as can be. Returns the names that were run; nothing pending: none."""
    spark.dataSource.register(FileNames)
    names = [r["file"] for r in index.select("file").where("file is not null").distinct().collect()]  # an index is a short text
    done: list[str] = []

    def handle(batch: DataFrame, _: int) -> None:
        for name in sorted(r["file"] for r in batch.collect()):
            step(name)
            done.append(name)

    source = spark.readStream.format("file_names").option("names", json.dumps(names)).load()
    source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return done
