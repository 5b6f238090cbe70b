"""Where rows go: files, tables, upserts, quarantine, run metrics."""

from __future__ import annotations

import json
import logging
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import RUNS, UPSERT_KEYS
from .files import Files
from .versions import State, VersionedTable

#: The file of bounds beside sorted files; Spark's readers pass over names that begin so.
BOUNDS = "_bounds.json"
#: The order of the normalized tables' rows.
ORDERS = {"ingredients": ["ingredient_id"], "product_ingredients": ["code", "ingredient_order", "ingredient_id"], "sous_ingredients": ["code", "ingredient_id", "rang", "sous_ingredient_id"], "ingredient_alias": ["ingredient_id", "alias_name"]}
#: Rows of a written batch.
BATCH_ROWS = 500


def write_parquet(rows: DataFrame, path: str, batch: int | None = None) -> None:
    writer = rows.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", batch) if batch else writer).parquet(path)


def write_sorted(rows: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Writes rows in order of their keys, a range of them a file, and beside them the bounds of the first key in each file, so
    that a reader opens only the files that can hold what it looks for. files: about how many; as many as Spark finds
    right without it. Rows without a first key are in the first file."""
    ordered = rows.repartitionByRange(files, *keys) if files else rows.repartitionByRange(*keys)
    ordered.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    held = rows.sparkSession.read.schema(rows.schema).parquet(path)
    name = F.substring_index(F.input_file_name(), "/", -1)
    # A row a file.
    bounds = held.groupBy(name.alias("file")).agg(*[F.to_json(F.struct(f(keys[0]).alias("v"))).alias(n) for n, f in (("low", F.min), ("high", F.max))], F.count_if(F.col(keys[0]).isNull()).alias("nulls")).collect()
    listed = [{"file": r["file"], "low": json.loads(r["low"]).get("v"), "high": json.loads(r["high"]).get("v"), "nulls": r["nulls"]} for r in bounds]
    kind = rows.schema[keys[0]].dataType.simpleString()
    Files(rows.sparkSession, path).write(BOUNDS, json.dumps({"key": keys[0], "kind": kind, "schema": rows.schema.json(), "files": listed}).encode())


def ensure_schema(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def versioned(spark: SparkSession, table: str) -> VersionedTable:
    """The versions of a table of the catalogue, which lie beside its database's tables."""
    database, _, name = table.rpartition(".")
    return VersionedTable(spark, f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{name}.versions")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table: of its last version, or as the catalogue has them if it has no versions."""
    database = table.rpartition(".")[0]
    if database and not spark.catalog.databaseExists(database):
        return spark.table(table)
    versions = versioned(spark, table)
    return versions.read() if versions.exists() else spark.table(table)


def publish(spark: SparkSession, table: str, versions: VersionedTable, state: State) -> None:
    """The version as a view under the table's name, for SQL. The log is what counts: a writer that ends before this leaves a
    view of the version before, whose files are still there."""
    fields = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in state.struct)
    empty_row = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in state.struct)
    parts = [f"SELECT {fields} FROM parquet.`{p}`" for p in versions.paths(state)] or [f"SELECT {empty_row} WHERE false"]
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {' UNION ALL '.join(parts)}")


def adopted(spark: SparkSession, table: str, keys: list[str]) -> VersionedTable:
    """The versions of a table; a plain table of that name becomes the first of them."""
    ensure_schema(spark, table)
    versions = versioned(spark, table)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        if not versions.exists():
            versions.replace(spark.table(table), keys)
        spark.sql(f"DROP TABLE {table}")
    return versions


def keys_of(table: str) -> list[str]:
    return UPSERT_KEYS.get(table.rsplit(".", 1)[-1], ["code"])


def replace_table(rows: DataFrame, table: str, keys: list[str] | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT: a version with these rows alone. keys: what later upserts will go by."""
    spark = rows.sparkSession
    keys = keys or [k for k in keys_of(table) if k in rows.columns] or rows.columns[:1]
    versions = adopted(spark, table, keys)
    publish(spark, table, versions, versions.replace(rows, keys))


def ensure_table(like: DataFrame, table: str) -> None:
    """An empty table with these columns, if there is none."""
    spark = like.sparkSession
    ensure_schema(spark, table)
    if not spark.catalog.tableExists(table):
        keys = [k for k in keys_of(table) if k in like.columns] or like.columns[:1]
        versions = versioned(spark, table)
        publish(spark, table, versions, versions.create(like.schema, keys))


def drop_table(spark: SparkSession, table: str) -> None:
    """A table with all of its versions."""
    if spark.catalog.tableExists(table):
        kind = "VIEW" if spark.catalog.getTable(table).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {table}")
    versioned(spark, table).drop()


def upsert(batch: DataFrame, table: str, keys: list[str] | None = None, dedupe: str | None = None, mark: tuple[str, str] | None = None) -> None:
    """Replaces the rows of a table whose keys the batch has: only the buckets of these keys are written, as a new version.
    If anything fails before that is in the table's log, the table is as it was. mark: see VersionedTable.upsert()."""
    spark = batch.sparkSession
    keys = keys or keys_of(table)
    versions = adopted(spark, table, keys)
    publish(spark, table, versions, versions.upsert(batch, keys, dedupe, mark))


def quarantine(judged: DataFrame, valid_path: str, invalid_path: str, flag: str = "valid") -> dict[str, int]:
    """Writes rows that pass and rows that don't, each to its folder, from one persisted frame. Returns records_in,
    records_out and records_rejected, which are counted by the way as the first folder is written: no pass is made for them."""
    seen, judged = Observation(), judged.persist()
    counts = {"records_in": F.count("*"), "records_out": F.count_if(flag), "records_rejected": F.count_if(~F.col(flag))}
    try:
        observed = judged.observe(seen, *[c.alias(k) for k, c in counts.items()])
        write_parquet(observed.where(flag).drop(flag), valid_path)
        write_parquet(judged.where(f"not {flag}").drop(flag), invalid_path)
        return {k: int(v) for k, v in seen.get.items()}
    finally:
        judged.unpersist()


def rejection_rate(records_in: int, rejected: int) -> float:
    return round(rejected / records_in * 100, 2) if records_in else 0.0


def record_run(spark: SparkSession, command: str, records_in: int, records_out: int, rejected: int, run_id: str | None, dag: str = "", table: str = "monitoring.pipeline_runs") -> bool:
    """One row for each run and command; a repeated run replaces its row. Without a run id nothing is written."""
    if not run_id:
        return False
    row = (run_id, dag, command, records_in, records_out, rejected, rejection_rate(records_in, rejected), datetime.now(UTC).replace(tzinfo=None))
    upsert(spark.createDataFrame([row], RUNS), table, UPSERT_KEYS["pipeline_runs"])
    return True


def write_result(values: list, path: str) -> None:
    """A small result for whatever started the run: a file in any store, or a line of the log where that can't be written."""
    try:
        spark, (folder, _, name) = SparkSession.getActiveSession(), path.rpartition("/")
        if spark is not None and ":" in path:
            Files(spark, folder).write(name, json.dumps(values).encode())
        else:
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            Path(path).write_text(json.dumps(values))
    except Exception as e:
        logging.getLogger(__name__).warning("result not written to %s (%s): %s", path, e, json.dumps(values))


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
