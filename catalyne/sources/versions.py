"""Tables of versions: rows lie in buckets by a hash of their key, and the last entry of a log says which folders they are in.

    <table>.versions/log/00000000000000000007.json    keys, number of buckets, schema, folder of every bucket, marks
    <table>.versions/data/<version>-<id>/__bucket=<n>/*.parquet

A batch rewrites the buckets that it touches, into a folder of its own; nothing that is there is changed. The version exists
from the moment its entry is in the log, under a name that only one writer can take. A writer that fails before leaves the
table as it was, one that fails after leaves it as it should be.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files

#: Buckets of a new table, and stored bytes of a bucket on average from which on a table gets more of them.
BUCKETS, MOST_BYTES = 16, 512 << 20
#: Times that a batch is applied anew as another writer was first.
TRIES = 5
BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer took the version."""


@dataclass
class State:
    """An entry of the log. parts: the folder and the stored bytes of every bucket that has rows. marks: what has been
    applied, by name."""

    version: int
    keys: list[str]
    buckets: int
    schema: str
    parts: dict[str, list] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    @property
    def bytes(self) -> int:
        return sum(size for _, size in self.parts.values())


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def state(self, version: int | None = None) -> State | None:
        """The last version, or an earlier one that has not been vacuumed; None if there is no table."""
        known = sorted(int(n.partition(".")[0]) for n in self.files.names("log") if n.endswith(".json") and n[0].isdigit())
        at = version if version is not None else max(known, default=None)
        return State(**json.loads(self.files.read(self._entry(at)))) if at in known else None

    def exists(self) -> bool:
        return self.state() is not None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; later ones don't change them while they last."""
        state = self.state(version)
        if state is None:
            raise ValueError(f"no such table or version: {self.path}")
        return self._rows(state, list(state.parts))

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """The rows of some keys; only the buckets that these can be in are read."""
        state = self.state()
        keys = wanted.select(*[F.col(k).cast(state.struct[k].dataType).alias(k) for k in state.keys]).distinct()
        touched = {str(r[0]) for r in keys.select(bucket_of(state.keys, state.buckets)).distinct().collect()}
        return self._rows(state, [b for b in state.parts if b in touched]).join(keys, state.keys, "left_semi")

    def paths(self, state: State, buckets: list[str] | None = None) -> list[str]:
        """A path for each folder that holds buckets of the version."""
        by_folder: dict[str, list[str]] = defaultdict(list)
        for b in state.parts if buckets is None else buckets:
            by_folder[state.parts[b][0]].append(b)
        return [f"{self.path}/data/{f}/{BUCKET}={{{','.join(sorted(bs, key=int))}}}" for f, bs in sorted(by_folder.items())]

    def replace(self, rows: DataFrame, keys: list[str], buckets: int | None = None) -> State:
        """A version with these rows alone."""
        before = self.state()
        n = buckets or (before.buckets if before else BUCKETS)
        schema = nullable(rows.schema)
        parts = self._write(rows.withColumn(BUCKET, bucket_of(keys, n)), self._next(before))
        return self._commit(before, State(0, list(keys), n, schema.json(), parts, before.marks if before else {}))

    def create(self, schema: T.StructType, keys: list[str], buckets: int = BUCKETS) -> State:
        """A version without rows, if there is no table."""
        return self.state() or self._commit(None, State(0, list(keys), buckets, nullable(schema).json()))

    def upsert(self, batch: DataFrame, keys: list[str], dedupe: str | None = None, mark: tuple[str, str] | None = None) -> State:
        """The rows of the table whose keys the batch hasn't, and the batch.

        Columns go by name and take the table's types; those that the batch lacks are null, those that it adds make every
        bucket be written once. Rows with a null among their keys match none and stay. dedupe: a column by which the last
        row of each key of the batch is kept; without it, all rows of the batch count. mark: (name, value); nothing happens
        if the table has that value or a later one under the name, so that a batch that is tried again counts once.
        """
        for _ in range(TRIES):
            try:
                return self._upsert(batch, list(keys), dedupe, mark)
            except Conflict:
                continue
        raise Conflict(f"other writers were first {TRIES} times: {self.path}")

    def _upsert(self, batch: DataFrame, keys: list[str], dedupe: str | None, mark: tuple[str, str] | None) -> State:
        state = self.state()
        if state and mark and state.marks.get(mark[0], "") >= mark[1]:
            return state
        if state is None:
            state = State(-1, keys, BUCKETS, nullable(batch.schema).json())
        more = state.buckets if state.bytes <= state.buckets * MOST_BYTES else -(-4 * state.bytes // MOST_BYTES)
        known = state.struct
        schema = T.StructType([*known.fields, *[f for f in nullable(batch.schema) if f.name not in known.names]])
        whole = more != state.buckets or keys != state.keys or len(schema) > len(known)
        cols = [(F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        fresh = batch.select(*cols)
        if dedupe:
            fresh = fresh.groupBy(*keys).agg(F.max_by(F.struct(*fresh.columns), F.col(dedupe)).alias("r")).select("r.*")
        # Read three times, and a batch may not be the same when it is computed again: it is written first.
        staged = f"data/{self._next(state)}.batch"
        fresh = fresh.withColumn(BUCKET, bucket_of(keys, more))
        try:
            fresh.write.parquet(f"{self.path}/{staged}")
            fresh = self.spark.read.schema(fresh.schema).parquet(f"{self.path}/{staged}")
            touched = {str(r[0]) for r in fresh.select(BUCKET).distinct().collect()}
            marks = state.marks | ({mark[0]: mark[1]} if mark else {})
            if not touched and not whole:
                return self._commit(state, State(0, keys, more, schema.json(), state.parts, marks)) if mark or state.version < 0 else state
            held = self._rows(state, [b for b in state.parts if whole or b in touched], schema)
            stay = held.join(fresh.select(*keys).distinct(), keys, "left_anti").select(schema.names)
            rows = stay.withColumn(BUCKET, bucket_of(keys, more)).unionByName(fresh)
            parts = self._write(rows, self._next(state))
            return self._commit(state, State(0, keys, more, schema.json(), parts if whole else state.parts | parts, marks))
        finally:
            self.files.delete(staged)

    def vacuum(self, keep: int = 2, older_than: float = 86_400) -> list[str]:
        """Deletes what none of the last versions needs: entries of the log, and folders that were last changed so many
        seconds ago, as younger ones may belong to a writer that isn't done. Returns the folders that went."""
        entries = sorted(n for n in self.files.names("log") if n.endswith(".json"))
        for n in entries[:-keep]:
            self.files.delete(f"log/{n}")
        used = {f for n in entries[-keep:] for f, _ in json.loads(self.files.read(f"log/{n}"))["parts"].values()}
        gone = [f for f, at in self.files.names("data").items() if f not in used and at <= (time.time() - older_than) * 1000]
        for f in gone:
            self.files.delete(f"data/{f}")
        return gone

    def drop(self) -> None:
        self.files.delete()

    @staticmethod
    def _entry(version: int) -> str:
        return f"log/{version:020d}.json"

    @staticmethod
    def _next(before: State | None) -> str:
        return f"{before.version + 1 if before else 0:020d}-{uuid.uuid4().hex[:12]}"

    def _rows(self, state: State, buckets: list[str], schema: T.StructType | None = None) -> DataFrame:
        """Rows of some buckets; columns that their files lack are null."""
        schema = schema or state.struct
        return self.spark.read.schema(schema).parquet(*self.paths(state, buckets)) if buckets else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, folder: str) -> dict[str, list]:
        """Writes rows into a new folder, a bucket a subfolder; a bucket that is too large for one task is dealt to many."""
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        made = [n.partition("=")[2] for n in self.files.names(f"data/{folder}") if n.startswith(f"{BUCKET}=")]
        return {b: [folder, self.files.size(f"data/{folder}/{BUCKET}={b}")] for b in made}

    def _commit(self, before: State | None, after: State) -> State:
        after.version = before.version + 1 if before else 0
        data = json.dumps(asdict(after)).encode()
        if not self.files.publish(self._entry(after.version), data, f"log/.{uuid.uuid4().hex}.tmp"):
            raise Conflict(f"version {after.version} of {self.path} is another writer's")
        return after
