"""Answers of a service for texts, such as vectors or terms: each text is asked once, and what is known is read from a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .versions import VersionedTable

#: Fixed value: texts of a call.
TOGETHER = 12
TRIES, WAIT = 3, 1.0


def asked(misses: DataFrame, ask: Callable[[list[str]], list], kind: T.DataType, together: int = TOGETHER, tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """(key, answer) of rows (key, text): ask gets so many texts and returns as many answers, null for a text that it has none
    for. A call that fails is tried again after a while, twice as long each time; after the last, its texts have no
    answer. It runs on executors, so that it has to open what it needs itself."""

    def called(texts: list[str]) -> list:
        for n in range(tries):
            try:
                out = list(ask(texts))
                if len(out) != len(texts):
                    raise ValueError(f"{len(out)} answers for {len(texts)} texts")
                return out
            except Exception:
                if n + 1 < tries:
                    time.sleep(wait * 2**n)
        return [None] * len(texts)

    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        texts: list[str] = []

        def answers() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(called(texts), arrow)], ["key", "answer"])
            keys.clear()
            texts.clear()
            return got

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys.append(k)
                texts.append(t)
                if len(texts) == together:
                    yield answers()
        if texts:
            yield answers()

    schema = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("answer", kind)])
    return misses.select("key", "text").mapInArrow(run, schema)


def answered(rows: DataFrame, text: str, ask: Callable[[list[str]], list], kind: str, cache: str, together: int = TOGETHER, tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """rows with `answer` for a column of texts. cache: the folder of a table of answers by the SHA-256 of the text; texts that
    it hasn't are asked for, each once however often it stands in rows, and added. A text without an answer has null and is
    asked for again the next time; null texts have null and are never asked for."""
    spark = rows.sparkSession
    answer = T._parse_datatype_string(kind)
    known = VersionedTable(spark, cache)
    known.create(T.StructType([T.StructField("key", T.BinaryType()), T.StructField("answer", answer)]), ["key"])
    keyed = rows.withColumn("_key", F.unhex(F.sha2(F.col(text), 256)))
    wanted = keyed.where(F.col(text).isNotNull()).groupBy(F.col("_key").alias("key")).agg(F.first(text).alias("text"))
    misses = wanted.join(known.read().select("key"), "key", "left_anti")
    known.upsert(asked(misses, ask, answer, together, tries, wait).where("answer is not null"), ["key"])
    return keyed.join(known.read().withColumnRenamed("key", "_key"), "_key", "left").select(*rows.columns, "answer")
