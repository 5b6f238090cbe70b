"""Choosing columns: fallbacks, fixed schemas, texts of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_spec(spec: str | list[str]) -> list[tuple[str, list[str]]]:
    """`code,grade|old_grade` gives (target, its alternatives in order) for each entry."""
    entries = spec.split(",") if isinstance(spec, str) else spec
    parsed = [[x.strip() for x in e.split("|") if x.strip()] for e in entries]
    return [(p[0], p) for p in parsed if p]


def keep_columns(spec: str | None) -> set[str] | None:
    """Every name that a spec mentions; None keeps all."""
    return {c for _, options in parse_spec(spec) for c in options} if spec else None


def resolve(rows: DataFrame, spec: str | list[str], kind: str = "string") -> DataFrame:
    """The spec's targets, each from the first alternative that the rows have; null where they have none."""
    have = set(rows.columns)

    def source(target: str, options: list[str]) -> Column:
        found = next((c for c in options if c in have), None)
        return (F.col(f"`{found}`") if found else F.lit(None).cast(kind)).alias(target)

    return rows.select(*[source(t, o) for t, o in parse_spec(spec)])


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: cast where the type differs (null where that fails), null where they're missing."""
    have = {f.name: f.dataType for f in rows.schema.fields}

    def one(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f"`{f.name}`")
        if have[f.name] == f.dataType:
            return c
        if isinstance(f.dataType, T.StringType) and isinstance(have[f.name], (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            return F.to_json(c).alias(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(have[f.name], T.StringType):
            return F.from_json(c, f.dataType).alias(f.name)
        return c.try_cast(f.dataType).alias(f.name)

    return rows.select(*[one(f) for f in schema.fields])


def without(rows: DataFrame, *names: str) -> DataFrame:
    """Less the columns that are there."""
    return rows.drop(*names)


def stringified(rows: DataFrame) -> DataFrame:
    """Every value as text: nested ones as JSON, NaN as null."""

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            return F.to_json(c).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c.cast("string")).alias(f.name)
        return c.cast("string").alias(f.name)

    return rows.select(*[one(f) for f in rows.schema.fields])
