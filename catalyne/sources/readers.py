"""Where rows come from: snapshots, deltas, indexes, taxonomies, tables."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.columns import parse_spec
from .files import Files


def read_columns(spark: SparkSession, path: str, columns: str | list[str] | None = None) -> DataFrame:
    """A Parquet scan of some columns, named in a list or in one text with commas."""
    rows = spark.read.parquet(path)
    names = [c.strip() for c in columns.split(",")] if isinstance(columns, str) else columns
    return rows.select(*[F.col(f"`{c}`") for c in names if c]) if names else rows


def read_zip_parquet(spark: SparkSession, path: str, staging: str) -> DataFrame:
    """The first Parquet member of a ZIP file, staged in a folder that executors can read. ValueError without any.

    The archive is a stream from store to store that is inflated on the way, a block at a time: neither it nor the member
    is held, and both may be larger than any memory. It's one stream by its nature; what is read of the member is not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(path)
    archive = jvm.java.util.zip.ZipInputStream(source.getFileSystem(conf).open(source))
    try:
        seen = 0
        while (entry := archive.getNextEntry()) is not None:
            seen += 1
            name = entry.getName().rsplit("/", 1)[-1]
            if not name.endswith(".parquet"):
                continue
            target = f"{staging.rstrip('/')}/{name}"
            made = jvm.org.apache.hadoop.fs.Path(target)
            out = made.getFileSystem(conf).create(made, True)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(archive, out, 1 << 20, False)
            finally:
                out.close()
            return spark.read.parquet(target)
    except Py4JJavaError as e:
        raise ValueError("not a ZIP archive, or a damaged one") from e
    finally:
        archive.close()
    raise ValueError("the archive holds no Parquet file" if seen else "not a ZIP archive")


def read_range(spark: SparkSession, path: str, low, high) -> DataFrame:
    """The rows of sorted files (see write_sorted) whose first key is between two values, both included: only files whose
    bounds allow for that are read."""
    held = json.loads(Files(spark, path).read("_bounds.json"))
    schema = T.StructType.fromJson(json.loads(held["schema"]))
    names = [f["file"] for f in held["files"] if f["low"] is not None and not (f["high"] < low or f["low"] > high)]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{n}" for n in names]).where(F.col(held["key"]).between(low, high))


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file in any store that Spark reaches."""
    folder, _, name = path.rpartition("/")
    Files(spark, folder).write(name, data)


def json_keys(lines: DataFrame) -> list[str]:
    """All keys that any line has, sorted."""
    keys = lines.select(F.explode(F.map_keys(F.from_json("value", "map<string,string>"))).alias("k")).distinct()
    return sorted(r["k"] for r in keys.collect())


def read_delta(spark: SparkSession, path: str, country: str | None = None, columns: str | None = None) -> DataFrame:
    """JSON lines, gzipped or not, with every value as text: nested values as JSON, scalars as they are written.

    columns: a column spec; all of its alternatives are kept. Without one, every key of the file is a column. country: only
    lines one of whose countries_tags holds it, in any case. Lines that aren't JSON objects are left out.
    """
    lines = spark.read.text(path).where(strip("value") != "")
    names = sorted({c for _, options in parse_spec(columns) for c in options}) if columns else json_keys(lines)
    wanted = sorted({*names, "countries_tags"})
    schema = T.StructType([T.StructField(c, T.StringType()) for c in wanted])
    rows = lines.where(F.try_parse_json("value").isNotNull()).select(F.from_json("value", schema).alias("r")).where("r is not null")
    if country:
        tags = F.from_json(F.col("r.countries_tags"), "array<string>")
        rows = rows.where(F.coalesce(F.exists(tags, lambda t: F.contains(F.lower(t), F.lit(country.lower()))), F.lit(False)))
    return rows.select(*[F.col(f"r.`{c}`").alias(c) for c in names])


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(file): the names in a text index, trimmed, without blanks, sorted."""
    names = spark.read.text(path).select(strip("value").alias("file"))
    return names.where("file <> ''").orderBy("file")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text as a whole, such as a taxonomy."""
    return spark.read.text(path, wholetext=True).first()[0]


def first_table(spark: SparkSession, *names: str) -> str | None:
    """The first of the tables that exists."""
    return next((n for n in names if n and spark.catalog.tableExists(n)), None)
