"""What the operators share: scratch tables, per-worker caches, connected components."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows handed to Python at once. Texts can be long, so that a batch stays within some tens of MB.
BATCH_ROWS = 512

#: Stored bytes of a bucket, the most buckets that a table can have, and a size that says that the planner knows of none.
BUCKET_BYTES, MOST_BUCKETS, UNKNOWN_BYTES = 64 << 20, 100_000, 1 << 60

_own_dir: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset: a folder in the warehouse, or a
    temporary one if the session runs on this machine alone."""
    global _own_dir
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        _own_dir = _own_dir or "file://" + tempfile.mkdtemp(prefix="catalyne-")
        return _own_dir
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: the lineage ends here, and a lost executor costs no
    more than the stage that reads this. Shuffle files of the plans that led here are released."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    del df
    release(spark)
    return out


def bucketed(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The same rows as a table in the shared folder, dealt into buckets by keys and sorted by them: joins on all of the
    keys read it without another shuffle or sort. Buckets hold some BUCKET_BYTES of the input as it is stored."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    size *= size < UNKNOWN_BYTES
    n = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)))
    table = f"catalyne_{name}_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/{table}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("compression", "zstd").option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._scratch_path, out._scratch_table = path, table
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of plans that nobody holds any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by written() that no later plan reads."""
    for t in tables:
        if table := getattr(t, "_scratch_table", None):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
        if path := getattr(t, "_scratch_path", None):
            jvm = t.sparkSession.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession) -> None:
    """Keeps the Arrow batches of text columns small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def worker_cache(key: str, make: Callable[[], object]) -> object:
    """One object per Python worker, kept from task to task."""
    store = sys.__dict__.setdefault("_catalyne_worker_cache", {})
    if key not in store:
        store[key] = make()
    return store[key]


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    edges: two long columns u, v; direction, repeats and loops don't matter. Returns (node, root) for every node that has
    an edge and isn't itself the smallest of its component; root is that smallest node. Each step is a minimum per node
    (combined before the shuffle) and an equi-join; a star's centre is a skewed join key, which adaptive execution splits.
    """
    tidy = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now, mark = written(tidy.distinct(), "edges"), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # The graph is a set of stars once a round changes nothing.
        same = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(now, large)
        now = after
        if same == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = same


def one_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """docs, with one row of every group: that of the smallest doc_id, and of rows that repeat it the smallest by all
    columns that have an order, so that any run keeps the same. Rows with a null doc_id stay. groups: (doc_id, component_id)."""
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    order = [f"`{f.name}`" for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    kept = docs.where("doc_id is not null").join(stay, "doc_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    return kept.withColumn("_first", first).where("_first = 1").select(docs.columns).unionByName(docs.where("doc_id is null"))
