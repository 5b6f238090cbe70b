"""Line dedup: lines that spread over many sites are boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: A line on this many different sites or more is boilerplate.
MIN_SITES = 8
#: Sketches hold 2 to this power of registers; their error is then some 2 %.
LOG_REGISTERS = 11
#: Estimates from 1 - this to 1 + this times the threshold are replaced by exact counts: over ten times the error.
MARGIN = 0.25
BLANKS = " \t\r\x0b\x0c"


def tidy(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_rows(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, tkey, pos, h1, h2, site): the lines that aren't blank, under a 128-bit hash of the line without blanks
    around it. tkey tells apart texts that share a doc_id."""
    key = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey")]
    each = docs.where("doc_id is not null and text is not null").select(*key, F.xxhash64(F.col(site)).alias("hash"), F.col(site).isNotNull().alias("known"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    line = tidy(F.col("line"))
    return each.where(line != "").select("doc_id", "tkey", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), F.when(F.col("known"), F.col("hash")).alias("site"))


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h1, h2, first): the lines on min_sites sites or more, and the smallest doc_id that has each.

    Sketches of the sites merge per line, before the shuffle as far as they can. Where a sketch comes near to the
    threshold, the line's sites are counted exactly; each line and site is then one row a task.
    """
    sketch = rows.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS)).alias("s"), F.min("doc_id").alias("first"))
    spread = written(sketch.select("h1", "h2", "first", F.hll_sketch_estimate("s").alias("n")).where(F.col("n") >= (1 - MARGIN) * min_sites), "spread")
    near = spread.where(F.col("n") <= (1 + MARGIN) * min_sites)
    pairs = rows.where("site is not null").join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("h1", "h2").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    sure = spread.where(F.col("n") > (1 + MARGIN) * min_sites).select("h1", "h2", "first")
    return sure.unionByName(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """docs with their text less the boilerplate, and n_lines and n_removed (columns of these names are replaced).

    A line, without blanks around it, that is on min_sites different sites or more goes everywhere but in the document with
    the smallest doc_id that has it, so that nothing is lost altogether. Blank lines stay and aren't lines that count. Null
    sites count for none; a null text stays null, with 0 lines; rows with a null doc_id are left as they are and don't
    count; rows that share a doc_id are one document. An empty table gives no rows; other columns stay.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = written(line_rows(docs, site), "lines")
    gone = rows.join(boilerplate(rows, min_sites), ["h1", "h2"]).where("doc_id > first")
    places = written(gone.groupBy("doc_id", "tkey").agg(F.collect_set("pos").alias("_gone")), "gone")
    discard(rows)
    left = docs.select(*names, F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("tkey")).alias("_at"))
    # A merge join at every size: the list grows with the corpus.
    both = left.join(places.select(F.struct(F.col("doc_id").alias("id"), "tkey").alias("_at"), "_gone").hint("merge"), "_at", "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    n = F.coalesce(F.size(F.filter(lines, lambda x: tidy(x) != "")), F.lit(0))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept)
    return both.select(*[text.alias("text") if c == "text" else F.col(c) for c in names], F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"), F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (
  SELECT doc_id, source, p.pos, p.line, trim(p.line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS tidy
  FROM documents, LATERAL (SELECT unnest(str_split(text, chr(10))) AS line, generate_subscripts(str_split(text, chr(10)), 1) AS pos) p
  WHERE text IS NOT NULL
), spread AS (
  SELECT tidy, min(doc_id) AS first FROM l WHERE tidy <> '' GROUP BY tidy HAVING count(DISTINCT source) >= {MIN_SITES}
), judged AS (
  SELECT l.*, coalesce(l.doc_id > s.first, false) AS gone FROM l LEFT JOIN spread s ON l.tidy = s.tidy
), kept AS (
  SELECT doc_id, count(*) FILTER (tidy <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
