"""How far the sources of a language diverge: wide term vectors, compared pair by pair inside each term's row."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, small_batches, written

#: Documents of a language that a term must be in, and terms listed for each group.
MIN_DOCS, TOP = 3, 200
#: What probabilities are multiplied by.
UNIT = 1_000_000_000
#: Fixed value: a term, in UTF-8 whose A-Z are lower case.
TERM, BREAK = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
#: Bytes of a text that are cut into terms together; terms that a task holds before they are handed on, and rows of a batch.
TOGETHER, HELD, ROWS = 1 << 20, 400_000, 20_000


def text_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length. bytes.lower() knows A-Z alone; long texts are cut between terms."""
    text, at = text.lower(), 0
    while at < len(text):
        m = BREAK.search(text, at + TOGETHER) if len(text) - at > TOGETHER else None
        end = m.start() if m else len(text)
        yield TERM.findall(text[at:end])
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents that have it. Tasks count
    before anything is shuffled, so that a hot source costs a row a term and task."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            for at in range(0, len(n), ROWS):
                terms = list(itertools.islice(n, at, at + ROWS)) if len(n) > ROWS else list(n)
                of = lambda c: pa.array([c[t] for t in terms], pa.int64())
                names = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*names, pa.array(terms, pa.binary()).cast(pa.string()), of(n), of(d)], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                own: set[bytes] = set()
                for terms in text_terms(text):
                    n.update(terms)
                    own.update(terms)
                d.update(own)
                size += len(n)
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    small_batches(docs.sparkSession)
    texts = docs.select("lang", "source", F.encode("text", "UTF-8").alias("text"))
    counted = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n, total, terms):
    """1 + floor(UNIT * (n + 1) / (total + terms)) of whole numbers, exactly. n + 1 is at most total + terms."""
    more, all_ = n + 1, total + terms
    wide = lambda c: c.cast("decimal(19,0)")
    exact = F.call_function("div", wide(more) * F.lit(UNIT).cast("decimal(10,0)"), wide(all_))
    return F.lit(1).cast("long") + F.when(more < 9_000_000_000, F.call_function("div", more * UNIT, all_)).otherwise(exact)


def difference(p, q):
    """floor((p - q)² / q): p and q are at most UNIT + 1, so that squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of each group (lang, source) of documents (text, lang, source).

    Part `pair`: each other source of the language, with the summed difference over the language's terms. Part `term`: the
    terms that the group uses more than its language does, the top of them. Terms are those in at least min_docs documents
    of the language.

    Each term of a language is one row with a vector as wide as the language has sources; pairs are compared inside the
    row by higher-order functions and summed before the shuffle. Counts are exact at any size. Nulls in any of the columns count
    as ''; a document without a term still makes its group occur; repeated rows count each; an empty table gives no rows;
    other columns are ignored. A pair of sources without a common vocabulary has the value 0 if the language keeps no term.
    """
    docs = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    # A term's sources are no more than the language has, so that the map is as wide as the vector.
    by_source = F.map_from_entries(F.collect_list(F.struct("source", "n"))).alias("by_source")
    terms = term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), by_source).where(F.col("docs") >= min_docs)
    kept = written(terms.drop("docs"), "terms")
    totals = kept.select("lang", F.explode("by_source").alias("source", "n")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n_terms"))
    by_lang = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("groups"), F.sum("total").alias("all"))
    langs = written(by_lang.join(sizes, "lang", "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0).cast("long"))), "languages")

    # A row a language, so small that Spark sends it to every task; where it isn't, the join is one that it can split.
    wide = kept.join(langs, "lang").select("lang", "term", "groups", "all", "n_terms", F.transform("groups", lambda g: F.coalesce(F.col("by_source")[g["source"]], F.lit(0).cast("long"))).alias("n"))
    vectors = wide.select(
        "lang", "term", "n",
        F.zip_with("n", "groups", lambda n, g: probability(n, g["total"], F.col("n_terms"))).alias("p"),
        probability(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x), F.col("all"), F.col("n_terms")).alias("q"),
    )

    # The difference between source i and source j stands at i * width + j.
    square = F.flatten(F.transform("p", lambda p: F.transform("p", lambda q: difference(p, q))))
    summed = vectors.select("lang", F.posexplode(square).alias("at", "f")).groupBy("lang", "at").agg(F.sum("f").alias("value"))
    # Every pair occurs, also where no term is kept.
    all_pairs = langs.select("lang", F.posexplode("groups").alias("i", "own"), "groups").select("lang", "i", F.col("own.source").alias("source"), F.posexplode("groups").alias("j", "other"), (F.col("i") * F.size("groups")).alias("row")).where("i <> j").withColumn("at", F.col("row") + F.col("j"))
    pairs = all_pairs.join(summed, ["lang", "at"], "left").select("lang", "source", F.lit("pair").alias("part"), F.col("other.source").alias("item"), F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(own))

    used = vectors.select("lang", "term", "q", F.posexplode(F.arrays_zip("n", "p")).alias("i", "x")).where("x.n > 0 AND x.p > q")
    names = langs.select("lang", F.posexplode("groups").alias("i", "own")).select("lang", "i", F.col("own.source").alias("source"))
    scored = used.select("lang", "i", F.col("term").alias("item"), difference(F.col("x.p"), F.col("q")).alias("value"))
    first = Window.partitionBy("lang", "i").orderBy(F.desc("value"), "item")
    best = scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    ranked_terms = best.join(names, ["lang", "i"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return ranked_pairs.unionByName(ranked_terms)


def query(spark, sf_dir: str) -> DataFrame:
    """The sources of documents, language by language."""
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (SELECT lang, source, regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM docs),
each AS (SELECT lang, source, unnest(terms) AS term FROM found),
kept AS MATERIALIZED (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM found) GROUP BY ALL HAVING count(*) >= {MIN_DOCS}),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
cells AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(sum(c.n) OVER (PARTITION BY g.lang, g.source), 0) + v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
wholes AS (SELECT lang, term, 1 + ({UNIT}::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS q FROM cells JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM cells JOIN wholes USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM every UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= {TOP}
"""
